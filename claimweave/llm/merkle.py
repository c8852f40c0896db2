"""A Merkle manifest of a dataset as an append log in postorder.

Each source has a tree of runs of three over its rows in order of doc_id, and the trees'
tops have one more.  Builders take aligned blocks of 3**8 leaves and append a node as
soon as its last child is there, so a subtree is one stretch of the log, and where a
node stands follows from the sizes of subtrees alone.  Proofs read siblings by these
addresses.  The tops of a tree's blocks are the leaves of the next tier, until a tree
has one top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import batches_of, rows_of, written
from claimweave.llm.order import in_order, with_places

ARITY, BLOCK_LEVELS = 3, 8
BLOCK = ARITY**BLOCK_LEVELS
ROOT_TREE = "root"
DIGEST_BYTES = 32
HEAD = ("head", "subroot", "root")
HEAD_FIELDS = [(name, pa.binary()) for name in HEAD]
HEAD_DDL = ", ".join(f"{name} binary" for name in HEAD)


class Step(NamedTuple):
    """A node's siblings in its run: those before it and those behind it."""

    before: tuple[bytes, ...]
    behind: tuple[bytes, ...]


def hashed(parts: Iterable[bytes]) -> bytes:
    """The digest of digests, each as hex text."""
    return hashlib.sha256("".join(part.hex() for part in parts).encode()).digest()


def levels_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels, width = 0, 1
    while width < leaves:
        levels, width = levels + 1, width * ARITY
    return levels


def address(level: int, index: int, leaves: int, levels: int) -> int:
    """Where node ``index`` of a level stands in the postorder log of a tree of
    ``levels`` levels over ``leaves`` leaves.

    When a node is complete, so is every node that begins below the end of its leaves
    on its own level and below it, and every node above it that ends before it begins."""
    end = min(leaves, (index + 1) * ARITY**level)
    here = sum(-(-end // ARITY**k) for k in range(level + 1))
    return here + sum(index // ARITY**k for k in range(1, levels - level + 1)) - 1


def append_log(leaves: Iterable[bytes], levels: int) -> list[bytes]:
    """All nodes over the leaves in the order in which they are complete, the top last.
    The last run of a level may be short."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def append(level: int, node: bytes) -> None:
        log.append(node)
        open_runs[level].append(node)
        if level < levels and len(open_runs[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        append(level + 1, hashed(run))

    for leaf in leaves:
        append(0, leaf)
    for level in range(levels):
        if open_runs[level]:
            close(level)
    return log


def steps_of(log: bytes, leaves: int, levels: int) -> Iterator[list[Step]]:
    """For each leaf of a block, its siblings from its own run up to the top's; nodes
    are read from the log by their addresses."""
    counts = [-(-leaves // ARITY**level) for level in range(levels + 1)]
    above: list[list[Step]] = [[]]
    for level in range(levels - 1, -1, -1):
        nodes = [address(level, i, leaves, levels) * DIGEST_BYTES for i in range(counts[level])]
        digests = [log[at : at + DIGEST_BYTES] for at in nodes]
        steps = []
        for i in range(counts[level]):
            first = i - i % ARITY
            step = Step(tuple(digests[first:i]), tuple(digests[i + 1 : first + ARITY]))
            steps.append([step, *above[i // ARITY]])
        above = steps
    yield from above


def as_bytes(steps: list[Step]) -> bytes:
    return b"".join(bytes(map(len, step)) + b"".join(step.before + step.behind) for step in steps)


def from_bytes(raw: bytes) -> list[Step]:
    steps, at = [], 0
    while at < len(raw):
        before, behind = raw[at], raw[at + 1]
        ends = range(at + 2, at + 2 + DIGEST_BYTES * (before + behind), DIGEST_BYTES)
        nodes = tuple(raw[i : i + DIGEST_BYTES] for i in ends)
        steps.append(Step(nodes[:before], nodes[before:]))
        at += 2 + DIGEST_BYTES * (before + behind)
    return steps


def folded(leaf: bytes, steps: list[Step]) -> bytes:
    """The root that a leaf and its siblings give."""
    return reduce(lambda node, step: hashed([*step.before, node, *step.behind]), steps, leaf)


# ---------------------------------------------------------------------- leaves


def field(value: Column) -> Column:
    """`-` for NULL, else the bytes of the value's text, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    fields = [field(F.col(name)) for name in ("doc_id", "source", "lang", "n_chars")]
    return F.unhex(F.sha2(F.concat(*fields, field(text)), 256))


def is_tampered() -> Column:
    """Whether 2 divides the CRC-32 of the doc_id's decimal text; not where it is NULL."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves_of(docs: DataFrame) -> DataFrame:
    """``tree`` (the source as text that sorts NULL first), doc_id, ``leaf`` and
    ``tampered``, the leaf of the row with a text that lost its line feeds where
    ``is_tampered``."""
    lines = is_tampered() & F.col("text").contains("\n")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree"),
        "doc_id",
        leaf(F.col("text")).alias("leaf"),
        F.when(lines, leaf(F.translate("text", "\n", ""))).otherwise(leaf(F.col("text"))).alias("tampered"),
    )


# ------------------------------------------------------------------------- log


def build(items: DataFrame, name: str) -> DataFrame:
    """The logs of all blocks of a tier's items (tree, position, total, digest): tree,
    ``block``, ``leaves``, ``levels``, ``log`` (digests in postorder) and ``top``."""
    schema = pa.schema(
        [("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("leaves", pa.int32()),
         ("levels", pa.int32()), ("log", pa.binary()), ("top", pa.binary())]
    )

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple]:
            for (tree, block, total), rows in groupby(rows_of(batches), key=lambda row: row[:3]):
                digests = [row[4] for row in rows]
                levels = levels_of(total) if total <= BLOCK else BLOCK_LEVELS
                log = append_log(digests, levels)
                yield tree, block, total, len(digests), levels, b"".join(log), log[-1]

        yield from batches_of(blocks(), schema, 16)  # a log has up to 315 KB

    blocked = items.select("tree", F.floor(F.col("position") / BLOCK).alias("block"), "total", "position", "digest")
    sorted_ = blocked.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    ddl = "tree string, block long, total long, leaves int, levels int, log binary, top binary"
    return written(sorted_.mapInArrow(of_task, ddl), name)


def tiers(items: DataFrame, name: str) -> list[DataFrame]:
    """The logs of a forest, tier by tier, until each tree has one top."""
    made = [build(items, name)]
    while made[-1].where(F.col("total") > BLOCK).limit(1).count():
        tops = made[-1].where(F.col("total") > BLOCK).select(
            "tree", F.col("block").alias("position"), F.ceil(F.col("total") / BLOCK).alias("total"),
            F.col("top").alias("digest"),
        )
        made.append(build(tops, name))
    return made


def tree_tops(logs: list[DataFrame]) -> DataFrame:
    """``tree`` and its ``top``."""
    done = [log.where(F.col("total") <= BLOCK).select("tree", "top") for log in logs]
    return reduce(DataFrame.unionByName, done)


# ---------------------------------------------------------------------- proofs


def with_heads(logs: list[DataFrame], heads: DataFrame, name: str) -> DataFrame:
    """The lowest tier's logs with ``head``, the siblings from above the block's top up
    to the root, ``subroot`` and ``root``; ``heads`` has these for whole trees."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def items() -> Iterator[tuple]:
            for tree, block, leaves, levels, log, head, subroot, root in rows_of(batches):
                for i, steps in enumerate(steps_of(log, leaves, levels)):
                    yield tree, block * BLOCK + i, as_bytes(steps) + head, subroot, root

        yield from batches_of(items(), pa.schema([("tree", pa.string()), ("block", pa.int64()), *HEAD_FIELDS]))

    found = above = None
    for log in reversed(logs):
        found = log.where(F.col("total") <= BLOCK).join(heads, "tree")
        if above is not None:
            found = found.unionByName(log.where(F.col("total") > BLOCK).join(above, ["tree", "block"]))
        found = found.select("tree", "block", "leaves", "levels", "log", *HEAD)
        if log is not logs[0]:
            above = written(found.mapInArrow(expand, f"tree string, block long, {HEAD_DDL}"), name)
    return found


def matched(blocks: DataFrame, items: DataFrame, proof: Callable[..., tuple], schema: pa.Schema, ddl: str) -> DataFrame:
    """``proof`` of key, leaf, tampered, siblings, subroot and root for each of the items
    (tree, key, position, leaf, tampered).  A block's log comes before its items."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            steps, above, ends = [], [], ()
            for _, _, position, leaves, levels, log, head, subroot, root, key, leaf, tampered in rows_of(batches):
                if position < 0:
                    steps, above, ends = list(steps_of(log, leaves, levels)), from_bytes(head), (subroot, root)
                else:
                    yield proof(key, leaf, tampered, steps[position % BLOCK] + above, *ends)

        yield from batches_of(found(), schema)

    both = blocks.withColumn("position", F.lit(-1).cast("long")).unionByName(
        items.withColumn("block", F.floor(F.col("position") / BLOCK)), allowMissingColumns=True
    )
    columns = ("tree", "block", "position", "leaves", "levels", "log", *HEAD, "key", "leaf", "tampered")
    sorted_ = both.select(*columns).repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    return sorted_.mapInArrow(of_task, ddl)


class Manifest(NamedTuple):
    """``items``: the rows with their places; ``logs``: of the sources' trees, tier by
    tier; ``sources``: tree, position and top of each; ``root_logs``: of the tree over them."""

    items: DataFrame
    logs: list[DataFrame]
    sources: DataFrame
    root_logs: list[DataFrame]


def manifest(docs: DataFrame) -> Manifest:
    """The log of ``docs`` (doc_id, source, lang, n_chars, text).

    Rows of one source stand in the order of doc_id (NULL first) and, for a repeated
    doc_id, of their leaf; equal rows are leaves of their own.  A NULL source is a
    source, the first; NULL values are written as `-`.  Texts are hashed whole.  An empty
    table has no nodes.  Other columns are left out."""
    # equal rows are many perhaps; a number lets them lie in several parts
    leaves = written(leaves_of(docs).withColumn("copy", F.monotonically_increasing_id()), "leaves")
    ordered = in_order(leaves, ["tree", "doc_id", "leaf", "copy"], "ordered-leaves").drop("copy")
    items = written(with_places(ordered, "tree"), "placed-leaves")
    logs = tiers(items.withColumnRenamed("leaf", "digest"), "merkle-log")
    tops = written(tree_tops(logs).select(F.lit(ROOT_TREE).alias("tree"), F.col("tree").alias("source"), "top"), "subroots")
    sources = written(with_places(in_order(tops, ["source"], "ordered-subroots"), "tree"), "placed-subroots")
    root_logs = tiers(sources.withColumnRenamed("top", "digest"), "merkle-root-log")
    return Manifest(items, logs, sources, root_logs)


def proofs(made: Manifest) -> DataFrame:
    """For each row: doc_id, leaf, subroot, root, ``proof_sha256`` (the hash of its
    siblings up to the root), ``folded_root`` (what the perhaps tampered leaf and these
    siblings give) and ``verified``, whether that is the root.  Hashes are hex text."""
    root = tree_tops(made.root_logs)  # one row
    none = F.lit(None).cast("binary")
    above_root = root.select("tree", F.lit(b"").alias("head"), none.alias("subroot"), F.col("top").alias("root"))
    heads = written(
        matched(
            with_heads(made.root_logs, F.broadcast(above_root), "root-heads"),
            made.sources.selectExpr("tree", "source AS key", "position", "top AS leaf", "top AS tampered"),
            lambda source, top, _, steps, __, root: (source, as_bytes(steps), top, root),
            pa.schema([("tree", pa.string()), *HEAD_FIELDS]), f"tree string, {HEAD_DDL}",
        ),
        "source-heads",
    )

    def proof(doc_id: str, leaf: bytes, tampered: bytes, steps: list[Step], subroot: bytes, root: bytes) -> tuple:
        siblings = hashed(node for step in steps for node in step.before + step.behind)
        return doc_id, leaf, subroot, root, siblings, folded(tampered, steps)

    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    proven = matched(
        with_heads(made.logs, heads, "heads"), made.items.withColumn("key", F.col("doc_id").cast("string")), proof,
        pa.schema([("doc_id", pa.string()), *((name, pa.binary()) for name in names)]),
        "doc_id string, " + ", ".join(f"{name} binary" for name in names),
    )
    return proven.select(
        F.col("doc_id").cast(made.items.schema["doc_id"].dataType).alias("doc_id"),
        *(F.lower(F.hex(name)).alias(name) for name in names),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
