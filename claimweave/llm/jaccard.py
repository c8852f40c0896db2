"""Exact Jaccard join of documents, by regions of the metric space.

The distance of two shingle sets is 1 - intersection / union, and documents link up to
the distance 1/4.  Shingles have one order for all documents, rare ones first.  The
region of a shingle ``s`` is all sets whose first shingle is ``s``: ``s`` is its pivot.
The nearest set to ``x`` in the region of the shingle that is k-th in ``x`` (from 0) is
``x`` without its first k, at the distance k / |x|.  If ``x`` and ``y`` link, their
intersection is no farther from either than they are from each other, so it lies in a
region within 1/4 of both: documents are replicated to all regions of their shingles
within the window k <= |x| / 4, and any two that link meet in one.

A region is joined in steps.  All its documents are compared with one of them, a second
pivot, which settles most regions, as near copies link to it.  In the others, pairs that
aren't connected yet are screened by folded bitmaps, whose Hamming distance is at most
that of the sets; the documents that pass are joined exactly, by recursive Voronoi cells
around sampled documents with windows of twice the link distance.  A region beyond a
block's size is cut into blocks, and each two of them are a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.common import broadcast_if_small, slices, tidy, written
from claimweave.llm.shingles import shingle_sets

#: Shingles counted in more documents than this come last in the order.
COMMON_FROM = 64
#: The most shingles that come last, 8 bytes each; the least frequent of more don't.
COMMON_LIMIT = 1 << 20
#: Shingles that a task sorts at once to count them.
COUNTED = 1 << 21
#: Documents in a block of a region.
BLOCK = 1024
#: Documents that are compared one by one.
LEAF = 48
LINK, WINDOW = 0.25, 0.5


# ------------------------------------------------------------------ signatures


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles found in very many documents, rising.

    Each task reports those that two or more of its documents share, so the report is
    short and a frequent shingle is in it.  The list only sets the order of shingles:
    the join is exact with any, and fast if hot passages come last."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def report() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held or [np.zeros(0, np.uint64)]), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], ["shingle", "n"]
            )

        for batch in batches:
            for shingles in shingle_sets(text.as_py() for text in batch.column(0)):
                key = xxhash.xxh3_64_intdigest(shingles.tobytes())
                if key not in seen:  # copies count once
                    seen.add(key)
                    held.append(shingles)
                    size += len(shingles)
                if size > COUNTED:
                    yield report()
                    held, size, seen = [], 0, set()
        yield report()

    reported = docs.select("text").mapInArrow(tidy(count), "shingle long, n long")
    summed = reported.groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = written(summed.where(F.col("n") > COMMON_FROM), "common-shingles")
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect()
    least, total = 64, 0
    for power, n in sizes:  # at most 63 rows
        total += n
        if total > COMMON_LIMIT:
            break
        least = power
    kept = counts.where(F.floor(F.log2("n")) >= least).select("shingle").toArrow()
    return np.sort(kept["shingle"].to_numpy().view(np.uint64))


def bitmap(shingles: np.ndarray) -> bytes:
    """Bits that an odd number of shingles hash to, four to eight for each shingle.  A
    bitmap of half the length is the exclusive or of the halves."""
    bits = 64 << max(0, int(len(shingles) * 4 - 1).bit_length() - 6)
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signatures(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """doc_id, n (set size), key (128 bits of the set), bitmap and the shingles of the
    window, for each document."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for part in slices(batches):
            sets = list(shingle_sets(part.column(1).to_pylist()))
            flat = np.concatenate(sets)
            at = np.searchsorted(last, flat)
            late = np.zeros(len(flat), bool)
            if len(last):
                late = last[np.minimum(at, len(last) - 1)] == flat
            prefixes, n = [], 0
            for s in sets:
                mask = late[n : n + len(s)]
                n += len(s)
                prefixes.append(np.concatenate([s[~mask], s[mask]])[: len(s) // 4 + 1])
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([bitmap(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(ends, np.concatenate(prefixes).view(np.int64)),
                ],
                ["doc_id", "n", "key", "bitmap", "prefix"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        tidy(sign), "doc_id long, n long, key binary, bitmap binary, prefix array<long>"
    )


def sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """id and the bytes of the shingle set, for the classes in ``ids``, from the texts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [s.tobytes() for s in shingle_sets(batch.column(1).to_pylist())]
            keys = [xxhash.xxh3_128_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["id", "key", "shingles"]
            )

    wanted = classes.select("id", "doc_id", "key").join(ids.distinct(), "id", "left_semi")
    wanted = broadcast_if_small(written(wanted, "wanted-sets"))
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(wanted.select(F.col("doc_id").alias("id")), "id", "left_semi")
    built = texts.mapInArrow(tidy(build), "id long, key binary, shingles binary").withColumnRenamed("id", "doc_id")
    # rows that repeat a doc_id with another text are of another class
    own = built.join(wanted, ["doc_id", "key"])
    return written(own.select("id", "shingles").dropDuplicates(["id"]), "sets")


# -------------------------------------------------------------- comparing pairs


def unpacked(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint64).reshape(len(values), -1)


def close_bitmaps(maps: list[bytes], n: np.ndarray, group: np.ndarray) -> np.ndarray:
    """True for documents that may link with one of another group: seven times the
    bitmaps' Hamming distance is at most the sum of the sizes, and the sizes fit."""
    found = np.zeros(len(n), bool)
    width = np.array([len(m) for m in maps])
    of = {w: np.flatnonzero(width == w) for w in np.unique(width)}
    for w, small in of.items():
        a = unpacked([maps[i] for i in small])
        for big in (small, of.get(2 * w)):
            if big is None:
                continue
            b = unpacked([maps[i] for i in big])
            if b.shape[1] > a.shape[1]:
                b = b[:, : a.shape[1]] ^ b[:, a.shape[1] :]
            step = max(1, (1 << 21) // max(1, len(big) * a.shape[1]))
            for first in range(0, len(small), step):
                own = small[first : first + step]
                sizes, others = n[own, None], n[big]
                fits = 4 * np.minimum(sizes, others) >= 3 * np.maximum(sizes, others)
                fits &= group[own, None] != group[big]
                if not fits.any():
                    continue
                apart = np.bitwise_count(a[first : first + step, None] ^ b).sum(2, dtype=np.int64)
                fits &= 7 * apart <= sizes + others
                found[own] |= fits.any(1)
                found[big] |= fits.any(0)
    return found


def overlaps(one: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a set with others, which lie in a row."""
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    return np.add.reduceat((one[at] == flat).astype(np.int64), starts)


def links(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * shared >= 75 * (a + b - shared)


class RegionJoin:
    """Links between documents of different groups, as many as connect them all."""

    def __init__(self, sets: list[np.ndarray], group: np.ndarray):
        self.size = np.array([len(s) for s in sets])
        known, places = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(places, np.cumsum(self.size)[:-1])
        self.marked = np.zeros(len(known), bool)
        self.root = {g: g for g in group.tolist()}
        self.group, self.found = group.tolist(), []

    def _root(self, member: int) -> int:
        g = self.group[member]
        while self.root[g] != g:
            self.root[g] = self.root[self.root[g]]
            g = self.root[g]
        return g

    def _shared(self, one: int, others: np.ndarray) -> np.ndarray:
        flat = np.concatenate([self.sets[i] for i in others])
        starts = np.concatenate([[0], np.cumsum(self.size[others])[:-1]])
        self.marked[self.sets[one]] = True
        shared = np.add.reduceat(self.marked[flat], starts, dtype=np.int64)
        self.marked[self.sets[one]] = False
        return shared

    def _connect(self, one: int, others: np.ndarray, shared: np.ndarray) -> None:
        for other in others[links(shared, self.size[one], self.size[others])].tolist():
            a, b = self._root(one), self._root(other)
            if a != b:
                self.root[a] = b
                self.found.append((one, other))

    def join(self, members: np.ndarray) -> list[tuple[int, int]]:
        if len(members) <= LEAF:
            self._compare(members)
            return self.found
        rng = np.random.default_rng(len(members))
        pivots = rng.choice(members, max(2, int(len(members) ** 0.5 / 2)), replace=False)
        far = np.empty((len(members), len(pivots)))
        for j, pivot in enumerate(pivots):
            shared = self._shared(pivot, members)
            far[:, j] = 1 - shared / (self.size[pivot] + self.size[members] - shared)
            others = members != pivot
            self._connect(pivot, members[others], shared[others])
        # the pair's cell is that of the one nearer to its pivot; the other is within
        # twice the link distance of its own nearest
        inside = far <= far.min(1, keepdims=True) + WINDOW + 1e-9
        if (inside.sum(0) ** 2).sum() >= len(members) ** 2:
            # the windows hold nearly all: cells would be more work than all at once
            self._compare(members)
            return self.found
        for j in range(len(pivots)):
            cell = members[inside[:, j]]
            if len({self._root(i) for i in cell.tolist()}) > 1:
                self.join(cell)
        return self.found

    def _compare(self, members: np.ndarray) -> None:
        members = members[np.argsort(self.size[members], kind="stable")]
        for i, one in enumerate(members[:-1].tolist()):
            rest = members[i + 1 :]
            rest = rest[: np.searchsorted(3 * self.size[rest], 4 * self.size[one], side="right")]
            own = self._root(one)
            rest = rest[[self._root(r) != own for r in rest.tolist()]] if len(rest) else rest
            if len(rest):
                self._connect(one, rest, self._shared(one, rest))


# ----------------------------------------------------------------------- tasks


def by_group(
    df: DataFrame, keys: list[str], work: Callable[[pa.Table], list], names: list[str]
) -> DataFrame:
    """``work`` on the rows of each group of a sorted partition, which gives rows of
    whole numbers.  Groups are small, so they are cut out of the batches here and not by
    one call to Python for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        made: list[tuple] = []
        for batch in batches:
            more = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, more]) if rest else more
            marks = [rest[k].to_numpy() for k in keys]
            change = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
            cuts = [0, *change.tolist()]
            for a, b in zip(cuts, cuts[1:]):
                made += work(rest.slice(a, b - a).combine_chunks())
            rest = rest.slice(cuts[-1]).combine_chunks()
            yield out(made)
            made = []
        if rest:
            yield out(work(rest))

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    fields = ", ".join(f"{name} long" for name in names)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), fields)


def one_of_each(rows: DataFrame, keys: list[str], same: list[str]) -> DataFrame:
    """Of groups with the same members, in columns ``same``, only one."""
    marks = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.bit_xor(F.xxhash64(*same)).alias("_a"),
        F.bit_xor(F.xxhash64(F.lit(1), *same)).alias("_b"),
    )
    first = marks.groupBy("_n", "_a", "_b").agg(F.min(F.struct(*keys)).alias("_first")).select("_first.*")
    return rows.join(first, keys, "left_semi")


def window_regions(classes: DataFrame) -> DataFrame:
    """region, id, n and the region's pivot (pivot, pivot_n): regions of two classes or
    more.  The pivot is the document with the largest part of its window shared, as the
    original of edited copies has."""
    posted = classes.select("id", "n", F.size("prefix").alias("_window"), F.explode("prefix").alias("region"))
    # a document is in a region once, so rows of a region are at most the documents
    counted = posted.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy("region")))
    shared = written(counted.where("_rows > 1").drop("_rows"), "regions")
    scores = shared.groupBy("id").agg((F.count(F.lit(1)) / F.first("_window")).alias("_score"))
    scored = one_of_each(shared, ["region"], ["id"]).join(scores, "id")
    best = F.max(F.struct("_score", (-F.col("id")).alias("_id"), "n"))
    pivots = scored.groupBy("region").agg(best.alias("_p")).select(
        "region", (-F.col("_p._id")).alias("pivot"), F.col("_p.n").alias("pivot_n")
    )
    return written(scored.select("region", "id", "n").join(pivots, "region"), "regions")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, with sizes a_n, b_n) that link: screened by bitmaps, then by sets."""
    maps = classes.select("id", "bitmap")
    with_maps = pairs.join(maps.toDF("a", "a_map"), "a").join(maps.toDF("b", "b_map"), "b")

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sides = zip(*(batch.column(c).to_pylist() for c in ("a_map", "b_map", "a_n", "b_n")))
            kept = [
                close_bitmaps([x, y], np.array([p, q]), np.array([0, 1])).all() for x, y, p, q in sides
            ]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                kept.append(bool(links(overlaps(p, q, np.zeros(1, np.int64)), len(p), len(q))[0]))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    likely = written(with_maps.mapInArrow(tidy(screen), "a long, b long"), "likely-pairs")
    ids = likely.select(F.explode(F.array("a", "b")).alias("id"))
    sets = sets_of(docs, classes, ids)
    full = likely.join(sets.toDF("a", "a_set"), "a").join(sets.toDF("b", "b_set"), "b")
    return written(full.select("a", "b", "a_set", "b_set").mapInArrow(tidy(check), "a long, b long"), "links")


def region_links(docs: DataFrame, classes: DataFrame, regions: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) between documents of a region other than its pivot, where ``labels``
    (id, label) doesn't connect them yet."""
    label = F.coalesce("label", "id").alias("label")
    rest = regions.where("id <> pivot").join(labels, "id", "left").select("region", "id", "n", label)
    several = rest.groupBy("region").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high"), F.count(F.lit(1)).alias("_rows")
    ).where("_low < _high").select("region", F.ceil(F.col("_rows") / BLOCK).cast("long").alias("_blocks"))
    open_ = one_of_each(rest.join(several, "region"), ["region"], ["id", "label"])
    # block i meets each block j >= i
    own = F.pmod(F.xxhash64("id"), F.col("_blocks"))
    pair = "least(_own, j) * 1000000 + greatest(_own, j)"
    tasks = open_.withColumn("_own", own).selectExpr(
        "region", "id", "n", "label",
        f"explode(transform(sequence(0L, _blocks - 1), j -> {pair})) AS task",
    )
    keys = ["region", "task"]

    def screen(group: pa.Table) -> list[tuple]:
        ids, names = group["id"].to_numpy(), group["label"].to_numpy()
        near = close_bitmaps(group["bitmap"].to_pylist(), group["n"].to_numpy(), names)
        region, task = group["region"][0].as_py(), group["task"][0].as_py()
        return [(region, task, i, g) for i, g in zip(ids[near].tolist(), names[near].tolist())]

    def join(group: pa.Table) -> list[tuple]:
        ids = group["id"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
        found = RegionJoin(sets, group["label"].to_numpy()).join(np.arange(len(sets)))
        return [(int(ids[a]), int(ids[b])) for a, b in found]

    with_maps = tasks.join(classes.select("id", "bitmap"), "id")
    near = written(by_group(with_maps, keys, screen, [*keys, "id", "label"]), "near-documents")
    near = written(one_of_each(near, keys, ["id", "label"]), "near-documents")
    with_sets = near.join(sets_of(docs, classes, near.select("id")), "id")
    return written(by_group(with_sets, keys, join, ["a", "b"]), "links")


# ------------------------------------------------------------------ components


def hop(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels (id, label) lowered to the least of the neighbours', then to that of the
    document the label names.  ``edges`` (a, b) go both ways."""
    near = edges.join(labels.toDF("b", "label"), "b").groupBy("a").agg(F.min("label").alias("_near"))
    lower = labels.join(near.toDF("id", "_near"), "id", "left").select(
        "id", F.least("label", F.coalesce("_near", "label")).alias("label")
    )
    return lower.join(lower.toDF("label", "_next"), "label", "left").select(
        "id", F.coalesce("_next", "label").alias("label")
    )


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select("b", "a")).distinct()


def first_labels(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """id and label, the least id that can be reached, for the documents of ``edges``.
    The labels are written after each round; names of names are followed, so the
    rounds grow with the logarithm of the longest path."""
    edges = written(both_ways(edges), "edges")
    labels = written(first_labels(edges), "labels")
    while True:
        lower = written(hop(edges, labels), "labels")
        changed = lower.join(labels.toDF("id", "_old"), "id").where("label <> _old")
        if changed.limit(1).count() == 0:
            return lower
        labels = lower


# -------------------------------------------------------------------- the join


def class_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame]:
    """The signatures of ``docs`` (doc_id, text); a class (id, doc_id, key, n) for each
    set of a named document; doc_ids whose rows have several sets, None if there are none;
    and links (a, b) between ids of classes, as many as connect them.

    The id of a class is its least doc_id, or a number above all doc_ids if another class
    has that one."""
    signed = written(signatures(docs, common_shingles(docs)), "signatures")
    first = F.row_number().over(Window.partitionBy("key").orderBy("doc_id"))
    classes = written(
        signed.where("n > 0 AND doc_id IS NOT NULL").withColumn("_nth", first).where("_nth = 1").drop("_nth")
        .withColumn("id", F.col("doc_id")),
        "classes",
    )
    keys = signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("key").alias("_low"), F.max("key").alias("_high"))
    several = written(keys.where("_low < _high").select("doc_id"), "several-sets")
    if not several.limit(1).count():
        several = None
    else:
        least = classes.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("key").alias("_least"))
        least = broadcast_if_small(written(least, "least-keys"))
        above = signed.agg(F.max("doc_id")).first()[0] + 1
        other = F.col("_least").isNotNull() & (F.col("key") != F.col("_least"))
        fresh = F.lit(above).cast("long") + F.monotonically_increasing_id()
        classes = written(
            classes.join(least, "doc_id", "left").withColumn("id", F.when(other, fresh).otherwise(F.col("doc_id"))).drop("_least"),
            "classes",
        )
    regions = window_regions(classes)
    pairs = (
        regions.where("id <> pivot AND 4 * least(n, pivot_n) >= 3 * greatest(n, pivot_n)")
        .selectExpr("pivot AS a", "id AS b", "pivot_n AS a_n", "n AS b_n")
        .distinct()
    )
    stars = verified(docs, classes, pairs)
    edges = both_ways(stars)
    labels = written(hop(edges, first_labels(edges)), "labels")
    return signed, classes, several, stars.union(region_links(docs, classes, regions, labels))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of ``docs`` (doc_id, text).

    Documents with equal sets are one class and are compared once.  A NULL or empty
    text has the empty set and is linked with nothing, its component is its doc_id's.
    Rows that repeat a doc_id are rows of the result and of one component, whatever their
    texts; a row without a doc_id takes part only if others with an equal set have one,
    and gets their component, else NULL.  Other columns are left out.
    """
    docs = docs.select("doc_id", "text")
    signed, classes, several, edges = class_links(docs)
    if several is not None:
        named = signed.where("n > 0").join(several, "doc_id", "left_semi").join(classes.select("id", "key"), "key")
        edges = edges.union(named.where("id <> doc_id").select("id", "doc_id"))
    found = components(edges)
    parts = classes.select("id", "key").join(found, "id", "left").select("key", F.coalesce("label", "id").alias("_component"))
    empty = F.col("doc_id")
    if several is not None:  # an empty text of a document that has others
        signed = signed.join(found.toDF("doc_id", "_own"), "doc_id", "left")
        empty = F.coalesce("_own", "doc_id")
    return signed.join(parts, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_component")).otherwise(empty).alias("component_id"),
    )


def leaders(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the set) and leads for each row of ``docs``: true for rows of the
    document that stands for a group of linked sets, and for empty texts.  Other texts of
    the same doc_id don't link sets."""
    docs = docs.select("doc_id", "text")
    signed, classes, _, edges = class_links(docs)
    grouped = classes.select("id", "key", "doc_id").join(components(edges), "id", "left")
    head = F.min(F.struct(F.col("doc_id").alias("_first"), "key")).alias("_head")
    heads = grouped.groupBy(F.coalesce("label", "id").alias("label")).agg(head).select("_head.*")
    leads = (F.col("n") == 0) | F.coalesce(F.col("_first") == F.col("doc_id"), F.lit(False))
    return signed.select("doc_id", "n", "key").join(heads, "key", "left").select("doc_id", "key", leads.alias("leads"))


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` in a struct ``kept``, and the ``key`` of each text's set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in shingle_sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["kept", "key"])

    rows = docs.select(F.struct(*docs.columns).alias("kept"), "text")
    return rows.mapInArrow(tidy(sign), T.StructType([rows.schema["kept"]]).add("key", "binary"))
