"""The operators over the given tables, and SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import (
    byte_bpe, conversations, exact_topk, hilbert, html_text, jaccard, langid, merkle, mixing, packing, pii, posting_ann,
    secrets,
)
from claimweave.llm.common import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ 1 sharding


@register
def op1_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "n_chars",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = hilbert.hilbert_shards(rows, tie_break=("text_crc32", "size"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def _curve_steps(axes: list[str], bits: int) -> Iterator[dict[str, str]]:
    """The curve as projections to run one after the other, each a dict of column and
    SQL text; the last gives ``_cell``."""
    def xor(a, b) -> str:
        return f"xor({a}, {b})"

    def bit(a, i) -> str:
        return f"(({a} >> {i}) & 1)"

    first, last = axes[0], axes[-1]
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        yield {first: f"CASE WHEN {bit(first, q)} = 1 THEN {xor(first, low)} ELSE {first} END"}
        for axis in axes[1:]:
            swapped = f"({xor(first, axis)} & {low})"
            yield {
                first: f"CASE WHEN {bit(axis, q)} = 1 THEN {xor(first, low)}"
                f" ELSE {xor(first, swapped)} END",
                axis: f"CASE WHEN {bit(axis, q)} = 1 THEN {axis} ELSE {xor(axis, swapped)} END",
            }
    for before, axis in zip(axes, axes[1:]):
        yield {axis: xor(axis, before)}
    turned = "0"
    for q in range(bits - 1, 0, -1):
        turned = xor(turned, f"({bit(last, q)} * {(1 << q) - 1})")
    yield {"_turned": turned}
    yield {axis: xor(axis, "_turned") for axis in axes}
    places = [(axis, q) for q in range(bits - 1, -1, -1) for axis in axes]
    terms = [f"{bit(a, q)} * {1 << (len(places) - 1 - i)}" for i, (a, q) in enumerate(places)]
    yield {"_cell": " + ".join(terms)}


def _crc32_sql(bytes_: str) -> str:
    """The CRC-32 of a list of bytes, by the table of the reflected polynomial."""
    crc = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        crc.append(value)
    return (
        f"xor(list_reduce(list_prepend(4294967295, {bytes_}),"
        f" lambda c, b: xor(c >> 8, {crc}[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def _bytes_sql(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"


def _hilbert_sql() -> str:
    """Levels by counting rows below, the curve by the same published steps, shards by
    dealing the ranked rows."""
    def h32(c: str) -> str:
        return f"('0x' || md5(coalesce({c}::VARCHAR, ''))[1:8])::BIGINT"

    steps = [
        "base AS (SELECT doc_id, coalesce(text, '') AS t, source, lang, n_chars,"
        f" CASE WHEN source IS NULL THEN -1 ELSE {h32('source')} % 4096 END AS r0,"
        f" CASE WHEN lang IS NULL THEN -1 ELSE {h32('lang')} % 4096 END AS r1,"
        " CASE WHEN n_chars IS NULL THEN -1 WHEN n_chars < 16 THEN greatest(n_chars, 0)"
        " ELSE (len(bin(n_chars)) - 1) * 16 + ((n_chars >> (len(bin(n_chars)) - 5)) - 16)"
        " END AS r2 FROM documents)",
        "s0 AS (SELECT *, " + ", ".join(
            f"(rank() OVER (ORDER BY r{i}) - 1) * 32 // count(*) OVER () AS _x{i}" for i in range(3)
        ) + " FROM base)",
    ]
    names = ["_x0", "_x1", "_x2"]
    for k, step in enumerate(_curve_steps(names, 5), 1):
        kept = [f"{text} AS {name}" for name, text in step.items()]
        old = [name for name in step if name in names]
        rest = f"* EXCLUDE ({', '.join(old)})" if old else "*"
        steps.append(f"s{k} AS MATERIALIZED (SELECT {rest}, {', '.join(kept)} FROM s{k - 1})")
    steps.append(
        f"sized AS (SELECT doc_id, _cell AS curve, strlen(t) + 16 AS size,"
        f" {_crc32_sql(_bytes_sql('t'))} AS text_crc32 FROM s{k})"
    )
    steps.append(
        "ranked AS (SELECT *, row_number() OVER (ORDER BY curve,"
        f" {h32('doc_id')}, doc_id, text_crc32, size) - 1 AS p, count(*) OVER () AS n FROM sized)"
    )
    return (
        "WITH " + ", ".join(steps) + " SELECT doc_id, size, text_crc32, 'rows' AS law,"
        " (p * 40 // n)::INT AS shard,"
        " row_number() OVER (PARTITION BY p * 40 // n ORDER BY p) - 1 AS slot,"
        " NULL::INT AS grown_shard, curve FROM ranked"
    )


SQL["op1_hilbert"] = _hilbert_sql()


# ------------------------------------------------------------------- 10 mixing


@register
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


SQL["op10_mixing"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS s,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source
), full_sets AS (
  SELECT 0 AS step, []::VARCHAR[] AS full_, -1 AS before
  UNION ALL
  SELECT step + 1, now_full, len(full_) FROM (
    SELECT f.step, f.full_, list_sort(list(coalesce('=' || source, '')) FILTER (
      list_contains(f.full_, coalesce('=' || source, '')) OR w * rate > 3 * s)) AS now_full
    FROM (
      SELECT f.*, c.source, c.s, c.w,
        (sum(s) OVER () - sum(CASE WHEN list_contains(f.full_, coalesce('=' || source, ''))
          THEN 3 * s ELSE 0 END) OVER ())
        / nullif(sum(CASE WHEN list_contains(f.full_, coalesce('=' || source, '')) THEN 0 ELSE w END) OVER (), 0) AS rate
      FROM full_sets f, sources c WHERE len(f.full_) > f.before
    ) f GROUP BY f.step, f.full_
  )
), settled AS (
  SELECT coalesce(arg_max(full_, step), []) AS full_ FROM full_sets WHERE full_ IS NOT NULL
), shared AS (
  SELECT source, s, CASE WHEN list_contains(full_, coalesce('=' || source, '')) THEN (3 * s)::DOUBLE
    ELSE w * ((sum(s) OVER () - sum(CASE WHEN list_contains(full_, coalesce('=' || source, ''))
        THEN 3 * s ELSE 0 END) OVER ())
      / sum(CASE WHEN list_contains(full_, coalesce('=' || source, '')) THEN 0 ELSE w END) OVER ())
    END AS target
  FROM sources, settled
), rated AS (
  SELECT d.doc_id, d.size, c.s, c.target, CASE WHEN c.s > 0 THEN c.target / c.s ELSE 0 END AS rate
  FROM sized d JOIN shared c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, size, s AS source_size, target,
  (floor(rate)::BIGINT + (('0x' || md5('mix-1:' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT
    / 4503599627370496.0 < rate - floor(rate))::BIGINT) * size AS taken
FROM rated
"""


# ------------------------------------------------------------------- 7 secrets


@register
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(spark, versions, shared_folder(spark, "blob-ledger"))
    base = [rule.kind for rule in secrets.BASE_RULES]
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    counts = [
        F.expr(f"CAST(size(filter(spans, s -> s.kind = '{kind}')) AS bigint) AS n_{kind}")
        for kind in base
    ]
    return found.select(
        "doc_id", *counts,
        F.sha2(secrets.as_text(of_base), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


# ----------------------------------------------------------- 4 and 6 vector search


@register
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return posting_ann.search(vectors.where("vec_id % 20 = 0"), vectors, 20)


@register
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = exact_topk.integer_weights(table(spark, sf_dir, "embeddings"))
    return exact_topk.search(vectors.where("vec_id % 50 = 0"), vectors, 5)


SQL["op6_topk"] = """
WITH ints AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum([q.w[i] * c.w[i] for i in range(1, 1 + len(c.w))])::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 5
"""


# ----------------------------------------------------------- 3 packing, 5 language


@register
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fitted(docs))
    return found.select(
        "doc_id", langid.is_held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


# --------------------------------------------------------------- 2 Jaccard join


@register
def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


SQL["op2_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), posted AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM posted a JOIN posted b
    ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""


# ---------------------------------------------------------------------- 9 PII


@register
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fitted(docs))
    base = F.filter("pii", lambda s: s["base"])
    counts = [
        F.expr(f"CAST(size(filter(pii, s -> s.base AND s.kind = '{kind}')) AS bigint) AS n_{kind}")
        for kind in pii.KINDS
    ]
    return found.select(
        "doc_id", *counts,
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
        secrets.as_text(F.col("pii")).alias("spans"),
    )


# --------------------------------------------------------------------- 8 HTML


@register
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------- 11 byte-level BPE


@register
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# ------------------------------------------------------------- 12 Merkle manifest


@register
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(merkle.manifest(table(spark, sf_dir, "documents")))


def _merkle_sql() -> str:
    """Levels by recursion: runs of three are joined and hashed; a leaf's siblings and
    fold go up the same levels."""
    fields = " || ".join(
        f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")
    )
    text = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"
    tampered = f"CASE WHEN {_crc32_sql(_bytes_sql('doc_id::VARCHAR'))} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"

    def levels(name: str, first: str) -> str:
        return f"""{name} AS (
  {first}
  UNION ALL
  SELECT tree, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
  FROM {name} WHERE n > 1 GROUP BY tree, level, i // 3
)"""

    def run(name: str) -> str:
        return f"""SELECT a.tree, a.level, a.i,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS behind
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.i"""

    return f"""
WITH RECURSIVE given AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, sha256({fields} || {text.format('text')}) AS leaf,
    sha256({fields} || {text.format(f'({tampered})')}) AS tampered
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY tree) AS n
  FROM given
), {levels("nodes", "SELECT tree, 0 AS level, i, leaf AS h, n FROM placed")},
subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), {levels("tops", "SELECT 'root' AS tree, 0 AS level, i, h, n FROM subroots")},
runs AS MATERIALIZED ({run("nodes")}), top_runs AS MATERIALIZED ({run("tops")}),
climbed AS (
  SELECT tree || ':' || i AS id, tree, 0 AS level, i, tampered AS h, '' AS siblings FROM placed
  UNION ALL
  SELECT id, c.tree, c.level + 1, c.i // 3, sha256(before || c.h || behind), siblings || before || behind
  FROM climbed c JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.i = c.i
), up AS (
  SELECT id, 0 AS level, s.i, c.h, siblings FROM climbed c JOIN subroots s ON s.tree = c.tree
  WHERE c.level = (SELECT max(level) FROM nodes x WHERE x.tree = c.tree)
  UNION ALL
  SELECT id, u.level + 1, u.i // 3, sha256(before || u.h || behind), siblings || before || behind
  FROM up u JOIN top_runs r ON r.level = u.level AND r.i = u.i
)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(u.siblings) AS proof_sha256, u.h AS folded_root,
  u.h = t.h AS verified
FROM placed p JOIN subroots s USING (tree) JOIN tops t ON t.n = 1
JOIN up u ON u.id = p.tree || ':' || p.i AND u.level = t.level
"""


SQL["op12_merkle"] = _merkle_sql()


# ------------------------------------------------------- 13 conversation repair


@register
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def _conversations_sql() -> str:
    """From the last row to the first, the least (cost, audit) from each of the four
    states of the grammar; then the audit is read off against the rows."""
    crc = _crc32_sql(_bytes_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"))
    never = "{'c': 1000000000::BIGINT, 'a': ''}"

    def plus(cost: str, letters: str, state: int) -> str:
        return f"{{'c': v{state}.c + {cost}, 'a': {letters} || v{state}.a}}"

    def option(state: int) -> str:
        """What row r can become in a state, v0 to v3 being the least that follow."""
        wanted, other, then = ("a", "u", 3) if state == 2 else ("u", "a", 2)
        back = 5 - then  # the state after one more turn
        choices = [plus("4", "'D'", state)]
        kept = [
            plus(f"x + CASE WHEN i0 = '{wanted}' THEN 0 ELSE 3 END", f"CASE WHEN i0 = '{wanted}' THEN 'K' ELSE 'R' END", then),
            plus(f"3 + x + CASE WHEN i0 = '{other}' THEN 0 ELSE 3 END", f"CASE WHEN i0 = '{other}' THEN 'IK' ELSE 'IR' END", back),
        ]
        if state == 0:
            kept.append(f"CASE WHEN i0 = 's' THEN {plus('x', repr('K'), 1)} ELSE {never} END")
        choices += [f"CASE WHEN fault IN (1, 2) THEN {never} ELSE {k} END" for k in kept]
        return f"list_min([{', '.join(choices)}])"

    return rf"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS fate FROM conversations
), broken AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM marked WHERE fate <> 0
), ordered AS (
  SELECT *, left(role, 1) AS i0, rtrim(text, E' 	
') AS ended,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS n
  FROM broken
), judged AS (
  SELECT *, CASE WHEN ended = '' THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 2
      WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(i0) OVER (PARTITION BY conv_id ORDER BY n) || i0 AS pair
  FROM ordered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    count(*) AS rows_
  FROM judged GROUP BY conv_id
), best AS (
  SELECT conv_id, rows_ AS n, {{'c': 0::BIGINT, 'a': ''}} AS v0, {{'c': 6::BIGINT, 'a': 'II'}} AS v1,
    {{'c': 3::BIGINT, 'a': 'I'}} AS v2, {{'c': 0::BIGINT, 'a': ''}} AS v3
  FROM counted
  UNION ALL
  SELECT conv_id, n - 1, {option(0)}, {option(1)}, {option(2)}, {option(3)}
  FROM (SELECT b.*, j.i0, j.fault, CASE WHEN j.fault = 3 THEN 3 ELSE 0 END AS x
    FROM best b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.n = b.n)
), letters AS (
  SELECT conv_id, v0.c AS cost, v0.a AS audit, unnest(string_split(v0.a, '')) AS letter, unnest(range(1, len(v0.a) + 1)) AS k
  FROM best WHERE n = 0
), placed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS n, count(*) FILTER (letter <> 'D') OVER w AS made
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), opened AS (
  SELECT p.*, j.role, j.text,
    max(CASE WHEN letter = 'K' AND made = 1 AND j.i0 = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS opens
  FROM placed p LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.n = p.n AND letter <> 'I'
), whole AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (made - opens) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k)) AS h
  FROM opened WHERE letter <> 'D' GROUP BY conv_id
)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.v0.c, 0)::BIGINT AS cost,
  coalesce(b.v0.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM g.conv_id AND b.n = 0
LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM g.conv_id
"""


SQL["op13_conversations"] = _conversations_sql()
