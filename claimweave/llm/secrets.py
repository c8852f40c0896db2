"""Secret scans with an incremental ledger of content-addressed texts.

Every version of every path is addressed by the SHA-256 of its text.  A ledger keeps,
for each address, which rules at which version have read it and what they found.  A
scan reads only texts that some rule has not seen, adds a row for each to the ledger,
and joins the findings of the current rules back to every path and version.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm.common import exists


class Rule(NamedTuple):
    """Matches of ``pattern``, leftmost and non-overlapping; those whose ``group`` has
    fewer than ``least`` characters are dropped after matching."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # a run of one class is matched whole, so its least length can stand in the pattern
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE_RULES,
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

SPAN = "struct<start: int, ord: int, kind: string, stop: int>"


def address(text: Column) -> Column:
    """The SHA-256 of the text; no text is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _spans(rule: Rule, order: int) -> str:
    """Spans of one rule from its columns: the text between matches and the matches
    alternate, so their lengths add up to positions in code points."""
    gaps, found, value = (f"_{part}_{rule.kind}" for part in ("gaps", "found", "value"))
    kept = f"filter(spans, (s, i) -> length({value}[i]) >= {rule.least})"
    walked = f"""aggregate(sequence(0, size({found}) - 1),
        struct(0 AS at, CAST(array() AS array<{SPAN}>) AS spans),
        (acc, i) -> struct(
            acc.at + length({gaps}[i]) + length({found}[i]) AS at,
            array_append(acc.spans, struct(acc.at + length({gaps}[i]) AS start, {order} AS ord,
                '{rule.kind}' AS kind, acc.at + length({gaps}[i]) + length({found}[i]) AS stop)) AS spans),
        acc -> acc.spans)"""
    if rule.least > 1:
        walked = f"transform(array({walked}), spans -> {kept})[0]"
    return f"CASE WHEN size({found}) > 0 THEN {walked} END"


def scan_texts(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob``, the rules that read it now, and their spans.  ``texts`` has ``blob``,
    ``text`` and ``_seen``, the names of rules that have read the text before."""
    columns = {}
    for rule in rules:
        unseen = f"NOT array_contains(_seen, '{rule.name}')"
        pattern = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
        columns[f"_found_{rule.kind}"] = F.expr(f"if({unseen}, regexp_extract_all(text, '{pattern}', 0), array())")
    scanned = texts.withColumns(columns)
    columns = {}
    for rule in rules:
        pattern = rule.pattern.replace("\\", "\\\\").replace("'", "\\'")
        some = f"size(_found_{rule.kind}) > 0"
        columns[f"_gaps_{rule.kind}"] = F.expr(f"if({some}, split(text, '{pattern}', -1), array())")
        columns[f"_value_{rule.kind}"] = F.expr(
            f"if({some}, regexp_extract_all(text, '{pattern}', {rule.group}), array())"
        )
    names = F.array(*[F.lit(rule.name) for rule in rules])
    spans = [f"coalesce({_spans(rule, i)}, array())" for i, rule in enumerate(rules)]
    return scanned.withColumns(columns).select(
        "blob",
        F.array_except(names, F.col("_seen")).alias("rules"),
        F.expr(f"concat({', '.join(spans)})").cast(f"array<{SPAN}>").alias("spans"),
    )


def update_ledger(
    spark: SparkSession, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES
) -> None:
    """Scan what the ledger lacks: texts new to it, and known texts for new rules.

    Equal texts meet in the shuffle by address, after each map task has kept one of
    them.  A scan that is repeated adds nothing."""
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    todo = versions.select(address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    if exists(spark, ledger):
        seen = spark.read.parquet(ledger).groupBy("blob").agg(
            F.array_distinct(F.flatten(F.collect_set("rules"))).alias("_seen")
        )
        todo = todo.join(seen, "blob", "left").withColumn(
            "_seen", F.coalesce("_seen", F.array().cast("array<string>"))
        )
        todo = todo.where(F.size(F.array_except(wanted, F.col("_seen"))) > 0)
    else:
        todo = todo.withColumn("_seen", F.array().cast("array<string>"))
    one = F.row_number().over(Window.partitionBy("blob").orderBy(F.lit(0)))
    todo = todo.withColumn("_nth", one).where("_nth = 1").drop("_nth")
    scan_texts(todo, rules).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``spans`` of the given rules in order, for texts where there are any."""
    names = ", ".join(f"'{rule.name}'" for rule in rules)
    kinds = ", ".join(f"'{rule.kind}'" for rule in rules)
    rows = spark.read.parquet(ledger).where(f"size(spans) > 0 AND arrays_overlap(rules, array({names}))")
    rows = rows.selectExpr(
        "blob",
        f"filter(spans, s -> array_contains(array({kinds}), s.kind) AND exists(rules,"
        f" r -> array_contains(array({names}), r) AND substring_index(r, '@', 1) = s.kind)) AS spans",
    )
    return rows.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def scan(
    spark: SparkSession, versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``versions`` (with ``text``) without the text but with ``spans``, an array of
    start, ord (the rule's place), kind, stop; empty where nothing is found.

    Positions count code points, ``stop`` is exclusive, and spans are sorted by start
    and rule.  Rows with equal texts, also repeated rows, get equal spans; a NULL text
    counts as empty.  ``ledger`` is a folder that all executors share; it is made when
    it does not exist, and later scans may add versions and rules.
    """
    update_ledger(spark, versions, ledger, rules)
    kept = [c for c in versions.columns if c not in ("text", "blob", "spans")]
    paths = versions.select(*kept, address(F.col("text")).alias("blob"))
    joined = paths.join(findings(spark, ledger, rules), "blob", "left")
    return joined.withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>"))).drop("blob")


def as_text(spans: Column) -> Column:
    """kind:start:stop of the spans, joined by commas."""
    def one(span: Column) -> Column:
        return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["stop"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")
