"""From raw documents to packed sequences; each stage reads what the last one wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.llm import jaccard, langid, mixing, packing, pii
from claimweave.llm.common import broadcast_if_small, remove, shared_folder, small_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A prediction less probable than this isn't one of the languages that are known.
LEAST_SCORE = 0.5


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: those without a letter go, and those
    that fit no known language, by bounds from labelled documents.  Where no document has
    a label, only the former go; a text of less than eight code points, or one in a
    language with few labelled documents, isn't held to a bound."""
    small_batches(spark)
    model = langid.fitted(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, model, langid.fit_bounds(docs, model))
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("lang_score") >= LEAST_SCORE)
    return found.where(known).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id.  Of rows
    that repeat a doc_id with an equal set one stays, the first by its columns; other
    texts of that doc_id are documents of their own.  Rows without a doc_id can't be told
    apart and stay."""
    small_batches(spark)
    parts = written(jaccard.leaders(docs).where("doc_id IS NOT NULL"), "leaders")
    by_id = parts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"), F.max("leads").alias("_leads"))
    others = by_id.where("_rows > 1 OR NOT _leads").select("doc_id")
    kept = docs.join(broadcast_if_small(written(others, "near-copies")), "doc_id", "left_anti").select(*docs.columns)
    repeated = written(by_id.where("_rows > 1").select("doc_id"), "repeated")
    if repeated.limit(1).count():
        leading = parts.where("leads").join(repeated, "doc_id", "left_semi").select("doc_id", "key").distinct()
        again = jaccard.with_key(docs.join(broadcast_if_small(repeated), "doc_id", "left_semi").select(*docs.columns))
        own = again.select("kept", "key", F.col("kept.doc_id").alias("doc_id")).join(leading, ["doc_id", "key"], "left_semi")
        first = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("kept"))
        again = own.withColumn("_nth", first).where("_nth = 1").select("kept.*")
        kept = kept.union(again.select(*docs.columns))
    return kept


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    small_batches(spark)
    return pii.redact(docs, pii.fitted(docs.select("doc_id", "text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.emit(mixing.mix(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids of power-of-two lengths."""
    small_batches(spark)
    return packing.pack(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", keep_languages),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: The language model, the random field and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        made, folder = stage(spark, docs, sf_dir), shared_folder(spark, name.replace(" ", "-"))
        made.write.parquet(folder)
        docs = spark.read.schema(made.schema).parquet(folder)
        if before:  # nothing reads it any more
            remove(spark, before)
        before = folder
    return docs
