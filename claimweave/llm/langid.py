"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.common import slices as batch_slices
from claimweave.llm.common import tidy, written
from claimweave.llm.order import in_order, with_places

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Languages whose counts a task holds at once.
HELD_LANGUAGES = 64
#: A language with fewer held-out labelled parts of a length has no bound there.
LEAST_FIT = 20
#: Code points of the parts of texts that bounds are taken for.
FIT_LENGTHS = (8, 16, 32, 64, 128, 256, 512, 1024)
#: A bound is so many times as far below the median as the hundredth part is, which is
#: counted as so far at least.
FIT_REACH, FIT_SPREAD = 2.5, 0.2
#: Code points that are hashed at once.
SLICE = 1 << 18
UNDETERMINED = "und"
#: Numbers, addresses and codes, which are of no language.
NO_WORD = re.compile(r"\S*[\d@]\S*")


class Model(NamedTuple):
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # bucket x language, with a row of zeros at the end


def slices(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of the lower-cased texts and the text that each belongs to, some
    texts or a part of a long text at a time.  A part begins with the last code points
    of the one before, which are marked as no text's (-1)."""
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = 0
    overlap = max(ORDERS) - 1
    for i, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        for first in range(0, len(codes), SLICE):
            lead = min(first, overlap)
            held.append(codes[first - lead : first + SLICE])
            owners.append(np.repeat([-1, i], [lead, len(held[-1]) - lead]))
            size += len(held[-1])
            if size >= SLICE:
                yield np.concatenate(held), np.concatenate(owners)
                held, owners, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owners)


def grams(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the bucket of the n-gram that ends at a code point, and the text;
    n-grams that reach over two texts are left out."""
    reach = np.where(owner < 0, np.roll(owner, -1), owner)
    reach = np.where(reach < 0, np.roll(reach, -1), reach)
    hashed = np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        kept = len(codes) - order + 1
        if kept <= 0:
            return
        hashed = hashed[:kept] * np.uint64(0x9E3779B97F4A7C15) + codes[order - 1 :] + np.uint64(order)
        if order in ORDERS:
            inside = (reach[:kept] == reach[order - 1 :]) & (owner[order - 1 :] >= 0)
            mixed = hashed ^ (hashed >> np.uint64(29))
            mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
            yield mixed[inside].astype(np.int64), owner[order - 1 :][inside]


def train(labelled: DataFrame) -> Model:
    """A model from ``text`` and ``lang``; rows where either is NULL are passed over.

    Counts of buckets are summed up in Spark; what comes to the driver is a row for
    each language and used bucket.  Raises ``ValueError`` without a labelled text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def summed() -> pa.RecordBatch:
            used = [np.flatnonzero(counts) for counts in held.values()]
            lang = np.repeat(np.arange(len(held)), [len(buckets) for buckets in used])
            bucket, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if held:
                bucket = np.concatenate(used)
                n = np.concatenate([counts[buckets] for counts, buckets in zip(held.values(), used)])
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()).take(pa.array(lang, pa.int64())), pa.array(bucket), pa.array(n)], ["lang", "bucket", "n"]
            )

        for batch in batch_slices(batches):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            known = sorted(set(langs))
            place = np.array([known.index(lang) for lang in langs], np.int64)
            counts = np.zeros(len(known) * BUCKETS, np.int64)
            for codes, owner in slices(texts):
                for bucket, text in grams(codes, owner):
                    counts += np.bincount(place[text] * BUCKETS + bucket, minlength=len(counts))
            for lang, own in zip(known, counts.reshape(-1, BUCKETS)):
                held[lang] = held[lang] + own if lang in held else own.copy()
            if len(held) > HELD_LANGUAGES:
                yield summed()
                held.clear()
        yield summed()

    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = rows.mapInArrow(tidy(count), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    documents = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not documents:
        raise ValueError("no labelled text to learn a language from")
    languages = sorted(documents)
    counts = np.zeros((BUCKETS, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    counts[found["bucket"].to_numpy(), [place[x] for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    smoothed = counts + SMOOTHING
    table = np.vstack([np.log(smoothed / smoothed.sum(0)), np.zeros(len(languages))])
    prior = np.array([documents[lang] for lang in languages], float)
    return Model(languages, np.log(prior / prior.sum()), table.astype(np.float32))


def totals(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each text in each language, without the prior, and the number
    of its n-grams."""
    total, n = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    for codes, owner in slices(texts):
        for bucket, text in grams(codes, owner):
            if len(bucket):
                # texts rise, so each is a run of rows of the sparse batch
                starts = np.flatnonzero(np.diff(text, prepend=-2))
                total[text[starts]] += np.add.reduceat(model.log_probability[bucket], starts, dtype=np.float64)
                n += np.bincount(text, minlength=len(texts))
    return total, n


def scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The most probable language of each text, its posterior probability, the text's mean
    log-probability for each n-gram in that language, and the number of n-grams."""
    total, n = totals(model, texts)
    posterior = total + model.log_prior
    best = posterior.argmax(1) if len(texts) else np.zeros(0, int)
    every = np.arange(len(texts))
    fit = total[every, best] / np.maximum(n, 1)
    return best, 1 / np.exp(posterior - posterior[every, best][:, None]).sum(1), fit, n


def fit_bounds(docs: DataFrame, model: Model) -> np.ndarray:
    """For each length of FIT_LENGTHS and each language of the model, the mean
    log-probability for an n-gram below which a text of that length or more isn't of the
    language.  It is taken from all labelled documents that the model hasn't learned from;
    their quantiles are exact, found by the places of the sorted values."""
    known = docs.where(is_held_out()).where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batch_slices(batches):
            place = [model.languages.index(x) if x in model.languages else -1 for x in batch.column(0).to_pylist()]
            texts = batch.column(1).to_pylist()
            for i, length in enumerate(FIT_LENGTHS):
                # the beginning and the middle; a shorter text is measured as it is
                parts, own = [], []
                for at, text in zip(place, texts):
                    if at >= 0:
                        parts += [text[:length], text[len(text) // 2 :][:length]] if len(text) > length else [text]
                        own += [at] * (len(parts) - len(own))
                total, n = totals(model, parts)
                own = np.array(own, np.int64)
                fit = total[np.arange(len(parts)), own] / np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([pa.array(i * len(model.languages) + own), pa.array(fit)], ["cell", "fit"])

    found = written(known.select("lang", "text").mapInArrow(tidy(measure), "cell long, fit double"), "language-fits")
    placed = with_places(in_order(found, ["cell", "fit"], "language-fits-in-order"), "cell").where(F.col("total") >= LEAST_FIT)
    # the two values that each quantile lies between, for each length and language
    at = {name: F.lit(share) * (F.col("total") - 1) for name, share in (("low", 0.01), ("middle", 0.5))}
    near = [F.col("position").isin(F.floor(x), F.ceil(x)) for x in at.values()]
    cells: dict[int, dict[str, float]] = {}
    for row in placed.where(near[0] | near[1]).select("cell", "position", "fit", *[x.alias(name) for name, x in at.items()]).collect():
        for name in at:
            weight = 1 - abs(row.position - row[name])
            if weight > 0:
                cell = cells.setdefault(row.cell, dict.fromkeys(at, 0.0))
                cell[name] += weight * row.fit
    bounds = np.full((len(FIT_LENGTHS), len(model.languages)), -np.inf)
    for cell, value in cells.items():
        spread = max(value["middle"] - value["low"], FIT_SPREAD)
        bounds[divmod(cell, len(model.languages))] = value["middle"] - FIT_REACH * spread
    return bounds


def fits(
    model: Model, bounds: np.ndarray, texts: list[str], best: np.ndarray, fit: np.ndarray, n: np.ndarray
) -> np.ndarray:
    """True for texts that fit the language ``best``, whole or by their words without a
    digit or sign of addresses."""

    def within(fit: np.ndarray, n: np.ndarray, lang: np.ndarray) -> np.ndarray:
        # a text of three code points or more has 3 n-grams for each but 3
        longest = np.searchsorted(np.array(FIT_LENGTHS), n // 3 + 1, side="right") - 1
        return (longest < 0) | (fit >= bounds[longest, lang])

    found = within(fit, n, best)
    rest = np.flatnonzero(~found)
    if len(rest):
        total, n = totals(model, [" ".join(NO_WORD.sub(" ", texts[i]).split()) for i in rest])
        found[rest] = within(total[np.arange(len(rest)), best[rest]] / np.maximum(n, 1), n, best[rest])
    return found


def is_held_out() -> Column:
    """Documents whose language is never learned from; a row without a doc_id isn't one."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang) to learn from: all labelled ones but the
    held-out."""
    return docs.where(~is_held_out()).where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")


def identify(docs: DataFrame, model: Model | None, bounds: np.ndarray | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``, columns that it must not have.

    The prediction reads the whole text and nothing else.  A NULL text, an empty one and
    one without a letter get ``und`` and 0, as does every text without a model, and with
    ``bounds`` (see ``fit_bounds``) one that fits none of the languages.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "lang_score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != "text"]
    kept = docs.select(F.struct(*names).alias("kept"), "text", letters.alias("letters"))
    place, out = docs.columns.index("text"), [*docs.columns, "lang_pred", "lang_score"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batch_slices(batches):
            known = batch.column(2).to_numpy(zero_copy_only=False)
            texts = [t if k else "" for t, k in zip(batch.column(1).to_pylist(), known)]
            best, score, fit, n = scores(model, texts)
            if bounds is not None:
                known = known & fits(model, bounds, texts, best, fit, n)
            langs = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
            columns = batch.column(0).flatten()
            columns.insert(place, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs, pa.string()), pa.array(np.where(known, score, 0.0))],
                out,
            )

    fields = T.StructType(list(docs.schema)).add("lang_pred", "string").add("lang_score", "double")
    return kept.mapInArrow(tidy(predict), fields)


def fitted(docs: DataFrame) -> Model | None:
    """The model of all labelled rows of ``docs`` that aren't held out; None without one."""
    rows = training_rows(docs)
    return train(rows) if rows.limit(1).count() else None
