"""Personal data by rules and by a linear-chain conditional random field.

The rules find what has a fixed form.  The field labels words by their shapes and
those of their neighbours; it is trained on a small table of passages of the corpus,
labelled by the rules, and adds spans where no rule found one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.common import hash32, slices, tidy, unit

KINDS = ("email", "ip", "card", "phone")
#: Documents to take passages from, drawn by a hash of doc_id, and passages to learn from.
SAMPLE_DOCUMENTS, SAMPLE_PASSAGES = 20_000, 3_000
#: Probability that the field must give to every word of a span.
SURE = 0.9

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that can't begin an address can't begin one further on either
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile("[^0-9]+")


class Span(NamedTuple):
    start: int
    order: int  # of the kind
    stop: int


# ----------------------------------------------------------------------- rules


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the run of its characters before the sign, so one look back
    from each sign finds what a search from the left finds."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def rule_spans(text: str) -> list[Span]:
    """Spans of the rules by start, then kind; matches that fail a rule's test are
    dropped and not tried again."""
    found = [Span(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m[0].split("."))):
            found.append(Span(m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(Span(m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGITS.sub("", m[0])) <= 15:
                found.append(Span(m.start(), 3, m.end()))
    return sorted(found)


# -------------------------------------------------------------- words, features

#: Only words with a digit or an at sign can be personal data to the field; all others
#: are labelled as outside, so a passage of such words is decoded on its own.
TRIGGER = re.compile("[0-9@]")
SPACE = re.compile(r"\s")
RUNS = re.compile(r"(.)\1+")
LABELS = ["O", *(f"{place}-{kind}" for kind in KINDS for place in "BI")]
EDGE = "\"'`<>[]{},;:!?.*_"

Passage = list[tuple[int, int]]


def passages(text: str) -> list[Passage]:
    """Runs of neighbouring words that have a digit or an at sign, as positions."""
    found: list[Passage] = []
    end = 0
    hit = TRIGGER.search(text)
    while hit:
        start = hit.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        space = SPACE.search(text, hit.end())
        stop = space.start() if space else len(text)
        if found and not text[end:start].strip():
            found[-1].append((start, stop))
        else:
            found.append([(start, stop)])
        end = stop
        hit = TRIGGER.search(text, stop)
    return found


def shape(word: str) -> str:
    """The word with letters and digits as classes and runs cut to three."""
    word = word[:64]
    signs = "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in word)
    return RUNS.sub(lambda m: m[1] * min(len(m[0]), 3), signs)


def features(words: list[str]) -> list[list[str]]:
    """For each word of a passage the names of its features."""
    bare = [w.strip(EDGE) for w in words]
    shapes = ["", *map(shape, bare), ""]
    digits = [sum(c.isdigit() for c in w) for w in bare]
    total = min(sum(digits), 24)
    rows = []
    for i, word in enumerate(bare):
        own = shapes[i + 1]
        rows.append([
            f"s={own}", f"c={RUNS.sub(lambda m: m[1], own)}", f"p={shapes[i]}", f"n={shapes[i + 2]}", f"ps={shapes[i]}|{own}",
            f"d={min(digits[i], 20)}", f"D={total}", f"at={'@' in word}", f"plus={word[:1] == '+'}",
            f"ip={bool(IP.fullmatch(word))}{word.count('.')}", f"len={min(len(word), 24) // 3}",
            f"luhn={14 <= digits[i] <= 19 and luhn(NOT_DIGITS.sub('', word))}" if word.isascii() else "luhn=False",
        ])
    return rows


def labels_of(passage: Passage, spans: list[Span]) -> list[int]:
    """Places in ``LABELS``: words that overlap a span begin or continue its kind."""
    out, last = [], None
    for start, stop in passage:
        span = next((s for s in spans if s.start < stop and start < s.stop), None)
        out.append(0 if span is None else 1 + 2 * span.order + (span == last))
        last = span
    return out


# ---------------------------------------------------------------- random field


class Field(NamedTuple):
    names: dict[str, int]
    weights: np.ndarray  # feature x label, with a row of zeros at the end
    steps: np.ndarray  # label before x label, with a row and a column for the edges

    def scores(self, rows: list[list[list[str]]]) -> np.ndarray:
        """Label scores of passages of one length: passage x word x label."""
        none = len(self.names)
        ids = np.array([[[self.names.get(f, none) for f in word] for word in row] for row in rows])
        return self.weights[ids].sum(2)


def _sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(unary: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels, and expected steps summed over words and passages, by
    the forward-backward algorithm."""
    inner, n = steps[:-1, :-1], unary.shape[1]
    ahead, behind = np.empty_like(unary), np.empty_like(unary)
    ahead[:, 0] = unary[:, 0] + steps[-1, :-1]
    for t in range(1, n):
        ahead[:, t] = unary[:, t] + _sum(ahead[:, t - 1, :, None] + inner, 1)
    behind[:, -1] = steps[:-1, -1]
    for t in range(n - 2, -1, -1):
        behind[:, t] = _sum(inner + (unary[:, t + 1] + behind[:, t + 1])[:, None], 2)
    total = _sum(ahead[:, -1] + behind[:, -1], 1)
    single = np.exp(ahead + behind - total[:, None, None])
    expected = np.zeros_like(steps)
    for t in range(1, n):
        pair = ahead[:, t - 1, :, None] + inner + (unary[:, t] + behind[:, t])[:, None] - total[:, None, None]
        expected[:-1, :-1] += np.exp(pair).sum(0)
    expected[-1, :-1], expected[:-1, -1] = single[:, 0].sum(0), single[:, -1].sum(0)
    return single, expected


def viterbi(unary: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The best labels of passages of one length."""
    best, back = unary[:, 0] + steps[-1, :-1], []
    for t in range(1, unary.shape[1]):
        options = best[:, :, None] + steps[:-1, :-1]
        back.append(options.argmax(1))
        best = options.max(1) + unary[:, t]
    path = [(best + steps[:-1, -1]).argmax(1)]
    for pointers in reversed(back):
        path.append(pointers[np.arange(len(pointers)), path[-1]])
    return np.stack(path[::-1], 1)


def train(table: list[tuple[list[str], list[int]]], rounds: int = 80, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """The field of most likely labels for rows of words and label places, by adaptive
    gradient steps on whole batches of passages of one length."""
    rows = [(features(words), labels) for words, labels in table]
    names = {f: i for i, f in enumerate(sorted({f for row, _ in rows for word in row for f in word}))}
    n = len(LABELS)
    field = Field(names, np.zeros((len(names) + 1, n)), np.zeros((n + 1, n + 1)))
    batches = []
    for length in sorted({len(labels) for _, labels in rows}):
        own = [(row, labels) for row, labels in rows if len(labels) == length]
        ids = np.array([[[names[f] for f in word] for word in row] for row, _ in own])
        batches.append((ids, np.array([labels for _, labels in own])))
    seen = [np.full_like(field.weights, 1e-6), np.full_like(field.steps, 1e-6)]
    for _ in range(rounds):
        slope, turn = -decay * field.weights * len(rows), -decay * field.steps * len(rows)
        for ids, gold in batches:
            single, expected = marginals(field.weights[ids].sum(2), field.steps)
            gap = np.eye(n)[gold] - single
            np.add.at(slope, ids.reshape(-1, ids.shape[2]), gap.reshape(-1, 1, n))
            edge = np.full((len(gold), 1), n)
            path = np.concatenate([edge, gold, edge], 1)
            np.add.at(turn, (path[:, :-1].ravel(), path[:, 1:].ravel()), 1)
            turn -= expected
        for value, change, past in zip((field.weights, field.steps), (slope, turn), seen):
            past += change * change
            value += rate * change / np.sqrt(past)
    field.weights[-1] = 0
    return field


def field_spans(field: Field, texts: list[str], rules: list[list[Span]]) -> list[list[Span]]:
    """Spans that the field adds: surely labelled, and apart from the rules' spans."""
    added: list[list[Span]] = [[] for _ in texts]
    by_length: dict[int, list[tuple[int, Passage]]] = {}
    for i, text in enumerate(texts):
        for passage in passages(text):
            by_length.setdefault(len(passage), []).append((i, passage))
    for group in by_length.values():
        for first in range(0, len(group), 4096):
            part = group[first : first + 4096]
            unary = field.scores([features([texts[i][a:b] for a, b in p]) for i, p in part])
            paths, (sure, _) = viterbi(unary, field.steps), marginals(unary, field.steps)
            for row in np.flatnonzero(paths.any(1)):
                i, passage = part[row]
                added[i] += _read(texts[i], passage, paths[row], sure[row], rules[i])
    return [sorted(spans) for spans in added]


def _read(text: str, passage: Passage, path: np.ndarray, sure: np.ndarray, rules: list[Span]) -> Iterator[Span]:
    at = 0
    while at < len(path):
        label, first = int(path[at]), at
        at += 1
        if not label:
            continue
        order = (label - 1) // 2
        while at < len(path) and path[at] == 2 + 2 * order:
            at += 1
        if min(sure[t, path[t]] for t in range(first, at)) < SURE:
            continue
        start, stop = passage[first][0], passage[at - 1][1]
        inner = text[start:stop]
        start += len(inner) - len(inner.lstrip(EDGE))
        stop -= len(inner) - len(inner.rstrip(EDGE))
        if start < stop and not any(s.start < stop and start < s.stop for s in rules):
            yield Span(start, order, stop)


# ----------------------------------------------------------------------- Spark


def labelled_passages(docs: DataFrame) -> DataFrame:
    """words and labels of passages from a bounded sample of ``docs`` (doc_id, text),
    labelled by the rules."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, labels = [], []
            for text in batch.column(0).to_pylist():
                spans = rule_spans(text)
                for passage in passages(text):
                    for first in range(0, len(passage), 16):
                        part = passage[first : first + 16]
                        words.append([text[a:b] for a, b in part])
                        labels.append(labels_of(part, spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.int64()))], ["words", "labels"]
            )

    total = docs.count()
    drawn = docs.where(unit(F.lit("pii"), F.col("doc_id")) < SAMPLE_DOCUMENTS / max(total, 1))
    made = drawn.where("text IS NOT NULL AND text RLIKE '[0-9@]'").select("text").mapInArrow(
        tidy(label), "words array<string>, labels array<long>"
    )
    order = hash32(F.concat_ws(" ", "words"))
    return made.distinct().orderBy(order, "words", "labels").limit(SAMPLE_PASSAGES)


def fitted(docs: DataFrame) -> Field | None:
    """The field for ``docs``; None if the rules find nothing to learn from."""
    rows = [(r["words"], r["labels"]) for r in labelled_passages(docs).collect()]
    return train(rows) if any(any(labels) for _, labels in rows) else None


def _each_text(docs: DataFrame, field: Field | None, work, fields: T.StructType, keep_text: bool) -> DataFrame:
    """``docs``' columns and what ``work`` makes of each batch's texts and spans."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = [c for c in docs.columns if c != "text"]
    place, out = docs.columns.index("text"), [c for c in docs.columns if keep_text or c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            given = batch.column(1).to_pylist()
            texts = [text or "" for text in given]
            rules = [rule_spans(text) for text in texts]
            added = field_spans(shared.value, texts, rules) if shared.value else [[] for _ in texts]
            columns = batch.column(0).flatten()
            made = work(given, rules, added)
            if keep_text:
                columns.insert(place, made)
                yield pa.RecordBatch.from_arrays(columns, out)
            else:
                yield pa.RecordBatch.from_arrays([*columns, made], [*out, "pii"])

    rows = docs.select(F.struct(*names).alias("kept"), "text")
    return rows.mapInArrow(tidy(run), fields)


_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("stop", pa.int32()), ("base", pa.bool_())]))


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """``docs`` without text, but with ``pii``: the spans of rules (base) and field by
    start, then kind, in code points, ``stop`` exclusive.

    The whole text is read; a NULL text counts as empty and has no spans.  Rows with
    equal texts get equal spans.  A column ``pii`` of ``docs`` is left out."""

    def spans(texts, rules, added) -> pa.Array:
        rows = [sorted([(*s, True) for s in r] + [(*s, False) for s in a]) for r, a in zip(rules, added)]
        return pa.array(
            [[{"start": a, "kind": KINDS[k], "stop": b, "base": base} for a, k, b, base in row] for row in rows], _ARROW
        )

    docs = docs.drop("pii")
    fields = T.StructType([f for f in docs.schema if f.name != "text"]).add("pii", SPANS_TYPE)
    return _each_text(docs, field, spans, fields, keep_text=False)


SPANS_TYPE = T.ArrayType(
    T.StructType().add("start", "integer").add("kind", "string").add("stop", "integer").add("base", "boolean")
)


def redact(docs: DataFrame, field: Field | None) -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in brackets; of spans
    that overlap, the first covers all.  A NULL text stays NULL."""

    def replaced(texts, rules, added) -> pa.Array:
        return pa.array([None if t is None else mask(t, sorted(r + a)) for t, r, a in zip(texts, rules, added)], pa.string())

    return _each_text(docs, field, replaced, docs.schema, keep_text=True)


def mask(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for start, order, stop in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[order].upper()}]"]
        at = max(at, stop)
    return "".join(parts) + text[at:] if parts else text
