"""Packing by power-of-two decomposition.

A document's token ids are cut into pieces of power-of-two lengths: as many of the
longest length as fit, then one piece for each binary digit of the rest.  Pieces of
one length form a bucket.  A piece is a sequence of its own, so no sequence holds two
documents and none needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import broadcast_if_small, tidy, written
from claimweave.llm.words import text_pieces, word_spans

MAX_LENGTH = 2048
END_ID = 1
#: Distinct words that a worker remembers; then it starts afresh.
KNOWN_WORDS = 1_000_000
#: Bytes of text that are looked up at once.
SLICE_BYTES = 1 << 18

#: Byte-level BPE writes a byte as the Latin-1 character if that is visible, else as the
#: next free character from U+0100.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_SIGNS = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in _VISIBLE)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of texts by a tokenizer whose tokens never cross white space, as word-level
    BPE: each distinct word is encoded once and then looked up.

    Words are split at ASCII white space, which is white space for the tokenizer too,
    so the ids of a text are the ids of its words in a row; a full stop or comma behind an
    ASCII letter or digit is a word of its own, as it is for the tokenizer.  Words are
    known by two 64-bit hashes of their bytes, A-Z as a-z, in arrays sorted by the first:
    about 40 bytes a word with its ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros((2, 0), np.uint64)  # both hashes of the words, by the first
        self.place = np.zeros(0, np.int64)  # of these words among the learned ones
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1, np.int64)  # of the word learned as number p: ends[p] to ends[p + 1]

    def _encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word.  Small Latin letters alone skip normalisation and
        pre-tokenisation, which don't change them."""
        found: dict[bytes, list[int]] = {}
        for word in words:
            letters = word.decode()
            if letters.isalpha() and letters.islower() and max(letters) < "\u0250":
                shown = letters if letters.isascii() else word.decode("latin-1").translate(BYTE_SIGNS)
                found[word] = [token.id for token in self.tokenizer.model.tokenize(shown)]
        rest = [word for word in words if word not in found]
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        found.update((word, r.ids) for word, r in zip(rest, encoded))
        return [found[word] for word in words]

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        """Words that aren't known yet, with their hashes, sorted by the first."""
        new = self._encode(words)
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        ends = self.ends[-1] + np.cumsum(lengths)
        while ends[-1] > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[self.ends[-1] : ends[-1]] = np.fromiter(chain.from_iterable(new), np.uint32, lengths.sum())
        at = np.searchsorted(self.known[0], hashes[0])
        self.known = np.insert(self.known, at, hashes, axis=1)
        self.place = np.insert(self.place, at, np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(new)))
        self.ends = np.append(self.ends, ends)

    def __call__(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text; texts are looked up together until they have
        ``SLICE_BYTES``, and a longer one in pieces of this size."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            raw = text.encode()
            # ids don't depend on the case of ASCII letters, but special tokens' names do
            if b"<|" in raw:
                yield from self._split(held)
                held, size = [], 0
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            elif len(raw) > SLICE_BYTES:
                yield from self._split(held)
                held, size = [], 0
                yield np.concatenate([self._ids(piece)[0] for piece in text_pieces(raw)])
            else:
                held.append(raw)
                size += len(raw)
                if size > SLICE_BYTES:
                    yield from self._split(held)
                    held, size = [], 0
        yield from self._split(held)

    def _split(self, held: list[bytes]) -> list[np.ndarray]:
        if not held:
            return []
        ids, starts, ends = self._ids(b"\n".join(held))
        words = np.searchsorted(starts, np.cumsum([len(raw) + 1 for raw in held])[:-1])
        return np.split(ids, np.append([0], ends)[words])

    def _ids(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words in a row, where the words start, and where their ids end."""
        hashes, starts, stops = word_spans(raw)
        if len(self.place) > KNOWN_WORDS:
            self._forget()
        first, where, which = np.unique(hashes[0], return_index=True, return_inverse=True)
        at = np.searchsorted(self.known[0], first)
        near = np.minimum(at, max(len(self.place) - 1, 0))
        hit = self.known[0][near] == first if len(self.place) else np.zeros(len(first), bool)
        if not hit.all():
            new = where[~hit]
            words = [raw[i:j].lower() for i, j in zip(starts[new].tolist(), stops[new].tolist())]
            self._learn(words, hashes[:, new])
            near = np.searchsorted(self.known[0], first)
        if (self.known[1][near][which] != hashes[1]).any():  # two words with one first hash
            found = self._encode([raw[i:j].lower() for i, j in zip(starts.tolist(), stops.tolist())])
            return np.fromiter(chain.from_iterable(found), np.uint32), starts, np.cumsum(list(map(len, found)))
        place = self.place[near][which] if len(first) else np.zeros(0, np.int64)
        begin = self.ends[place]
        lengths = self.ends[place + 1] - begin
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(begin - ends + lengths, lengths) + np.arange(total)], starts, ends


@cache
def tokenizer_of_worker(path: str) -> WordTokenizer:
    """A worker keeps what it has learned for its next tasks."""
    return WordTokenizer(path)


def piece_lengths(tokens: int, longest: int = MAX_LENGTH) -> list[int]:
    """Power-of-two lengths, not rising, that add up to ``tokens``."""
    digits = [1 << b for b in reversed(range(longest.bit_length() - 1)) if tokens >> b & 1]
    return [longest] * (tokens // longest) + digits


def pieces(docs: DataFrame, tokenizer: str, longest: int, with_ids: bool) -> DataFrame:
    """A row for each piece, with the task that made it and its place among that
    task's pieces of the same length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokenizer_of_worker(tokenizer), TaskContext.get().partitionId()
        made = [0] * longest.bit_length()
        for batch in batches:
            rows: list[tuple] = []
            held: list[np.ndarray] = []
            texts = (text.as_py() or "" for text in batch.column(1))
            for key, found in zip(batch.column(0).to_pylist(), encode(texts)):
                ids = np.append(found, END_ID).astype("<u4")
                start = 0
                for length in piece_lengths(len(ids), longest):
                    piece = ids[start : start + length]
                    bucket = length.bit_length() - 1
                    rows.append((key, start, length, zlib.crc32(piece.tobytes()), len(ids), bucket, part, made[bucket]))
                    made[bucket] += 1
                    start += length
                if with_ids:
                    held.append(ids)
                if len(rows) > 20_000 or sum(map(len, held)) > 1_000_000:
                    yield as_batch(rows, held)
                    rows, held = [], []
            yield as_batch(rows, held)

    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64()), ("_bucket", pa.int32()), ("_part", pa.int32()), ("_nth", pa.int64())]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, _bucket int, _part int, _nth long"

    def as_batch(rows: list[tuple], held: list[np.ndarray]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(fields)
        arrays = [pa.array(values, kind) for values, (_, kind) in zip(columns, fields)]
        names = [name for name, _ in fields]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(columns[2], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate(held).astype(np.int32) if held else np.zeros(0, np.int32)
            arrays.append(pa.ListArray.from_arrays(ends, flat))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    if with_ids:
        schema += ", ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(tidy(cut), schema)


def pack(
    docs: DataFrame, tokenizer: str | None = None, longest: int = MAX_LENGTH, with_ids: bool = False
) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset (always 0) and, if asked for, ids.

    A document's ids end with ``END_ID``; a NULL or empty text has that id alone.
    Each row of ``docs`` is a document of its own, also with a repeated or NULL doc_id.
    Sequences are numbered from 0 without gaps, bucket by bucket from the longest; so a
    run of ids is a batch of equal lengths.  The pieces are written once, and numbers
    follow from how many pieces of a length each task wrote.  Other columns are left out.
    """
    made = written(pieces(docs, tokenizer or default_tokenizer(), longest, with_ids), "pieces")
    counts = made.groupBy("_bucket", "_part").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy("_bucket").agg(F.sum("_n").alias("_all"))
    # 12 rows for pieces of up to 2048
    longer = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_bucket", F.coalesce(F.sum("_all").over(longer), F.lit(0)).alias("_earlier"))
    tasks = Window.partitionBy("_bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(tasks), F.lit(0)))
    starts = starts.join(F.broadcast(totals), "_bucket").select(
        "_bucket", "_part", (F.col("_earlier") + F.col("_before")).alias("_first")
    )
    return made.join(broadcast_if_small(written(starts, "piece-numbers")), ["_bucket", "_part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_first") + F.col("_nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
