"""Byte-level BPE by recursive DuckDB queries inside the tasks.

A task cuts its texts into words by the tokenizer's pattern and encodes the distinct
ones as tables: a row for each token of each word, joined with the table of merges.
The recursion contracts each word's leftmost pair of least rank until none is left.
Decoding joins ids with the vocabulary and puts the bytes together by an ordered
aggregation.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

#: Distinct words, and words with what clings to them, that a worker remembers, about 200
#: bytes each; then it starts afresh, so frequent words come back at once.
KEPT_WORDS = 600_000
#: Bytes of texts and words looked up at once, ids decoded at once, tokens of one query.
SLICE_BYTES, SLICE_WORDS, DECODED_IDS, QUERY_TOKENS = 1 << 21, 1 << 18, 1 << 18, 1 << 19
#: Ids of a group of the aggregation that decodes, as a power of two.
DECODED_BITS = 16
#: Longer words are encoded up to one rank after the other, each time cut where no token
#: of a lower rank can come to lie across; pieces that are longer still contract all
#: pairs of one rank at a time.
LONG_BYTES = 64
RANK_STEPS = (1 << 9, 1 << 10, 1 << 11, 1 << 12, 1 << 13, 1 << 14, 1 << 15, 1 << 31)
#: The words of longer texts are searched one after the other.
LONG_TEXT = 1 << 20
#: No word lies across a place before a space without other white space beside it.
CHUNK = re.compile(r"(?<=\S)(?= \S)")
_WHITE = r"[\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
BESIDE_SPACE = f"{_WHITE} | {_WHITE}"
#: Bytes of results that are handed on at once.
BATCH_BYTES = 1 << 24

#: Each step takes one pair of each word: the least of merged id, then position.  A row
#: holds its token, where the token ends and the token that follows.
LEFTMOST = """
WITH RECURSIVE state(word, pos, stop, token, following, step) AS (
  SELECT word, pos, stop, token, following, 0 FROM start
  UNION ALL
  SELECT s.word, s.pos,
    CASE WHEN s.pos = p.pos THEN q.stop ELSE s.stop END,
    CASE WHEN s.pos = p.pos THEN p.merged ELSE s.token END,
    CASE WHEN s.pos = p.pos THEN q.following WHEN s.stop = p.pos THEN p.merged ELSE s.following END,
    s.step + 1
  FROM state s
  JOIN (
    SELECT word, (least >> 40)::INT AS merged, ((least >> 8) & 4294967295)::INT AS pos,
      ((least >> 8) & 4294967295)::INT + (least & 255)::INT AS second
    FROM (
      SELECT s.word, min((m.merged::BIGINT << 40) | (s.pos::BIGINT << 8) | m.first_size) AS least
      FROM state s JOIN merges m ON m.first = s.token AND m.second = s.following AND m.merged < $below
      GROUP BY s.word
    )
  ) p ON p.word = s.word
  JOIN state q ON q.word = p.word AND q.pos = p.second
  WHERE s.pos <> p.second
)
SELECT word, token FROM state
JOIN (SELECT word, max(step) AS step FROM state WHERE pos = 0 GROUP BY word) USING (word, step)
ORDER BY word, pos
"""

#: Each step takes all pairs of each word's least rank, every other one where they
#: overlap; only the leftmost if a token that holds the merged one has a lower rank, as
#: that may have to come in between.
EVERY = """
WITH RECURSIVE state(word, pos, token) USING KEY (word, pos) AS (
  SELECT word, pos, token FROM start
  UNION
  SELECT word, pos, CASE WHEN gone THEN -1 ELSE best END FROM (
    SELECT *, lag(chosen, 1, FALSE) OVER (PARTITION BY word ORDER BY pos) AS gone FROM (
      SELECT *, coalesce(merged = best AND (n - miss) % 2 = 1 AND (alone OR n = first_hit), FALSE) AS chosen FROM (
        SELECT *, coalesce(max(CASE WHEN merged = best THEN NULL ELSE n END)
            OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS miss,
          min(CASE WHEN merged = best THEN n END) OVER (PARTITION BY word) AS first_hit
        FROM (
          SELECT s.*, m.merged, m.alone, min(m.merged) OVER (PARTITION BY word) AS best
          FROM (
            SELECT word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS following,
              row_number() OVER (PARTITION BY word ORDER BY pos) AS n
            FROM recurring.state WHERE token >= 0
          ) s LEFT JOIN merges m ON m.first = s.token AND m.second = s.following AND m.merged < $below
        ) WHERE best IS NOT NULL
      )
    )
  ) WHERE gone OR chosen
)
SELECT word, token FROM state WHERE token >= 0 ORDER BY word, pos
"""

DECODE = "SELECT part, list(bytes ORDER BY pos) AS bytes FROM sequence JOIN vocabulary USING (id) GROUP BY part ORDER BY part"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def newer_signs() -> frozenset[str]:
    """Letters and digits for the module that cuts texts that aren't so for the
    library whose ids are wanted, as it knows an older Unicode; found by asking both."""
    import regex
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    found: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        bytes_ = {bytes([b]): b for b in range(256)}
        other = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=bytes_, special_tokens={})
        found |= {*regex.findall(kind, every)} - {*other.decode(other.encode_ordinary(every))}
    return frozenset(found)


class Codec:
    """Ids of texts and bytes of ids, by a file of base64 tokens and their ranks."""

    def __init__(self, path: str):
        import duckdb
        import public_tokenizers
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.starts = {token[:i] for token in self.ranks for i in range(1, len(token) + 1)}
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        self.sizes = np.zeros(max(self.bytes, default=0) + 1, np.int64)
        self.sizes[list(self.bytes)] = [len(token) for token in self.bytes.values()]
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        self._create_tables()
        self._forget()

    def _create_tables(self) -> None:
        """``merges``: every cut of a token into two tokens; ``alone`` if no token of a
        lower rank begins or ends with the merged one."""
        merges, together = [], set()
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                first, second = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if first is not None and second is not None:
                    merges.append((first, second, rank, i))
                together.update(part for part in (first, second) if part is not None and part > rank)
        columns = [pa.array(column, pa.int32()) for column in zip(*merges)] or [pa.array([], pa.int32())] * 4
        rows = pa.table(columns, ["first", "second", "merged", "first_size"])
        rows = rows.append_column("alone", pa.array([m not in together for m in rows["merged"].to_pylist()], pa.bool_()))
        words = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "bytes": pa.array(self.ranks, pa.binary())})
        for name, table in (("merges", rows), ("vocabulary", words)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)

    # -------------------------------------------------------------- words to ids

    def words_of(self, text: str, newer: bool) -> Sequence[str] | Iterator[str]:
        """The matches of the pattern; one after the other from a long text.  Letters alone, or
        with full stops and commas behind, need no search."""
        stem = text.rstrip(".,")
        if (stem[1:] if stem[:1] == " " else stem).isalpha():
            return [stem, text[len(stem) :]] if len(stem) < len(text) else [text]
        if newer and not newer_signs().isdisjoint(text):
            shown = "".join("\ue000" if sign in newer_signs() else sign for sign in text)
            found = (text[m.start() : m.end()] for m in self.pattern.finditer(shown))
            return found if len(text) > LONG_TEXT else list(found)
        if len(text) > LONG_TEXT:
            return (m[0] for m in self.pattern.finditer(text))
        return self.pattern.findall(text)

    def _cut(self, tokens: tuple[int, ...], below: int) -> list[tuple[int, ...]]:
        """The tokens, cut where no run of them makes a token of a rank below the given one."""
        pieces, last, reach = [], 0, 0
        for at in range(len(tokens)):
            if at and at >= reach:
                pieces.append(tokens[last:at])
                last = at
            run, stop = self.bytes[tokens[at]], at + 1
            while stop < len(tokens):
                run += self.bytes[tokens[stop]]
                stop += 1
                if self.ranks.get(run, below) < below:
                    reach = max(reach, stop)
                elif run not in self.starts:
                    break
        return [*pieces, tokens[last:]]

    def _contracted(self, pieces: Iterable[tuple[int, ...]], below: int) -> dict[tuple[int, ...], list[int]]:
        """The ids that the tokens of each piece are merged to by ranks below the given one."""
        found: dict[tuple[int, ...], list[int]] = {}
        sizes = {piece: int(self.sizes[list(piece)].sum()) for piece in pieces}
        short = [piece for piece, size in sizes.items() if size <= LONG_BYTES]
        long = [piece for piece, size in sizes.items() if size > LONG_BYTES]
        for how, group in ((LEFTMOST, short), (EVERY, long)):
            for some in _groups(group, QUERY_TOKENS):
                tokens = np.fromiter(chain.from_iterable(some), np.int32)
                ids, ends = self._queried(tokens, list(map(len, some)), how, below)
                found.update((piece, part.tolist()) for piece, part in zip(some, np.split(ids, ends[:-1])))
        return found

    def _queried(self, tokens: np.ndarray, counts: list[int], how: str, below: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that have so many of the tokens each, and where each word's end."""
        counts = np.array(counts, np.int64)
        first = np.cumsum(counts) - counts
        ends = np.cumsum(self.sizes[tokens])
        before = np.repeat((ends - self.sizes[tokens])[first], counts)
        following = np.append(tokens[1:], -1).astype(np.int32)
        following[first + counts - 1] = -1
        columns = {
            "word": np.repeat(np.arange(len(counts), dtype=np.int32), counts), "token": tokens, "following": following,
            "pos": (ends - self.sizes[tokens] - before).astype(np.int32), "stop": (ends - before).astype(np.int32),
        }
        self.db.register("start", pa.table(columns))
        found = self.db.sql(how, params={"below": below}).to_arrow_table()
        self.db.unregister("start")
        word, ids = (found.column(name).to_numpy() for name in ("word", "token"))
        return ids, np.searchsorted(word, np.arange(len(counts)), "right")

    def _learn_words(self, words: list[str]) -> None:
        """The ids of each word: its own id, or the merges of its bytes."""
        raw = [word.encode() for word in words]
        own = [i for i, w in enumerate(raw) if w in self.ranks]
        self._add([words[i] for i in own], np.array([self.ranks[raw[i]] for i in own], np.int32), np.arange(1, len(own) + 1))
        for some in _groups(((i, w) for i, w in enumerate(raw) if w not in self.ranks and len(w) <= LONG_BYTES), QUERY_TOKENS, 1):
            tokens = self.single[np.frombuffer(b"".join(w for _, w in some), np.uint8)]
            found = self._queried(tokens, [len(w) for _, w in some], LEFTMOST, RANK_STEPS[-1])
            self._add([words[i] for i, _ in some], *found)
        for word, w in zip(words, raw):
            if len(w) > LONG_BYTES and w not in self.ranks:
                tokens = tuple(self.single[np.frombuffer(w, np.uint8)].tolist())
                for below in RANK_STEPS:
                    cut = self._cut(tokens, below)
                    done = self._contracted({piece for piece in cut if len(piece) > 1}, below)
                    tokens = tuple(chain.from_iterable(done.get(piece, piece) for piece in cut))
                self._add([word], np.array(tokens, np.int32), np.array([len(tokens)]))

    def _add(self, keys: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        first = len(self.places)
        start = self.ends[first]
        while first + len(keys) >= len(self.ends):
            self.ends = np.append(self.ends, np.zeros_like(self.ends))
        while start + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[start : start + len(ids)] = ids
        self.ends[first + 1 : first + 1 + len(keys)] = start + ends
        self.places.update(zip(keys, range(first, first + len(keys))))

    def _learn(self, chunks: list[str], newer: bool) -> None:
        words = [self.words_of(chunk, newer) for chunk in chunks]
        self._learn_words(list({word for some in words for word in some}.difference(self.places)))
        several = [i for i, some in enumerate(words) if len(some) != 1]
        if several:
            ids, ends = self._ids_at(np.array([self.places[word] for i in several for word in words[i]], np.int64))
            stops = np.cumsum([len(words[i]) for i in several])
            self._add([chunks[i] for i in several], ids, np.append([0], ends)[stops])

    def _ids_at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words or chunks in a row, and where each one's end."""
        starts = self.ends[place]
        sizes = self.ends[place + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(starts - ends + sizes, sizes) + np.arange(total)], ends

    def _looked_up(self, chunks: pa.Array, newer: bool) -> tuple[np.ndarray, np.ndarray]:
        if len(self.places) > KEPT_WORDS:
            self._forget()
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [chunk for chunk in distinct if chunk not in self.places]
        if new:
            self._learn(new, newer)
        place = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))
        return self._ids_at(place[coded.indices.to_numpy()])

    def _encoded(self, texts: pa.Array, newer: bool) -> list[np.ndarray]:
        """The ids of each text, chunks cut at spaces; one by one only where a space has
        other white space beside it."""
        odd = pc.match_substring_regex(texts, BESIDE_SPACE).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        counts = pc.list_value_length(lists).to_numpy()
        first = np.zeros(int(counts.sum()), bool)
        first[np.cumsum(counts) - counts] = True
        chunks = pc.binary_join_element_wise(pc.if_else(pa.array(first), "", " "), lists.flatten(), "")
        cut = [CHUNK.split(text) for text in texts.filter(pa.array(odd)).to_pylist()]
        chunks = pa.concat_arrays([chunks, pa.array(list(chain.from_iterable(cut)), pa.string())])
        ids, ends = self._looked_up(chunks, newer)
        stops = np.append([0], ends)[np.cumsum([*counts, *map(len, cut)], dtype=np.int64)]
        found: list[np.ndarray] = [ids] * len(texts)
        for row, part in zip([*np.flatnonzero(~odd), *np.flatnonzero(odd)], np.split(ids, stops[:-1])):
            found[row] = part
        return found

    def _encoded_long(self, text: str, newer: bool) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            cut = CHUNK.search(text, at + SLICE_BYTES)
            block = text[at : cut.start() if cut else len(text)]
            if len(block) <= 2 * SLICE_BYTES:
                parts += self._encoded(pa.array([block]), newer)
            else:  # hardly a place to cut
                words = iter(self.words_of(block, newer))
                while some := list(islice(words, SLICE_WORDS)):
                    parts.append(self._looked_up(pa.array(some), newer)[0])
            at += len(block)
        return np.concatenate(parts)

    def encode(self, texts: Sequence[str | None] | pa.Array, newer: bool = True) -> Iterator[np.ndarray]:
        """The ids of each text, ``newer`` if one may hold newer signs.  Texts are looked up
        ``SLICE_BYTES`` at a time, and longer ones a block at a time."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        start = 0
        while start < len(texts):
            ends = np.cumsum(sizes[start : start + SLICE_WORDS])
            count = int(np.searchsorted(ends, SLICE_BYTES, "right"))
            if count:
                yield from self._encoded(texts.slice(start, count), newer)
            else:
                yield self._encoded_long(texts[start].as_py(), newer)
            start += max(count, 1)

    # -------------------------------------------------------------- ids to bytes

    def decode(self, sequences: Iterable[np.ndarray]) -> Iterator[bytes]:
        """The bytes of each sequence of ids, ``DECODED_IDS`` at a time."""
        held: list[np.ndarray] = []
        size = 0
        for ids in sequences:
            if size + len(ids) > DECODED_IDS:
                yield from self._joined(held)
                held, size = [], 0
            if len(ids) > DECODED_IDS:
                cuts = np.split(ids, range(DECODED_IDS, len(ids), DECODED_IDS))
                yield b"".join(self._joined([cut])[0] for cut in cuts)
                continue
            held.append(ids)
            size += len(ids)
        yield from self._joined(held)

    def _joined(self, sequences: list[np.ndarray]) -> list[bytes]:
        sizes = [len(ids) for ids in sequences]
        if not sum(sizes):
            return [b""] * len(sizes)
        ids = np.concatenate(sequences).astype(np.int32)
        pos = np.arange(len(ids), dtype=np.int32)
        self.db.register("sequence", pa.table({"part": pos >> DECODED_BITS, "pos": pos, "id": ids}))
        tokens = self.db.sql(DECODE).to_arrow_table().column("bytes").combine_chunks().flatten()
        self.db.unregister("sequence")
        raw = pc.binary_join(pa.ListArray.from_arrays([0, len(tokens)], tokens), b"")[0].as_py()
        ends = np.append([0], np.cumsum(self.sizes[ids]))[np.cumsum([0, *sizes])].tolist()
        return [raw[i:j] for i, j in zip(ends, ends[1:])]


def _groups(pieces: Iterable, size: int, at: int | None = None) -> Iterator[list]:
    """The pieces in groups of at most ``size`` tokens; a longer one is by itself.  A
    piece is the element ``at`` of what is given, if that is set."""
    held: list = []
    total = 0
    for piece in pieces:
        tokens = len(piece if at is None else piece[at])
        if held and total + tokens > size:
            yield held
            held, total = [], 0
        held.append(piece)
        total += tokens
    if held:
        yield held


@cache
def codec_of_worker(path: str) -> Codec:
    """A worker keeps its tables and words for its next tasks."""
    return Codec(path)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of a key and byte strings as batches of about ``BATCH_BYTES``."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row[1:])) + 16
        if size > BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def encode(docs: DataFrame, tokenizer: str | None = None, decoded: bool = False) -> DataFrame:
    """doc_id and ``ids``, the text's ids as little-endian unsigned 32-bit integers;
    with ``decoded`` also the bytes that these ids decode to.

    The ids are those of the pattern's matches, each by itself, without special tokens.
    A NULL or empty text has no ids and decodes to no bytes.  Each row of ``docs``
    gives a row, also with a repeated or NULL doc_id; other columns are left out.
    Texts of any length are whole, their words looked up a slice at a time.  A run of
    letters without an end is the costly case: one step for each distinct merge in it.
    """
    path = tokenizer or default_tokenizer()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of_worker(path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                texts = batch.column(1)
                # signs from U+0540 on begin with these bytes; newer ones come after U+0557
                raw = texts.buffers()[2]
                newer = raw is not None and bool((np.frombuffer(raw, np.uint8) >= 0xD5).any())
                found = codec.encode(texts, newer)
                for key, ids in zip(batch.column(0).to_pylist(), found):
                    yield key, ids

        def whole() -> Iterator[tuple]:
            if not decoded:
                yield from ((key, ids.astype("<u4").tobytes()) for key, ids in rows())
                return
            held: list[tuple] = []
            size = 0
            for key, ids in rows():
                held.append((key, ids))
                size += len(ids)
                if size > DECODED_IDS:
                    yield from decoded_rows(held)
                    held, size = [], 0
            yield from decoded_rows(held)

        def decoded_rows(held: list[tuple]) -> Iterator[tuple]:
            for (key, ids), text in zip(held, codec.decode(ids for _, ids in held)):
                yield key, ids.astype("<u4").tobytes(), text

        schema = pa.schema([("doc_id", key_type), ("ids", pa.binary())] + [("decoded", pa.binary())] * decoded)
        yield from _batches(whole(), schema)

    key_type = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = f"doc_id {kind}, ids binary" + ", decoded binary" * decoded
    return docs.select("doc_id", "text").mapInArrow(of_task, schema)


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and ``decoded``, the bytes of ``ids`` (little-endian unsigned 32-bit
    integers); NULL or empty ids give no bytes.  An id outside the vocabulary is an error."""
    path = tokenizer or default_tokenizer()
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of_worker(path)
        schema = pa.schema([("doc_id", key_type), ("decoded", pa.binary())])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                ids = [np.frombuffer(raw.as_py() or b"", "<u4") for raw in batch.column(1)]
                for some in ids:
                    if len(some) and some.max() >= len(codec.ranks):
                        raise ValueError(f"id {some.max()} isn't in the vocabulary")
                yield from zip(batch.column(0).to_pylist(), codec.decode(ids))

        yield from _batches(rows(), schema)

    key_type = to_arrow_type(encoded.schema["doc_id"].dataType)
    return encoded.select("doc_id", "ids").mapInArrow(of_task, f"doc_id {kind}, decoded binary")
