"""Repair of conversations by alignment with the strings of their grammar.

A repaired conversation's role initials are nothing or ``(s?)(ua)+``.  For each feasible
length this is one string, and a Wagner-Fischer table aligns the turns with it; as the
strings differ only in front, one table by remaining length serves all of them.  Ukkonen
bands come from the cost of a greedy repair.  Of the cheapest alignments the one with
the least audit is found by walking all of them letter by letter.

Turns are aligned in blocks of at most 256, so a conversation of any length is cut: each
block gives its costs from every state of the grammar to every other, sums from the end
give what follows a block, and the walk goes on from block to block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from claimweave.llm.common import batches_of, rows_of, written
from claimweave.llm.order import in_order

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Nothing written yet; only the system turn; last a user turn; last an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: What the states cost at the end of a conversation: the turns that are inserted.
AT_END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60
BLOCK_BITS = 8
#: Code points of a text that decide the order of rows of one turn and role, before its hash.
HEAD_SIZE = 64


class Turn(NamedTuple):
    """``initial``: s, u, a or another; ``required``: it has to go; ``open_``: it is
    truncated; ``copies``: so many required ones in a row."""

    initial: str
    required: bool
    open_: bool
    copies: int


# ------------------------------------------------------------------- alignment


def next_state(state: int) -> int:
    """The state after the next turn of the alternation."""
    return ASSISTANT if state == USER else USER


def target(end: int, left: int) -> str:
    """The next initial if ``left`` turns remain up to one that leaves the state ``end``."""
    return "ua"[(end == ASSISTANT) == (left % 2 == 1)]


class Alignment:
    """Costs of aligning a block's turns with each feasible string of the grammar.

    ``plain[end][i][q]``: the turns from ``i`` on with the last ``q`` initials of an
    alternation that ends in ``end``; ``opened[end][i][q]``: with one more ``s`` before
    them.  No turn is inserted behind the block's last, that is left to what follows.
    Rows hold the band only, from ``low[i]`` on."""

    def __init__(self, turns: Sequence[Turn]):
        self.turns, n = turns, len(turns)
        self.rest = [0] * (n + 1)  # turns that needn't go, from i on
        self.removal = [0] * (n + 1)  # cost of deleting all from i on
        for i in range(n - 1, -1, -1):
            self.rest[i] = self.rest[i + 1] + (not turns[i].required)
            self.removal[i] = self.removal[i + 1] + DELETE * turns[i].copies
        least = sum(DELETE * t.copies if t.required else TRUNCATED * t.open_ for t in turns)
        slack = self._incumbent() - least
        cheap = sum(t.open_ and not t.required for t in turns)  # deleting these costs one more
        fewer = min(slack, cheap) + max(0, slack - cheap) // DELETE
        more = slack // INSERT
        self.low = [max(0, r - fewer - 1) for r in self.rest]  # a kept system turn is one less
        self.high = [r + more for r in self.rest]
        self.plain = {end: self._table(end) for end in (USER, ASSISTANT)}
        self.alone = [NEVER] * (n + 1)  # a system turn, from i on, and nothing else
        for i, turn in reversed([*enumerate(turns)]):
            self.alone[i] = self.alone[i + 1] + DELETE * turn.copies
            if turn.initial == "s" and not turn.required:
                self.alone[i] = min(self.alone[i], self.removal[i + 1] + TRUNCATED * turn.open_)
        system = self.alone[0] < NEVER
        self.opened = {end: self._opened(end) for end in (USER, ASSISTANT)} if system else {}

    def _incumbent(self) -> int:
        """The cost of a greedy repair, whatever its first and last state: a turn that
        doesn't fit gets another before it or a new role."""
        cost, state = 2 * INSERT + RELABEL, ASSISTANT
        for turn in self.turns:
            if turn.required:
                cost += DELETE * turn.copies
                continue
            cost += TRUNCATED * turn.open_
            if turn.initial == target(next_state(state), 1):
                state = next_state(state)
            elif turn.initial in "ua" and turn.initial:
                cost += INSERT
            else:
                cost += RELABEL
                state = next_state(state)
        return cost

    def _table(self, end: int) -> list[list[int]]:
        n = len(self.turns)
        rows: list[list[int]] = [[]] * n + [[0 if q == 0 else NEVER for q in range(self.low[n], self.high[n] + 1)]]
        for i in range(n - 1, -1, -1):
            turn, low, below, below_low = self.turns[i], self.low[i], rows[i + 1], self.low[i + 1]
            kept = TRUNCATED * turn.open_
            row, before = [], NEVER
            for q in range(low, self.high[i] + 1):
                best = before + INSERT if q else NEVER
                if 0 <= q - below_low < len(below):
                    best = min(best, below[q - below_low] + DELETE * turn.copies)
                if q and not turn.required and 0 <= q - 1 - below_low < len(below):
                    fits = turn.initial == target(end, q)
                    best = min(best, below[q - 1 - below_low] + kept + (0 if fits else RELABEL))
                row.append(best)
                before = best
            rows[i] = row
        return rows

    def _opened(self, end: int) -> list[list[int]]:
        n = len(self.turns)
        rows: list[list[int]] = [[]] * n + [[NEVER] * (self.high[n] - self.low[n] + 1)]
        for i in range(n - 1, -1, -1):
            turn = self.turns[i]
            row = []
            for q in range(self.low[i], self.high[i] + 1):
                best = NEVER
                if 0 <= q - self.low[i + 1] < len(rows[i + 1]):
                    best = rows[i + 1][q - self.low[i + 1]] + DELETE * turn.copies
                if turn.initial == "s" and not turn.required:
                    best = min(best, self._left(end, i + 1, q) + TRUNCATED * turn.open_)
                row.append(best)
            rows[i] = row
        return rows

    def _left(self, end: int, i: int, q: int, opened: bool = False) -> int:
        """The cost of the rest from turn ``i`` on."""
        if q == 0:
            return self.alone[i] if opened else self.removal[i]
        rows = (self.opened if opened else self.plain)[end][i]
        return rows[q - self.low[i]] if 0 <= q - self.low[i] < len(rows) else NEVER

    def targets(self, state: int) -> Iterator[tuple[bool, int, int, int]]:
        """Whether a system turn comes first, the end state, the length of the
        alternation and the cost, of each string that can be written from a state."""
        yield False, state, 0, self.removal[0]
        lengths = range(max(1, self.low[0]), self.high[0] + 1)
        for end in (USER, ASSISTANT):
            for q in lengths:
                if target(end, q) == ("a" if state == USER else "u"):
                    yield False, end, q, self._left(end, 0, q)
        if state == START and self.opened:
            yield True, SYSTEM, 0, self.alone[0]
            for end in (USER, ASSISTANT):
                for q in lengths:
                    if target(end, q) == "u":
                        yield True, end, q, self._left(end, 0, q, opened=True)

    def costs(self) -> list[list[int]]:
        """Least costs from each state to each."""
        found = [[NEVER] * len(STATES) for _ in STATES]
        for state in STATES:
            for _, end, _, cost in self.targets(state):
                found[state][end] = min(found[state][end], cost)
        return found

    def walk(self, state: int, after: Sequence[int]) -> tuple[str, int]:
        """The least audit of the cheapest alignments from a state on, if what follows
        costs ``after`` by state; and the state that it ends in."""
        every = [(cost + after[end], opened, end, q) for opened, end, q, cost in self.targets(state)]
        best = min(cost for cost, *_ in every)
        live = {(opened, end, q): best - after[end] for cost, opened, end, q in every if cost == best}
        audit = []
        for i, turn in enumerate(self.turns):
            while True:
                letter, live = self._step(i, turn, live)
                audit.append(letter)
                if letter != "I":
                    if letter == "D":
                        audit.append("D" * (turn.copies - 1))
                    break
        ends = {end for _, end, _ in live}
        return "".join(audit), ends.pop()

    def _step(self, i: int, turn: Turn, live: dict) -> tuple[str, dict]:
        """The least letter with which some target keeps its cost, and these targets."""
        kept = TRUNCATED * turn.open_
        for letter in "DIKR":
            found = {}
            for (opened, end, q), cost in live.items():
                if letter == "D":
                    then, paid = (opened, end, q), DELETE * turn.copies
                elif letter == "I":
                    then, paid = (opened, end, q - 1), INSERT
                    if opened or not q:
                        continue
                elif turn.required:
                    continue
                elif opened:
                    then, paid = (False, end, q), kept
                    if letter == "R" or turn.initial != "s":
                        continue
                else:
                    then, paid = (False, end, q - 1), kept + RELABEL * (letter == "R")
                    if not q or (letter == "K") != (turn.initial == target(end, q)):
                        continue
                at = i if letter == "I" else i + 1
                left = self._left(end, at, then[2], then[0])
                if paid + left == cost:
                    found[then] = left
            if found:
                return letter, found
        raise AssertionError("no alignment keeps its cost")


@lru_cache(1 << 12)
def _remembered(turns: tuple[Turn, ...]) -> Alignment:
    return Alignment(turns)


def aligned(turns: tuple[Turn, ...]) -> Alignment:
    """Many short conversations are alike."""
    return _remembered(turns) if len(turns) <= 16 else Alignment(turns)


# ---------------------------------------------------------------------- damage


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after damage, and how many ``copies`` of a row there
    are, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text,
    2 takes the marks ``.!?`` out of it, 3 doubles it, 4 sets the role user.  A NULL role or text
    is one space, and so is a NULL conv_id or turn in the hashed text; elsewhere these stay
    NULL.  Other columns are left out."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    return (
        rows.select("conv_id", "turn", "role", "text", fate.alias("fate")).where("fate <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(shown("role")).alias("role"),
            text.alias("text"), F.when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


ORDER = ("conv_id", "turn", "role", "head", "digest")


def keyed(rows: DataFrame) -> DataFrame:
    """Add ``head`` and ``digest`` of the text, which order rows of one turn and role."""
    return rows.withColumns({"head": F.substring("text", 1, HEAD_SIZE), "digest": F.unhex(F.sha2("text", 256))})


def features(rows: DataFrame) -> DataFrame:
    """Distinct damaged rows in order, without their texts: whether a row is ``blank``,
    ``open`` (not ended by one of ``.!?``) and ``known`` (role and text were there
    before), its ``copies`` and ``_row``."""
    space = "\x20\x09\x0a\x0b\x0c\x0d"
    ended = F.rtrim(F.col("text"), F.lit(space))
    marked = keyed(rows).select(
        *ORDER, "copies", (ended == "").alias("blank"), (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("open")
    )
    distinct = marked.groupBy(*ORDER, "blank", "open").agg(F.sum("copies").alias("copies"))
    same = F.sha2(F.to_json(F.struct("conv_id", "role", F.hex("digest").alias("text"))), 256)
    ordered = in_order(written(distinct.withColumn("same", F.unhex(same)), "turns"), ORDER, "ordered-turns")
    firsts = ordered.groupBy("same").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = firsts.where("_n > 1").drop("_n")
    joined = ordered.join(firsts, "same", "left")
    return joined.withColumn("known", F.coalesce(F.col("_row") > F.col("_first"), F.lit(False))).drop("same", "_first")


# ---------------------------------------------------------------------- blocks

NUMBERS = ("blank", "duplicate", "truncated", "illegal")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def turns_of(codes: bytes, copies: Sequence[int]) -> tuple[Turn, ...]:
    """The turns to align: of several equal rows all but the first have to go."""
    found = []
    for code, n in zip(codes, copies):
        initial, required, open_ = " sua"[code & 3], bool(code & 4), bool(code & 8)
        found.append(Turn(initial, required, open_ and not required, n if required else 1))
        if n > 1 and not required:
            found.append(Turn(initial, True, False, n - 1))
    return tuple(found)


def blocks_of(turns: DataFrame) -> DataFrame:
    """A row for each block of a conversation, with the keys of its first row: the turns
    as ``codes`` (initial, whether it has to go, whether it is truncated) and ``copies``,
    least ``costs`` between states, numbers of faults, and what is needed to add up blocks."""
    key_type = to_arrow_type(turns.schema["conv_id"].dataType)
    schema = pa.schema(
        [("conv_id", key_type), ("turn", pa.int64()), ("role", pa.string()), ("head", pa.string()), ("digest", pa.binary()),
         ("block", pa.int64()), ("codes", pa.binary()), ("copies", pa.list_(pa.int64())), ("costs", pa.list_(pa.int64())),
         *((name, pa.int64()) for name in NUMBERS), ("first", pa.string()), ("last", pa.string()),
         ("low", pa.int64()), ("high", pa.int64()), ("distinct", pa.int64())]
    )

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for (conv_id, block), group in groupby(rows_of(batches), key=lambda row: row[:2]):
                yield conv_id, *one([row[2:] for row in group], block)

        yield from batches_of(found(), schema, 1024)

    def one(rows: list[tuple], block: int) -> tuple:
        codes, numbers, last = bytearray(), dict.fromkeys(NUMBERS, 0), None
        for _, role, _, _, blank, open_, known, copies in rows:
            initial = role[:1]
            codes.append((" sua".find(initial) if initial in ("s", "u", "a") else 0) | (blank or known) << 2 | open_ << 3)
            if blank:
                numbers["blank"] += copies
            else:
                numbers["duplicate"] += copies - (not known)
                numbers["truncated"] += open_ and not known
            numbers["illegal"] += copies - 1 + (last is not None and (last, initial) not in LEGAL)
            last = initial
        copies = [row[7] for row in rows]
        numbered = [row[0] for row in rows if row[0] is not None]
        costs = [cost for row in aligned(turns_of(codes, copies)).costs() for cost in row]
        ends = (numbered[0], numbered[-1], len(set(numbered))) if numbered else (None, None, 0)
        return *rows[0][:4], block, bytes(codes), copies, costs, *numbers.values(), rows[0][1][:1], last, *ends

    block = F.shiftright("_row", BLOCK_BITS).alias("block")
    cut = turns.select("conv_id", block, "turn", "role", "head", "digest", "blank", "open", "known", "copies", "_row")
    sorted_ = cut.repartition("conv_id", "block").sortWithinPartitions("conv_id", "_row").drop("_row")
    kind = turns.schema["conv_id"].dataType.simpleString()
    ddl = (
        f"conv_id {kind}, turn long, role string, head string, digest binary, block long, codes binary,"
        f" copies array<long>, costs array<long>, {', '.join(f'{name} long' for name in NUMBERS)},"
        " first string, last string, low long, high long, distinct long"
    )
    return written(sorted_.mapInArrow(of_task, ddl), "turn-blocks")


RESULT = ("gaps", *NUMBERS, "cost")


def audits_of(blocks: DataFrame) -> DataFrame:
    """The ``audit`` of each block, with the keys of its first row, and for each conversation
    a row of rank 1 with its ``numbers`` (those of ``RESULT``) and the audit of turns
    inserted at its end.

    A conversation's blocks come twice: their costs from the last to the first, to sum up what
    follows each, then their turns from the first to the last."""
    columns = ("costs", "turn", "role", "head", "digest", "codes", "copies", *NUMBERS, "first", "last", "low", "high", "distinct")
    backward = blocks.select("conv_id", F.lit(0).alias("phase"), (-F.col("block")).alias("place"), "costs")
    forward = blocks.withColumns({"phase": F.lit(1), "place": F.col("block")}).drop("costs")
    both = backward.unionByName(forward, allowMissingColumns=True).select("conv_id", "phase", "place", *columns)
    key_type = to_arrow_type(blocks.schema["conv_id"].dataType)
    schema = pa.schema(
        [("conv_id", key_type), ("rank", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("head", pa.string()),
         ("digest", pa.binary()), ("audit", pa.string()), ("numbers", pa.list_(pa.int64()))]
    )

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv_id, rows in groupby(rows_of(batches), key=lambda row: row[0]):
                for row in walked(row[1:] for row in rows):
                    yield conv_id, *row

        yield from batches_of(found(), schema, 1024)

    def walked(rows: Iterable[tuple]) -> Iterator[tuple]:
        follows, after, state, last = [], list(AT_END), START, None
        numbers, low, high, distinct = dict.fromkeys(NUMBERS, 0), None, None, 0
        for phase, _, costs, turn, role, head, digest, codes, copies, *rest in rows:
            if phase == 0:
                follows.append(after)
                after = [min(costs[4 * a + b] + after[b] for b in STATES) for a in STATES]
                continue
            audit, state = aligned(turns_of(codes, copies)).walk(state, follows.pop())
            yield 2, turn, role, head, digest, audit, None
            for name, number in zip(NUMBERS, rest):
                numbers[name] += number
            first, ends_in, lowest, highest, found = rest[len(NUMBERS) :]
            numbers["illegal"] += last is not None and (last, first) not in LEGAL
            last = ends_in
            if found:
                distinct += found - (lowest == high)
                low, high = lowest if low is None else low, highest
        gaps = high - low + 1 - distinct if distinct else 0
        yield 1, None, None, None, None, "I" * (AT_END[state] // INSERT), [gaps, *numbers.values(), after[START]]

    sorted_ = both.repartition("conv_id").sortWithinPartitions("conv_id", "phase", "place")
    kind = blocks.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, rank int, turn long, role string, head string, digest binary, audit string, numbers array<long>"
    return written(sorted_.mapInArrow(of_task, ddl), "turn-audits")


# ---------------------------------------------------------------------- repair


def repaired(letters: str, rows: Iterable[tuple[str, str]], state: int) -> Iterator[tuple[str, str, int]]:
    """Role and text of each turn that an audit keeps or makes, and the state behind it."""
    for letter in letters:
        if letter == "D":
            next(rows)
            continue
        role, text = next(rows) if letter != "I" else ("", "")
        state = SYSTEM if state == START and letter == "K" and role[:1] == "s" else next_state(state)
        yield role if letter == "K" else ("user" if state == USER else "assistant"), text, state


def repair(rows: DataFrame, turns: bool = False) -> DataFrame:
    """Damage ``rows`` (conv_id, turn, role, text) and repair the conversations.

    A row for each conv_id of ``rows``, a NULL one included: gaps, blank, duplicate, truncated,
    illegal, cost, audit and ``repaired_sha256``, the hash of its repaired ``role:text``
    joined by line feeds.  One of which no row is left has zeros, an empty audit and the
    hash of nothing.  With ``turns``, the repaired turns instead: conv_id, ``nth`` from 0, role,
    text.

    Rows of one turn stand in the order of role, of the text's first 64 code points and of its
    SHA-256; a NULL turn comes first and isn't counted in gaps.  Equal rows are repeats.  A
    role is known by its first letter; one that begins otherwise, or is empty, can't be kept.
    Texts are read whole.  All work but the last is cut into blocks; the last streams a
    conversation's rows through one task, sorted by Spark, as its hash has to be taken in order."""
    given = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    broken = damaged(given)
    audits = audits_of(blocks_of(features(broken)))
    texts = keyed(broken).withColumns({"rank": F.lit(2), "kind": F.lit(1)})
    both = given.select("conv_id").distinct().withColumn("rank", F.lit(0))
    for part in (audits.withColumn("kind", F.lit(0)), texts):
        both = both.unionByName(part, allowMissingColumns=True)
    columns = ("conv_id", "rank", "kind", "role", "text", "copies", "audit", "numbers")
    sorted_ = both.repartition("conv_id").sortWithinPartitions("conv_id", "rank", "turn", "role", "head", "digest", "kind")
    kind = given.schema["conv_id"].dataType.simpleString()
    key = ("conv_id", to_arrow_type(given.schema["conv_id"].dataType))
    if turns:
        schema = pa.schema([key, ("nth", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        ddl = f"conv_id {kind}, nth long, role string, text string"
    else:
        schema = pa.schema([key, *((n, pa.int64()) for n in RESULT), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        ddl = f"conv_id {kind}, {', '.join(f'{name} long' for name in RESULT)}, audit string, repaired_sha256 string"

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv_id, group in groupby(rows_of(batches), key=lambda row: row[0]):
                yield from one(conv_id, (row[1:] for row in group))

        yield from batches_of(found(), schema, 256)

    def one(conv_id, group: Iterable[tuple]) -> Iterator[tuple]:
        numbers, pieces, tail, digest, state, nth = [0] * len(RESULT), [], "", hashlib.sha256(), START, 0

        def contents() -> Iterator[tuple]:
            """Audits, each followed by its rows."""
            nonlocal numbers, tail
            for rank, is_text, role, text, copies, audit, counted in group:
                if rank == 1:
                    numbers, tail = counted, audit
                elif rank == 2:
                    yield from [(role, text)] * copies if is_text else [audit]
            yield tail

        content = contents()
        for letters in content:
            pieces.append(letters)
            for role, text, state in repaired(letters, content, state):
                if turns:
                    yield conv_id, nth, role, text
                digest.update(f"{chr(10) * (nth > 0)}{role}:{text}".encode())
                nth += 1
        if not turns:
            yield conv_id, *numbers, "".join(pieces), digest.hexdigest()

    return sorted_.select(*columns).mapInArrow(of_task, ddl)
