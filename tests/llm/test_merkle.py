import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from claimweave.llm import merkle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """The rows of the query, by whole levels in lists."""

    def leaf(row, text):
        values = [row[0], row[3], row[2], row[4], text]
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def steps(levels, i):
        found = []
        for level in levels[:-1]:
            first = i - i % 3
            found.append((level[first:i], level[i + 1 : first + 3]))
            i //= 3
        return found

    trees = defaultdict(list)
    for row in rows:
        text = row[1]
        if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        trees[(row[3] is not None, (row[3] or "").encode())].append(((row[0] is not None, row[0] or 0, leaf(row, row[1])), row[0], leaf(row, text)))
    names = sorted(trees)
    made = {name: tree([key[2] for key, *_ in sorted(trees[name])]) for name in names}
    top = tree([made[name][-1][0] for name in names])
    out = []
    for n, name in enumerate(names):
        for i, (key, doc_id, tampered) in enumerate(sorted(trees[name])):
            path = steps(made[name], i) + steps(top, n)
            node = tampered
            for before, behind in path:
                node = H(*before, node, *behind)
            proof = H(*(x for before, behind in path for x in before + behind))
            out.append((doc_id, key[2], made[name][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(map(str, out))


def full(rows):
    return [(*row, None if row[1] is None else len(row[1])) for row in rows]


def table_of(rng, sizes):
    rows = []
    for source, n in sizes.items():
        for i in range(n):
            text = rng.choice([None, "", "a\nb", "line\n" * 5, "é 漢字", f"text {i}"])
            rows.append((rng.choice([None, len(rows), rng.randrange(50)]), text, rng.choice([None, "en"]), source))
    return rows + rows[:3] * 2


def test_addresses_are_places_in_the_log():
    for n in [*range(1, 40), 81, 82, 100]:
        leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
        for levels in {merkle.levels_of(n), merkle.levels_of(n) + 2}:
            log = merkle.append_log(leaves, levels)
            level, at = leaves, 0
            for depth in range(levels + 1):
                for i, node in enumerate(level):
                    assert log[merkle.address(depth, i, n, levels)] == node
                    at += 1
                level = [merkle.hashed(level[i : i + 3]) for i in range(0, len(level), 3)]
            assert at == len(log)
            assert all(merkle.folded(leaf, steps) == log[-1] for leaf, steps in zip(leaves, merkle.steps_of(b"".join(log), n, levels)))
            steps = list(merkle.steps_of(b"".join(log), n, levels))[-1]
            assert merkle.from_bytes(merkle.as_bytes(steps)) == steps


@pytest.mark.parametrize("levels", [8, 1, 2])
def test_equals_brute_force(spark, documents, as_table, monkeypatch, levels):
    """Also with blocks of 3 and 9 leaves, so that trees take several tiers."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    rows = table_of(random.Random(levels), {None: 1, "": 5, "big": 95, "é": 9, "z": 27, "one": 1, "-": 2, "=": 4, "s": 10, "t": 3, "u": 4})
    docs = documents(*rows).selectExpr("*", "1 AS tree", "2 AS leaf", "3 AS position", "4 AS root")
    found = queries.QUERIES["op12_merkle"](spark, as_table(documents=docs)).collect()
    assert sorted(map(str, map(tuple, found))) == brute(full(rows))
    assert {r.verified for r in found} == {True, False}


def test_one_row_and_none(spark, documents):
    row = (7, "x\ny", "en", "s")
    assert sorted(map(str, map(tuple, merkle.proofs(merkle.manifest(documents(row))).collect()))) == brute(full([row]))
    assert merkle.proofs(merkle.manifest(documents().limit(0))).count() == 0


def test_the_log_holds_every_node_once(spark, documents):
    made = merkle.manifest(documents(*((i, f"text {i}", "en", "s") for i in range(20))))
    log = made.logs[0].first()
    assert len(log.log) == 32 * (20 + 7 + 3 + 1) and bytes(log.log[-32:]) == bytes(log.top)
    assert made.logs[0].count() == made.sources.count() == 1
