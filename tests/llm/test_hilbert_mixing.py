import zlib
from collections import Counter, defaultdict

import pytest

from claimweave.llm import hilbert, mixing, queries


def rows(n=300):
    made = [(i, "w " * (i % 40) if i % 11 else None, ["en", "de", None][i % 3], "hot" if i % 3 else f"s{i % 7}") for i in range(n)]
    return [*made, made[5], made[5], (None, "no id here", None, None), (7777, "é😀 x" * 5000, "en", "hot")]


def test_shards_are_whole_even_and_gapless(spark, documents, as_table):
    given = rows()
    found = queries.QUERIES["op1_hilbert"](spark, as_table(documents=documents(*given))).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in given
    )
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.curve for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3)])
def test_curve_visits_every_cell_once_and_steps_to_a_neighbour(spark, axes, bits):
    side = 1 << bits
    names = [f"a{i}" for i in range(axes)]
    grid = spark.range(side**axes).selectExpr(*[f"(id div {side ** i}) % {side} AS a{i}" for i in range(axes)])
    found = grid.withColumn("curve", hilbert.curve_index(names, bits)).collect()
    path = sorted(found, key=lambda r: r.curve)
    assert [r.curve for r in path] == list(range(side**axes))
    assert all(sum(abs(a[n] - b[n]) for n in names) == 1 for a, b in zip(path, path[1:]))


def test_shard_files_prune_by_any_dimension(spark, documents, tmp_path):
    df = documents(*[(i, "x" * (1 + i * 37 % 500), "en", f"s{i % 16}") for i in range(1600)])
    hilbert.write_shards(df, f"{tmp_path}/shards", shards=16)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 1600
    touched = back.where("source = 's3'").select("shard").distinct().count()
    assert touched <= 8


def test_empty_table(spark, documents):
    assert hilbert.hilbert_shards(documents().limit(0)).count() == 0
    assert mixing.mix(documents().limit(0)).count() == 0


def filled(sizes, weights):
    """Targets by resharing the excess until none is above its limit."""
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weights[s] for s in sizes if s not in full)
        target = {s: 3 * sizes[s] if s in full else rest * weights[s] / share for s in sizes}
        above = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def test_targets_and_copies(spark, documents, as_table):
    given = rows(2000)
    folder = as_table(documents=documents(*given))
    found = queries.QUERIES["op10_mixing"](spark, folder).collect()
    sizes, of = defaultdict(int), defaultdict(set)
    for i, text, _, source in given:
        sizes[source] += len((text or "").split())
        of[i].add(source)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    taken = Counter()
    for r in found:
        (source,) = of[r.doc_id]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(wanted[source])
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[source] += r.taken
    assert len(found) == len(given)
    fraction = wanted["hot"] / sizes["hot"] % 1
    spread = (fraction * (1 - fraction) * sum(r.size**2 for r in found if "hot" in of[r.doc_id])) ** 0.5
    assert abs(taken["hot"] - wanted["hot"]) < 4 * spread
    again = queries.QUERIES["op10_mixing"](spark, folder)
    assert sorted(map(str, again.collect())) == sorted(map(str, found))


def test_emitted_rows_and_given_weights(spark, documents):
    docs = documents((1, "a b", "en", "x"), (2, "c d", "en", "y"), (3, "e f", "en", "z"), (3, "e f", "en", "z"))
    # of four words one is for x and three for y
    weights = spark.createDataFrame([("x", 1), ("y", 3)], "source string, weight long")
    mixed = mixing.mix(docs.withColumn("target", docs.doc_id), weights)
    copies = {r.doc_id: r._copies for r in mixed.collect()}
    assert copies[1] in (0, 1) and copies[2] in (1, 2) and 3 not in copies
    out = mixing.emit(mixed)
    assert sorted(r.target for r in out.collect()) == [1] * copies[1] + [2] * copies[2]
