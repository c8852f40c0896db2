import hashlib
import random
import re

from claimweave.llm import queries, secrets

KINDS = [
    ("assign", re.compile(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]


def brute(text):
    found = []
    for order, (kind, pattern) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            long_enough = {"assign": lambda: len(m[1]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}
            if long_enough[kind]():
                found.append((m.start(), order, kind, m.end()))
    return sorted(found)


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in found).encode()).hexdigest()


def texts():
    rng = random.Random(3)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", " ", "'", '"', "é😀", "abcdef", "AKIA",
             "ABCDEFGHIJ0123456789", "0123456789abcdef", "deadbeefdeadbeef", "xyz", "\n", "/+_.", "hunter2", "12345"]
    made = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(300)]
    return [None, "", "secret=token:abcdef", "token=secret:abcdefgh", "AKIA" * 9, *made, made[0], "ab12" * 50_000]


def test_query_equals_brute_force(spark, documents, as_table):
    rows = list(enumerate(texts())) + [(None, "password=abcdef"), (3, "password=abcdef")]
    df = documents(*rows)
    found = queries.QUERIES["op7_secrets"](spark, as_table(documents=df)).collect()
    wanted = sorted((str(i), len([1 for s in brute(t) if s[2] == "hex"]), digest(brute(t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_hex, r.base_sha256) for r in found) == wanted


def test_only_unseen_pairs_are_scanned(spark, documents, tmp_path):
    ledger = f"{tmp_path}/ledger"
    docs = documents((1, "password=abcdef"), (2, "password=abcdef"), (3, None))
    first = secrets.scan(spark, docs, ledger, secrets.BASE_RULES)
    assert sorted((r.doc_id, len(r.spans)) for r in first.collect()) == [(1, 1), (2, 1), (3, 0)]
    assert spark.read.parquet(ledger).count() == 2
    secrets.scan(spark, docs, ledger, secrets.BASE_RULES).collect()
    assert spark.read.parquet(ledger).count() == 2
    newer = documents((1, "password=abcdef"), (4, "-----BEGIN PRIVATE KEY-----"))
    found = secrets.scan(spark, newer, ledger, secrets.RULES)
    assert sorted((r.doc_id, [s.kind for s in r.spans]) for r in found.collect()) == [(1, ["assign"]), (4, ["pem"])]
    added = spark.read.parquet(ledger).where("array_contains(rules, 'pem@1')")
    assert sorted(len(r.rules) for r in added.collect()) == [2, 5]


def test_empty_table_and_clashing_columns(spark, documents, tmp_path):
    none = secrets.scan(spark, documents().limit(0), f"{tmp_path}/a")
    assert none.count() == 0
    clash = documents((1, "secret: abcdefg")).selectExpr("*", "1 AS blob", "2 AS spans", "3 AS rules")
    (row,) = secrets.scan(spark, clash, f"{tmp_path}/b").collect()
    assert [s.kind for s in row.spans] == ["assign"]
