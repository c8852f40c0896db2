import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimweave.llm import html_text, langid, pii, queries
from claimweave.llm.html_text import visible_text

# ------------------------------------------------------------------- language


def prose(rng, letters, words=60):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(words))


def test_language_accuracy_on_held_out_documents(spark, documents, as_table):
    rng = random.Random(1)
    kinds = {"aa": "abcdeaei", "bb": "abxyzaao", "cc": "éàçaeiou"}
    rows = [(i, prose(rng, kinds[lang], rng.choice([3, 60])), lang, "s") for i, lang in enumerate(rng.choices(list(kinds), k=600))]
    odd = [(1000, None, "aa", "s"), (1001, "", "bb", "s"), (1002, "123 !!", "cc", "s"), (1003, prose(rng, kinds["bb"]) * 4000, None, "s"),
           (None, prose(rng, kinds["cc"]), "cc", "s"), rows[3]]
    found = queries.QUERIES["op5_langid"](spark, as_table(documents=documents(*rows, *odd))).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    held = [(i, lang) for i, _, lang, _ in rows if by_id[i].held_out]
    assert 100 < len(held) < 200
    assert sum(by_id[i].lang_pred == lang for i, lang in held) / len(held) > 0.97
    assert [by_id[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "bb"]
    assert all(0 <= r.score <= 1 for r in found) and not by_id[None].held_out


def test_texts_of_no_known_language_go(spark, documents):
    rng = random.Random(3)
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(150)] for lang, letters in
             (("aa", "abcdeaei"), ("bb", "lmnopouu"), ("xx", "abcqwxzy"))}
    def made(lang, n):
        return " ".join(rng.choices(words[lang], k=n))
    rows = [(i, made(lang, rng.choice([3, 60])), lang, "s") for i, lang in enumerate(rng.choices(["aa", "bb"], k=600))]
    odd = ["Съешь же ещё этих мягких французских булок", "これは日本語の文章です。今日はいい天気です", made("xx", 12), prose(rng, "bcdfghjklmnpqrstvwxyz", 20)]
    short = [made("aa", 2), made("bb", 3), made("aa", 1)[:3], made("aa", 4) + " 4734663219866878 2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"]
    docs = documents(*rows, *[(1000 + i, t, None, "s") for i, t in enumerate(odd)], *[(2000 + i, t, None, "s") for i, t in enumerate(short)])
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, docs, "").collect()}
    assert not kept & set(range(1000, 1004)) and kept >= {2000, 2001, 2002, 2003}
    assert len(kept & set(range(600))) >= 597


def test_model_and_bounds_come_from_all_labelled_documents(spark, documents):
    rng = random.Random(5)
    rows = [(i, prose(rng, "abcdeaei", rng.choice([1, 2, 3, 12])), "aa" if i else "bb", "s") for i in range(7000)]
    docs = documents(*rows)
    held = {r.doc_id for r in docs.where(langid.is_held_out()).collect()}
    learned = [(lang, text) for i, text, lang, _ in rows if i not in held]
    assert len(learned) > 5000 and len(held) > 1500
    model = langid.fitted(docs)
    assert abs(np.exp(model.log_prior[model.languages.index("aa")]) - sum(lang == "aa" for lang, _ in learned) / len(learned)) < 1e-9
    counts = np.zeros(langid.BUCKETS)
    for codes, owner in langid.slices([text for lang, text in learned if lang == "aa"]):
        for bucket, _ in langid.grams(codes, owner):
            counts += np.bincount(bucket, minlength=len(counts))
    smoothed = counts + langid.SMOOTHING
    assert np.allclose(model.log_probability[:-1, model.languages.index("aa")], np.log(smoothed / smoothed.sum()), atol=1e-5)
    bounds = langid.fit_bounds(docs, model)
    own = [text for i, text, lang, _ in rows if i in held and lang == "aa"]
    for i, length in enumerate(langid.FIT_LENGTHS):
        parts = [part for text in own for part in ([text[:length], text[len(text) // 2 :][:length]] if len(text) > length else [text])]
        total, n = langid.totals(model, parts)
        low, middle = np.quantile(total[:, model.languages.index("aa")] / n, [0.01, 0.5])
        expected = middle - langid.FIT_REACH * max(middle - low, langid.FIT_SPREAD)
        assert abs(bounds[i, model.languages.index("aa")] - expected) < 1e-9
    assert "bb" not in model.languages or (bounds[:, model.languages.index("bb")] == -np.inf).all()


def test_long_text_scores_as_the_sum_of_its_n_grams(monkeypatch):
    rng = random.Random(2)
    text = prose(rng, "abcdeéß", 400)
    def grams(size):
        monkeypatch.setattr(langid, "SLICE", size)
        return sorted((b, t) for c, o in langid.slices(["x", text, "", text[:50]]) for bs, ts in langid.grams(c, o) for b, t in zip(bs.tolist(), ts.tolist()))
    assert grams(1 << 20) == grams(64)
    counts = [sum(t == i for _, t in grams(64)) for i in range(4)]
    assert counts == [1, 3 * len(text) - 3, 0, 147]


def test_language_without_labels(spark, documents):
    docs = documents((1, "some text", None, "s"), (2, None, None, None))
    assert langid.fitted(docs) is None and langid.fitted(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.identify(docs.withColumn("score", F.lit(1)), None).collect()} == {"und"}


# ------------------------------------------------------------------------ PII

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute_spans(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


def pii_texts():
    rng = random.Random(4)
    parts = ["a.b", "@", "x-y.org", ".", "..", " ", "é", "😀", "1.2.3.4", "256.1.1.1", ".5", "00012", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "79927398713", "+1 (743) 555-3824", "+", "+44", " 20 7946 0958", "\n", "word", "_", "%", "--", "(", ")"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(2000)] + ["9" * 50_000, "1." * 30_000, "a" * 100_000 + "@b"]


def test_rules_equal_brute_force():
    for text in pii_texts():
        assert [tuple(s) for s in pii.rule_spans(text)] == brute_spans(text), text[:200]


def labelled(rng, n):
    words = ["the", "of", "Item", "12", "3.5", "page", "2024", "(a)", "v2", "10%"]
    kinds = [
        lambda: f"{rng.choice('abc')}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.org",
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        lambda: "4111 1111 1111 1111",
        lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
    ]
    return [" ".join([*rng.choices(words, k=5), rng.choice(kinds)() if rng.random() < 0.6 else "end", *rng.choices(words, k=3)]) for _ in range(n)]


def test_field_learns_the_labels_and_adds_only_apart_from_rules():
    rng = random.Random(6)
    def rows(texts):
        return [([t[a:b] for a, b in p], pii.labels_of(p, pii.rule_spans(t))) for t in texts for p in pii.passages(t)]
    field = pii.train(rows(labelled(rng, 400)))
    held = rows(labelled(rng, 200))
    right = total = 0
    for words, labels in held:
        path = pii.viterbi(field.scores([pii.features(words)]), field.steps)[0]
        right += sum(a == b for a, b in zip(path, labels))
        total += len(labels)
    assert right / total > 0.96
    texts = labelled(rng, 50) + ["call 743 now", ""]
    rules = [pii.rule_spans(t) for t in texts]
    for base, added in zip(rules, pii.field_spans(field, texts, rules)):
        assert all(a.stop <= b.start or b.stop <= a.start for a in added for b in base)


def test_viterbi_and_marginals_equal_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    n = len(pii.LABELS)
    unary, steps = rng.normal(size=(2, 3, n)), rng.normal(size=(n + 1, n + 1))
    single, _ = pii.marginals(unary, steps)
    best = pii.viterbi(unary, steps)
    for row in range(2):
        score = {}
        for path in itertools.product(range(n), repeat=3):
            edges = [n, *path, n]
            score[path] = sum(unary[row, t, k] for t, k in enumerate(path)) + sum(steps[a, b] for a, b in zip(edges, edges[1:]))
        assert tuple(best[row]) == max(score, key=score.get)
        total = sum(np.exp(list(score.values())))
        for t in range(3):
            for k in range(n):
                assert single[row, t, k] == pytest.approx(sum(np.exp(s) for p, s in score.items() if p[t] == k) / total)


def test_pii_query_and_redaction(spark, documents, as_table):
    rows = [(i, t) for i, t in enumerate(labelled(random.Random(8), 80))] + [(100, None), (101, ""), (101, ""), (None, "1.2.3.4")]
    df = documents(*rows)
    found = queries.QUERIES["op9_pii"](spark, as_table(documents=df)).collect()
    wanted = sorted((str(i), sum(s[1] == 0 for s in brute_spans(t or "")), sum(s[1] == 3 for s in brute_spans(t or ""))) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_email, r.n_phone) for r in found) == wanted
    clash = df.withColumn("pii", F.lit(1)).withColumn("kept", F.lit(2))
    clean = pii.redact(clash, pii.fitted(df))
    assert clean.columns == clash.columns and clean.count() == len(rows)
    texts = [r.text for r in clean.collect()]
    assert texts.count(None) == 1 and not any(EMAIL.search(t or "") or IP.search(t or "") for t in texts)
    assert pii.find(df.limit(0), None).count() == 0 and pii.fitted(df.limit(0)) is None


# ----------------------------------------------------------------------- HTML


@pytest.mark.parametrize("html, text", [
    ("<p>one <b>two</b>\n three<p>four<br>five", "one two three\n\nfour\nfive"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>x", "- a\n- b\n  3. c\n  4. d\n- e\n\nx"),
    ("<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td colspan=2>a wide cell</table>", "Name   N\nalpha  1\na wide cell"),
    ("<table><tr><td>漢字<td>b<tr><td>x<br>y<td>z</table>", "漢字  b\nx     z\ny"),
    ("a<div hidden>b<p>c</div><span style='Display : none'>d</span><script>e</script><!-- f -->g", "ag"),
    ("<pre>x\n  y</pre>end", "x\n  y\n\nend"),
    ("<blockquote>q<p>r</blockquote>s", "> q\n\n> r\n\ns"),
    ("<title>t</title>&lt;a&amp;b&gt;&nbsp;c", "<a&b>\xa0c"),
    ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\n    v\nl\n    w"),
    ("</p>x</div></table><td>y", "x\ny"),
    ("<div>a</div><div>b</div>c<h1>d</h1>e<hr>f", "a\nb\nc\n\nd\n\ne\n\n---\n\nf"),
    ("", ""), ("<", "<"),
])
def test_layout(html, text):
    assert visible_text(html) == text


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>T</title><p>Hello", "Hello"),
    ("<html><head><title>T</title><meta charset=utf-8>\n Hello", "Hello"),
    ("<head><style>a</style><script>b</script><link rel=x><noscript>n</noscript><div>c</div></head>d", "c\nd"),
    ("<head></p><title>T</title></head><p>a<head>b", "ab"),
    ("<p>pick <select><option>a<option selected>b<option>c</select> now", "pick b now"),
    ("<select><option selected hidden disabled>Choose<option>a</select><select><option disabled>x<option>y</select>z", "Choose y z"),
    ("<select multiple><optgroup label=G><option>a<option hidden>h<option label=L>b</select>", "G\na\nL"),
    ("<table><tr><td><select><option>a<option>b<td>c</table>", "a  c"),
    ("<datalist><option>a</datalist>b", "b"),
    ("x<svg/>y<p>z", "xy\n\nz"),
    ("<svg><title>t</title><path d='M0 0'/><text>one <tspan>two</tspan></text>\n<text>three</text></svg>four", "one two three four"),
    ("<svg><defs><text>a</text></defs>b<g><foreignObject><div>c</div></foreignObject></g></svg>d", "c\nd"),
    ("<svg><path><p>a</p>b", "a\n\nb"),
    ("<svg><text display=none>a</text><text><![CDATA[b]]></text></svg>", "b"),
    ("<p>so <math> <mi>x</mi> <mo>=</mo> <mfrac><mn>1</mn><mn>2</mn></mfrac><mspace/></math> holds", "so x= 1 2 holds"),
    ("<math><semantics><mi>x</mi><annotation>tex</annotation></semantics></math><math/>y", "xy"),
])
def test_implied_head_choices_drawings_and_formulas(html, text):
    assert visible_text(html) == text


def test_blocks_round_trip():
    rng = random.Random(9)
    for _ in range(200):
        blocks = [" ".join(rng.choices(["a", "b&c", "<d>", "é", "e."], k=rng.randint(1, 6))) for _ in range(rng.randint(1, 8))]
        def escaped(t):
            return t.replace("&", "&amp;").replace("<", "&lt;")
        end = rng.choice(["</p>", ""])
        html = "<html><body>" + "".join(f"<p>{escaped(b)}{end}\n<style>p{{}}</style>" for b in blocks)
        assert visible_text(html) == "\n\n".join(blocks)


def test_deep_and_long_pages():
    assert visible_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert len(visible_text("<p>word " * 50_000).split()) == 50_000


def test_html_query(spark, as_table):
    rows = [(1, "u", "<p>a"), (2, "v", None), (3, None, ""), (3, None, ""), (None, "w", "<li>b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = queries.QUERIES["op8_html"](spark, as_table(pages=pages)).collect()
    assert sorted(map(str, ((r.page_id, r.url, r.text) for r in found))) == sorted(
        map(str, [(1, "u", "a"), (2, "v", None), (3, None, ""), (3, None, ""), (None, "w", "- b")])
    )
    assert html_text.extract(pages.withColumn("text", F.lit("old")).limit(0)).columns == ["page_id", "url", "text"]
