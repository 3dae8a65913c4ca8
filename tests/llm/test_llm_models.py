"""PII, top-k, language, quality and rules: brute force, planted cases and held-out accuracy."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import language, pii, quality, rules, textstats, topk
from tracewell.llm.queries import CHECKS, QUERIES

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_identifiers(text):
    out = set()
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            odd = [int(d) for d in digits[-1::-2]]
            even = [sum(map(int, str(2 * int(d)))) for d in digits[-2::-2]]
            fits = (True, kind != 1 or all(int(p) <= 255 for p in m[0].split(".")), 12 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0, 9 <= len(digits) <= 15)
            if fits[kind]:
                out.add((m.start(), kind, m.end()))
    return out


def test_plain_identifiers_equal_the_patterns():
    r = random.Random(3)
    for _ in range(30_000):
        text = "".join(r.choice("a1.@-+ 0 2()%9.@\n") for _ in range(r.randrange(60)))
        assert pii.identifiers(text) == plain_identifiers(text), text


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("mail john dot smith at example dot com please", "email", "john dot smith at example dot com"),
        ("john (at) example [dot] co [dot] uk.", "email", "john (at) example [dot] co [dot] uk"),
        ("write jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("write john＠example．com", "email", "john＠example．com"),
        ("jo​hn@exam​ple.com", "email", "jo​hn@exam​ple.com"),
        ("a.b AT c.d DOT com", "email", "a.b AT c.d DOT com"),
        ("call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
        ("call plus 44 20 7946 0018 now", "phone", "plus 44 20 7946 0018"),
        ("card four one one one 1111 1111 one one one one.", "card", "four one one one 1111 1111 one one one one"),
        ("card 41l1 1111 1111 1111", "card", "41l1 1111 1111 1111"),
        ("192 [.] 168 [.] 1 [.] 1", "ip", "192 [.] 168 [.] 1 [.] 1"),
        ("+١٢٣٤٥٦٧٨٩٠", "phone", "+١٢٣٤٥٦٧٨٩٠"),
    ],
)
def test_disguised_identifiers(text, kind, found):
    base, added = pii.spans_in(text)
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in added] == [(kind, found)]
    assert base == plain_identifiers(text)


@pytest.mark.parametrize("text", ["we met at noon. dot com bubble at home", "seven seven seven", "почта@пример.рф", "look at this one two three", "1 of 2 at 3.", "the dot on the i", ""])
def test_clean_texts_get_no_span(text):
    assert pii.spans_in(text) == (set(), set())


def test_pii_of_tables(spark, sf_dir, edge_docs, empty_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in pii.digest(docs).collect():
        base = plain_identifiers(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        written = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(base))
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert r.n_added or r.spans == written
    assert pii.find(edge_docs).count() == pii.digest(edge_docs).count() == edge_docs.count()
    assert pii.find(empty_docs).count() == pii.masked(empty_docs).count() == 0


def test_masking(spark, edge_docs):
    out = pii.masked(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert out.filter("text like '%a@b.example%'").count() == 0
    one = pii.masked(spark.createDataFrame([(1, "to a@b.example and +1 (017) 555-7713 x", 0), (2, None, 5)], "doc_id long, text string, n_chars long")).collect()
    assert one[0].text == "to [EMAIL] and [PHONE] x" and one[0].n_chars == 24 and one[1].text is None


def plain_top_k(rows, k, modulus):
    ok = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % modulus == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ok if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("a_round,block,size", [(8192, 4096, 1.0), (2, 7, 1.0), (3, 5, 2e5), (8192, 4096, 3e6), (5, 9, 6e6)])
def test_top_k(spark, a_round, block, size):
    r = np.random.default_rng(7)
    rows = [(i, (r.normal(size=10) * size).tolist()) for i in range(60)]
    rows += [(60, rows[3][1]), (61, rows[3][1]), (20, rows[5][1]), (7, rows[7][1]), (62, None), (63, [None] * 10), (64, [float("nan")] * 10), (80, [float("inf")] * 10), (None, rows[1][1]), (65, []), (100, [1.0, 2.0])]
    vectors = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=9, dims_a_step=3, block_rows=block, queries_a_round=a_round)
    assert sorted(map(tuple, got.collect())) == plain_top_k(rows, 9, 20)


def test_top_k_of_few_and_none(spark):
    for rows in ([], [(20, [1.0])], [(20, [1.0]), (3, [2.0])]):
        got = topk.every_twentieth(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert sorted(map(tuple, got.collect())) == plain_top_k(rows, 20, 20)


def test_top_k_of_large_components_and_many_dimensions(spark):
    rows = [(0, [3e6]), (1, [2e6]), (2, [4e6]), (20, [-3e6])]
    got = topk.every_twentieth(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == plain_top_k(rows, 20, 20)
    assert (0, 1, 2, 49152000000000000) in [tuple(r) for r in got]
    r = np.random.default_rng(3)
    for dims in (1536, 3072):
        rows = [(i, r.normal(size=dims).tolist()) for i in range(45)]
        vectors = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        got = topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=9).collect()
        assert sorted(map(tuple, got)) == plain_top_k(rows, 9, 20)
    with pytest.raises(Exception, match="is no long"):
        topk.every_twentieth(spark.createDataFrame([(0, [1e9]), (1, [2e9])], "vec_id long, embedding array<double>")).collect()
    with pytest.raises(Exception, match="too large for a long"):
        topk.every_twentieth(spark.createDataFrame([(0, [1e300])], "vec_id long, embedding array<double>")).collect()


def test_samples_take_one_row_of_each_id(spark, labelled):
    """An id on most of the rows does not crowd others out, wherever its rows are."""
    docs, labels, _ = labelled
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi").orderBy("doc_id").limit(1)
    crowd = docs.unionByName(known.select(docs.columns).crossJoin(spark.range(8000).select(F.lit(1).alias("_n"))).drop("_n"))
    once = textstats.one_row_each(crowd.select("doc_id", "text"))
    assert once.count() == docs.count()
    model, again = (quality.fit(t, labels) for t in (docs, crowd.repartition(5)))
    assert model is not None and model.weights == pytest.approx(again.weights, rel=1e-6)
    assert rules.fit(docs, labels) == rules.fit(crowd.repartition(3), labels)


def test_top_k_prunes_dimensions():
    r = np.random.default_rng(1)
    block = np.rint(r.normal(size=(64, 4000)) * 40 * np.linspace(3, 0.2, 64)[:, None])
    search = topk.Search(np.array([-1]), block[:, :1].copy(), 5, 16)
    search.add(np.arange(2000), block[:, :2000])
    search.add(np.arange(2000, 4000), block[:, 2000:])
    scores = block[:, 0] @ block
    assert [i for _, i, _ in search.rows()] == sorted(range(4000), key=lambda i: (-scores[i], i))[:5]


def test_language(spark, sf_dir, edge_docs, empty_docs):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    true = dict(docs.select("doc_id", "lang").collect())
    rows = language.digest(docs).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and 150 < len(held) < 350
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    edge = {r.doc_id: r for r in language.digest(edge_docs).collect()}
    assert edge[4].lang_pred == edge[3].lang_pred == edge[7].lang_pred == edge[11].lang_pred == "und" and edge[1].lang_pred == "en"
    assert language.digest(empty_docs).count() == 0
    unknown = language.digest(docs.limit(5).selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


def test_temperature_softens_what_is_too_sure():
    wrong = [(np.array([9.0, 0.0]), 0)] * 7 + [(np.array([9.0, 0.0]), 1)] * 3
    t = language.temperature(wrong)
    assert abs(language.softmax(np.array([9.0, 0.0]) / t)[0] - 0.7) < 0.05


@pytest.fixture(scope="module")
def labelled(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, dict(labels.select("doc_id", "quality").collect())


def test_quality_classifier(labelled):
    docs, labels, truth = labelled
    rows = quality.digest(docs, labels).collect()
    assert len(rows) == docs.count()
    known = [(r.kept, truth[r.doc_id]) for r in rows if r.doc_id in truth]
    good, bad = [k for k, t in known if t], [k for k, t in known if not t]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_learns_from_few_and_scores_all(labelled):
    docs, labels, truth = labelled
    few = labels.filter("doc_id % 3 = 0")
    rows = quality.digest(docs, few).collect()
    unseen = [(r.kept, truth[r.doc_id]) for r in rows if r.doc_id in truth and r.doc_id % 3]
    assert sum(k == bool(t) for k, t in unseen) >= 0.97 * len(unseen)


def test_quality_edge_cases(edge_docs, empty_docs, labels):
    out = quality.kept(edge_docs, labels)
    assert out.columns == edge_docs.columns
    assert quality.digest(edge_docs, labels).count() == edge_docs.count()
    assert quality.kept(edge_docs, labels.filter("quality = 1")).count() == edge_docs.count()
    assert quality.kept(empty_docs, labels).count() == 0 and quality.kept(edge_docs, labels.limit(0)).count() == edge_docs.count()


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rule_counts(spark, sf_dir, edge_docs):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), edge_docs):
        got = rules.judged(docs, []).collect()
        want = sorted((r.doc_id or 0, *plain_counts(r.text)) for r in docs.collect())
        assert sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
        assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.kept != r.base_failed for r in got)


def test_lines_of_form_feeds_are_blank_and_lines_of_f_are_not(spark):
    texts = ["\f\none\n\f\ntwo\n \f\v", "f\nff \nf\nff \none", "\fone\n\fone"]
    got = rules.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), []).select("doc_id", "n_dup_lines").collect()
    assert dict(got) == {0: 0, 1: 2, 2: 1}


def test_rules_reject_what_labels_call_bad(labelled):
    docs, labels, truth = labelled
    learned = rules.fit(docs, labels)
    rows = [r for r in rules.judged(docs, learned).collect() if r.doc_id in truth]
    assert learned and not any(r.kept and r.base_failed for r in rows)
    good = [r for r in rows if truth[r.doc_id] and not r.base_failed]
    bad = [r for r in rows if not truth[r.doc_id]]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_rules_run_without_python(labelled, edge_docs, empty_docs, labels):
    docs, given, _ = labelled
    plan = rules.judged(docs, rules.fit(docs, given))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    assert rules.judged(edge_docs, rules.fit(edge_docs, labels)).count() == edge_docs.count()
    assert rules.judged(empty_docs, rules.fit(empty_docs, labels)).count() == 0


def test_covering_finds_a_conjunction():
    r = random.Random(8)
    rows = [(r.random(), r.random(), r.random()) for _ in range(3000)]
    bad = [a > 0.6 and b <= 0.4 for a, b, _ in rows]
    learned = rules.learn(rows, bad, ["a", "b", "c"])
    fires = lambda row: any(all(row["abc".index(f)] > t if op == ">" else row["abc".index(f)] <= t for f, op, t in x.conditions) for x in learned)
    assert np.mean([fires(row) == b for row, b in zip(rows, bad, strict=True)]) > 0.97


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(CHECKS) <= set(QUERIES)
