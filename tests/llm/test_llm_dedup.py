"""SimHash clusters and suffix-array dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tracewell.llm import simhash, suffix_dedup
from tracewell.llm.components import components
from tracewell.llm.suffix_sort import repeated


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def plain_clusters(rows):
    fps = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    of = roots(len(rows), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    least = {}
    for (doc_id, _), r in zip(rows, of, strict=True):
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    return sorted(((d is None, d or 0), f"{f:016x}", least[r]) for (d, _), f, r in zip(rows, fps.tolist(), of, strict=True))


@pytest.mark.parametrize("edge", [False, True])
def test_clusters(spark, sf_dir, edge_docs, edge):
    docs = edge_docs if edge else spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = simhash.digest(docs).collect()
    want = plain_clusters([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in got) == want


@pytest.mark.parametrize("block", [2048, 3])
def test_links_join_what_all_pairs_join(spark, block):
    r = random.Random(1)
    fps = set()
    for _ in range(150):
        x = r.getrandbits(64)
        for _ in range(r.randrange(8)):
            fps.add(x)
            for _ in range(r.randrange(1, 6)):
                x ^= 1 << r.randrange(64)
    fps = np.array(sorted(fps), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    of = roots(len(fps), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    sizes = Counter(of)
    signed = fps.view(np.int64).tolist()
    want = {frozenset(signed[i] for i in range(len(fps)) if of[i] == k) for k, n in sizes.items() if n > 1}
    found = components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), block)).collect()
    got = {}
    for node, root in found:
        got.setdefault(root, set()).add(node)
    assert {frozenset(v) for v in got.values()} == want and all(min(v) == k for k, v in got.items())


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(3).sample(range(n), n)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (7, 7)], "a long, b long")
    assert dict(components(edges).collect()) == dict.fromkeys(range(n), 0) | {1000: 1000, 1001: 1000}


def plain_kept(rows):
    """One row of each component: the smallest doc_id, none only where there is no other."""
    fps = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    of = roots(len(rows), zip(*np.nonzero(np.triu(near, 1)), strict=True))
    groups = {}
    for row, r in zip(rows, of, strict=True):
        groups.setdefault(r, []).append(row)
    return [min((d is None, d or 0) for d, _ in g) for g in groups.values()]


def test_one_document_of_each_group_stays(spark, sf_dir, edge_docs, empty_docs):
    for docs in (edge_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows, kept = docs.collect(), simhash.kept(docs)
        got = kept.collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(plain_kept([(r.doc_id, r.text) for r in rows]))
        assert kept.columns == docs.columns and set(got) <= set(rows)
    assert simhash.digest(empty_docs).count() == simhash.kept(empty_docs).count() == 0


def test_rows_that_repeat_a_doc_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(200)) for x in "abc")
    for rows, want in (
        ([(5, a), (5, b), (9, b + " end")], {(5, a), (5, b)}),
        ([(3, a), (5, a), (5, b)], {(3, a), (5, b)}),
        ([(5, a), (5, b), (4, b), (5, c), (5, c)], {(5, a), (4, b), (5, c)}),
        ([(None, a), (None, a), (None, b)], {(None, a), (None, b)}),
        ([(None, a), (7, a), (None, b)], {(7, a), (None, b)}),
    ):
        got = [tuple(r) for r in simhash.kept(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
        assert len(got) == len(want) and set(got) == want


def plain_removal(texts, width):
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = True
        edges = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        left = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), edges, hashlib.sha256(left).hexdigest()))
    return out


def removal_of(docs, width):
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest(docs, width).collect())


def test_suffix_sort_finds_repetitions():
    r = random.Random(2)
    for _ in range(1500):
        width = r.choice([1, 2, 3, 5, 8, 16, 24, 40])
        letters = r.choice([b"ab", b"\0\1", b"abcd", bytes(range(250, 256))])
        base = bytes(r.choice(letters) for _ in range(r.randrange(1, 120)))
        texts = []
        for _ in range(r.randrange(1, 7)):
            a = r.randrange(len(base))
            texts.append(base[a : a + r.randrange(90)] if r.random() < 0.6 else bytes(r.choice(letters) for _ in range(r.randrange(60))))
        seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
        assert [x.tolist() for x in repeated(texts, width)] == [[seen[t[i : i + width]] > 1 for i in range(len(t) - width + 1)] for t in texts]


@pytest.mark.parametrize("most_runs", [4096, 1])
def test_removal_on_mixed_texts(spark, monkeypatch, most_runs):
    monkeypatch.setattr(suffix_dedup, "MOST_RUNS", most_runs)
    r = random.Random(4)
    words = ["".join(r.choice("etaoinshré漢") for _ in range(r.randrange(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, page, texts = prose(45), prose(300), []
    for _ in range(40):
        texts.append(prose(60) + passage + prose(30))
    for _ in range(30):  # near copies
        w = page.split()
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [page] * 10 + ["ab" * 400, "x" * 700, prose(20), "", page[: len(page) // 2], passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert removal_of(docs, 200) == sorted(plain_removal([t.encode() for t in texts], 200))


def test_removal_of_edge_cases_and_given_documents(spark, sf_dir, edge_docs, empty_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for table in (docs, edge_docs.filter("n_chars < 20000")):
        texts = [(r.text or "").encode() for r in table.collect()]
        assert removal_of(table, 200) == sorted(plain_removal(texts, 200))
    assert suffix_dedup.digest(edge_docs).count() == edge_docs.count()
    assert suffix_dedup.digest(empty_docs).count() == suffix_dedup.deduplicated(empty_docs).count() == 0


def test_long_texts_are_looked_at_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRINGS_AT_A_TIME", 50)
    r = random.Random(6)
    page = "".join(r.choice("abcdef ") for _ in range(900))
    texts = [page + "one" + page[300:700], "two" + page[100:] + "x", page[::-1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert removal_of(docs, 200) == sorted(plain_removal([t.encode() for t in texts], 200))


def test_deduplicated_keeps_columns(edge_docs):
    out = suffix_dedup.deduplicated(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[2].text == "" and by_id[2].n_chars == 0 and by_id[4].text is None and by_id[9].text == "one"
