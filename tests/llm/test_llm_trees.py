"""The conversation trie and the Merkle manifest against brute force and against SQL."""

import hashlib
import math
import random
import re
import zlib

import pytest
from compare import connect, differences

from tracewell.llm import merkle, prefix_trie, queries
from tracewell.llm.common import stored
from tracewell.llm.ranks import ranked

COLUMNS = "conv_id long, turn long, role string, text string, name string, k long, block long, _range int, depth string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def order(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_merkle_manifest"])
def test_queries_match_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.CHECKS[name]) == []


def test_places_of_hot_and_alike_rows(spark):
    r = random.Random(2)
    rows = [(r.choice("aaab"), r.choice([None, 1, 2, 3]), r.randrange(2)) for _ in range(3000)]
    df = stored(spark.createDataFrame(rows, "g string, x long, y long").repartition(7), "rows")
    got = ranked(df, ["g"], ["x", "y"], "place").collect()
    for g in "ab":
        want = sorted(((x is not None, x or 0, y) for h, x, y in rows if h == g))
        have = sorted((p, (x is not None, x or 0, y)) for h, x, y, p in got if h == g)
        assert [p for p, _ in have] == list(range(len(want))) and [x for _, x in have] == want


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in own.items()}
    members = {}
    lengths = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(math.fmod(c, 20))
        sequence = own.get(base, [])[:h] + turns[h:]
        lengths[c] = len(sequence)
        for d in range(len(sequence) + 1):
            members.setdefault(tuple(sequence[:d]), []).append(c)
    out = []
    for p, convs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        children = {q for q in under if len(q) == len(p) + 1}
        leaves = sum(not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in under) for q in under)
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in under if q)
        ends = ",".join(map(str, sorted(c for c in convs if lengths[c] == len(p))))
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(children), leaves, saved, sha(ends)))
    return sorted(out, key=order)


def trie_rows(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, prefix_trie.trie(df).select(columns).collect()), key=order)


def wide(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], COLUMNS)


def test_trie_of_random_conversations(spark):
    r = random.Random(1)
    for depth, letters in ((9, "ab"), (33, "a")):
        rows = []
        for c in r.sample(range(-60, 200), 60):
            rows += [(c, t, "user" if t % 2 else None, r.choice(letters) * r.randrange(2) + " x") for t in range(r.randrange(depth))]
        r.shuffle(rows)
        assert trie_rows(wide(spark, rows).repartition(5)) == plain_trie(rows)


def test_trie_of_edge_cases(spark):
    rows = [(20, None, None, None), (20, 2, "user", " \t\n one  two "), (20, 1, "user", "漢字 é\xa0x"), (21, None, "", ""), (None, 1, "user", "lost")]
    rows += [(40 + i, 1, "user", "same") for i in range(40)] + [(7, t, "a", "long " * 3000) for t in range(70)] + [(60, 1, "user", "same")] * 3
    assert trie_rows(wide(spark, rows)) == plain_trie(rows)
    assert trie_rows(wide(spark, [])) == []
    assert trie_rows(wide(spark, [(20, None, None, None)])) == plain_trie([(20, None, None, None)])


def test_ends_of_a_node_with_many_members(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_A_ROW", 7)
    members = spark.createDataFrame([(1, 3, c) for c in range(1, 500)] + [(2, 3, 9), (1, 2, 1), (1, 2, -5)], "conv_id long, depth long, conv long").repartition(6)
    got = {(r.conv_id, r.depth): r.ends_sha256 for r in prefix_trie.ends_of(members).collect()}
    assert got == {(1, 3): sha(",".join(map(str, range(1, 500)))), (2, 3): sha("9"), (1, 2): sha("-5,1")}


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(r, more=0):
    return sha(*map(field, (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_way(levels, at):
    for level in levels[:-1]:
        yield at % 2 == 1, level[at ^ 1] if at ^ 1 < len(level) else ""
        at //= 2


def plain_manifest(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r)))
    levels = {lang: plain_levels([plain_leaf(r) for r in trees[lang]]) for lang in langs}
    top = plain_levels([levels[lang][-1][0] for lang in langs])
    for k, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            way = [*plain_way(levels[lang], i), *plain_way(top, k)]
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            reached = plain_leaf(r, 1 if tampered else 0)
            for left, other in way:
                reached = sha(other, reached) if left else sha(reached, other)
            yield r.doc_id, plain_leaf(r), levels[lang][-1][0], top[-1][0], sha(*(o for _, o in way)), reached, reached == top[-1][0]


@pytest.mark.parametrize("band", [10, 1, 3])
def test_manifest(spark, edge_docs, empty_docs, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    r = random.Random(band)
    rows = [(r.choice([None, *range(400)]), r.choice(["x", None]), r.choice([None, "", "en", "en", "en", "é", "漢", "z"]), r.choice([None, 5, 2**63 - 1]), "t" * r.randrange(4)) for _ in range(300)]
    rows += [rows[0]] * 40 + [(i, "s", f"lang{i}", 1, "alone") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    for table in (docs, edge_docs):
        got = [tuple(x) for x in merkle.digest(table).collect()]
        assert sorted(got, key=order) == sorted(plain_manifest(table.collect()), key=order)
    assert merkle.digest(empty_docs).count() == 0
    one = merkle.digest(docs.limit(1)).collect()
    assert len(one) == 1 and one[0].subroot == one[0].root == one[0].leaf


def test_nodes_cover_nested_intervals(spark, sf_dir):
    _, nodes, _ = merkle.manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = nodes.collect()
    by_level = {(r.tree, r.level, r.low): r for r in rows}
    for r in rows:
        assert r.low % (1 << r.level) == 0 and r.high == min(r.n, r.low + (1 << r.level))
        if r.level:
            children = [by_level[c] for c in ((r.tree, r.level - 1, r.low), (r.tree, r.level - 1, r.low + (1 << (r.level - 1)))) if c in by_level]
            assert r.hash == sha(*(c.hash for c in children)) and children[-1].high == r.high
