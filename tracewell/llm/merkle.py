"""Merkle manifest of a table of documents, on nested intervals.

Every node covers an interval of leaf ranks [low, high), and its children cover the parts of it. So nothing
points anywhere: a node is an ancestor of those whose intervals lie in its own, and what of a parent's
interval a child does not cover is its sibling's.

Levels are dealt with in bands. Two nodes of a band can only be nested where the first ranks of both,
without the band's bits, are equal; that bucket is the join key, and a bucket holds a bounded number of
nodes whatever the size of a tree. A tree of n leaves takes one shuffle of its nodes per band and way, the
second band having a thousandth of the first one's rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored
from .crc_sql import CRC_TABLE, crc32
from .ranks import ranked

#: Levels of a band; a bucket has at most 2^(BAND + 1) - 1 nodes.
BAND = 10
#: The tree above the subroots.
TOP = "top"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(c: Column) -> Column:
    """`-` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in (doc_id, source, lang, n_chars, text))).cast("binary"), 256)


def tree_of(lang: Column) -> Column:
    """A key for each language that sorts null first and others by their bytes."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("-"))


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return (n - 1).bit_length()


def bucketed(nodes: DataFrame, base: int, *more: str) -> DataFrame:
    """Rows of one band, those that can be nested side by side."""
    dealt = nodes.withColumn("bucket", F.shiftright("low", base + BAND)).select("tree", "bucket", "n", "level", "low", "high", "hash", *more)
    return dealt.repartition("tree", "bucket").sortWithinPartitions("tree", "bucket", "level", "low")


def groups(rows: Iterator[tuple], key: int) -> Iterator[list[tuple]]:
    now, held = None, []
    for row in rows:
        if row[:key] != now:
            if held:
                yield held
            now, held = row[:key], []
        held.append(row)
    if held:
        yield held


def nodes_above(leaves: DataFrame) -> DataFrame:
    """All nodes of the trees whose leaves are given (tree, n: the tree's leaves, low: a leaf's rank, hash): the leaves themselves and what is above.

    tree, n, level, low, high, hash. While a tree has several nodes, each two consecutive ones, or the
    last alone, become one node of the next level: the hash of their hashes.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    here = leaves.select("tree", "n", F.lit(0).alias("level"), "low", (F.col("low") + 1).alias("high"), "hash")
    parts = [here]

    def build(base: int) -> DataFrame:
        def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
            for members in groups(rows, 2):
                tree, _, n = members[0][:3]
                nodes = [m[4:7] for m in members]
                for level in range(base + 1, min(base + BAND, height(n)) + 1):
                    pairs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
                    nodes = [(p[0][0], p[-1][1], sha("".join(x[2] for x in p))) for p in pairs]
                    for low, high, digest in nodes:
                        yield tree, n, level, low, high, digest

        return map_rows(bucketed(here, base), rows, "tree string, n long, level int, low long, high long, hash string")

    for base in range(0, height(most), BAND):
        built = stored(build(base), "nodes")
        parts.append(built)
        here = built.filter((F.col("level") == base + BAND) & (F.expr(f"n > shiftleft(1L, {base + BAND})")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def ancestors(members: list[tuple]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Each node (level, low, high, …) with those of the same bucket that contain it, from the nearest on.

    In the order of intervals, wider and higher ones first, what contains a node is what is still open.
    """
    open_: list[tuple] = []
    for node in sorted(members, key=lambda m: (m[1], -m[2], -m[0])):
        while open_ and open_[-1][2] <= node[1]:
            open_.pop()
        yield node, open_[::-1]
        open_.append(node)


def steps_within(members: list[tuple], base: int) -> Iterator[tuple[tuple, list[str]]]:
    """Each node of the band's lowest level with its way up to the bucket's top.

    A step is `<` or `>` and the hash of the sibling to the left or right, or `=` where the parent's
    interval is the child's own.
    """
    at = {(m[0], m[1], m[2]): m[3] for m in members}
    for node, above in ancestors(members):
        if node[0] == base:
            steps, (level, low, high) = [], node[:3]
            for parent in above:  # the parent's interval without the child's is the sibling's
                if parent[1] < low:
                    steps.append("<" + at[level, parent[1], low])
                elif high < parent[2]:
                    steps.append(">" + at[level, high, parent[2]])
                else:
                    steps.append("=")
                level, low, high = parent[:3]
            yield node, steps


def folded(leaf: str, steps: list[str]) -> str:
    for step in steps:
        leaf = sha(step[1:] + leaf if step[0] == "<" else leaf + step[1:])
    return leaf


def levels(n: str = "n") -> str:
    return f"case when {n} <= 1 then 0 else length(bin({n} - 1)) end"


def ways(nodes: DataFrame, ends: DataFrame, leaves: DataFrame | None = None, finish: Callable[..., Iterator[tuple]] | None = None, schema: str = "") -> DataFrame:
    """What finish(node, steps, to, payload) yields for each leaf, with its steps to the root of its tree and on.

    ends: tree, steps (joined by blanks) from the tree's root on, and `to`, a text that goes with them.
    leaves: the nodes of level 0 again, with a `payload`. From the top band down: how a bucket's top goes on
    is known from the band above or, where it is the tree's root, from `ends`. That is one row, joined
    where its interval contains the bucket and handed to all nodes in it. Without finish: tree, low, hash,
    steps and `to` of each leaf.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    found = None
    for base in reversed(range(0, max(1, height(most)), BAND)):
        band = nodes.filter(F.col("level").between(base, base + BAND)).filter(f"{base} = 0 or n > shiftleft(1L, {base})")
        tops = band.withColumn("n_levels", F.expr(levels())).filter(f"level = least({base + BAND}, n_levels)")
        heads = tops.filter(f"n_levels <= {base + BAND}").join(ends, "tree").select("tree", "n", "low", "steps", "to")
        if found is not None:
            higher = tops.filter(f"n_levels > {base + BAND}").select("tree", "n", "low")
            heads = heads.unionAll(higher.join(found.select("tree", "low", "steps", "to"), ["tree", "low"]).select(heads.columns))
        if base == 0 and leaves is not None:
            band = leaves.unionByName(band.filter("level > 0"), allowMissingColumns=True)
        last = base == 0 and finish is not None

        def rows(rows: Iterator[tuple], base: int = base, last: bool = last) -> Iterator[tuple]:
            for _, *members in groups(rows, 2):  # first the head
                steps_on, to = _[7:9]
                for node, steps in steps_within([m[3:] for m in members], base):
                    steps = steps + [steps_on] if steps_on else steps
                    if last:
                        yield from finish(node[3], " ".join(steps), to, node[6] if len(node) > 6 else None)
                    else:
                        yield members[0][0], node[1], node[3], " ".join(steps), to

        # The head comes first in its bucket, as a node below all levels.
        dealt = bucketed(heads.withColumn("level", F.lit(-1)).unionByName(band, allowMissingColumns=True), base, "steps", "to", *(["payload"] if "payload" in band.columns else []))
        found = map_rows(dealt, rows, schema if last else "tree string, low long, hash string, steps string, to string", 1024)
        if base:
            found = stored(found, "ways")
    return found


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The leaves, the nodes of the languages' trees and the nodes above them.

    Leaves: tree, doc_id, leaf (the hash of the row), tampered (what it would be with one more in n_chars,
    null unless 7 divides the CRC-32 of the id), low (the leaf's rank in its tree) and n. Rows without a
    language are a tree of their own, before the others; rows without a doc_id come first in theirs; rows
    that repeat one are told apart by their hashes, and alike ones stand next to each other. Other columns
    are ignored.
    """
    doc_id, source, lang, n_chars, text = (F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    tampered = F.when(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, leaf_hash(doc_id, source, lang, n_chars.cast("decimal(38,0)") + 1, text))
    rows = docs.select(tree_of(lang).alias("tree"), doc_id.cast("long").alias("doc_id"), leaf_hash(doc_id, source, lang, n_chars, text).alias("leaf"), tampered.alias("tampered"))
    rows = stored(rows, "leaves")
    places = ranked(rows, ["tree"], ["doc_id", "leaf"], "low")
    sizes = stored(rows.groupBy("tree").agg(F.count("*").alias("n")), "sizes")
    leaves = stored(places.join(sizes, "tree"), "ranked")
    nodes = stored(nodes_above(leaves.withColumnRenamed("leaf", "hash")), "manifest")
    subroots = nodes.filter("low = 0 and high = n").groupBy("tree").agg(F.max_by("hash", "level").alias("hash"))
    places = ranked(stored(subroots, "subroots"), [], ["tree"], "low")
    top = stored(places.select(F.lit(TOP).alias("tree"), "low", "hash", F.col("tree").alias("of")), "top-leaves")
    top = top.crossJoin(F.broadcast(top.agg(F.count("*").alias("n"))))  # one row
    return leaves, nodes, top


def digest(docs: DataFrame) -> DataFrame:
    """Of every row of docs: its leaf, its tree's root (subroot), the root of all, its proof and what the proof leads to.

    proof_sha256 is the hash of the siblings on the way to the root. folded_root is recomputed from the
    tampered leaf where there is one; verified says whether it is the root. An empty table has no rows.
    """
    leaves, nodes, top = manifest(docs)
    above = stored(nodes_above(top.drop("of")), "manifest")
    root = above.filter("low = 0 and high = n").agg(F.max_by("hash", "level").alias("to"))
    over = ways(above, root.select(F.lit(TOP).alias("tree"), F.lit("").alias("steps"), "to"))
    # On from a subroot: the steps, and with them the subroot and the root.
    ends = over.join(top.select("low", "of"), "low").select(F.col("of").alias("tree"), "steps", F.concat_ws(" ", "hash", "to").alias("to"))
    payload = leaves.select("tree", "n", F.lit(0).alias("level"), "low", (F.col("low") + 1).alias("high"), F.col("leaf").alias("hash"), F.struct("doc_id", "tampered").alias("payload"))

    def finish(leaf: str, steps: str, to: str, row: dict) -> Iterator[tuple]:
        way, (subroot, root) = steps.split(), to.split()
        reached = folded(row["tampered"] or leaf, way)
        yield row["doc_id"], leaf, subroot, root, sha("".join(s[1:] for s in way)), reached, reached == root

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return ways(nodes, stored(ends, "ends"), payload, finish, schema)


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _tree(name: str, leaves: str) -> str:
    return f"""{name}(tree, pos, hash, n) AS (SELECT tree, pos, hash, n FROM {leaves}
    UNION ALL SELECT tree, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, pos // 2, n)"""


def _way(name: str, begin: str, tree: str) -> str:
    fold = "CASE WHEN s.hash IS NULL THEN sha256(w.fold) WHEN w.pos % 2 = 1 THEN sha256(s.hash || w.fold) ELSE sha256(w.fold || s.hash) END"
    return f"""{name}(id, tree, pos, n, proof, fold) AS ({begin}
    UNION ALL SELECT w.id, w.tree, w.pos // 2, (w.n + 1) // 2, w.proof || coalesce(s.hash, ''), {fold}
    FROM {name} AS w LEFT JOIN {tree} AS s ON s.tree = w.tree AND s.n = w.n AND s.pos = xor(w.pos, 1) WHERE w.n > 1)"""


CHECK = f"""
WITH RECURSIVE c32 AS ({CRC_TABLE}),
d AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS hash,
             CASE WHEN {crc32("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS tampered FROM documents, c32),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
{_tree("lv", "l")},
r AS (SELECT tree AS lang, '' AS tree, hash, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
{_tree("tp", "r")},
{_way("w1", "SELECT id, tree, pos, n, '' AS proof, coalesce(tampered, hash) AS fold FROM l", "lv")},
{_way("w2", "SELECT w1.id, '', r.pos, r.n, w1.proof, w1.fold FROM w1 JOIN r ON r.lang = w1.tree WHERE w1.n = 1", "tp")}
SELECT l.doc_id, l.hash AS leaf, r.hash AS subroot, tp.hash AS root, sha256(w2.proof) AS proof_sha256, w2.fold AS folded_root, w2.fold = tp.hash AS verified
FROM l JOIN w2 ON w2.id = l.id AND w2.n = 1 JOIN r ON r.lang = l.tree CROSS JOIN tp WHERE tp.n = 1
"""
