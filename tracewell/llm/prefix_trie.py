"""The prefix trie of conversations, by van Emde Boas recursion.

Sequences are cut at half depth. The first halves make an upper trie; what each distinct first half, the
name of its cut, is followed by makes a lower trie under it. Both are cut in the same way, all of a size at
once, so a trie of depth D takes as many rounds as D has bits, in three passes:

- names of blocks, from single turns up: a block of 2^(j+1) turns is named by its two halves;
- names of cuts, from the whole down: the lower tries of a round stand under what their upper trie's name
  and the block in it are named together, until every prefix has its name;
- totals, from small tries up: what the lower tries of a round sum up to is grafted on the nodes of the
  upper trie above their cuts, which are the prefixes of the cut's smallest conversation.

No step brings a conversation or a node's members together: rows are (conversation, block), (conversation,
depth) and (node, sum), so a conversation or a beginning that makes up a third of all rows is split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored
from .crc_sql import CRC_TABLE, crc32
from .ranks import ranked

WORDS = r"[^\\x20\\x09-\\x0D]+"
#: The name of the empty prefix.
ROOT = bytes(16)
#: Ids that are written out together before they are hashed.
IDS_A_ROW = 4096
#: Rounds of cuts that are planned together.
ROUNDS_A_PLAN = 6
NONE = hashlib.sha256().hexdigest()


def name(*parts: Column | str) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def rebuilt(conversations: DataFrame, family: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations (conv, length) and their turns (conv, pos from 0, name, words).

    Conversation c begins with the first h turns of conversation c - c % family and goes on with its own
    after the first h; h is the CRC-32 of its id modulo `shared`. % truncates, as in SQL. Turns are in
    order of their number, those without one first; equal ones by the hash of role and text. A null role
    or text is empty. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        name(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("name"),
        F.expr(f"regexp_count(coalesce(cast(text as string), ''), '{WORDS}')").cast("long").alias("words"),
    )
    turns = stored(ranked(stored(turns, "turns"), ["conv"], ["turn", "name"], "k").drop("turn"), "turns")
    sizes = stored(turns.groupBy("conv").agg(F.count("*").alias("n")), "sizes")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    first = sizes.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    given = F.least("h", F.coalesce("m", F.lit(0))).alias("given")
    convs = first.join(sizes.selectExpr("conv base", "n m"), "base", "left").select("conv", "base", "h", given, F.expr("least(h, coalesce(m, 0)) + greatest(n - h, 0)").alias("length"))
    convs = stored(convs, "conversations")
    heads = turns.filter(f"conv % {family} = 0 and k < {shared}").withColumnRenamed("conv", "base").join(convs.select("conv", "base", "h"), "base").filter("k < h")
    own = turns.join(convs.select("conv", "h", "given"), "conv").filter("k >= h")
    rows = heads.selectExpr("conv", "k pos", "name", "words").unionAll(own.selectExpr("conv", "given + k - h pos", "name", "words"))
    return convs.select("conv", "length"), stored(rows, "sequences")


def prefixes(convs: DataFrame, turns: DataFrame, rounds: int) -> DataFrame:
    """conv, depth and name of every prefix of every conversation, the empty one included."""
    blocks = [turns.selectExpr("conv", "pos block", "name")]
    for _ in range(1, rounds):
        half = "max(if(block % 2 = {}, name, null))"
        pairs = blocks[-1].groupBy("conv", F.expr("shiftright(block, 1)").alias("block")).agg(F.expr(half.format(0)).alias("a"), F.expr(half.format(1)).alias("b"))
        blocks.append(stored(pairs.filter("a is not null and b is not null").select("conv", "block", name("a", "b").alias("name")), "blocks"))
    cuts = convs.select("conv", F.lit(0).cast("long").alias("block"), F.lit(ROOT).alias("name"))
    for done, upper in enumerate(reversed(blocks), 1):
        upper = upper.filter("block % 2 = 0").selectExpr("conv", "shiftright(block, 1) block", "name upper")
        below = F.when(F.col("upper").isNotNull(), F.struct((2 * F.col("block") + 1).alias("block"), name("name", "upper").alias("name")))
        both = F.array_compact(F.array(F.struct((2 * F.col("block")).alias("block"), "name"), below))
        cuts = cuts.join(upper, ["conv", "block"], "left").select("conv", F.inline(both))
        if done % ROUNDS_A_PLAN == 0 or done == len(blocks):
            cuts = stored(cuts, "cuts")
    return cuts.withColumnRenamed("block", "depth")


def ends_of(members: DataFrame) -> DataFrame:
    """conv_id, depth and ends_sha256 of each node (conv_id, depth) that conversations (conv) end at.

    Ids are sorted over all tasks and written out in rows of thousands; one node's rows are then hashed as
    they come, since the hash of a list has to be taken in its order.
    """

    def written(rows: Iterator[tuple]) -> Iterator[tuple]:
        node, ids = None, []
        for conv_id, depth, conv in rows:
            if (conv_id, depth) != node or len(ids) == IDS_A_ROW:
                if ids:
                    yield *node, ids[0], ",".join(map(str, ids))
                node, ids = (conv_id, depth), []
            ids.append(conv)
        if ids:
            yield *node, ids[0], ",".join(map(str, ids))

    def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
        node, state = None, None
        for conv_id, depth, _, ids in rows:
            if (conv_id, depth) == node:
                state.update(f",{ids}".encode())
                continue
            if node:
                yield *node, state.hexdigest()
            node, state = (conv_id, depth), hashlib.sha256(ids.encode())
        if node:
            yield *node, state.hexdigest()

    keys = ["conv_id", "depth", "conv"]
    lists = map_rows(members.select(keys).repartitionByRange(*keys).sortWithinPartitions(*keys), written, "conv_id long, depth long, first long, ids string", 16)
    dealt = lists.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return map_rows(dealt, hashed, "conv_id long, depth long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A conversation whose rebuilt sequence is empty is a member of the root. Without conversations there
    are no nodes. Turns that repeat a number all count (see `rebuilt`). Other columns are ignored.
    """
    convs, turns = rebuilt(conversations)
    rounds = int(convs.agg(F.max("length")).first()[0] or 0).bit_length()
    named = prefixes(convs, turns, rounds)
    nodes = stored(named.groupBy("name").agg(F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs")), "nodes")
    # From now on a node is its smallest member and its depth.
    paths = stored(named.join(nodes.select("name", "conv_id"), "name").select("conv", "depth", "conv_id"), "paths")
    parents = paths.selectExpr("conv conv_id", "depth + 1 depth", "conv_id parent_conv_id")
    last = turns.selectExpr("conv conv_id", "pos + 1 depth", "words")
    nodes = stored(nodes.drop("name").join(parents, ["conv_id", "depth"], "left").join(last, ["conv_id", "depth"], "left"), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = F.coalesce((F.col("n_convs") - 1) * F.col("words"), F.lit(0).cast("long"))
    nodes = stored(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": own}).drop("words"), "nodes")

    for j in range(rounds):
        half = 1 << j
        cuts = nodes.filter(f"depth % {2 * half} = {half}").selectExpr("conv_id conv", f"shiftright(depth, {j + 1}) block", "n_leaves a", "saved_tokens b")
        upper = paths.filter(f"depth % {2 * half} < {half}").withColumn("block", F.shiftright("depth", j + 1))
        grafts = upper.join(cuts, ["conv", "block"]).groupBy("conv_id", "depth").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        more = {c: F.col(c) + F.coalesce(x, F.lit(0)) for c, x in (("n_leaves", "a"), ("saved_tokens", "b"))}
        nodes = stored(nodes.join(grafts, ["conv_id", "depth"], "left").withColumns(more).drop("a", "b"), "nodes")

    members = paths.join(convs.selectExpr("conv", "length depth"), ["conv", "depth"])
    ended = nodes.join(ends_of(members), ["conv_id", "depth"], "left")
    kinds = [F.col(c).cast("long") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    return ended.select(*kinds, F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"))


CHECK = f"""
WITH c32 AS ({CRC_TABLE}),
t AS (SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT *, {crc32("conv")} % 4 AS h, conv - conv % 20 AS base FROM (SELECT conv, count(*) AS n FROM t GROUP BY conv), c32),
g AS (SELECT c.conv, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS given FROM c LEFT JOIN c AS b ON b.conv = c.base),
s AS (SELECT g.conv, t.k AS pos, t.role, t.text FROM g JOIN t ON t.conv = g.base AND t.k < g.h
      UNION ALL SELECT g.conv, g.given + t.k - g.h, t.role, t.text FROM g JOIN t ON t.conv = g.conv AND t.k >= g.h),
p AS (SELECT conv, pos + 1 AS depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
             string_agg(md5(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv ORDER BY pos) AS path FROM s
      UNION ALL SELECT conv, 0, 0, '' FROM c),
n AS (SELECT path, depth, min(conv) AS conv_id, count(*) AS n_convs, max(words) AS words FROM p GROUP BY path, depth),
k AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
o AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n_convs - 1) * words AS tokens FROM n LEFT JOIN k USING (path)),
a AS (SELECT u.path, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum(d.tokens) AS saved_tokens
      FROM o AS u JOIN o AS d ON d.depth >= u.depth AND left(d.path, 32 * u.depth) = u.path GROUP BY u.path),
e AS (SELECT path, sha256(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv)) AS ends
      FROM (SELECT conv, max_by(path, depth) AS path FROM p GROUP BY conv) GROUP BY path)
SELECT o.conv_id, CAST(o.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, a.n_leaves,
       CAST(a.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM o JOIN a USING (path) LEFT JOIN e USING (path) LEFT JOIN o AS u ON o.depth > 0 AND u.path = left(o.path, 32 * (o.depth - 1))
"""
