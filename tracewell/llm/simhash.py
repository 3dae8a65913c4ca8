"""Near copies by SimHash: candidates from pigeonring filtering, an exact Hamming check, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, map_rows, stored
from .components import components

SEED = 42
#: Shingles whose bits are counted at a time.
SHINGLES_AT_A_TIME = 8192
#: 64 bits in a ring of five segments: with at most 4 differing bits, the mean is below one a segment.
RING = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each of the text's shingles, repeats included; of all words where there are no more than `width`."""
    import xxhash

    words = (text or "").encode().lower().split()  # of bytes: only A to Z, and only ASCII white space
    if not words:
        return np.zeros(0, "<u8")
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([hash64(b" ".join(words), SEED)], "<u8")
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: -width] + 1]).tolist()
    return np.fromiter((hash64(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)), "<u8", len(starts))


def fingerprint(text: str | None, width: int = 4) -> int:
    """Bits that are set in over half the XXH64 of the text's shingles, repeats included; zero without words."""
    hashes = shingle_hashes(text, width)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_A_TIME):
        counts += np.unpackbits(hashes[at : at + SHINGLES_AT_A_TIME].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of each row."""

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            fp = fingerprint(text, width)
            yield doc_id, fp - (1 << 64) if fp >> 63 else fp

    return map_rows(doc_texts(docs), rows, "doc_id long, fp long")


def ring_keys(fp: str = "fp") -> str:
    """The keys under which two fingerprints with at most 4 differing bits must meet, as an array.

    In a ring of five segments with at most 4 differences in all, some segment begins a chain whose first k
    segments have less than k differences together, for every k (else the chains' excesses would add up to
    more than there is). So the first segment of the chain is equal in both and the second differs in at
    most one bit, that is, one of its halves is equal too. A key is the segment's place, its bits, which
    half of the next one, and the half's bits.
    """
    keys = []
    for i, (at, size) in enumerate(RING):
        after, more = RING[(i + 1) % len(RING)]
        low = more // 2
        for half, (begin, bits) in enumerate(((after, low), (after + low, more - low))):
            first = f"(shiftrightunsigned({fp}, {at}) & {(1 << size) - 1}L)"
            next_one = f"(shiftrightunsigned({fp}, {begin}) & {(1 << bits) - 1}L)"
            keys.append(f"shiftleft({first}, 16) + shiftleft({next_one}, 4) + {2 * i + half}L")
    return f"array({', '.join(keys)})"


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def chains(x: np.ndarray, start: int) -> np.ndarray:
    """Which differences keep within the budget of every chain that begins at segment `start`: less than k in k segments."""
    total, fits = np.zeros(x.shape, np.uint8), np.ones(x.shape, bool)
    for k in range(len(RING)):
        at, size = RING[(start + k) % len(RING)]
        total = total + np.bitwise_count(x >> np.uint64(at) & np.uint64((1 << size) - 1))
        fits &= total <= k
    return fits


def forest(links: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> Iterator[tuple[int, int]]:
    """Of the links between n things, those that join what was apart."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for left, right in links:
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield i, j


def linked(fps: np.ndarray, start: int, most: int, rows_at_a_time: int = 256) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among fingerprints that share a key of chain `start`."""

    def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(fps), rows_at_a_time):
            x = fps[at : at + rows_at_a_time, None] ^ fps[None, at:]
            i, j = np.nonzero(np.triu(np.ones(x.shape, bool), 1) if most > 4 else np.triu(chains(x, start), 1))
            near = np.bitwise_count(x[i, j]) <= most
            yield i[near] + at, j[near] + at

    yield from forest(links(), len(fps))


def links(fps: DataFrame, block: int = 2048) -> DataFrame:
    """a, b: enough pairs of distinct fingerprints (column fp) with at most 4 differing bits to join all that such pairs join.

    Every fingerprint goes under its ten keys (see `ring_keys`). A key with many fingerprints is cut into
    blocks by a hash, and every two of its blocks meet in a group of their own, so groups are bounded and
    none is left out. A group compares its members in rows, keeps pairs whose chains stay within their
    budgets, checks their Hamming distance, and hands on a spanning forest of the links, fewer than members.
    """
    keyed = fps.select("fp", F.explode(F.expr(ring_keys())).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    sizes = stored(sizes, "sizes")  # so that adaptive execution splits a hot key in the join
    placed = keyed.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
    groups = placed.select("fp", "key", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    grouped = groups.select("fp", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    dealt = grouped.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        def found(key: tuple, members: list[int]) -> Iterator[tuple]:
            if len(members) > 1:
                fps = np.array(members, np.int64).view(np.uint64)
                for i, j in linked(fps, (key[0] & 15) // 2, 4):
                    yield members[i], members[j]

        now, members = None, []
        for fp, *key in rows:
            if key != now:
                yield from found(now, members)
                now, members = key, []
            members.append(fp)
        yield from found(now, members)

    return map_rows(dealt, rows, "a long, b long").distinct()


def clusters(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id, fp and component_id of each row of docs: the smallest doc_id that links lead to.

    Documents whose fingerprints differ in at most 4 of 64 bits are linked; equal fingerprints are one node,
    so groups of copies of any size cost one row. A null or empty text has fingerprint zero and is linked
    like any other. Rows that repeat a doc_id count each; a row without one is given its component's
    smallest (null if none has any). Other columns are ignored.
    """
    prints = stored(fingerprints(docs, width), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    roots = components(links(nodes.select("fp")))
    joined = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    joined = stored(joined, "roots")
    smallest = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = joined.join(smallest, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return clusters(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def kept(docs: DataFrame, width: int = 4) -> DataFrame:
    """docs without near copies: of each component of fingerprints (see `clusters`) one row stays, whole and as it was.

    The row with the smallest doc_id stays, one without a doc_id only where its component has no other; of
    several, that with the smallest hash of its columns, and one of rows that are alike. Texts without words
    (null ones too) have fingerprint zero and are copies of each other. Only fingerprints and hashes are
    compared; the texts move once, to meet the rows chosen.
    """
    hashable = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    values = [*hashable, *(c.isNull() for c in hashable)]
    marked = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(*values).alias("r1"),
        F.xxhash64(F.lit(1), *values).alias("r2"),
    )

    def rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, r1, r2, text in rows:
            fp = fingerprint(text, width)
            yield doc_id, r1, r2, fp - (1 << 64) if fp >> 63 else fp

    texts = marked.select("id", "r1", "r2", F.col("doc.text").cast("string").alias("text"))
    prints = stored(map_rows(texts, rows, "id long, r1 long, r2 long, fp long"), "fingerprints")
    least = stored(prints.groupBy("fp").agg(F.expr("min(struct(id is null, id, r1, r2))").alias("least")), "nodes")
    roots = components(links(least.select("fp")))
    rooted = least.join(roots, least.fp == roots.node, "left").select(F.coalesce("root", "fp").alias("root"), "least")
    chosen = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.r1", "least.r2")
    # Rows with equal hashes are alike, so they are in one component, and one of them stays.
    return marked.join(stored(chosen, "chosen"), ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]).select("doc.*")
