"""Suffix-array dedup: bytes covered by a string of 200 bytes that also begins elsewhere.

Suffixes are sorted by a difference cover (suffix_sort), in buckets. The bucket of a 200-byte string is the
smallest hash of the 32-byte strings in it, its anchor: equal strings have equal anchors, so each bucket can
be sorted by itself. Consecutive strings with one anchor, a run, travel together as one row, about one for
every 90 bytes of text.

What need not be sorted is left out first, without loss. A run whose anchor occurs nowhere else repeats
nothing. A run whose bytes occur as a whole elsewhere repeats everything. Only where runs share an anchor
and differ are their bytes sorted, each different run once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, row_udf, stored
from .suffix_sort import repeated

#: Bytes of an anchor, and strings of a text that are looked at together.
ANCHOR = 32
STRINGS_AT_A_TIME = 1 << 20
#: Bytes that are sorted together (a bucket is never parted), and the most runs of a bucket that is.
SORTED_TOGETHER = 1 << 18
MOST_RUNS = 4096

_random = np.random.default_rng(20)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = _random.integers(0, 2**63, 5, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from each position on, by doubling."""
    h, m = _BYTE[data], 1
    for step in _STEP:
        h = h[:-m] * step + h[m:]
        h ^= h >> np.uint64(31)
        m *= 2
    return h


def smallest_in(h: np.ndarray, width: int) -> np.ndarray:
    m = 1
    while 2 * m <= width:
        h = np.minimum(h[:-m], h[m:])
        m *= 2
    return np.minimum(h[: len(h) - (width - m)], h[width - m :]) if m < width else h


def runs(data: bytes, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, hash of the run's bytes, first string, last string) of every run of a text.

    A string's anchor is the leftmost smallest hash in it. No string occurs twice in a run: its anchor
    would lie at two distances from its beginning.
    """
    import xxhash

    strings = len(data) - width + 1
    for begin in range(0, strings, STRINGS_AT_A_TIME):
        end = min(begin + STRINGS_AT_A_TIME, strings)
        h = anchor_hashes(np.frombuffer(data, np.uint8, end - begin + width - 1, begin))
        least = smallest_in(h, width - ANCHOR + 1)
        changes = (least[1:] != least[:-1]) | (h[: len(least) - 1] == least[:-1])
        first = np.flatnonzero(np.concatenate([[True], changes]))
        last = np.concatenate([first[1:], [len(least)]]) - 1
        anchors = least[first].view(np.int64).tolist()
        for anchor, a, b in zip(anchors, (first + begin).tolist(), (last + begin).tolist(), strict=True):
            digest = xxhash.xxh3_64_intdigest(data[a : b + width])
            yield anchor, digest - (1 << 64) if digest >> 63 else digest, a, b


def joined(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Spans of bytes, those that touch or overlap as one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def removed(docs: DataFrame, value: Callable[[str, list[list[int]]], str | None], width: int = 200, all_texts: bool = False) -> DataFrame:
    """docs' rows, all columns but text as `_row`, with `spans`: what is to be removed of the text, as an array of [start, end) in UTF-8 bytes.

    `value` is what the function of that name makes of the text (null counts as empty) and the spans of a
    row with a repeated string; of other rows it is the text if all_texts, else null. Texts shorter than
    width, among them empty ones, have no spans. Rows that repeat a text repeat each other, so all of it
    goes from each of them (if it has width bytes).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # 128 bits for a text; of two texts with one key the same would be removed.
    named = docs.select(F.struct(*others, F.col("text").isNull().alias("_no_text")).alias("_row"), text.alias("_text"))
    named = named.withColumns({"k1": F.xxhash64("_text"), "k2": F.xxhash64(F.lit(1), "_text")})

    def text_runs(rows: Iterator[tuple]) -> Iterator[tuple]:
        for k1, k2, text in rows:
            for anchor, digest, first, last in runs(text.encode(), width):
                yield k1, k2, anchor, digest, first * width + last - first

    texts = named.filter(F.octet_length("_text") >= width).select("k1", "k2", "_text")
    found = stored(map_rows(texts, text_runs, "k1 long, k2 long, anchor long, bytes long, at long", 65536), "runs")
    # Most anchors occur once; of their runs only the anchor is shuffled a first time.
    # Counts are stored before they are joined: adaptive execution then splits a hot key of the other side.
    twice = stored(found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
    shared = stored(found.join(twice, "anchor", "left_semi"), "shared-runs")

    # Per different run: how often it occurs, and one of its occurrences. Per anchor: its different runs.
    tag = F.xxhash64("k1", "k2", "at")
    kinds = stored(shared.groupBy("anchor", "bytes").agg(F.count("*").alias("n"), F.min(tag).alias("chosen")), "kinds")
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("n_kinds"), F.min("n").alias("rarest"))
    anchors = stored(anchors.select("anchor", F.expr("n_kinds > 1 and rarest = 1").alias("mixed"), (F.col("n_kinds") > MOST_RUNS).alias("large")), "buckets")
    # sorts: the run's bytes are to be sorted; alone: its repetitions are not known yet.
    first = F.floor(F.col("at") / width).cast("int")
    run = {"first": first, "last": (first + F.col("at") % width).cast("int"), "anchor": F.col("anchor"), "bytes": F.col("bytes"), "sorts": F.col("mixed") & (tag == F.col("chosen")), "alone": F.col("n") == 1, "large": F.col("large")}
    marked = shared.join(kinds.join(anchors, "anchor"), ["anchor", "bytes"]).select("k1", "k2", F.struct(*(v.alias(k) for k, v in run.items())).alias("run"))
    lists = stored(marked.groupBy("k1", "k2").agg(F.collect_set("run").alias("runs")), "lists")
    kept_text = F.col("_text") if all_texts else F.when(F.col("runs").isNotNull(), F.col("_text"))
    touched = stored(named.join(lists, ["k1", "k2"], "left").select("_row", "k1", "k2", kept_text.alias("_text"), "runs"), "touched")

    texts = touched.filter("exists(runs, r -> r.sorts)").select("k1", "k2", "_text", F.expr("filter(runs, r -> r.sorts)").alias("runs"))
    details = sorted_buckets(texts, width).unionAll(large_buckets(texts, width))
    details = stored(details.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("more")), "details")
    whole = "transform(filter(runs, r -> not r.alone), r -> struct(r.first as first, r.last as last))"
    none = "cast(array() as array<struct<first: int, last: int>>)"
    known = touched.filter("runs is not null").join(details, ["k1", "k2"], "left").withColumn("strings", F.expr(f"concat({whole}, coalesce(more, {none}))"))

    def row(strings: list[dict], text: str) -> dict:
        spans = joined([(x["first"], x["last"] + width) for x in strings])
        return {"spans": spans, "value": value(text, spans)}

    done = row_udf(row, "struct<spans: array<array<int>>, value: string>")
    untouched = touched.filter("runs is null").select("_row", F.array().cast("array<array<int>>").alias("spans"), F.col("_text").alias("value"))
    return known.select("_row", done("strings", "_text").alias("_done")).select("_row", "_done.spans", "_done.value").unionAll(untouched)


def chosen_runs(texts: DataFrame, large: bool) -> DataFrame:
    which = "r.large" if large else "not r.large"
    return texts.select("k1", "k2", "_text", F.expr(f"filter(runs, r -> {which})").alias("runs")).filter("size(runs) > 0")


def sorted_buckets(texts: DataFrame, width: int) -> DataFrame:
    """k1, k2, first, last: repeated strings of runs that are alone in a bucket of up to MOST_RUNS different runs."""

    def bytes_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        last_key = None
        for k1, k2, text, found in rows:
            if (k1, k2) != last_key:  # copies of a text mostly follow each other
                last_key, data = (k1, k2), text.encode()
                for r in found:
                    yield k1, k2, r["anchor"], r["bytes"], r["first"], r["alone"], data[r["first"] : r["last"] + width]

    schema = "k1 long, k2 long, anchor long, bytes long, first int, alone boolean, data binary"
    dealt = map_rows(chosen_runs(texts, large=False), bytes_of, schema).repartition("anchor").sortWithinPartitions("anchor", "bytes")

    def compare(rows: Iterator[tuple]) -> Iterator[tuple]:
        def flush(members: list[tuple]) -> Iterator[tuple]:
            for (k1, k2, first, alone, _), flags in zip(members, repeated([m[4] for m in members], width), strict=True):
                if alone and flags.any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
                    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                        yield k1, k2, first + a, first + b - 1

        members: list[tuple] = []
        size, last_anchor, last_run = 0, None, None
        for k1, k2, anchor, run, first, alone, data in rows:
            if (anchor, run) == last_run:
                continue
            if anchor != last_anchor and size > SORTED_TOGETHER:
                yield from flush(members)
                members, size = [], 0
            last_anchor, last_run = anchor, (anchor, run)
            members.append((k1, k2, first, alone, data))
            size += len(data) + 1
        if members:
            yield from flush(members)

    return map_rows(dealt, compare, "k1 long, k2 long, first int, last int")


def large_buckets(texts: DataFrame, width: int) -> DataFrame:
    """The same of larger buckets: their strings, one by one, by a hash of 128 bits, counted before they are shuffled.

    A passage in very many documents, each going on differently, makes a bucket that no task can hold.
    """

    def strings(rows: Iterator[tuple]) -> Iterator[tuple]:
        import xxhash

        for k1, k2, text, found in rows:
            data = text.encode()
            for r in found:
                for s in range(r["first"], r["last"] + 1):
                    yield k1, k2, s, r["alone"], r["bytes"], xxhash.xxh3_128_digest(data[s : s + width])

    each = stored(map_rows(chosen_runs(texts, large=True), strings, "k1 long, k2 long, first int, alone boolean, bytes long, name binary", 65536), "strings")
    # Strings of one run all differ, so a string in two different runs is repeated.
    twice = stored(each.groupBy("name").agg(F.min("bytes").alias("a"), F.max("bytes").alias("b")).filter("a < b").select("name"), "names")
    return each.filter("alone").join(twice, "name", "left_semi").selectExpr("k1", "k2", "first", "first as last").distinct()


def without_spans(text: str, spans: list[list[int]]) -> bytes:
    data, parts, at = text.encode(), [], 0
    for start, end in spans:
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]])


def digest(docs: DataFrame, width: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is left of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("sha"))

    def sha_left(text: str, spans: list[list[int]]) -> str | None:
        return hashlib.sha256(without_spans(text, spans)).hexdigest() if spans else None

    kept = removed(sized, sha_left, width).withColumn("kept", F.coalesce("value", F.col("_row.sha")))
    n_removed = F.expr("aggregate(spans, 0L, (a, s) -> a + s[1] - s[0])")
    return kept.select("_row.doc_id", "_row.n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.col("kept").alias("kept_sha256"))


def deduplicated(docs: DataFrame, width: int = 200) -> DataFrame:
    """docs without repeated bytes in text, and n_chars (if there) counted again; other columns stay as they are.

    Where a cut falls inside a character, what is left of it becomes the replacement character.
    """

    def cut(text: str, spans: list[list[int]]) -> str:
        return without_spans(text, spans).decode(errors="replace") if spans else text

    left = F.when(~F.col("_row._no_text"), F.col("value"))
    found = removed(docs, cut, width, all_texts=True).withColumn("_left", left)
    values = {"text": F.col("_left")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.length("_left").cast(docs.schema["n_chars"].dataType)
    return found.select(*(values.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))
