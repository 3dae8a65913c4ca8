"""Token-id files: id blocks transposed into byte or bit planes, each plane compressed with zstandard.

A file set is a Parquet folder whose rows are chunks. Parquet gives it atomic commits on any store that
Spark can write; the chunk itself is a format of its own (see `pack_chunk`), and the other columns are the
chunk index: which part and chunk it is, how many ids come before it in its part, and which documents it
holds. Parts are in ascending order of doc_id, and so are chunks in a part and ids in a chunk.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import doc_texts, map_rows
from .tokens import vocabulary_path, word_ids

MAGIC = b"TPL1"
BLOCK_IDS = 65_536
#: part: the range of doc_ids; first: ids before the chunk in its part; docs: the pieces of documents in it, in order.
#: Of a piece: no: the document's place in its part; at, n: place and number of its ids in the chunk; start, total: of the whole document.
CHUNKS = "part int, chunk int, first long, n_ids int, data binary, docs array<struct<no: long, doc_id: long, at: int, n: int, start: long, total: long>>"


def pack_chunk(ids: np.ndarray, planes: str = "byte", level: int = 1) -> bytes:
    """Header (magic, kind of planes, number of ids, compressed bytes of each plane), then the planes.

    Byte planes: plane k holds byte k of every id. Bit planes: plane k holds bit k of every id. Planes of
    zeros only take no bytes.
    """
    import zstandard

    compress = zstandard.ZstdCompressor(level=level).compress
    rows = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if planes == "bit":
        rows = np.packbits(np.unpackbits(rows[:, :, None], axis=2, bitorder="little").transpose(0, 2, 1).reshape(32, -1), axis=1)
    done = [compress(r.tobytes()) if r.any() else b"" for r in rows]
    return struct.pack(f"<4sBI{len(done)}I", MAGIC, len(done), len(ids), *map(len, done)) + b"".join(done)


def unpack_chunk(data: bytes) -> np.ndarray:
    import zstandard

    magic, n_planes, n = struct.unpack_from("<4sBI", data)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    sizes, at, expand = struct.unpack_from(f"<{n_planes}I", data, 9), 9 + 4 * n_planes, zstandard.ZstdDecompressor().decompress
    width = n if n_planes == 4 else (n + 7) // 8
    rows = np.zeros((n_planes, width), np.uint8)
    for k, size in enumerate(sizes):
        if size:
            rows[k] = np.frombuffer(expand(data[at : at + size]), np.uint8)
        at += size
    if n_planes == 32:
        bits = np.unpackbits(rows, axis=1, count=n).reshape(4, 8, n)
        rows = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").reshape(4, n)
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


def write_token_files(docs: DataFrame, folder: str, end_id: int = 1, planes: str = "byte", block_ids: int = BLOCK_IDS, path: str | None = None) -> None:
    """Encode every text, close it with end_id and write the ids of all documents in ascending order of doc_id.

    Documents are range-partitioned by (doc_id, hash of the text), so a doc_id that very many rows repeat
    still spreads. Rows without a doc_id come first; equal doc_ids follow the hash; a null or empty text is
    the end id alone; an empty table makes an empty file set. Other columns are ignored.
    """
    path = path or vocabulary_path()
    end = end_id.to_bytes(4, "little")

    def chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        words, part = word_ids(path), TaskContext.get().partitionId()
        held, inside, chunk, first, begun = bytearray(), [], 0, 0, 0
        for no, (doc_id, text) in enumerate(rows):
            ids, at = words.encode(text) + end, 0
            total = len(ids) // 4
            while at < total:
                here = len(held) // 4
                n = min(total - at, block_ids - here)
                held += ids[4 * at : 4 * (at + n)]
                inside.append((no, doc_id, here, n, begun, total))
                at += n
                if here + n == block_ids:
                    yield part, chunk, first, block_ids, pack_chunk(np.frombuffer(bytes(held), "<u4"), planes), inside
                    held, inside, chunk, first = bytearray(), [], chunk + 1, first + block_ids
            begun += total
        if held:
            yield part, chunk, first, len(held) // 4, pack_chunk(np.frombuffer(bytes(held), "<u4"), planes), inside

    def named(rows: Iterator[tuple]) -> Iterator[tuple]:
        names = ("no", "doc_id", "at", "n", "start", "total")
        for *chunk, inside in chunks(rows):
            yield *chunk, [dict(zip(names, x, strict=True)) for x in inside]

    texts = doc_texts(docs).withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    map_rows(ordered, named, CHUNKS, 32).write.option("compression", "none").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Each document in the files: doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian unsigned 32-bit).

    Only documents that cross a chunk's end are put together again by a shuffle; a document is the largest
    thing that a task holds at once besides a chunk.
    """
    files = spark.read.schema(CHUNKS).parquet(folder)

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        for part, chunk, data, inside in rows:
            ids = unpack_chunk(data)
            for x in inside:
                yield part, chunk, x["no"], x["doc_id"], x["start"], x["total"], ids[x["at"] : x["at"] + x["n"]].tobytes()

    def found(which: str) -> DataFrame:
        chunks = files.select("part", "chunk", "data", F.expr(f"filter(docs, d -> d.n {which} d.total)").alias("docs")).filter(F.size("docs") > 0)
        return map_rows(chunks, pieces, "part int, chunk int, no long, doc_id long, start long, total long, ids binary", 1024)

    put_together = (
        found("<")
        .groupBy("part", "no", "doc_id", "start", "total")
        .agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("list"))
        .select("part", "doc_id", "start", "total", F.expr("aggregate(list, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
    )
    whole = found("=").select("part", "doc_id", "start", "total", "ids")
    # One row per part, so as many as the writing stage had tasks: small enough for one window and a broadcast.
    sizes = files.groupBy("part").agg(F.max(F.col("first") + F.col("n_ids")).alias("size"))
    before = F.coalesce(F.sum("size").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", before.alias("before"))
    return whole.unionByName(put_together).join(F.broadcast(offsets), "part").select("doc_id", (F.col("before") + F.col("start")).alias("start"), F.col("total").alias("n_tokens"), "ids")


def digest(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
