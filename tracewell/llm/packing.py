"""Packing by power-of-two decomposition: no sequence crosses documents and none needs padding."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, map_rows
from .tokens import vocabulary_path, word_ids

#: Bits of a sequence id below its bucket: 2^25 partitions of 2^33 rows.
BUCKET_SHIFT = 58


def binary_lengths(total: int, longest: int) -> Iterator[int]:
    """Lengths that are powers of two up to `longest` (one itself), longest first, summing to total."""
    while total:
        piece = min(longest, 1 << (total.bit_length() - 1))
        yield piece
        total -= piece


def pieces(docs: DataFrame, end_id: int = 2, longest: int = 4096, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, bucket, sequence_id, offset.

    Each document is encoded, closed with end_id and cut into pieces whose lengths are powers of two, the
    binary digits of its length (longest first, as many of the longest as fit). Pieces of one length share a
    bucket, and a piece is a sequence by itself, at offset 0: equal lengths make a batch without padding.
    Ids of one bucket's sequences lie in one range, bucket * 2^58 and up.

    Everything happens where a document is read, without a shuffle, so hot keys and copies cost nothing.
    A sequence id is made of the input partition and the row in it. A null or empty text is the end id
    alone. Rows that repeat a doc_id, or have none, are documents of their own. Other columns are ignored.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = path or vocabulary_path()
    end = end_id.to_bytes(4, "little")

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        words = word_ids(path)
        for doc_id, text in rows:
            ids = words.encode(text) + end
            total, start = len(ids) // 4, 0
            for length in binary_lengths(total, longest):
                yield doc_id, start, length, ids[4 * start : 4 * (start + length)], total, length.bit_length() - 1
                start += length

    cuts = map_rows(doc_texts(docs), cut, "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int", 2048)
    number = F.shiftleft(F.col("bucket").cast("long"), BUCKET_SHIFT) + F.monotonically_increasing_id()
    return cuts.withColumns({"sequence_id": number, "offset": F.lit(0).cast("long")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """The pieces as Parquet, a folder for each length: a trainer reads batches of one length from one folder."""
    packed.write.partitionBy("bucket").parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
