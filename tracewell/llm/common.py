"""Scratch tables in the shared folder, and helpers for functions over Arrow batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch that are turned into Python objects at a time.
ROWS_AT_A_TIME = 256
ROOT = str(Path(__file__).resolve().parents[2])


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    context = spark.sparkContext
    if folder := context.getConf().get("spark.checkpoint.dir"):
        return folder
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return context._jsc.sc().getCheckpointDir().get()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: later steps neither compute it again nor lose it with an executor."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def doc_texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as a long and text as a string, without the other columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def map_rows(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str, rows_out: int = 4096) -> DataFrame:
    """df through `rows`, a generator from tuples to tuples that sees a whole partition as one stream."""
    target = T._parse_datatype_string(schema)
    environment = df.sparkSession.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):  # workers import this package
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, environment.get("PYTHONPATH")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, out = to_arrow_schema(target), []
        for row in rows(tuples(batches)):
            out.append(row)
            if len(out) >= rows_out:
                yield to_batch(out, arrow)
                out = []
        if out:
            yield to_batch(out, arrow)
        del out
        give_memory_back()

    return df.mapInArrow(run, schema)


def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, ROWS_AT_A_TIME).columns), strict=True)


def row_udf(function: Callable, kind: str) -> Callable:
    """A column function that applies `function` to the values of each row, a few rows at a time; null where it returns None."""
    target = T._parse_datatype_string(kind)

    @F.arrow_udf(kind)
    def column(*arrays: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow, parts = to_arrow_type(target), []
        for start in range(0, len(arrays[0]), ROWS_AT_A_TIME):
            values = zip(*(a.slice(start, ROWS_AT_A_TIME).to_pylist() for a in arrays), strict=True)
            parts.append(pa.array([function(*v) for v in values], arrow))
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return column


def give_memory_back() -> None:
    """Workers idle between tasks; what they have freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
