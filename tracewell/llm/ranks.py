"""Places in a sorted order, however many rows a group has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored


def ranked(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """df with `out`: each row's place (from 0) among the rows of its group, in ascending order of `order`, null first.

    Rows are sorted by range over all tasks, so a group goes over as many of them as its size asks for; a
    window numbers the rows of a group inside one range, and the sizes of the group's earlier ranges are
    added. Rows that are alike in all of group and order are dealt over ranges by their place in the
    input, so df should be a stored table. Group columns are not null; columns are named without dots.
    """
    keys = [*group, *order]
    sorted_rows = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie")
    parts = stored(sorted_rows.withColumn("_range", F.spark_partition_id()), "ranges")
    by = [*group, "_range"]
    sizes = parts.groupBy(*by).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    offsets = offsets.select(*(F.col(c).alias(f"_o_{c}") for c in by), "_offset")
    inside = F.row_number().over(W.partitionBy(*by).orderBy(*order, "_tie"))
    joined = parts.withColumn("_inside", inside).join(offsets, [F.col(c) == F.col(f"_o_{c}") for c in by])
    return joined.select(*df.columns, (F.col("_offset") + F.col("_inside") - 1).alias(out))
