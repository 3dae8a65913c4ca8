"""Exact quantiles without sorting the column in one place.

Values are counted, and the counts added up along nested slices: millions, units,
millionths, values. Each level is accumulated inside the slice above it, so an ordered
group holds at most a million slices (ten million at the top for 15-digit money), however
many rows there are.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Points of the summary, as shares of the sorted column.
SUMMARY = (("25%", 0.25), ("50%", 0.5), ("75%", 0.75))


def exact_quantiles(df: DataFrame, column: str, points: tuple[tuple[str, float], ...]) -> DataFrame:
    """Rows (name, value) with linear interpolation between neighbouring ranks."""
    value = F.col(column).cast("double")
    slices = {
        "_million": F.floor(value / 1_000_000),
        "_unit": F.floor(value),
        "_millionth": F.floor(value * 1_000_000),
        "_value": value,
    }
    levels = list(slices)
    known = df.select(*[c.alias(name) for name, c in slices.items()])
    # Stated for every slice, so that the joins below have no filter to add and all levels
    # read the counts from the same shuffle.
    for name in levels:
        known = known.filter(F.col(name).isNotNull())
    counts = known.groupBy(*levels).agg(F.count(F.lit(1)).alias("_rows"))

    def ranked(depth: int, counts: DataFrame) -> DataFrame:
        """Slices of one level with the number of rows in all slices before them."""
        outer = levels[:depth]
        order = Window.partitionBy(*outer).orderBy(levels[depth])
        before = F.coalesce(F.sum("_rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        if not outer:
            whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            return counts.withColumns({"_start": before, "_n": F.sum("_rows").over(whole)})
        above = ranked(depth - 1, counts.groupBy(*outer).agg(F.sum("_rows").alias("_rows")))
        above = above.select(*outer, F.col("_start").alias("_above"), "_n")
        inner = counts.withColumn("_before", before).join(above, outer)
        return inner.withColumn("_start", F.col("_above") + F.col("_before")).drop("_above", "_before")

    place = {name: (F.col("_n") - 1) * F.lit(point) for name, point in points}
    ends = [
        F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), rank.alias("rank"), (at - F.floor(at)).alias("weight"))
        for name, at in place.items()
        for side, rank in (("low", F.floor(at)), ("high", F.ceil(at)))
    ]
    holds = lambda end: (end["rank"] >= F.col("_start")) & (end["rank"] < F.col("_start") + F.col("_rows"))
    found = ranked(len(levels) - 1, counts).select("_value", F.inline(F.filter(F.array(*ends), holds)))
    low = F.max(F.when(F.col("side") == "low", F.col("_value")))
    high = F.max(F.when(F.col("side") == "high", F.col("_value")))
    return found.groupBy("name").agg((low + (high - low) * F.max("weight")).alias("value"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of a column, as (name, value) rows."""
    value = F.col(column).cast("double")
    moments = df.agg(
        F.count(value).cast("double").alias("count"),
        F.mean(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    lines = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in moments.columns])
    return moments.select(F.inline(lines)).unionByName(exact_quantiles(df, column, SUMMARY))
