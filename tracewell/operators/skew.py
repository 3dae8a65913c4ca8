"""Hot keys: finding them, spreading their rows, and joining them without one big task.

A window or a join puts all rows of a key in one task. Before a plan is built, one
aggregation over the key columns lists the keys that have more rows than a limit.
If none has, operators use plain windows and joins. Otherwise rows of hot keys are dealt
over lanes, so that an operator partitioned by (key, lane) never sees a group above the
limit: joins deal them by row, temporal operators by instant. What hot rows need from other
rows of their key comes from a computation that is cut into time slices and meets them in
their lane; ordinary rows move as they would without hot keys.
"""

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(frames: list[DataFrame], key: str) -> DataFrame:
    """Rows per key over all frames."""
    counts = [f.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")) for f in frames]
    if len(counts) == 1:
        return counts[0]
    return reduce(DataFrame.unionByName, counts).groupBy(key).agg(F.sum("_rows").alias("_rows"))


def _spread(row_id: str) -> Column:
    """A lane number that differs from row to row and is never 0."""
    return F.xxhash64(row_id).bitwiseOR(F.lit(1))


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, small: bool = False
) -> DataFrame:
    """Equi-join in which NULL keys meet, as they do in PARTITION BY."""
    others = [c for c in right.columns if c not in keys]
    right = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *others)
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(F.broadcast(right) if small else right, condition, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


# At most so many keys of a column can be hot, a few MB: the limit grows with the tables.
MOST_HOT_KEYS = 200_000


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than `limit` rows, or None where there are none. The limit is at least
    a MOST_HOT_KEYS-th of all rows, so the list is small enough to hold and to broadcast
    however large the tables are."""

    key: str
    keys: DataFrame | None = None
    # Instants of hot keys (key, _at) that have more rows than the limit by themselves.
    crowds: DataFrame | None = None

    @classmethod
    def find(
        cls, sources: dict[str, list[DataFrame]], limit: int, ts: str | None = None
    ) -> dict[str, "HotKeys"]:
        """Hot keys per key column, counted over all frames given for it. Tables of no more
        than `limit` rows have none; otherwise one job lists them, once for all later plans.
        With `ts`, crowded instants are looked for in the frames that have this column."""
        every = {id(f): f for frames in sources.values() for f in frames}.values()
        total = reduce(DataFrame.union, [f.select(F.lit(1)) for f in every]).count()
        if total <= limit:
            return {key: cls(key) for key in sources}
        limit = max(limit, total // MOST_HOT_KEYS)
        found = {}
        for key, frames in sources.items():
            over = _counts(frames, key).filter(F.col("_rows") > limit).select(key)
            rows = over.collect()
            if not rows:
                found[key] = cls(key)
                continue
            hot = cls(key, over.sparkSession.createDataFrame(rows, over.schema))
            timed = [hot.only(f).select(key, F.col(ts).alias("_at")) for f in frames if ts in f.columns]
            found[key] = hot._with_crowds(timed, limit)
        return found

    def _with_crowds(self, frames: list[DataFrame], limit: int) -> "HotKeys":
        if not frames:
            return self
        counts = reduce(DataFrame.unionByName, frames).groupBy(self.key, "_at").agg(F.count(F.lit(1)).alias("_rows"))
        crowded = counts.filter(F.col("_rows") > limit).drop("_rows")
        rows = crowded.collect()  # as few as hot keys
        if not rows:
            return self
        return replace(self, crowds=crowded.sparkSession.createDataFrame(rows, crowded.schema))

    @property
    def any(self) -> bool:
        return self.keys is not None

    @property
    def lane(self) -> str:
        return f"_lane_{self.key}"

    @property
    def placement(self) -> list[str]:
        """Columns to partition by so that no group exceeds the limit."""
        return [self.key, self.lane] if self.any else [self.key]

    @property
    def slot(self) -> str:
        return f"_slot_{self.key}"

    @property
    def slots(self) -> list[str]:
        """Columns to partition by so that rows of one hot instant, if no crowd, are together."""
        return [self.key, self.slot] if self.any else [self.key]

    def is_hot(self) -> Column:
        return F.col(self.slot) != 0

    @staticmethod
    def slot_of(ts: str) -> Column:
        """The slot of hot rows at an instant."""
        return _spread(ts)

    def _tagged(self, df: DataFrame, column: str, number: Column) -> DataFrame:
        marked = self.keys.withColumn("_hot_key", F.lit(True))
        lane = F.when(F.col("_hot_key"), number).otherwise(F.lit(0).cast("long"))
        return null_safe_join(df, marked, [self.key], "left", small=True).withColumn(column, lane).drop("_hot_key")

    def tag(self, df: DataFrame, row_id: str) -> DataFrame:
        """Add the lane: 0 for ordinary keys, another number per row for hot keys. Rows that
        are dealt by instant already keep that."""
        if not self.any or self.slot in df.columns or self.lane in df.columns:
            return df
        return self._tagged(df, self.lane, _spread(row_id))

    def tag_instants(self, df: DataFrame, row_id: str, ts: str) -> DataFrame:
        """Add the slot: 0 for ordinary keys, another number per instant for hot keys, per row in crowds."""
        if not self.any or self.slot in df.columns:
            return df
        if self.crowds is None:
            return self._tagged(df, self.slot, self.slot_of(ts))
        crowd = self.crowds.withColumn("_crowd", F.lit(True)).withColumnRenamed("_at", ts)
        marked = null_safe_join(df, crowd, [self.key, ts], "left", small=True)
        number = F.when(F.col("_crowd"), _spread(row_id)).otherwise(self.slot_of(ts))
        return self._tagged(marked, self.slot, number).drop("_crowd")

    def untag(self, df: DataFrame) -> DataFrame:
        """Forget lanes and slots, as times or keys change."""
        return df.drop(self.lane, self.slot)

    @property
    def mark(self) -> str:
        return f"_hot_{self.key}"

    def marked(self, df: DataFrame) -> DataFrame:
        """Add whether the row's key is hot, as `mark`."""
        hot = null_safe_join(df, self.keys.withColumn(self.mark, F.lit(True)), [self.key], "left", small=True)
        return hot.withColumn(self.mark, F.coalesce(self.mark, F.lit(False)))

    def only(self, df: DataFrame) -> DataFrame:
        return null_safe_join(df, self.keys, [self.key], "left_semi", small=True)

    def without(self, df: DataFrame) -> DataFrame:
        return null_safe_join(df, self.keys, [self.key], "left_anti", small=True) if self.any else df

    def join_dimension(
        self, fact: DataFrame, dim: DataFrame, columns: dict[str, str], known: str, row_id: str
    ) -> DataFrame:
        """Left join a table that is unique on the key, adding its columns under new names
        and whether there was a match as `known`. Hot fact rows meet a broadcast of their few
        dimension rows; the rest join on (key, lane), which no group can dominate."""
        renamed = [F.col(c).alias(name) for c, name in columns.items()]
        if not self.any:
            packed = dim.select(F.col(self.key).alias("_dim_key"), *renamed)
            joined = fact.join(packed, F.col(self.key) == F.col("_dim_key"), "left")
            return joined.withColumn(known, F.col("_dim_key").isNotNull()).drop("_dim_key")
        hit = F.struct(F.lit(True).alias(known), *renamed)
        heavy = self.only(dim).select(F.col(self.key).alias("_heavy_key"), hit.alias("_heavy"))
        # Always 0, but not a literal: the optimizer would take it out of the join keys, and with it the
        # lane, so that all rows of a hot key would go to one task.
        zero = F.pmod(F.hash(self.key), F.lit(1)).cast("long")
        light = dim.select(F.col(self.key).alias("_light_key"), zero.alias("_light_lane"), hit.alias("_light"))
        found = F.coalesce(F.col("_heavy"), F.col("_light"))
        tagged = self.tag(fact, row_id)
        lane = self.slot if self.slot in tagged.columns else self.lane
        return (
            tagged.join(F.broadcast(heavy), F.col(self.key) == F.col("_heavy_key"), "left")
            .join(light, (F.col(self.key) == F.col("_light_key")) & (F.col(lane) == F.col("_light_lane")), "left")
            .select(
                *tagged.columns,
                F.coalesce(found[known], F.lit(False)).alias(known),
                *[found[name].alias(name) for name in columns.values()],
            )
        )
