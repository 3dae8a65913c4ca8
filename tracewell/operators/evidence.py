"""Who sent the money behind a mule-rule hit (J5 as rows)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions.columns import epoch_bucket
from tracewell.operators.rules import mule_network
from tracewell.operators.scope import EVENT_COLUMNS, TXN, Scope


def mule_senders(df: DataFrame, scope: Scope, rows_per_part: int = 100_000) -> DataFrame:
    """Each transfer that the mule rule hits, with `senders`, the different users who sent to its
    beneficiary in the trailing window, in order.

    Time is cut into buckets as long as the window, so a hit reaches into its own bucket and the one before.
    A sender is one row under each of the two buckets whose hits can see it, however many transfers there are: it
    belongs to a hit if its first transfer in the hit's own bucket is not after the hit, or its last one in the
    bucket before is inside the window. The senders under a bucket are packed into one sorted array, which is at
    most as long as the lists of two hits, and meet the hits in the task that makes the lists: neither pairs nor
    lists are shuffled. Hits at one instant share one list. Hits of a bucket are dealt over lanes of `rows_per_part`
    rows, or of as many as the bucket has senders if that is more, so copies of its array are no more than its rows."""
    key, window = "beneficiary_id", scope.params.mule_window
    bucket = epoch_bucket(F.col("timestamp"), window)
    hits = mule_network(df.select(EVENT_COLUMNS), scope, "_hit").filter("_hit").select(TXN, key, "timestamp", bucket.alias("_at"))
    events = df.filter(F.col("timestamp").isNotNull() & F.col(key).isNotNull()).select(key, "user_id", "timestamp", bucket.alias("_bucket"))
    # Under each bucket that hits look into: its own senders, and those of the one before.
    none = F.lit(None).cast(events.schema["timestamp"].dataType)
    own = F.struct(F.col("_bucket").alias("_at"), F.col("timestamp").alias("_first"), none.alias("_last"), F.lit(1).alias("_row"))
    later = F.struct((F.col("_bucket") + 1).alias("_at"), none.alias("_first"), F.col("timestamp").alias("_last"), F.lit(0).alias("_row"))
    seen = events.select(key, "user_id", F.inline(F.array(own, later)))
    seen = seen.groupBy(key, "_at", "user_id").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_row").alias("_rows"))
    lanes = F.ceil(F.sum("_rows") / F.greatest(F.count("user_id"), F.lit(rows_per_part))).alias("_lanes")
    sender = F.when(F.col("user_id").isNotNull(), F.struct("user_id", "_first", "_last"))
    packed = seen.groupBy(key, "_at").agg(F.sort_array(F.collect_list(sender)).alias("_seen"), lanes).filter("_lanes > 0")
    packed = packed.select(key, "_at", "_seen", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_lanes") - 1)).alias("_lane"))

    crowded = seen.groupBy(key, "_at").agg(lanes).filter("_lanes > 1")
    lane = F.pmod(F.xxhash64(TXN), F.coalesce("_lanes", F.lit(1)))
    dealt = hits.join(crowded, [key, "_at"], "left").withColumn("_lane", lane).repartition(key, "_at", "_lane")
    instants = dealt.groupBy(key, "_at", "_lane", "timestamp").agg(F.collect_list(F.struct(TXN)).alias("_hits"))
    instants = instants.withColumn("_since", F.col("timestamp") - F.lit(window))
    inside = F.filter("_seen", lambda x: (x["_first"] <= F.col("timestamp")) | (x["_last"] >= F.col("_since")))
    lists = instants.join(packed, [key, "_at", "_lane"]).select(key, "timestamp", "_hits", inside["user_id"].alias("senders"))
    return lists.select(F.inline("_hits"), key, "timestamp", "senders")
