"""Time-ordered operators per key: trailing counts, as-of join, previous row.

Ordinary keys go through window functions partitioned by key, always with frames that
grow with the row position, so one pass over the sorted group is enough. Hot keys are
first reduced to one row per instant and then cut into minutes: a window inside each
minute plus what earlier minutes hand over. A group is thus bounded by the microseconds
in a minute, and the hand-over by the minutes in the calendar, whatever the number of rows.
"""

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from tracewell.functions.columns import epoch_bucket
from tracewell.operators.skew import HotKeys, null_safe_join

MINUTE = timedelta(minutes=1)

# Positions of steps that share an instant: a row is counted at its own instant,
# and leaves a closed trailing window only after the instant at its far end.
ARRIVAL, DEPARTURE = 0, 1


def _up_to_here(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before_here(spec: WindowSpec) -> WindowSpec:
    return spec.rowsBetween(Window.unboundedPreceding, -1)


def _step(at: Column, phase: int, delta: Column) -> Column:
    return F.struct(
        at.alias("_at"), F.lit(phase).alias("_phase"), delta.cast("long").alias("_delta")
    )


def _level_after(steps: DataFrame, key: str) -> DataFrame:
    """Sum of all deltas up to and at each arrival. Steps are unique on (key, _at, _phase)."""
    cut = steps.withColumn("_minute", epoch_bucket(F.col("_at"), MINUTE))
    inside = _up_to_here(Window.partitionBy(key, "_minute").orderBy("_at", "_phase"))
    carried = (
        cut.groupBy(key, "_minute")
        .agg(F.sum("_delta").alias("_net"))
        .withColumn("_carried", F.sum("_net").over(_before_here(Window.partitionBy(key).orderBy("_minute"))))
        .select(key, "_minute", "_carried")
    )
    levels = cut.withColumn("_inside", F.sum("_delta").over(inside))
    level = F.col("_inside") + F.coalesce("_carried", F.lit(0))
    joined = null_safe_join(levels.filter(F.col("_phase") == ARRIVAL), carried, [key, "_minute"], "left")
    return joined.select(key, "_at", level.alias("_level"))


def _span(window: timedelta) -> str:
    return f"INTERVAL '{window.total_seconds():.6f}' SECOND"


def _trailing_sum(arriving: str, leaving: str, ts: str, window: timedelta, hot: HotKeys) -> Column:
    """Sum of `arriving` up to t minus sum of `leaving` up to just before t - window.

    Both frames only grow along the sorted group, so the cost does not depend on how many
    rows are inside the window, as it would for a sliding frame. Rows without a time are
    peers of each other and of no other row."""
    spec = f"PARTITION BY {', '.join(hot.slots)} ORDER BY {ts} RANGE BETWEEN UNBOUNDED PRECEDING AND"
    older = f"INTERVAL '{window.total_seconds() + 1e-6:.6f}' SECOND PRECEDING"
    so_far = f"sum({arriving}) OVER ({spec} CURRENT ROW)"
    return F.expr(f"if({ts} is null, {so_far}, {so_far} - coalesce(sum({leaving}) OVER ({spec} {older}), 0))")


def _marks(table: DataFrame, ts: str, hot: HotKeys, **values: Column) -> DataFrame:
    """A row for each instant of the table, in the slot of the hot rows at that instant and before them."""
    return table.select(
        hot.key, F.col("_at").alias(ts), hot.slot_of("_at").alias(hot.slot), F.lit(0).alias("_kind"), *[v.alias(n) for n, v in values.items()]
    )


def _crowded(df: DataFrame, table: DataFrame, ts: str, hot: HotKeys, out: str) -> DataFrame:
    """Put `_level` of the table, whose crowded instants are few, in place on rows of crowds."""
    if hot.crowds is None:
        return df
    few = null_safe_join(table, hot.crowds, [hot.key, "_at"], "left_semi", small=True)
    few = few.select(hot.key, F.col("_at").alias(ts), F.struct("_level").alias("_crowd"))
    joined = null_safe_join(df, few, [hot.key, ts], "left", small=True)
    value = F.when(F.col("_crowd").isNotNull(), F.col("_crowd._level")).otherwise(F.col(out))
    return joined.withColumn(out, value).drop("_crowd")


def _met(df: DataFrame, table: DataFrame, ts: str, hot: HotKeys, plain: dict[str, Column], out: str) -> DataFrame:
    """df with `out`, worked out by windows for ordinary rows and taken from the table, which is unique on
    (key, instant), for hot ones.

    The table's rows go into the timeline of the windows: a hot row finds the value of its instant just
    before itself. So ordinary rows move and are sorted as they are without hot keys. `plain` has the
    columns of the ordinary way, the last of them `out`."""
    met = _marks(table, ts, hot, _met=F.struct("_level"))
    line = df.withColumn("_kind", F.lit(1)).unionByName(met, allowMissingColumns=True).repartition(*hot.slots)
    so_far = _up_to_here(Window.partitionBy(*hot.slots).orderBy(ts, "_kind"))
    line = line.withColumn("_met", F.last("_met", ignorenulls=True).over(so_far))
    for name, column in plain.items():
        line = line.withColumn(name, column)
    found = F.when(hot.is_hot(), F.col("_met._level")).otherwise(F.col(out))
    line = line.filter(F.col("_kind") == 1).withColumn(out, found).select(*df.columns, out)
    return _crowded(line, table, ts, hot, out)


def _count_levels(busy: DataFrame, key: str, ts: str, window: timedelta) -> DataFrame:
    """Rows of the key in [t - window, t] for each of its instants: key, _at, _level."""
    instants = busy.groupBy(key, ts).agg(F.count(F.lit(1)).alias("_n"))
    here, gone = F.col(ts), F.col(ts) + F.lit(window)
    both = F.array(_step(here, ARRIVAL, F.col("_n")), _step(gone, DEPARTURE, -F.col("_n")))
    return _level_after(instants.select(key, F.inline(both)), key)


def range_count(
    df: DataFrame,
    ts: str,
    window: timedelta,
    out: str,
    row_id: str,
    hot: HotKeys,
    busy: DataFrame | None = None,
    placed: bool = False,
    met: str | None = None,
) -> DataFrame:
    """Rows of the same key in [t - window, t], both ends included, rows at t all included;
    for a row without a time, the key's rows without one.

    `busy` holds the hot keys' rows, if the caller has them at less cost than `df`;
    `placed` says that the rows already sit in the task of their slot, and `met` names the
    column in which hot ones have their count by then (see `asof_last`)."""
    if not hot.any:
        rows = df if placed else df.repartition(*hot.slots)
        return rows.withColumn(out, _trailing_sum("1", "1", ts, window, hot))
    if met is not None:
        counted = df.withColumn(out, _trailing_sum("1", "1", ts, window, hot))
        return counted.withColumn(out, F.when(hot.is_hot(), F.col(met)).otherwise(F.col(out))).drop(met)
    table = _count_levels(hot.only(df) if busy is None else busy, hot.key, ts, window)
    tagged = hot.tag_instants(df, row_id, ts)
    return _met(tagged, table, ts, hot, {out: _trailing_sum("1", "1", ts, window, hot)}, out)


def range_distinct(
    df: DataFrame,
    ts: str,
    window: timedelta,
    who: str,
    out: str,
    row_id: str,
    hot: HotKeys,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Distinct non-NULL values of `who` among the key's rows in [t - window, t]; rows without
    a time count for no other row and have 0 themselves.

    A value is present at t while its latest row is at most `window` old. Its rows
    therefore form stays: one arrival when the previous row is too old, one departure
    when the next row comes too late. The distinct count is what arrived minus what left;
    no set is kept and no pair of rows is formed."""
    key = hot.key
    own = Window.partitionBy(*hot.slots, who).orderBy(ts)
    previous, following = F.lag(ts).over(own), F.lead(ts).over(own)
    span = F.lit(window)
    timed = F.col(ts).isNotNull()
    counted = F.col(who).isNotNull() & timed
    plain = {
        "_previous": previous,
        "_following": following,
        "_arrives": F.when(counted & F.expr(f"_previous is null or _previous < {ts} - {_span(window)}"), 1).otherwise(0),
        "_leaves": F.when(counted & F.expr(f"_following is null or _following > {ts} + {_span(window)}"), 1).otherwise(0),
        out: F.when(timed, _trailing_sum("_arrives", "_leaves", ts, window, hot)).otherwise(0),
    }
    if not hot.any:
        rows = df.repartition(*hot.slots)
        for name, column in plain.items():
            rows = rows.withColumn(name, column)
        return rows.select(*df.columns, out)

    # Hot keys: inside one slice as long as the window, rows of a value are always part of
    # the same stay, so the first and the last are enough.
    busy = hot.only(df) if busy is None else busy
    slices = (
        busy.filter(counted)
        .groupBy(key, who, epoch_bucket(F.col(ts), window).alias("_slice"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )
    order = Window.partitionBy(key, who).orderBy("_slice")
    before, after = F.lag("_last").over(order), F.lead("_first").over(order)
    starts = before.isNull() | (before < F.col("_first") - span)
    ends = after.isNull() | (after > F.col("_last") + span)
    stays = slices.select(
        key,
        F.array(
            _step(F.col("_first"), ARRIVAL, F.when(starts, 1)),
            _step(F.col("_last") + span, DEPARTURE, F.when(ends, -1)),
        ).alias("_steps"),
    ).select(key, F.inline("_steps"))
    instants = busy.filter(timed).select(key, F.inline(F.array(_step(F.col(ts), ARRIVAL, F.lit(0)))))
    steps = (
        stays.filter(F.col("_delta").isNotNull())
        .unionByName(instants)
        .groupBy(key, "_at", "_phase")
        .agg(F.sum("_delta").alias("_delta"))
    )
    found = _met(hot.tag_instants(df, row_id, ts), _level_after(steps, key), ts, hot, plain, out)
    return found.withColumn(out, F.when(timed, F.col(out)).otherwise(0))


def timeline_of(
    left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str, columns: list[str], tie: str, out: str
) -> DataFrame:
    """Rows of both sides in one table: left ones (`_kind` 1) as they are, right ones (0) with their columns
    as the struct `out` and `_tie`, at their time. Right rows without a key or a time match nothing and are left out."""
    known = right.filter(F.col(by).isNotNull() & F.col(right_ts).isNotNull())
    marks = known.select(
        by, F.col(right_ts).alias(left_ts), F.lit(0).alias("_kind"), F.col(tie).alias("_tie"), F.struct(*columns).alias(out)
    )
    return left.withColumn("_kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)


def latest_on(timeline: DataFrame, by: str, ts: str, out: str) -> DataFrame:
    """Left rows of a timeline with the latest right row of their key at or before them as `out`."""
    so_far = _up_to_here(Window.partitionBy(by).orderBy(ts, "_kind", "_tie"))
    latest = timeline.withColumn(out, F.last(out, ignorenulls=True).over(so_far))
    return latest.filter(F.col("_kind") == 1).drop("_kind", "_tie")


def _tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions. Named outright it is kept: left to itself, Spark joins the partitions of a
    shuffle into one or two more than there are cores, and the long stage behind it takes twice the time of its longest task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def asof_last(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_ts: str,
    right_ts: str,
    columns: list[str],
    tie: str,
    out: str,
    row_id: str,
    hot: HotKeys,
    busy: DataFrame | None = None,
    counts: dict[str, timedelta] | None = None,
) -> DataFrame:
    """Add the struct `out`: the latest right row of the key at or before each left row.

    Right rows at the same instant are told apart by the largest `tie`. The struct is NULL
    only when there is no such row; rows without a time match nothing. Both inputs meet in one sorted timeline, so no pair of
    rows is ever formed. With `counts`, hot rows also get their trailing counts of these names and
    windows, which `range_count` then takes over; other rows get NULL."""
    if not hot.any:
        timeline = timeline_of(left, right, by, left_ts, right_ts, columns, tie, out)
        return latest_on(timeline.repartition(_tasks(left), by), by, left_ts, out)
    hit = F.struct(*columns)
    counts = counts or {}
    known = right.filter(F.col(by).isNotNull() & F.col(right_ts).isNotNull())
    ordinary = hot.without(known).withColumn(hot.slot, F.lit(0).cast("long"))
    timeline = timeline_of(hot.tag_instants(left, row_id, left_ts), ordinary, by, left_ts, right_ts, columns, tie, out)
    timeline = timeline.withColumn(hot.slot, F.coalesce(hot.slot, F.lit(0).cast("long")))
    so_far = _up_to_here(Window.partitionBy(*hot.slots).orderBy(left_ts, "_kind", "_tie"))

    # What hot rows find is worked out per instant, and laid into their slots as marks.
    busy = hot.only(left) if busy is None else busy
    probes = busy.select(by, F.col(left_ts).alias("_at")).distinct().withColumn("_kind", F.lit(1))
    marks = hot.only(known).groupBy(by, F.col(right_ts).alias("_at"))
    marks = marks.agg(F.max_by(hit, F.col(tie)).alias("_mark")).withColumn("_kind", F.lit(0))
    cut = probes.unionByName(marks, allowMissingColumns=True)
    cut = cut.withColumn("_minute", epoch_bucket(F.col("_at"), MINUTE))
    inside = _up_to_here(Window.partitionBy(by, "_minute").orderBy("_at", "_kind"))
    earlier = _before_here(Window.partitionBy(by).orderBy("_minute"))
    carried = (
        cut.groupBy(by, "_minute")
        .agg(F.max_by("_mark", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_mark"))
        .select(by, "_minute", F.last("_mark", ignorenulls=True).over(earlier).alias("_carried"))
    )
    latest = cut.withColumn("_inside", F.last("_mark", ignorenulls=True).over(inside)).filter(F.col("_kind") == 1)
    table = null_safe_join(latest, carried, [by, "_minute"], "left")
    table = table.select(by, "_at", F.coalesce("_inside", "_carried").alias("_login"))
    for name, window in counts.items():
        levels = _count_levels(busy, by, left_ts, window).select(by, "_at", F.col("_level").alias(name))
        table = null_safe_join(table, levels, [by, "_at"], "left")
    table = table.select(by, "_at", F.struct("_login", *counts).alias("_level"))
    timeline = timeline.unionByName(_marks(table, left_ts, hot, _met=F.col("_level")), allowMissingColumns=True)
    latest = timeline.withColumns({name: F.last(name, ignorenulls=True).over(so_far) for name in (out, "_met")})
    latest = latest.filter(F.col("_kind") == 1).drop("_kind", "_tie")
    latest = _crowded(latest, table, left_ts, hot, "_met")
    found = {out: F.when(hot.is_hot(), F.col("_met._login")).otherwise(F.col(out))}
    found |= {name: F.when(hot.is_hot(), F.col(f"_met.{name}")) for name in counts}
    return latest.withColumns(found).drop("_met")


def _with_tie_slice(rows: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Add `_tie_slice`, an order-keeping slice of the id: a million neighbours of a number, or
    the few characters of a text behind what all ids of the instant begin with."""
    if isinstance(rows.schema[tie].dataType, T.IntegralType):
        return rows.withColumn("_tie_slice", F.shiftright(tie, 20))
    same = "filter(sequence(1, least(length(_low), length(_high))), i -> substr(_low, i, 1) <> substr(_high, i, 1))"
    common = F.expr(f"if(_low = _high, length(_low), coalesce(array_min({same}) - 1, least(length(_low), length(_high))))")
    ends = rows.groupBy(key, ts).agg(F.min(tie).alias("_low"), F.max(tie).alias("_high"))
    ends = ends.select(key, ts, common.alias("_common"))
    sliced = null_safe_join(rows, ends, [key, ts], "left")
    return sliced.withColumn("_tie_slice", F.substring(F.col(tie), F.lit(1), F.col("_common") + 4)).drop("_common")


def previous_row(
    df: DataFrame, ts: str, tie: str, columns: list[str], out: str, hot: HotKeys
) -> DataFrame:
    """Add the struct `out`: the key's row just before each row in the order (ts, tie)."""
    key = hot.key
    row = F.struct(*columns)
    plain = hot.without(df)
    plain = plain.withColumn(out, F.lag(row).over(Window.partitionBy(key).orderBy(ts, tie)))
    if not hot.any:
        return plain

    # Hot keys, from the inside out: within an id slice of one instant, then the last row
    # of the slice before within the minute, then the last row of the minute before.
    cut = hot.only(df).withColumns({"_row": row, "_minute": epoch_bucket(F.col(ts), MINUTE)})
    cut = _with_tie_slice(cut, key, ts, tie)
    slice_keys = [key, "_minute", ts, "_tie_slice"]
    tails = cut.groupBy(*slice_keys).agg(F.max_by("_row", F.col(tie)).alias("_tail"))
    minutes = tails.groupBy(key, "_minute").agg(F.max_by("_tail", F.struct(ts, "_tie_slice")).alias("_tail"))
    minutes = minutes.select(
        key, "_minute", F.lag("_tail").over(Window.partitionBy(key).orderBy("_minute")).alias("_from_minute")
    )
    in_minute = F.lag("_tail").over(Window.partitionBy(key, "_minute").orderBy(ts, "_tie_slice"))
    handed = null_safe_join(tails.withColumn("_from_slice", in_minute), minutes, [key, "_minute"], "left")
    handed = handed.select(*slice_keys, F.coalesce("_from_slice", "_from_minute").alias("_handed"))
    within = F.lag("_row").over(Window.partitionBy(*slice_keys).orderBy(tie))
    busy = null_safe_join(cut.withColumn("_within", within), handed, slice_keys, "left")
    busy = busy.withColumn(out, F.coalesce("_within", "_handed")).select(*df.columns, out)
    return plain.unionByName(busy)
