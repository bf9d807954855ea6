"""As-of join: the latest right row per key at or before each left row's time.

One exchange on the key for ordinary keys. A key with more than ``hot_rows``
rows is first cut into time ranges of about equal size, so that its rows spread
over many tasks; the last right row before each range is carried in by a small
table (one row per hot range). Expects a UTC session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskspark.functions.search import cuts_below, double_array

HOT_ROWS = 2_000_000
MAX_RANGES = 4096
LANES = 1024
BROADCAST_ROWS = 100_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_ts: str,
    right_ts: str,
    payload: list[str],
    tie_break: list[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Left as-of join; ``payload`` columns of ``right`` are appended (NULL without a match).

    ``tie_break`` orders right rows of one key and time, the greatest wins. It
    defaults to the payload, so the result does not depend on row order.
    ``hot_rows=None`` skips the look for hot keys.
    """
    order_type = left.schema[left_ts].dataType
    # A left row without key or time matches nothing: it gets a lane of its own, away from right rows.
    complete = F.col(by).isNotNull() & F.col(left_ts).isNotNull()
    lane = F.when(complete, F.lit(0)).otherwise(_spread(F.struct(*left.columns)))
    left_rows = left.select(
        F.col(by).alias("_key"),
        F.col(left_ts).alias("_ts"),
        F.lit(1).alias("_side"),
        lane.alias("_lane"),
        F.struct(*left.columns).alias("_left"),
    )
    right_rows = right.where(F.col(by).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(by).alias("_key"),
        F.col(right_ts).cast(order_type).alias("_ts"),
        F.lit(0).alias("_side"),
        F.lit(0).alias("_lane"),
        F.struct(*payload).alias("_right"),
        *([F.struct(*tie_break).alias("_tie")] if tie_break else []),
    )
    hot = _hot_ranges(left_rows, right_rows, hot_rows) if hot_rows else None
    if hot is None:
        matched = _latest_in_group(left_rows, right_rows, ["_key", "_lane"])
    else:
        matched = _with_hot_keys(left_rows, right_rows, hot)
    return matched.select("_left.*", *[F.col("_right")[c].alias(c) for c in payload])


def _spread(row: Column) -> Column:
    """A lane number above 0, by row content."""
    return F.pmod(F.xxhash64(row), F.lit(LANES)).cast("int") + 1


def _latest_in_group(left_rows: DataFrame, right_rows: DataFrame, group: list[str]) -> DataFrame:
    """Left rows with the last right row at or before them inside their group."""
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)
    running = Window.partitionBy(*group).orderBy("_ts", "_side", _tie(right_rows))
    running = running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        both.withColumn("_right", F.last("_right", ignorenulls=True).over(running))
        .where(F.col("_side") == 1)
        .drop("_side", "_tie", "_ts")
    )


def _tie(right_rows: DataFrame) -> str:
    """The column that orders right rows of one time; the payload itself unless told otherwise."""
    return "_tie" if "_tie" in right_rows.columns else "_right"


def _hot_ranges(left_rows: DataFrame, right_rows: DataFrame, hot_rows: int) -> list | None:
    """(key, range starts) of every hot key, or None when no key is hot.

    At most (total rows / hot_rows) keys qualify, and the starts of all of them
    together are at most twice that many numbers.
    """
    timed = left_rows.where("_lane = 0")
    keys = timed.select("_key").unionByName(right_rows.select("_key"))
    hot = keys.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).collect()
    if not hot:
        return None
    key_field = T.StructField("_key", left_rows.schema["_key"].dataType)
    wanted = left_rows.sparkSession.createDataFrame(
        [(r["_key"], max(1, MAX_RANGES * hot_rows // (2 * r["_n"]))) for r in hot],
        T.StructType([key_field, T.StructField("_step", T.LongType())]),
    )
    times = timed.select("_key", "_ts").unionByName(right_rows.select("_key", "_ts"))
    grid = double_array([i / MAX_RANGES for i in range(1, MAX_RANGES)])
    starts = (
        times.join(F.broadcast(wanted), "_key")
        .groupBy("_key", "_step")
        .agg(F.percentile_approx(_micros(F.col("_ts")), grid, F.lit(10 * MAX_RANGES)).alias("_grid"))
        # A key of n rows gets about 2n / hot_rows ranges.
        .withColumn("_grid", F.filter("_grid", lambda c, i: (i + 1) % F.col("_step") == 0))
        .select("_key", F.array_sort(F.array_distinct("_grid")).alias("_cuts"))
    )
    return [(r["_key"], list(r["_cuts"])) for r in starts.collect()]


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _with_hot_keys(left_rows: DataFrame, right_rows: DataFrame, hot: list) -> DataFrame:
    """Window per (key, range); ranges that find nothing take the carried row.

    A cut that many rows share (a burst at one instant) makes two ranges: the
    instant itself and what follows. Left rows at such an instant all have the
    same answer, the carried row, and are spread over lanes.
    """
    spark = left_rows.sparkSession
    key_field = T.StructField("_key", left_rows.schema["_key"].dataType)
    lookup = F.broadcast(
        spark.createDataFrame(hot, T.StructType([key_field, T.StructField("_cuts", T.ArrayType(T.LongType()))]))
    )
    spot_rows = [(key, i) for key, cuts in hot for i in range(2 * len(cuts) + 1)]

    def place(rows: DataFrame) -> DataFrame:
        # Even numbers are the open ranges between cuts, odd numbers the cut instants.
        micros = _micros(F.col("_ts"))
        below = cuts_below(F.col("_cuts"), micros, MAX_RANGES)
        on_cut = F.coalesce(F.get("_cuts", below) == micros, F.lit(False)).cast("int")
        known = F.col("_cuts").isNotNull() & F.col("_ts").isNotNull()
        spot = F.when(known, F.lit(2) * below + on_cut).otherwise(F.lit(-1))
        return rows.join(lookup, "_key", "left").withColumn("_range", spot).drop("_cuts")

    left_placed, right_placed = place(left_rows), place(right_rows)
    is_hot = F.col("_range") >= 0
    last_right = (
        right_placed.where(is_hot)
        .groupBy("_key", "_range")
        .agg(F.max_by("_right", F.struct("_ts", _tie(right_rows))).alias("_right"))
    )
    spots = spark.createDataFrame(spot_rows, T.StructType([key_field, T.StructField("_range", T.IntegerType())]))
    by_range = Window.partitionBy("_key").orderBy("_range")
    up_to_here = F.last("_right", ignorenulls=True).over(by_range)
    before_here = F.last("_right", ignorenulls=True).over(by_range.rowsBetween(Window.unboundedPreceding, -1))
    carried = spots.join(last_right, ["_key", "_range"], "left").select(
        "_key",
        "_range",
        F.when(F.col("_range") % 2 == 1, up_to_here).otherwise(before_here).alias("_carried"),
    )
    if len(spot_rows) <= BROADCAST_ROWS:
        carried = F.broadcast(carried)
    burst = F.when(F.col("_range") % 2 == 1, _spread(F.col("_left"))).otherwise(F.col("_lane"))
    needed = right_placed.where((F.col("_range") < 0) | (F.col("_range") % 2 == 0))
    found = _latest_in_group(left_placed.withColumn("_lane", burst), needed, ["_key", "_range", "_lane"])
    return (
        found.join(carried, ["_key", "_range"], "left")
        .withColumn("_right", F.coalesce("_right", "_carried"))
        .select("_key", "_left", "_right")
    )
