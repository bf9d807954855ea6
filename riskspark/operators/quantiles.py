"""Exact quantiles of very large columns without sorting them.

Each round counts rows in equal-width value buckets (partial aggregation on the
mappers, at most ``BUCKETS`` groups per open interval) and keeps only the bucket
that holds the wanted rank, until that bucket is one value or few rows. Nothing
is shuffled but bucket counts, and a value that fills a third of the column is
just one large count.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

BUCKETS = 2048
FINISH_ROWS = 2048


@dataclass
class OrderStats:
    """Count, moments and selected order statistics of one metric."""

    n: int
    mean: float | None
    std_pop: float | None
    low: float | None
    high: float | None
    values: dict[int, float] = field(default_factory=dict)

    def discrete(self, p: float) -> float | None:
        """First value whose cumulative share reaches ``p``."""
        return None if self.n == 0 else self.values[_discrete_rank(self.n, p)]

    def linear(self, p: float, clip: tuple[float, float] | None = None) -> float | None:
        """Interpolated quantile; ``clip`` gives the quantile of the clipped column."""
        if self.n == 0:
            return None
        lo, hi, share = _linear_ranks(self.n, p)
        a, b = self.values[lo], self.values[hi]
        if clip is not None:
            a, b = (min(max(v, clip[0]), clip[1]) for v in (a, b))
        return a + (b - a) * share


def _discrete_rank(n: int, p: float) -> int:
    return min(max(math.ceil(p * n), 1), n) - 1


def _linear_ranks(n: int, p: float) -> tuple[int, int, float]:
    position = (n - 1) * p
    lo = math.floor(position)
    return lo, min(lo + 1, n - 1), position - lo


def _wanted_ranks(n: int, request: list[tuple[str, float]]) -> set[int]:
    ranks: set[int] = set()
    for method, p in request:
        if method == "disc":
            ranks.add(_discrete_rank(n, p))
        elif method == "linear":
            ranks.update(_linear_ranks(n, p)[:2])
        elif method == "rank":
            ranks.add(int(p))
        else:
            raise ValueError(f"unknown quantile method {method!r}")
    return ranks


@dataclass
class _Interval:
    metric: str
    low: float
    high: float
    count: int
    before: int
    ranks: set[int]


def long_metric(df: DataFrame, name: str, value: Column) -> DataFrame:
    """One metric in the (metric, value) shape that ``order_statistics`` takes."""
    return df.select(F.lit(name).alias("metric"), value.cast("double").alias("value"))


def order_statistics(
    long: DataFrame,
    requests: dict[str, list[tuple[str, float]]],
    finish_rows: int = FINISH_ROWS,
    buckets: int = BUCKETS,
) -> dict[str, OrderStats]:
    """Exact order statistics of every requested metric of a (metric, value) frame.

    ``requests`` maps a metric to ``[(method, p), ...]`` with method ``disc``,
    ``linear`` or ``rank`` (p is then a position from 0). NULL and NaN are
    ignored, infinities count as the largest double. An
    optional ``weight`` column (bigint) counts a row that many times (the moments are then not
    given). All metrics share each round's single job.
    """
    weighted = "weight" in long.columns
    limit = F.lit(sys.float_info.max)
    finite = F.greatest(F.least(F.col("value"), limit), -limit)
    present = long.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("value", finite)
    if not weighted:
        present = present.withColumn("weight", F.lit(1))
    summary = {
        r["metric"]: r
        for r in present.groupBy("metric")
        .agg(
            F.sum("weight").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std_pop"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .collect()
    }
    result: dict[str, OrderStats] = {}
    open_intervals: list[_Interval] = []
    for metric, request in requests.items():
        row = summary.get(metric)
        if row is None:
            result[metric] = OrderStats(0, None, None, None, None)
            continue
        stats = OrderStats(row["n"], None if weighted else row["mean"], None if weighted else row["std_pop"], row["low"], row["high"])
        result[metric] = stats
        whole = _Interval(metric, row["low"], row["high"], row["n"], 0, _wanted_ranks(row["n"], request))
        open_intervals += _settle(stats, [whole])

    while True:
        # Neighbouring doubles cannot be cut further; few values lie between them.
        wide = [i for i in open_intervals if i.count > finish_rows and i.high / 2 > i.low / 2]
        if not wide:
            break
        narrow = [i for i in open_intervals if i not in wide]
        open_intervals = narrow + _refine(present, wide, result, buckets)
    _finish(present, open_intervals, result)
    return result


def _settle(stats: OrderStats, intervals: list[_Interval]) -> list[_Interval]:
    """Record the ranks that an interval's least and greatest value answer; return what is left."""
    rest = []
    for interval in intervals:
        last = interval.before + interval.count - 1
        for rank in interval.ranks:
            if rank == interval.before or interval.low == interval.high:
                stats.values[rank] = interval.low
            elif rank == last:
                stats.values[rank] = interval.high
        interval.ranks = {r for r in interval.ranks if r not in stats.values}
        if interval.ranks:
            rest.append(interval)
    return rest


def _labelled(present: DataFrame, intervals: list[_Interval]) -> DataFrame:
    """Rows in one of the (disjoint) intervals with its number and bounds, by a join with the table of open intervals."""
    kinds = {"metric": present.schema["metric"].dataType, "interval": T.IntegerType(), "low": T.DoubleType(), "high": T.DoubleType()}
    schema = T.StructType([T.StructField(n, kind) for n, kind in kinds.items()])
    table = present.sparkSession.createDataFrame([(i.metric, n, float(i.low), float(i.high)) for n, i in enumerate(intervals)], schema)
    return present.join(F.broadcast(table), "metric").where(F.col("value").between(F.col("low"), F.col("high")))


def _refine(present: DataFrame, wide: list[_Interval], result: dict[str, OrderStats], buckets: int) -> list[_Interval]:
    # Halves keep the width finite for any pair of doubles.
    share = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
    bucket = F.floor(share * buckets)
    rows = (
        _labelled(present, wide)
        .groupBy("interval", bucket.alias("bucket"))
        .agg(F.sum("weight").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()
    )
    kept = []
    for index, interval in enumerate(wide):
        before = interval.before
        for row in sorted((r for r in rows if r["interval"] == index), key=lambda r: r["bucket"]):
            ranks = {r for r in interval.ranks if before <= r < before + row["n"]}
            child = _Interval(interval.metric, row["low"], row["high"], row["n"], before, ranks)
            kept += _settle(result[interval.metric], [child])
            before += row["n"]
    return kept


def _finish(present: DataFrame, intervals: list[_Interval], result: dict[str, OrderStats]) -> None:
    if not intervals:
        return
    rows = (
        _labelled(present, intervals).groupBy("interval", "value").agg(F.sum("weight").alias("n")).collect()
    )
    for index, interval in enumerate(intervals):
        before = interval.before
        for row in sorted((r for r in rows if r["interval"] == index), key=lambda r: r["value"]):
            for rank in interval.ranks:
                if before <= rank < before + row["n"]:
                    result[interval.metric].values[rank] = row["value"]
            before += row["n"]


def exact_quantiles(df: DataFrame, value: Column, probabilities: list[float], method: str = "disc", **kwargs) -> DataFrame:
    """(p, value) rows with the exact quantiles of one column."""
    request = [(method, p) for p in probabilities]
    stats = order_statistics(long_metric(df, "v", value), {"v": request}, **kwargs)["v"]
    pick = stats.discrete if method == "disc" else stats.linear
    return df.sparkSession.createDataFrame([(p, pick(p)) for p in probabilities], "p double, value double")
