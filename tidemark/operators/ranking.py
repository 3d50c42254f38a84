"""Ranks, top-k and latest rows, islands of consecutive hours."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_first


def topk_per_group(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """The first `k` rows of each group, ranked. `order` has to settle every tie. At most
    `k` rows per group leave each map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key: `DISTINCT ON`."""
    return keep_first(rows, list(keys), *order)


def latest_one(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.orderBy(*order).limit(1)


def count_up_to(rows: DataFrame, limit: int | None, name: str = "n_rows") -> DataFrame:
    """Row count, or `limit` where there are more. Tasks count, and one number a task is added up:
    a limit before the count would send that many rows of every task to one of them."""
    n = F.count(F.lit(1))
    return rows.agg((n if limit is None else F.least(n, F.lit(limit).cast("bigint"))).alias(name))


def oldest_hours(pending: DataFrame, k: int | None, hour: str = "hour") -> DataFrame:
    """Distinct pending hours, oldest first, at most `k`."""
    hours = pending.select(hour).distinct()
    return hours if k is None else hours.orderBy(hour).limit(k)


def hour_islands(hours: DataFrame, hour: str = "hour") -> DataFrame:
    """Distinct hours -> (start, end) of each run of consecutive ones, end excluded.

    Hour minus rank is constant within a run. Input is one row per hour of the data's
    time range, so the global order is small."""
    numbered = hours.select(hour).distinct().withColumn(
        "_n", F.row_number().over(Window.orderBy(hour))
    )
    anchor = F.col(hour) - F.make_dt_interval(hours=F.col("_n"))
    return (
        numbered.groupBy(anchor.alias("_island"))
        .agg(
            F.min(hour).alias("range_start"),
            (F.max(hour) + F.make_dt_interval(hours=F.lit(1))).alias("range_end"),
        )
        .drop("_island")
    )


def first_flag(rows: DataFrame, column: str, name: str = "is_first") -> DataFrame:
    """`column = min(column) OVER ()`, the minimum as a scalar subquery: a window over all
    rows would bring them into one task."""
    return rows.withColumn(name, F.col(column) == rows.agg(F.min(column)).scalar())
