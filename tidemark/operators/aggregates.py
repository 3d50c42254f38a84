"""Aggregations. Each is a partial aggregate on the map side, then a small shuffle."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_where(rows: DataFrame, keys: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    """Conditional counts per key: `count(*) FILTER (WHERE ...)` under each name."""
    return rows.groupBy(*keys).agg(*[F.count_if(cond).alias(n) for n, cond in counts.items()])


def sum_where(
    rows: DataFrame, keys: Sequence[str], sums: Mapping[str, tuple[str | Column, Column]]
) -> DataFrame:
    """Conditional sums per key: NULL where no row meets the condition."""
    return rows.groupBy(*keys).agg(
        *[
            F.sum(F.when(cond, F.col(v) if isinstance(v, str) else v)).alias(n)
            for n, (v, cond) in sums.items()
        ]
    )


def any_where(rows: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.bool_or(cond).alias(n) for n, cond in flags.items()])


def distinct_count(rows: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Exact distinct values per key. Spark first makes (key, value) distinct across the
    cluster, so one hot key does not sit in one task."""
    return rows.groupBy(*keys).agg(F.count_distinct(column).alias(name))


def distinct_with_total(
    rows: DataFrame, key: str, label: str, column: str, name: str, total: str = "all"
) -> DataFrame:
    """Exact distinct values per (key, label), and per key under the label `total`.

    The two levels cannot be summed: an account active under two labels counts once in
    the total. Distinct rows are taken before the levels are expanded, so the event rows
    themselves are not doubled. NULL labels are dropped: they would collide with the
    total's NULL."""
    once = rows.select(key, label, column).where(F.col(label).isNotNull()).distinct()
    levels = once.groupingSets([[F.col(key), F.col(label)], [F.col(key)]], key, label)
    return levels.agg(F.count_distinct(column).alias(name)).select(
        key, F.coalesce(F.col(label), F.lit(total)).alias(label), name
    )


def latest_value(rows: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Value of the row with the highest `order` per key."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def first_copy(
    rows: DataFrame, keys: Sequence[str] = ("kafka_partition", "kafka_offset")
) -> DataFrame:
    """One row per message: earliest write and event time over its copies, and the collection of
    its earliest copy. Copies collapse before the shuffle, whatever their number."""
    return rows.groupBy(*keys).agg(
        F.min_by("collection", F.struct("processed_at", "collection")).alias("collection"),
        F.min("processed_at").alias("processed_at"),
        F.min("event_time").alias("event_time"),
    )


def having_more_than(rows: DataFrame, keys: Sequence[str], n: int = 1) -> DataFrame:
    """Key values held by more than `n` rows, with their count."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") > n)


def ratio_of_sums(value: str | Column, weight: str | Column) -> Column:
    """Weighted mean sum(v * w) / sum(w); NULL when the weights sum to 0."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(v * w) / F.nullif(F.sum(w), F.lit(0))


def per_unit(amount: Column, units: Column) -> Column:
    """amount / units, NULL when there are no units."""
    return amount / F.nullif(units, F.lit(0))


def bounds(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.min(column).alias("lower"), F.max(column).alias("upper"))


def running_sum(rows: DataFrame, value: str, order: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Running total by rows. Meant for small pre-aggregated inputs: the commit list, a
    coarse histogram. Without keys all rows are ordered in one task."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn(
        name, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )


def with_group_total(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with its group's total: `sum(value) OVER (PARTITION BY keys)`.

    The total is pre-aggregated and joined back. A window would bring each group whole
    into one task."""
    totals = rows.groupBy(*keys).agg(F.sum(value).alias(name))
    return rows.join(totals, list(keys))
