"""Deduplication on an event key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import between_times


def keep_first(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """One row per key, the first in `order`.

    The filter on the rank becomes a group limit on both sides of the shuffle: every map
    task sends at most one row per key, so a key with very many copies costs no more
    than any other."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_batch(
    rows: DataFrame, key: str = "seq", order: tuple[Column | str, ...] = ("processed_at",)
) -> DataFrame:
    """One row per event: copies are the same event, the earliest processed one stays. Copies of
    one time are ordered by a hash of the row, so that the same one stays in every run."""
    return keep_first(rows, [key], *order, F.xxhash64(*map(F.col, rows.columns)))


def not_yet_in(
    rows: DataFrame, target: DataFrame, key: str = "seq", bounds: tuple | None = None
) -> DataFrame:
    """Rows whose key the target lacks. With `bounds`, the batch's (min, max) event time,
    only that part of the target is read: copies of an event share its time."""
    known = target if bounds is None else between_times(target, *bounds)
    return rows.join(known.select(key), key, "left_anti")


def dedup_incremental(
    rows: DataFrame,
    target: DataFrame,
    key: str = "seq",
    order: tuple[Column | str, ...] = ("processed_at",),
    bounds: tuple | None = None,
) -> DataFrame:
    """`dedup_batch`, minus the events the target already holds."""
    return not_yet_in(dedup_batch(rows, key, order), target, key, bounds)
