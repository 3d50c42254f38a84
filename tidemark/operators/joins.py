"""Joins the pipeline needs beyond a plain `df.join`.

Strategy is left to Catalyst and AQE, which broadcast a side by its size in bytes; nothing here
hints a broadcast of a table."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.topics import within_offsets

def join_inner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "inner")


def join_left_all(base: DataFrame, others: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """`base` left-joined with each of the others on the same key columns.

    The key's partitioning is reused from one join to the next."""
    return reduce(lambda acc, other: acc.join(other, list(on), "left"), others, base)


def compare_full_outer(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_value: str, right_value: str
) -> DataFrame:
    """Two layers side by side: key, value of each, NULL where a layer lacks the key."""
    return left.select(*on, left_value).join(
        right.select(*on, right_value), list(on), "full_outer"
    )


def join_exists(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_semi")


def join_not_exists(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_anti")


def join_not_in(
    left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]
) -> DataFrame:
    """`left_on NOT IN (SELECT right_on FROM right)` with SQL's NULL rules, for any sizes.

    Spark plans NOT IN by broadcasting the subquery whatever its size (a nested loop when
    there are several columns). Here each pattern of NULLs on the two sides is one equi
    anti join on the columns both have: a row stays only if it compares as surely
    different from every row of the subquery."""
    names = [f"_k{n}" for n in range(len(left_on))]
    keys = right.select(*[F.col(r).alias(n) for r, n in zip(right_on, names, strict=True)])
    keys = keys.distinct()
    kept = left
    # The patterns that occur, from one aggregate: at most 2^n rows. Others need no join
    right_patterns = _patterns(keys, names)
    for known in right_patterns:
        side = keys.where(_known(names, known))
        if all(known):
            pairs = zip(left_on, names, strict=True)
            kept = kept.join(side, _all([F.col(c) == F.col(n) for c, n in pairs]), "left_anti")
            continue
        # Few distinct patterns reach here in practice: rows with a NULL in the key
        usable = [(c, n) for c, n, k in zip(left_on, names, known, strict=True) if k]
        kept = _drop_possible(kept, side, usable)
    return _drop_left_nulls(kept, keys, list(left_on), names, right_patterns)


def _patterns(rows: DataFrame, names: Sequence[str]) -> list[tuple[bool, ...]]:
    """Which columns are set together, for every combination that occurs."""
    flags = rows.select(*[F.col(n).isNotNull().alias(f"_f{i}") for i, n in enumerate(names)])
    return sorted((tuple(row) for row in flags.distinct().collect()), reverse=True)


def _known(names: Sequence[str], known: Sequence[bool]) -> Column:
    checks = [F.col(n).isNotNull() if k else F.col(n).isNull() for n, k in zip(names, known)]
    return _all(checks)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _drop_if_any(left: DataFrame, side: DataFrame, condition: Column) -> DataFrame:
    """Left rows meeting `condition` go when `side` has any row: its first one decides."""
    return left.join(F.broadcast(side.limit(1)), condition, "left_anti")


def _drop_possible(left: DataFrame, side: DataFrame, usable: list[tuple[str, str]]) -> DataFrame:
    """Drop left rows that may equal a row of `side` on its non-NULL columns."""
    if not usable:
        return _drop_if_any(left, side, F.lit(True))
    names = [n for _, n in usable]
    return left.join(
        side.select(*names).distinct(), _all([F.col(c) == F.col(n) for c, n in usable]), "left_anti"
    )


def _drop_left_nulls(
    left: DataFrame,
    keys: DataFrame,
    columns: list[str],
    names: list[str],
    right_patterns: list[tuple[bool, ...]],
) -> DataFrame:
    """Drop left rows whose own NULLs leave them possibly equal to a row of `keys`."""
    for known in _patterns(left, columns):
        if all(known):
            continue
        pattern = _known(columns, known)
        pairs = [(c, n) for c, n, k in zip(columns, names, known) if k]
        if not pairs:
            left = _drop_if_any(left, keys, pattern)
            continue
        # On each column the row does have: equal, or NULL in the subquery. Split by the
        # subquery's own pattern so that every join keeps an equality
        occurring = {tuple(r for r, k in zip(right, known) if k) for right in right_patterns}
        for right_known in sorted(occurring, reverse=True):
            side = keys.where(_known([n for _, n in pairs], right_known))
            usable = [pair for pair, k in zip(pairs, right_known) if k]
            if not usable:
                left = _drop_if_any(left, side, pattern)
                continue
            side = side.select(*[n for _, n in usable]).distinct()
            equal = _all([F.col(c) == F.col(n) for c, n in usable])
            left = left.join(side, equal & pattern, "left_anti")
    return left


def join_cross_values(rows: DataFrame, values: dict[str, Column], name: str, value: str) -> DataFrame:
    """One row per (row, named value): an unpivot within the row, nothing is shuffled."""
    pairs = [F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in values.items()]
    return rows.select("*", F.inline(F.array(*pairs)))


OFFSETS_PER_SLOT = 1 << 20


def join_offset_range(
    rows: DataFrame,
    bounds: DataFrame,
    partition: str = "kafka_partition",
    offset: str = "kafka_offset",
) -> DataFrame:
    """Rows in their partition's [start_offset, end_offset), with the bounds' columns.

    `bounds` has a row per partition and period. The outermost bounds of each partition are put
    into the scan as values: one row per topic partition reaches the driver. Offsets are cut into
    slots, so rows meet the periods of their own slot, and a topic of few partitions is dealt out
    to as many tasks as it has slots."""
    outer = bounds.groupBy(partition).agg(
        F.min("start_offset").alias("low"), F.max("end_offset").alias("high")
    ).where("low IS NOT NULL AND high IS NOT NULL").collect()
    lows = {row[partition]: row["low"] for row in outer}
    highs = {row[partition]: row["high"] for row in outer}
    first = F.floor(F.col("start_offset") / OFFSETS_PER_SLOT)
    last = F.floor((F.col("end_offset") - 1) / OFFSETS_PER_SLOT)
    periods = bounds.where("start_offset < end_offset").withColumn("_slot", F.explode(F.sequence(first, last)))
    slotted = rows.where(within_offsets(lows, highs, partition, offset)).withColumn(
        "_slot", F.floor(F.col(offset) / OFFSETS_PER_SLOT)
    )
    inside = (F.col(offset) >= F.col("start_offset")) & (F.col(offset) < F.col("end_offset"))
    return slotted.join(periods, [partition, "_slot"]).where(inside).drop("_slot")


def join_correlated_max(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows that hold their key's largest value, ties included.

    The maxima are pre-aggregated; a hot key only meets one row of them, and AQE splits
    its side of the join."""
    largest = rows.groupBy(*keys).agg(F.max(column).alias("_max"))
    return rows.join(largest, list(keys)).where(F.col(column) == F.col("_max")).drop("_max")
