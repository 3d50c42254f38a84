"""Exact percentiles from a histogram of whole numbers.

Percentile q of n values is at position h = (n - 1) q: the value of rank floor(h) moved
towards the value of rank ceil(h) by the fraction of h. The value of rank k is the first
one whose running count exceeds k.

The histogram is aggregated on the map side. A running count over one group's histogram
would still pass every distinct value of a hot group through one task, so ranks are found in
two steps: a coarse histogram (one row per `width` values) gives the bucket each rank falls
in, then only those buckets are looked at value by value, `width` rows at most each."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_WIDTH = 1024


def histogram(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (keys, value) as `n`."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n")
    )


def add_histograms(parts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One histogram out of several over disjoint rows: counts of a value add up."""
    return parts.groupBy(*keys, value).agg(F.sum("n").alias("n"))


def _rank_name(name: str, side: str) -> str:
    return f"_{side}_{name}"


def percentiles_from_histogram(
    hist: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    count_name: str = "messages",
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Per key: the number of values, and each quantile under its name.

    `hist` has columns keys, `value` (whole numbers) and `n`, with no NULL key: NULL is
    kept for a total the caller adds."""
    keys = list(keys)
    groups = Window.partitionBy(*keys)
    bucketed = hist.select(
        *keys, F.col(value).alias("_value"), F.col("n").alias("_n"),
        (F.col(value) - F.pmod(F.col(value), F.lit(width))).alias("_bucket"),
    )
    coarse = bucketed.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_bucket_n"))
    running = F.sum("_bucket_n").over(
        groups.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    coarse = coarse.withColumn("_up_to", running).withColumn(
        "_total", F.sum("_bucket_n").over(groups)
    )
    ranks: dict[str, Column] = {}
    positions: dict[str, Column] = {}
    for name, q in quantiles.items():
        h = (F.col("_total") - 1) * F.lit(float(q))
        positions[name] = h
        ranks[_rank_name(name, "lo")] = F.floor(h)
        ranks[_rank_name(name, "hi")] = F.ceil(h)
    before = F.col("_up_to") - F.col("_bucket_n")
    holds = F.lit(False)
    for rank in ranks.values():
        holds = holds | ((rank >= before) & (rank < F.col("_up_to")))
    wanted = coarse.where(holds).select(
        *keys, "_bucket", before.alias("_before"), "_total"
    )
    fine = bucketed.join(wanted, [*keys, "_bucket"])
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_value")
    cum = F.col("_before") + F.sum("_n").over(
        in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    fine = fine.withColumn("_cum", cum)
    found = fine.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[
            F.min(F.when(F.col("_cum") > rank, F.col("_value"))).alias(name)
            for name, rank in ranks.items()
        ],
    )
    return found.select(
        *keys,
        F.col("_total").alias(count_name),
        *[_interpolate(positions[name], name).alias(name) for name in quantiles],
    )


def _interpolate(h: Column, name: str) -> Column:
    lo, hi = F.col(_rank_name(name, "lo")), F.col(_rank_name(name, "hi"))
    return lo + (h - F.floor(h)) * (hi - lo)


def hist_percentiles(
    rows: DataFrame,
    keys: Sequence[str],
    label: str,
    value: str,
    quantiles: Mapping[str, float],
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Percentiles per (keys, label), and per keys over all labels with a NULL label."""
    labelled = histogram(rows.where(F.col(label).isNotNull()), [*keys, label], value)
    return percentiles_with_total(labelled, keys, label, value, quantiles, width)


def percentiles_with_total(
    labelled: DataFrame,
    keys: Sequence[str],
    label: str,
    value: str,
    quantiles: Mapping[str, float],
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """The same from a histogram by label. The total rides along as one more group, told
    from the labels by a flag: joins do not match on NULL."""
    each = labelled.select(*keys, label, value, "n", F.lit(False).alias("_all"))
    total = (
        labelled.groupBy(*keys, value)
        .agg(F.sum("n").alias("n"))
        .select(*keys, F.lit("").alias(label), value, "n", F.lit(True).alias("_all"))
    )
    found = percentiles_from_histogram(
        each.unionByName(total), [*keys, label, "_all"], value, quantiles, width=width
    )
    return found.withColumn(label, F.when(~F.col("_all"), F.col(label))).drop("_all")


def percentile_within_group(column: str | Column, q: float) -> Column:
    """`percentile_cont(q) WITHIN GROUP (ORDER BY column)`.

    It keeps a group's distinct values in memory: for window figures, of which there is
    one per five minutes, and never for events (use the histogram)."""
    return F.percentile(column, F.lit(float(q)))
