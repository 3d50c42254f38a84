"""Message windows and arrival measures: throughput and end-to-end latency."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.times import epoch_window, instant, latency_ms
from tidemark.operators.aggregates import first_copy
from tidemark.operators.percentiles import (
    add_histograms,
    hist_percentiles,
    histogram,
    percentiles_from_histogram,
    percentiles_with_total,
)

QUANTILES = {"latency_p50_ms": 0.5, "latency_p95_ms": 0.95}


def message_latencies(
    bronze: DataFrame, keys: Sequence[str] = (), seconds: int = c.WINDOW_SECONDS
) -> DataFrame:
    """One row per distinct message (of each of `keys`, such as the day): window of its
    write, collection, latency."""
    return first_copy(bronze, [*keys, "kafka_partition", "kafka_offset"]).select(
        *keys,
        "kafka_partition",
        "kafka_offset",
        epoch_window(F.col("processed_at"), seconds).alias("window_epoch"),
        "collection",
        latency_ms(F.col("event_time"), F.col("processed_at")).alias("latency_ms"),
    )


def message_percentiles(bronze: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Messages and latency percentiles by window and collection, NULL for the total."""
    return hist_percentiles(
        message_latencies(bronze, keys),
        [*keys, "window_epoch"],
        "collection",
        "latency_ms",
        QUANTILES,
    )


def latency_histogram(bronze: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return histogram(
        message_latencies(bronze, keys), [*keys, "window_epoch", "collection"], "latency_ms"
    )


def percentiles_of_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """`message_percentiles` from histograms over disjoint offset ranges, such as those of
    the parts of a day loaded one after the other."""
    stacked = reduce(DataFrame.unionByName, parts)
    added = add_histograms(stacked, ["window_epoch", "collection"], "latency_ms")
    return percentiles_with_total(
        added, ["window_epoch"], "collection", "latency_ms", QUANTILES
    )


def message_windows(percentiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per window: its total, and a map of messages by collection (a handful)."""
    is_total = F.col("collection").isNull()
    mix = F.collect_list(
        F.when(~is_total, F.struct("collection", F.col("messages").alias("n")))
    )
    return percentiles.groupBy(*keys, "window_epoch").agg(
        F.max(F.when(is_total, F.col("messages"))).alias("messages"),
        *[F.max(F.when(is_total, F.col(name))).alias(name) for name in QUANTILES],
        F.map_from_entries(F.array_sort(mix)).alias("collections"),
    )


def arrival_measures(
    arrivals: DataFrame, sends: DataFrame | None, keys: Sequence[str] = ()
) -> DataFrame:
    """Per run (`keys`): messages, write window, throughput and latency.

    `arrivals` has kafka_partition, kafka_offset, processed_at; a message's first copy
    counts. Messages of the first commit were written before the window starts: they are
    left out of the throughput, which is NULL for a run of a single commit. Latency is
    taken over arrivals with a send time (`sends`: same key, `sent_at`)."""
    keys = list(keys)
    message = [*keys, "kafka_partition", "kafka_offset"]
    ms = F.unix_millis(instant(F.col("processed_at")))
    first = arrivals.groupBy(*message).agg(F.min(ms).alias("ms"))
    # Counts per millisecond of write: one row per commit is left to find the first one
    commits = first.groupBy(*keys, "ms").agg(F.count(F.lit(1)).alias("n"))
    window = commits.groupBy(*keys).agg(
        F.sum("n").alias("bronze_messages"),
        F.min("ms").alias("lo"),
        F.max("ms").alias("hi"),
        F.min_by("n", "ms").alias("first_n"),
    )
    seconds = (F.col("hi") - F.col("lo")) / F.lit(1000.0)
    rate = (F.col("bronze_messages") - F.col("first_n")) / F.nullif(seconds, F.lit(0.0))
    measures = window.select(
        *keys,
        "bronze_messages",
        F.timestamp_millis("lo").alias("first_processed_at"),
        F.timestamp_millis("hi").alias("last_processed_at"),
        rate.alias("throughput_msg_s"),
    )
    if sends is None:
        return measures
    sent = sends.select(*message, F.unix_millis(instant(F.col("sent_at"))).alias("sent_ms"))
    waits = first.join(sent, message).select(
        *(keys or [F.lit(0).alias("_run")]), (F.col("ms") - F.col("sent_ms")).alias("wait_ms")
    )
    run = keys or ["_run"]
    latency = percentiles_from_histogram(
        histogram(waits, run, "wait_ms"), run, "wait_ms", QUANTILES, count_name="_n"
    ).drop("_n")
    if keys:
        return measures.join(latency, keys, "left")
    return (
        measures.withColumn("_run", F.lit(0)).join(latency, "_run", "left").drop("_run")
    )
