"""The windows of benchmark days, rebuilt from their samples and their Bronze rows.

A day's samples are those between its start and end, so no pair of samples crosses from one
day to the next: every step is keyed by the day, and many days are built in one run."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.labels import first_match, rate_bucket, regime
from tidemark.functions.times import epoch_window, instant
from tidemark.operators.joins import join_offset_range
from tidemark.operators.messages import message_percentiles, message_windows
from tidemark.operators.usage import (
    catalog_windows,
    flag_exits,
    host_contaminated,
    host_windows,
    neighbour_cores,
    service_windows,
)
from tidemark.session import scratch_path
from tidemark.sources.tables import delete_path, replace_days

DAY = ["day"]


@dataclass(frozen=True)
class DayInputs:
    """What days are built from.

    `days`: day, branch, start_ts, end_ts, caught_up_at, one row per day. `bounds`: day,
    kafka_partition, start_offset, end_offset. `services`: service, branch, layer."""

    days: DataFrame
    bounds: DataFrame
    bronze: DataFrame
    samples: DataFrame
    services: DataFrame
    exits: DataFrame
    catalog_samples: DataFrame
    host_samples: DataFrame
    postgres_service: str


def day_dates(days: DataFrame) -> DataFrame:
    """Each day's [start, end), the start moved back to its window's, once per date it
    touches."""
    start = F.timestamp_seconds(epoch_window(F.col("start_ts")))
    calendar = days.select("day", start.alias("_start"), instant(F.col("end_ts")).alias("_end"))
    dates = F.explode(F.sequence(F.to_date("_start"), F.to_date("_end")))
    return calendar.withColumn("_date", dates)


def in_day(rows: DataFrame, dates: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows of each day's range. Days meet rows by the dates both touch, an equality; the
    range is checked after."""
    moment = instant(F.col(ts))
    return (
        rows.withColumn("_date", F.to_date(moment))
        .join(dates, "_date")
        .where((moment >= F.col("_start")) & (moment < F.col("_end")))
        .drop("_date", "_start", "_end")
    )


def day_windows(
    inputs: DayInputs,
    max_gap_seconds: float = c.MAX_SAMPLE_GAP_SECONDS,
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> dict[str, DataFrame]:
    """The three tables of windows: services, catalogs, branches. All three read the services'
    usage, which `keep` may store, so that it is computed once."""
    days = day_dates(inputs.days)
    built = service_windows(
        in_day(inputs.samples, days), ["day", "service"], max_gap_seconds=max_gap_seconds
    )
    built = keep(flag_exits(built, in_day(inputs.exits, days), ["day", "service"]))
    services = built.join(inputs.services, "service")
    postgres = built.where(F.col("service") == inputs.postgres_service)
    catalogs = catalog_windows(
        in_day(inputs.catalog_samples, days), postgres, max_gap_seconds=max_gap_seconds, keys=DAY
    )
    owner = first_match({b: F.col("db") == db for db, b in c.CATALOG_BRANCHES.items()})
    return {
        "service_windows": services,
        "catalog_windows": catalogs.withColumn("branch", owner),
        "branch_windows": branch_windows(inputs, built, days),
    }


def branch_windows(
    inputs: DayInputs, service_usage: DataFrame, dates: DataFrame
) -> DataFrame:
    """Messages, latency, regime and traffic level per window, with the host's health.

    The neighbours' CPU is what the host used beyond all sampled services of the day,
    shared ones included."""
    bronze = join_offset_range(inputs.bronze, inputs.bounds).select(
        "day", "kafka_partition", "kafka_offset", "collection", "event_time", "processed_at"
    )
    messages = message_windows(message_percentiles(bronze, DAY), DAY)
    hosts = host_windows(in_day(inputs.host_samples, dates), DAY)
    health = neighbour_cores(hosts, service_usage, keys=DAY)
    health = health.select(
        "day",
        "window_epoch",
        F.lit(True).alias("_host"),
        *[F.col(name).alias(f"_{name}") for name in HEALTH],
    )
    calendar = inputs.days.select("day", "branch", "caught_up_at")
    joined = messages.join(calendar, "day").join(health, ["day", "window_epoch"], "left")
    contaminated = host_contaminated(
        F.coalesce("_host", F.lit(False)), F.col("_steal_pct"), F.col("_neighbour_cpu_cores")
    )
    return joined.select(
        "day",
        "branch",
        "window_epoch",
        "messages",
        "latency_p50_ms",
        "latency_p95_ms",
        "collections",
        regime(F.col("window_epoch"), F.col("caught_up_at")).alias("regime"),
        rate_bucket(F.col("messages")).alias("rate_bucket"),
        *[F.col(f"_{name}").alias(alias) for name, alias in HEALTH.items()],
        contaminated.alias("host_contaminated"),
    )


# Host figure -> its column in the branch's windows
HEALTH = {
    "steal_pct": "host_steal_pct",
    "psi_mem_ms": "host_psi_mem_ms",
    "psi_cpu_ms": "host_psi_cpu_ms",
    "psi_io_ms": "host_psi_io_ms",
    "min_available_mib": "host_min_available_mib",
    "neighbour_cpu_cores": "neighbour_cpu_cores",
}


def rebuild_days(inputs: DayInputs, root: str, **options) -> dict[str, str]:
    """Write the windows in place of those of the days asked for, and of no others; returns the
    paths. A day that has no windows any more ends up without any. Rebuilding a day gives the
    same rows."""
    spark = inputs.days.sparkSession
    aside = scratch_path(spark, "service-usage")

    def keep(rows: DataFrame) -> DataFrame:
        rows.write.parquet(aside)
        return spark.read.schema(rows.schema).parquet(aside)

    # A row per day of the calendar that was asked for
    days = [r[0] for r in inputs.days.select(F.col("day").cast("string")).distinct().collect()]
    paths = {}
    for name, rows in day_windows(inputs, keep=keep, **options).items():
        paths[name] = f"{root}/{name}"
        replace_days(rows, paths[name], "day", days)
    delete_path(spark, aside)
    return paths
