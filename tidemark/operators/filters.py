"""Filters by ranges of hours."""

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import DAY

HOUR = timedelta(hours=1)


def listed_hours(ranges: Sequence[tuple[str, str]]) -> list[str]:
    """Every hour of the [start, end) ranges, once."""
    hours = set()
    for start, end in ranges:
        hour = datetime.fromisoformat(start)
        while hour < datetime.fromisoformat(end):
            hours.add(hour.isoformat(" "))
            hour += HOUR
    return sorted(hours)


def hour_ranges_filter(
    rows: DataFrame, ranges: Sequence[tuple[str, str]], ts: str = "event_time"
) -> DataFrame:
    """Rows whose time lies in one of the [start, end) ranges of whole hours, as values.

    One scan for any number of ranges: the days they touch prune partitions, the outermost
    bounds prune row groups, and the hour is looked up in a set. Hours grow with the time
    covered and not with the rows."""
    hours = listed_hours(ranges)
    if not hours:
        return rows.where(F.lit(False))
    kind = rows.schema[ts].dataType.simpleString()
    last = (datetime.fromisoformat(hours[-1]) + HOUR).isoformat(" ")
    lower, upper = F.lit(hours[0]).cast(kind), F.lit(last).cast(kind)
    # The sets as text: a call to the JVM for every hour would take longer than the scan
    listed = ", ".join(f"{kind} '{h}'" for h in hours)
    inside = (F.col(ts) >= lower) & (F.col(ts) < upper)
    inside &= F.expr(f"CAST(date_trunc('HOUR', `{ts}`) AS {kind}) IN ({listed})")
    if DAY in rows.columns:
        days = ", ".join(f"DATE '{d}'" for d in sorted({h[:10] for h in hours}))
        inside = F.expr(f"{DAY} IN ({days})") & inside
    return rows.where(inside)


def in_hours(rows: DataFrame, hours: DataFrame, ts: str = "event_time") -> DataFrame:
    """Rows of the hours in a table of distinct hours, by a join. Where the rows are split by day,
    the join is on the day as well, so that Spark prunes days while it runs."""
    named = hours.select(F.col("hour").cast("timestamp").alias("_hour"))
    keys = ["_hour"]
    if DAY in rows.columns:
        named = named.withColumn(DAY, F.to_date("_hour"))
        keys.append(DAY)
    hour = F.date_trunc("HOUR", F.col(ts))
    return rows.withColumn("_hour", hour).join(named, keys, "left_semi").drop("_hour").select(*rows.columns)
