"""Time series of cumulative counters: consecutive samples, and their split over windows.

A lag window over a whole series would put a busy series in one task. Series are cut into
chunks of time: pairs are found within each chunk, and the ends of neighbouring chunks are
paired on their own, so every two consecutive samples still meet exactly once."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.times import instant

CHUNK_SECONDS = 3600


def consecutive_pairs(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    chunk_seconds: int = CHUNK_SECONDS,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Structs `a` and `b` (all columns of the input) for each two consecutive samples of a
    series; rows carry the series columns too.

    Both halves of the result read the one shuffle by (series, chunk). The ends of the
    chunks are one row per series and chunk."""
    series = list(series)
    row = F.struct(*[F.col(name) for name in samples.columns])
    chunk = F.floor(F.unix_seconds(instant(F.col(ts))) / F.lit(chunk_seconds))
    chunked = samples.select(*series, chunk.alias("_chunk"), row.alias("b"))
    within = Window.partitionBy(*series, "_chunk").orderBy(*[f"b.{n}" for n in (ts, *tie_break)])
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    paired = chunked.withColumn("a", F.lag("b").over(within))
    inner = paired.where("a IS NOT NULL").select(*series, "a", "b")
    ends = paired.withColumn("_last", F.last("b").over(whole)).where("a IS NULL")
    across = F.lag("_last").over(Window.partitionBy(*series).orderBy("_chunk"))
    outer = ends.withColumn("a", across).where("a IS NOT NULL").select(*series, "a", "b")
    return inner.unionByName(outer)


def micros(ts: Column) -> Column:
    return F.unix_micros(instant(ts))


def window_micros(us: Column, seconds: int = c.WINDOW_SECONDS) -> Column:
    return us - F.pmod(us, F.lit(seconds * 1_000_000))


def counter_delta(a: Column, b: Column) -> Column:
    """Growth of a cumulative counter; NULL when one is missing or it went down."""
    return F.when(b >= a, (b - a).cast("double"))


def trapezoid(a: Column, b: Column) -> Column:
    """Mean of a level over a pair; NULL when one end is missing."""
    return (a + b) / F.lit(2.0)


def overlapped_windows(start_us: Column, end_us: Column, seconds: int = c.WINDOW_SECONDS) -> Column:
    """Starts (microseconds) of the windows that (start, end] overlaps; start < end."""
    step = F.lit(seconds * 1_000_000).cast("bigint")
    return F.sequence(window_micros(start_us, seconds), window_micros(end_us - 1, seconds), step)


def window_share(
    window_us: Column, start_us: Column, end_us: Column, seconds: int = c.WINDOW_SECONDS
) -> Column:
    """Share of (start, end] that lies in one window."""
    upper = F.least(window_us + F.lit(seconds * 1_000_000), end_us)
    return (upper - F.greatest(window_us, start_us)) / (end_us - start_us).cast("double")
