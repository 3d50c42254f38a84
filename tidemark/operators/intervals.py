"""Offsets as sets of runs: what a partition holds, without its rows.

Runs are found per chunk of offsets and never reach over a chunk's border, so a partition with a
third of all rows is spread over as many tasks as it has chunks, and runs of different commits are
merged chunk by chunk."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.sources.tables import CommitTable, PartTable

CHUNK_OFFSETS = 1 << 16
PARTITION = "kafka_partition"
RUNS_SCHEMA = c.schema(kafka_partition="int", start_offset="bigint", end_offset="bigint", n_rows="bigint")
UP_TO = "up_to"  # the last commit behind a part of stored runs


def chunk_of(offset: str) -> Column:
    return F.floor(F.col(offset) / CHUNK_OFFSETS)


def offset_runs(rows: DataFrame, by: Sequence[str] = (PARTITION,), offset: str = "kafka_offset") -> DataFrame:
    """(by..., start_offset, end_offset, n_rows): the runs of consecutive offsets of a chunk, ends
    excluded, and the rows in them, copies included. Rows without an offset are in no run."""
    counted = rows.where(F.col(offset).isNotNull()).groupBy(*by, F.col(offset).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_chunk", chunk_of("_at"))
    # At most CHUNK_OFFSETS offsets a window; offset minus rank is constant within a run
    rank = F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy("_at"))
    runs = counted.withColumn("_run", F.col("_at") - rank).groupBy(*by, "_chunk", "_run")
    ends = [F.min("_at").alias("start_offset"), (F.max("_at") + 1).alias("end_offset"), F.sum("_n").alias("n_rows")]
    return runs.agg(*ends).drop("_chunk", "_run")


def fresh_lengths(runs: DataFrame, by: Sequence[str] = (PARTITION,)) -> DataFrame:
    """`runs` with `fresh`: the offsets of a run that no run before it in order of starts holds. A
    sweep over runs, chunk by chunk; summed up it is the size of their union."""
    order = Window.partitionBy(*by, "_chunk").orderBy("start_offset", "end_offset")
    before = F.max("end_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.greatest("start_offset", F.coalesce(before, F.col("start_offset")))
    swept = runs.withColumn("_chunk", chunk_of("start_offset"))
    return swept.withColumn("fresh", F.greatest(F.col("end_offset") - first, F.lit(0))).drop("_chunk")


def merged_runs(runs: DataFrame, by: Sequence[str] = (PARTITION,)) -> DataFrame:
    """The union of runs as few runs, chunk by chunk, with the sum of their rows."""
    order = Window.partitionBy(*by, "_chunk").orderBy("start_offset", "end_offset")
    before = F.max("end_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (before.isNull() | (F.col("start_offset") > before)).cast("int")
    swept = runs.withColumn("_chunk", chunk_of("start_offset")).withColumn("_begins", begins)
    number = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    groups = swept.withColumn("_run", number).groupBy(*by, "_chunk", "_run")
    ends = [F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"), F.sum("n_rows").alias("n_rows")]
    return groups.agg(*ends).drop("_chunk", "_run")


def completeness_of_runs(runs: DataFrame, bounds: DataFrame) -> DataFrame:
    """`checks.completeness` from runs: per partition the messages expected, found and missing
    between its bounds. Copies and commits that were read twice count once."""
    start = F.coalesce("start_offset", "end_offset")
    ranges = bounds.select(PARTITION, start.alias("_start"), F.col("end_offset").alias("_end"))
    inside = runs.join(ranges, PARTITION).withColumns(
        {"start_offset": F.greatest("start_offset", "_start"), "end_offset": F.least("end_offset", "_end")}
    )
    held = fresh_lengths(inside.where("start_offset < end_offset").select(PARTITION, "start_offset", "end_offset"))
    found = held.groupBy(PARTITION).agg(F.sum("fresh").alias("found"))
    expected, counted = F.col("_end") - F.col("_start"), F.coalesce("found", F.lit(0))
    return ranges.join(found, PARTITION, "left").select(
        PARTITION, expected.alias("expected"), counted.alias("found"), (expected - counted).alias("missing")
    )


class RunStore:
    """The runs of a table, kept beside it: an update reads the commits since the last one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.parts = PartTable(spark, path, UP_TO)

    def position(self) -> int | None:
        return max(map(int, self.parts.current()), default=None)

    def update(self, table: CommitTable) -> bool:
        """Add the runs of what was appended since; whether there was anything."""
        done, current = self.position(), table.current()
        if current is None or (done is not None and done >= current):
            return False
        runs = offset_runs(table.appended(done, current)).withColumn(UP_TO, F.lit(str(current)))
        self.parts.replace(runs, [str(current)])
        return True

    def merge(self) -> None:
        """Put all runs so far together in one part."""
        parts = self.parts.current()
        if len(parts) > 1:
            last = str(self.position())
            self.parts.replace(merged_runs(self.read()).withColumn(UP_TO, F.lit(last)), parts)
            self.parts.drop_keys(set(parts) - {last})

    def read(self) -> DataFrame:
        return self.parts.read(RUNS_SCHEMA).select(*RUNS_SCHEMA.fieldNames())
