"""Parquet tables written commit by commit, and tables replaced part by part.

A commit is one folder, `commit_id=<n>`, split by day of event time. Writing a commit again
replaces its folder, so a replayed write leaves the table unchanged. Commit ids only grow:
"appended after a, up to b" and "as of b" are ranges of a partition column, which Spark
prunes before it opens a file.

A commit is finished once its line stands in the table's log. The line is measured by the write
itself: rows, distinct hours, and the lowest and highest value of every number and time, so that
positions, backlogs, touched hours and time ranges are answered without reading data. Lines are
folded into Parquet files that name the last commit in them; what a reader needs of the past are
the totals in the head.

Merged rows live apart from the commits, in `<path>_merged/segment=<n>`, where no writer of
commits can reach them; they keep their commit id. A line of `<path>_merges`, written last, says
of each day up to which commit it was merged, which large commits stayed where they were, and which
segment holds the rest that is still small. A commit that is written again after it was merged is
not read twice, and loses nothing."""

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.logs import FOLD, Line, LineLog, delete_path

COMMIT = "commit_id"
DAY = "event_day"
HOUR_MICROS = 3_600_000_000

_BOUNDS = T.MapType(T.StringType(), T.LongType())
LOG_SCHEMA = T.StructType(
    [
        T.StructField(COMMIT, T.LongType()),
        T.StructField("added_rows", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("hours", T.ArrayType(T.LongType())),
        T.StructField("lows", _BOUNDS),
        T.StructField("highs", _BOUNDS),
    ]
)
CHUNK = "upto"  # the last commit of a folded file


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether `path` exists, on whatever file system the cluster uses."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def partition_folders(spark: SparkSession, path: str, levels: int = 1) -> list[str]:
    """Partition folders below `path`: names only, no data."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path + "/*=*" * levels)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(status.getPath().toString()) for status in fs.globStatus(target) or []]


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A partitioned table with a declared schema; no rows before its first write."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def lines_frame(spark: SparkSession, lines: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """Lines of a log as rows; times are microseconds in the lines. The text is a literal."""
    bare = T.StructType(
        [T.StructField(f.name, T.LongType() if f.dataType == T.TimestampType() else f.dataType) for f in schema]
    )
    text = F.from_json(F.lit(json.dumps(list(lines))), T.ArrayType(bare))
    rows = spark.range(1).select(F.inline(text))
    times = {f.name: F.timestamp_micros(f.name) for f in schema if f.dataType == T.TimestampType()}
    return rows.withColumns(times).select(*schema.fieldNames())


def now_micros() -> int:
    since = datetime.now(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return int(since.total_seconds() * 1_000_000)


def spelled_time(micros: int) -> str:
    """UTC text of a moment, as `between_times` takes it."""
    moment = datetime.fromtimestamp(micros // 1_000_000, timezone.utc)
    return moment.strftime("%Y-%m-%d %H:%M:%S") + f".{micros % 1_000_000:06d}"


@dataclass(frozen=True)
class Merged:
    """What is merged of a day: its commits up to `up_to`, but for those that `stay`; the rows
    that do not fill a file yet are in segment `rest`."""

    up_to: int
    rest: int
    stay: tuple[int, ...]


class CommitTable:
    """An append-only table. `schema` holds the data columns, `time_column` gives the day."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        time_column: str = "event_time",
        cluster_by: Iterable[str] = (),
        rebalance: bool = False,
    ) -> None:
        self.spark = spark
        self.path = path
        self.log = LineLog(spark, f"{path}_commits")
        self.merge_log = LineLog(spark, f"{path}_merges")
        self.schema = schema
        self.time_column = time_column
        self.cluster_by = list(cluster_by)
        self.rebalance = rebalance

    # Writing

    def append(self, rows: DataFrame, commit_id: int) -> int:
        """Write the rows as one commit and return how many there were. Writing the same
        commit again replaces it.

        The commit's line in the log is written last: a reader never sees a commit half written."""
        day = F.to_date(F.col(self.time_column))
        out = rows.select(*self.schema.fieldNames()).withColumn(DAY, day)
        if self.rebalance:
            # One file per day where it fits; AQE splits a day too large for one task
            out = out.hint("rebalance", DAY)
        # Measured in the stage that writes, whose finished tasks count once: a shuffle file that
        # is lost and made again is not counted again
        seen = Observation()
        out = out.observe(seen, *self._measures())
        if self.cluster_by:
            out = out.sortWithinPartitions(DAY, *self.cluster_by)
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy(DAY)
            .parquet(f"{self.path}/{COMMIT}={commit_id}")
        )
        line = self._line(seen.get)
        self._finish(commit_id, line)
        return line["added_rows"]

    def _zoned(self) -> dict[str, Column]:
        """The columns a line keeps bounds of, as numbers: times in microseconds."""
        times = {f.name: F.unix_micros(f.name) for f in self.schema if f.dataType == T.TimestampType()}
        whole = (T.LongType(), T.IntegerType())
        return times | {f.name: F.col(f.name).cast("bigint") for f in self.schema if f.dataType in whole}

    def _measures(self) -> list[Column]:
        hour = F.floor(F.unix_micros(self.time_column) / HOUR_MICROS).cast("bigint")
        bounds = [
            bound(column).alias(f"{name}_{field}")
            for field, column in self._zoned().items()
            for name, bound in (("low", F.min), ("high", F.max))
        ]
        return [F.count(F.lit(1)).alias("n"), F.collect_set(hour).alias("hours"), *bounds]

    def _line(self, seen: Mapping[str, Any]) -> Line:
        def bounds(name: str) -> dict[str, int]:
            found = {field: seen.get(f"{name}_{field}") for field in self._zoned()}
            return {field: value for field, value in found.items() if value is not None}

        return {
            "added_rows": seen.get("n", 0),
            "committed_at": now_micros(),
            "hours": sorted(seen.get("hours", [])),
            "lows": bounds("low"),
            "highs": bounds("high"),
        }

    def _finish(self, commit_id: int, line: Line) -> None:
        """Write the commit's line; every so often, fold the lines."""
        _, folded, _ = self.log.listing()
        before = 0
        if folded is not None and commit_id <= folded:
            # Written again long after: the head's total holds its first count
            known = self._folded(folded).where(F.col(COMMIT) == commit_id)
            before = known.agg(F.max_by("added_rows", CHUNK)).first()[0] or 0
        if self.log.write(commit_id, line | {"change": line["added_rows"] - before}) >= FOLD:
            self._fold()

    def _fold(self) -> None:
        """Move the lines into a Parquet file of their own and their sum into the head. A file
        written by a fold that stopped half way has no head, or the same lines as the next one."""
        _, folded, _ = self.log.listing()
        lines = self.log.read()[1]
        if folded is not None and max(lines) <= folded:
            return
        rows = lines_frame(self.spark, [{COMMIT: n, **line} for n, line in lines.items()], LOG_SCHEMA)
        chunk = f"{self.log.path}/chunks/{CHUNK}={max(lines)}"
        rows.coalesce(1).write.mode("overwrite").parquet(chunk)
        self.log.fold(lambda head, lines: {"rows": total_of(head, lines)})

    # The log

    def _folded(self, last: int) -> DataFrame:
        schema = T.StructType([*LOG_SCHEMA, T.StructField(CHUNK, T.LongType())])
        return read_parts(self.spark, f"{self.log.path}/chunks", schema).where(F.col(CHUNK) <= last)

    def folded_lines(self) -> DataFrame:
        """The lines that were folded, with the file each is in."""
        _, folded, _ = self.log.listing()
        return self._folded(-1 if folded is None else folded)

    def commits(self, after: int | None = None) -> DataFrame:
        """One line per commit: its id, rows added, time, hours and bounds. No data is read, and
        with `after` no line file that ends at or before it."""
        _, folded, _ = self.log.listing()
        _, lines = self.log.read()
        rows = lines_frame(self.spark, [{COMMIT: n, **line} for n, line in lines.items()], LOG_SCHEMA)
        if folded is not None and (after is None or folded > after):
            old = self._folded(folded)
            old = old if after is None else old.where(F.col(CHUNK) > after)
            # A line written again stands above the folded one
            both = old.unionByName(rows.withColumn(CHUNK, F.lit(2**62)))
            values = [n for n in LOG_SCHEMA.fieldNames() if n != COMMIT]
            last = F.max_by(F.struct(*values), CHUNK).alias("line")
            rows = both.groupBy(COMMIT).agg(last).select(COMMIT, "line.*")
        return rows if after is None else rows.where(F.col(COMMIT) > after)

    def current(self) -> int | None:
        """The latest finished commit, from names alone."""
        return self.log.last()

    def rows_after(self, position: int | None) -> int:
        """Rows appended after a commit, all without one: from the head and the lines beside it
        where the commit is no older than they are."""
        _, folded, _ = self.log.listing()
        head, lines = self.log.read()
        if position is None:
            return total_of(head, lines)
        if folded is None or folded <= position:
            return sum(line["added_rows"] for n, line in lines.items() if n > position)
        return self.commits(position).agg(F.sum("added_rows")).first()[0] or 0

    def _lines_between(self, after: int | None, up_to: int) -> list[Line] | None:
        """The lines of a range of commits, None where some of them are folded."""
        _, folded, _ = self.log.listing()
        if folded is not None and (after is None or folded > after):
            return None
        lines = self.log.read()[1]
        return [line for n, line in lines.items() if (after is None or n > after) and n <= up_to]

    def touched(self, after: int | None, up_to: int) -> list[int]:
        """The distinct hours (since 1970) of the rows appended after `after`, up to `up_to`, from
        the log. Their number grows with the time covered, not with rows."""
        lines = self._lines_between(after, up_to)
        if lines is not None:
            return sorted({hour for line in lines for hour in line["hours"]})
        rows = self.commits(after).where(F.col(COMMIT) <= up_to)
        return [r[0] for r in rows.select(F.explode("hours").alias("h")).distinct().orderBy("h").collect()]

    def bounds(self, column: str, after: int | None, up_to: int) -> tuple[int, int] | None:
        """The lowest and highest value of a number or time among the rows appended after `after`,
        up to `up_to`, from the log; None without rows."""
        lines = self._lines_between(after, up_to)
        if lines is None:
            rows = self.commits(after).where(F.col(COMMIT) <= up_to)
            low, high = rows.agg(F.min(F.col("lows")[column]), F.max(F.col("highs")[column])).first()
            return None if low is None else (low, high)
        zones = [line for line in lines if column in line["lows"]]
        if not zones:
            return None
        return min(z["lows"][column] for z in zones), max(z["highs"][column] for z in zones)

    def commits_reaching(self, column: str, low: int) -> DataFrame:
        """Lines of the commits that hold a value of at least `low` in a column."""
        return self.commits().where(F.col("highs")[column] >= low)

    # Reading

    def written(self, commit_id: int) -> DataFrame:
        """The rows of one commit as they were written: only its own folder is listed."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{COMMIT}={commit_id}")

    def merges(self) -> tuple[int, dict[str, Merged]]:
        """The last merged segment (0 without one), and what is merged of each day."""
        days, segment = merged_days(*self.merge_log.read())
        return segment, {day: Merged(d["up_to"], d["rest"], tuple(d["stay"])) for day, d in days.items()}

    def kept(self, days: Mapping[str, Merged]) -> DataFrame:
        """The rows of finished commits that are not merged."""
        commit, day = T.StructField(COMMIT, T.LongType()), T.StructField(DAY, T.DateType())
        rows = read_parts(self.spark, self.path, T.StructType([*self.schema.fields, commit, day]))
        current = self.current()
        rows = rows.where(F.lit(False) if current is None else F.col(COMMIT) <= current)
        if not days:
            return rows
        above = F.coalesce(F.col(COMMIT) > by_day({d: m.up_to for d, m in days.items()}), F.lit(True))
        stay = [f"{d}/{commit}" for d, m in days.items() for commit in m.stay]
        place = F.concat_ws("/", F.col(DAY).cast("string"), F.col(COMMIT).cast("string"))
        return rows.where(above | place.isin(stay) if stay else above)

    def merged(self, segment: int, days: Mapping[str, Merged]) -> DataFrame:
        """Merged rows, with their segment, part (files that are full, or the rest) and bin."""
        places = [T.StructField(n, T.LongType()) for n in (COMMIT, "segment", "bin")]
        places += [T.StructField("part", T.StringType()), T.StructField(DAY, T.DateType())]
        rows = read_parts(self.spark, f"{self.path}_merged", T.StructType([*self.schema.fields, *places]))
        rest = by_day({d: m.rest for d, m in days.items()})
        valid = (F.col("part") == FULL) | (F.col("segment") == rest)
        return rows.where((F.col("segment") <= segment) & valid)

    def scans(self) -> list[DataFrame]:
        """The table as one scan of commits, and one of merged rows where there are any."""
        segment, days = self.merges()
        kept = self.kept(days)
        return [kept, self.merged(segment, days).drop("segment", "part", "bin")] if days else [kept]

    def read(self) -> DataFrame:
        """The rows of all finished commits."""
        scans = self.scans()
        return scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1])

    def as_of(self, commit_id: int) -> DataFrame:
        """The table as it was after `commit_id`."""
        return self.read().where(F.col(COMMIT) <= commit_id)

    def appended(self, after: int | None, up_to: int) -> DataFrame:
        """Rows of the commits after `after`, up to `up_to`; all of them without `after`."""
        rows = self.as_of(up_to)
        return rows if after is None else rows.where(F.col(COMMIT) > after)


FULL, REST = "full", "rest"


def total_of(head: Line, lines: Mapping[int, Line]) -> int:
    return head.get("rows", 0) + sum(line["change"] for line in lines.values())


def merged_days(head: Line, lines: Mapping[int, Line]) -> tuple[dict[str, Line], int]:
    """The last line of each day, and the last segment."""
    days, segment = dict(head.get("days", {})), head.get("segment", 0)
    for number, line in lines.items():
        days |= line["days"]
        for day in line.get("gone", ()):
            days.pop(day, None)
        segment = max(segment, number)
    return days, segment


def by_day(values: dict[str, int]) -> Column:
    """The value of a row's day, null without one; on the partition column, so it prunes."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(DAY).cast("string")).cast("bigint")


def utc(moment: datetime | str) -> Column:
    """A timestamp literal. A datetime without a zone is UTC: PySpark would read it in the
    zone of the driver's machine."""
    if isinstance(moment, datetime):
        zoned = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
        moment = zoned.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(f"{moment}+00:00"))


def between_times(rows: DataFrame, lower, upper, time_column: str = "event_time") -> DataFrame:
    """Rows of a closed time range given as values: prunes the day partitions too."""
    bounded = rows.where(F.col(time_column).between(F.lit(lower), F.lit(upper)))
    if DAY in rows.columns:
        bounded = bounded.where(
            F.col(DAY).between(F.to_date(F.lit(lower)), F.to_date(F.lit(upper)))
        )
    return bounded


def time_bounds(rows: DataFrame, time_column: str = "event_time") -> tuple | None:
    """(min, max) of a batch as values for `between_times`; one row reaches the driver.

    Text, not datetimes: PySpark turns a collected timestamp into the Python process's
    own time zone."""
    row = rows.agg(
        F.min(time_column).cast("string").alias("lower"),
        F.max(time_column).cast("string").alias("upper"),
    ).first()
    return None if row["lower"] is None else (row["lower"], row["upper"])


HOUR_KEY = "hour_key"
GENERATION = "generation"


class PartTable:
    """A table replaced part by part: a part is everything under one key, such as an hour.

    Every replacement is a generation with a folder of its own. One line of `<path>_parts` names
    the keys it replaces, and switches all of them over at once: a reader sees the old parts or the
    new ones, and a write that stopped half way is never seen. A key that the line names and the
    generation has no rows of is empty from then on."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark = spark
        self.path = path
        self.key = key
        self.log = LineLog(spark, f"{path}_parts")

    def current(self) -> dict[str, int]:
        """The generation of each key. Keys grow with time, not with rows."""
        return latest_parts(*self.log.read())

    def replace(self, rows: DataFrame, keys: Iterable[str] = ()) -> list[str]:
        """Put the rows in place of the parts they are of, and of those of `keys`; `rows` holds the
        key as a text column. Returns the keys replaced. Parts are spread over a fixed number of
        tasks, since their files, not their bytes, take the time."""
        last, seen = self.log.last(), Observation()
        generation = 0 if last is None else last + 1
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        out = rows.withColumn(self.key, F.coalesce(F.col(self.key), F.lit("none")))
        # As many values as there are keys, counted in the stage that writes
        out = out.repartition(tasks, self.key).observe(seen, F.collect_set(self.key).alias("keys"))
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy(self.key)
            .parquet(f"{self.path}/{GENERATION}={generation}")
        )
        replaced = sorted({*keys, *seen.get.get("keys", [])})
        if self.log.write(generation, {"keys": replaced}) >= FOLD:
            self.log.fold(lambda head, lines: {"parts": latest_parts(head, lines)})
        return replaced

    def read(self, schema: T.StructType) -> DataFrame:
        """The current rows. The part's key and generation are partition columns, so a filter on
        them is settled before a file is opened."""
        places = [T.StructField(GENERATION, T.LongType()), T.StructField(self.key, T.StringType())]
        rows = read_parts(self.spark, self.path, T.StructType([*schema.fields, *places]))
        parts = [f"'{generation}/{key}'" for key, generation in self.current().items()]
        if not parts:
            return rows.where(F.lit(False)).drop(GENERATION)
        found = F.expr(f"concat({GENERATION}, '/', {self.key}) IN ({', '.join(parts)})")
        return rows.where(found).drop(GENERATION)

    def drop_replaced(self) -> int:
        """Delete the parts that no reader takes any more; returns how many. Scans that began
        before the last replacement must have ended."""
        current, gone = self.current(), 0
        for folder in partition_folders(self.spark, self.path, 2):
            generation, key = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
            if current.get(key) != int(generation):
                delete_path(self.spark, folder)
                gone += 1
        return gone

    def drop_keys(self, old: Iterable[str]) -> int:
        """Drop parts for good; returns how many there were."""
        gone = sorted(set(old) & set(self.current()))
        if gone:
            self.log.append({"keys": [], "gone": gone})
        self.drop_replaced()
        return len(gone)


def latest_parts(head: Line, lines: Mapping[int, Line]) -> dict[str, int]:
    parts = dict(head.get("parts", {}))
    for generation, line in lines.items():
        parts |= dict.fromkeys(line["keys"], generation)
        for key in line.get("gone", ()):
            parts.pop(key, None)
    return parts


def hour_table(spark: SparkSession, path: str) -> PartTable:
    return PartTable(spark, path, HOUR_KEY)


def hour_keys(hours: Iterable[int]) -> list[str]:
    """The keys of hours since 1970."""
    return [datetime.fromtimestamp(3600 * h, timezone.utc).strftime("%Y-%m-%d-%H") for h in hours]


def replace_hours(rows: DataFrame, path: str, time_column: str = "hour", keys: Iterable[str] = ()) -> None:
    """Replace the hours present in the rows and those of `keys`, all at once; the other hours
    stay as they are."""
    key = F.date_format(F.col(time_column), "yyyy-MM-dd-HH")
    hour_table(rows.sparkSession, path).replace(rows.withColumn(HOUR_KEY, key), keys)


def read_hours(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return hour_table(spark, path).read(schema)


def write_by_day(rows: DataFrame, path: str, day: str, mode: str = "overwrite") -> None:
    """Write a table split by a day column; overwriting replaces only the days present."""
    (
        rows.hint("rebalance", day)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(day)
        .parquet(path)
    )


def replace_days(rows: DataFrame, path: str, day: str, days: Sequence[str]) -> None:
    """Write a table split by a day column in place of the given days: one of them that has no
    rows any more ends up empty."""
    spark, seen = rows.sparkSession, Observation()
    wanted = rows.where(F.col(day).cast("string").isin(list(days)))
    # As many values as days were asked for
    counted = wanted.observe(seen, F.collect_set(F.col(day).cast("string")).alias("days"))
    write_by_day(counted, path, day)
    for name in sorted(set(days) - set(seen.get.get("days", []))):
        delete_path(spark, f"{path}/{day}={name}")


def file_stats(table: CommitTable, commit: str = COMMIT) -> DataFrame:
    """Files, bytes and commits behind a stored table, from file metadata and the commit column."""
    scans = [
        scan.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col(commit).alias("commit_id"),
        )
        for scan in table.scans()
    ]
    found = scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1])
    files = found.groupBy("file_path", "commit_id").agg(F.max("file_size").alias("file_size"))
    sizes = files.groupBy("file_path").agg(F.max("file_size").alias("file_size"))
    commits = files.agg(F.countDistinct("commit_id").alias("commits"))
    totals = sizes.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")
    )
    return totals.select("files", "bytes", commits.scalar().alias("commits"))
