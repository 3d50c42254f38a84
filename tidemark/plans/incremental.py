"""Incremental Silver and Gold: read what was appended since, rebuild the hours it touches.

State lives in small logs of lines. A position is staged before a model's write and
marked done after it. A crash in between reads the same commits again: Silver drops the
events it already has, Gold rebuilds an hour that was already right."""

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract as c
from tidemark.operators.dedup import dedup_batch, not_yet_in
from tidemark.operators.filters import hour_ranges_filter
from tidemark.operators.sets import union_all
from tidemark.plans.gold import GOLD, GOLD_INPUTS, GOLD_SCHEMAS
from tidemark.plans.silver import SILVER, SILVER_SCHEMAS, SNAPSHOT
from tidemark.sources.logs import FOLD, Line, LineLog
from tidemark.sources.tables import (
    COMMIT,
    HOUR_MICROS,
    CommitTable,
    hour_keys,
    lines_frame,
    now_micros,
    read_hours,
    replace_hours,
    spelled_time,
)

PASS = "pass_id"


# --- Caps: how far one pass reads -------------------------------------------------------


def _cap(commits: DataFrame, size: str, cap: int, order: str) -> DataFrame:
    """The last commit with a running total of `size` within the cap, at least the first.

    Commits are one line each, so their order in one task is small."""
    running = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = commits.withColumn("_total", F.sum(F.coalesce(size, F.lit(0))).over(running))
    within = F.max(F.when(F.col("_total") <= cap, F.col(order)))
    return totals.agg(F.coalesce(within, F.min(order)).alias("read_up_to"))


def capped_range(
    commits: DataFrame, max_rows: int, after: int | None = None, order: str = COMMIT
) -> DataFrame:
    """One row, `read_up_to`: whole commits after `after` with at most `max_rows` rows in
    all, and at least one. NULL when there is nothing to read."""
    new = commits if after is None else commits.where(F.col(order) > after)
    return _cap(new, "added_rows", max_rows, order)


def capped_range_bytes(
    rows: DataFrame,
    commits: DataFrame,
    max_rows: int,
    max_length: int,
    after: int | None = None,
    content: str = "record",
) -> DataFrame:
    """The same, then capped again by the length of `content` over that range only."""
    # As a value, so that the range prunes partitions before the content is read
    up_to = capped_range(commits, max_rows, after).first()["read_up_to"]
    new = rows if after is None else rows.where(F.col(COMMIT) > after)
    within = new.where(F.col(COMMIT) <= F.lit(up_to).cast("bigint"))
    sizes = within.groupBy(COMMIT).agg(F.sum(F.length(content)).alias("_length"))
    return _cap(sizes, "_length", max_length, COMMIT)


def hours_by_commit(inputs: Sequence[DataFrame], ts: str = "event_time") -> DataFrame:
    """Distinct (commit, hour) pairs of the rows appended to several inputs."""
    pairs = [
        rows.select(COMMIT, F.date_trunc("HOUR", ts).alias("hour")).distinct() for rows in inputs
    ]
    return union_all(pairs).distinct()


def touched_hours(inputs: Sequence[DataFrame], ts: str = "event_time") -> DataFrame:
    """Distinct hours of the rows appended to several inputs."""
    hours = [rows.select(F.date_trunc("HOUR", ts).alias("hour")).distinct() for rows in inputs]
    return union_all(hours).distinct()


def first_touch_cap(touched: DataFrame, max_hours: int) -> DataFrame:
    """One row, `read_up_to`: the commit before the one that would bring the hours over the
    cap. An hour counts once, at the first commit touching it; the first commit is
    always read. The last commit when none goes over."""
    first = touched.groupBy("hour").agg(F.min(COMMIT).alias(COMMIT))
    per_commit = first.groupBy(COMMIT).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy(COMMIT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = per_commit.withColumn("_total", F.sum("_n").over(running)).withColumn(
        "_rank", F.row_number().over(Window.orderBy(COMMIT))
    )
    over = totals.where((F.col("_total") > max_hours) & (F.col("_rank") > 1)).agg(
        (F.min(COMMIT) - 1).alias("_over")
    )
    last = touched.agg(F.max(COMMIT)).scalar()
    return over.select(F.coalesce(F.col("_over"), last).alias("read_up_to"))


# --- State tables -----------------------------------------------------------------------

Row = dict[str, Any]

PROGRESS_SCHEMA = c.schema(model="string", input="string", position="bigint", done="boolean", recorded_at="timestamp")
PENDING_SCHEMA = c.schema(model="string", hour="timestamp", pending="boolean")
BACKLOG_SCHEMA = T.StructType(
    [*c.schema(silver_rows="bigint", gold_hours="bigint"), T.StructField("positions", T.MapType(T.StringType(), T.LongType()))]
)


def last_positions(progress: DataFrame, keys: Sequence[str] = ("model", "input")) -> DataFrame:
    """Latest done position of each reader. Pass ids order what one clock tick cannot."""
    order = F.struct("recorded_at", *([PASS] if PASS in progress.columns else []))
    return (
        progress.where("done").groupBy(*keys).agg(F.max_by("position", order).alias("position"))
    )


def position_or_rows(
    progress: DataFrame, rows: DataFrame, model: str, column: str = SNAPSHOT
) -> DataFrame:
    """One row, `position`: the model's last done position, else the highest commit its
    rows name, else NULL (read everything)."""
    done = last_positions(progress.where(F.col("model") == model), ["model"]).agg(
        F.max("position").alias("_done")
    )
    stored = rows.agg(F.max(column)).scalar()
    return done.select(F.coalesce(F.col("_done"), stored).alias("position"))


def still_pending(log: DataFrame) -> DataFrame:
    """(model, hour) whose latest line says pending. Clearing an hour appends a line."""
    # In one pass an hour is recorded before it is cleared
    order = F.struct(F.col(PASS), (~F.col("pending")).alias("cleared"))
    return (
        log.groupBy("model", "hour")
        .agg(F.max_by("pending", order).alias("pending"))
        .where("pending")
        .select("model", "hour")
    )


class StateLog:
    """Rows of a small state in numbered passes, a line of a log each time; kept in the head as
    far as `kept` finds them of use. Rows are plain values, times are microseconds."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        kept: Callable[[Sequence[Row]], list[Row]],
    ) -> None:
        self.spark = spark
        self.log = LineLog(spark, path)
        self.schema = T.StructType([*schema, T.StructField(PASS, T.LongType())])
        self.kept = kept

    def rows(self) -> list[Row]:
        """All rows still held, in order of writing."""
        return held_rows(*self.log.read())

    def read(self) -> DataFrame:
        return lines_frame(self.spark, self.rows(), self.schema)

    def last_pass(self) -> int:
        return max((row[PASS] for row in self.rows()), default=0)

    def append(self, rows: Sequence[Row], pass_id: int) -> None:
        if rows:
            line = {"rows": [{**row, PASS: pass_id} for row in rows]}
            if self.log.append(line) >= FOLD:
                self.trim(self.kept)

    def trim(self, kept: Callable[[Sequence[Row]], list[Row]]) -> None:
        """Keep only the rows that `kept` finds, in one head."""
        self.log.fold(lambda head, lines: {"rows": kept(held_rows(head, lines))})


def held_rows(head: Line, lines: Mapping[int, Line]) -> list[Row]:
    return [*head.get("rows", []), *(row for line in lines.values() for row in line["rows"])]


def kept_positions(rows: Sequence[Row], since: int | None = None) -> list[Row]:
    """The last done position of every reader, what the last pass staged, and what was recorded
    from `since` (microseconds) on."""
    last_pass = max((row[PASS] for row in rows), default=0)
    last = {(row["model"], row["input"]): at for at, row in enumerate(rows) if row["done"]}
    return [
        row
        for at, row in enumerate(rows)
        if row[PASS] == last_pass
        or last.get((row["model"], row["input"])) == at
        or (since is not None and row["recorded_at"] >= since)
    ]


def kept_hours(rows: Sequence[Row]) -> list[Row]:
    """The hours still pending, and one row of the last pass."""
    last = {(row["model"], row["hour"]): row for row in rows}
    return [row for row in last.values() if row["pending"]] + list(rows[-1:])


# --- Backlog ----------------------------------------------------------------------------


def rows_behind(commits: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows appended after each model's position; every row for a model without one.

    A running total over the list of commits (lines, not rows) says how many rows there are up to
    any commit; a position takes the total of the last commit at or below it."""
    read = F.lit(None).cast("string")
    lines = commits.select(COMMIT, "added_rows", read.alias("model"), F.lit(0).alias("_after"))
    marks = positions.select(
        F.col("position").alias(COMMIT), F.lit(None).cast("bigint").alias("added_rows"), "model", F.lit(1).alias("_after")
    )
    # A mark stands after the commit of its own number, one without a position before all
    order = [F.col(COMMIT).asc_nulls_first(), F.col("_after")]
    totals = lines.unionByName(marks).withColumn("_read", F.coalesce(F.sum("added_rows").over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)))
    whole = commits.agg(F.coalesce(F.sum("added_rows"), F.lit(0)))
    return totals.where("_after = 1").select("model", (whole.scalar() - F.col("_read")).alias("behind"))


def gold_hours_behind(
    appended: Mapping[str, DataFrame],
    inputs: Mapping[str, Sequence[str]],
    positions: Mapping[str, int | None],
) -> DataFrame:
    """Distinct hours each Gold model has to rebuild, from its own position in its own
    inputs. A model that never ran has none: it will build everything anyway."""
    frames = []
    for model, tables in inputs.items():
        position = positions.get(model)
        if position is None:
            continue
        new = [appended[t].where(F.col(COMMIT) > position) for t in tables]
        frames.append(touched_hours(new).select(F.lit(model).alias("model"), "hour"))
    return union_all(frames).groupBy("model").agg(F.count(F.lit(1)).alias("hours"))


# --- The pipeline -----------------------------------------------------------------------


class Pipeline:
    """Bronze, Silver and Gold tables below one root, and the passes that move them on.

    With a choice of Gold models, only the Silver models they read are kept up."""

    def __init__(
        self, spark: SparkSession, root: str, gold_models: Sequence[str] = tuple(GOLD)
    ) -> None:
        self.spark = spark
        self.root = root
        self.gold_models = tuple(gold_models)
        inputs = {table for model in gold_models for table in GOLD_INPUTS[model]}
        self.silver_models = [m for m in SILVER if m in inputs or set(gold_models) == set(GOLD)]
        self.bronze = CommitTable(
            spark, f"{root}/bronze/bronze_events", c.BRONZE_SCHEMA, cluster_by=["collection"]
        )
        self.silver = {
            name: CommitTable(spark, f"{root}/silver/{name}", schema, rebalance=True)
            for name, schema in SILVER_SCHEMAS.items()
            if name in self.silver_models
        }
        self.progress = StateLog(spark, f"{root}/meta/progress", PROGRESS_SCHEMA, kept_positions)
        self.pending = StateLog(spark, f"{root}/meta/pending", PENDING_SCHEMA, kept_hours)

    # Positions

    def _positions(self) -> dict[tuple[str, str], int]:
        """Last done position by (model, input): one row per reader."""
        return {(r["model"], r["input"]): r["position"] for r in self.progress.rows() if r["done"]}

    def stage_positions(self, positions: Mapping[str, Mapping[str, int]], pass_id: int) -> None:
        """Record how far a pass is about to read, by model and input; a position counts
        once its model is marked done."""
        rows = [
            {"model": model, "input": name, "position": position, "done": False, "recorded_at": now_micros()}
            for model, inputs in positions.items()
            for name, position in inputs.items()
        ]
        self.progress.append(rows, pass_id)

    def mark_done(self, models: Sequence[str], pass_id: int) -> None:
        """The positions the pass staged become the models' own."""
        staged = [
            {**row, "done": True, "recorded_at": now_micros()}
            for row in self.progress.rows()
            if row[PASS] == pass_id and row["model"] in models and not row["done"]
        ]
        self.progress.append(staged, pass_id)

    def trim_progress(self, since: datetime) -> None:
        """Drop stored positions recorded before `since` (UTC without a zone), but for the last
        done one of every reader and the last pass."""
        zoned = since if since.tzinfo else since.replace(tzinfo=timezone.utc)
        micros = int(zoned.timestamp()) * 1_000_000 + zoned.microsecond
        self.progress.trim(lambda rows: kept_positions(rows, micros))

    # Silver

    def append_bronze(self, rows: DataFrame, commit_id: int) -> int:
        return self.bronze.append(rows, commit_id)

    def silver_pass(self, max_rows: int | None = None, up_to: int | None = None) -> int:
        """One pass of every Silver model over the commits it has not read, or those of them up to
        `up_to`. Returns the number of models that had something to read.

        A pass repeated after a crash reads the same range again: the events a model
        already holds are dropped."""
        current = self.bronze.current()
        if current is None:
            return 0
        current = current if up_to is None else min(current, up_to)
        done = self._positions()
        # Models mostly share their position: what depends on it alone is asked once
        read_up_to: dict[int | None, int] = {}
        bounds: dict[tuple, tuple | None] = {}
        work = {}
        for model in self.silver_models:
            last = done.get((model, "bronze"))
            if last is not None and last >= current:
                continue
            if last not in read_up_to:
                read_up_to[last] = self._read_up_to(last, current, max_rows)
            up_to = read_up_to[last]
            if (last, up_to) not in bounds:
                found = self.bronze.bounds("event_time", last, up_to)
                bounds[last, up_to] = found and tuple(map(spelled_time, found))
            work[model] = (last, up_to, bounds[last, up_to])
        if not work:
            return 0
        pass_id = self.progress.last_pass() + 1
        self.stage_positions({m: {"bronze": up_to} for m, (_, up_to, _) in work.items()}, pass_id)
        self._each(list(work), lambda m: self._build_silver(m, *work[m]), pass_id)
        return len(work)

    def _each(self, models: Sequence[str], build: Callable[[str], None], pass_id: int) -> None:
        """Build the models side by side: their jobs share the cluster. Those that finished
        are marked done even when another one failed."""
        failed = {}

        def run(model: str) -> None:
            try:
                build(model)
            except Exception as error:
                failed[model] = error

        with ThreadPoolExecutor(max_workers=len(models)) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(run), models))
        self.mark_done([m for m in models if m not in failed], pass_id)
        for model, error in failed.items():
            raise RuntimeError(f"{model} failed") from error

    def _read_up_to(self, last: int | None, current: int, max_rows: int | None) -> int:
        if max_rows is None:
            return current
        listed = self.bronze.commits(last).where(F.col(COMMIT) <= current)
        capped = capped_range(listed, max_rows, last).first()[0]
        return current if capped is None else capped

    def _build_silver(
        self, model: str, last: int | None, up_to: int, bounds: tuple | None
    ) -> None:
        table = self.silver[model]
        current = table.current()
        batch = self.bronze.appended(last, up_to).withColumn(SNAPSHOT, F.lit(up_to))
        rows = dedup_batch(SILVER[model](batch))
        if current is not None and bounds is not None:
            rows = not_yet_in(rows, table.as_of(current), bounds=bounds)
        table.append(rows, 1 if current is None else current + 1)

    # Gold

    def gold_pass(self, max_hours: int | None = None) -> int:
        """One pass of every Gold model: note the hours its inputs touched, rebuild the
        oldest pending ones (all without a cap). Returns the models that rebuilt any."""
        done = self._positions()
        pass_id = self.progress.last_pass() + 1
        current = {name: table.current() for name, table in self.silver.items()}
        inputs: dict[str, dict[str, int]] = {}
        touched, moved = [], {}
        for model in self.gold_models:
            known = {t: current[t] for t in GOLD_INPUTS[model] if current[t] is not None}
            last = {t: done.get((model, t)) for t in known}
            new = {t: n for t, n in known.items() if last[t] is None or last[t] < n}
            inputs[model] = known
            if new:
                # From the commits' lines: Silver is not read
                hours = sorted({h for t, n in new.items() for h in self.silver[t].touched(last[t], n)})
                touched += _pending(model, hours, True)
                moved[model] = known
        self.pending.append(touched, pass_id)
        waiting = self.waiting_hours()
        hours = {model: found[:max_hours] for model in self.gold_models if (found := waiting.get(model))}
        # Models without anything to read or to rebuild leave no trace
        self.stage_positions({m: k for m, k in inputs.items() if m in moved or m in hours}, pass_id)
        rebuilt = []

        def rebuild(model: str) -> None:
            if model in hours:
                self._rebuild(model, inputs[model], hours[model])
                rebuilt.append(model)

        models = [m for m in self.gold_models if m in moved or m in hours]
        try:
            if models:
                self._each(models, rebuild, pass_id)
        finally:
            self.pending.append([row for m in rebuilt for row in _pending(m, hours[m], False)], pass_id)
        return len(rebuilt)

    def _rebuild(self, model: str, inputs: Mapping[str, int], hours: Sequence[int]) -> None:
        """Recompute whole hours from Silver as of the positions read, and replace them."""
        ranges = [(spelled_time(h * HOUR_MICROS)[:19], spelled_time((h + 1) * HOUR_MICROS)[:19]) for h in hours]
        silver = {}
        for name in GOLD_INPUTS[model]:
            table = self.silver[name]
            rows = table.as_of(inputs[name]) if name in inputs else table.read().where(F.lit(False))
            silver[name] = hour_ranges_filter(rows, ranges)
        snapshot = inputs.get(GOLD_INPUTS[model][0]) or 0
        rows = GOLD[model](silver).withColumn(
            "silver_snapshot_id", F.lit(snapshot).cast("bigint")
        )
        # An hour that has nothing any more is replaced by nothing
        replace_hours(rows, self.gold_path(model), gold_time(model), hour_keys(hours))

    def gold_path(self, model: str) -> str:
        return f"{self.root}/gold/{model}"

    def read_gold(self, model: str) -> DataFrame:
        schema = GOLD_SCHEMAS[model]
        return read_hours(self.spark, self.gold_path(model), schema).select(*schema.fieldNames())

    def waiting_hours(self) -> dict[str, list[int]]:
        """The hours each model has to rebuild, oldest first: as many as the time they cover."""
        last = {(row["model"], row["hour"]): row["pending"] for row in self.pending.rows()}
        found: dict[str, list[int]] = {}
        for (model, micros), pending in sorted(last.items()):
            if pending:
                found.setdefault(model, []).append(micros // HOUR_MICROS)
        return found

    def pending_hours(self) -> DataFrame:
        return still_pending(self.pending.read())

    # Backlog

    def backlog(self) -> DataFrame:
        """One row: rows Silver has not read (least advanced model), hours Gold has not rebuilt
        (most loaded model), and the positions. From the heads of the logs and the lines beside
        them: no data is read."""
        done = self._positions()
        positions = {model: done.get((model, "bronze")) for model in self.silver_models}
        least = None if None in positions.values() else min(positions.values(), default=None)
        most = max(map(len, self.waiting_hours().values()), default=0)
        line = {"silver_rows": self.bronze.rows_after(least), "gold_hours": most, "positions": positions}
        return lines_frame(self.spark, [line], BACKLOG_SCHEMA)

    def catch_up(self, max_rows: int | None = None, max_hours: int | None = None) -> int:
        """Passes until everything that is in Bronze now has reached Gold; returns how many.

        What the stream commits meanwhile is left to the next call, so this ends on a live table
        as well. Fails only when a pass leaves all positions and hours as they were."""
        target, passes, before = self.bronze.current(), 0, None
        while True:
            self.silver_pass(max_rows, target)
            self.gold_pass(max_hours)
            passes += 1
            after = self.backlog().select("gold_hours", "positions").first()
            at = after["positions"].values()
            if after["gold_hours"] == 0 and all(p is not None and p >= target for p in at if target is not None):
                return passes
            if after == before:
                raise RuntimeError(f"pass {passes} moved nothing: {after.asDict()}")
            before = after


def _pending(model: str, hours: Sequence[int], pending: bool) -> list[Row]:
    return [{"model": model, "hour": h * HOUR_MICROS, "pending": pending} for h in hours]


def gold_time(model: str) -> str:
    return "minute" if model.endswith("_minute") else "hour"
