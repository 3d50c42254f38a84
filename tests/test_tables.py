import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.operators import maintenance
from tidemark.sources import tables

SCHEMA = c.schema(seq="bigint", event_time="timestamp")


def rows(spark, *pairs):
    frame = spark.createDataFrame(list(pairs), "seq bigint, t string")
    return frame.select("seq", F.col("t").cast("timestamp").alias("event_time"))


def seqs(frame):
    return sorted(r["seq"] for r in frame.collect())


@pytest.fixture
def table(spark, scratch):
    table = tables.CommitTable(spark, scratch("table"), SCHEMA)
    table.append(rows(spark, (1, "2026-10-01 10:00:00"), (2, "2026-10-02 10:00:00")), 1)
    table.append(rows(spark, (3, "2026-10-02 11:00:00")), 2)
    table.append(rows(spark, (4, "2026-10-01 12:00:00"), (5, "2026-10-03 01:00:00")), 3)
    return table


def test_an_unwritten_table_has_no_rows(spark, scratch):
    table = tables.CommitTable(spark, scratch("none"), SCHEMA)
    assert table.read().count() == 0 and table.current() is None
    assert table.commits().count() == 0


def test_commits_are_ranges(table):
    assert table.current() == 3
    assert seqs(table.as_of(2)) == [1, 2, 3]
    assert seqs(table.appended(1, 2)) == [3]
    assert seqs(table.appended(None, 1)) == [1, 2]
    counts = {r["commit_id"]: r["added_rows"] for r in table.commits().collect()}
    assert counts == {1: 2, 2: 1, 3: 2}


def test_writing_a_commit_again_replaces_it(spark, table):
    table.append(rows(spark, (3, "2026-10-02 11:00:00")), 2)
    assert seqs(table.read()) == [1, 2, 3, 4, 5]
    # Other days than the first attempt's do not leave the old ones behind
    table.append(rows(spark, (9, "2026-10-05 11:00:00")), 2)
    assert seqs(table.read()) == [1, 2, 4, 5, 9]


def test_an_empty_commit_moves_the_position(spark, table):
    assert table.append(rows(spark, (1, "2026-10-01 10:00:00")).where("false"), 4) == 0
    assert table.current() == 4 and seqs(table.appended(3, 4)) == []


def test_ranges_of_commits_and_days_prune_partitions(table):
    plan = tables.between_times(
        table.appended(1, 2), "2026-10-02 00:00:00", "2026-10-02 12:00:00"
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "commit_id" in filters and "event_day" in filters
    assert seqs(plan) == [3]


def test_file_stats_count_files_not_rows(table):
    stats = tables.file_stats(table).first()
    assert stats["files"] == 5 and stats["commits"] == 3 and stats["bytes"] > 0


def test_only_the_hours_written_are_replaced(spark, scratch):
    path = scratch("gold")
    schema = c.schema(hour="timestamp", n="bigint")

    def write(*pairs):
        frame = spark.createDataFrame(list(pairs), "t string, n bigint")
        tables.replace_hours(frame.select(F.col("t").cast("timestamp").alias("hour"), "n"), path)

    write(("2026-10-01 10:00:00", 1), ("2026-10-01 10:00:00", 2), ("2026-10-01 11:00:00", 3))
    write(("2026-10-01 10:00:00", 9))
    found = tables.read_hours(spark, path, schema).select("n").collect()
    assert sorted(r["n"] for r in found) == [3, 9]


HOURS = c.schema(hour="timestamp", n="bigint")


def hours_of(spark, *pairs):
    frame = spark.createDataFrame(list(pairs), "t string, n bigint")
    return frame.select(F.col("t").cast("timestamp").alias("hour"), "n")


def test_hours_switch_at_once(spark, scratch, monkeypatch):
    path = scratch("gold")
    old = hours_of(spark, ("2026-10-01 10:00:00", 1), ("2026-10-01 11:00:00", 2), ("2026-10-01 12:00:00", 3))
    new = hours_of(spark, ("2026-10-01 10:00:00", 7), ("2026-10-01 11:00:00", 8))
    tables.replace_hours(old, path)

    def values():
        return sorted(r["n"] for r in tables.read_hours(spark, path, HOURS).collect())

    def crash(*_):
        raise RuntimeError("node lost")

    # Everything is written, the line is not
    with monkeypatch.context() as patched:
        patched.setattr(tables.LineLog, "write", crash)
        with pytest.raises(RuntimeError):
            tables.replace_hours(new, path)
    assert values() == [1, 2, 3]

    # The job dies while it writes: one hour has its file, the other has not
    broken = new.withColumn("n", F.when(F.hour("hour") == 11, F.raise_error(F.lit("killed"))).otherwise(F.col("n")).cast("bigint"))
    with pytest.raises(Exception, match="killed"):
        tables.replace_hours(broken, path)
    assert values() == [1, 2, 3]
    tables.replace_hours(new, path)
    assert values() == [3, 7, 8]


def test_an_hour_rebuilt_to_nothing_is_empty(spark, scratch):
    path = scratch("gold")
    tables.replace_hours(hours_of(spark, ("2026-10-01 10:00:00", 1), ("2026-10-01 11:00:00", 2)), path)
    nothing = hours_of(spark, ("2026-10-01 10:00:00", 1)).where("false")
    tables.replace_hours(nothing, path, keys=["2026-10-01-11"])
    assert [r["n"] for r in tables.read_hours(spark, path, HOURS).collect()] == [1]
    table = tables.hour_table(spark, path)
    assert table.drop_replaced() == 1 and table.drop_replaced() == 0
    assert [r["n"] for r in tables.read_hours(spark, path, HOURS).collect()] == [1]
    tables.replace_hours(hours_of(spark, ("2026-10-01 11:00:00", 5)), path)
    assert sorted(r["n"] for r in tables.read_hours(spark, path, HOURS).collect()) == [1, 5]


def test_hours_prune_generations(spark, scratch, monkeypatch):
    path = scratch("gold")
    monkeypatch.setattr(tables, "FOLD", 6)
    for n in range(tables.FOLD + 3):
        tables.replace_hours(hours_of(spark, ("2026-10-01 10:00:00", n), (f"2026-10-02 {n % 5:02d}:00:00", n)), path)
    found = tables.read_hours(spark, path, HOURS).where("hour_key = '2026-10-01-10'")
    assert [r["n"] for r in found.collect()] == [tables.FOLD + 2]
    # One of all the files written under this hour is opened: the filter is on partition columns
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "generation" in filters and "hour_key" in filters
    assert len(tables.hour_table(spark, path).log.listing()[2]) < tables.FOLD


def test_retention_drops_whole_days_at_midnight(table):
    now = datetime(2026, 10, 9, 15, 30)
    assert maintenance.retention_cutoff(now, 7) == datetime(2026, 10, 2)
    counts = maintenance.expired_counts(table.read(), datetime(2026, 10, 2)).collect()
    assert [(str(r["day"]), r["removed"]) for r in counts] == [("2026-10-01", 2)]
    assert maintenance.drop_expired_days(table, now, 7) == 2
    assert seqs(table.read()) == [2, 3, 5]
    assert maintenance.drop_expired_days(table, now, 7) == 0


def test_kept_rows_is_the_same_rule(table):
    assert seqs(maintenance.kept_rows(table.read(), datetime(2026, 10, 2))) == [2, 3, 5]


def test_time_column_is_the_first_present():
    assert maintenance.time_column(["hour", "minute"]) == "minute"
    with pytest.raises(ValueError):
        maintenance.time_column(["day"])


def test_the_cutoff_is_the_utc_midnight_of_any_zone():
    tokyo = timezone(timedelta(hours=9))
    assert maintenance.retention_cutoff(datetime(2024, 1, 21, 8, 0, tzinfo=tokyo), 7) == datetime(2024, 1, 13)
    assert maintenance.retention_cutoff(datetime(2024, 1, 21, 9, 0, tzinfo=tokyo), 7) == datetime(2024, 1, 14)
    assert maintenance.retention_cutoff(datetime(2024, 1, 20, 23, 0), 7) == datetime(2024, 1, 13)


def half_written(spark, table, commit_id, *pairs):
    """A commit whose writer died before its line."""
    found = rows(spark, *pairs).withColumn("event_day", F.to_date("event_time"))
    found.write.partitionBy("event_day").parquet(f"{table.path}/commit_id={commit_id}")


def test_half_a_commit_is_never_read(spark, table):
    half_written(spark, table, 4, (6, "2026-10-02 13:00:00"))
    assert seqs(table.read()) == seqs(table.as_of(9)) == [1, 2, 3, 4, 5] and table.current() == 3
    assert seqs(table.appended(3, 4)) == []
    table.append(rows(spark, (6, "2026-10-02 13:00:00"), (7, "2026-10-02 14:00:00")), 4)
    assert seqs(table.appended(3, 4)) == [6, 7]


def test_half_a_commit_is_never_merged(spark, table):
    half_written(spark, table, 4, (6, "2026-10-02 13:00:00"))
    assert maintenance.compact_commits(table, 9) == 2
    maintenance.drop_merged(table)
    table.append(rows(spark, (6, "2026-10-02 13:00:00"), (7, "2026-10-01 14:00:00")), 4)
    assert seqs(table.read()) == [1, 2, 3, 4, 5, 6, 7]
    assert maintenance.compact_commits(table, 9) == 2 and seqs(table.read()) == [1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize(
    "sizes, bins", [([5, 5, 5], [0, 0, 1]), ([9, 6, 4, 1], [0, 1, 1, 0]), ([20, 3], [0, 1]), ([], []), ([1], [0])]
)
def test_first_fit_decreasing(sizes, bins):
    assert maintenance.first_fit(sizes, 10) == bins


def merged_files(spark, table):
    found = maintenance.list_objects(spark, f"{table.path}_merged").where("key LIKE '%.parquet'")
    return {r["key"]: r["size"] for r in found.collect()}


def test_full_files_are_written_once_and_large_commits_stay(spark, scratch):
    table = tables.CommitTable(spark, scratch("bins"), SCHEMA)

    def commit(number, n):
        day = F.lit("2026-10-01").cast("timestamp")
        seq = (F.rand(number) * 2**40).cast("bigint")
        table.append(spark.range(n, numPartitions=1).select(seq.alias("seq"), day.alias("event_time")), number)

    for number, n in enumerate((20_000, 3000, 3000, 3000), 1):
        commit(number, n)
    target = 70_000
    before = seqs(table.read())
    assert maintenance.compact_commits(table, 4, target_bytes=target) == 1
    first = merged_files(spark, table)
    segment, days = table.merges()
    assert segment == 1 and days["2026-10-01"].stay == (1,) and seqs(table.read()) == before
    maintenance.drop_merged(table)
    assert [p.rsplit("=", 1)[1] for p in tables.partition_folders(spark, table.path)] == ["1"]
    full = {k for k in first if "part=full" in k}
    assert full and all(first[k] > 0.7 * target for k in full)
    for number in (5, 6, 7):
        commit(number, 1500)
    before = seqs(table.read())
    assert maintenance.compact_commits(table, 7, target_bytes=target) == 1
    again = merged_files(spark, table)
    assert full <= set(again) and table.merges()[1]["2026-10-01"].stay == (1,)
    assert seqs(table.read()) == before and seqs(table.as_of(4)) != before
    maintenance.drop_merged(table)
    assert seqs(table.read()) == before and full <= set(merged_files(spark, table))
    # Nothing small is left over but one rest: nothing to merge
    assert maintenance.compact_commits(table, 7, target_bytes=target) == 0


def test_retention_trims_the_logs(spark, table):
    maintenance.compact_commits(table, 3)
    assert set(table.merges()[1]) == {"2026-10-01", "2026-10-02"}
    assert maintenance.drop_expired_days(table, datetime(2026, 10, 9, 15, 30), 7) == 2
    assert set(table.merges()[1]) == {"2026-10-02"} and seqs(table.read()) == [2, 3, 5]
    assert maintenance.drop_expired_days(table, datetime(2026, 10, 11), 7) == 3 and seqs(table.read()) == []
    table.append(rows(spark, (8, "2026-10-12 10:00:00")), 4)
    table.append(rows(spark, (9, "2026-10-12 10:00:00")), 5)
    assert maintenance.compact_commits(table, 5) == 1 and seqs(table.read()) == [8, 9]


def test_compaction_keeps_every_row_and_every_reader(table):
    before = seqs(table.read())
    # The second of October is in two commits, the first in one: nothing to merge there
    assert maintenance.compact_commits(table, 2) == 1
    assert seqs(table.read()) == before
    assert seqs(table.appended(2, 3)) == [4, 5]
    assert seqs(table.as_of(1)) == [1, 2]
    assert maintenance.compact_commits(table, 2) == 0
    stats = tables.file_stats(table).first()
    assert stats["files"] == 4 and stats["commits"] == 3


def test_compaction_of_one_day(table):
    assert maintenance.compact_commits(table, 3, "2026-10-01") == 1
    assert seqs(table.read()) == [1, 2, 3, 4, 5]
    assert maintenance.compact_commits(table, 3, "2026-10-03") == 0


def test_commits_replayed_after_a_compaction_change_nothing(spark, table):
    first = rows(spark, (1, "2026-10-01 10:00:00"), (2, "2026-10-02 10:00:00"))
    last = rows(spark, (4, "2026-10-01 12:00:00"), (5, "2026-10-03 01:00:00"))
    for clean in (False, True):
        maintenance.compact_commits(table, 3)
        if clean:
            assert maintenance.drop_merged(table) > 0
        table.append(first, 1)
        table.append(last, 3)
        assert seqs(table.read()) == [1, 2, 3, 4, 5]
        assert seqs(table.appended(2, 3)) == [4, 5]
    # Later commits are merged with the days that are merged already
    table.append(rows(spark, (6, "2026-10-01 13:00:00")), 4)
    assert maintenance.compact_commits(table, 4) == 1
    maintenance.drop_merged(table)
    table.append(first, 1)
    assert seqs(table.read()) == [1, 2, 3, 4, 5, 6] and seqs(table.appended(3, 4)) == [6]


def test_replaced_folders_go_with_their_empty_commits(spark, table):
    maintenance.compact_commits(table, 3, "2026-10-02")
    maintenance.drop_merged(table)
    left = {p.rsplit("/", 1)[1] for p in tables.partition_folders(spark, table.path)}
    assert left == {"commit_id=1", "commit_id=3"}
    assert seqs(table.read()) == [1, 2, 3, 4, 5]


def test_merged_days_prune_commits_and_days(table):
    maintenance.compact_commits(table, 2)
    plan = table.read().where("event_day = DATE '2026-10-02'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    scans = [part.split("PushedFilters")[0] for part in text.split("PartitionFilters: ")[1:]]
    assert len(scans) == 2 and "segment" in scans[1] and all("event_day" in s for s in scans)


def test_a_compaction_that_stopped_half_way_changes_nothing(table, monkeypatch):
    def crash(*_):
        raise RuntimeError("node lost")

    with monkeypatch.context() as patched:
        patched.setattr(table.merge_log, "write", crash)
        with pytest.raises(RuntimeError):
            maintenance.compact_commits(table, 3)
    assert seqs(table.read()) == [1, 2, 3, 4, 5] and table.merges() == (0, {})
    assert maintenance.compact_commits(table, 3) == 2
    assert seqs(table.read()) == [1, 2, 3, 4, 5]


def test_a_day_rebuilt_to_nothing_is_empty(spark, scratch):
    path = scratch("days")
    frame = spark.sql("SELECT * FROM VALUES ('2026-10-01', 1), ('2026-10-02', 2), ('2026-10-03', 3) AS v (day, n)")
    tables.replace_days(frame, path, "day", ["2026-10-01", "2026-10-02", "2026-10-03"])
    tables.replace_days(frame.where("n = 2").withColumn("n", F.lit(9)), path, "day", ["2026-10-01", "2026-10-02"])
    found = spark.read.parquet(path)
    assert sorted(r["n"] for r in found.collect()) == [3, 9]


def test_retention_of_hours(spark, scratch):
    path = scratch("hours")
    frame = spark.sql("SELECT TIMESTAMP '2026-10-01 23:00:00' + make_dt_interval(0, CAST(id AS INT)) AS hour, id FROM range(4)")
    tables.replace_hours(frame, path)
    assert maintenance.drop_expired_hours(spark, path, datetime(2026, 11, 1, 8), 30) == 1
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert maintenance.drop_expired_hours(spark, path, datetime(2026, 11, 1, 8), 30) == 0
    schema = c.schema(hour="timestamp", id="bigint")
    assert sorted(r["id"] for r in tables.read_hours(spark, path, schema).collect()) == [1, 2, 3]


def test_naive_moments_are_utc_in_any_zone(spark, table, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        assert seqs(maintenance.kept_rows(table.read(), datetime(2026, 10, 2, 10))) == [2, 3, 5]
        assert spark.range(1).select(tables.utc(datetime(2026, 1, 2)).cast("string")).first()[0] == "2026-01-02 00:00:00"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_positions_trimmed_but_for_the_last_done(spark):
    old, now = datetime(2026, 10, 1), datetime(2026, 10, 20)
    log = [
        ("a", 1, True, old),
        ("a", 2, True, old + timedelta(hours=1)),
        ("a", 3, False, old + timedelta(hours=2)),
        ("b", 4, True, now),
    ]
    frame = spark.createDataFrame(log, "model string, position bigint, done boolean, recorded_at timestamp")
    kept = maintenance.trim_positions(frame, ["model"], datetime(2026, 10, 13)).collect()
    assert sorted(r["position"] for r in kept) == [2, 4]


def test_stale_readers(spark):
    t0 = datetime(2026, 10, 1)
    commits = [("t", n, t0 + timedelta(hours=10 * n)) for n in range(1, 6)]
    readers = [("up to date", "t", 5), ("fresh", "t", 4), ("behind", "t", 1), ("gone", "t", 99)]
    found = maintenance.stale_readers(
        spark.createDataFrame(readers, "reader string, table_name string, commit_id bigint"),
        spark.createDataFrame(commits, "table_name string, commit_id bigint, committed_at timestamp"),
        F.lit(t0 + timedelta(hours=60)),
    )
    assert {(r["reader"], r["expired"]) for r in found.collect()} == {("behind", False), ("gone", True)}


def test_prefixes(spark, scratch):
    keys = [("ducklake/a/x", 100), ("ducklake/a/y", 50), ("ducklake/z", 3), ("iceberg/b/c", 7), ("w", 2)]
    frame = spark.createDataFrame(keys, "key string, size bigint")
    found = maintenance.storage_by_prefix(frame, {"ducklake": "duckdb"})
    assert {tuple(r) for r in found.collect()} == {
        ("ducklake/a", "duckdb", 150, 2),
        ("ducklake", "duckdb", 3, 1),
        ("iceberg", None, 7, 1),
        ("w", None, 2, 1),
    }


def test_objects_are_listed_without_their_content(spark, table):
    objects = maintenance.list_objects(spark, table.path)
    assert objects.where("key LIKE 'commit_id=%' AND size > 0").count() >= 5


def test_usage_of_tables(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES ('a', timestamp'2026-10-01', map('total-records', '5')),"
        " ('a', timestamp'2026-10-02', map('total-records', '1000', 'total-position-deletes', '40',"
        "   'total-files-size', '9', 'total-data-files', '3', 'total-delete-files', '1')),"
        " ('empty', timestamp'2026-10-01', map()) AS v (table_name, committed_at, summary)"
    )
    found = {r["table_name"]: tuple(r)[1:] for r in maintenance.table_usage(frame).collect()}
    assert found == {"a": (960, 9, 4), "empty": (0, 0, 0)}
