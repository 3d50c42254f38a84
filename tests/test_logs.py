"""Logs of lines, and what tables answer from them without reading data."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.plans import incremental as inc
from tidemark.sources import logs, tables

SCHEMA = c.schema(seq="bigint", event_time="timestamp", n="int", name="string")


def summed(head, lines):
    return {"total": head.get("total", 0) + sum(line["n"] for line in lines.values())}


def test_lines_and_heads(spark, scratch):
    log = logs.LineLog(spark, scratch("log"))
    assert log.last() is None and log.read() == ({}, {})
    for n in range(5):
        assert log.append({"n": n}) == n + 1
    log.write(3, {"n": 30})
    assert log.last() == 4 and log.read()[1][3] == {"n": 30}
    log.fold(summed)
    assert log.read() == ({"total": 37}, {}) and log.last() == 4
    assert log.append({"n": 1}) == 1 and log.last() == 5
    # A folded number written again stands beside the head
    log.write(2, {"n": 9})
    assert list(log.read()[1]) == [2, 5] and log.last() == 5
    log.fold(summed)
    assert log.read() == ({"total": 47}, {}) and log.last() == 5
    log.fold(summed)
    assert log.read() == ({"total": 47}, {})


def test_lines_of_an_older_head_count_no_more(spark, scratch, monkeypatch):
    log = logs.LineLog(spark, scratch("log"))
    for n in range(4):
        log.append({"n": n})
    # The fold stops after its head: no line is deleted
    with monkeypatch.context() as patched:
        patched.setattr(logs.SharedFiles, "delete", lambda *_: None)
        log.fold(summed)
    assert len(log.files.names(log.path)) >= 5
    assert log.read() == ({"total": 6}, {}) and log.last() == 3
    log.append({"n": 10})
    assert log.read() == ({"total": 6}, {4: {"n": 10}})


def test_a_line_is_whole_or_not_there(spark, scratch):
    path, files = scratch("whole"), logs.SharedFiles(spark)
    files.write(f"{path}/a.json", json.dumps({"é": "日本"}))
    files.write(f"{path}/a.json", json.dumps({"é": 2}))
    assert json.loads(files.read(f"{path}/a.json")) == {"é": 2}
    assert [n for n in files.names(path) if not n.startswith(".")] == ["a.json"]


def rows(spark, *found):
    frame = spark.createDataFrame(list(found), "seq bigint, t string, n int, name string")
    return frame.select("seq", F.col("t").cast("timestamp").alias("event_time"), "n", "name")


def test_a_line_is_measured_by_the_write(spark, scratch):
    for clustered in ([], ["name"]):
        table = tables.CommitTable(spark, scratch("measured"), SCHEMA, cluster_by=clustered, rebalance=not clustered)
        found = [(5, "2026-10-01 10:59:59.999999", 3, "a"), (2, "2026-10-01 11:00:00", None, "b"), (9, "2026-10-03 11:30:00", 1, None)]
        assert table.append(rows(spark, *found).repartition(3), 0) == 3
        assert table.append(rows(spark, *found).where("false"), 1) == 0
        line, empty = table.commits().orderBy("commit_id").collect()
        hours = [int(datetime.fromisoformat(f"2026-10-0{d}T{h}:00:00+00:00").timestamp()) // 3600 for d, h in ((1, 10), (1, 11), (3, 11))]
        assert line["hours"] == hours and (line["lows"]["seq"], line["highs"]["seq"]) == (2, 9)
        assert (line["lows"]["n"], line["highs"]["n"]) == (1, 3) and "name" not in line["lows"]
        assert empty["added_rows"] == 0 and empty["hours"] == [] and empty["lows"] == {}
        assert table.touched(None, 1) == hours and table.touched(0, 1) == []
        low, high = table.bounds("event_time", None, 1)
        assert tables.spelled_time(low) == "2026-10-01 10:59:59.999999" and tables.spelled_time(high).startswith("2026-10-03 11:30")
        assert table.bounds("event_time", 0, 1) is None


def written_lines(table, count, each=7):
    """A log as so many commits leave it, without their data."""
    for n in range(count):
        table._finish(n, {"added_rows": each, "committed_at": n, "hours": [n // 10], "lows": {"seq": n}, "highs": {"seq": n}})


def test_questions_open_a_bounded_number_of_files(spark, scratch, monkeypatch):
    table = tables.CommitTable(spark, scratch("long"), SCHEMA)
    monkeypatch.setattr(tables, "FOLD", 40)
    written_lines(table, 290)
    # However many commits there were: the files of folded lines grow in number, nothing else does
    names = table.log.files.names(table.log.path)
    assert len([n for n in names if n.endswith(".json")]) <= 40 + 1
    opened = []
    whole = logs.SharedFiles.read
    monkeypatch.setattr(logs.SharedFiles, "read", lambda files, path: opened.append(path) or whole(files, path))
    assert table.current() == 289 and not opened
    assert table.rows_after(None) == 2030 and table.rows_after(285) == 28
    assert table.touched(285, 289) == [28] and table.bounds("seq", 281, 286) == (282, 286)
    assert len(opened) <= 4 * 41
    late = table.commits(250)
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert late.count() == 39 and "upto" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert table.commits().count() == 290
    assert table.rows_after(100) == 7 * 189 and table.touched(0, 30) == [0, 1, 2, 3]
    assert table.bounds("seq", None, 289) == (0, 289)


def test_an_old_commit_written_again_counts_once(spark, scratch, monkeypatch):
    table = tables.CommitTable(spark, scratch("again"), SCHEMA)
    monkeypatch.setattr(tables, "FOLD", 5)
    written_lines(table, 12)
    written_lines(table, 2, each=10)
    assert table.rows_after(None) == 10 * 7 + 2 * 10 and table.rows_after(0) == 10 * 7 + 10
    assert {r["commit_id"]: r["added_rows"] for r in table.commits().collect()} == {n: 10 if n < 2 else 7 for n in range(12)}
    for n in range(12, 20):
        table._finish(n, {"added_rows": 7, "committed_at": n, "hours": [], "lows": {}, "highs": {}})
    written_lines(table, 1, each=1)
    assert table.rows_after(None) == 1 + 10 + 18 * 7 == table.commits().agg(F.sum("added_rows")).first()[0]


def test_a_fold_that_stopped_half_way_counts_once(spark, scratch, monkeypatch):
    table = tables.CommitTable(spark, scratch("half"), SCHEMA)
    monkeypatch.setattr(tables, "FOLD", 5)

    def crash(*_):
        raise RuntimeError("node lost")

    with monkeypatch.context() as patched:
        patched.setattr(table.log, "fold", crash)
        with pytest.raises(RuntimeError):
            written_lines(table, 5)
    assert table.commits().count() == 5 and table.rows_after(None) == 35
    for n in (5, 6):
        table._finish(n, {"added_rows": 7, "committed_at": n, "hours": [], "lows": {}, "highs": {}})
    assert table.commits().count() == 7 and table.rows_after(None) == 49 and table.current() == 6


def test_positions_are_kept_in_one_head(spark, scratch):
    pipeline = inc.Pipeline(spark, scratch("positions"), ["gold_langs_hour"])
    for n in range(1, inc.FOLD + 9):
        pipeline.stage_positions({"silver_posts": {"bronze": n}, "gold_langs_hour": {"silver_posts": n}}, n)
        pipeline.mark_done(["silver_posts"] if n % 2 else ["gold_langs_hour"], n)
    assert pipeline._positions() == {("silver_posts", "bronze"): inc.FOLD + 7, ("gold_langs_hour", "silver_posts"): inc.FOLD + 8}
    assert len(pipeline.progress.rows()) < 3 * inc.FOLD and pipeline.progress.last_pass() == inc.FOLD + 8
    assert len(pipeline.progress.log.files.names(pipeline.progress.log.path)) <= 2 * (inc.FOLD + 2)
    found = {(r["model"], r["position"]) for r in inc.last_positions(pipeline.progress.read()).collect()}
    assert found == {("silver_posts", inc.FOLD + 7), ("gold_langs_hour", inc.FOLD + 8)}


def test_gold_finds_touched_hours_without_reading_silver(spark, scratch, monkeypatch):
    pipeline = inc.Pipeline(spark, scratch("touched"), ["gold_langs_hour"])
    table = pipeline.silver["silver_posts"]
    line = {"added_rows": 1, "committed_at": 0, "lows": {}, "highs": {}}
    table._finish(1, line | {"hours": [480_000, 480_005]})
    table._finish(2, line | {"hours": [480_005, 480_009]})
    rebuilt = []
    monkeypatch.setattr(pipeline, "_rebuild", lambda model, inputs, hours: rebuilt.append((model, inputs, hours)))
    monkeypatch.setattr(tables.CommitTable, "read", lambda self: pytest.fail("Silver was read"))
    assert pipeline.gold_pass(max_hours=2) == 1
    assert rebuilt == [("gold_langs_hour", {"silver_posts": 2}, [480_000, 480_005])]
    assert pipeline.waiting_hours() == {"gold_langs_hour": [480_009]}
    assert pipeline.gold_pass() == 1 and pipeline.gold_pass() == 0 and pipeline.pending_hours().count() == 0
    # A pass without anything to do leaves no trace
    lines = pipeline.progress.log.listing()[2]
    pipeline.gold_pass()
    assert pipeline.progress.log.listing()[2] == lines
