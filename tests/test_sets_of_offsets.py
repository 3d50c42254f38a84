"""Runs of offsets, checksums of tables, bitmaps of accounts, and hours of recent events."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.operators import checks, intervals
from tidemark.operators.parity import checksum_parity, table_parity
from tidemark.plans.account_bitmaps import AccountBitmaps
from tidemark.sources import tables

CHUNK = intervals.CHUNK_OFFSETS


def offsets(spark, *pairs):
    return spark.createDataFrame(list(pairs), "kafka_partition int, kafka_offset bigint")


def runs_of(frame):
    return sorted(tuple(r) for r in frame.select(*intervals.RUNS_SCHEMA.fieldNames()).collect())


def test_runs_of_a_chunk(spark):
    found = [(0, 1), (0, 2), (0, 2), (0, 3), (0, 7), (1, 7), (1, None), (0, CHUNK - 1), (0, CHUNK), (0, CHUNK + 1)]
    got = runs_of(intervals.offset_runs(offsets(spark, *found).repartition(3)))
    assert got == [(0, 1, 4, 4), (0, 7, 8, 1), (0, CHUNK - 1, CHUNK, 1), (0, CHUNK, CHUNK + 2, 2), (1, 7, 8, 1)]
    assert intervals.offset_runs(offsets(spark).where("false")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_sweeps_equal_sets(spark, seed):
    rng = random.Random(seed)
    runs, sets, rows = [], {0: set(), 1: set()}, {0: 0, 1: 0}
    for _ in range(60):
        p, chunk = rng.randrange(2), rng.randrange(2) * CHUNK
        start = chunk + rng.randrange(200)
        end = start + 1 + rng.randrange(40)
        runs.append((p, start, end, end - start))
        sets[p] |= set(range(start, end))
        rows[p] += end - start
    frame = spark.createDataFrame(runs, "kafka_partition int, start_offset bigint, end_offset bigint, n_rows bigint")
    total = {r[0]: r[1] for r in intervals.fresh_lengths(frame).groupBy("kafka_partition").agg(F.sum("fresh")).collect()}
    assert total == {p: len(s) for p, s in sets.items()}
    merged = runs_of(intervals.merged_runs(frame))
    for p in sets:
        own = [(s, e) for q, s, e, _ in merged if q == p]
        assert sorted(o for s, e in own for o in range(s, e)) == sorted(sets[p])
        assert all(e < s for (_, e), (s, _) in zip(own, own[1:], strict=False))
        assert sum(n for q, _, _, n in merged if q == p) == rows[p]


def test_stored_runs_equal_the_rows(spark, scratch):
    schema = c.schema(kafka_partition="int", kafka_offset="bigint", event_time="timestamp")
    table = tables.CommitTable(spark, scratch("offsets"), schema)
    store = intervals.RunStore(spark, scratch("runs"))
    bounds = spark.sql("SELECT * FROM VALUES (0, 3, 90), (1, NULL, 50), (2, 10, 20), (3, 0, 5) AS b (kafka_partition, start_offset, end_offset)")
    rng = random.Random(5)
    assert store.update(table) is False

    def same():
        got = sorted(tuple(r) for r in intervals.completeness_of_runs(store.read(), bounds).collect())
        assert got == sorted(tuple(r) for r in checks.completeness(table.read(), bounds).collect())

    for commit in range(4):
        found = [(rng.randrange(3), rng.randrange(100)) for _ in range(70)]
        rows = offsets(spark, *found).withColumn("event_time", F.lit("2026-10-01").cast("timestamp"))
        table.append(rows, commit)
        if commit == 2:
            table.append(rows, commit)  # replayed
        if commit != 1:
            assert store.update(table) is True and store.update(table) is False
            same()
    store.merge()
    assert len(store.parts.current()) == 1 and store.position() == 3
    same()
    # What was kept answers without the rows
    plan = intervals.completeness_of_runs(store.read(), bounds)._jdf.queryExecution().executedPlan().toString()
    assert table.path not in plan
    table.append(offsets(spark, (2, 15), (2, 99)).withColumn("event_time", F.lit(None).cast("timestamp")), 4)
    assert store.update(table)
    same()


TABLE = "n int, name string, at timestamp, tags array<string>, x double"


def sample(spark, rows):
    return spark.createDataFrame(rows, TABLE)


def odd_table():
    t = datetime(2026, 10, 1)
    rows = [(n % 9, None if n % 5 == 0 else f"n{n % 4}", t + timedelta(microseconds=n % 3), [f"a{n % 2}", None], n / 7) for n in range(60)]
    return rows + [(None, "x", None, None, None), (None, "x", None, None, None), (1, None, t, [], float("nan"))]


def counts(frame):
    return tuple(frame.first())


def test_checksums_find_what_the_rows_show(spark):
    rows = odd_table()
    a = sample(spark, rows).repartition(4)
    cases = [
        rows, rows[1:], rows[:-2], rows + rows[:3], rows + [rows[-2]], [], rows[::-1],
        [(None if r[0] == 3 else r[0], *r[1:]) for r in rows],
        [(*r[:2], r[2] and r[2] + timedelta(microseconds=1), *r[3:]) for r in rows],
        [(*r[:3], r[3] and r[3][::-1], r[4]) for r in rows],
    ]
    for other in cases:
        b = sample(spark, other)
        for buckets in (2, 1 << 16):
            assert counts(checksum_parity("t", a, b, buckets)) == counts(table_parity("t", a, b))
    assert counts(checksum_parity("t", a.where("false"), a.where("false"))) == ("t", 0, 0, 0, 0)


def test_nulls_that_move_are_found(spark):
    a = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS INT)), (2, 3) AS v (p, q)")
    b = a.select(F.col("q").alias("p"), F.col("p").alias("q"))
    assert counts(checksum_parity("t", a, b))[3:] == (2, 2)


def test_equal_tables_shuffle_bucket_sums_only(spark):
    a = spark.range(20_000).select("id", F.lit("x" * 200).alias("pad"))
    found = checksum_parity("t", a, a.repartition(7).withColumn("pad", F.col("pad")), 16)
    assert [tuple(r) for r in found.collect()] == [("t", 20_000, 20_000, 0, 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = [part.split("== Initial Plan ==")[0] for part in plan.split("== Final Plan ==")[1:]]
    # The rows are gone from the final plans of the comparison: no semi join is left
    assert final and not any("LeftSemi" in part for part in final)
    differs = checksum_parity("t", a, a.where("id <> 5"), 16)
    assert [tuple(r) for r in differs.collect()] == [("t", 20_000, 19_999, 1, 0)]
    assert "LeftSemi" in differs._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_count_late_commits(spark, scratch):
    schema = c.schema(event_time="timestamp", did="string", operation="string")
    silver = {n: tables.CommitTable(spark, scratch(n), schema) for n in ("silver_posts", "silver_likes", "silver_reposts", "silver_follows")}
    store = AccountBitmaps(spark, scratch("active"))
    assert store.update(silver) is False and store.active().count() == 0
    rng = random.Random(3)
    t0, seen = datetime(2026, 10, 1), []

    def append(name, commit, n, hours=30):
        rows = [(t0 + timedelta(hours=rng.randrange(hours)), f"did{rng.randrange(40)}", rng.choice(("create", "update"))) for _ in range(n)]
        silver[name].append(spark.createDataFrame(rows + [(t0, None, "create")], "event_time timestamp, did string, operation string"), commit)
        kept = [r for r in rows if name != "silver_posts" or r[2] == "create"]
        seen.extend((name, r[0], r[1]) for r in kept)

    def same():
        for span, width in ((None, 1), (F.date_trunc("DAY", "hour"), 24)):
            want = {}
            for name, at, did in seen:
                start = t0 + timedelta(hours=(at - t0).seconds // 3600 // width * width + (at - t0).days * 24)
                for kind in (collections[name], "all"):
                    want.setdefault((start, kind), set()).add(did)
            found = store.active(span).select(F.col("hour").cast("string"), "collection", "active_accounts").collect()
            assert {(r[0], r[1]): r[2] for r in found} == {(str(h), k): len(s) for (h, k), s in want.items()}

    collections = {"silver_posts": c.POST, "silver_likes": c.LIKE, "silver_reposts": c.REPOST, "silver_follows": c.FOLLOW}
    append("silver_posts", 1, 50)
    append("silver_likes", 1, 80)
    assert store.update(silver)
    same()
    append("silver_likes", 2, 60)  # late, to hours that hold accounts already
    append("silver_follows", 1, 20)
    assert store.update(silver) and not store.update(silver)
    same()
    ids = [r["account"] for r in store.accounts.read(c.schema(did="string", account="bigint")).collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1)) and len(ids) == len({s[2] for s in seen})
    store.merge()
    assert len(store.bitmaps.current()) == 1
    same()


def test_recent_hours_come_from_the_log(spark, scratch):
    schema = c.schema(seq="bigint", event_time="timestamp", processed_at="timestamp")
    table = tables.CommitTable(spark, scratch("recent"), schema)

    def append(commit, *rows):
        frame = spark.createDataFrame(list(rows), "seq bigint, e string, p string")
        table.append(frame.select("seq", F.col("e").cast("timestamp").alias("event_time"), F.col("p").cast("timestamp").alias("processed_at")), commit)

    append(1, (1, "2026-10-01 10:00:00", "2026-10-01 10:00:01"))
    append(2, (2, "2026-10-05 10:00:00", "2026-10-05 10:00:01"), (3, "2026-09-01 03:00:00", "2026-10-05 11:00:00"))
    hours = checks.hours_since([table], datetime(2026, 10, 5))
    spelled = [tables.spelled_time(h * tables.HOUR_MICROS)[:13] for h in hours]
    # One late row brings its own hour, and not the month between
    assert spelled == ["2026-09-01 03", "2026-10-05 10"]
    assert checks.hours_since([table], datetime(2026, 10, 6)) == []
