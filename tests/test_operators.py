import random
from datetime import datetime, timedelta
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import aggregates, joins, messages, parity, percentiles, ranking
from tidemark.operators.dedup import dedup_batch, dedup_incremental
from tidemark.operators.filters import hour_ranges_filter
from tidemark.operators.series import consecutive_pairs


def test_dedup_keeps_the_earliest_copy_and_what_is_new(spark):
    rows = [(n % 5, n, "x") for n in range(20)]
    frame = spark.createDataFrame(rows, "seq bigint, processed_at bigint, v string")
    kept = {r["seq"]: r["processed_at"] for r in dedup_batch(frame).collect()}
    assert kept == {n: n for n in range(5)}
    target = spark.createDataFrame([(1,), (2,)], "seq bigint")
    assert sorted(r["seq"] for r in dedup_incremental(frame, target).collect()) == [0, 3, 4]


def test_dedup_limits_a_hot_key_before_the_shuffle(spark):
    plan = dedup_batch(spark.range(100).selectExpr("id % 7 AS seq", "id AS processed_at"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    before_shuffle = text.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def brute_not_in(left, right):
    """SQL's NOT IN over tuples: true only if different from every row for sure."""

    def equal(a, b):
        parts = [None if x is None or y is None else x == y for x, y in zip(a, b)]
        return False if False in parts else (None if None in parts else True)

    return sorted(
        (row for row in left if all(equal(row, other) is False for other in right)), key=repr
    )


LEFT = list(product((1, 2, None), repeat=2))


@pytest.mark.parametrize(
    "right",
    [[], [(None, 2)], [(None, None)], [(1, 1), (2, None), (None, 5)]],
)
def test_not_in_with_nulls(spark, right):
    a = spark.createDataFrame(LEFT, "a int, b int")
    b = spark.createDataFrame(right, "c int, d int")
    found = joins.join_not_in(a, b, ["a", "b"], ["c", "d"])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_not_in(LEFT, right)


@pytest.mark.parametrize("right", [[], [1], [1, None]])
def test_not_in_of_one_column(spark, right):
    a = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    b = spark.createDataFrame([(x,) for x in right], "c int")
    found = sorted((tuple(r) for r in joins.join_not_in(a, b, ["a"], ["c"]).collect()), key=repr)
    assert found == brute_not_in([(1,), (2,), (None,)], [(x,) for x in right])


def test_not_in_uses_no_nested_loop_over_the_subquery(spark):
    a = spark.range(1000).selectExpr("nullif(id, 3) AS a", "nullif(id, 4) AS b")
    b = spark.range(1000).selectExpr("nullif(id, 5) AS c", "nullif(id, 6) AS d")
    plan = joins.join_not_in(a, b, ["a", "b"], ["c", "d"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    found = [line for line in text.splitlines() if "Join" in line]
    assert len(found) >= 5 and all("LeftAnti" in line for line in found)
    # Without an equality only where one row of the subquery decides
    assert all(" = " in line or "strategy=broadcast" in line for line in found)
    assert text.count("strategy=broadcast") <= text.count("GlobalLimit 1")


def test_offset_ranges(spark):
    rows = spark.createDataFrame([(0, 1), (0, 5), (1, 5), (2, 5)], "kafka_partition int, kafka_offset bigint")
    bounds = spark.createDataFrame(
        [(0, 2, 6), (1, 0, 5)], "kafka_partition int, start_offset bigint, end_offset bigint"
    )
    assert [tuple(r)[:2] for r in joins.join_offset_range(rows, bounds).collect()] == [(0, 5)]


def test_offset_ranges_of_many_periods(spark, scratch, monkeypatch):
    monkeypatch.setattr(joins, "OFFSETS_PER_SLOT", 16)
    rng, pairs, periods = random.Random(2), [], []
    for n in range(400):
        pairs.append((rng.randrange(3), rng.randrange(300)))
    for n in range(60):
        start = rng.randrange(280)
        periods.append((rng.randrange(3), start, start + rng.randrange(0, 50), n))
    path = scratch("offsets")
    spark.createDataFrame(pairs, "kafka_partition int, kafka_offset bigint").write.parquet(path)
    bounds = spark.createDataFrame(periods, "kafka_partition int, start_offset bigint, end_offset bigint, period int")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    found = joins.join_offset_range(spark.read.parquet(path), bounds)
    got = sorted((r["kafka_partition"], r["kafka_offset"], r["period"]) for r in found.collect())
    assert got == sorted((p, o, n) for p, o in pairs for q, a, b, n in periods if p == q and a <= o < b)
    text = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = [part.split("ReadSchema")[0] for part in text.split("PushedFilters: ")[1:]]
    assert any("GreaterThanOrEqual(kafka_offset" in p and "LessThan(kafka_offset" in p for p in pushed)
    dealt = [part.split("]")[0] for part in text.split("hashpartitioning(")[1:]]
    assert all("_slot" in keys for keys in dealt if "kafka_partition" in keys)


@pytest.mark.parametrize("chunk", [1, 7, 60, 100_000])
def test_pairs_are_those_of_a_plain_lag(spark, chunk):
    rng = random.Random(chunk)
    t0 = datetime(2026, 10, 1)
    rows, series = [], {}
    for n in range(300):
        # One series holds most of the samples
        name = "hot" if rng.random() < 0.7 else rng.choice("ab")
        ts = t0 + timedelta(milliseconds=rng.randrange(0, 3_000_000))
        rows.append((name, ts, n))
        series.setdefault(name, []).append((ts, n))
    expected = set()
    for name, samples in series.items():
        ordered = sorted(samples)
        expected |= {(name, a[1], b[1]) for a, b in zip(ordered, ordered[1:])}
    frame = spark.createDataFrame(rows, "s string, ts timestamp, n int")
    pairs = consecutive_pairs(frame, ["s"], chunk_seconds=chunk, tie_break=("n",))
    assert {tuple(r) for r in pairs.select("s", "a.n", "b.n").collect()} == expected


def numpy_percentiles(values):
    return [float(np.percentile(values, q)) for q in (50, 95)]


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(-5_000, 50_000_000)), min_size=1, max_size=60
    ),
    st.sampled_from([1, 10, 1024]),
)
def test_histogram_percentiles_are_exact(spark, rows, width):
    frame = spark.createDataFrame(rows, "k string, v bigint")
    hist = percentiles.histogram(frame, ["k"], "v")
    found = percentiles.percentiles_from_histogram(
        hist, ["k"], "v", {"p50": 0.5, "p95": 0.95}, width=width
    ).collect()
    assert {r["k"] for r in found} == {k for k, _ in rows}
    for row in found:
        values = [v for k, v in rows if k == row["k"]]
        assert row["messages"] == len(values)
        assert [row["p50"], row["p95"]] == pytest.approx(numpy_percentiles(values), rel=1e-12)


def bronze(spark, n, copies=True):
    t0 = datetime(2026, 10, 8, 12)
    rows = []
    for i in range(n):
        event = t0 + timedelta(seconds=i)
        processed = event + timedelta(milliseconds=i * 7919 % 5000)
        rows.append((i % 3, i // 3, "like" if i % 2 else "post", event, processed))
        if copies and i % 50 == 0:
            rows.append((i % 3, i // 3, "like" if i % 2 else "post", event, processed + timedelta(hours=1)))
    schema = (
        "kafka_partition int, kafka_offset bigint, collection string, event_time timestamp,"
        " processed_at timestamp"
    )
    return spark.createDataFrame(rows, schema)


def test_parts_of_a_day_add_up(spark):
    rows = bronze(spark, 1200)
    whole = messages.message_percentiles(rows)
    parts = [
        messages.latency_histogram(rows.where(f"kafka_offset >= {lo} AND kafka_offset < {lo + 130}"))
        for lo in range(0, 400, 130)
    ]
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(
        map(tuple, messages.percentiles_of_parts(parts).collect()), key=repr
    )


def test_message_windows_count_a_copy_once(spark):
    windows = messages.message_windows(messages.message_percentiles(bronze(spark, 300)))
    rows = windows.collect()
    assert sum(r["messages"] for r in rows) == 300
    assert all(sum(r["collections"].values()) == r["messages"] for r in rows)


def arrivals(spark, rows):
    frame = spark.createDataFrame(rows, "kafka_partition int, kafka_offset bigint, ms bigint")
    return frame.select("kafka_partition", "kafka_offset", F.timestamp_millis("ms").alias("processed_at"))


def test_throughput_leaves_out_the_first_commit(spark):
    rows = [(0, n, 1000) for n in range(50)] + [(0, 50 + n, 2000) for n in range(100)]
    rows += [(0, 3, 9000)]
    found = messages.arrival_measures(arrivals(spark, rows), None).first()
    assert found["bronze_messages"] == 150 and found["throughput_msg_s"] == pytest.approx(100)


def test_a_single_commit_has_no_throughput(spark):
    found = messages.arrival_measures(arrivals(spark, [(0, 1, 5), (0, 2, 5)]), None).first()
    assert found["bronze_messages"] == 2 and found["throughput_msg_s"] is None


def test_latency_only_for_arrivals_with_a_send_time(spark):
    rows = [(0, n, 1000 + 10 * n) for n in range(11)] + [(1, 0, 99999)]
    sends = spark.createDataFrame([(0, n) for n in range(11)], "kafka_partition int, kafka_offset bigint")
    sends = sends.withColumn("sent_at", F.timestamp_millis(F.lit(900)))
    found = messages.arrival_measures(arrivals(spark, rows), sends).first()
    assert found["bronze_messages"] == 12
    assert found["latency_p50_ms"] == pytest.approx(150)
    assert found["latency_p95_ms"] == pytest.approx(195)


def test_parity_counts_copies_and_ignores_order_and_lineage(spark):
    a = spark.createDataFrame(
        [(1, ["b", "a"], 10), (2, [], 10), (2, [], 11)],
        "seq bigint, hashtags array<string>, bronze_snapshot_id bigint",
    )
    b = spark.createDataFrame(
        [(1, ["a", "b"], 77), (2, [], 77)],
        "seq bigint, hashtags array<string>, bronze_snapshot_id bigint",
    )
    found = parity.table_parity("silver_posts", a, b).first()
    assert tuple(found) == ("silver_posts", 3, 2, 1, 0)
    assert parity.column_differences(a, b.drop("hashtags")) == {
        "only_in_a": ["hashtags"],
        "only_in_b": [],
    }
    empty = parity.table_parity("t", a.where("false"), b.where("false")).first()
    assert tuple(empty)[1:] == (0, 0, 0, 0)


def test_distinct_levels_do_not_add_up(spark):
    rows = [(1, "x", "u"), (1, "y", "u"), (1, "y", "v"), (2, "x", "u")]
    frame = spark.createDataFrame(rows, "h int, l string, u string")
    found = {tuple(r) for r in aggregates.distinct_with_total(frame, "h", "l", "u", "n").collect()}
    assert found == {(1, "x", 1), (1, "y", 2), (1, "all", 2), (2, "x", 1), (2, "all", 1)}


def test_islands_of_hours(spark):
    hours = ["2026-10-01 01:00:00", "2026-10-01 02:00:00", "2026-10-01 04:00:00", "2026-10-01 01:00:00"]
    frame = spark.createDataFrame([(h,) for h in hours], "h string")
    found = ranking.hour_islands(frame.select(F.col("h").cast("timestamp").alias("hour")))
    text = found.selectExpr("cast(range_start as string) s", "cast(range_end as string) e")
    assert {tuple(r) for r in text.collect()} == {
        ("2026-10-01 01:00:00", "2026-10-01 03:00:00"),
        ("2026-10-01 04:00:00", "2026-10-01 05:00:00"),
    }


@pytest.mark.parametrize("count", [3, 40])
def test_ranges_of_hours_few_or_many(spark, count):
    t0 = datetime(2026, 10, 1)
    rows = [(n, t0 + timedelta(minutes=20 * n)) for n in range(600)]
    frame = spark.createDataFrame(rows, "n int, event_time timestamp")
    ranges = [(t0 + timedelta(hours=4 * k), t0 + timedelta(hours=4 * k + 2)) for k in range(count)]
    found = hour_ranges_filter(frame, [(str(a), str(b)) for a, b in ranges])
    expected = [n for n, ts in rows if any(a <= ts < b for a, b in ranges)]
    assert sorted(r["n"] for r in found.collect()) == expected
    assert hour_ranges_filter(frame, []).count() == 0


def test_count_stops_at_the_limit(spark):
    assert ranking.count_up_to(spark.range(100), 30).first()[0] == 30
    assert ranking.count_up_to(spark.range(10), 30).first()[0] == 10
    assert ranking.count_up_to(spark.range(100), None).first()[0] == 100
