from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ratios

POINTS = "branch string, rate double, cost double"


def fits(session, **branches):
    rows = [(branch, float(r), fixed / r + marginal) for branch, (fixed, marginal, rates) in branches.items() for r in rates]
    return ratios.cost_fit(session.createDataFrame(rows, POINTS))


RATES = (464, 1850, 30000)


def test_a_fit_finds_both_costs(spark):
    row = fits(spark, spark=(500.0, 0.02, RATES)).first()
    assert row["fixed_ms_per_s"] == pytest.approx(500)
    assert row["marginal_ms_per_message"] == pytest.approx(0.02)
    assert row["r2"] == pytest.approx(1) and row["runs"] == 3
    assert (row["min_rate"], row["max_rate"]) == (464, 30000)


def test_one_rate_is_no_fit_and_bad_points_are_left_out(spark):
    rows = [("a", 10.0, 1.0), ("a", 10.0, 2.0), ("b", None, 1.0), ("b", 0.0, 1.0), ("b", 5.0, None)]
    rows += [("c", 1.0, 2.0), ("c", 2.0, 2.0), ("c", -1.0, 9.0)]
    found = ratios.cost_fit(spark.createDataFrame(rows, POINTS)).collect()
    # Flat costs have no R²
    assert [(r["branch"], r["runs"], r["r2"]) for r in found] == [("c", 2, None)]


@pytest.mark.parametrize(
    "duckdb, other, expected",
    [
        # Spark's fixed cost is higher, its marginal one lower: they cross at 15 000 per second
        ((200.0, 0.05, RATES), (500.0, 0.03, RATES), (15000, "measured", "duckdb", "spark")),
        ((200.0, 0.05, RATES), (2000.0, 0.03, RATES), (90000, "extrapolated", "duckdb", "spark")),
        ((200.0, 0.03, RATES), (500.0, 0.05, RATES), (None, "none", "duckdb", "duckdb")),
        ((500.0, 0.05, RATES), (200.0, 0.03, RATES), (None, "none", "spark", "spark")),
        ((200.0, 0.03, RATES), (200.0, 0.03, RATES), (None, "none", "duckdb", "duckdb")),
    ],
)
def test_crossings(spark, duckdb, other, expected):
    row = ratios.tipping_point(fits(spark, duckdb=duckdb, spark=other)).first()
    rate, *rest = expected
    assert list(row)[1:] == rest
    assert row["rate"] == (None if rate is None else pytest.approx(rate, rel=1e-6))


def test_a_missing_fit_is_unknown(spark):
    row = ratios.tipping_point(fits(spark, spark=(500.0, 0.02, RATES))).first()
    assert tuple(row) == (None, "unknown", None, None)


def test_points_add_both_phases(spark):
    frame = spark.sql("SELECT 'a' branch, 10D throughput_msg_s, CAST(NULL AS DOUBLE) ingest_cpu_ms_per_message, 2D transform_cpu_ms_per_message")
    assert tuple(ratios.total_cost_points(frame).first()) == ("a", 10.0, 2.0)


DAY = date(2026, 10, 8)


def branches(spark, *rows):
    schema = (
        "day date, window_epoch bigint, branch string, messages bigint, host_contaminated boolean,"
        " latency_p50_ms double, latency_p95_ms double, regime string, rate_bucket string"
    )
    full = [(DAY, w, b, m, bad, 10.0 * w, 20.0 * w, "live", "0-200") for w, b, m, bad in rows]
    return spark.createDataFrame(full, schema)


def services(spark, *rows):
    schema = (
        "day date, window_epoch bigint, branch string, service string, layer string, cpu_ms double,"
        " ram_mib_s double, swap_mib_s double, psi_mem_ms double, peak_anon_mib double,"
        " covered_s double, restarted boolean"
    )
    full = [
        (DAY, w, b, f"s{n}", layer, cpu, cpu / 10, 0.0, 1.0, cpu, covered, restarted)
        for n, (w, b, layer, cpu, covered, restarted) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schema)


def test_ratios_leave_out_unclean_windows(spark):
    windows = branches(
        spark, (1, "a", 10, False), (2, "a", 10, True), (3, "a", 20, False), (4, "a", 0, False)
    )
    used = services(
        spark,
        (1, "a", "x", 500.0, 300.0, False),
        (1, "a", "x", 500.0, 270.0, False),
        (1, "a", "y", 100.0, 269.0, False),
        (2, "a", "x", 9.0, 300.0, False),
        (3, "a", "x", 9.0, 300.0, False),
        # Restarted in a layer of its own: the whole window goes
        (3, "a", "y", 9.0, 10.0, True),
        (4, "a", "x", 9.0, 300.0, False),
    )
    found = {r["window_epoch"]: r for r in ratios.benchmark_ratios(windows, used).collect()}
    assert set(found) == {1, 4}
    assert found[1]["layer"] == "x" and found[1]["cpu_ms_per_message"] == pytest.approx(100)
    assert found[1]["ram_mib_s_per_10k_messages"] == pytest.approx(100_000)
    assert found[1]["peak_anon_mib"] == 500 and found[4]["cpu_ms_per_message"] is None
    kept = ratios.windows_kept(windows, used).first()
    assert tuple(kept) == ("a", 4, 1, 1)


def test_days_are_ratios_of_sums(spark):
    windows = branches(spark, (1, "a", 10, False), (2, "a", 30, False))
    used = services(spark, (1, "a", "x", 100.0, 300.0, False), (2, "a", "x", 100.0, 300.0, False))
    daily = ratios.branch_daily(ratios.benchmark_ratios(windows, used)).first()
    assert daily["windows"] == 2 and daily["messages"] == 40
    assert daily["cpu_ms_per_message"] == pytest.approx(5)
    assert daily["latency_p50_ms"] == pytest.approx(15)
    table = ratios.benchmark_ratios(windows, used)
    old = ratios.branches_compare(table, 7, F.lit(date(2026, 10, 20)))
    assert old.count() == 0
    recent = ratios.branches_compare(table, 7, F.lit(date(2026, 10, 15))).first()
    assert recent["cpu_ms_per_message_p50"] == pytest.approx((10 + 100 / 30) / 2)


def test_catalogs(spark):
    windows = branches(spark, (1, "a", 10, False), (2, "a", 30, False))
    used = services(spark, (2, "a", "x", 1.0, 300.0, True))
    catalogs = spark.createDataFrame(
        [(DAY, 1, "a", 50.0, 0.2), (DAY, 2, "a", 50.0, 0.9)],
        "day date, window_epoch bigint, branch string, cpu_ms_estimate double, active_share double",
    )
    row = ratios.catalogs_compare(catalogs, windows, used).first()
    assert row["windows"] == 1 and row["cpu_ms_per_message_estimate"] == pytest.approx(5)


def test_passes(spark):
    t = datetime(2026, 10, 1)
    rows = [("a", t, t.replace(minute=2)), ("a", t, t.replace(minute=2)), ("b", None, None), ("c", t, None)]
    frame = spark.createDataFrame(rows, "run_id string, started_at timestamp, ended_at timestamp")
    assert [(r["run_id"], r["seconds"]) for r in ratios.pass_durations(frame).collect()] == [("a", 120.0)]


def test_bench_ratios_hide_what_means_nothing(spark):
    frame = spark.sql(
        """SELECT run_id, 'spark' AS branch, date'2026-10-08' AS night, '1x' AS rate, 1 AS repetition,
            status, messages AS bronze_messages, 100D AS throughput_msg_s, relevant AS latency_relevant,
            5D AS latency_p50_ms, 6D AS latency_p95_ms, 3 AS transform_passes,
            timestamp'2026-10-08 01:00:00' AS transform_started_at,
            timestamp'2026-10-08 01:00:50' AS transform_finished_at,
            map('streaming', named_struct('cpu_ms', 200D, 'ram_mib_s', 1D, 'peak_anon_mib', 9D)) AS ingest_usage,
            map('transform', named_struct('cpu_ms', 60D, 'ram_mib_s', 2D, 'peak_anon_mib', 1D)) AS transform_usage
        FROM VALUES (1, 'done', 100L, true), (2, 'done', 0L, false), (3, 'failed', 9L, true)
            AS v (run_id, status, messages, relevant)"""
    )
    first, second = ratios.bench_ratios(frame).orderBy("run_id").collect()
    assert first["ingest_cpu_ms_per_message"] == pytest.approx(2)
    assert first["transform_cpu_ms_per_message"] == pytest.approx(0.6)
    assert first["transform_seconds"] == 50 and first["transform_rows_per_s"] == pytest.approx(2)
    assert first["latency_p50_ms"] == 5 and second["latency_p50_ms"] is None
    assert second["ingest_cpu_ms_per_message"] is None and second["ingest_peak_mib"] == 9
