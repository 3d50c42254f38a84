from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import usage

T0 = datetime(2026, 10, 8, 12)
MIB = 2**20
SAMPLES = (
    "service string, ts timestamp, container_id string, cpu_usec bigint, anon_bytes bigint,"
    " swap_bytes bigint, pgmajfault bigint, mem_psi_full_us bigint, branch string, layer string"
)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def sample(seconds, cpu, anon_mib, cid="a", service="s", faults=0, branch="spark", layer="l"):
    anon = None if anon_mib is None else int(anon_mib * MIB)
    return (service, at(seconds), cid, cpu, anon, 0, faults, 0, branch, layer)


def service(spark, *rows, **options):
    frame = usage.service_windows(spark.createDataFrame(list(rows), SAMPLES), **options)
    epoch = int(frame.sparkSession.sql("SELECT unix_seconds(timestamp'2026-10-08 12:00:00')").first()[0])
    return {(r["window_epoch"] - epoch) // 300: r for r in frame.collect()}


def test_cpu_and_memory_of_one_pair(spark):
    found = service(spark, sample(0, 0, 100), sample(10, 2_000_000, 200))[0]
    assert found["cpu_ms"] == pytest.approx(2000)
    assert found["ram_mib_s"] == pytest.approx(1500)
    assert found["covered_s"] == pytest.approx(10)
    assert found["peak_anon_mib"] == pytest.approx(200)
    assert found["swap_mib_s"] == 0 and not found["restarted"]


def test_a_pair_is_split_between_its_windows(spark):
    found = service(spark, sample(295, 0, 100), sample(305, 1_000_000, 300))
    assert found[0]["cpu_ms"] == pytest.approx(500) and found[1]["cpu_ms"] == pytest.approx(500)
    assert found[0]["ram_mib_s"] == pytest.approx(1000)
    # The peak looks at both ends and lands in every window the pair touches
    assert found[0]["peak_anon_mib"] == found[1]["peak_anon_mib"] == pytest.approx(300)


def test_a_pair_ending_on_a_boundary_stays_in_its_window(spark):
    assert set(service(spark, sample(290, 0, 1), sample(300, 10, 1))) == {0}


def test_a_new_container_flags_the_window_of_its_first_sample(spark):
    found = service(spark, sample(295, 5_000_000, 100), sample(305, 1000, 900, cid="b"))
    assert set(found) == {1}
    assert found[1]["restarted"] and found[1]["cpu_ms"] == 0 and found[1]["peak_anon_mib"] == 0
    # However long the gap
    assert service(spark, sample(0, 1, 1), sample(100, 1, 1, cid="b"))[0]["restarted"]


def test_a_long_gap_is_not_covered(spark):
    assert service(spark, sample(0, 0, 1), sample(31, 10, 1)) == {}
    assert set(service(spark, sample(0, 0, 1), sample(30, 10, 1))) == {0}
    assert set(service(spark, sample(0, 0, 1), sample(31, 10, 1), max_gap_seconds=60)) == {0}


def test_a_counter_that_falls_or_is_missing_counts_zero_but_covers(spark):
    found = service(
        spark, sample(0, 500, 1), sample(10, 100, None), sample(20, None, 4), sample(30, 900, 2)
    )[0]
    assert found["cpu_ms"] == 0 and found["covered_s"] == pytest.approx(30)
    assert found["ram_mib_s"] == pytest.approx(30) and found["peak_anon_mib"] == pytest.approx(4)


def test_exits_flag_existing_windows_only(spark):
    rows = [sample(t, t * 1000, 1) for t in range(0, 460, 10)]
    windows = usage.service_windows(spark.createDataFrame(rows, SAMPLES))
    exits = spark.createDataFrame([("s", at(320)), ("s", at(18000))], "service string, ts timestamp")
    found = usage.flag_exits(windows, exits).orderBy("window_epoch").collect()
    assert [r["restarted"] for r in found] == [False, True]


CATALOG = "ts timestamp, db string, active_time_ms double"


def catalogs(spark, rows, cpu_ms=1000.0):
    frame = spark.createDataFrame([(at(s), db, ms) for s, db, ms in rows], CATALOG)
    postgres = spark.sql(
        f"SELECT unix_seconds(timestamp'2026-10-08 12:00:00') AS window_epoch, double({cpu_ms}) AS cpu_ms"
    )
    return {r["db"]: r for r in usage.catalog_windows(frame, postgres, ["c1", "c2"]).collect()}


def test_catalogs_share_the_active_time(spark):
    rows = [(0, "c1", 0.0), (10, "c1", 300.0), (0, "c2", 50.0), (10, "c2", 150.0)]
    rows += [(0, "app", 0.0), (10, "app", 600.0)]
    found = catalogs(spark, rows)
    assert found["c1"]["active_share"] == pytest.approx(0.3)
    assert found["c2"]["active_share"] == pytest.approx(0.1)
    assert found["c1"]["cpu_ms_estimate"] == pytest.approx(300)
    assert set(found) == {"c1", "c2"}


def test_a_reset_or_a_gap_adds_no_active_time(spark):
    rows = [(0, "c1", 500.0), (10, "c1", 10.0), (20, "c1", 20.0), (60, "c1", 999.0)]
    found = catalogs(spark, rows)
    assert found["c1"]["active_ms"] == pytest.approx(10)
    assert found["c2"]["active_ms"] == 0 and found["c2"]["active_share"] == 0


HOST = (
    "ts timestamp, cpu_total_ticks bigint, cpu_steal_ticks bigint, mem_available_bytes bigint,"
    " mem_psi_full_us bigint, cpu_psi_some_us bigint, io_psi_full_us bigint, cpu_usec bigint"
)


def hosts(spark, *rows):
    frame = [(at(s), total, steal, mem * MIB, 0, 0, 0, cpu) for s, total, steal, mem, cpu in rows]
    return usage.host_windows(spark.createDataFrame(frame, HOST)).orderBy("window_epoch")


def test_host_steal_memory_and_cpu(spark):
    found = hosts(spark, (0, 0, 0, 500, 0), (10, 1000, 80, 300, 4_000_000), (20, 2000, 80, 400, 5_000_000))
    row = found.first()
    assert row["steal_pct"] == pytest.approx(4)
    assert row["min_available_mib"] == pytest.approx(300)
    assert row["cpu_ms"] == pytest.approx(5000)


def test_host_cpu_is_unknown_once_a_sample_lacks_it(spark):
    found = hosts(spark, (0, 0, 0, 1, 0), (10, 10, 0, 1, None), (20, 20, 0, 1, 9), (310, 30, 0, 1, 10))
    assert [r["cpu_ms"] for r in found.collect()] == [None, pytest.approx(0.001 * 10 / 290, abs=1e-9)]


def test_neighbours_use_what_the_services_do_not(spark):
    windows = hosts(spark, (0, 0, 0, 1, 0), (10, 10, 0, 1, 400_000_000))
    epoch = windows.select("window_epoch")
    sampled = epoch.withColumn("cpu_ms", F.lit(70_000.0))
    cores = usage.neighbour_cores(windows, sampled).first()["neighbour_cpu_cores"]
    assert cores == pytest.approx(1.1)
    more = epoch.withColumn("cpu_ms", F.lit(900_000.0))
    assert usage.neighbour_cores(windows, more).first()["neighbour_cpu_cores"] == 0
    unknown = hosts(spark, (0, 0, 0, 1, None), (10, 10, 0, 1, None))
    assert usage.neighbour_cores(unknown, sampled).first()["neighbour_cpu_cores"] is None


@pytest.mark.parametrize(
    "host, steal, cores, expected",
    [
        (False, None, None, True),
        (True, 1.0, 0.4, False),
        (True, 5.0, 0.5, False),
        (True, 8.0, None, True),
        (True, None, 1.1, True),
    ],
)
def test_contamination(spark, host, steal, cores, expected):
    flag = usage.host_contaminated(
        F.lit(host), F.lit(steal).cast("double"), F.lit(cores).cast("double")
    )
    assert spark.range(1).select(flag).first()[0] is expected


def phases(spark, *spans):
    rows = [(n, at(a), at(b)) for n, (a, b) in enumerate(spans)]
    return spark.createDataFrame(rows, "run int, start_ts timestamp, end_ts timestamp")


def test_an_interval_takes_its_part_of_each_pair(spark):
    rows = [sample(t, t * 10_000, 100, faults=t) for t in range(0, 40, 10)]
    frame = spark.createDataFrame(rows, SAMPLES)
    found = usage.interval_usage(frame, phases(spark, (5, 25), (-50, 500)), ["run"]).collect()
    part, whole = sorted(found, key=lambda r: r["run"])
    assert part["cpu_ms"] == pytest.approx(200) and part["covered_s"] == pytest.approx(20)
    assert part["ram_mib_s"] == pytest.approx(2000) and part["majfaults"] == pytest.approx(20)
    assert whole["cpu_ms"] == pytest.approx(300)


@pytest.mark.parametrize("chunk", [1, 7, 3600])
def test_the_hours_used_to_match_phases_do_not_matter(spark, chunk):
    rows = [sample(t, t * 10_000, 100) for t in range(0, 100, 10)]
    frame = spark.createDataFrame(rows, SAMPLES)
    found = usage.interval_usage(frame, phases(spark, (5, 25), (33, 78)), ["run"], chunk_seconds=chunk)
    assert sorted(r["cpu_ms"] for r in found.collect()) == pytest.approx([200, 450])


def test_a_restart_counts_only_inside_the_interval(spark):
    rows = [sample(0, 0, 1), sample(10, 0, 1, cid="b"), sample(20, 0, 1, cid="b")]
    frame = spark.createDataFrame(rows, SAMPLES)
    found = usage.interval_usage(frame, phases(spark, (10, 15), (12, 15)), ["run"]).collect()
    assert {r["run"]: r["restarted"] for r in found} == {0: True, 1: False}


def test_layers_add_up_but_for_coverage(spark):
    rows = [sample(t, t * 10_000, 100, service=s) for t in (0, 10) for s in "xy"]
    rows.append(sample(20, 200_000, 100, service="y"))
    frame = spark.createDataFrame(rows, SAMPLES)
    by_service = usage.interval_usage(frame, phases(spark, (0, 60)), ["run"])
    layers = usage.sampled_services(frame, {"layer": "layer"})
    found = usage.phase_usage(by_service, layers, ["run"])
    row = found.first()
    assert row["cpu_ms"] == pytest.approx(300) and row["covered_s"] == pytest.approx(20)
    assert row["peak_anon_mib"] == pytest.approx(200)
    figures = usage.usage_by_layer(found, ["run"], "u").first()["u"]["l"]
    assert figures["cpu_ms"] == pytest.approx(300)


def test_live_resources(spark):
    rows = [sample(0, 0, 100, service="x"), sample(10, 10_000_000, 200, service="x")]
    rows += [sample(0, 0, 900, service="y"), sample(10, 5_000_000, 1000, service="y")]
    # A restart is no growth
    rows += [sample(70, 50, 300, service="x", cid="b"), sample(80, 3_000_050, 300, service="x", cid="b")]
    found = usage.resources_series(spark.createDataFrame(rows, SAMPLES)).orderBy("minute").collect()
    assert [(r["cpu_cores"], r["anon_mib"]) for r in found] == [(1.5, 1200.0), (0.3, 300.0)]


def test_live_rate(spark):
    rows = [(at(0), 100), (at(10), 600), (at(20), 50)]
    readings = spark.createDataFrame(rows, "ts timestamp, position bigint")
    found = usage.live_rate(readings).orderBy("ts").collect()
    assert [r["rate"] for r in found] == [50.0, None]
