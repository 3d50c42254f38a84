"""Every query of the catalogue is registered, and agrees with its SQL on the tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, comparable  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# These take long, mostly a whole protocol each: tools/check_oracle.py compares them as well
SKIPPED = {
    "bench_ratios",
    "bronze_append",
    "chunked_histogram",
    "kafka_source",
    "rebuild_hours",
    "rebuild_day",
    "check_silver_recent",
    "gold_active_users_bitmaps",
}

KEYS = """
kafka_source bronze_parse bronze_append day_partitioned_table scan_asof scan_appended append_sink
replace_hours_sink parquet_dump_scan freeze_slice table_file_stats
json_path json_array facet_features hashtags mentions simple_lower at_uri_parts try_timestamp
lang_subtag truncate_time epoch_window latency_ms rate_bucket regime business_day rotation_branch
model_label offset_bounds hour_ranges_filter predicates collection_mix
dedup_batch dedup_incremental silver_posts silver_likes silver_reposts silver_follows silver_deletes
gold_activity_minute gold_langs_hour gold_hashtags_hour gold_active_users_hour gold_engagement_hour
join_inner join_left_using join_full_outer join_left_anti join_not_in join_exists join_cross_values
join_offset_range join_correlated_max join_send_times
agg_count_filter agg_count_distinct agg_grouping_sets agg_bool_or agg_count_if agg_max_by
agg_first_copy hist_percentiles pct_within_group ratio_of_sums agg_having agg_bounds regr_fit
win_row_number win_running_sum win_total win_min_over win_islands win_lag_pairs
latest_one oldest_k_hours topk_per_group latest_per_key count_up_to set_union_all set_union
set_except_all
capped_range capped_range_bytes stage_position mark_done last_position touched_hours rebuild_hours
clear_pending first_touch_cap backlog gold_hours_behind
check_not_null check_unique check_accepted_values check_unique_combination
check_silver_matches_bronze check_gold_matches_silver check_at_uri completeness parity
retention_delete trim_progress stale_readers compact_day storage_by_prefix table_usage
service_windows host_windows catalog_windows neighbour_cores host_contaminated flag_exits
message_windows chunked_histogram rebuild_day benchmark_ratios branch_daily branches_compare
catalogs_compare windows_kept resources_series live_rate storage_series tables_latest pass_durations
interval_usage phase_usage arrival_measures bench_ratios tipping_point calendar_latest check_suite
parity_checksums completeness_runs check_silver_recent gold_active_users_bitmaps
""".split()


def test_every_key_is_registered():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(queries) >= set(KEYS)
    assert not set(KEYS) - set(oracles)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [key for key in KEYS if key not in SKIPPED])
def test_query_agrees_with_its_sql(spark, oracle, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got)
        return
    want = oracle.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = comparable(got), comparable(want)
    assert len(a) == len(b) and a.equals(b)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_rebuilding_hours_takes_its_rows_from_the_log(spark, monkeypatch):
    # every event is shaped again for a count of Bronze
    def count(rows):
        raise AssertionError("the log knows how many rows there are")

    found = spark.range(0)
    rows = entry.queries()["rebuild_hours"]
    with monkeypatch.context() as m:
        m.setattr(type(found), "count", count)
        frame = rows(spark, FOLDER)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(f"SELECT count(*) FROM ({entry.oracle_sql()['rebuild_hours']})").fetchone()[0]
    assert frame.count() == want
