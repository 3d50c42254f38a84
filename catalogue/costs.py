"""Checks, parity, and the benchmark's figures: usage, latency, cost per message."""

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.medallion import silver_tables
from catalogue.registry import ORACLES, Tables, query
from catalogue.relational import cost_points
from catalogue.shape import CTES, over
from tidemark import contract as c
from tidemark.operators import checks, messages, ranking, ratios, usage
from tidemark.operators.dedup import dedup_batch
from tidemark.operators.intervals import RunStore, completeness_of_runs
from tidemark.operators.parity import checksum_parity
from tidemark.operators.parity import parity as compare
from tidemark.operators.sets import union_all
from tidemark.plans import benchmark_day as bench
from tidemark.plans.gold import GOLD
from tidemark.plans.silver import SILVER, SILVER_SCHEMAS
from tidemark.session import scratch_path
from tidemark.sources.tables import CommitTable, utc
from tidemark.sources.topics import within_offsets

# The events are minutes apart where samples are seconds apart
GAP = 3600
GAP_US = GAP * 1_000_000

# --- Sample shapes ----------------------------------------------------------------------

BRANCH = """CASE WHEN event_type IN ('click', 'purchase') THEN 'spark'
    WHEN event_type IN ('view', 'signup') THEN 'duckdb' END"""
LAYER = """CASE event_type WHEN 'purchase' THEN 'transform' WHEN 'signup' THEN 'catalog'
    WHEN 'error' THEN 'shared' ELSE 'streaming' END"""
DB = """CASE user_id % 3 WHEN 0 THEN 'ducklake_catalog' WHEN 1 THEN 'iceberg_catalog'
    ELSE 'app' END"""


def _sample_columns(micros: str, millis: str) -> dict[str, str]:
    """Sample columns as SQL over `events`; the engines differ in their epoch functions."""
    return {
        "samples": f"""'svc-' || event_type AS service, {BRANCH} AS branch, {LAYER} AS layer, ts,
            'c' || CAST(floor(CAST(extract(DAY FROM ts) AS DOUBLE) / 4) AS BIGINT) AS container_id,
            CASE WHEN event_id % 31 = 0 THEN NULL
                ELSE CAST(floor({micros} / 10) AS BIGINT) + event_id % 7 * 1000000 END AS cpu_usec,
            CASE WHEN event_id % 43 != 0 THEN CAST(floor(value * 1000000) AS BIGINT) END AS anon_bytes,
            CAST(floor(value * 1000) AS BIGINT) AS swap_bytes,
            event_id * 3 AS pgmajfault, event_id * 50 + event_id % 9 * 70 AS mem_psi_full_us""",
        "host_samples": f"""ts, event_id * 1000 AS cpu_total_ticks,
            event_id * 40 + event_id % 5 * 40 AS cpu_steal_ticks,
            2000000000 + CAST(floor(value * 1000000) AS BIGINT) AS mem_available_bytes,
            event_id * 11 AS mem_psi_full_us, event_id * 13 AS cpu_psi_some_us,
            event_id * 17 AS io_psi_full_us,
            CASE WHEN event_id % 101 != 0 THEN CAST(floor({micros} / 2) AS BIGINT)
                + event_id % 10 * 2000000 END AS cpu_usec""",
        "catalog_samples": f"""ts, {DB} AS db,
            CAST(floor({millis} / 10) AS DOUBLE) + event_id % 11 * 500 AS active_time_ms""",
        "exits": "ts, 'svc-' || event_type AS service",
    }


DUCK_SAMPLES = _sample_columns("epoch_us(ts)", "epoch_us(ts) // 1000")
SPARK_SAMPLES = _sample_columns(
    "unix_micros(cast(ts AS TIMESTAMP))", "unix_millis(cast(ts AS TIMESTAMP))"
)
# Which events count as exits of a service
EXITED = "value > 480"

for _name, _columns in DUCK_SAMPLES.items():
    CTES[_name] = ("", f"SELECT {_columns} FROM events {'WHERE ' + EXITED if _name == 'exits' else ''}")
    CTES[f"day_{_name}"] = (
        f"{_name} calendar",
        f"SELECT s.*, day FROM {_name} AS s JOIN calendar ON ts >= start_ts AND ts < end_ts",
    )


def shape(t: Tables, name: str):
    events = t.events
    if name == "exits":
        events = events.where(EXITED)
    return over(events, f"SELECT {SPARK_SAMPLES[name]} FROM sampled_events", "sampled_events")


W = 300_000_000
WINDOWS = f"range(s_us // {W} * {W}, e_us, {W})"
SHARE = f"(least(w_us + {W}, e_us) - greatest(w_us, s_us)) / (e_us - s_us)::DOUBLE"


def _lags(columns: str) -> str:
    return ", ".join(f"lag({n}) OVER w AS a_{n}" for n in columns.split())


def _grown(name: str) -> str:
    return f"CASE WHEN {name} >= a_{name} THEN {name} - a_{name} END"


def service_sql(source: str, keys: str) -> str:
    def mean(name):
        return f"(a_{name} + {name}) / 2.0 * (e_us - s_us) / 1e6 / 1048576"

    return f"""SELECT {keys}, w_us // 1000000 AS window_epoch,
        coalesce(sum({_grown("cpu_usec")} * share / 1000), 0) AS cpu_ms,
        coalesce(sum({mean("anon_bytes")} * share), 0) AS ram_mib_s,
        coalesce(sum({mean("swap_bytes")} * share), 0) AS swap_mib_s,
        coalesce(sum({_grown("mem_psi_full_us")} * share / 1000), 0) AS psi_mem_ms,
        coalesce(sum({_grown("pgmajfault")} * share), 0) AS majfaults,
        coalesce(max(CASE WHEN NOT restart THEN greatest(a_anon_bytes, anon_bytes) END)
            / 1048576.0, 0) AS peak_anon_mib,
        coalesce(sum((e_us - s_us) / 1e6 * share), 0) AS covered_s,
        bool_or(restart) AS restarted
    FROM (SELECT *, CASE WHEN NOT restart THEN {SHARE} END AS share FROM (
        SELECT *, unnest(CASE WHEN restart THEN [e_us // {W} * {W}]
            WHEN e_us > s_us AND e_us - s_us <= {GAP_US} THEN {WINDOWS} ELSE [] END) AS w_us
        FROM (SELECT *, epoch_us(a_ts) AS s_us, epoch_us(ts) AS e_us,
                container_id IS DISTINCT FROM a_container_id AS restart
              FROM (SELECT *, {_lags("ts container_id cpu_usec anon_bytes swap_bytes pgmajfault mem_psi_full_us")}
                    FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY ts, container_id))
              WHERE a_ts IS NOT NULL)))
    GROUP BY {keys}, window_epoch"""


def host_sql(source: str, keys: str = "") -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""

    def total(name):
        return f"sum(coalesce({_grown(name)}, 0) * share)"

    return f"""SELECT *, 100 * steal_ticks / nullif(total_ticks, 0) AS steal_pct FROM (
        SELECT {lead}w_us // 1000000 AS window_epoch,
            {total("cpu_steal_ticks")} AS steal_ticks, {total("cpu_total_ticks")} AS total_ticks,
            {total("mem_psi_full_us")} / 1000 AS psi_mem_ms,
            {total("cpu_psi_some_us")} / 1000 AS psi_cpu_ms,
            {total("io_psi_full_us")} / 1000 AS psi_io_ms,
            min(least(a_mem_available_bytes, mem_available_bytes)) / 1048576.0 AS min_available_mib,
            CASE WHEN count_if({_grown("cpu_usec")} IS NULL) = 0
                THEN sum({_grown("cpu_usec")} * share / 1000) END AS cpu_ms
        FROM (SELECT *, {SHARE} AS share FROM (SELECT *, unnest({WINDOWS}) AS w_us FROM (
            SELECT *, epoch_us(a_ts) AS s_us, epoch_us(ts) AS e_us FROM (
                SELECT *, {_lags("ts cpu_total_ticks cpu_steal_ticks mem_available_bytes mem_psi_full_us cpu_psi_some_us io_psi_full_us cpu_usec")}
                FROM {source} WINDOW w AS ({part} ORDER BY ts))
            WHERE a_ts < ts)))
        GROUP BY {lead}window_epoch)"""


def catalog_sql(source: str, postgres: str, key: str = "") -> str:
    lead = f"{key}, " if key else ""
    return f"""SELECT {lead}window_epoch, db, active_ms,
        CASE WHEN total > 0 THEN active_ms / total ELSE 0 END AS active_share,
        p.cpu_ms * CASE WHEN total > 0 THEN active_ms / total ELSE 0 END AS cpu_ms_estimate
    FROM (SELECT {lead}window_epoch, v.db, total,
            coalesce(list_sum([x.active FOR x IN parts IF x.db = v.db]), 0) AS active_ms
          FROM (SELECT {lead}window_epoch, sum(active) AS total,
                    list({{'db': db, 'active': active}}) AS parts
                FROM (SELECT *, w_us // 1000000 AS window_epoch, delta * {SHARE} AS active FROM (
                    SELECT *, unnest({WINDOWS}) AS w_us FROM (
                        SELECT *, active_time_ms - a_active_time_ms AS delta,
                            epoch_us(a_ts) AS s_us, epoch_us(ts) AS e_us
                        FROM (SELECT *, {_lags("ts active_time_ms")} FROM {source}
                              WINDOW w AS (PARTITION BY {lead}db ORDER BY ts))
                        WHERE a_ts < ts AND active_time_ms >= a_active_time_ms
                            AND epoch_us(ts) - epoch_us(a_ts) <= {GAP_US})))
                GROUP BY {lead}window_epoch)
          CROSS JOIN (VALUES ('ducklake_catalog'), ('iceberg_catalog')) AS v (db))
    LEFT JOIN (SELECT {lead}window_epoch, cpu_ms FROM {postgres} WHERE service = 'svc-error') AS p
        USING ({lead}window_epoch)"""


def contaminated_sql(has_host: str, steal: str, cores: str) -> str:
    return f"(NOT {has_host} OR coalesce({steal}, 0) > 5 OR coalesce({cores}, 0) > 0.5)"


CORES = """CASE WHEN h.cpu_ms IS NOT NULL AND total_ticks != 0
    THEN greatest(0, h.cpu_ms - coalesce(s.cpu_ms, 0)) / 300000 END"""

CTES["service_usage"] = ("samples", service_sql("samples", "service"))
CTES["host_usage"] = ("host_samples", host_sql("host_samples"))
CTES["catalog_usage"] = (
    "catalog_samples service_usage",
    catalog_sql("catalog_samples", "service_usage"),
)
CTES["neighbours"] = (
    "host_usage service_usage",
    f"""SELECT h.*, {CORES} AS neighbour_cpu_cores FROM host_usage AS h
    LEFT JOIN (SELECT window_epoch, sum(cpu_ms) AS cpu_ms FROM service_usage GROUP BY 1) AS s
        USING (window_epoch)""",
)
CTES["day_usage"] = (
    "day_samples day_exits",
    f"""SELECT u.* REPLACE (restarted OR hit IS NOT NULL AS restarted) FROM (
        {service_sql("day_samples", "day, service")}) AS u
    LEFT JOIN (SELECT DISTINCT day, service, CAST(floor(epoch(ts)) AS BIGINT) // 300 * 300
            AS window_epoch, true AS hit FROM day_exits) AS x USING (day, service, window_epoch)""",
)
CTES["service_windows"] = (
    "day_usage samples",
    """SELECT u.*, branch, layer FROM day_usage AS u
    JOIN (SELECT DISTINCT service, branch, layer FROM samples) USING (service)""",
)
CTES["catalog_windows"] = (
    "day_catalog_samples day_usage",
    f"""SELECT *, CASE db WHEN 'ducklake_catalog' THEN 'duckdb' ELSE 'spark' END AS branch
    FROM ({catalog_sql("day_catalog_samples", "day_usage", "day")})""",
)
CTES["day_bounds"] = (
    "bronze",
    """SELECT CAST(event_time AS DATE) AS day, kafka_partition, min(kafka_offset) AS start_offset,
        max(kafka_offset) + 1 AS end_offset FROM bronze GROUP BY 1, 2""",
)
CTES["day_latencies"] = (
    "bronze day_bounds",
    """SELECT day, CAST(floor(epoch(processed_at)) AS BIGINT) // 300 * 300 AS window_epoch, collection,
        epoch_us(processed_at) // 1000 - epoch_us(event_time) // 1000 AS latency_ms
    FROM (SELECT day, b.kafka_partition, kafka_offset, min(processed_at) AS processed_at,
            min(event_time) AS event_time, any_value(collection) AS collection
          FROM bronze AS b JOIN day_bounds AS d ON d.kafka_partition = b.kafka_partition
            AND kafka_offset >= start_offset AND kafka_offset < end_offset
          GROUP BY 1, 2, 3)""",
)
CTES["branch_windows"] = (
    "day_latencies calendar day_host_samples day_usage",
    f"""SELECT m.day, branch, m.window_epoch, messages, latency_p50_ms, latency_p95_ms,
        CASE WHEN m.window_epoch >= CAST(epoch(caught_up_at) AS BIGINT) // 300 * 300
            THEN 'live' ELSE 'catchup' END AS regime,
        CASE WHEN messages / 300 < 200 THEN '0-200' WHEN messages / 300 < 500 THEN '200-500'
            ELSE '500+' END AS rate_bucket,
        steal_pct AS host_steal_pct, psi_mem_ms AS host_psi_mem_ms, psi_cpu_ms AS host_psi_cpu_ms,
        psi_io_ms AS host_psi_io_ms, min_available_mib AS host_min_available_mib,
        neighbour_cpu_cores,
        {contaminated_sql("(h.window_epoch IS NOT NULL)", "steal_pct", "neighbour_cpu_cores")}
            AS host_contaminated
    FROM (SELECT day, window_epoch, count(*) AS messages,
            quantile_cont(latency_ms, 0.5) AS latency_p50_ms,
            quantile_cont(latency_ms, 0.95) AS latency_p95_ms FROM day_latencies GROUP BY 1, 2) AS m
    JOIN calendar USING (day)
    LEFT JOIN (SELECT h.*, {CORES} AS neighbour_cpu_cores FROM ({host_sql("day_host_samples", "day")}) AS h
        LEFT JOIN (SELECT day, window_epoch, sum(cpu_ms) AS cpu_ms FROM day_usage GROUP BY 1, 2) AS s
            USING (day, window_epoch)) AS h
        ON h.day = m.day AND h.window_epoch = m.window_epoch""",
)
# Windows that no restart and no neighbour spoils
CTES["clean"] = (
    "branch_windows service_windows",
    """SELECT day, branch, window_epoch FROM branch_windows WHERE host_contaminated IS FALSE
    EXCEPT SELECT day, branch, window_epoch FROM service_windows WHERE restarted""",
)
CTES["clean_usage"] = (
    "clean service_windows",
    """SELECT day, branch, window_epoch, layer, sum(cpu_ms) AS cpu, sum(ram_mib_s) AS ram,
        sum(swap_mib_s) AS swap, sum(psi_mem_ms) AS stalled, max(peak_anon_mib) AS peak
    FROM clean JOIN service_windows USING (day, branch, window_epoch)
    WHERE covered_s >= 300 * 0.9 GROUP BY ALL""",
)
CTES["ratios"] = (
    "branch_windows clean_usage",
    """SELECT day, branch, window_epoch, regime, rate_bucket, messages, latency_p50_ms, latency_p95_ms,
        layer, cpu / messages AS cpu_ms_per_message, 10000 * ram / messages AS ram_mib_s_per_10k_messages,
        10000 * swap / messages AS swap_mib_s_per_10k_messages, stalled AS psi_mem_ms, peak AS peak_anon_mib
    FROM clean_usage JOIN branch_windows USING (day, branch, window_epoch) WHERE messages <> 0""",
)

USAGE_DOUBLES = "cpu_ms ram_mib_s swap_mib_s psi_mem_ms majfaults peak_anon_mib covered_s"
HOST_DOUBLES = (
    "steal_ticks total_ticks psi_mem_ms psi_cpu_ms psi_io_ms min_available_mib cpu_ms steal_pct"
)


def services(t: Tables):
    return usage.service_windows(shape(t, "samples"), max_gap_seconds=GAP)


@query("service_windows", "SELECT * FROM service_usage", "service_usage", USAGE_DOUBLES)
def service_windows(t: Tables):
    return services(t)


@query(
    "flag_exits",
    """SELECT service, window_epoch, covered_s, restarted OR hit IS NOT NULL AS restarted
    FROM service_usage LEFT JOIN (SELECT DISTINCT service,
        CAST(floor(epoch(ts)) AS BIGINT) // 300 * 300 AS window_epoch, true AS hit FROM exits)
        USING (service, window_epoch)""",
    "service_usage exits",
    "covered_s",
)
def flag_exits(t: Tables):
    flagged = usage.flag_exits(services(t), shape(t, "exits"))
    return flagged.select("service", "window_epoch", "covered_s", "restarted")


@query("host_windows", "SELECT * FROM host_usage", "host_usage", HOST_DOUBLES)
def host_windows(t: Tables):
    return usage.host_windows(shape(t, "host_samples"))


@query(
    "catalog_windows",
    "SELECT * FROM catalog_usage",
    "catalog_usage",
    "active_ms active_share cpu_ms_estimate",
)
def catalog_windows(t: Tables):
    postgres = services(t).where("service = 'svc-error'")
    return usage.catalog_windows(shape(t, "catalog_samples"), postgres, max_gap_seconds=GAP)


def neighbours(t: Tables):
    return usage.neighbour_cores(usage.host_windows(shape(t, "host_samples")), services(t))


@query(
    "neighbour_cores",
    "SELECT window_epoch, neighbour_cpu_cores FROM neighbours",
    "neighbours",
    "neighbour_cpu_cores",
)
def neighbour_cores(t: Tables):
    return neighbours(t).select("window_epoch", "neighbour_cpu_cores")


@query(
    "host_contaminated",
    f"""SELECT window_epoch, events, {contaminated_sql("(n.window_epoch IS NOT NULL)", "steal_pct", "neighbour_cpu_cores")}
        AS contaminated
    FROM (SELECT CAST(floor(epoch(processed_at)) AS BIGINT) // 300 * 300 AS window_epoch,
            count(*) AS events FROM bronze GROUP BY 1)
    LEFT JOIN neighbours AS n USING (window_epoch)""",
    "bronze neighbours",
)
def host_contaminated(t: Tables):
    from tidemark.functions.times import epoch_window

    windows = t.bronze.groupBy(epoch_window(F.col("processed_at")).alias("window_epoch")).agg(
        F.count(F.lit(1)).alias("events")
    )
    hosts = neighbours(t).withColumn("seen", F.lit(True))
    flag = usage.host_contaminated(
        F.coalesce("seen", F.lit(False)), F.col("steal_pct"), F.col("neighbour_cpu_cores")
    )
    joined = windows.join(hosts, "window_epoch", "left")
    return joined.select("window_epoch", "events", flag.alias("contaminated"))


MIX = """array_to_string(list_sort(list(collection || '=' || n)), ',')"""


@query(
    "message_windows",
    f"""SELECT window_epoch, messages, latency_p50_ms, latency_p95_ms, mix
    FROM (SELECT window_epoch, count(*) AS messages, quantile_cont(latency_ms, 0.5) AS latency_p50_ms,
            quantile_cont(latency_ms, 0.95) AS latency_p95_ms FROM latencies GROUP BY 1)
    JOIN (SELECT window_epoch, {MIX} AS mix FROM (
            SELECT window_epoch, collection, count(*) AS n FROM latencies GROUP BY 1, 2) GROUP BY 1)
        USING (window_epoch)""",
    "latencies",
    "latency_p50_ms latency_p95_ms",
)
def message_windows(t: Tables):
    windows = messages.message_windows(messages.message_percentiles(t.bronze))
    entries = F.transform(
        F.map_entries("collections"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    mix = F.array_join(F.array_sort(entries), ",")
    return windows.select(
        "window_epoch", "messages", "latency_p50_ms", "latency_p95_ms", mix.alias("mix")
    )


@query(
    "chunked_histogram",
    """SELECT window_epoch, coalesce(collection, 'all') AS collection, count(*) AS messages,
        quantile_cont(latency_ms, 0.5) AS latency_p50_ms,
        quantile_cont(latency_ms, 0.95) AS latency_p95_ms
    FROM latencies GROUP BY GROUPING SETS ((window_epoch, collection), (window_epoch))""",
    "latencies",
    "latency_p50_ms latency_p95_ms",
)
def chunked_histogram(t: Tables):
    """The percentiles from histograms of four ranges of offsets."""
    last = t.bronze.agg(F.max("kafka_offset")).first()[0] + 1
    edges = [last * n // 4 for n in range(5)]
    parts = []
    for lo, hi in zip(edges, edges[1:]):
        inside = within_offsets(
            dict.fromkeys(range(3), lo), dict.fromkeys(range(3), hi), "kafka_partition", "kafka_offset"
        )
        parts.append(messages.latency_histogram(t.bronze.where(inside)))
    found = messages.percentiles_of_parts(parts)
    return found.withColumn("collection", F.coalesce("collection", F.lit("all")))


# --- Benchmark days ---------------------------------------------------------------------


def day_inputs(t: Tables) -> bench.DayInputs:
    samples = shape(t, "samples")
    bounds = t.bronze.groupBy(F.to_date("event_time").alias("day"), "kafka_partition").agg(
        F.min("kafka_offset").alias("start_offset"), (F.max("kafka_offset") + 1).alias("end_offset")
    )
    return bench.DayInputs(
        days=t.calendar,
        bounds=bounds,
        bronze=t.bronze,
        samples=samples,
        services=usage.sampled_services(samples, {"branch": "branch", "layer": "layer"}),
        exits=shape(t, "exits"),
        catalog_samples=shape(t, "catalog_samples"),
        host_samples=shape(t, "host_samples"),
        postgres_service="svc-error",
    )


def days(t: Tables) -> dict:
    """The windows of every day, with the services' usage computed once for all three tables."""
    aside = scratch_path(t.spark, "service-usage")

    def keep(rows: DataFrame) -> DataFrame:
        rows.write.parquet(aside)
        return t.spark.read.schema(rows.schema).parquet(aside)

    return bench.day_windows(day_inputs(t), max_gap_seconds=GAP, keep=keep)


BRANCH_DOUBLES = (
    "latency_p50_ms latency_p95_ms host_steal_pct host_psi_mem_ms host_psi_cpu_ms host_psi_io_ms"
    " host_min_available_mib neighbour_cpu_cores"
)


# The three tables one below the other: four figures, a flag and a label of each
WINDOWS = """SELECT CAST(day AS VARCHAR) AS day, window_epoch, branch AS name, messages::DOUBLE AS a,
        latency_p50_ms AS b, latency_p95_ms AS c, neighbour_cpu_cores AS d, CAST(host_contaminated AS VARCHAR) AS flag,
        regime || ' ' || rate_bucket || ' ' || mix AS label
    FROM branch_windows JOIN (
        SELECT day, window_epoch, string_agg(collection || ' ' || n, ', ' ORDER BY collection) AS mix
        FROM (SELECT day, window_epoch, collection, count(*) AS n FROM day_latencies GROUP BY ALL)
        GROUP BY ALL) USING (day, window_epoch)
    UNION ALL SELECT CAST(day AS VARCHAR), window_epoch, service, cpu_ms, ram_mib_s, covered_s,
        peak_anon_mib, CAST(restarted AS VARCHAR), branch || ' ' || layer FROM service_windows
    UNION ALL SELECT CAST(day AS VARCHAR), window_epoch, db, active_ms, active_share, cpu_ms_estimate,
        NULL, 'none', branch FROM catalog_windows"""


@query(
    "rebuild_day",
    WINDOWS,
    "branch_windows service_windows catalog_windows",
    "a:3 b:3 c:3 d",
)
def rebuild_day(t: Tables):
    """The windows of every day written, then written again over themselves: all three tables."""
    root = scratch_path(t.spark, "windows")
    for _ in range(2):
        paths = bench.rebuild_days(day_inputs(t), root, max_gap_seconds=GAP)
    mix = "array_join(transform(array_sort(map_entries(collections)), x -> concat(x.key, ' ', x.value)), ', ')"
    columns = {
        "branch_windows": f"""branch AS name, messages AS a, latency_p50_ms AS b, latency_p95_ms AS c,
            neighbour_cpu_cores AS d, CAST(host_contaminated AS STRING) AS flag, concat(regime, ' ', rate_bucket, ' ', {mix}) AS label""",
        "service_windows": """service AS name, cpu_ms AS a, ram_mib_s AS b, covered_s AS c, peak_anon_mib AS d,
            CAST(restarted AS STRING) AS flag, branch || ' ' || layer AS label""",
        "catalog_windows": """db AS name, active_ms AS a, active_share AS b, cpu_ms_estimate AS c,
            CAST(NULL AS DOUBLE) AS d, 'none' AS flag, branch AS label""",
    }
    found = [
        t.spark.sql(
            f"SELECT CAST(day AS STRING) AS day, window_epoch, {shown} FROM {{rows}}",
            rows=t.spark.read.parquet(paths[name]),
        )
        for name, shown in columns.items()
    ]
    figures = {n: F.col(n).cast("double") for n in "abcd"}
    return union_all([rows.withColumns(figures) for rows in found])


RATIO_DOUBLES = (
    "latency_p50_ms latency_p95_ms cpu_ms_per_message ram_mib_s_per_10k_messages:1"
    " swap_mib_s_per_10k_messages:3 psi_mem_ms peak_anon_mib"
)


def day_ratios(t: Tables):
    windows = days(t)
    return ratios.benchmark_ratios(windows["branch_windows"], windows["service_windows"])


@query(
    "benchmark_ratios",
    "SELECT * REPLACE (CAST(day AS VARCHAR) AS day) FROM ratios",
    "ratios",
    RATIO_DOUBLES,
)
def benchmark_ratios(t: Tables):
    return day_ratios(t)


# From the sums over all windows, not from the windows' ratios
SUMMARY = """count() AS windows, sum(messages)::BIGINT AS messages,
    sum(cpu) / sum(messages) AS cpu_ms_per_message, 10000 * sum(ram) / sum(messages) AS ram_mib_s_per_10k_messages,
    median(latency_p50_ms) AS latency_p50_ms, median(latency_p95_ms) AS latency_p95_ms, max(peak) AS peak_anon_mib"""
SUMMED = "clean_usage JOIN branch_windows USING (day, branch, window_epoch) WHERE messages <> 0"
SUMMARY_DOUBLES = (
    "cpu_ms_per_message ram_mib_s_per_10k_messages:1 latency_p50_ms latency_p95_ms peak_anon_mib"
)
AS_OF = date(2024, 1, 31)


@query(
    "branch_daily",
    f"""SELECT CAST(day AS VARCHAR) AS day, branch, layer, regime, rate_bucket, {SUMMARY}
    FROM {SUMMED} GROUP BY 1, 2, 3, 4, 5""",
    "clean_usage branch_windows",
    SUMMARY_DOUBLES,
)
def branch_daily(t: Tables):
    return ratios.branch_daily(day_ratios(t))


@query(
    "branches_compare",
    f"""SELECT branch, layer, regime, rate_bucket, {SUMMARY},
        quantile_cont(cpu / messages, 0.5) AS cpu_ms_per_message_p50,
        quantile_cont(cpu / messages, 0.95) AS cpu_ms_per_message_p95
    FROM {SUMMED} AND day >= DATE '2024-01-31' - 21 GROUP BY 1, 2, 3, 4""",
    "clean_usage branch_windows",
    f"{SUMMARY_DOUBLES} cpu_ms_per_message_p50 cpu_ms_per_message_p95",
)
def branches_compare(t: Tables):
    return ratios.branches_compare(day_ratios(t), 21, F.lit(AS_OF))


@query(
    "catalogs_compare",
    """SELECT branch, regime, rate_bucket, count() AS windows,
        sum(cpu_ms_estimate) / sum(messages) AS cpu_ms_per_message_estimate,
        avg(active_share) AS active_share
    FROM clean JOIN branch_windows USING (day, branch, window_epoch)
        JOIN catalog_windows USING (day, branch, window_epoch)
    WHERE day >= DATE '2024-01-31' - 21 AND cpu_ms_estimate IS NOT NULL GROUP BY ALL""",
    "clean catalog_windows",
    "cpu_ms_per_message_estimate active_share",
)
def catalogs_compare(t: Tables):
    windows = days(t)
    return ratios.catalogs_compare(
        windows["catalog_windows"],
        windows["branch_windows"],
        windows["service_windows"],
        21,
        F.lit(AS_OF),
    )


@query(
    "windows_kept",
    """WITH broken AS (SELECT day, branch, window_epoch, bool_or(restarted) AS restarted
        FROM service_windows GROUP BY ALL)
    SELECT branch, count() AS windows, sum(host_contaminated::INT)::BIGINT AS contaminated,
        sum(coalesce(restarted, false)::INT)::BIGINT AS restarted
    FROM branch_windows LEFT JOIN broken USING (day, branch, window_epoch)
    WHERE day >= DATE '2024-01-31' - 21 GROUP BY branch""",
    "branch_windows service_windows",
)
def windows_kept(t: Tables):
    windows = days(t)
    return ratios.windows_kept(
        windows["branch_windows"], windows["service_windows"], 21, F.lit(AS_OF)
    )


# --- Live figures -----------------------------------------------------------------------


@query(
    "resources_series",
    """SELECT minute, branch, layer, round(sum(cores), 3) AS cpu_cores,
        round(coalesce(sum(mib), 0), 1) AS anon_mib
    FROM (SELECT date_trunc('minute', ts) AS minute, branch, layer, service,
            sum(cpu_usec - a_cpu_usec) / sum(epoch_us(ts) - epoch_us(a_ts)) AS cores,
            avg(anon_bytes / 1048576.0) AS mib
          FROM (SELECT *, lag(ts) OVER w AS a_ts, lag(cpu_usec) OVER w AS a_cpu_usec,
                    lag(container_id) OVER w AS a_container_id FROM samples WHERE branch IS NOT NULL
                WINDOW w AS (PARTITION BY service ORDER BY ts, container_id))
          WHERE a_container_id = container_id AND cpu_usec >= a_cpu_usec AND ts > a_ts
          GROUP BY 1, 2, 3, 4)
    GROUP BY 1, 2, 3""",
    "samples",
    "cpu_cores anon_mib",
)
def resources_series(t: Tables):
    return usage.resources_series(shape(t, "samples").where("branch IS NOT NULL"))


@query(
    "live_rate",
    """SELECT event_type, ts, CASE WHEN ts > a_ts AND position >= a_position THEN
        (position - a_position) / ((epoch_us(ts) - epoch_us(a_ts)) / 1e6) END AS rate
    FROM (SELECT event_type, ts, position, lag(ts) OVER w AS a_ts, lag(position) OVER w AS a_position
          FROM (SELECT event_type, ts, CASE WHEN event_id % 29 = 0 THEN 0 ELSE event_id * 1000 END
                    AS position FROM events)
          WINDOW w AS (PARTITION BY event_type ORDER BY ts, position))
    WHERE a_ts IS NOT NULL""",
    doubles="rate",
)
def live_rate(t: Tables):
    position = F.when(F.col("event_id") % 29 == 0, F.lit(0)).otherwise(F.col("event_id") * 1000)
    readings = t.events.select("event_type", "ts", position.cast("bigint").alias("position"))
    return usage.live_rate(readings, ["event_type"])


@query(
    "storage_series",
    """SELECT ts, event_type AS prefix, event_id * 1000 AS bytes, user_id AS objects FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def storage_series(t: Tables):
    samples = t.events.select(
        "ts",
        F.col("event_type").alias("prefix"),
        (F.col("event_id") * 1000).alias("bytes"),
        F.col("user_id").alias("objects"),
    )
    now = samples.agg(F.max("ts").cast("string")).first()[0]
    return ratios.rolling(samples, "ts", 7, F.lit(now).cast("timestamp_ntz"))


@query(
    "tables_latest",
    """WITH samples AS (SELECT event_type AS branch, user_id AS table_id,
            max({'ts': ts, 'rows': event_id, 'bytes': floor(value * 1000)::BIGINT}) AS last
        FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 14 DAY GROUP BY ALL)
    SELECT branch, table_id, last.ts AS ts, last.rows AS rows, last.bytes AS bytes,
        CASE WHEN last.rows >= 13 THEN last.bytes / (last.rows // 13 * 13) END AS bytes_per_row
    FROM samples""",
    doubles="bytes_per_row",
)
def tables_latest(t: Tables):
    samples = t.events.select(
        F.col("event_type").alias("branch"),
        F.col("user_id").alias("table_id"),
        "ts",
        F.col("event_id").alias("rows"),
        F.floor(F.col("value") * 1000).alias("bytes"),
        (F.col("event_id") % 13).alias("inlined"),
    )
    now = samples.agg(F.max("ts").cast("string")).first()[0]
    recent = ratios.rolling(samples, "ts", 14, F.lit(now).cast("timestamp_ntz"))
    latest = ranking.latest_per_key(recent, ["branch", "table_id"], [F.desc("ts"), F.desc("rows")])
    per_row = ratios.bytes_per_row(F.col("rows"), F.col("inlined"), F.col("bytes"))
    return latest.withColumn("bytes_per_row", per_row).drop("inlined")


@query(
    "pass_durations",
    """SELECT o_orderkey AS run_id, o_orderpriority AS job, o_orderdate AS started_at,
        epoch_us(o_orderdate + INTERVAL 1 SECOND * CAST(floor(o_totalprice) AS BIGINT))
            / 1e6 - epoch_us(o_orderdate) / 1e6 AS seconds
    FROM orders WHERE o_orderstatus != 'P'
        AND o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus != 'P') - INTERVAL 30 DAY""",
    doubles="seconds",
)
def pass_durations(t: Tables):
    """Orders as runs, each reported twice; those with status P were never started."""
    started = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("timestamp"))
    runs = t.orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("job"),
        started.alias("started_at"),
        (started + F.make_dt_interval(secs=F.floor("o_totalprice"))).alias("ended_at"),
    )
    last = runs.agg(F.max("started_at").cast("string")).first()[0]
    recent = ratios.rolling(runs.unionByName(runs), "started_at", 30, F.lit(last).cast("timestamp"))
    return ratios.pass_durations(recent).drop("ended_at")


# --- Runs -------------------------------------------------------------------------------

CTES["phases"] = (
    "calendar",
    """SELECT CAST(day AS VARCHAR) AS run_id, branch, CAST(day AS TIMESTAMP) + INTERVAL 133 MINUTE AS start_ts,
        CAST(day AS TIMESTAMP) + INTERVAL 571 MINUTE AS end_ts FROM calendar""",
)
CTES["run_usage"] = (
    "phases samples",
    f"""SELECT run_id, service,
        coalesce(sum({_grown("cpu_usec")} * share / 1000), 0) AS cpu_ms,
        coalesce(sum((a_anon_bytes + anon_bytes) / 2.0 * overlap / 1e6 / 1048576), 0) AS ram_mib_s,
        coalesce(sum((a_swap_bytes + swap_bytes) / 2.0 * overlap / 1e6 / 1048576), 0) AS swap_mib_s,
        coalesce(max(CASE WHEN overlap IS NOT NULL AND a_anon_bytes IS NOT NULL AND anon_bytes IS NOT NULL
            THEN greatest(a_anon_bytes, anon_bytes) END) / 1048576.0, 0) AS peak_anon_mib,
        coalesce(sum({_grown("pgmajfault")} * share), 0) AS majfaults,
        coalesce(sum(overlap / 1e6), 0) AS covered_s, bool_or(restart) AS restarted
    FROM (SELECT *, overlap / (e_us - s_us)::DOUBLE AS share FROM (
        SELECT *, CASE WHEN NOT restart THEN least(e_us, p_end) - greatest(s_us, p_start) END AS overlap
        FROM (SELECT *, epoch_us(a_ts) AS s_us, epoch_us(ts) AS e_us,
                container_id != a_container_id AS restart FROM (
                SELECT *, {_lags("ts container_id cpu_usec anon_bytes swap_bytes pgmajfault")}
                FROM samples WINDOW w AS (PARTITION BY service ORDER BY ts, container_id))
              WHERE a_ts IS NOT NULL) AS p
        JOIN (SELECT run_id, epoch_us(start_ts) AS p_start, epoch_us(end_ts) AS p_end FROM phases) AS f
            ON s_us <= p_end AND e_us >= p_start
        WHERE CASE WHEN restart THEN e_us BETWEEN p_start AND p_end
            ELSE e_us > s_us AND e_us - s_us <= {GAP_US} END))
    WHERE restart OR overlap > 0
    GROUP BY 1, 2""",
)
CTES["layer_usage"] = (
    "run_usage samples",
    """SELECT run_id, layer, sum(cpu_ms) AS cpu_ms, sum(ram_mib_s) AS ram_mib_s,
        sum(swap_mib_s) AS swap_mib_s, sum(peak_anon_mib) AS peak_anon_mib,
        sum(majfaults) AS majfaults, max(covered_s) AS covered_s, bool_or(restarted) AS restarted
    FROM run_usage JOIN (SELECT DISTINCT service, layer FROM samples) USING (service) GROUP BY 1, 2""",
)
CTES["arrivals"] = (
    "bronze",
    """SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS run_id, kafka_partition, kafka_offset,
        min(epoch_us(processed_at) // 1000) AS ms, min(epoch_us(event_time) // 1000) AS sent_ms
    FROM bronze GROUP BY 1, 2, 3""",
)
CTES["arrival_figures"] = (
    "arrivals",
    """SELECT run_id, count(*) AS bronze_messages, make_timestamp_ms(lo) AS first_processed_at,
        make_timestamp_ms(max(ms)) AS last_processed_at,
        count(*) FILTER (WHERE ms > lo) / nullif((max(ms) - lo) / 1000, 0) AS throughput_msg_s,
        quantile_cont(ms - sent_ms, 0.5) AS latency_p50_ms,
        quantile_cont(ms - sent_ms, 0.95) AS latency_p95_ms
    FROM (SELECT *, min(ms) OVER (PARTITION BY run_id) AS lo FROM arrivals) GROUP BY run_id, lo""",
)
PHASE_DOUBLES = "cpu_ms:3 ram_mib_s:3 swap_mib_s:3 peak_anon_mib majfaults covered_s"


def run_usage(t: Tables):
    midnight = F.col("day").cast("timestamp")
    phases = t.calendar.select(
        F.col("day").cast("string").alias("run_id"),
        (midnight + F.make_dt_interval(mins=F.lit(133))).alias("start_ts"),
        (midnight + F.make_dt_interval(mins=F.lit(571))).alias("end_ts"),
    )
    return usage.interval_usage(shape(t, "samples"), phases, ["run_id"], max_gap_seconds=GAP)


def layer_usage(t: Tables):
    layers = usage.sampled_services(shape(t, "samples"), {"layer": "layer"})
    return usage.phase_usage(run_usage(t), layers, ["run_id"])


@query("interval_usage", "SELECT * FROM run_usage", "run_usage", PHASE_DOUBLES)
def interval_usage(t: Tables):
    return run_usage(t)


@query("phase_usage", "SELECT * FROM layer_usage", "layer_usage", PHASE_DOUBLES)
def phase_usage(t: Tables):
    return layer_usage(t)


def arrivals(t: Tables):
    run = F.to_date("event_time").cast("string").alias("run_id")
    rows = t.bronze.select(run, "kafka_partition", "kafka_offset", "processed_at", "event_time")
    keys = ["run_id", "kafka_partition", "kafka_offset"]
    sends = rows.groupBy(*keys).agg(F.min("event_time").alias("sent_at"))
    return messages.arrival_measures(rows, sends, ["run_id"])


@query(
    "arrival_measures",
    "SELECT * FROM arrival_figures",
    "arrival_figures",
    "throughput_msg_s latency_p50_ms latency_p95_ms",
)
def arrival_measures(t: Tables):
    return arrivals(t)


BENCH_DOUBLES = (
    "throughput_msg_s latency_p50_ms latency_p95_ms ingest_cpu_ms_per_message"
    " ingest_ram_mib_s_per_10k_messages:1 ingest_peak_mib transform_cpu_ms_per_message"
    " transform_ram_mib_s_per_10k_messages:1 transform_seconds transform_rows_per_s"
)


def _layer(layer: str, figure: str) -> str:
    return f"max({figure}) FILTER (WHERE layer = '{layer}')"


def _transform(figure: str) -> str:
    return f"coalesce({_layer('transform', figure)}, 0) + coalesce({_layer('catalog', figure)}, 0)"


@query(
    "bench_ratios",
    f"""SELECT run_id, branch, bronze_messages, throughput_msg_s,
        CASE WHEN relevant THEN latency_p50_ms END AS latency_p50_ms,
        CASE WHEN relevant THEN latency_p95_ms END AS latency_p95_ms,
        i_cpu / bronze_messages AS ingest_cpu_ms_per_message,
        i_ram * 10000 / bronze_messages AS ingest_ram_mib_s_per_10k_messages, i_peak AS ingest_peak_mib,
        coalesce(t_cpu, 0) / bronze_messages AS transform_cpu_ms_per_message,
        coalesce(t_ram, 0) * 10000 / bronze_messages AS transform_ram_mib_s_per_10k_messages,
        26280.0 AS transform_seconds, bronze_messages / 26280.0 AS transform_rows_per_s
    FROM (SELECT *, day(CAST(run_id AS DATE)) % 3 != 0 AS relevant FROM arrival_figures) AS a
    JOIN phases USING (run_id)
    LEFT JOIN (SELECT run_id, {_layer("streaming", "cpu_ms")} AS i_cpu,
            {_layer("streaming", "ram_mib_s")} AS i_ram, {_layer("streaming", "peak_anon_mib")} AS i_peak,
            {_transform("cpu_ms")} AS t_cpu, {_transform("ram_mib_s")} AS t_ram
        FROM layer_usage GROUP BY 1) USING (run_id)
    WHERE day(CAST(run_id AS DATE)) % 7 != 0""",
    "arrival_figures phases layer_usage",
    BENCH_DOUBLES,
)
def bench_ratios(t: Tables):
    """Days as runs; one in seven failed, and one in three has no meaningful latency."""
    number = F.dayofmonth("day")
    midnight = F.col("day").cast("timestamp")
    calendar = t.calendar.select(
        F.col("day").cast("string").alias("run_id"),
        "branch",
        F.col("day").alias("night"),
        F.lit("1x").alias("rate"),
        F.lit(1).alias("repetition"),
        F.when(number % 7 == 0, "failed").otherwise("done").alias("status"),
        (number % 3 != 0).alias("latency_relevant"),
        (midnight + F.make_dt_interval(mins=F.lit(133))).alias("transform_started_at"),
        (midnight + F.make_dt_interval(mins=F.lit(571))).alias("transform_finished_at"),
        F.lit(1).alias("transform_passes"),
    )
    layers = usage.usage_by_layer(layer_usage(t), ["run_id"], "ingest_usage")
    layers = layers.withColumn("transform_usage", F.col("ingest_usage"))
    runs = arrivals(t).join(calendar, "run_id").join(layers, "run_id", "left")
    extra = ("night", "rate", "repetition", "transform_passes")
    return ratios.bench_ratios(runs).drop(*extra)


@query(
    "tipping_point",
    """WITH fits AS (SELECT branch, regr_slope(cost, 1 / rate) AS f,
            regr_intercept(cost, 1 / rate) AS m, max(rate) AS top FROM cost_points GROUP BY 1),
    pair AS (SELECT d.f AS df, d.m AS dm, d.top AS dtop, s.f AS sf, s.m AS sm, s.top AS stop,
            (s.f - d.f) / nullif(d.m - s.m, 0) AS r
        FROM fits AS d, fits AS s WHERE d.branch = 'duckdb' AND s.branch = 'spark'),
    judged AS (SELECT *, r IS NOT NULL AND r > 0 AS crosses,
            CASE WHEN df / greatest(dtop, stop) + dm <= sf / greatest(dtop, stop) + sm
                THEN 'duckdb' ELSE 'spark' END AS always FROM pair)
    SELECT CASE WHEN crosses THEN r END AS rate,
        CASE WHEN NOT crosses THEN 'none' WHEN r <= least(dtop, stop) THEN 'measured'
            ELSE 'extrapolated' END AS kind,
        CASE WHEN NOT crosses THEN always WHEN df < sf THEN 'duckdb' ELSE 'spark' END AS cheaper_below,
        CASE WHEN NOT crosses THEN always WHEN df < sf THEN 'spark' ELSE 'duckdb' END AS cheaper_above
    FROM judged""",
    "cost_points",
    "rate",
)
def tipping_point(t: Tables):
    return ratios.tipping_point(ratios.cost_fit(cost_points(t)))


# --- Checks and parity ------------------------------------------------------------------

SINCE = datetime(2024, 1, 8)


@query(
    "check_not_null",
    "SELECT seq, event_time FROM silver_likes WHERE subject_uri IS NULL",
    "silver_likes",
)
def check_not_null(t: Tables):
    likes = silver_tables(t)["silver_likes"]
    return checks.check_not_null(likes, "subject_uri").select("seq", "event_time")


@query(
    "check_unique",
    """SELECT seq, count(*) AS n_rows FROM bronze WHERE processed_at >= TIMESTAMP '2024-01-08'
    GROUP BY 1 HAVING count(*) > 1""",
    "bronze",
)
def check_unique(t: Tables):
    return checks.check_unique(t.bronze, "seq", utc(SINCE))


@query(
    "check_accepted_values",
    """SELECT lang, count(*) AS n_rows FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 1""",
)
def check_accepted_values(t: Tables):
    return checks.check_accepted_values(t.documents, "lang", ["en", "fr"])


@query(
    "check_unique_combination",
    """SELECT did, collection, operation, count(*) AS n_rows FROM bronze GROUP BY 1, 2, 3
    HAVING count(*) > 1""",
    "bronze",
)
def check_unique_combination(t: Tables):
    return checks.check_unique_combination(t.bronze, ["did", "collection", "operation"])


@query(
    "check_at_uri",
    f"""SELECT model, seq, subject_uri FROM (
        SELECT 'silver_likes' AS model, seq, subject_uri, processed_at FROM silver_likes
        UNION ALL SELECT 'silver_reposts', seq, subject_uri, processed_at FROM silver_reposts)
    WHERE processed_at >= TIMESTAMP '2024-01-08'
        AND NOT regexp_matches(subject_uri, '{c.AT_URI_PATTERN}')""",
    "silver_likes silver_reposts",
)
def check_at_uri(t: Tables):
    silver = silver_tables(t)
    tables = {name: silver[name] for name in ("silver_likes", "silver_reposts")}
    return checks.check_at_uri(tables, since=utc(SINCE))


@query(
    "check_silver_matches_bronze",
    """SELECT model, problem, events FROM (
        SELECT 'silver_posts' AS model, 'missing from Silver' AS problem, count(DISTINCT seq) AS events
            FROM bronze WHERE commit_id <= 6 AND processed_at >= TIMESTAMP '2024-01-08'
            AND collection = 'app.bsky.feed.post' AND operation = 'update'
        UNION ALL SELECT 'silver_likes', 'absent from Bronze', count(DISTINCT seq) FROM bronze
            WHERE processed_at >= TIMESTAMP '2024-01-08' AND collection = 'app.bsky.feed.like'
            AND operation = 'create'
            AND seq NOT IN (SELECT seq FROM bronze WHERE commit_id <= 4))
    WHERE events > 0""",
    "bronze",
)
def check_silver_matches_bronze(t: Tables):
    """Two seeded faults: posts lack their edits, and likes hold events Bronze does not have
    as of the commit they have read."""
    silver = silver_tables_upto(t, 6)
    silver["silver_posts"] = silver["silver_posts"].where("operation = 'create'")
    silver["silver_likes"] = silver_tables(t)["silver_likes"]
    reached = dict.fromkeys(silver, 6) | {"silver_likes": 4}
    return checks.check_silver_matches_bronze(t.bronze, silver, reached, utc(SINCE))


def silver_tables_upto(t: Tables, commit: int) -> dict:
    bronze = t.bronze.where(F.col("commit_id") <= commit)
    return {name: dedup_batch(model(bronze)) for name, model in SILVER.items()}


@query(
    "check_gold_matches_silver",
    """SELECT model, hour, silver_value, gold_value FROM (
        SELECT 'gold_engagement_hour' AS model, hour, likes AS silver_value, likes + 1 AS gold_value
            FROM gold_engagement_hour WHERE likes > 6
        UNION ALL SELECT 'gold_active_users_hour', hour, active_accounts, NULL
            FROM gold_active_users_hour WHERE collection = 'app.bsky.feed.like' AND active_accounts > 4)
    WHERE hour >= TIMESTAMP '2024-01-08' AND hour < TIMESTAMP '2024-01-20'""",
    "gold_engagement_hour gold_active_users_hour",
    "gold_value",
)
def check_gold_matches_silver(t: Tables):
    """Two seeded faults: one like too many in busy hours, and lost rows of busy hours. From
    the twentieth on every hour is still pending, so nothing is reported."""
    silver = silver_tables(t)
    gold = {
        name: GOLD[name](silver)
        for name in ("gold_activity_minute", "gold_engagement_hour", "gold_active_users_hour")
    }
    hours = gold["gold_engagement_hour"].where("hour >= '2024-01-20'").select("hour")
    names = F.explode(F.array(*[F.lit(name) for name in gold]))
    pending = hours.select(names.alias("model"), "hour")
    more = F.when(F.col("likes") > 6, F.col("likes") + 1).otherwise(F.col("likes"))
    lost = (F.col("collection") == c.LIKE) & (F.col("active_accounts") > 4)
    gold["gold_engagement_hour"] = gold["gold_engagement_hour"].withColumn("likes", more)
    gold["gold_active_users_hour"] = gold["gold_active_users_hour"].where(~lost)
    found = checks.check_gold_matches_silver(silver, gold, pending, utc(SINCE))
    # NULL on one side: compared as a double, which both engines print alike
    return found.withColumn("gold_value", F.col("gold_value").cast("double"))


@query(
    "completeness",
    """SELECT kafka_partition::BIGINT AS kafka_partition, end_offset - start_offset AS expected,
        coalesce(found, 0) AS found, end_offset - start_offset - coalesce(found, 0) AS missing
    FROM bounds LEFT JOIN (SELECT b.kafka_partition, count(DISTINCT kafka_offset) AS found
        FROM bronze AS b JOIN bounds AS r ON r.kafka_partition = b.kafka_partition
            AND kafka_offset >= start_offset AND kafka_offset < end_offset
        WHERE operation != 'update' GROUP BY 1) USING (kafka_partition)""",
    "bounds",
)
def completeness(t: Tables):
    """Bronze that lost the edits."""
    from catalogue.relational import bounds

    return checks.completeness(t.bronze.where("operation != 'update'"), bounds(t))


@query(
    "parity",
    """SELECT 'silver_likes' AS table_name, (SELECT count(*) FROM silver_likes) AS rows_a,
        (SELECT count(*) FROM silver_likes WHERE subject_uri IS NOT NULL) AS rows_b,
        (SELECT count(*) FROM silver_likes WHERE subject_uri IS NULL) AS only_in_a, 0 AS only_in_b
    UNION ALL SELECT 'silver_posts', (SELECT count(*) FROM silver_posts), (SELECT count(*) FROM silver_posts), 0, 0
    UNION ALL SELECT 'gold_langs_hour', (SELECT count(*) FROM gold_langs_hour),
        (SELECT count(*) FROM gold_langs_hour),
        (SELECT count(*) FROM gold_langs_hour WHERE lang = 'fr'),
        (SELECT count(*) FROM gold_langs_hour WHERE lang = 'fr')""",
    "silver_likes silver_posts gold_langs_hour",
)
def parity(t: Tables):
    """Against a copy without likes of nothing, with reversed lists and one label changed."""
    return compare(*parity_sides(t))


def parity_sides(t: Tables) -> tuple[dict, dict]:
    silver = silver_tables(t)
    langs = GOLD["gold_langs_hour"](silver)
    a = {**{n: silver[n] for n in ("silver_likes", "silver_posts")}, "gold_langs_hour": langs}
    other = F.when(F.col("lang") == "fr", "xx").otherwise(F.col("lang"))
    b = {
        "silver_likes": silver["silver_likes"].where("subject_uri IS NOT NULL"),
        "silver_posts": silver["silver_posts"].withColumn("hashtags", F.reverse("hashtags")),
        "gold_langs_hour": langs.withColumn("lang", other),
    }
    return a, b


@query("parity_checksums", ORACLES["parity"].sql, "silver_likes silver_posts gold_langs_hour")
def parity_checksums(t: Tables):
    """The same comparison by sums of row hashes, and of rows only where sums differ."""
    a, b = parity_sides(t)
    return union_all([checksum_parity(name, a[name], b[name]) for name in a])


@query("completeness_runs", ORACLES["completeness"].sql, "bounds")
def completeness_runs(t: Tables):
    """The same figures from runs of offsets, kept commit by commit: the second check reads what was
    appended since the first, the third nothing."""
    from catalogue.relational import bounds

    table = CommitTable(t.spark, scratch_path(t.spark, "offsets"), c.BRONZE_SCHEMA)
    store = RunStore(t.spark, scratch_path(t.spark, "runs"))
    rows = t.bronze.where("operation != 'update'")
    for first, last in ((1, 3), (4, 6), (7, 8)):
        table.append(rows.where(F.col("commit_id").between(first, last)), last)
        store.update(table)
    store.merge()
    return completeness_of_runs(store.read(), bounds(t))


@query("check_silver_recent", ORACLES["check_silver_matches_bronze"].sql, "bronze")
def check_silver_recent(t: Tables):
    """The check of recent events over stored tables, whose logs say which hours to read."""
    silver = silver_tables_upto(t, 6)
    silver["silver_posts"] = silver["silver_posts"].where("operation = 'create'")
    silver["silver_likes"] = silver_tables(t)["silver_likes"]
    root = scratch_path(t.spark, "recent")
    bronze = CommitTable(t.spark, f"{root}/bronze", c.BRONZE_SCHEMA)
    for first, last in ((1, 4), (5, 6), (7, 8)):
        bronze.append(t.bronze.where(F.col("commit_id").between(first, last)), last)
    stored = {name: CommitTable(t.spark, f"{root}/{name}", SILVER_SCHEMAS[name], rebalance=True) for name in silver}
    for name, table in stored.items():
        table.append(silver[name], 1)
    moment = datetime.fromisoformat(str(SINCE))
    hours = checks.hours_since([bronze, *stored.values()], moment)
    reached = dict.fromkeys(silver, 6) | {"silver_likes": 4}
    read = {name: table.read() for name, table in stored.items()}
    return checks.check_silver_matches_bronze(bronze.read(), read, reached, utc(SINCE), hours=hours)


@query(
    "calendar_latest",
    """SELECT CAST(day AS VARCHAR) AS day, coalesce(forced_branch, CASE (day - DATE '2024-01-02') % 2
        WHEN 0 THEN 'duckdb' ELSE 'spark' END) AS branch
    FROM calendar WHERE day > (SELECT max(day) - 2 FROM calendar)""",
    "calendar",
)
def calendar_latest(t: Tables):
    found = ratios.calendar_latest(t.calendar, date(2024, 1, 2))
    return found.select(F.col("day").cast("string").alias("day"), "branch")


def _suite_sql() -> str:
    parts = []
    for check in checks.SUITE:
        columns = ", ".join(check.columns)
        recent = " AND processed_at >= TIMESTAMP '2024-01-08'" if check.recent_only else ""
        wrong = {
            "not_null": f"SELECT 1 FROM {check.model} WHERE {columns} IS NULL",
            "accepted": f"SELECT 1 FROM {check.model} WHERE {columns} NOT IN {check.accepted}{recent}",
            "unique": f"SELECT {columns} FROM {check.model} WHERE true{recent}"
            f"{''.join(f' AND {x} IS NOT NULL' for x in check.columns)} GROUP BY {columns} HAVING count(*) > 1",
        }[check.kind]
        if "bronze_snapshot_id" in columns:
            wrong = f"SELECT 1 FROM {check.model} WHERE seq % 29 = 0"
        parts.append(f"SELECT '{check.model}' AS model, '{check.name}' AS \"check\", '{check.severity}' AS severity,"
                     f" (SELECT count(*) FROM ({wrong})) AS failures")
    return " UNION ALL ".join(parts)


SUITE_MODELS = tuple(dict.fromkeys(check.model for check in checks.SUITE))


@query("check_suite", _suite_sql(), " ".join(SUITE_MODELS))
def check_suite(t: Tables):
    """The declared checks of all ten models. Snapshots are the commits of the rows, and some rows
    have none."""
    snapshot = F.when(F.col("seq") % 29 != 0, F.col("commit_id"))
    bronze = t.bronze.withColumn("bronze_snapshot_id", snapshot)
    silver = {name: dedup_batch(model(bronze)) for name, model in SILVER.items()}
    built = {**silver, **{name: model(silver) for name, model in GOLD.items()}}
    return checks.run_suite({name: built[name] for name in SUITE_MODELS}, utc(SINCE))
