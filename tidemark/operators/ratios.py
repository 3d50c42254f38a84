"""Ratios per message over clean windows, and the figures built on them.

All inputs here are window figures: one row per five minutes and branch, service or
database, whatever the number of events behind them."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.labels import rotation_branch
from tidemark.operators.aggregates import per_unit, ratio_of_sums
from tidemark.operators.percentiles import percentile_within_group

WINDOW = ["day", "window_epoch", "branch"]


def restarted_windows(services: DataFrame) -> DataFrame:
    """Windows of a branch in which any of its services restarted."""
    return services.where("restarted").select(*WINDOW).distinct()


def clean_windows(branches: DataFrame, services: DataFrame) -> DataFrame:
    return branches.where(~F.col("host_contaminated")).join(
        restarted_windows(services), WINDOW, "left_anti"
    )


def benchmark_ratios(
    branches: DataFrame, services: DataFrame, seconds: int = c.WINDOW_SECONDS
) -> DataFrame:
    """Cost per message, window and layer, over clean and covered windows.

    The restarts of a window ride along with its layers, of which there are a few: the
    services are read once."""
    covered = F.col("covered_s") >= F.lit(seconds * c.MIN_COVERAGE)

    def of_covered(figure: str) -> Column:
        return F.when(covered, F.col(figure))

    layers = services.groupBy(*WINDOW, "layer").agg(
        F.sum(of_covered("cpu_ms")).alias("_cpu"),
        F.sum(of_covered("ram_mib_s")).alias("_ram"),
        F.sum(of_covered("swap_mib_s")).alias("_swap"),
        F.sum(of_covered("psi_mem_ms")).alias("psi_mem_ms"),
        F.max(of_covered("peak_anon_mib")).alias("peak_anon_mib"),
        F.count_if(covered).alias("_covered"),
        F.bool_or("restarted").alias("_restarted"),
    )
    any_restart = F.max("_restarted").over(Window.partitionBy(*WINDOW))
    kept = layers.withColumn("_restarted", any_restart).where("_covered > 0 AND NOT _restarted")
    clean = branches.where(~F.col("host_contaminated"))
    messages = F.col("messages")
    return clean.join(kept, WINDOW).select(
        *WINDOW,
        "regime",
        "rate_bucket",
        "messages",
        "latency_p50_ms",
        "latency_p95_ms",
        "layer",
        per_unit(F.col("_cpu"), messages).alias("cpu_ms_per_message"),
        per_unit(F.col("_ram") * 10000, messages).alias("ram_mib_s_per_10k_messages"),
        per_unit(F.col("_swap") * 10000, messages).alias("swap_mib_s_per_10k_messages"),
        "psi_mem_ms",
        "peak_anon_mib",
    )


def _summary() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("windows"),
        F.sum("messages").alias("messages"),
        ratio_of_sums("cpu_ms_per_message", "messages").alias("cpu_ms_per_message"),
        ratio_of_sums("ram_mib_s_per_10k_messages", "messages").alias(
            "ram_mib_s_per_10k_messages"
        ),
        percentile_within_group("latency_p50_ms", 0.5).alias("latency_p50_ms"),
        percentile_within_group("latency_p95_ms", 0.5).alias("latency_p95_ms"),
        F.max("peak_anon_mib").alias("peak_anon_mib"),
    ]


def branch_daily(ratios: DataFrame) -> DataFrame:
    """Ratios of sums by day, branch, layer, regime and traffic level."""
    return ratios.groupBy("day", "branch", "layer", "regime", "rate_bucket").agg(*_summary())


def _since(rows: DataFrame, as_of: Column | None, days: int | None) -> DataFrame:
    if days is None:
        return rows
    today = F.current_date() if as_of is None else as_of
    return rows.where(F.col("day") >= F.date_sub(today, days))


def branches_compare(
    ratios: DataFrame, days: int | None = None, as_of: Column | None = None
) -> DataFrame:
    """The same over the last `days` days, with the spread of the cost per message."""
    return (
        _since(ratios, as_of, days)
        .groupBy("branch", "layer", "regime", "rate_bucket")
        .agg(
            *_summary(),
            percentile_within_group("cpu_ms_per_message", 0.5).alias("cpu_ms_per_message_p50"),
            percentile_within_group("cpu_ms_per_message", 0.95).alias("cpu_ms_per_message_p95"),
        )
    )


def catalogs_compare(
    catalogs: DataFrame,
    branches: DataFrame,
    services: DataFrame,
    days: int | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Estimated catalog CPU per message of its branch, over clean windows."""
    kept = _since(catalogs, as_of, days).where(F.col("cpu_ms_estimate").isNotNull())
    clean = clean_windows(branches, services).select(*WINDOW, "regime", "rate_bucket", "messages")
    return (
        kept.select(*WINDOW, "cpu_ms_estimate", "active_share")
        .join(clean, WINDOW)
        .groupBy("branch", "regime", "rate_bucket")
        .agg(
            F.count(F.lit(1)).alias("windows"),
            per_unit(F.sum("cpu_ms_estimate"), F.sum("messages")).alias(
                "cpu_ms_per_message_estimate"
            ),
            F.avg("active_share").alias("active_share"),
        )
    )


def windows_kept(
    branches: DataFrame, services: DataFrame, days: int | None = None, as_of: Column | None = None
) -> DataFrame:
    """Windows per branch, and how many were left out for which reason."""
    flagged = restarted_windows(services).withColumn("_restarted", F.lit(True))
    return (
        _since(branches, as_of, days)
        .join(flagged, WINDOW, "left")
        .groupBy("branch")
        .agg(
            F.count(F.lit(1)).alias("windows"),
            F.count_if("host_contaminated").alias("contaminated"),
            F.count_if("_restarted").alias("restarted"),
        )
    )


def bench_ratios(runs: DataFrame) -> DataFrame:
    """Cost per message of each finished run, by phase.

    `ingest_usage` and `transform_usage` are maps layer -> struct of figures."""

    def used(phase: str, layer: str, figure: str) -> Column:
        return F.try_element_at(F.col(phase), F.lit(layer))[figure]

    def transform(figure: str) -> Column:
        zero = F.lit(0.0)
        return F.coalesce(used("transform_usage", "transform", figure), zero) + F.coalesce(
            used("transform_usage", "catalog", figure), zero
        )

    messages = F.col("bronze_messages")
    elapsed = F.unix_micros("transform_finished_at") - F.unix_micros("transform_started_at")
    seconds = elapsed / F.lit(1e6)
    relevant = F.col("latency_relevant")
    return runs.where(F.col("status") == "done").select(
        "run_id",
        "branch",
        "night",
        "rate",
        "repetition",
        "bronze_messages",
        "throughput_msg_s",
        F.when(relevant, F.col("latency_p50_ms")).alias("latency_p50_ms"),
        F.when(relevant, F.col("latency_p95_ms")).alias("latency_p95_ms"),
        per_unit(used("ingest_usage", "streaming", "cpu_ms"), messages).alias(
            "ingest_cpu_ms_per_message"
        ),
        per_unit(used("ingest_usage", "streaming", "ram_mib_s") * 10000, messages).alias(
            "ingest_ram_mib_s_per_10k_messages"
        ),
        used("ingest_usage", "streaming", "peak_anon_mib").alias("ingest_peak_mib"),
        per_unit(transform("cpu_ms"), messages).alias("transform_cpu_ms_per_message"),
        per_unit(transform("ram_mib_s") * 10000, messages).alias(
            "transform_ram_mib_s_per_10k_messages"
        ),
        seconds.alias("transform_seconds"),
        per_unit(messages, seconds).alias("transform_rows_per_s"),
        "transform_passes",
    )


def cost_fit(points: DataFrame, branch: str = "branch") -> DataFrame:
    """Least squares of cost = fixed / rate + marginal per branch.

    `points` has `rate` and `cost`; points without a positive rate or a cost are left
    out, and a branch with fewer than two distinct rates has no fit."""
    valid = points.where((F.col("rate") > 0) & F.col("cost").isNotNull())
    x, y = F.lit(1.0) / F.col("rate"), F.col("cost")
    fits = valid.groupBy(branch).agg(
        F.regr_slope(y, x).alias("fixed_ms_per_s"),
        F.regr_intercept(y, x).alias("marginal_ms_per_message"),
        F.when(F.var_pop(y) > 0, F.regr_r2(y, x)).alias("r2"),
        F.count(F.lit(1)).alias("runs"),
        F.min("rate").alias("min_rate"),
        F.max("rate").alias("max_rate"),
        F.min(F.round("rate", 6)).alias("_lo"),
        F.max(F.round("rate", 6)).alias("_hi"),
    )
    return fits.where(F.col("_lo") < F.col("_hi")).drop("_lo", "_hi")


FIT_FIGURES = ("fixed_ms_per_s", "marginal_ms_per_message", "max_rate")


def tipping_point(fits: DataFrame, base: str = "duckdb", other: str = "spark") -> DataFrame:
    """The rate from which `other` costs less per message than `base`, as one row.

    Two cost lines cross at (F_other - F_base) / (m_base - m_other). Without a positive
    crossing one branch is cheaper at every rate: the one that is at the fastest run."""

    def of(branch: str, figure: str) -> Column:
        return F.max(F.when(F.col("branch") == branch, F.col(figure)))

    row = fits.agg(
        *[of(base, figure).alias(f"b_{figure}") for figure in FIT_FIGURES],
        *[of(other, figure).alias(f"o_{figure}") for figure in FIT_FIGURES],
    )
    b_fixed, b_marginal = F.col("b_fixed_ms_per_s"), F.col("b_marginal_ms_per_message")
    o_fixed, o_marginal = F.col("o_fixed_ms_per_s"), F.col("o_marginal_ms_per_message")
    known = b_fixed.isNotNull() & o_fixed.isNotNull()
    candidate = (o_fixed - b_fixed) / F.nullif(b_marginal - o_marginal, F.lit(0.0))
    rate = F.when(candidate > 0, candidate)
    fastest = F.greatest("b_max_rate", "o_max_rate")
    base_wins = b_fixed / fastest + b_marginal <= o_fixed / fastest + o_marginal
    always = F.when(base_wins, base).otherwise(other)
    small_fixed = F.when(b_fixed < o_fixed, base).otherwise(other)
    large_fixed = F.when(b_fixed < o_fixed, other).otherwise(base)
    measured = F.col("rate") <= F.least("b_max_rate", "o_max_rate")
    crossing = F.col("rate").isNotNull()
    return row.withColumn("rate", rate).select(
        "rate",
        F.when(~known, "unknown")
        .when(~crossing, "none")
        .when(measured, "measured")
        .otherwise("extrapolated")
        .alias("kind"),
        F.when(known, F.when(crossing, small_fixed).otherwise(always)).alias("cheaper_below"),
        F.when(known, F.when(crossing, large_fixed).otherwise(always)).alias("cheaper_above"),
    )


def total_cost_points(ratios: DataFrame) -> DataFrame:
    """(branch, rate, cost) of each run: ingestion plus transformation, NULL as 0."""
    zero = F.lit(0.0)
    cost = F.coalesce("ingest_cpu_ms_per_message", zero) + F.coalesce(
        "transform_cpu_ms_per_message", zero
    )
    return ratios.select("branch", F.col("throughput_msg_s").alias("rate"), cost.alias("cost"))


def pass_durations(runs: DataFrame) -> DataFrame:
    """Finished passes with their duration, once per run; never-started ones dropped."""
    finished = runs.where(F.col("started_at").isNotNull() & F.col("ended_at").isNotNull())
    seconds = (F.unix_micros("ended_at") - F.unix_micros("started_at")) / F.lit(1e6)
    return finished.dropDuplicates(["run_id"]).withColumn("seconds", seconds)


def rolling(rows: DataFrame, ts: str, days: int, as_of: Column) -> DataFrame:
    """Rows of the last `days` days before `as_of`."""
    return rows.where(F.col(ts) >= as_of - F.make_dt_interval(days=F.lit(days)))


def bytes_per_row(rows: Column, inlined: Column, size: Column) -> Column:
    """Bytes per stored row, rows kept in the catalog itself left out."""
    return per_unit(size.cast("double"), rows - inlined)


def calendar_latest(calendar: DataFrame, start: date, days: int = 2) -> DataFrame:
    """The latest days of the calendar with the branch of each: a forced one wins over the
    rotation that began at `start`."""
    latest = calendar.orderBy(F.desc("day")).limit(days)
    return latest.withColumn("branch", rotation_branch(F.col("day"), start, F.col("forced_branch")))
