"""Resource usage from samples of cumulative counters.

Sample columns: `ts`, `container_id`, counters `cpu_usec`, `mem_psi_full_us`, `pgmajfault`
and levels `anon_bytes`, `swap_bytes`, per `service`. Window starts are epoch seconds."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.times import epoch_window
from tidemark.operators.series import (
    consecutive_pairs,
    counter_delta,
    micros,
    overlapped_windows,
    trapezoid,
    window_micros,
    window_share,
)

MIB = float(2**20)
SECOND = 1_000_000


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _timed(pairs: DataFrame) -> DataFrame:
    start, end = micros(F.col("a.ts")), micros(F.col("b.ts"))
    return pairs.withColumn("start_us", start).withColumn("end_us", end).withColumn(
        "gap_us", F.col("end_us") - F.col("start_us")
    )


def _usable(max_gap_seconds: float) -> Column:
    return (F.col("gap_us") > 0) & (F.col("gap_us") <= int(max_gap_seconds * SECOND))


def _restart() -> Column:
    return ~F.col("a.container_id").eqNullSafe(F.col("b.container_id"))


def service_windows(
    samples: DataFrame,
    series: Sequence[str] = ("service",),
    max_gap_seconds: float = c.MAX_SAMPLE_GAP_SECONDS,
    seconds: int = c.WINDOW_SECONDS,
) -> DataFrame:
    """Usage per service and window.

    A pair of samples spreads its counter growth and memory integral over the windows it
    overlaps, by time. A pair across two containers only flags the window of its later
    sample; a pair with a gap that is too long or not positive is not used."""
    series = list(series)
    pairs = _timed(consecutive_pairs(samples, series, tie_break=("container_id",)))
    windows = (
        F.when(_restart(), F.array(window_micros(F.col("end_us"), seconds)))
        .when(_usable(max_gap_seconds), overlapped_windows(F.col("start_us"), F.col("end_us"), seconds))
        .otherwise(F.array().cast("array<bigint>"))
    )
    parts = pairs.withColumn("restart", _restart()).withColumn("window_us", F.explode(windows))
    counted = ~F.col("restart")
    share = F.when(counted, window_share(F.col("window_us"), F.col("start_us"), F.col("end_us"), seconds))
    parts = parts.withColumn("share", share)
    gap_s = F.col("gap_us") / F.lit(float(SECOND))

    def grown(name: str) -> Column:
        return _zero(counter_delta(F.col(f"a.{name}"), F.col(f"b.{name}"))) * F.col("share")

    def integral(name: str) -> Column:
        mean = trapezoid(F.col(f"a.{name}"), F.col(f"b.{name}"))
        return _zero(mean * gap_s / F.lit(MIB)) * F.col("share")

    peak = F.when(counted, F.greatest(F.col("a.anon_bytes"), F.col("b.anon_bytes")))
    return (
        parts.groupBy(*series, (F.col("window_us") / SECOND).cast("bigint").alias("window_epoch"))
        .agg(
            _zero(F.sum(grown("cpu_usec") / 1000.0)).alias("cpu_ms"),
            _zero(F.sum(integral("anon_bytes"))).alias("ram_mib_s"),
            _zero(F.sum(integral("swap_bytes"))).alias("swap_mib_s"),
            _zero(F.sum(grown("mem_psi_full_us") / 1000.0)).alias("psi_mem_ms"),
            _zero(F.sum(grown("pgmajfault"))).alias("majfaults"),
            _zero(F.max(peak) / F.lit(MIB)).alias("peak_anon_mib"),
            _zero(F.sum(gap_s * F.col("share"))).alias("covered_s"),
            F.bool_or("restart").alias("restarted"),
        )
    )


def flag_exits(
    windows: DataFrame, exits: DataFrame, series: Sequence[str] = ("service",),
    seconds: int = c.WINDOW_SECONDS,
) -> DataFrame:
    """Windows in which the service's process exited count as restarted. An exit without a
    window adds none."""
    keys = [*series, "window_epoch"]
    hit = exits.select(*series, epoch_window(F.col("ts"), seconds).alias("window_epoch")).distinct()
    flagged = windows.join(hit.withColumn("_exit", F.lit(True)), keys, "left")
    return flagged.withColumn(
        "restarted", F.col("restarted") | F.coalesce(F.col("_exit"), F.lit(False))
    ).drop("_exit")


def host_windows(
    samples: DataFrame,
    series: Sequence[str] = (),
    seconds: int = c.WINDOW_SECONDS,
) -> DataFrame:
    """Host health per window: steal share, stalls, lowest memory, CPU of all processes.

    Gaps are not limited. CPU is NULL as soon as one pair of the window lacks it."""
    series = list(series)
    ties = [name for name in samples.columns if name not in (*series, "ts")]
    pairs = _timed(consecutive_pairs(samples, series, tie_break=ties)).where("gap_us > 0")
    parts = pairs.withColumn(
        "window_us", F.explode(overlapped_windows(F.col("start_us"), F.col("end_us"), seconds))
    )
    parts = parts.withColumn(
        "share", window_share(F.col("window_us"), F.col("start_us"), F.col("end_us"), seconds)
    )

    def grown(name: str) -> Column:
        return counter_delta(F.col(f"a.{name}"), F.col(f"b.{name}")) * F.col("share")

    def total(name: str) -> Column:
        return F.sum(_zero(grown(name)))

    cpu = grown("cpu_usec") / 1000.0
    available = F.least(F.col("a.mem_available_bytes"), F.col("b.mem_available_bytes"))
    windows = parts.groupBy(
        *series, (F.col("window_us") / SECOND).cast("bigint").alias("window_epoch")
    ).agg(
        total("cpu_steal_ticks").alias("steal_ticks"),
        total("cpu_total_ticks").alias("total_ticks"),
        (total("mem_psi_full_us") / 1000.0).alias("psi_mem_ms"),
        (total("cpu_psi_some_us") / 1000.0).alias("psi_cpu_ms"),
        (total("io_psi_full_us") / 1000.0).alias("psi_io_ms"),
        (F.min(available) / F.lit(MIB)).alias("min_available_mib"),
        F.when(F.count_if(cpu.isNull()) == 0, F.sum(cpu)).alias("cpu_ms"),
    )
    steal = F.lit(100.0) * F.col("steal_ticks") / F.nullif(F.col("total_ticks"), F.lit(0.0))
    return windows.withColumn("steal_pct", steal)


def catalog_windows(
    samples: DataFrame,
    postgres_windows: DataFrame,
    catalogs: Sequence[str] = tuple(c.CATALOG_BRANCHES),
    max_gap_seconds: float = c.MAX_SAMPLE_GAP_SECONDS,
    seconds: int = c.WINDOW_SECONDS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Each catalog database's share of the active time of every database per window, and
    the database server's CPU times that share (NULL without a window of the server).

    `postgres_windows` has `window_epoch` and `cpu_ms` (and `keys`, such as the day). Every
    window with any activity has a row for each catalog, zeros included."""
    keys = [*keys, "window_epoch"]
    pairs = _timed(consecutive_pairs(samples, [*keys[:-1], "db"], tie_break=["active_time_ms"]))
    delta = F.col("b.active_time_ms") - F.col("a.active_time_ms")
    pairs = pairs.withColumn("delta", delta).where(_usable(max_gap_seconds) & (F.col("delta") >= 0))
    parts = pairs.withColumn(
        "window_us", F.explode(overlapped_windows(F.col("start_us"), F.col("end_us"), seconds))
    )
    active = F.col("delta") * window_share(
        F.col("window_us"), F.col("start_us"), F.col("end_us"), seconds
    )
    named = {f"_active_{n}": db for n, db in enumerate(catalogs)}
    windows = parts.withColumn("window_epoch", (F.col("window_us") / SECOND).cast("bigint"))
    windows = windows.groupBy(*keys).agg(
        F.sum(active).alias("_total"),
        *[_zero(F.sum(F.when(F.col("db") == db, active))).alias(n) for n, db in named.items()],
    )
    each = [
        F.struct(F.lit(db).alias("db"), F.col(n).alias("active_ms")) for n, db in named.items()
    ]
    shares = windows.select(*keys, "_total", F.inline(F.array(*each)))
    share = F.when(F.col("_total") > 0, F.col("active_ms") / F.col("_total")).otherwise(0.0)
    cpu = postgres_windows.select(*keys, F.col("cpu_ms").alias("_cpu"))
    return (
        shares.withColumn("active_share", share)
        .join(cpu, keys, "left")
        .select(
            *keys,
            "db",
            "active_ms",
            "active_share",
            (F.col("_cpu") * F.col("active_share")).alias("cpu_ms_estimate"),
        )
    )


def neighbour_cores(
    hosts: DataFrame,
    sampled: DataFrame,
    seconds: int = c.WINDOW_SECONDS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Host windows with the cores used by everything outside the sampled services.

    `sampled` has `window_epoch` and `cpu_ms` of every service window; NULL without the
    host's CPU."""
    window = [*keys, "window_epoch"]
    inside = sampled.groupBy(*window).agg(F.sum("cpu_ms").alias("_sampled"))
    outside = F.greatest(F.lit(0.0), F.col("cpu_ms") - _zero(F.col("_sampled")))
    # `greatest` skips NULL: without the host's CPU there is no figure, not zero
    known = F.col("cpu_ms").isNotNull() & (F.col("total_ticks") != 0)
    cores = F.when(known, outside / F.lit(seconds * 1000.0))
    return (
        hosts.join(inside, window, "left")
        .withColumn("neighbour_cpu_cores", cores)
        .drop("_sampled")
    )


def host_contaminated(
    has_host: Column,
    steal_pct: Column,
    neighbours: Column,
    max_steal: float = c.HOST_STEAL_PCT_MAX,
    max_cores: float = c.NEIGHBOUR_CORES_MAX,
) -> Column:
    """No host data, too much steal, or neighbours that use too much CPU."""
    return (
        ~has_host | (_zero(steal_pct) > F.lit(max_steal)) | (_zero(neighbours) > F.lit(max_cores))
    )


def interval_usage(
    samples: DataFrame,
    phases: DataFrame,
    keys: Sequence[str],
    max_gap_seconds: float = c.MAX_SAMPLE_GAP_SECONDS,
    chunk_seconds: int = 3600,
) -> DataFrame:
    """Usage of each service over each phase [start_ts, end_ts], pairs counted by overlap.

    `phases` has `keys`, `start_ts` and `end_ts`. Pairs meet phases by the hours both
    touch, so the range join is an equi join; a pair is counted in the first hour shared."""
    hour = F.lit(chunk_seconds * SECOND)
    pairs = _timed(consecutive_pairs(samples, ["service"], tie_break=("container_id",)))
    restart = _restart()
    pairs = pairs.withColumn("restart", restart).where(restart | _usable(max_gap_seconds))
    # A restart counts at its later sample only, whatever the gap before it
    lower = F.when(F.col("restart"), F.col("end_us")).otherwise(F.col("start_us"))
    pairs = pairs.withColumn("from_us", lower)
    step = F.lit(chunk_seconds * SECOND).cast("bigint")

    def floor_hour(us: Column) -> Column:
        return us - F.pmod(us, hour)

    pairs = pairs.withColumn(
        "slot", F.explode(F.sequence(floor_hour(F.col("from_us")), floor_hour(F.col("end_us")), step))
    )
    spans = phases.select(
        *keys, micros(F.col("start_ts")).alias("p_start"), micros(F.col("end_ts")).alias("p_end")
    ).where("p_end >= p_start")
    spans = spans.withColumn(
        "slot", F.explode(F.sequence(floor_hour(F.col("p_start")), floor_hour(F.col("p_end")), step))
    )
    met = pairs.join(spans, "slot").where(
        F.col("slot") == floor_hour(F.greatest(F.col("from_us"), F.col("p_start")))
    )
    overlap = F.least(F.col("end_us"), F.col("p_end")) - F.greatest(F.col("start_us"), F.col("p_start"))
    met = met.withColumn("overlap_us", overlap)
    inside = (F.col("end_us") >= F.col("p_start")) & (F.col("end_us") <= F.col("p_end"))
    met = met.where((F.col("restart") & inside) | (~F.col("restart") & (F.col("overlap_us") > 0)))
    counted = ~F.col("restart")
    share = F.col("overlap_us") / F.col("gap_us").cast("double")
    overlap_s = F.col("overlap_us") / F.lit(float(SECOND))

    def grown(name: str) -> Column:
        return F.when(counted, counter_delta(F.col(f"a.{name}"), F.col(f"b.{name}")) * share)

    def integral(name: str) -> Column:
        mean = trapezoid(F.col(f"a.{name}"), F.col(f"b.{name}"))
        return F.when(counted, mean * overlap_s / F.lit(MIB))

    both = F.col("a.anon_bytes").isNotNull() & F.col("b.anon_bytes").isNotNull()
    peak = F.when(counted & both, F.greatest(F.col("a.anon_bytes"), F.col("b.anon_bytes")))
    return met.groupBy(*keys, "service").agg(
        _zero(F.sum(grown("cpu_usec") / 1000.0)).alias("cpu_ms"),
        _zero(F.sum(integral("anon_bytes"))).alias("ram_mib_s"),
        _zero(F.sum(integral("swap_bytes"))).alias("swap_mib_s"),
        _zero(F.max(peak) / F.lit(MIB)).alias("peak_anon_mib"),
        _zero(F.sum(grown("pgmajfault"))).alias("majfaults"),
        _zero(F.sum(F.when(counted, overlap_s))).alias("covered_s"),
        F.bool_or("restart").alias("restarted"),
    )


def phase_usage(usage: DataFrame, layers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Usage of the services summed per layer: coverage is the longest one, the peak the
    sum of the services' peaks. `layers` maps `service` to `layer`."""
    by_layer = usage.join(layers.select("service", "layer"), "service")
    summed = ("cpu_ms", "ram_mib_s", "swap_mib_s", "peak_anon_mib", "majfaults")
    return by_layer.groupBy(*keys, "layer").agg(
        *[F.sum(name).alias(name) for name in summed],
        F.max("covered_s").alias("covered_s"),
        F.bool_or("restarted").alias("restarted"),
    )


USAGE_FIGURES = ("cpu_ms", "ram_mib_s", "swap_mib_s", "peak_anon_mib", "majfaults", "covered_s")


def usage_by_layer(by_layer: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row per phase with a map layer -> figures (a handful of layers)."""
    figures = F.struct(*USAGE_FIGURES, "restarted")
    entry = F.struct(F.col("layer"), figures)
    return by_layer.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def resources_series(samples: DataFrame) -> DataFrame:
    """Per minute, branch and layer: CPU cores and mean memory, services added up.

    A whole pair counts in the minute of its later sample; a pair across two containers,
    with a missing counter or one that went down, is left out."""
    pairs = _timed(consecutive_pairs(samples, ["service"], tie_break=("container_id",)))
    grown = F.col("b.cpu_usec") - F.col("a.cpu_usec")
    usable = pairs.where(~_restart() & (F.col("gap_us") > 0) & (grown >= 0))
    per_service = usable.groupBy(
        F.date_trunc("MINUTE", F.col("b.ts")).alias("minute"),
        F.col("b.branch").alias("branch"),
        F.col("b.layer").alias("layer"),
        "service",
    ).agg(
        (F.sum(grown) / F.sum("gap_us").cast("double")).alias("cores"),
        F.avg(F.col("b.anon_bytes") / F.lit(MIB)).alias("mib"),
    )
    return per_service.groupBy("minute", "branch", "layer").agg(
        F.round(F.sum("cores"), 3).alias("cpu_cores"),
        F.round(_zero(F.sum("mib")), 1).alias("anon_mib"),
    )


def live_rate(readings: DataFrame, series: Sequence[str] = (), chunk_seconds: int = 3600) -> DataFrame:
    """Messages per second between a reading (`ts`, `position`) and the one before; NULL
    after a reset or when no time passed."""
    pairs = _timed(consecutive_pairs(readings, series, chunk_seconds=chunk_seconds, tie_break=("position",)))
    moved = F.col("b.position") - F.col("a.position")
    seconds = F.col("gap_us") / F.lit(float(SECOND))
    return pairs.select(
        *series,
        F.col("b.ts").alias("ts"),
        F.when((F.col("gap_us") > 0) & (moved >= 0), moved / seconds).alias("rate"),
    )


def sampled_services(samples: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row per service with its branch and layer."""
    return samples.groupBy("service").agg(*[F.max(v).alias(k) for k, v in columns.items()])
