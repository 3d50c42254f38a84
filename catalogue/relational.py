"""Joins, aggregations, windows, top-k and set operations."""

from pyspark.sql import functions as F

from catalogue.registry import Tables, query
from catalogue.shape import CTES
from tidemark.functions.times import epoch_window, latency_ms
from tidemark.operators import aggregates, joins, messages, percentiles, ranking, ratios, sets
from tidemark.operators.series import consecutive_pairs

# Offset bounds of a day in each partition: the middle half of what it holds
BOUNDS = """SELECT kafka_partition, max(kafka_offset) // 4 AS start_offset,
    max(kafka_offset) // 4 * 3 AS end_offset FROM bronze GROUP BY 1"""
CTES["bounds"] = ("bronze", BOUNDS)


def bounds(t: Tables):
    quarter = F.floor(F.max("kafka_offset") / 4)
    return t.bronze.groupBy("kafka_partition").agg(
        quarter.alias("start_offset"), (quarter * 3).alias("end_offset")
    )


# --- Joins ---


@query(
    "join_inner",
    """SELECT c_custkey, o_orderkey, l_linenumber::BIGINT AS l_linenumber,
        n_name, l_extendedprice * (1 - l_discount) AS revenue
    FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    JOIN nation ON n_nationkey = c_nationkey""",
    doubles="revenue",
)
def join_inner(t: Tables):
    orders = t.orders.select(F.col("o_orderkey"), F.col("o_custkey").alias("c_custkey"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = joins.join_inner(t.customer.select("c_custkey", "c_nationkey"), nations, ["c_nationkey"])
    ordered = joins.join_inner(orders, customers, ["c_custkey"])
    return joins.join_inner(lines, ordered, ["o_orderkey"]).drop("c_nationkey")


@query(
    "join_left_using",
    """SELECT hour, coalesce(a, 0) AS clicks, coalesce(b, 0) AS views, coalesce(s, 0) AS spent,
        coalesce(e, 0) AS errors
    FROM (SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS hour, count(*) AS a FROM events
        WHERE event_type = 'click' GROUP BY 1) USING (hour)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS hour, count(*) AS b FROM events
        WHERE event_type = 'view' GROUP BY 1) USING (hour)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS hour, sum(value) AS s FROM events
        WHERE event_type = 'purchase' GROUP BY 1) USING (hour)
    LEFT JOIN (SELECT date_trunc('hour', ts) AS hour, count(*) AS e FROM events
        WHERE event_type = 'error' GROUP BY 1) USING (hour)""",
    doubles="spent",
)
def join_left_using(t: Tables):
    events = t.events.withColumn("hour", F.date_trunc("HOUR", "ts"))

    def of(kind, figure):
        return events.where(F.col("event_type") == kind).groupBy("hour").agg(figure)

    zero = F.lit(0)
    parts = [
        of("click", F.count(F.lit(1)).alias("clicks")),
        of("view", F.count(F.lit(1)).alias("views")),
        of("purchase", F.sum("value").alias("spent")),
        of("error", F.count(F.lit(1)).alias("errors")),
    ]
    joined = joins.join_left_all(events.select("hour").distinct(), parts, ["hour"])
    figures = ("clicks", "views", "spent", "errors")
    return joined.select("hour", *[F.coalesce(f, zero).alias(f) for f in figures])


@query(
    "join_full_outer",
    """SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS ordered, coalesce(b.n, 0) AS returned
    FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) AS a
    FULL OUTER JOIN (SELECT l_suppkey AS k, count(*) AS n FROM lineitem
        WHERE l_returnflag = 'R' GROUP BY 1) AS b ON a.k = b.k""",
)
def join_full_outer(t: Tables):
    ordered = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("a"))
    returned = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_suppkey").alias("k"))
    both = joins.compare_full_outer(
        ordered, returned.agg(F.count(F.lit(1)).alias("b")), ["k"], "a", "b"
    )
    zero = F.lit(0)
    return both.select(
        "k", F.coalesce("a", zero).alias("ordered"), F.coalesce("b", zero).alias("returned")
    )


@query(
    "join_left_anti",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def join_left_anti(t: Tables):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.join_not_exists(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@query(
    "join_not_in",
    """SELECT p_partkey, p_brand FROM part WHERE (p_partkey, CASE WHEN p_size % 7 != 0 THEN p_size END)
        NOT IN (SELECT l_partkey, CASE WHEN l_linenumber % 5 != 0 THEN l_linenumber END
                FROM lineitem WHERE l_quantity < 6)""",
)
def join_not_in(t: Tables):
    """Keys of two columns with NULLs on both sides."""
    parts = t.part.select(
        "p_partkey", "p_brand", F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("size")
    )
    lines = t.lineitem.where("l_quantity < 6").select(
        "l_partkey", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_linenumber")).alias("line")
    )
    kept = joins.join_not_in(parts, lines, ["p_partkey", "size"], ["l_partkey", "line"])
    return kept.drop("size")


@query(
    "join_exists",
    """SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (
        SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_discount > 0.09)""",
)
def join_exists(t: Tables):
    lines = t.lineitem.where("l_discount > 0.09").select(F.col("l_suppkey").alias("s_suppkey"))
    return joins.join_exists(t.supplier.select("s_suppkey", "s_name"), lines, ["s_suppkey"])


@query(
    "join_cross_values",
    """SELECT user_id, problem, CASE problem WHEN 'errors' THEN errors ELSE clicks END AS events
    FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors,
            count(*) FILTER (WHERE event_type = 'click') AS clicks FROM events GROUP BY 1)
    CROSS JOIN (VALUES ('errors'), ('clicks')) AS v (problem)""",
)
def join_cross_values(t: Tables):
    kinds = {"errors": F.col("event_type") == "error", "clicks": F.col("event_type") == "click"}
    counts = aggregates.count_where(t.events, ["user_id"], kinds)
    values = {"errors": F.col("errors"), "clicks": F.col("clicks")}
    unpivoted = joins.join_cross_values(counts, values, "problem", "events")
    return unpivoted.select("user_id", "problem", "events")


@query(
    "join_offset_range",
    """SELECT seq, b.kafka_partition::BIGINT AS kafka_partition, kafka_offset, start_offset
    FROM bronze AS b JOIN bounds AS r ON r.kafka_partition = b.kafka_partition
        AND kafka_offset >= start_offset AND kafka_offset < end_offset""",
    "bounds",
)
def join_offset_range(t: Tables):
    rows = t.bronze.select("seq", "kafka_partition", "kafka_offset")
    return joins.join_offset_range(rows, bounds(t)).drop("end_offset")


@query(
    "join_correlated_max",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM orders AS o WHERE o_orderdate = (
        SELECT max(o_orderdate) FROM orders AS i WHERE i.o_custkey = o.o_custkey)""",
)
def join_correlated_max(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return joins.join_correlated_max(orders, ["o_custkey"], "o_orderdate")


@query(
    "join_send_times",
    """SELECT a.kafka_partition::BIGINT AS kafka_partition, a.kafka_offset,
        epoch_us(a.processed_at) // 1000 - epoch_us(s.event_time) // 1000 AS wait_ms
    FROM (SELECT kafka_partition, kafka_offset, min(processed_at) AS processed_at
          FROM bronze GROUP BY 1, 2) AS a
    JOIN shaped AS s USING (kafka_partition, kafka_offset)""",
    "bronze",
)
def join_send_times(t: Tables):
    keys = ["kafka_partition", "kafka_offset"]
    first = aggregates.first_copy(t.bronze).select(*keys, "processed_at")
    sent = aggregates.first_copy(t.bronze).select(*keys, F.col("event_time").alias("sent_at"))
    wait = latency_ms(F.col("sent_at"), F.col("processed_at"))
    return joins.join_inner(first, sent, keys).select(*keys, wait.alias("wait_ms"))


# --- Aggregations ---


@query(
    "agg_count_filter",
    """SELECT l_shipdate, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
        count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
        coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), -1) AS open_quantity
    FROM lineitem GROUP BY 1""",
    doubles="open_quantity",
)
def agg_count_filter(t: Tables):
    keys = ["l_shipdate"]
    counts = {"returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") > 0.05}
    open_lines = F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))
    return t.lineitem.groupBy(*keys).agg(
        *[F.count_if(rule).alias(name) for name, rule in counts.items()],
        F.coalesce(F.sum(open_lines), F.lit(-1.0)).alias("open_quantity"),
    )


@query(
    "agg_count_distinct",
    "SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1",
)
def agg_count_distinct(t: Tables):
    return aggregates.distinct_count(t.lineitem, ["l_partkey"], "l_suppkey", "suppliers")


@query(
    "agg_grouping_sets",
    """SELECT date_trunc('hour', ts) AS hour, coalesce(event_type, 'all') AS event_type,
        count(DISTINCT user_id) AS users
    FROM events GROUP BY GROUPING SETS ((date_trunc('hour', ts), event_type), (date_trunc('hour', ts)))""",
)
def agg_grouping_sets(t: Tables):
    events = t.events.withColumn("hour", F.date_trunc("HOUR", "ts"))
    return aggregates.distinct_with_total(events, "hour", "event_type", "user_id", "users")


@query(
    "agg_bool_or",
    """SELECT o_custkey, bool_or(o_totalprice > 400000) AS has_big,
        bool_or(o_orderpriority = '1-URGENT') AS has_urgent FROM orders GROUP BY 1""",
)
def agg_bool_or(t: Tables):
    flags = {
        "has_big": F.col("o_totalprice") > 400000,
        "has_urgent": F.col("o_orderpriority") == "1-URGENT",
    }
    return aggregates.any_where(t.orders, ["o_custkey"], flags)


@query(
    "agg_count_if",
    """SELECT source, CAST(count_if(n_chars > 1000) AS BIGINT) AS long_docs,
        CAST(count_if(lang = 'en') AS BIGINT) AS english FROM documents GROUP BY 1""",
)
def agg_count_if(t: Tables):
    counts = {"long_docs": F.col("n_chars") > 1000, "english": F.col("lang") == "en"}
    return aggregates.count_where(t.documents, ["source"], counts)


@query("agg_max_by", "SELECT user_id, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1")
def agg_max_by(t: Tables):
    return aggregates.latest_value(t.events, ["user_id"], "event_id", "ts")


@query(
    "agg_first_copy",
    """SELECT kafka_partition::BIGINT AS kafka_partition, kafka_offset,
        min(processed_at) AS processed_at, min(event_time) AS event_time,
        any_value(collection) AS collection FROM bronze GROUP BY 1, 2""",
    "bronze",
)
def agg_first_copy(t: Tables):
    return aggregates.first_copy(t.bronze)


CTES["latencies"] = (
    "bronze",
    """SELECT kafka_partition, kafka_offset, CAST(floor(epoch(processed_at)) AS BIGINT) // 300 * 300
        AS window_epoch, collection, epoch_us(processed_at) // 1000 - epoch_us(event_time) // 1000 AS latency_ms
    FROM (SELECT kafka_partition, kafka_offset, min(processed_at) AS processed_at,
            min(event_time) AS event_time, any_value(collection) AS collection
          FROM bronze GROUP BY 1, 2)""",
)


@query(
    "hist_percentiles",
    """SELECT day, coalesce(collection, 'all') AS collection, count(*) AS messages,
        quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95
    FROM (SELECT *, window_epoch // 86400 AS day FROM latencies)
    GROUP BY GROUPING SETS ((day, collection), (day))""",
    "latencies",
    doubles="p50 p95",
)
def hist_percentiles(t: Tables):
    rows = messages.message_latencies(t.bronze).withColumn(
        "day", F.expr("window_epoch div 86400")
    )
    found = percentiles.hist_percentiles(
        rows, ["day"], "collection", "latency_ms", {"p50": 0.5, "p95": 0.95}
    )
    return found.withColumn("collection", F.coalesce("collection", F.lit("all")))


@query(
    "pct_within_group",
    """SELECT day, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.95) AS p95
    FROM (SELECT date_trunc('day', ts) AS day, CAST(floor(epoch(ts)) AS BIGINT) // 300 AS w,
            sum(value) AS v FROM events GROUP BY 1, 2) GROUP BY 1""",
    doubles="p50 p95",
)
def pct_within_group(t: Tables):
    """Percentiles over the figures of five-minute windows."""
    windows = t.events.groupBy(
        F.date_trunc("DAY", "ts").alias("day"), epoch_window(F.col("ts")).alias("w")
    ).agg(F.sum("value").alias("v"))
    return windows.groupBy("day").agg(
        percentiles.percentile_within_group("v", 0.5).alias("p50"),
        percentiles.percentile_within_group("v", 0.95).alias("p95"),
    )


@query(
    "ratio_of_sums",
    """SELECT l_suppkey, sum(l_discount * l_extendedprice) / nullif(sum(l_extendedprice), 0) AS discount
    FROM lineitem GROUP BY 1""",
    doubles="discount",
)
def ratio_of_sums(t: Tables):
    ratio = aggregates.ratio_of_sums("l_discount", "l_extendedprice")
    return t.lineitem.groupBy("l_suppkey").agg(ratio.alias("discount"))


@query(
    "agg_having",
    """SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def agg_having(t: Tables):
    return aggregates.having_more_than(t.lineitem, ["l_partkey", "l_suppkey"])


@query("agg_bounds", "SELECT min(ts) AS lower, max(ts) AS upper FROM events")
def agg_bounds(t: Tables):
    return aggregates.bounds(t.events, "ts")


CTES["cost_points"] = (
    "",
    """SELECT CASE WHEN user_id % 2 = 0 THEN 'duckdb' ELSE 'spark' END AS branch,
        count(*) / 24.0 AS rate, sum(value) / nullif(count(*), 0) AS cost
    FROM events GROUP BY branch, date_trunc('day', ts)""",
)


def cost_points(t: Tables):
    branch = F.when(F.col("user_id") % 2 == 0, "duckdb").otherwise("spark")
    runs = t.events.groupBy(branch.alias("branch"), F.date_trunc("DAY", "ts").alias("day"))
    n = F.count(F.lit(1))
    return runs.agg((n / 24.0).alias("rate"), (F.sum("value") / n).alias("cost")).drop("day")


@query(
    "regr_fit",
    """SELECT branch, regr_slope(cost, 1 / rate) AS fixed_ms_per_s,
        regr_intercept(cost, 1 / rate) AS marginal_ms_per_message,
        regr_r2(cost, 1 / rate) AS r2, count(*) AS runs, min(rate) AS min_rate,
        max(rate) AS max_rate
    FROM cost_points GROUP BY 1 HAVING count(DISTINCT round(rate, 6)) > 1""",
    "cost_points",
    doubles="fixed_ms_per_s marginal_ms_per_message r2 min_rate max_rate",
)
def regr_fit(t: Tables):
    return ratios.cost_fit(cost_points(t))


# --- Windows ---


@query(
    "win_row_number",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank
    FROM lineitem QUALIFY rank <= 3""",
)
def win_row_number(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_linenumber")]
    return ranking.topk_per_group(lines, ["l_orderkey"], order, 3).drop("l_extendedprice")


@query(
    "win_running_sum",
    """SELECT commit_id, added_rows, CAST(sum(added_rows) OVER (ORDER BY commit_id
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
    FROM (SELECT commit_id, count(*) AS added_rows FROM bronze GROUP BY 1)""",
    "bronze",
)
def win_running_sum(t: Tables):
    commits = t.bronze.groupBy("commit_id").agg(F.count(F.lit(1)).alias("added_rows"))
    return aggregates.running_sum(commits, "added_rows", "commit_id", "total")


@query(
    "win_total",
    """SELECT o_orderkey, o_custkey, sum(o_totalprice) OVER (PARTITION BY o_custkey) AS spent
    FROM orders""",
    doubles="spent",
)
def win_total(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return aggregates.with_group_total(orders, ["o_custkey"], "o_totalprice", "spent").drop(
        "o_totalprice"
    )


@query(
    "win_min_over",
    """SELECT commit_id, events, commit_id = min(commit_id) OVER () AS is_first
    FROM (SELECT commit_id, count(*) AS events FROM bronze GROUP BY 1)""",
    "bronze",
)
def win_min_over(t: Tables):
    commits = t.bronze.groupBy("commit_id").agg(F.count(F.lit(1)).alias("events"))
    return ranking.first_flag(commits, "commit_id")


@query(
    "win_islands",
    """WITH hours AS (SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events
        WHERE event_type = 'error')
    SELECT min(hour) AS range_start, max(hour) + INTERVAL 1 HOUR AS range_end
    FROM (SELECT hour, hour - to_hours(row_number() OVER (ORDER BY hour)) AS island FROM hours)
    GROUP BY island""",
)
def win_islands(t: Tables):
    errors = t.events.where("event_type = 'error'")
    return ranking.hour_islands(errors.select(F.date_trunc("HOUR", "ts").alias("hour")))


@query(
    "win_lag_pairs",
    """SELECT event_type, event_id, ts, lag(event_id) OVER w AS previous_id, lag(ts) OVER w AS previous_ts
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
    QUALIFY previous_id IS NOT NULL""",
)
def win_lag_pairs(t: Tables):
    rows = t.events.select("event_type", "event_id", "ts")
    pairs = consecutive_pairs(rows, ["event_type"], tie_break=("event_id",))
    return pairs.select(
        "event_type",
        F.col("b.event_id").alias("event_id"),
        F.col("b.ts").alias("ts"),
        F.col("a.event_id").alias("previous_id"),
        F.col("a.ts").alias("previous_ts"),
    )


# --- Sorts, limits, sets ---


@query(
    "latest_one",
    "SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1",
)
def latest_one(t: Tables):
    rows = t.events.select("event_id", "ts", "user_id")
    return ranking.latest_one(rows, F.desc("ts"), F.desc("event_id"))


@query(
    "oldest_k_hours",
    """SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events WHERE event_type = 'error'
    ORDER BY 1 LIMIT 6""",
)
def oldest_k_hours(t: Tables):
    hours = t.events.where("event_type = 'error'").select(
        F.date_trunc("HOUR", "ts").alias("hour")
    )
    return ranking.oldest_hours(hours, 6)


@query(
    "latest_per_key",
    """SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, value
    FROM events ORDER BY user_id, event_type, ts DESC, event_id DESC""",
    doubles="value",
)
def latest_per_key(t: Tables):
    order = [F.desc("ts"), F.desc("event_id")]
    rows = ranking.latest_per_key(t.events, ["user_id", "event_type"], order)
    return rows.select("user_id", "event_type", "event_id", "value")


@query(
    "count_up_to",
    """SELECT 'below' AS cap, count(*) AS n_rows FROM lineitem WHERE l_quantity > 10
    UNION ALL SELECT 'reached', (SELECT count(*) // 2 FROM lineitem)""",
)
def count_up_to(t: Tables):
    """A cap that is not reached, and one of half the table's rows, which is."""
    half = t.lineitem.count() // 2
    wide = ranking.count_up_to(t.lineitem.where("l_quantity > 10"), 2 * half + 1)
    reached = ranking.count_up_to(t.lineitem, half)
    return wide.select(F.lit("below").alias("cap"), "*").unionByName(reached.select(F.lit("reached").alias("cap"), "*"))


@query(
    "set_union_all",
    """SELECT k, kind, count(*) AS n FROM (SELECT o_custkey AS k, 'order' AS kind FROM orders
        UNION ALL SELECT l_suppkey, 'line' FROM lineitem
        UNION ALL SELECT c_custkey, 'customer' FROM customer) GROUP BY 1, 2""",
)
def set_union_all(t: Tables):
    def of(rows, key, kind):
        return rows.select(F.col(key).alias("k"), F.lit(kind).alias("kind"))

    stacked = sets.union_all(
        [
            of(t.orders, "o_custkey", "order"),
            of(t.lineitem, "l_suppkey", "line"),
            of(t.customer, "c_custkey", "customer"),
        ]
    )
    return stacked.groupBy("k", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "set_union",
    """SELECT date_trunc('hour', ts) AS hour FROM events WHERE event_type = 'click'
    UNION SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'view'
    UNION SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error'""",
)
def set_union(t: Tables):
    hours = [
        t.events.where(F.col("event_type") == kind).select(F.date_trunc("HOUR", "ts").alias("hour"))
        for kind in ("click", "view", "error")
    ]
    return sets.union_distinct(hours)


@query(
    "set_except_all",
    """SELECT l_partkey AS partkey, l_suppkey AS suppkey FROM lineitem WHERE l_returnflag != 'R'
    EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'""",
)
def set_except_all(t: Tables):
    pairs = t.lineitem.select(
        F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"), "l_returnflag"
    )
    returned = F.col("l_returnflag") == "R"
    return sets.set_except_all(
        pairs.where(~returned).drop("l_returnflag"), pairs.where(returned).drop("l_returnflag")
    )
