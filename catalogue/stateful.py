"""Queries that run a whole protocol: commits, a replay, late rows, passes, maintenance.

Each writes to a fresh folder below the cluster's shared one, so runs never meet."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogue.medallion import DUCK_POSTS, flat, silver_tables
from catalogue.registry import Tables, query
from catalogue.shape import CTES
from tidemark import contract as c
from tidemark.operators import maintenance
from tidemark.operators.dedup import dedup_batch
from tidemark.operators.filters import in_hours
from tidemark.operators.parity import read_dump
from tidemark.plans import incremental as inc
from tidemark.plans.gold import GOLD, GOLD_SCHEMAS
from tidemark.plans.silver import SILVER, SILVER_SCHEMAS
from tidemark.session import scratch_path
from tidemark.sources import message_log, tables, topics
from tidemark.sources.envelopes import bronze_parse as parse
from tidemark.sources.envelopes import decode_messages
from tidemark.streaming.bronze import BronzeWriter, start_bronze

BRONZE = ", ".join(c.BRONZE_COLUMNS)
# The record's one escaped character, as the SQL side spells it
DUCK_BRONZE = BRONZE.replace("kafka_partition", "kafka_partition::BIGINT AS kafka_partition")
COMMITS = 8


def spelled(rows: DataFrame, *more: str) -> DataFrame:
    """Every Bronze column, with the record spelled as the SQL side does."""
    return rows.withColumn("record", plain_record()).select(*c.BRONZE_COLUMNS, *more)


def bronze_table(t: Tables, name: str) -> tables.CommitTable:
    path = scratch_path(t.spark, name)
    return tables.CommitTable(t.spark, path, c.BRONZE_SCHEMA, cluster_by=["collection"])


def commits(t: Tables):
    """The Bronze rows of each commit, in order, laid out by commit once."""
    path = scratch_path(t.spark, "commits")
    t.bronze.write.partitionBy("commit_id").parquet(path)
    rows = t.spark.read.parquet(path)
    for commit in range(1, COMMITS + 1):
        yield commit, rows.where(F.col("commit_id") == commit)


def stored(t: Tables, name: str) -> tables.CommitTable:
    """A Bronze table with every commit, the third written twice as after a crash."""
    table = bronze_table(t, name)
    for commit, rows in commits(t):
        table.append(rows, commit)
        if commit == 3:
            table.append(rows, commit)
    return table


# --- Sources and sinks ---


@query(
    "bronze_parse",
    f"SELECT {DUCK_BRONZE} FROM messages WHERE usable",
    "messages",
)
def bronze_parse(t: Tables):
    return spelled(parse(t.messages, F.col("timestamp")))


# A message's bytes as the SQL side spells them
DUCK_MESSAGE = """'{"$type":"' || CASE WHEN seq % 41 = 0 THEN 'info' ELSE 'message' END || '","payload":{'
    || coalesce('"record":' || record || ',', '') || '"seq":' || seq || ',"did":"' || did
    || '","collection":"' || collection || '","operation":"' || operation || '","rkey":"' || rkey
    || '","rev":"' || rev || '"' || coalesce(',"cid":"' || cid || '"', '') || ',"time":"'
    || CASE WHEN seq % 43 = 0 THEN 'not a time' ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END || '"}}'"""


@query(
    "kafka_source",
    f"""SELECT kafka_partition::BIGINT AS partition, kafka_offset AS "offset", processed_at AS "timestamp",
        {DUCK_MESSAGE} AS value, true AS within_cap, true AS in_turn
    FROM once, (SELECT max(kafka_offset) AS top, max(kafka_offset) // 8 + 1 AS size FROM once)
    WHERE CASE kafka_partition WHEN 0 THEN kafka_offset >= top // 2 WHEN 1 THEN kafka_offset >= 2 * size ELSE true END""",
    "once",
)
def kafka_source(t: Tables):
    """A topic streamed from a start of each partition, one of them expired, so many messages a
    batch at the most; the stream is stopped where the log ends, and started again with the messages
    written since. Every message, and whether its batch kept to the cap and to the order."""
    folder = scratch_path(t.spark, "topic")
    log, checkpoint = f"{folder}/log", f"{folder}/checkpoint"
    messages = t.messages.groupBy("partition", "offset").agg(
        F.min_by("value", "timestamp").alias("value"), F.min("timestamp").alias("timestamp")
    )
    top, n = messages.agg(F.max("offset"), F.count(F.lit(1))).first()
    size, cap = top // 8 + 1, n // 5
    early = F.col("offset") < top * 3 // 5
    for number, part in enumerate((early, ~early)):
        message_log.write_log(messages.where(part), log, size)
        if number == 0:
            message_log.drop_segments(log, {1: 2 * size})
        stream = message_log.read_message_log(t.spark, log, checkpoint, {0: top // 2, 1: 7}, max_offsets=cap)
        query = stream.writeStream.foreachBatch(
            lambda rows, batch: rows.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")
        )
        running = query.option("checkpointLocation", checkpoint).start()
        try:
            running.processAllAvailable()
        finally:
            running.stop()
    out = t.spark.read.parquet(f"{folder}/out")
    sizes = out.groupBy("batch").agg((F.count(F.lit(1)) <= cap).alias("within_cap"))
    # Offsets of a partition only grow from batch to batch
    ends = out.groupBy("partition", "batch").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    before = F.lag("high").over(Window.partitionBy("partition").orderBy("batch"))
    turns = ends.select("partition", "batch", (F.coalesce(before, F.lit(-1)) < F.col("low")).alias("in_turn"))
    spelled_value = F.replace(F.col("value").cast("string"), F.lit("⛅"), F.lit("\\u26c5"))
    return out.join(sizes, "batch").join(turns, ["partition", "batch"]).select(
        "partition", "offset", "timestamp", spelled_value.alias("value"), "within_cap", "in_turn"
    )


@query(
    "bronze_append",
    f"SELECT {DUCK_BRONZE} FROM messages WHERE usable",
    "messages",
)
def bronze_append(t: Tables):
    """Stream the messages into Bronze in several micro-batches, and start the stream again: it
    carries on where it ended, and nothing comes twice."""
    folder = scratch_path(t.spark, "stream")
    t.messages.drop("commit_id").repartition(4).write.parquet(f"{folder}/messages")
    table = bronze_table(t, "bronze")
    for _ in range(2):
        writer = BronzeWriter(table, processed_at=F.col("timestamp"))
        stream = topics.read_message_files(t.spark, f"{folder}/messages", max_files=2)
        start_bronze(stream, writer, f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    return spelled(table.read())


@query(
    "day_partitioned_table",
    """SELECT commit_id, CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_day, count(*) AS n,
        min(seq) AS lowest FROM bronze GROUP BY 1, 2""",
    "bronze",
)
def day_partitioned_table(t: Tables):
    rows = stored(t, "days").read()
    return rows.groupBy("commit_id", "event_day").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("lowest")
    )


@query("scan_asof", f"SELECT {DUCK_BRONZE}, commit_id FROM bronze WHERE commit_id <= 4", "bronze")
def scan_asof(t: Tables):
    return spelled(stored(t, "asof").as_of(4), "commit_id")


@query(
    "scan_appended",
    f"SELECT {DUCK_BRONZE}, commit_id FROM bronze WHERE commit_id > 2 AND commit_id <= 5",
    "bronze",
)
def scan_appended(t: Tables):
    return spelled(stored(t, "appended").appended(2, 5), "commit_id")


@query("append_sink", "SELECT * FROM silver_likes", "silver_likes")
def append_sink(t: Tables):
    """Silver likes appended in two batches, the second without what the first brought."""
    path = scratch_path(t.spark, "likes")
    table = tables.CommitTable(t.spark, path, SILVER_SCHEMAS["silver_likes"], rebalance=True)
    typed = SILVER["silver_likes"](t.bronze)
    early = SILVER["silver_likes"](t.bronze.where("commit_id <= 4"))
    table.append(dedup_batch(early), 1)
    rest = inc.not_yet_in(dedup_batch(typed), table.as_of(1), bounds=tables.time_bounds(typed))
    table.append(rest, 2)
    return flat(table.read().select(*SILVER_SCHEMAS["silver_likes"].fieldNames()))


@query("replace_hours_sink", "SELECT * FROM gold_hashtags_hour", "gold_hashtags_hour")
def replace_hours_sink(t: Tables):
    """Hours written from the first commits, then those later commits touch replaced."""
    path = scratch_path(t.spark, "hashtags")
    model = GOLD["gold_hashtags_hour"]
    typed = SILVER["silver_posts"]
    early = dedup_batch(typed(t.bronze.where("commit_id <= 4")))
    tables.replace_hours(model({"silver_posts": early}), path)
    late = typed(t.bronze.where("commit_id > 4"))
    hours = inc.touched_hours([late])
    whole = in_hours(dedup_batch(typed(t.bronze)), hours)
    tables.replace_hours(model({"silver_posts": whole}), path)
    schema = GOLD_SCHEMAS["gold_hashtags_hour"]
    return tables.read_hours(t.spark, path, schema).select("hour", "hashtag", "posts", "rank")


@query(
    "parquet_dump_scan",
    DUCK_POSTS.replace("SELECT *", "SELECT * EXCLUDE (processed_at)"),
    "silver_posts",
)
def parquet_dump_scan(t: Tables):
    path = scratch_path(t.spark, "dump")
    silver_tables(t)["silver_posts"].write.parquet(path)
    return flat(read_dump(t.spark, path))


SLICE_START = datetime(2024, 1, 10)
SLICE_MINUTES = 7 * 24 * 60


@query(
    "freeze_slice",
    """SELECT kafka_partition::BIGINT AS partition, kafka_offset AS "offset", processed_at AS "timestamp",
        seq, usable FROM messages WHERE processed_at >= TIMESTAMP '2024-01-10'
        AND processed_at < TIMESTAMP '2024-01-17'""",
    "messages",
)
def freeze_slice(t: Tables):
    path = scratch_path(t.spark, "slice")
    messages = t.messages.drop("commit_id")
    frozen = topics.freeze_slice(messages, path, SLICE_START, SLICE_MINUTES)
    rows = decode_messages(frozen, F.col("timestamp"))
    names = {"kafka_partition": "partition", "kafka_offset": "offset", "processed_at": "timestamp"}
    return rows.select(*names, "seq", "usable").withColumnsRenamed(names)


@query(
    "table_file_stats",
    "SELECT count(DISTINCT commit_id) AS commits, true AS all_files, true AS all_bytes FROM bronze",
    "bronze",
)
def table_file_stats(t: Tables):
    """Commits counted, and files and bytes against a listing of the folder."""
    table = stored(t, "files")
    objects = maintenance.list_objects(t.spark, table.path).where("key LIKE '%.parquet'")
    listed = objects.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    return tables.file_stats(table).select(
        "commits",
        (F.col("files") == listed.select("n").scalar()).alias("all_files"),
        (F.col("bytes") == listed.select("size").scalar()).alias("all_bytes"),
    )


# --- Incremental control ---

CTES["commits"] = (
    "bronze",
    """SELECT commit_id, count(*) AS added_rows, max(processed_at) AS committed_at,
        sum(length(record)) AS size FROM bronze GROUP BY 1""",
)
CTES["touched"] = (
    "once",
    "SELECT DISTINCT commit_id, date_trunc('hour', event_time) AS hour FROM once",
)


def commit_list(t: Tables) -> DataFrame:
    return t.bronze.groupBy("commit_id").agg(
        F.count(F.lit(1)).alias("added_rows"), F.max("processed_at").alias("committed_at")
    )


@query(
    "capped_range",
    """SELECT 'first' AS reader, coalesce(max(commit_id) FILTER (WHERE total <= cap),
            min(commit_id)) AS read_up_to
    FROM (SELECT commit_id, sum(added_rows) OVER (ORDER BY commit_id) AS total,
            (SELECT sum(added_rows) * 2 // 5 FROM commits) AS cap FROM commits)
    UNION ALL
    SELECT 'second', coalesce(max(commit_id) FILTER (WHERE total <= cap), min(commit_id))
    FROM (SELECT commit_id, sum(added_rows) OVER (ORDER BY commit_id) AS total,
            (SELECT sum(added_rows) * 2 // 5 FROM commits) AS cap FROM commits
          WHERE commit_id > 2)
    UNION ALL
    SELECT 'tiny cap', min(commit_id) FROM commits WHERE commit_id > 4""",
    "commits",
)
def capped_range(t: Tables):
    """A reader that never ran, one past the second commit, one whose cap is too small."""
    listed = commit_list(t)
    cap = listed.agg(F.sum("added_rows")).first()[0] * 2 // 5

    def of(reader, cap, after):
        return inc.capped_range(listed, cap, after).select(F.lit(reader).alias("reader"), "*")

    return of("first", cap, None).unionByName(of("second", cap, 2)).unionByName(
        of("tiny cap", 1, 4)
    )


@query(
    "capped_range_bytes",
    """WITH total AS (SELECT sum(added_rows) AS n, sum(size) AS s FROM commits),
    rows_cap AS (SELECT coalesce(max(commit_id) FILTER (WHERE total <= cap), min(commit_id)) AS up_to
        FROM (SELECT commit_id, sum(added_rows) OVER (ORDER BY commit_id) AS total,
            (SELECT n * 4 // 5 FROM total) AS cap FROM commits))
    SELECT coalesce(max(commit_id) FILTER (WHERE running <= cap), min(commit_id)) AS read_up_to
    FROM (SELECT commit_id, sum(coalesce(size, 0)) OVER (ORDER BY commit_id) AS running,
            (SELECT s // 2 FROM total) AS cap
          FROM commits WHERE commit_id <= (SELECT up_to FROM rows_cap))""",
    "commits",
)
def capped_range_bytes(t: Tables):
    rows = t.bronze.withColumn("record", plain_record())
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("record")).alias("s")).first()
    return inc.capped_range_bytes(
        rows, commit_list(t), total["n"] * 4 // 5, total["s"] // 2
    )


def plain_record():
    """The record with its one escaped character as the SQL side spells it."""
    return F.replace("record", F.lit("⛅"), F.lit("\\u26c5"))


@query(
    "touched_hours",
    """SELECT DISTINCT date_trunc('hour', event_time) AS hour FROM bronze
    WHERE commit_id > 5 AND collection IN ('app.bsky.feed.post', 'app.bsky.feed.like')
        AND operation = 'create'""",
    "bronze",
)
def touched_hours(t: Tables):
    created = t.bronze.where("operation = 'create' AND commit_id > 5")
    return inc.touched_hours(
        [created.where(F.col("collection") == kind) for kind in (c.POST, c.LIKE)]
    )


@query(
    "first_touch_cap",
    """WITH first AS (SELECT hour, min(commit_id) AS commit_id FROM touched GROUP BY 1),
    running AS (SELECT commit_id, sum(count(*)) OVER (ORDER BY commit_id) AS total,
        commit_id = min(commit_id) OVER () AS is_first FROM first GROUP BY 1)
    SELECT coalesce(min(commit_id) - 1, (SELECT max(commit_id) FROM touched)) AS read_up_to
    FROM running WHERE total > 300 AND NOT is_first""",
    "touched",
)
def first_touch_cap(t: Tables):
    once = dedup_batch(t.bronze.select("seq", "event_time", "processed_at", "commit_id"))
    return inc.first_touch_cap(inc.hours_by_commit([once]), 300)


@query(
    "gold_hours_behind",
    """SELECT model, count(DISTINCT date_trunc('hour', event_time)) AS hours FROM (
        SELECT 'gold_langs_hour' AS model, event_time FROM bronze
            WHERE commit_id > 6 AND collection = 'app.bsky.feed.post' AND operation != 'delete'
        UNION ALL SELECT 'gold_active_users_hour', event_time FROM bronze
            WHERE commit_id > 4 AND operation IN ('create', 'update')) GROUP BY 1""",
    "bronze",
)
def gold_hours_behind(t: Tables):
    labelled = {}
    for name in SILVER:
        typed = SILVER[name](t.bronze.withColumn("bronze_snapshot_id", F.col("commit_id")))
        labelled[name] = typed.withColumn("commit_id", F.col("bronze_snapshot_id"))
    models = ("gold_langs_hour", "gold_active_users_hour", "gold_hashtags_hour")
    inputs = {model: inc.GOLD_INPUTS[model] for model in models}
    positions = {"gold_langs_hour": 6, "gold_active_users_hour": 4, "gold_hashtags_hour": None}
    return inc.gold_hours_behind(labelled, inputs, positions)


def _progress(t: Tables, mark: bool) -> DataFrame:
    """Two models stage the positions of two passes; the second pass of one is not marked."""
    pipeline = inc.Pipeline(t.spark, scratch_path(t.spark, "progress"))
    last = t.bronze.agg(F.max("commit_id")).first()[0]
    for pass_id, model, position in (
        (1, "silver_posts", last - 2),
        (2, "silver_likes", last - 1),
        (3, "silver_posts", last),
    ):
        pipeline.stage_positions({model: {"bronze": position}}, pass_id)
        if mark and pass_id != 3:
            pipeline.mark_done([model], pass_id)
    return pipeline.progress.read()


LAST = "(SELECT max(commit_id) AS last FROM bronze)"
STAGED = f"""SELECT model, last - behind AS position, false AS done FROM {LAST}
    CROSS JOIN (VALUES ('silver_posts', 2), ('silver_likes', 1), ('silver_posts', 0)) AS v (model, behind)"""
MARKED = f"""SELECT model, last - behind AS position, true AS done FROM {LAST}
    CROSS JOIN (VALUES ('silver_posts', 2), ('silver_likes', 1)) AS v (model, behind)"""


@query("stage_position", STAGED, "bronze")
def stage_position(t: Tables):
    return _progress(t, mark=False).select("model", "position", "done")


@query("mark_done", f"{STAGED} UNION ALL {MARKED}", "bronze")
def mark_done(t: Tables):
    return _progress(t, mark=True).select("model", "position", "done")


@query("last_position", f"SELECT model, position FROM ({MARKED})", "bronze")
def last_position(t: Tables):
    return inc.last_positions(_progress(t, mark=True), ["model"])


def _half_way(t: Tables, models, max_hours) -> inc.Pipeline:
    """Four commits taken to Silver, a capped number of hours to Gold, then the rest of the
    commits left waiting in Bronze."""
    pipeline = inc.Pipeline(t.spark, scratch_path(t.spark, "pipeline"), models)
    listed = list(commits(t))
    for commit, rows in listed[:4]:
        pipeline.append_bronze(rows, commit)
    pipeline.silver_pass()
    pipeline.gold_pass(max_hours)
    for commit, rows in listed[4:]:
        pipeline.append_bronze(rows, commit)
    return pipeline


@query(
    "backlog",
    """SELECT (SELECT count(*) FROM bronze WHERE commit_id > 4) AS silver_rows,
        (SELECT count(DISTINCT date_trunc('hour', event_time)) - 6 FROM bronze
         WHERE commit_id <= 4 AND collection = 'app.bsky.feed.post'
            AND operation IN ('create', 'update')) AS gold_hours""",
    "bronze",
)
def backlog(t: Tables):
    return _half_way(t, ["gold_langs_hour", "gold_hashtags_hour"], 6).backlog().select("silver_rows", "gold_hours")


@query(
    "clear_pending",
    """SELECT 'gold_langs_hour' AS model, hour FROM (
        SELECT DISTINCT date_trunc('hour', event_time) AS hour FROM bronze
        WHERE commit_id <= 4 AND collection = 'app.bsky.feed.post'
            AND operation IN ('create', 'update') ORDER BY 1 OFFSET 6)""",
    "bronze",
)
def clear_pending(t: Tables):
    return _half_way(t, ["gold_langs_hour"], 6).pending_hours()


@query("rebuild_hours", "SELECT * FROM gold_engagement_hour", "gold_engagement_hour")
def rebuild_hours(t: Tables):
    """Half way, then capped passes until nothing is left: late rows and copies included,
    the hours equal one recompute of everything."""
    pipeline = _half_way(t, ["gold_engagement_hour"], None)
    # From the commits' lines: the events are not read again
    rows = pipeline.bronze.rows_after(None)
    pipeline.catch_up(max_rows=rows // 4)
    return pipeline.read_gold("gold_engagement_hour").drop("silver_snapshot_id")


# --- Maintenance ---


TOKYO = timezone(timedelta(hours=9))


@query(
    "retention_delete",
    f"""SELECT 'bronze' AS kind, commit_id, seq AS number, event_time AS at FROM bronze
        WHERE event_time >= TIMESTAMP '2024-01-13'
    UNION ALL SELECT 'gold', NULL, posts, hour FROM gold_langs_hour WHERE hour >= TIMESTAMP '2024-01-13'
    UNION ALL SELECT 'merged day', NULL, 5, day FROM (SELECT CAST(event_time AS DATE) AS day FROM bronze
        WHERE commit_id <= 5 AND event_time >= TIMESTAMP '2024-01-13' GROUP BY 1 HAVING count(DISTINCT commit_id) > 1)
    UNION ALL SELECT 'commit', commit_id, count(*), NULL FROM bronze GROUP BY commit_id""",
    "bronze gold_langs_hour",
)
def retention_delete(t: Tables):
    """Bronze by day, Gold by hour and the log of merges, at eight in the morning of Tokyo, where
    UTC has not reached that day: what is left, and the commits' counts, which stay."""
    table, hours = stored(t, "retention"), scratch_path(t.spark, "retention-gold")
    now = datetime(2024, 1, 21, 8, 0, tzinfo=TOKYO)
    silver = {"silver_posts": dedup_batch(SILVER["silver_posts"](t.bronze))}
    tables.replace_hours(GOLD["gold_langs_hour"](silver), hours)
    maintenance.compact_commits(table, 5)
    maintenance.drop_expired_days(table, now, 7)
    maintenance.drop_expired_hours(t.spark, hours, now, 7)
    none = F.lit(None).cast("bigint")
    bronze = table.read().select(F.lit("bronze").alias("kind"), "commit_id", F.col("seq").alias("number"), F.col("event_time").alias("at"))
    gold = tables.read_hours(t.spark, hours, GOLD_SCHEMAS["gold_langs_hour"])
    lines = [{"kind": "merged day", "number": m.up_to, "day": day} for day, m in table.merges()[1].items()]
    merged = tables.lines_frame(t.spark, lines, c.schema(kind="string", number="bigint", day="string"))
    listed = table.commits()
    return (
        bronze.unionByName(gold.select(F.lit("gold").alias("kind"), none.alias("commit_id"), F.col("posts").alias("number"), F.col("hour").alias("at")))
        .unionByName(merged.select("kind", none.alias("commit_id"), "number", F.col("day").cast("timestamp").alias("at")))
        .unionByName(listed.select(F.lit("commit").alias("kind"), "commit_id", F.col("added_rows").alias("number"), F.lit(None).cast("timestamp").alias("at")))
    )


@query(
    "trim_progress",
    """SELECT model, commit_id AS position, done, committed_at AS recorded_at FROM positions
    WHERE committed_at >= TIMESTAMP '2024-01-25' OR (model, committed_at) IN (
        SELECT (model, max(committed_at)) FROM positions WHERE done GROUP BY model)
        OR commit_id = (SELECT max(commit_id) FROM positions)""",
    "positions",
)
def trim_progress(t: Tables):
    """The stored positions of readers that went on commit by commit, trimmed in place."""
    pipeline = inc.Pipeline(t.spark, scratch_path(t.spark, "positions"))
    found = positions(t).withColumn("at", F.unix_micros("committed_at")).orderBy("commit_id", "model").collect()
    for row in found:
        line = {"model": row["model"], "input": "bronze", "position": row["commit_id"], "done": row["done"]}
        pipeline.progress.append([line | {"recorded_at": row["at"]}], row["commit_id"])
    pipeline.trim_progress(datetime(2024, 1, 25))
    return pipeline.progress.read().select("model", "position", "done", "recorded_at")


CTES["positions"] = (
    "commits",
    """SELECT model, commit_id, committed_at, commit_id <= reach AS done FROM commits
    CROSS JOIN (VALUES ('silver_posts', 8), ('silver_likes', 3), ('silver_follows', 5)) AS v (model, reach)""",
)


def positions(t: Tables) -> DataFrame:
    reach = {"silver_posts": 8, "silver_likes": 3, "silver_follows": 5}
    readers = F.inline(
        F.array(
            *[F.struct(F.lit(m).alias("model"), F.lit(n).alias("reach")) for m, n in reach.items()]
        )
    )
    rows = commit_list(t).select("commit_id", "committed_at", readers)
    return rows.withColumn("done", F.col("commit_id") <= F.col("reach"))


@query(
    "stale_readers",
    """WITH readers AS (SELECT model AS reader, max(commit_id) AS read_id FROM positions
            WHERE done GROUP BY 1
        UNION ALL SELECT 'gold', -1),
    known AS (SELECT reader, read_id, committed_at AS read_at FROM readers
        LEFT JOIN commits ON commit_id = read_id),
    unread AS (SELECT reader, min(committed_at) AS oldest_unread FROM known
        JOIN commits ON committed_at > read_at GROUP BY 1)
    SELECT reader, read_id, oldest_unread, read_at IS NULL AS expired
    FROM known LEFT JOIN unread USING (reader)
    WHERE read_at IS NULL OR oldest_unread < (SELECT max(committed_at) - INTERVAL 100 HOUR FROM commits)""",
    "positions",
)
def stale_readers(t: Tables):
    done = positions(t).where("done").groupBy(F.col("model").alias("reader"))
    readers = done.agg(F.max("commit_id").alias("commit_id")).unionByName(
        t.spark.range(1).select(
            F.lit("gold").alias("reader"), F.lit(-1).cast("bigint").alias("commit_id")
        )
    )
    listed = commit_list(t).withColumn("table_name", F.lit("bronze"))
    # The latest commit's time, as text: it does not pass through the Python time zone
    now = listed.agg(F.max("committed_at").cast("string")).first()[0]
    return maintenance.stale_readers(
        readers.withColumn("table_name", F.lit("bronze")),
        listed,
        F.lit(now).cast("timestamp"),
        max_age_hours=100,
    )


@query("compact_day", f"SELECT {DUCK_BRONZE}, commit_id FROM bronze", "bronze")
def compact_day(t: Tables):
    """Commits up to the fifth merged and their folders dropped while the sixth stands half written;
    then the fifth, the second and the rest written by a stream that crashed before, and all merged
    again: every row is there once."""
    table = bronze_table(t, "compact")
    listed = dict(commits(t))
    for commit in range(1, 6):
        table.append(listed[commit], commit)
    half = listed[6].where("seq % 2 = 0").withColumn(tables.DAY, F.to_date("event_time"))
    half.select(*c.BRONZE_COLUMNS, tables.DAY).write.partitionBy(tables.DAY).parquet(f"{table.path}/commit_id=6")
    maintenance.compact_commits(table, COMMITS)
    maintenance.drop_merged(table)
    for commit in (2, 5, *range(6, COMMITS + 1)):
        table.append(listed[commit], commit)
    maintenance.compact_commits(table, COMMITS)
    maintenance.drop_merged(table)
    return spelled(table.read(), "commit_id")


@query(
    "storage_by_prefix",
    """SELECT prefix, branch, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS objects FROM (
        SELECT n_chars AS size, CASE WHEN lang = 'en' THEN 'ducklake/' || source ELSE 'iceberg' END AS prefix,
            CASE WHEN lang = 'en' THEN 'duckdb' ELSE 'spark' END AS branch FROM documents)
    GROUP BY 1, 2""",
)
def storage_by_prefix(t: Tables):
    root = F.when(F.col("lang") == "en", "ducklake").otherwise("iceberg")
    objects = t.documents.select(
        F.concat_ws("/", root, "source", F.col("doc_id").cast("string")).alias("key"),
        F.col("n_chars").alias("size"),
    )
    return maintenance.storage_by_prefix(objects, {"ducklake": "duckdb", "iceberg": "spark"})


@query(
    "table_usage",
    """SELECT event_type AS table_name, arg_max(event_id - user_id % 10, ts) AS rows,
        arg_max(CAST(floor(value * 1000) AS BIGINT), ts) AS bytes,
        arg_max(event_id % 97 + 1, ts) AS files FROM events GROUP BY 1""",
)
def table_usage(t: Tables):
    def text(column):
        return column.cast("string")

    summary = F.create_map(
        F.lit("total-records"), text(F.col("event_id")),
        F.lit("total-position-deletes"), text(F.col("user_id") % 10),
        F.lit("total-files-size"), text(F.floor(F.col("value") * 1000)),
        F.lit("total-data-files"), text(F.col("event_id") % 97),
        F.lit("total-delete-files"), F.lit("1"),
    )
    snapshots = t.events.select(
        F.col("event_type").alias("table_name"), F.col("ts").alias("committed_at"), summary.alias("summary")
    )
    return maintenance.table_usage(snapshots)
