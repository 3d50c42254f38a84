"""Projections and scalar functions."""

from datetime import date

from pyspark.sql import functions as F

from catalogue.registry import Tables, query
from catalogue.shape import CTES
from tidemark import contract as c
from tidemark.functions import labels, records, text, times
from tidemark.operators.filters import hour_ranges_filter
from tidemark.operators.ranking import hour_islands
from tidemark.sources.envelopes import collection_mix
from tidemark.sources.topics import within_offsets


def joined(column):
    return F.array_join(F.array_sort(column), "|")


def pieces(source: str) -> str:
    """SQL: seq, kind (tag, did or lang), value and place of every element of the lists of the
    records `j` of a table. Facets are taken apart element by element."""
    return f"""WITH facets AS (SELECT seq, unnest(CAST(j -> '$.facets' AS JSON[])) AS facet FROM {source}
            WHERE json_type(j -> '$.facets') = 'ARRAY'),
        features AS (SELECT seq, unnest(CAST(facet -> '$.features' AS JSON[])) AS feature FROM facets
            WHERE json_type(facet -> '$.features') = 'ARRAY')
    SELECT seq, 'feature' AS kind, feature ->> '$."$type"' AS value, 0 AS place FROM features
    UNION ALL SELECT seq, 'tag', lower(feature ->> '$.tag'), 0 FROM features
        WHERE feature ->> '$."$type"' = '{c.FACET_TAG}' AND feature ->> '$.tag' IS NOT NULL
    UNION ALL SELECT seq, 'did', feature ->> '$.did', 0 FROM features
        WHERE feature ->> '$."$type"' = '{c.FACET_MENTION}' AND feature ->> '$.did' IS NOT NULL
    UNION ALL SELECT seq, 'tag', lower(tag ->> '$'), 0 FROM (
        SELECT seq, unnest(CAST(j -> '$.tags' AS JSON[])) AS tag FROM {source}
        WHERE json_type(j -> '$.tags') = 'ARRAY')
    UNION ALL SELECT seq, 'lang', lang ->> '$', place FROM (
        SELECT seq, unnest(CAST(j -> '$.langs' AS JSON[])) AS lang,
            generate_subscripts(CAST(j -> '$.langs' AS JSON[]), 1) AS place FROM {source}
        WHERE json_type(j -> '$.langs') = 'ARRAY')"""


# Records one by one (`row` tells copies of an event apart) and their lists, gathered again
CTES["records"] = (
    "bronze",
    """SELECT row_number() OVER (ORDER BY seq, processed_at) AS seq, seq AS event, record::JSON AS j
    FROM bronze WHERE record IS NOT NULL""",
)
CTES["record_lists"] = ("records", pieces("records"))


@query(
    "json_path",
    """SELECT seq, record::JSON ->> '$.text' AS body, record::JSON ->> '$.reply.parent.uri' AS parent_uri,
        record::JSON ->> '$.embed."$type"' AS embed_type,
        CAST(record::JSON -> '$.subject' AS VARCHAR) AS subject
    FROM bronze WHERE record IS NOT NULL""",
    "bronze",
)
def json_path(t: Tables):
    record = F.col("record")
    subject = records.json_path(record, "$.subject")
    # Objects are compact JSON in both engines; a JSON string keeps its quotes in SQL only
    quoted = F.when(subject.startswith("did:"), F.concat(F.lit('"'), subject, F.lit('"')))
    return t.bronze.where(record.isNotNull()).select(
        "seq",
        records.json_path(record, "$.text").alias("body"),
        records.json_path(record, "$.reply.parent.uri").alias("parent_uri"),
        records.json_path(record, "$.embed.$type").alias("embed_type"),
        F.coalesce(quoted, subject).alias("subject"),
    )


@query(
    "json_array",
    """SELECT b.seq, CAST(CASE WHEN json_type(b.record::JSON -> '$.langs') = 'ARRAY'
            THEN json_array_length(b.record::JSON -> '$.langs') ELSE -1 END AS INTEGER) AS n,
        (SELECT CASE WHEN json_type(b.record::JSON -> '$.langs') = 'ARRAY'
            THEN ifnull(string_agg(x, '|' ORDER BY x), '') END
         FROM (SELECT unnest(json_extract_string(b.record::JSON, '$.langs[*]')) AS x)) AS langs
    FROM bronze AS b""",
    "bronze",
)
def json_array(t: Tables):
    langs = records.json_array(F.col("record"), "$.langs")
    size = F.when(langs.isNotNull(), F.size(langs)).otherwise(-1)
    return t.bronze.select("seq", size.alias("n"), joined(langs).alias("langs"))


@query(
    "facet_features",
    f"""SELECT r.event AS seq, count(value) FILTER (WHERE kind = 'feature') AS features,
        count(value) FILTER (WHERE kind = 'feature' AND value = '{c.FACET_TAG}') AS tags
    FROM records AS r LEFT JOIN record_lists AS l ON l.seq = r.seq GROUP BY r.seq, r.event""",
    "record_lists",
)
def facet_features(t: Tables):
    features = records.facet_features(F.col("record"))
    return t.bronze.where("record IS NOT NULL").select(
        "seq",
        F.size(features).alias("features"),
        F.size(records.feature_values(features, c.FACET_TAG, "tag")).alias("tags"),
    )


@query(
    "hashtags",
    """SELECT r.event AS seq, ifnull(string_agg(DISTINCT value, '|' ORDER BY value), '') AS hashtags
    FROM records AS r LEFT JOIN record_lists AS l ON l.seq = r.seq AND kind = 'tag' GROUP BY r.seq, r.event""",
    "record_lists",
)
def hashtags(t: Tables):
    tags = records.hashtags(F.col("record"))
    return t.bronze.where("record IS NOT NULL").select("seq", joined(tags).alias("hashtags"))


@query(
    "mentions",
    """SELECT r.event AS seq, ifnull(string_agg(value, '|' ORDER BY value), '') AS mentions
    FROM records AS r LEFT JOIN record_lists AS l ON l.seq = r.seq AND kind = 'did' GROUP BY r.seq, r.event""",
    "record_lists",
)
def mentions(t: Tables):
    found = records.mentions(F.col("record"))
    return t.bronze.where("record IS NOT NULL").select("seq", joined(found).alias("mentions"))


@query("simple_lower", "SELECT doc_id, lower(text || ' İΣ') AS lowered FROM documents")
def simple_lower(t: Tables):
    lowered = text.simple_lower(F.concat("text", F.lit(" İΣ")))
    return t.documents.select("doc_id", lowered.alias("lowered"))


@query(
    "at_uri_parts",
    """SELECT seq, split_part(uri, '/', 3) AS subject_did, split_part(uri, '/', 5) AS subject_rkey
    FROM (SELECT seq, record::JSON ->> '$.subject.uri' AS uri FROM bronze)""",
    "bronze",
)
def at_uri_parts(t: Tables):
    uri = records.json_path(F.col("record"), "$.subject.uri")
    return t.bronze.select(
        "seq", text.at_uri_did(uri).alias("subject_did"), text.at_uri_rkey(uri).alias("subject_rkey")
    )


@query(
    "try_timestamp",
    """SELECT seq, TRY_CAST(record::JSON ->> '$.createdAt' AS TIMESTAMP) AS created_at
    FROM bronze""",
    "bronze",
)
def try_timestamp(t: Tables):
    created = records.json_path(F.col("record"), "$.createdAt")
    return t.bronze.select("seq", times.try_timestamp(created).alias("created_at"))


@query(
    "lang_subtag",
    """SELECT lang, count(*) AS posts FROM (
        SELECT DISTINCT seq, lower(split_part(unnest(langs), '-', 1)) AS lang FROM (
            SELECT seq, coalesce(CASE WHEN json_type(record::JSON, '$.langs') = 'ARRAY'
                THEN from_json(record::JSON -> '$.langs', '["VARCHAR"]') END, ['und']) AS langs
            FROM once))
    GROUP BY lang""",
    "once",
)
def lang_subtag(t: Tables):
    from tidemark.operators.dedup import dedup_batch

    langs = records.json_array(F.col("record"), "$.langs")
    once = dedup_batch(t.bronze.select("seq", langs.alias("langs"), "processed_at"))
    return (
        once.select(F.explode(text.primary_languages(F.col("langs"))).alias("lang"))
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("posts"))
    )


@query(
    "truncate_time",
    """SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour
    FROM events""",
)
def truncate_time(t: Tables):
    return t.events.select(
        "event_id",
        times.truncate_time("MINUTE", F.col("ts")).alias("minute"),
        times.truncate_time("HOUR", F.col("ts")).alias("hour"),
    )


@query(
    "epoch_window",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) // 300 * 300 AS window_epoch
    FROM events""",
)
def epoch_window(t: Tables):
    return t.events.select("event_id", times.epoch_window(F.col("ts")).alias("window_epoch"))


@query(
    "latency_ms",
    """SELECT seq, kafka_offset, commit_id,
        epoch_us(processed_at) // 1000 - epoch_us(event_time) // 1000 AS latency_ms FROM bronze""",
    "bronze",
)
def latency_ms(t: Tables):
    return t.bronze.select(
        "seq",
        "kafka_offset",
        "commit_id",
        times.latency_ms(F.col("event_time"), F.col("processed_at")).alias("latency_ms"),
    )


@query(
    "rate_bucket",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN m / 300.0 < 200 THEN '0-200'
        WHEN m / 300.0 < 500 THEN '200-500' ELSE '500+' END AS bucket
    FROM (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * 3) AS BIGINT) AS m
          FROM lineitem)""",
)
def rate_bucket(t: Tables):
    messages = F.floor(F.col("l_extendedprice") * 3)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", labels.rate_bucket(messages).alias("bucket")
    )


@query(
    "regime",
    """SELECT w.window_epoch, CASE WHEN w.window_epoch >= CAST(epoch(c.caught_up_at) AS BIGINT)
            // 300 * 300 THEN 'live' ELSE 'catchup' END AS regime, w.events
    FROM (SELECT CAST(event_time AS DATE) AS day, CAST(floor(epoch(event_time)) AS BIGINT)
            // 300 * 300 AS window_epoch, count(*) AS events
          FROM bronze GROUP BY 1, 2) AS w
    JOIN calendar AS c ON c.day = w.day""",
    "bronze calendar",
)
def regime(t: Tables):
    windows = t.bronze.groupBy(
        F.to_date("event_time").alias("day"),
        times.epoch_window(F.col("event_time")).alias("window_epoch"),
    ).agg(F.count(F.lit(1)).alias("events"))
    days = t.calendar.select("day", "caught_up_at")
    label = labels.regime(F.col("window_epoch"), F.col("caught_up_at"))
    return windows.join(days, "day").select("window_epoch", label.alias("regime"), "events")


@query(
    "business_day",
    """SELECT event_id, CAST(CAST(timezone('Europe/Paris', ts AT TIME ZONE 'UTC')
        + INTERVAL 5 HOUR AS DATE) AS VARCHAR) AS day FROM events""",
)
def business_day(t: Tables):
    return t.events.select("event_id", times.business_day(F.col("ts")).alias("day"))


@query(
    "rotation_branch",
    """SELECT CAST(day AS VARCHAR) AS day, CASE WHEN (day - DATE '2024-01-01') % 2 = 0
        THEN 'duckdb' ELSE 'spark' END AS rotation,
        coalesce(forced_branch, CASE WHEN (day - DATE '2024-01-01') % 2 = 0
        THEN 'duckdb' ELSE 'spark' END) AS branch FROM calendar""",
    "calendar",
)
def rotation_branch(t: Tables):
    start = date(2024, 1, 1)
    return t.calendar.select(
        "day",
        labels.rotation_branch(F.col("day"), start).alias("rotation"),
        labels.rotation_branch(F.col("day"), start, F.col("forced_branch")).alias("branch"),
    )


MODEL_CASE = f"""CASE
    WHEN collection = '{c.POST}' AND operation IN ('create', 'update') THEN 'silver_posts'
    WHEN collection = '{c.LIKE}' AND operation = 'create' THEN 'silver_likes'
    WHEN collection = '{c.REPOST}' AND operation = 'create' THEN 'silver_reposts'
    WHEN collection = '{c.FOLLOW}' AND operation = 'create' THEN 'silver_follows'
    WHEN operation = 'delete' THEN 'silver_deletes' END"""


@query(
    "model_label",
    f"""SELECT {MODEL_CASE} AS model, count(*) AS events, min(event_time) AS lower,
        max(event_time) AS upper FROM bronze GROUP BY 1""",
    "bronze",
)
def model_label(t: Tables):
    label = labels.silver_model(F.col("collection"), F.col("operation"))
    return t.bronze.groupBy(label.alias("model")).agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_time").alias("lower"),
        F.max("event_time").alias("upper"),
    )


@query(
    "offset_bounds",
    """SELECT seq, kafka_partition::BIGINT AS kafka_partition, kafka_offset FROM bronze
    WHERE kafka_partition < 2 AND kafka_offset < (SELECT max(kafka_offset) // 2 FROM bronze AS b
        WHERE b.kafka_partition = bronze.kafka_partition)""",
    "bronze",
)
def offset_bounds(t: Tables):
    """Half of two partitions; the third has no end and keeps nothing."""
    # As many rows as the topic has partitions
    ends = t.bronze.groupBy("kafka_partition").agg(
        F.floor(F.max("kafka_offset") / 2).alias("end")
    )
    end = {row["kafka_partition"]: row["end"] for row in ends.collect()}
    end.pop(2, None)
    inside = within_offsets(None, end, "kafka_partition", "kafka_offset")
    return t.bronze.where(inside).select("seq", "kafka_partition", "kafka_offset")


@query(
    "hour_ranges_filter",
    """WITH purchases AS (SELECT date_trunc('hour', ts) AS hour, sum(value) AS v FROM events GROUP BY 1),
    chosen AS (SELECT hour FROM purchases WHERE v > (SELECT avg(v) * 1.3 FROM purchases))
    SELECT event_id, ts, value FROM events
    WHERE date_trunc('hour', ts) IN (SELECT hour FROM chosen)""",
    doubles="value",
)
def hour_ranges(t: Tables):
    """Events of the busiest hours, as ranges of consecutive hours."""
    hours = t.events.groupBy(F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.sum("value").alias("v")
    )
    busy = hours.where(F.col("v") > hours.agg(F.avg("v") * 1.3).scalar())
    ranges = hour_islands(busy).selectExpr("cast(range_start as string)", "cast(range_end as string)")
    # Ranges of hours: at most one per two hours of the time covered
    listed = [tuple(row) for row in ranges.collect()]
    return hour_ranges_filter(t.events, listed, "ts").select("event_id", "ts", "value")


@query(
    "predicates",
    """SELECT event_id, event_type, value FROM events
    WHERE event_type IN ('click', 'view') AND value BETWEEN 10 AND 100 AND props IS NOT NULL
        AND regexp_matches(props, '"k": [0-9]*[05]\\}') AND user_id != 3""",
    doubles="value",
)
def predicates(t: Tables):
    return t.events.where(
        F.col("event_type").isin("click", "view")
        & F.col("value").between(10, 100)
        & F.col("props").isNotNull()
        & F.col("props").rlike(r'"k": [0-9]*[05]\}')
        & (F.col("user_id") != 3)
    ).select("event_id", "event_type", "value")


@query(
    "collection_mix",
    """SELECT CASE WHEN usable THEN collection || '/' || operation ELSE 'other' END AS label,
        count(*) AS messages FROM messages GROUP BY 1""",
    "messages",
)
def mix(t: Tables):
    return collection_mix(t.messages)
