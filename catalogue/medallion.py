"""Deduplication, Silver models and Gold models."""

from pyspark.sql import functions as F

from catalogue.registry import Tables, query
from catalogue.scalars import joined, pieces
from catalogue.shape import CTES
from tidemark import contract as c
from tidemark.operators import ranking
from tidemark.operators.dedup import dedup_batch, dedup_incremental
from tidemark.plans.account_bitmaps import AccountBitmaps
from tidemark.plans.gold import GOLD
from tidemark.plans.incremental import Pipeline
from tidemark.plans.silver import SILVER
from tidemark.session import scratch_path
from tidemark.sources.tables import time_bounds

CREATED = "TRY_CAST(record::JSON ->> '$.createdAt' AS TIMESTAMP) AS created_at"


def _subject(collection: str) -> str:
    return f"""SELECT seq, did, rkey, cid, event_time, {CREATED},
        record::JSON ->> '$.subject.uri' AS subject_uri,
        split_part(record::JSON ->> '$.subject.uri', '/', 3) AS subject_did,
        split_part(record::JSON ->> '$.subject.uri', '/', 5) AS subject_rkey, processed_at
    FROM once WHERE collection = '{collection}' AND operation = 'create'"""


# Features, tags and mentions of every record one by one, and gathered again per event
CTES["posted"] = (
    "once",
    f"SELECT *, record::JSON AS j FROM once WHERE collection = '{c.POST}' AND operation <> 'delete'",
)
CTES["post_lists"] = (
    "posted",
    f"""SELECT seq, list(DISTINCT value) FILTER (WHERE kind = 'tag') AS hashtags,
        list(value) FILTER (WHERE kind = 'did') AS mention_dids,
        list(value ORDER BY place) FILTER (WHERE kind = 'lang') AS langs FROM ({pieces('posted')}) GROUP BY seq""",
)
CTES["silver_posts"] = (
    "posted post_lists",
    f"""WITH lists AS (SELECT p.*, l.hashtags, l.mention_dids, l.langs,
            p.j -> '$.reply' AS reply FROM posted AS p LEFT JOIN post_lists AS l ON l.seq = p.seq)
    SELECT seq, did, rkey, cid, operation, event_time, {CREATED}, j ->> '$.text' AS body,
        CASE json_type(j -> '$.langs') WHEN 'ARRAY' THEN ifnull(langs, []) END AS langs,
        reply ->> '$.parent.uri' AS reply_parent_uri, reply ->> '$.root.uri' AS reply_root_uri,
        j -> '$.embed' ->> '$."$type"' AS embed_type,
        ifnull(hashtags, []) AS hashtags, ifnull(mention_dids, []) AS mention_dids, processed_at
    FROM lists""",
)
CTES["silver_likes"] = ("once", _subject(c.LIKE))
CTES["silver_reposts"] = ("once", _subject(c.REPOST))
CTES["silver_follows"] = (
    "once",
    f"""SELECT seq, did, rkey, cid, event_time, {CREATED},
        record::JSON ->> '$.subject' AS subject_did, processed_at
    FROM once WHERE collection = '{c.FOLLOW}' AND operation = 'create'""",
)
CTES["silver_deletes"] = (
    "once",
    """SELECT seq, did, collection, rkey, event_time, processed_at
    FROM once WHERE operation = 'delete'""",
)
# Every Silver event in one table: what happened to which collection, and what a post carries
CTES["happenings"] = (
    "silver_posts silver_likes silver_reposts silver_follows silver_deletes",
    f"""SELECT seq, event_time, did, '{c.LIKE}' AS thing, 'made' AS act, NULL AS parent, NULL AS embed
        FROM silver_likes
    UNION ALL BY NAME SELECT seq, event_time, did, '{c.REPOST}' AS thing, 'made' AS act FROM silver_reposts
    UNION ALL BY NAME SELECT seq, event_time, did, '{c.FOLLOW}' AS thing, 'made' AS act FROM silver_follows
    UNION ALL BY NAME SELECT seq, event_time, did, '{c.POST}' AS thing, 'made' AS act,
        reply_parent_uri AS parent, embed_type AS embed FROM silver_posts WHERE operation <> 'update'
    UNION ALL BY NAME SELECT seq, event_time, did, collection AS thing, 'deleted' AS act FROM silver_deletes""",
)
CTES["gold_activity_minute"] = (
    "happenings",
    """SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS minute, thing AS collection,
        CAST(sum(CASE act WHEN 'made' THEN 1 ELSE 0 END) AS BIGINT) AS creates,
        CAST(sum(CASE act WHEN 'deleted' THEN 1 ELSE 0 END) AS BIGINT) AS deletes
    FROM happenings GROUP BY ALL""",
)
CTES["gold_langs_hour"] = (
    "silver_posts",
    """WITH spoken AS (
        SELECT seq, event_time, lower(regexp_extract(tag, '^[^-]*')) AS lang FROM (
            SELECT seq, event_time, unnest(langs) AS tag FROM silver_posts WHERE operation <> 'update')
        UNION ALL SELECT seq, event_time, 'und' FROM silver_posts WHERE operation <> 'update' AND langs IS NULL)
    SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS hour, lang, count(DISTINCT seq) AS posts
    FROM spoken GROUP BY ALL""",
)
CTES["tagged_hours"] = (
    "silver_posts",
    """SELECT hour, tag, count(*) AS uses FROM (
        SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS hour, unnest(hashtags) AS tag
        FROM silver_posts WHERE operation <> 'update') GROUP BY ALL""",
)
# A tag's rank is one more than the tags of its hour that beat it
CTES["gold_hashtags_hour"] = (
    "tagged_hours",
    f"""SELECT own.hour, own.tag AS hashtag, own.uses AS posts, 1 + count(other.tag) AS rank
    FROM tagged_hours AS own LEFT JOIN tagged_hours AS other ON other.hour = own.hour
        AND (other.uses > own.uses OR other.uses = own.uses AND other.tag < own.tag)
    GROUP BY ALL HAVING count(other.tag) < {c.TOP_HASHTAGS}""",
)
CTES["gold_active_users_hour"] = (
    "happenings",
    """WITH seen AS (SELECT DISTINCT time_bucket(INTERVAL 1 HOUR, event_time) AS hour, thing, did
        FROM happenings WHERE act = 'made')
    SELECT hour, thing AS collection, count(did) AS active_accounts FROM seen GROUP BY ALL
    UNION ALL SELECT hour, 'all', count(DISTINCT did) FROM seen GROUP BY hour""",
)
CTES["gold_engagement_hour"] = (
    "happenings",
    f"""WITH counted AS (SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS hour,
            count_if(act = 'made' AND thing = '{c.LIKE}') AS likes,
            count_if(act = 'made' AND thing = '{c.REPOST}') AS reposts,
            count(parent) AS replies, count(*) FILTER (WHERE embed IN {c.QUOTE_EMBEDS}) AS quotes,
            count_if(act = 'deleted' AND thing = '{c.LIKE}') AS likes_deleted,
            count_if(act = 'deleted' AND thing = '{c.REPOST}') AS reposts_deleted,
            count_if(act = 'deleted' AND thing = '{c.POST}') AS posts_deleted
        FROM happenings WHERE act = 'deleted' OR thing <> '{c.FOLLOW}' GROUP BY ALL)
    SELECT *, likes - likes_deleted AS net_likes, reposts - reposts_deleted AS net_reposts
    FROM (SELECT hour, COLUMNS(* EXCLUDE (hour))::BIGINT FROM counted)""",
)

LISTS = {"silver_posts": ("langs", "hashtags", "mention_dids")}


def silver_tables(t: Tables) -> dict:
    return {name: dedup_batch(model(t.bronze)) for name, model in SILVER.items()}


def flat(rows):
    """Silver rows without the snapshot, lists as sorted text."""
    names = [name for name in rows.columns if name != "bronze_snapshot_id"]
    lists = LISTS["silver_posts"]
    return rows.select(
        *[joined(F.col(n)).alias(n) if n in lists else F.col(n) for n in names]
    ).withColumnsRenamed({"text": "body"})


DUCK_POSTS = """SELECT * REPLACE (array_to_string(list_sort(langs), '|') AS langs,
    array_to_string(list_sort(hashtags), '|') AS hashtags,
    array_to_string(list_sort(mention_dids), '|') AS mention_dids) FROM silver_posts"""


def _register_silver(name: str) -> None:
    sql = DUCK_POSTS if name == "silver_posts" else f"SELECT * FROM {name}"

    @query(name, sql, name)
    def build(t: Tables):
        return flat(dedup_batch(SILVER[name](t.bronze)))


def _register_gold(name: str) -> None:
    @query(name, f"SELECT * FROM {name}", name)
    def build(t: Tables):
        return GOLD[name](silver_tables(t))


for _name in SILVER:
    _register_silver(_name)
for _name in GOLD:
    _register_gold(_name)


@query("dedup_batch", "SELECT seq, event_time, processed_at, commit_id FROM once", "once")
def dedup(t: Tables):
    rows = t.bronze.select("seq", "event_time", "processed_at", "commit_id")
    return dedup_batch(rows)


@query(
    "dedup_incremental",
    """SELECT seq, event_time, processed_at FROM once AS o WHERE seq NOT IN (
        SELECT seq FROM bronze WHERE commit_id <= 3)""",
    "once",
)
def dedup_inc(t: Tables):
    """The batch of commits after the third, against what the first three brought."""
    rows = t.bronze.select("seq", "event_time", "processed_at", "commit_id")
    known = dedup_batch(rows.where("commit_id <= 3"))
    batch = rows.where("commit_id > 3")
    bounds = time_bounds(batch)
    return dedup_incremental(batch, known, bounds=bounds).drop("commit_id")


@query(
    "topk_per_group",
    """SELECT date_trunc('day', ts) AS day, user_id, total, rank FROM (
        SELECT date_trunc('day', ts) AS ts, user_id, round(sum(value), 2) AS total,
            row_number() OVER (PARTITION BY date_trunc('day', ts)
                ORDER BY round(sum(value), 2) DESC, user_id) AS rank
        FROM events GROUP BY 1, 2) WHERE rank <= 50""",
    doubles="total",
)
def topk(t: Tables):
    totals = t.events.groupBy(
        F.date_trunc("DAY", "ts").alias("day"), "user_id"
    ).agg(F.round(F.sum("value"), 2).alias("total"))
    return ranking.topk_per_group(
        totals, ["day"], [F.desc("total"), F.asc("user_id")], c.TOP_HASHTAGS
    )


@query(
    "gold_active_users_bitmaps",
    """SELECT 'hour' AS span, hour, collection, active_accounts FROM gold_active_users_hour
    UNION ALL SELECT 'day', day, collection, count(DISTINCT did) FROM (
        SELECT CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS day, unnest([thing, 'all']) AS collection, did
        FROM happenings WHERE act = 'made') GROUP BY ALL""",
    "gold_active_users_hour",
)
def gold_active_users_bitmaps(t: Tables):
    """Distinct accounts from bitmaps kept up commit by commit, late rows and copies included: per
    hour, and over the 24 hours of a day, from the same bitmaps."""
    root = scratch_path(t.spark, "accounts")
    pipeline = Pipeline(t.spark, root, ["gold_active_users_hour"])
    store = AccountBitmaps(t.spark, f"{root}/active")
    for first, last in ((1, 4), (5, 8)):
        pipeline.append_bronze(t.bronze.where(F.col("commit_id").between(first, last)), last)
        pipeline.silver_pass()
        store.update(pipeline.silver)
    hours = store.active().select(F.lit("hour").alias("span"), "*")
    days = store.active(F.date_trunc("DAY", "hour")).select(F.lit("day").alias("span"), "*")
    return hours.unionByName(days)
