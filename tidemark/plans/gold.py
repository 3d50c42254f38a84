"""Gold models: Silver tables -> figures per minute or hour.

Every model is one function of the Silver tables it reads, given by name. Each is a single
aggregation with map-side combine: one busy hour or collection spreads over all tasks."""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.text import primary_languages
from tidemark.operators.sets import union_all

Silver = Mapping[str, DataFrame]

CREATED_BY_TABLE = {
    "silver_posts": c.POST,
    "silver_likes": c.LIKE,
    "silver_reposts": c.REPOST,
    "silver_follows": c.FOLLOW,
}

GOLD_SCHEMAS = {
    "gold_activity_minute": c.schema(minute="timestamp", collection="string", creates="bigint", deletes="bigint", silver_snapshot_id="bigint"),
    "gold_langs_hour": c.schema(hour="timestamp", lang="string", posts="bigint", silver_snapshot_id="bigint"),
    "gold_hashtags_hour": c.schema(hour="timestamp", hashtag="string", posts="bigint", rank="int", silver_snapshot_id="bigint"),
    "gold_active_users_hour": c.schema(hour="timestamp", collection="string", active_accounts="bigint", silver_snapshot_id="bigint"),
    "gold_engagement_hour": c.schema(hour="timestamp", likes="bigint", reposts="bigint", replies="bigint", quotes="bigint", likes_deleted="bigint", reposts_deleted="bigint", posts_deleted="bigint", net_likes="bigint", net_reposts="bigint", silver_snapshot_id="bigint"),
}


def created_events(silver: Silver, *columns: str) -> DataFrame:
    """Creations of the four collections, labelled; edits of posts are not creations."""
    frames = []
    for table, collection in CREATED_BY_TABLE.items():
        rows = silver[table]
        if table == "silver_posts":
            rows = rows.where(F.col("operation") == "create")
        frames.append(rows.select(F.lit(collection).alias("collection"), *columns))
    return union_all(frames)


def _hour() -> Column:
    return F.date_trunc("HOUR", "event_time")


def gold_activity_minute(silver: Silver) -> DataFrame:
    """Creations and deletions per minute and collection."""
    created = created_events(silver, "event_time").withColumn("created", F.lit(1))
    deleted = silver["silver_deletes"].select(
        "collection", "event_time", F.lit(0).alias("created")
    )
    return (
        created.unionByName(deleted)
        .groupBy(F.date_trunc("MINUTE", "event_time").alias("minute"), "collection")
        .agg(
            F.count_if(F.col("created") == 1).alias("creates"),
            F.count_if(F.col("created") == 0).alias("deletes"),
        )
    )


def gold_langs_hour(silver: Silver) -> DataFrame:
    """Created posts per hour and primary language, a post once per language.

    Silver holds a post once, so its languages are made distinct within the row: no
    shuffle by post is needed."""
    posts = silver["silver_posts"].where(F.col("operation") == "create")
    return (
        posts.select(_hour().alias("hour"), F.explode(primary_languages(F.col("langs"))).alias("lang"))
        .groupBy("hour", "lang")
        .agg(F.count(F.lit(1)).alias("posts"))
    )


def gold_hashtags_hour(silver: Silver, top: int = c.TOP_HASHTAGS) -> DataFrame:
    """The `top` hashtags of each hour by posts, ties in alphabetical order."""
    posts = silver["silver_posts"].where(F.col("operation") == "create")
    counts = (
        posts.select(_hour().alias("hour"), F.explode("hashtags").alias("hashtag"))
        .groupBy("hour", "hashtag")
        .agg(F.count(F.lit(1)).alias("posts"))
    )
    order = Window.partitionBy("hour").orderBy(F.desc("posts"), F.asc("hashtag"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def gold_active_users_hour(silver: Silver) -> DataFrame:
    """Exact distinct accounts per hour and collection, and over all of them (`all`).

    One row per (hour, account) with a flag per collection answers both grouping levels,
    so the events are shuffled once and not once per level."""
    flags = {f"c{n}": collection for n, collection in enumerate(c.COLLECTIONS)}
    accounts = (
        created_events(silver, "event_time", "did")
        .where(F.col("did").isNotNull())
        .groupBy(_hour().alias("hour"), "did")
        .agg(
            *[
                F.max((F.col("collection") == collection).cast("int")).alias(flag)
                for flag, collection in flags.items()
            ]
        )
    )
    per_hour = accounts.groupBy("hour").agg(
        F.count(F.lit(1)).alias("everyone"),
        *[F.sum(flag).alias(flag) for flag in flags],
    )
    levels = [
        F.struct(F.lit("all").alias("collection"), F.col("everyone").alias("active_accounts")),
        *[
            F.struct(F.lit(name).alias("collection"), F.col(flag).alias("active_accounts"))
            for flag, name in flags.items()
        ],
    ]
    return (
        per_hour.select("hour", F.inline(F.array(*levels)))
        .where(F.col("active_accounts") > 0)
    )


def gold_engagement_hour(silver: Silver) -> DataFrame:
    """Likes, reposts, replies, quotes, deletions and nets; an hour any input saw appears.

    The inputs are tagged and counted in one aggregation, which needs no joins by hour."""
    posts = silver["silver_posts"].where(F.col("operation") == "create")
    nothing = F.lit(False)
    tagged = union_all(
        [
            posts.select(
                "event_time",
                F.lit("post").alias("kind"),
                F.col("reply_parent_uri").isNotNull().alias("reply"),
                F.coalesce(F.col("embed_type").isin(*c.QUOTE_EMBEDS), nothing).alias("quote"),
            ),
            *[
                silver[table].select(
                    "event_time",
                    F.lit(kind).alias("kind"),
                    nothing.alias("reply"),
                    nothing.alias("quote"),
                )
                for table, kind in (("silver_likes", "like"), ("silver_reposts", "repost"))
            ],
            silver["silver_deletes"].select(
                "event_time",
                F.concat(F.lit("deleted "), F.col("collection")).alias("kind"),
                nothing.alias("reply"),
                nothing.alias("quote"),
            ),
        ]
    )

    def count_kind(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    counts = tagged.groupBy(_hour().alias("hour")).agg(
        count_kind("like").alias("likes"),
        count_kind("repost").alias("reposts"),
        F.count_if("reply").alias("replies"),
        F.count_if("quote").alias("quotes"),
        count_kind(f"deleted {c.LIKE}").alias("likes_deleted"),
        count_kind(f"deleted {c.REPOST}").alias("reposts_deleted"),
        count_kind(f"deleted {c.POST}").alias("posts_deleted"),
    )
    return counts.select(
        "*",
        (F.col("likes") - F.col("likes_deleted")).alias("net_likes"),
        (F.col("reposts") - F.col("reposts_deleted")).alias("net_reposts"),
    )


GOLD: dict[str, Callable[[Silver], DataFrame]] = {
    "gold_activity_minute": gold_activity_minute,
    "gold_langs_hour": gold_langs_hour,
    "gold_hashtags_hour": gold_hashtags_hour,
    "gold_active_users_hour": gold_active_users_hour,
    "gold_engagement_hour": gold_engagement_hour,
}
ALL_CREATED = list(CREATED_BY_TABLE)
GOLD_INPUTS = {
    "gold_activity_minute": [*ALL_CREATED, "silver_deletes"],
    "gold_langs_hour": ["silver_posts"],
    "gold_hashtags_hour": ["silver_posts"],
    "gold_active_users_hour": ALL_CREATED,
    "gold_engagement_hour": ["silver_posts", "silver_likes", "silver_reposts", "silver_deletes"],
}
