"""Silver models: Bronze rows -> typed events, one function per model.

A model types its rows first and deduplicates after, so that the shuffle on the event key
carries no raw record. The record is parsed once, with the fields the model needs."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.records import FACETS_TYPE, feature_values, flatten_features, merge_tags
from tidemark.functions.text import at_uri_did, at_uri_rkey
from tidemark.functions.times import try_timestamp

SNAPSHOT = "bronze_snapshot_id"

POST_RECORD = (
    "createdAt string, text string, langs array<string>,"
    " reply struct<parent:struct<uri:string>, root:struct<uri:string>>,"
    f" embed struct<`$type`:string>, facets {FACETS_TYPE}, tags array<string>"
)
SUBJECT_RECORD = "createdAt string, subject struct<uri:string>"
FOLLOW_RECORD = "createdAt string, subject string"

SILVER_SCHEMAS = {
    "silver_posts": c.schema(seq="bigint", did="string", rkey="string", cid="string", operation="string", event_time="timestamp", created_at="timestamp", text="string", langs="strings", reply_parent_uri="string", reply_root_uri="string", embed_type="string", hashtags="strings", mention_dids="strings", processed_at="timestamp", bronze_snapshot_id="bigint"),
    "silver_likes": c.schema(seq="bigint", did="string", rkey="string", cid="string", event_time="timestamp", created_at="timestamp", subject_uri="string", subject_did="string", subject_rkey="string", processed_at="timestamp", bronze_snapshot_id="bigint"),
    "silver_follows": c.schema(seq="bigint", did="string", rkey="string", cid="string", event_time="timestamp", created_at="timestamp", subject_did="string", processed_at="timestamp", bronze_snapshot_id="bigint"),
    "silver_deletes": c.schema(seq="bigint", did="string", collection="string", rkey="string", event_time="timestamp", processed_at="timestamp", bronze_snapshot_id="bigint"),
}
SILVER_SCHEMAS["silver_reposts"] = SILVER_SCHEMAS["silver_likes"]


def _snapshot(bronze: DataFrame) -> Column:
    present = SNAPSHOT in bronze.columns
    return (F.col(SNAPSHOT) if present else F.lit(None)).cast("bigint").alias(SNAPSHOT)


def _parsed(record: str) -> Column:
    return F.from_json("record", record)


def silver_posts(bronze: DataFrame) -> DataFrame:
    """Creations and edits of posts."""
    posts = bronze.where(
        (F.col("collection") == c.POST) & F.col("operation").isin("create", "update")
    ).withColumn("r", _parsed(POST_RECORD))
    features = flatten_features(F.col("r.facets"))
    return posts.select(
        "seq",
        "did",
        "rkey",
        "cid",
        "operation",
        "event_time",
        try_timestamp(F.col("r.createdAt")).alias("created_at"),
        F.col("r.text").alias("text"),
        F.col("r.langs").alias("langs"),
        F.col("r.reply.parent.uri").alias("reply_parent_uri"),
        F.col("r.reply.root.uri").alias("reply_root_uri"),
        F.col("r.embed")["$type"].alias("embed_type"),
        merge_tags(features, F.col("r.tags")).alias("hashtags"),
        feature_values(features, c.FACET_MENTION, "did").alias("mention_dids"),
        "processed_at",
        _snapshot(bronze),
    )


def subject_events(bronze: DataFrame, collection: str) -> DataFrame:
    """Creations of the collections whose record points at another record."""
    created = bronze.where(
        (F.col("collection") == collection) & (F.col("operation") == "create")
    ).withColumn("r", _parsed(SUBJECT_RECORD))
    uri = F.col("r.subject.uri")
    return created.select(
        "seq",
        "did",
        "rkey",
        "cid",
        "event_time",
        try_timestamp(F.col("r.createdAt")).alias("created_at"),
        uri.alias("subject_uri"),
        at_uri_did(uri).alias("subject_did"),
        at_uri_rkey(uri).alias("subject_rkey"),
        "processed_at",
        _snapshot(bronze),
    )


def silver_likes(bronze: DataFrame) -> DataFrame:
    return subject_events(bronze, c.LIKE)


def silver_reposts(bronze: DataFrame) -> DataFrame:
    return subject_events(bronze, c.REPOST)


def silver_follows(bronze: DataFrame) -> DataFrame:
    """Creations of follows; the subject is the followed account itself."""
    created = bronze.where(
        (F.col("collection") == c.FOLLOW) & (F.col("operation") == "create")
    ).withColumn("r", _parsed(FOLLOW_RECORD))
    return created.select(
        "seq",
        "did",
        "rkey",
        "cid",
        "event_time",
        try_timestamp(F.col("r.createdAt")).alias("created_at"),
        F.col("r.subject").alias("subject_did"),
        "processed_at",
        _snapshot(bronze),
    )


def silver_deletes(bronze: DataFrame) -> DataFrame:
    """Deletions of every collection: the key of the deleted record only."""
    return bronze.where(F.col("operation") == "delete").select(
        "seq", "did", "collection", "rkey", "event_time", "processed_at", _snapshot(bronze)
    )


SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "silver_posts": silver_posts,
    "silver_likes": silver_likes,
    "silver_reposts": silver_reposts,
    "silver_follows": silver_follows,
    "silver_deletes": silver_deletes,
}
