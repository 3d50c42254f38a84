"""Data checks. Each returns the failing rows: no row means the check passed.

Windows on `processed_at` take an explicit moment, so a check can be repeated."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.labels import silver_model
from tidemark.operators.aggregates import having_more_than
from tidemark.operators.filters import hour_ranges_filter
from tidemark.operators.joins import join_cross_values, join_offset_range
from tidemark.operators.sets import union_all
from tidemark.sources.tables import DAY, HOUR_MICROS, CommitTable, between_times, spelled_time, time_bounds


def recent(rows: DataFrame, since: Column | None, ts: str = "processed_at") -> DataFrame:
    """Rows from a moment on; on the event time, days before it are not opened."""
    if since is None:
        return rows
    kept = rows.where(F.col(ts) >= since)
    if ts == "event_time" and DAY in rows.columns:
        kept = kept.where(F.col(DAY) >= F.to_date(since))
    return kept


def check_not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def check_unique(rows: DataFrame, column: str, since: Column | None = None) -> DataFrame:
    """Values held by several of the (recently processed) rows."""
    present = recent(rows, since).where(F.col(column).isNotNull())
    return having_more_than(present, [column])


def check_accepted_values(rows: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the list, with their number of rows; NULL is not reported."""
    return (
        rows.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def check_unique_combination(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return having_more_than(rows, columns)


def check_at_uri(
    tables: Mapping[str, DataFrame], column: str = "subject_uri", since: Column | None = None
) -> DataFrame:
    """Subjects that are no AT URI; a NULL subject is another check's business."""
    bad = ~F.col(column).rlike(c.AT_URI_PATTERN)
    return union_all(
        [
            recent(rows, since).where(bad).select(F.lit(name).alias("model"), "seq", column)
            for name, rows in tables.items()
        ]
    )


def check_silver_matches_bronze(
    bronze: DataFrame,
    silver: Mapping[str, DataFrame],
    read_up_to: Mapping[str, int] | None = None,
    since: Column | None = None,
    commit: str = "commit_id",
    hours: Sequence[int] | None = None,
) -> DataFrame:
    """Per Silver model, events missing from Silver and events absent from Bronze.

    Bronze is read once for every model, labelled with the model each row belongs to; the
    Silver tables are stacked under the same labels; one outer join by (model, seq)
    compares them. `read_up_to` is the commit each model has read: later Bronze rows do
    not count, and a model without a position expects nothing.

    With `since`, events processed from then on are checked. Both layers are read over
    the range of event times those have: copies of an event share its time. Where the caller
    knows the `hours` of those events (`hours_since`), only these are read, and no rows to find them."""
    if hours is not None:
        ranges = [(spelled_time(h * HOUR_MICROS)[:19], spelled_time((h + 1) * HOUR_MICROS)[:19]) for h in hours]
        bronze = hour_ranges_filter(bronze, ranges)
        silver = {name: hour_ranges_filter(rows, ranges) for name, rows in silver.items()}
    elif since is not None:
        found = [recent(rows, since).select("event_time") for rows in (bronze, *silver.values())]
        bounds = time_bounds(union_all(found))
        if bounds is not None:
            bronze = between_times(bronze, *bounds)
            silver = {name: between_times(rows, *bounds) for name, rows in silver.items()}
    model = silver_model(F.col("collection"), F.col("operation"))
    labelled = bronze.withColumn("model", model).where(F.col("model").isin(*silver))
    # `expected` are the rows Silver has to hold; the others only prove that an event
    # Silver holds does come from Bronze
    expected = F.lit(True) if since is None else F.col("processed_at") >= since
    if read_up_to is not None:
        limits = F.lit(None).cast("bigint")
        for name, position in read_up_to.items():
            limits = F.when(F.col("model") == name, F.lit(position)).otherwise(limits)
        labelled = labelled.withColumn("_limit", limits).where(
            F.col("_limit").isNull() | (F.col(commit) <= F.col("_limit"))
        )
        expected = expected & F.col("_limit").isNotNull()
    left = labelled.groupBy("model", "seq").agg(F.bool_or(expected).alias("in_bronze"))
    checked = F.lit(True) if since is None else F.col("processed_at") >= since
    stacked = union_all(
        [
            rows.select(F.lit(name).alias("model"), "seq", checked.alias("checked"))
            for name, rows in silver.items()
        ]
    )
    right = stacked.groupBy("model", "seq").agg(F.bool_or("checked").alias("in_silver"))
    compared = left.join(right, ["model", "seq"], "full_outer")
    counts = compared.groupBy("model").agg(
        F.count_if(F.col("in_bronze") & F.col("in_silver").isNull()).alias("missing"),
        F.count_if(F.col("in_silver") & F.col("in_bronze").isNull()).alias("extra"),
    )
    problems = {
        "missing from Silver": F.col("missing"),
        "absent from Bronze": F.col("extra"),
    }
    return (
        join_cross_values(counts, problems, "problem", "events")
        .select("model", "problem", "events")
        .where("events > 0")
    )


def hours_since(tables: Sequence[CommitTable], since: datetime, column: str = "processed_at") -> list[int]:
    """The event hours of all commits that hold a row processed from a moment on (UTC without a
    zone), from the lines of their logs: no data is read. One late row brings its own hour, and
    nothing between."""
    zoned = since if since.tzinfo else since.replace(tzinfo=timezone.utc)
    micros = int(zoned.timestamp()) * 1_000_000 + zoned.microsecond
    found = [table.commits_reaching(column, micros).select(F.explode("hours").alias("h")) for table in tables]
    # Hours grow with the time covered, not with rows
    return [r["h"] for r in union_all(found).distinct().orderBy("h").collect()]


def check_gold_matches_silver(
    silver: Mapping[str, DataFrame],
    gold: Mapping[str, DataFrame],
    pending: DataFrame | None = None,
    since_hour: Column | None = None,
) -> DataFrame:
    """Hours whose Gold likes, posts or likers differ from a recount of Silver.

    Hours a model still has to rebuild (`pending`: model, hour) are skipped."""
    likes = recent(silver["silver_likes"], since_hour, "event_time")
    posts = recent(silver["silver_posts"], since_hour, "event_time").where(
        F.col("operation") == "create"
    )
    activity = recent(gold["gold_activity_minute"], since_hour, "minute")
    engagement = recent(gold["gold_engagement_hour"], since_hour, "hour")
    users = recent(gold["gold_active_users_hour"], since_hour, "hour")

    nobody = F.lit(None).cast("string").alias("did")
    events = likes.select("event_time", F.lit(True).alias("like"), "did").unionByName(
        posts.select("event_time", F.lit(False).alias("like"), nobody)
    )
    # One recount serves the three models; accounts are those of the likes
    recount = events.groupBy(F.date_trunc("HOUR", "event_time").alias("hour")).agg(
        F.count_if("like").alias("s_likes"),
        F.count_if(~F.col("like")).alias("s_posts"),
        F.count_distinct("did").alias("s_likers"),
    )

    def creates(collection: str) -> Column:
        return F.sum(F.when(F.col("collection") == collection, F.col("creates")))

    stored = [
        activity.groupBy(F.date_trunc("HOUR", "minute").alias("hour")).agg(
            creates(c.LIKE).alias("a_likes"), creates(c.POST).alias("a_posts")
        ),
        engagement.select("hour", F.col("likes").alias("e_likes")),
        users.where(F.col("collection") == c.LIKE).select(
            "hour", F.col("active_accounts").alias("u_likers")
        ),
    ]
    hours = recount
    for side in stored:
        hours = hours.join(side, "hour", "full_outer")

    def differ(a: str, b: str) -> Column:
        return F.coalesce(F.col(a), F.lit(0)) != F.coalesce(F.col(b), F.lit(0))

    def result(model: str, silver_value: Column, gold_value: str, wrong: Column) -> Column:
        return F.struct(
            F.lit(model).alias("model"),
            silver_value.alias("silver_value"),
            F.col(gold_value).alias("gold_value"),
            wrong.alias("wrong"),
        )

    none = F.lit(0)
    results = F.array(
        result(
            "gold_activity_minute",
            F.col("s_likes"),
            "a_likes",
            differ("s_likes", "a_likes") | differ("s_posts", "a_posts"),
        ),
        result(
            "gold_engagement_hour",
            F.nullif("s_likes", none),
            "e_likes",
            differ("s_likes", "e_likes"),
        ),
        result(
            "gold_active_users_hour",
            F.nullif("s_likers", none),
            "u_likers",
            differ("s_likers", "u_likers"),
        ),
    )
    found = hours.select("hour", F.inline(results)).where("wrong")
    found = found.select("model", "hour", "silver_value", "gold_value")
    if pending is None:
        return found
    return found.join(pending.select("model", "hour").distinct(), ["model", "hour"], "left_anti")


def completeness(bronze: DataFrame, bounds: DataFrame) -> DataFrame:
    """Per partition of a closed day: messages expected, found and missing in Bronze.

    `bounds` has kafka_partition, start_offset, end_offset (exclusive); a partition
    without a start expects nothing. Copies of a message count once."""
    start = F.coalesce("start_offset", "end_offset")
    ranges = bounds.select("kafka_partition", start.alias("start_offset"), "end_offset")
    inside = join_offset_range(bronze.select("kafka_partition", "kafka_offset"), ranges)
    found = inside.groupBy("kafka_partition").agg(F.count_distinct("kafka_offset").alias("found"))
    expected = F.col("end_offset") - F.col("start_offset")
    counted = F.coalesce("found", F.lit(0))
    return ranges.join(found, "kafka_partition", "left").select(
        "kafka_partition",
        expected.alias("expected"),
        counted.alias("found"),
        (expected - counted).alias("missing"),
    )


def expected_messages(bounds: DataFrame) -> DataFrame:
    """Messages of a day over its partitions; NULL until the day is closed."""
    start = F.coalesce("start_offset", "end_offset")
    return bounds.agg(F.sum(F.col("end_offset") - start).alias("messages"))


def bounds_reached(positions: DataFrame, bounds: DataFrame) -> DataFrame:
    """Whether every partition's next offset is at or past its end; a partition with no
    position has not started."""
    reached = F.coalesce("position", F.lit(-1)) >= F.col("end_offset")
    return (
        bounds.join(positions, "kafka_partition", "left")
        .agg(F.coalesce(F.bool_and(reached), F.lit(True)).alias("reached"))
    )


@dataclass(frozen=True)
class Check:
    """A declared check of a model: what its rows have to hold, and how grave a failure is."""

    model: str
    kind: str
    columns: tuple[str, ...]
    accepted: tuple[str, ...] = ()
    severity: str = "error"
    recent_only: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind} {','.join(self.columns)}"


def _declared() -> tuple[Check, ...]:
    found = []
    for model, (filled, warned) in SILVER_FILLED.items():
        found.append(Check(model, "unique", ("seq",), recent_only=True))
        found += [Check(model, "not_null", (name,)) for name in (*ALWAYS_FILLED, *filled)]
        found += [Check(model, "not_null", (name,), severity="warn") for name in warned]
    for model, (filled, unique) in GOLD_FILLED.items():
        found += [Check(model, "not_null", (name,)) for name in filled]
        found += [Check(model, "unique", columns) for columns in unique]
    for (model, column), (accepted, recent_only) in ACCEPTED.items():
        found.append(Check(model, "accepted", (column,), accepted, recent_only=recent_only))
    return tuple(found)


# Columns that are never NULL in any Silver model, in one of them, and those that
# only warn
ALWAYS_FILLED = ("seq", "did", "event_time", "bronze_snapshot_id")
SILVER_FILLED = {
    "silver_posts": ((), ()),
    "silver_likes": ((), ("subject_uri",)),
    "silver_reposts": ((), ("subject_uri",)),
    "silver_follows": ((), ("subject_did",)),
    "silver_deletes": (("rkey",), ()),
}
# Columns of Gold that are never NULL, and combinations that are unique
GOLD_FILLED = {
    "gold_activity_minute": (("minute", "creates", "deletes"), (("minute", "collection"),)),
    "gold_langs_hour": (("hour", "lang", "posts"), (("hour", "lang"),)),
    "gold_hashtags_hour": (("hour", "hashtag", "rank"), (("hour", "hashtag"), ("hour", "rank"))),
    "gold_active_users_hour": (("hour", "active_accounts"), (("hour", "collection"),)),
    "gold_engagement_hour": (("hour", "likes", "net_likes"), (("hour",),)),
}
# The values a column may have, and whether only recent rows are looked at
ACCEPTED = {
    ("silver_posts", "operation"): (("create", "update"), True),
    ("silver_deletes", "collection"): (c.COLLECTIONS, True),
    ("gold_activity_minute", "collection"): (c.COLLECTIONS, False),
    ("gold_active_users_hour", "collection"): (("all", *c.COLLECTIONS), False),
}
SUITE = _declared()


def run_suite(
    tables: Mapping[str, DataFrame], since: Column | None = None, suite: Sequence[Check] = SUITE
) -> DataFrame:
    """model, check, severity, failures of every declared check of the given tables.

    NULLs and unaccepted values of a model are counted in one scan of it; each uniqueness is an
    aggregate of its own. With `since`, the checks that look at recent rows only begin there."""
    found = []
    for model in dict.fromkeys(check.model for check in suite):
        if model not in tables:
            continue
        rows, own = tables[model], [check for check in suite if check.model == model]
        flags = {}
        for check in own:
            column = F.col(check.columns[0])
            bad = column.isNull() if check.kind == "not_null" else ~column.isin(*check.accepted)
            if check.recent_only and since is not None and check.kind == "accepted":
                bad = bad & (F.col("processed_at") >= since)
            if check.kind != "unique":
                flags[check] = F.count_if(bad)
        entries = [
            F.struct(F.lit(k.name).alias("check"), F.lit(k.severity).alias("severity"), n.alias("failures"))
            for k, n in flags.items()
        ]
        found.append(rows.agg(F.array(*entries).alias("checks")).select(F.lit(model).alias("model"), F.inline("checks")))
        for check in own:
            if check.kind == "unique":
                looked_at = recent(rows, since) if check.recent_only else rows
                present = looked_at.dropna(subset=list(check.columns))
                count = having_more_than(present, check.columns).agg(F.count(F.lit(1)).alias("failures"))
                found.append(count.select(F.lit(model).alias("model"), F.lit(check.name).alias("check"),
                                          F.lit(check.severity).alias("severity"), "failures"))
    return union_all(found)
