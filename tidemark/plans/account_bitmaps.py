"""Exact distinct accounts that can be merged: bitmaps of account numbers.

An account gets a number once, from a dictionary that only grows. What an update brings is kept as
bitmaps per (hour, collection, block of numbers), built and joined by Spark's own bitmap aggregates.
A late commit adds bitmaps to its hours and reads nothing of what they held, and any span of hours
is counted exactly by joining theirs."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.plans.gold import GOLD_INPUTS, created_events
from tidemark.session import scratch_path
from tidemark.sources.logs import FOLD, Line, LineLog
from tidemark.sources.tables import CommitTable, PartTable, delete_path

UPDATE = "update_id"
INPUTS = GOLD_INPUTS["gold_active_users_hour"]
ACCOUNTS_SCHEMA = c.schema(did="string", account="bigint")
BITMAPS_SCHEMA = c.schema(hour="timestamp", collection="string", block="bigint", bits="binary")


class AccountBitmaps:
    """The dictionary, the bitmaps and the positions read, below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.accounts = PartTable(spark, f"{root}/accounts", UPDATE)
        self.bitmaps = PartTable(spark, f"{root}/bitmaps", UPDATE)
        self.log = LineLog(spark, f"{root}/updates")

    def positions(self) -> dict[str, int]:
        return last_positions(*self.log.read())

    def update(self, silver: Mapping[str, CommitTable]) -> bool:
        """Add what was appended to the Silver tables since the last update; whether there was
        anything. An update that stopped half way is done again over the same parts."""
        done = self.positions()
        current = {name: silver[name].current() for name in INPUTS}
        new = {n: p for n, p in current.items() if p is not None and done.get(n, -1) < p}
        if not new:
            return False
        number = str(1 + (self.log.last() if self.log.last() is not None else -1))
        rows = {
            name: silver[name].appended(done.get(name), new[name])
            if name in new
            else self.spark.createDataFrame([], silver[name].schema)
            for name in INPUTS
        }
        # An account that acts a lot is one row an hour and collection before it meets its number
        hour = F.date_trunc("HOUR", "event_time").alias("hour")
        seen = created_events(rows, "event_time", "did").where(F.col("did").isNotNull())
        aside = scratch_path(self.spark, "active")
        seen.select(hour, "collection", "did").distinct().write.parquet(aside)
        seen = self.spark.read.parquet(aside)
        known = self.accounts.read(ACCOUNTS_SCHEMA).where(F.col(UPDATE) != number)
        unknown = seen.select("did").distinct().join(known, "did", "left_anti")
        self.accounts.replace(self._numbered(unknown, known).withColumn(UPDATE, F.lit(number)), [number])
        numbers = self.accounts.read(ACCOUNTS_SCHEMA).select("did", "account")
        self.bitmaps.replace(bitmaps_of(seen.join(numbers, "did")).withColumn(UPDATE, F.lit(number)), [number])
        if self.log.append({"positions": new}) >= FOLD:
            self.log.fold(lambda head, lines: {"positions": last_positions(head, lines)})
        delete_path(self.spark, aside)
        return True

    def _numbered(self, unknown: DataFrame, known: DataFrame) -> DataFrame:
        """Dense numbers above those given out, without a sort of all accounts: each partition
        counts its own, and starts where the ones before it end."""
        aside = scratch_path(self.spark, "accounts")
        place = F.monotonically_increasing_id()
        unknown.withColumn("_place", place).write.parquet(aside)
        rows = self.spark.read.parquet(aside)
        part, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit(2**33 - 1))
        # A line a partition
        counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
        first = (known.agg(F.max("account")).first()[0] or 0) + 1
        starts: dict[int, int] = {}
        for line in counts:
            starts[line["part"]] = first
            first += line["n"]
        if not starts:
            return rows.select("did", F.lit(None).cast("bigint").alias("account"))
        start = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])[part]
        return rows.select("did", (start + at).cast("bigint").alias("account"))

    def merge(self) -> None:
        """Join the bitmaps of all updates into one part."""
        parts = self.bitmaps.current()
        if len(parts) > 1:
            last = max(parts, key=int)
            merged = self.bitmaps.read(BITMAPS_SCHEMA).groupBy("hour", "collection", "block")
            self.bitmaps.replace(merged.agg(F.bitmap_or_agg("bits").alias("bits")).withColumn(UPDATE, F.lit(last)), parts)
            self.bitmaps.drop_keys(set(parts) - {last})

    def active(self, span: Column | None = None) -> DataFrame:
        """hour, collection, active_accounts: exact distinct accounts per hour, or per any other
        span of whole hours (a column over `hour`), by collection and over all of them (`all`)."""
        bits = self.bitmaps.read(BITMAPS_SCHEMA)
        spans = bits.withColumn("hour", F.col("hour") if span is None else span)
        both = spans.unionByName(spans.withColumn("collection", F.lit("all")))
        joined = both.groupBy("hour", "collection", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
        counts = joined.groupBy("hour", "collection").agg(F.sum(F.bitmap_count("bits")).alias("active_accounts"))
        return counts


def bitmaps_of(rows: DataFrame) -> DataFrame:
    """(hour, collection, block, bits) of rows with an account number."""
    block = F.bitmap_bucket_number("account").alias("block")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("account")).alias("bits")
    return rows.groupBy("hour", "collection", block).agg(bits)


def last_positions(head: Line, lines: Mapping[int, Line]) -> dict[str, int]:
    found = dict(head.get("positions", {}))
    for line in lines.values():
        found |= line["positions"]
    return found
