"""Topics: the raw message stream, its offset maps and frozen slices."""

import json
from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import delete_path, path_exists, utc

Offsets = Mapping[int, int]

MESSAGE_SCHEMA = "value binary, partition int, offset bigint, timestamp timestamp"


def offsets_json(topic: str, offsets: Offsets) -> str:
    """Start or end offsets in the form the Kafka source takes."""
    by_partition = {str(p): int(offset) for p, offset in sorted(offsets.items())}
    return json.dumps({topic: by_partition})


def offsets_of(topic: str, text: str | None) -> dict[int, int] | None:
    if not text:
        return None
    return {int(p): int(offset) for p, offset in json.loads(text)[topic].items()}


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of a topic read from `starting` that carries on from the oldest retained offset
    when its own has expired. With `max_offsets` a micro-batch reads so many at the most."""
    capped = {} if max_offsets is None else {"maxOffsetsPerTrigger": str(max_offsets)}
    return capped | {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream a topic. The Kafka connector has to be on the class path."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def read_message_files(
    spark: SparkSession, path: str, starting: Offsets | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream the same messages from files: those at or after each partition's start. With
    `max_files` a micro-batch reads so many files at the most."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    return stream if starting is None else stream.where(from_start(starting))


def within_offsets(
    start: Offsets | None, end: Offsets | None, partition: str = "partition", offset: str = "offset"
) -> Column:
    """In [start, end) of the row's partition, as values a scan can prune by.

    Without `start` or `end` that side is open for every partition. A partition that `start` does
    not name is read from its beginning where only starts are given; one that `end` does not name
    keeps nothing; one that `end` names and a given `start` doesn't is empty."""
    place, at = F.col(partition), F.col(offset)
    if end is None:
        named = [(place == p) & (at < low) for p, low in (start or {}).items()]
        return ~reduce(or_, named, F.lit(False))
    lows = {p: None for p in end} if start is None else start
    ranges = [
        (place == p) & (at < high) & (F.lit(True) if lows[p] is None else at >= lows[p])
        for p, high in end.items()
        if p in lows
    ]
    return reduce(or_, ranges, F.lit(False))


def from_start(start: Offsets, partition: str = "partition", offset: str = "offset") -> Column:
    """At or after the partition's start; a partition without one is kept whole."""
    return within_offsets(start, None, partition, offset)


class SliceError(RuntimeError):
    """The slice is empty or was not copied whole."""


def freeze_slice(
    messages: DataFrame, path: str, start: datetime, minutes: int, expected: int | None = None
) -> DataFrame:
    """Copy the messages of [start, start + minutes) once and return the copy.

    A path that holds a slice is refused (a frozen slice never changes). The copy keeps the
    messages' partition and is laid out by it. It is written aside, counted there against
    `expected` where given, and else against what the write itself saw, and becomes the slice when
    its mark is written; a copy that failed is dropped, and nothing else below the path. A start without a zone is UTC."""
    spark, mark = messages.sparkSession, f"{path}/slice_mark"
    if path_exists(spark, mark):
        raise FileExistsError(f"{path} holds a frozen slice")
    end = start + timedelta(minutes=minutes)
    sliced = messages.where((F.col("timestamp") >= utc(start)) & (F.col("timestamp") < utc(end)))
    # The frozen copy is written with one more column for the layout, so that reading it
    # back gives `partition` as data
    seen = Observation()
    laid_out = sliced.withColumn("topic_partition", F.col("partition"))
    counted = laid_out.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite").partitionBy("topic_partition").parquet(f"{path}/messages")
    frozen = spark.read.schema(laid_out.schema).parquet(f"{path}/messages").drop("topic_partition")
    copied = frozen.count()
    wanted = seen.get.get("n", 0) if expected is None else expected
    if copied == 0 or copied != wanted:
        delete_path(spark, f"{path}/messages")
        raise SliceError(f"copied {copied} messages between {start} and {end}, expected {wanted}")
    spark.range(1).write.parquet(mark)
    return frozen
