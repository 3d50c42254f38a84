import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.sources import topics
from tidemark.sources.envelopes import bronze_parse, collection_mix


WHALE = {
    "seq": 7001,
    "did": "did:web:whale.test",
    "collection": c.FOLLOW,
    "operation": "create",
    "rkey": "deep-1",
    "rev": "3lz",
    "cid": "bafywhale",
    "time": "2031-02-03T04:05:06.070809Z",
    "record": {"subject": "did:web:krill.test", "depth": [10, 20]},
}


def wire(kind="message", without=(), **fields):
    """One message as text: the whale's follow, with some fields replaced or left out."""
    kept = {name: value for name, value in (WHALE | fields).items() if name not in without}
    return json.dumps({"payload": kept, "$type": kind}, ensure_ascii=False)


KEPT = [
    wire(),
    wire(seq=7002, collection=c.POST, record={"text": "brume ☔", "langs": []}),
    wire(seq=7003, collection=c.POST, operation="update", record={"text": ""}),
    wire(seq=7004, operation="delete", without=("record", "cid")),
    wire(seq=7005, time="2031-02-03T04:05:06Z"),
    wire(seq=7006, without=("rev",)),
]
DROPPED = [
    wire(seq=7010, without=("rkey",)),
    wire(seq=7011, without=("collection",)),
    wire(seq=7012, without=("operation",)),
    wire(without=("seq",)),
    wire(seq=7013, without=("did",)),
    wire(seq=7014, time="soon"),
    wire("identity", seq=7015),
    '"message"',
    "{",
    "",
    f"[{wire(seq=7016)}]",
]


def raw(spark, texts):
    rows = [(bytearray(t, "utf8"), n % 3, n // 3) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value binary, partition int, offset bigint")


def test_usable_messages_are_kept_in_contract_order(spark):
    rows = bronze_parse(raw(spark, KEPT + DROPPED))
    assert rows.columns == list(c.BRONZE_COLUMNS)
    assert [f.dataType for f in rows.schema] == [f.dataType for f in c.BRONZE_SCHEMA]
    found = {row["seq"]: row for row in rows.collect()}
    assert sorted(found) == [7001, 7002, 7003, 7004, 7005, 7006]
    assert json.loads(found[7002]["record"]) == {"text": "brume ☔", "langs": []}
    assert found[7001]["record"] == '{"subject":"did:web:krill.test","depth":[10,20]}'
    assert (found[7004]["record"], found[7004]["cid"], found[7006]["rev"]) == (None, None, None)
    assert (found[7003]["kafka_partition"], found[7003]["kafka_offset"]) == (2, 0)


def test_times_keep_microseconds(spark):
    row = bronze_parse(raw(spark, KEPT[:1])).select(F.unix_micros("event_time")).first()
    assert row[0] % 1_000_000 == 70809


def test_the_message_is_parsed_once(spark):
    plan = bronze_parse(raw(spark, KEPT))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_mix_labels_what_bronze_drops(spark):
    mix = {r["label"]: r["messages"] for r in collection_mix(raw(spark, KEPT + DROPPED)).collect()}
    assert mix == {
        f"{c.FOLLOW}/create": 3,
        f"{c.POST}/create": 1,
        f"{c.POST}/update": 1,
        f"{c.FOLLOW}/delete": 1,
        "other": len(DROPPED),
    }


def offsets(spark, pairs, column):
    frame = spark.createDataFrame(pairs, "partition int, offset bigint")
    return sorted(tuple(r) for r in frame.where(column).collect())


def test_end_offsets_are_exclusive_and_bind_their_partition(spark):
    pairs = [(0, 9), (0, 10), (1, 19), (1, 20), (2, 0)]
    assert offsets(spark, pairs, topics.within_offsets(None, {0: 10, 1: 20})) == [(0, 9), (1, 19)]
    assert offsets(spark, pairs, topics.within_offsets(None, {})) == []


def test_start_offsets_leave_other_partitions_whole(spark):
    pairs = [(0, 9), (0, 10), (2, 0)]
    assert offsets(spark, pairs, topics.from_start({0: 10})) == [(0, 10), (2, 0)]


def test_a_range_without_a_start_is_empty(spark):
    pairs = [(0, 4), (0, 5), (1, 5)]
    assert offsets(spark, pairs, topics.within_offsets({0: 5}, {0: 10, 1: 10})) == [(0, 5)]


def test_offsets_round_trip():
    text = topics.offsets_json("t", {1: 5, 0: 3})
    assert json.loads(text) == {"t": {"0": 3, "1": 5}}
    assert topics.offsets_of("t", text) == {0: 3, 1: 5}
    assert topics.offsets_of("t", None) is None


def test_kafka_options_cap_the_batch_and_survive_expiry():
    assert "maxOffsetsPerTrigger" not in topics.kafka_options("host:9092", "t")
    options = topics.kafka_options("host:9092", "t", '{"t":{"0":1}}', max_offsets=70)
    assert options["maxOffsetsPerTrigger"] == "70"
    assert options["failOnDataLoss"] == "false"
    assert options["startingOffsets"] == '{"t":{"0":1}}'
    assert options["subscribe"] == "t"


def test_a_slice_is_frozen_once(spark, scratch):
    start = datetime(2026, 10, 1)
    rows = [
        (bytearray(b"v"), n % 3, n, start + timedelta(seconds=30 * n)) for n in range(20)
    ]
    frame = spark.createDataFrame(rows, topics.MESSAGE_SCHEMA)
    path = scratch("slice")
    frozen = topics.freeze_slice(frame, path, start + timedelta(minutes=1), 5)
    assert sorted(r["offset"] for r in frozen.collect()) == list(range(2, 12))
    assert {r["partition"] for r in frozen.collect()} == {0, 1, 2}
    with pytest.raises(FileExistsError):
        topics.freeze_slice(frame, path, start, 5)
    with pytest.raises(topics.SliceError):
        topics.freeze_slice(frame, scratch("empty"), start + timedelta(days=1), 5)
    # A copy that failed leaves nothing behind, and the next one succeeds
    again = scratch("short")
    spark.range(3).write.parquet(f"{again}/beside")
    with pytest.raises(topics.SliceError):
        topics.freeze_slice(frame, again, start, 5, expected=11)
    assert topics.freeze_slice(frame, again, start, 5, expected=10).count() == 10
    assert spark.read.parquet(f"{again}/beside").count() == 3


def test_a_slice_starts_at_utc_whatever_the_drivers_zone(spark, scratch, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        frame = spark.range(48).selectExpr(
            "CAST('v' AS BINARY) AS value", "0 AS partition", "id AS offset",
            "TIMESTAMP '2024-01-10 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS timestamp")
        frozen = topics.freeze_slice(frame, scratch("zone"), datetime(2024, 1, 10, 5), 120)
        assert sorted(r["offset"] for r in frozen.collect()) == [5, 6]
    finally:
        monkeypatch.undo()
        time.tzset()
