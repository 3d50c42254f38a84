"""The streaming source over a message log."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import message_log as ml


def messages(spark, start, end, partitions=(0, 1, 2)):
    rows = spark.range(start, end).withColumn("partition", F.explode(F.array(*map(F.lit, partitions))))
    return rows.select(
        F.concat_ws("-", "partition", "id").cast("binary").alias("value"), "partition",
        F.col("id").alias("offset"), F.timestamp_seconds(F.col("id")).alias("timestamp"))


@pytest.fixture
def log(spark, scratch):
    path = scratch("log")
    ml.write_log(messages(spark, 0, 100), path, 10)
    return path


def reader(path, **options):
    return ml.MessageLogReader({"path": path, **{k.lower(): str(v) for k, v in options.items()}})


def test_starts_expired_and_unknown(log):
    ml.drop_segments(log, {1: 35})
    starting = json.dumps({"0": 42, "1": 7, "2": ml.LATEST})
    assert reader(log, starting=starting).initialOffset() == {"0": 42, "1": 30, "2": 100}
    assert reader(log).initialOffset() == {"0": 0, "1": 30, "2": 0}
    assert reader(log, default=ml.LATEST).initialOffset() == {"0": 100, "1": 100, "2": 100}
    assert sorted(ml.segments(log)[1]) == [30, 40, 50, 60, 70, 80, 90]


@pytest.mark.parametrize(
    "left, most, taken",
    [({0: 5, 1: 5}, None, {0: 5, 1: 5}), ({0: 90, 1: 10}, 10, {0: 9, 1: 1}), ({0: 1, 1: 1, 2: 1}, 2, {0: 1, 1: 1, 2: 0}),
     ({0: 0, 1: 100}, 7, {0: 0, 1: 7}), ({}, 5, {}), ({0: 3}, 100, {0: 3})],
)
def test_a_batch_is_dealt_in_proportion(left, most, taken):
    assert ml.dealt(left, most) == taken


def test_batches_take_so_many_and_segments_split_them(log, scratch, tmp_path):
    own = reader(log, maxOffsetsPerTrigger=31, progress=f"{tmp_path}/p.json")
    start, seen = own.initialOffset(), set()
    for _ in range(20):
        end = own.latestOffset()
        if end == start:
            break
        ranges = own.partitions(start, end)
        rows = [r for part in ranges for batch in own.read(part) for r in batch.to_pylist()]
        assert 0 < len(rows) <= 31 and all(r.end - r.start <= 10 for r in ranges)
        assert not seen & {(r["partition"], r["offset"]) for r in rows}
        seen |= {(r["partition"], r["offset"]) for r in rows}
        start = end
        # Another reader goes on where the last batch ended
        own = reader(log, maxOffsetsPerTrigger=31, progress=f"{tmp_path}/p.json")
    assert len(seen) == 300


def test_loss_and_foreign_progress_are_reported(log, tmp_path):
    ml.drop_segments(log, {0: 50})
    strict = reader(log, failOnDataLoss="true")
    with pytest.raises(ValueError, match="are gone"):
        strict.partitions({"0": 10}, {"0": 80})
    assert [(r.start, r.end) for r in reader(log).partitions({"0": 10}, {"0": 65})] == [(50, 60), (60, 65)]
    with pytest.raises(ValueError, match="goes back"):
        reader(log).partitions({"0": 10}, {"0": 5})


def test_gaps_in_offsets(spark, scratch):
    path = scratch("gaps")
    ml.write_log(messages(spark, 0, 100, [4]).where("offset % 10 = 3 OR offset < 5"), path, 20)
    own = reader(path, maxOffsetsPerTrigger=40)
    assert own.initialOffset() == {"4": 0} and own.latestOffset() == {"4": 40}
    found = [r["offset"] for part in own.partitions({"4": 0}, {"4": 40}) for b in own.read(part) for r in b.to_pylist()]
    assert found == [0, 1, 2, 3, 4, 13, 23, 33]


def drained(spark, path, folder, **options):
    stream = ml.read_message_log(spark, path, f"{folder}/checkpoint", **options)
    batches = []

    def keep(rows, batch):
        batches.append((batch, rows.count()))
        rows.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")

    running = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return batches


def test_a_stream_goes_on_after_a_restart(spark, scratch, log):
    folder = scratch("stream")
    ml.drop_segments(log, {1: 35})
    options = {"starting": {0: 40, 1: 7}, "max_offsets": 50}
    first = drained(spark, log, folder, **options)
    assert [b for b, _ in first] == list(range(len(first))) and all(0 < n <= 50 for _, n in first)
    assert sum(n for _, n in first) == 60 + 70 + 100
    # Nothing new: nothing comes twice
    assert drained(spark, log, folder, **options) == []
    # More of the same partitions, and a partition that is new
    ml.write_log(messages(spark, 100, 125), log, 10)
    ml.write_log(messages(spark, 0, 5, [7]), log, 10)
    second = drained(spark, log, folder, **options)
    assert sum(n for _, n in second) == 3 * 25 + 5 and second[0][0] == len(first)
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == out.select("partition", "offset").distinct().count() == 310
    assert out.where("value <> cast(concat_ws('-', partition, offset) AS BINARY) OR unix_seconds(timestamp) <> offset").count() == 0


def test_a_batch_that_failed_comes_again(spark, scratch, log):
    folder = scratch("failed")
    stream = ml.read_message_log(spark, log, f"{folder}/checkpoint", max_offsets=100)
    seen = []

    def fail_once(rows, batch):
        seen.append((batch, sorted((r["partition"], r["offset"]) for r in rows.select("partition", "offset").collect())))
        if batch == 1 and len(seen) == 2:
            raise RuntimeError("node lost")

    for _ in range(2):
        running = stream.writeStream.foreachBatch(fail_once).option("checkpointLocation", f"{folder}/checkpoint").start()
        try:
            running.processAllAvailable()
        except Exception:
            pass
        finally:
            running.stop()
    assert [b for b, _ in seen] == [0, 1, 1, 2] and seen[1] == seen[2]
    assert len({x for _, rows in seen for x in rows}) == 300
