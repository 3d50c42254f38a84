"""A message log in files, and a streaming source over it.

`write_log` lays messages out as a topic keeps them: a folder for each partition of the topic, in it
a segment for every range of offsets. Retention deletes whole segments. The source streams such a
folder as a broker's topic is streamed: each partition has an offset of its own, a stream starts
where it is told to (at the oldest offset left where that one has expired), a micro-batch takes so
many offsets at the most, and a stream that is started again goes on where its last batch ended.

No server is involved: the driver lists folder names, and each task reads the segments of a range
of offsets as Arrow batches through pyarrow's file systems."""

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.session import ship_package

SEGMENT_OFFSETS = 100_000
# The offsets that stand for the oldest one left and for the next one written
EARLIEST, LATEST = -2, -1

MESSAGE_SCHEMA = "value binary, partition int, offset bigint, timestamp timestamp"
ARROW_SCHEMA = pa.schema(
    {"value": pa.binary(), "partition": pa.int32(), "offset": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}
)

Positions = dict[str, int]  # offset by partition, as JSON keeps it


def write_log(messages: DataFrame, path: str, segment_offsets: int = SEGMENT_OFFSETS) -> None:
    """Write messages (`value`, `partition`, `offset`, `timestamp`) as a log, or add to one: the
    files of a segment that is written again stand beside its first ones."""
    segment = F.floor(F.col("offset") / segment_offsets) * segment_offsets
    rows = messages.select("value", "partition", "offset", F.col("timestamp").cast("timestamp").alias("timestamp"))
    rows = rows.withColumns({"topic_partition": F.col("partition"), "segment": segment.cast("bigint")})
    (
        rows.repartition("topic_partition", "segment")
        .sortWithinPartitions("topic_partition", "segment", "offset")
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy("topic_partition", "segment")
        .parquet(path)
    )


def drop_segments(path: str, below: Mapping[int, int]) -> int:
    """Retention of a log: delete the segments of a partition that end at or before an offset, the
    last one excepted; returns how many."""
    gone = 0
    for partition, own in segments(path).items():
        firsts = sorted(own)
        for first, after in zip(firsts, firsts[1:], strict=False):
            if after <= below.get(partition, 0):
                system, name = opened(own[first])
                system.delete_dir(name)
                gone += 1
    return gone


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def folders(path: str, name: str) -> dict[int, str]:
    """{n: path} of the folders `name=<n>` in a folder; names only."""
    system, root = opened(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return {
        int(info.base_name.split("=", 1)[1]): f"{path.rstrip('/')}/{info.base_name}"
        for info in found
        if info.type == fs.FileType.Directory and info.base_name.startswith(f"{name}=")
    }


def segments(path: str) -> dict[int, dict[int, str]]:
    """{partition: {first offset: folder}} of a log."""
    return {p: folders(folder, "segment") for p, folder in folders(path, "topic_partition").items()}


def segment_scan(folder: str) -> ds.Dataset:
    system, root = opened(folder)
    return ds.dataset(root, schema=ARROW_SCHEMA, format="parquet", filesystem=system)


def end_of(folder: str) -> int:
    """One past the last offset in a segment, from the statistics in its files' footers."""
    ends = [0]
    for piece in segment_scan(folder).get_fragments():
        at = piece.physical_schema.get_field_index("offset")
        for group in range(piece.metadata.num_row_groups):
            ends.append(piece.metadata.row_group(group).column(at).statistics.max + 1)
    return max(ends)


@dataclass(frozen=True)
class LogRange(InputPartition):
    """Offsets [start, end) of one segment."""

    folder: str
    start: int
    end: int


class MessageLogReader(DataSourceStreamReader):
    """Offsets are objects {partition: next offset}, with keys in order.

    Spark asks for the latest offset without saying where the stream stands, so the end of the last
    planned batch is the source's own state: kept here, and in the file `progress` for the next
    start. The file is written when a batch is planned, after Spark has logged its offsets; a batch
    that Spark plans again after a crash writes the same state."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"]
        self.progress = options.get("progress")
        self.starting = json.loads(options.get("starting", "{}"))
        self.default = int(options.get("default", EARLIEST))
        self.most = int(options["maxoffsetspertrigger"]) if "maxoffsetspertrigger" in options else None
        self.fail_on_loss = options.get("failondataloss", "false").lower() == "true"
        self.planned = self._stored()

    def _stored(self) -> Positions | None:
        if self.progress is None:
            return None
        system, name = opened(self.progress)
        if system.get_file_info(name).type == fs.FileType.NotFound:
            return None
        with system.open_input_file(name) as file:
            return json.loads(file.read())

    def _store(self, positions: Positions) -> None:
        self.planned = positions
        if self.progress is None:
            return
        system, name = opened(self.progress)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        aside = f"{name}.{uuid.uuid4().hex}"
        with system.open_output_stream(aside) as out:
            out.write(json.dumps(positions).encode())
        system.move(aside, name)

    def _start(self, partition: int, own: Mapping[int, str]) -> int:
        """Where a partition is read from: its own start, the oldest offset left if that expired."""
        wanted = int(self.starting.get(str(partition), self.default))
        if wanted == LATEST:
            return end_of(own[max(own)])
        return max(wanted, min(own))

    def initialOffset(self) -> dict:
        found = {p: self._start(p, own) for p, own in segments(self.path).items() if own}
        return {str(p): found[p] for p in sorted(found)}

    def latestOffset(self) -> dict:
        """The end of the next batch: all there is, or as many offsets as one may have, dealt to
        the partitions in proportion to what each has left."""
        log = {p: own for p, own in segments(self.path).items() if own}
        at = self.planned if self.planned is not None else self.initialOffset()
        starts = {p: at[str(p)] if str(p) in at else min(own) for p, own in log.items()}
        ends = {p: max(starts[p], end_of(own[max(own)])) for p, own in log.items()}
        gone = {int(p): offset for p, offset in at.items() if int(p) not in log}
        # An expired start goes on at the oldest offset left, which costs no share of a batch
        floors = {p: max(starts[p], min(own)) for p, own in log.items()}
        taken = dealt({p: ends[p] - min(floors[p], ends[p]) for p in log}, self.most)
        reached = gone | {p: min(ends[p], floors[p] + n) if n else starts[p] for p, n in taken.items()}
        return {str(p): reached[p] for p in sorted(reached)}

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        log, found = segments(self.path), []
        for name, stop in end.items():
            own = log.get(int(name), {})
            low = start.get(name, min(own, default=0))
            if stop < low:
                raise ValueError(f"partition {name} goes back from {low} to {stop}: {self.progress} is not of this checkpoint")
            if stop > low and (not own or min(own) > low) and self.fail_on_loss:
                raise ValueError(f"offsets from {low} of partition {name} are gone")
            firsts = [*sorted(own), stop]
            found += [
                LogRange(own[first], max(low, first), min(stop, after))
                for first, after in zip(firsts, firsts[1:], strict=False)
                if max(low, first) < min(stop, max(after, first))
            ]
        self._store(end)
        return found

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        offset = ds.field("offset")
        inside = (offset >= partition.start) & (offset < partition.end)
        yield from segment_scan(partition.folder).to_batches(filter=inside)


def dealt(left: Mapping[int, int], most: int | None) -> dict[int, int]:
    """How many offsets each partition takes: all, or `most` together in proportion to what is
    left, what rounding leaves over going to the lowest partitions that have more."""
    total = sum(left.values())
    if most is None or total <= most:
        return dict(left)
    taken = {p: n * most // total for p, n in left.items()}
    over = most - sum(taken.values())
    for p in sorted(left):
        more = min(over, left[p] - taken[p], 1)
        taken[p] += more
        over -= more
    return taken


class MessageLogSource(DataSource):
    """Options: `path`; `starting`, JSON of offsets by partition, and `default` for the others
    (-2 the oldest, -1 the next); `maxOffsetsPerTrigger`; `progress`, a file that belongs to the
    stream's checkpoint; `failOnDataLoss`."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def streamReader(self, schema) -> MessageLogReader:
        return MessageLogReader(dict(self.options))


def read_message_log(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    starting: Mapping[int, int] | None = None,
    default: int = EARLIEST,
    max_offsets: int | None = None,
    fail_on_loss: bool = False,
) -> DataFrame:
    """Stream a message log; `checkpoint` is the one its query will be started with. Spark drains
    what is there with `processAllAvailable`; the trigger `availableNow` takes one batch."""
    ship_package(spark)
    spark.dataSource.register(MessageLogSource)
    options = {
        "path": path,
        "progress": f"{checkpoint}/message_log.json",
        "starting": json.dumps({str(p): offset for p, offset in (starting or {}).items()}),
        "default": str(default),
        "failOnDataLoss": str(fail_on_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return spark.readStream.format("message_log").options(**options).load()
