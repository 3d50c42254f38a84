"""WARC archives with a two-level capture index.

Records are gzip members of .warc.gz files that the tasks write. The index holds a line per
record, sorted by reversed-host URL key: lines are cut into compressed blocks, and the end of each
index file is a sparse directory, the first key of every block. A lookup is a binary search in the
list of index files, one in a directory, a range read of the block, one in its lines, and a range
read of the record."""

import bisect
import gzip
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.files import new_file, open_file
from tidemark.session import scratch_path

LEAST_REVISIT = 1000  # bytes: smaller payloads are always written in full
LINES_PER_BLOCK = 3000
CAPTURED = "2024-01-01T00:00:00Z"

CAPTURES = "key string, page_id bigint, path string, at bigint, size bigint"
INDEX_FILES = "part int, path string, first_key string, captures bigint"
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_TAIL = struct.Struct("<QQ4s")
_MARK = b"CIX1"


def directory_bytes(directory: list, at: int) -> bytes:
    """The end of an index file: its directory, and where that starts."""
    raw = zlib.compress(json.dumps(directory, ensure_ascii=False).encode())
    return raw + _TAIL.pack(at, len(raw), _MARK)


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: `com,example,www)/a?b`. No scheme, port of the scheme,
    user or fragment. A null or unusable URL has the key of its text."""
    try:
        parts = urlsplit(url or "")
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url or ""
    if not host:
        return url or ""
    place = "" if port in (None, {"http": 80, "https": 443}.get(parts.scheme)) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + place + ")" + (parts.path or "/") + query


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", CAPTURED),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", f"<urn:page:{refers_to}>" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields if v is not None) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(member: bytes) -> dict:
    """A record's row, and its payload (None for a revisit)."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != stated):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload it states")

    def page(name: str) -> int | None:
        value = fields.get(name, "<urn:page:none>")[len("<urn:page:") : -1]
        return None if value == "none" else int(value)

    return {
        "page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": stated, "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
        "payload": None if revisit else payload,
    }


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for a response).

    Digests that repeat among large payloads are found on ids and digests alone, pre-aggregated
    before their shuffle; the join back has one row per repeated digest on the small side, and AQE
    splits a digest that a third of all pages share. Rows that repeat the largest page_id are all
    responses, and so are pages that have no id where none of their copies has one."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    large = rows.filter(F.octet_length("payload") >= LEAST_REVISIT)
    first = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
    first = first.filter("copies > 1").drop("copies")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_records(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives; a capture (key, page_id, path, at, size) for each record."""

    def write(batches):
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        path, at = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0
        with new_file(path) as out:
            batch = first
            while batch is not None:
                found = {name: [] for name in ("key", "page_id", "path", "at", "size")}
                for row in zip(*(batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                    page_id, url, payload, digest, refers_to = (v.as_py() for v in row)
                    member = record_bytes(page_id, url, payload, digest, refers_to)
                    out.write(member)
                    for name, value in zip(found, (url_key(url), page_id, path, at, len(member)), strict=True):
                        found[name].append(value)
                    at += len(member)
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)], list(found))
                batch = next(batches, None)

    return stored(planned(pages).mapInArrow(write, CAPTURES), "captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sort the captures by key into index files; a row per file. A key that many captures share is
    split over files by page_id."""
    order = ["key", "page_id", "path", "at"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches):
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.cix"
        directory, at, lines, total, low = [], 0, [], 0, None

        def block() -> None:
            nonlocal at
            raw = zlib.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode())
            out.write(raw)
            directory.append([lines[0][0], at, len(raw)])
            at += len(raw)
            lines.clear()

        with new_file(path) as out:
            batch = first
            while batch is not None:
                for row in zip(*(batch.column(n).to_pylist() for n in ("key", "page_id", "path", "at", "size")), strict=True):
                    low = row[0] if low is None else low
                    lines.append(list(row))
                    total += 1
                    if len(lines) == LINES_PER_BLOCK:
                        block()
                batch = next(batches, None)
            if lines:
                block()
            out.write(directory_bytes(directory, at))
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "path": [path], "first_key": [low], "captures": [total]})

    return stored(ranged.mapInArrow(write, INDEX_FILES), "capture-index")


class IndexFile:
    """One open index file; holds its directory."""

    def __init__(self, file) -> None:
        self.file = file
        at, size, mark = _TAIL.unpack(file.read_at(_TAIL.size, file.size() - _TAIL.size))
        if mark != _MARK:
            raise ValueError("not a capture index")
        self.directory = json.loads(zlib.decompress(file.read_at(size, at)))
        self.keys = [key for key, _, _ in self.directory]

    def block(self, number: int) -> list[list]:
        _, at, size = self.directory[number]
        return [json.loads(x) for x in zlib.decompress(self.file.read_at(size, at)).split(b"\n")]

    def find(self, key: str) -> Iterator[list]:
        """Captures of a key; the blocks before the first that may hold it are not read."""
        for number in range(max(0, bisect.bisect_left(self.keys, key) - 1), len(self.keys)):
            if self.keys[number] > key:
                return
            lines = self.block(number)
            at = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while at < len(lines) and lines[at][0] == key:
                yield lines[at]
                at += 1


def read_index(files: DataFrame) -> DataFrame:
    """All captures, read back from the index files block by block."""

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    index = IndexFile(file)
                    for number in range(len(index.directory)):
                        columns = zip(*index.block(number), strict=True)
                        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                            ["key", "page_id", "path", "at", "size"])

    return files.select("path").repartition(F.col("path")).mapInArrow(read, CAPTURES)


def read_records(captures: DataFrame) -> DataFrame:
    """The records of captures, by range reads in file order. The payload of a revisit is null."""

    def read(batches):
        held, file, closing = None, None, None
        for batch in batches:
            out = {name: [] for name in (*RECORDS_ORDER, "payload")}
            for path, at, size in zip(*(batch.column(n).to_pylist() for n in ("path", "at", "size")), strict=True):
                if path != held:
                    if closing:
                        closing.__exit__(None, None, None)
                    closing, held = open_file(path), path
                    file = closing.__enter__()
                row = parse_record(file.read_at(size, at))
                for name, value in row.items():
                    out[name].append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))
        if closing:
            closing.__exit__(None, None, None)

    dealt = captures.repartition("path").sortWithinPartitions("path", "at")
    return dealt.mapInArrow(read, RECORDS + ", payload binary")


RECORDS_ORDER = tuple(part.split()[0] for part in RECORDS.split(", "))


def find_captures(files: DataFrame, url: str) -> list[dict]:
    """The records of one URL. `files` has a row per index file: its first keys are searched, and
    only files that may hold the key are opened."""
    key, found = url_key(url), []
    below = files.filter(F.col("first_key") < key).agg(F.max("part")).first()[0]
    candidates = files.filter((F.col("first_key") == key) | (F.col("part") == F.lit(below))).orderBy("part")
    for row in candidates.select("path").collect():  # more than one where the key is split over files
        with open_file(row["path"]) as index:
            for _, _, path, at, size in IndexFile(index).find(key):
                with open_file(path) as archive:
                    found.append(parse_record(archive.read_at(size, at)))
    return found


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, written to
    archives, indexed, and read back through the index.

    A null html is an empty payload. A page without a URL has the key ''. Repeated rows get a
    record each. Further columns are ignored."""
    folder = scratch_path(pages.sparkSession, "llm-warc")
    captures = write_records(pages, f"{folder}/archive")
    records = read_records(read_index(write_index(captures, f"{folder}/index")))
    return records.drop("url", "payload")
