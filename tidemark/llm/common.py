"""What the operators of this package share: stored steps, Arrow texts as numpy bytes, hashing.

Row identity. A document is a row. `k` is its doc_id (the least bigint where that is null, so
that a null sorts first) and `th` tells rows apart that repeat a doc_id with another text. Rows
that repeat both are one document to every comparison, and each of them gets its result."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

NO_ID = -(2**63)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there, and a lost
    executor costs a re-read."""
    path = scratch_path(rows.sparkSession, f"llm-{name}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def widened(rows: DataFrame, **kinds: str) -> T.StructType:
    """The schema of the rows with further columns, name = type."""
    more = [T.StructField(n, T.StructType.fromDDL(f"{n} {k}")[0].dataType) for n, k in kinds.items()]
    return T.StructType([*rows.schema.fields, *more])


def row_key(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID))


def whole_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def pieces(batch: pa.RecordBatch, column: str | int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `limit` bytes (one row at the least)."""
    if batch.num_rows == 0:
        return
    _, ends = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = max(start + 1, min(stop, batch.num_rows))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and the n + 1 offsets. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (xor-shift and odd multipliers)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One name for each ordered pair of names."""
    h = left * np.uint64(0x9E3779B97F4A7C15)
    h += right
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


# The bytes of words: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z became a-z
WORD_BYTE = np.array(
    [(48 <= b <= 57) or (65 <= b <= 90) or (97 <= b <= 122) or b >= 128 for b in range(256)]
)
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BASE = np.uint64(0x9FB21C651E98DF25)
_INVERSE = np.uint64(pow(0x9FB21C651E98DF25, -1, 2**64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts, ends and text numbers of the words of texts (lower-cased A-Z; a word is a
    run of digits, letters and non-ASCII bytes and never crosses texts)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    inside = WORD_BYTE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    # prefix sums of byte values times powers of an odd base, which has an inverse mod 2^64
    power = np.full(len(data), _BASE, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWERED[data].astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    shift = np.full(len(data), _INVERSE, np.uint64)
    shift[0] = 1
    np.multiply.accumulate(shift, out=shift)
    h = mixed((sums[ends] - sums[starts]) * shift[starts] + (ends - starts).astype(np.uint64))
    return h, starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Names of all runs of `size` neighbouring names."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n]
    for j in range(1, size):
        out = paired(out, h[j : j + n])
    return out if size > 1 else out.copy()


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    reach, out = 1, values
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
