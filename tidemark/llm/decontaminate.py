"""Benchmark decontamination by winnowing.

Fingerprints are word k-grams; of every window of neighbouring k-grams the least is kept, so any
shared run of k + window - 1 words has a kept fingerprint in common, on both sides. Documents and
items are joined on fingerprints, and every hit is extended word by word to both sides. A match of
WINDOW words or more counts; an item of fewer words counts as a whole.

Both sides carry the words next to a fingerprint (as far as a window can reach) along, so a hit is
extended where it was joined, on the words themselves: no hash decides."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import grams, pieces, row_key, stored, text_bytes, whole_text, window_minima, words

WINDOW = 10
GRAM = 5
REACH = WINDOW - GRAM  # words a window can hold beside its fingerprint
BLOCK_BYTES = 800_000  # numpy holds some 40 times as much

MARKS = "row bigint, mark bigint, size int, at int, context array<binary>, left int"
MARKED = (
    "row bigint, doc_id bigint, th bigint, n_words bigint,"
    " marks array<struct<mark:bigint,size:int,at:int,context:array<binary>,left:int>>"
)


def winnowed(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Word positions of the kept fingerprints: minima of the windows inside one text."""
    names = grams(h, GRAM)
    width = WINDOW - GRAM + 1
    n = len(names) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = window_minima(names, width)
    inside = text[:n] == text[WINDOW - 1 : WINDOW - 1 + n]
    kept = np.zeros(len(names), bool)
    for j in range(width):
        kept[j : j + n] |= inside & (names[j : j + n] == least)
    return np.flatnonzero(kept)


class Block:
    """The words of some texts."""

    def __init__(self, column: pa.Array) -> None:
        self.data, offsets = text_bytes(column)
        self.h, self.starts, self.ends, self.text = words(self.data, offsets)
        self.counts = np.bincount(self.text, minlength=len(column))
        self.first = np.append(0, np.cumsum(self.counts))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes().lower()

    def context(self, i: int, size: int) -> tuple[list[bytes], int]:
        """The words a window can reach from the fingerprint at word i, and how many stand before.

        A negative size means a whole short item, which needs no words beside it."""
        reach = REACH if size > 0 else 0
        low = max(i - reach, self.first[self.text[i]])
        high = min(i + abs(size) + reach, self.first[self.text[i] + 1])
        return [self.word(j) for j in range(low, high)], int(i - low)

    def marks(self, short: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(word positions, names, words) of the fingerprints, and of all runs of each short size.

        The size is part of a name, so runs of different sizes never meet."""
        at = winnowed(self.h, self.text)
        yield at, grams(self.h, GRAM)[at], GRAM
        for size in short:
            names = grams(self.h, size)
            at = np.flatnonzero(self.text[: len(names)] == self.text[size - 1 :])
            yield at, names[at] + np.uint64(1000003 * size), -size


def mark_batch(rows: list[int], block: Block, wanted) -> pa.RecordBatch:
    out = {"row": [], "mark": [], "size": [], "at": [], "context": [], "left": []}
    for at, names, size in wanted:
        for i, name in zip(at.tolist(), names.view(np.int64).tolist(), strict=True):
            context, left = block.context(i, size)
            for key, value in zip(out, (rows[int(block.text[i])], name, size, i - int(block.first[block.text[i]]), context, left), strict=True):
                out[key].append(value)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


def item_marks(items: DataFrame) -> DataFrame:
    """Fingerprints of items of WINDOW words or more, and one whole-item mark of each shorter one."""

    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                block = Block(part.column("text"))
                rows = part.column("row").to_pylist()
                full = block.counts >= WINDOW
                at = winnowed(block.h, block.text)
                wanted = [(at, grams(block.h, GRAM)[at], GRAM)]
                for size in range(1, WINDOW):
                    at = block.first[:-1][(block.counts == size) & ~full]
                    wanted.append((at, grams(block.h, size)[at] + np.uint64(1000003 * size), -size))
                yield mark_batch(rows, block, wanted)

    return items.select("row", "text").mapInArrow(scan, MARKS)


FILTER_BITS = 1 << 23


def bits_of(names: np.ndarray) -> list[np.ndarray]:
    return [((names >> np.uint64(s)) & np.uint64(FILTER_BITS - 1)).astype(np.int64) for s in (0, 23, 40)]


def name_filter(marks: DataFrame) -> np.ndarray:
    """A Bloom filter of FILTER_BITS over all item marks: 1 MB however many there are.

    It only spares the join; were it full, every document mark would be joined."""

    def fill(batches):
        for batch in batches:
            names = batch.column("mark").to_numpy().view(np.uint64)
            own = np.unique(np.concatenate([at >> 6 for at in bits_of(names)]))
            words64 = np.zeros(FILTER_BITS // 64, np.uint64)
            for at in bits_of(names):
                np.bitwise_or.at(words64, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_pydict({"word": own, "bits": words64[own].view(np.int64)})

    parts = marks.select("mark").mapInArrow(fill, "word bigint, bits bigint")
    found = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()  # FILTER_BITS / 64 rows at most
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def document_marks(docs: DataFrame, bits: np.ndarray, short: list[int]) -> DataFrame:
    """One row per document: row, doc_id, n_words, and the marks that may be an item's."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    def may(names: np.ndarray) -> np.ndarray:
        out = np.ones(len(names), bool)
        for at in bits_of(names):
            out &= (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out

    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                block = Block(part.column("text"))
                marks: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for at, names, size in block.marks(short):
                    keep = may(names)
                    for i, name in zip(at[keep].tolist(), names[keep].view(np.int64).tolist(), strict=True):
                        context, left = block.context(i, size)
                        text = int(block.text[i])
                        marks[text].append(
                            {"mark": name, "size": size, "at": i - int(block.first[text]), "context": context, "left": left}
                        )
                kind = pa.list_(pa.struct([("mark", pa.int64()), ("size", pa.int32()), ("at", pa.int32()),
                                           ("context", pa.list_(pa.binary())), ("left", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in ("row", "doc_id", "th")),
                     pa.array(block.counts.astype(np.int64)), pa.array(marks, kind)],
                    ["row", "doc_id", "th", "n_words", "marks"],
                )

    return docs.select("row", "doc_id", "th", "text").mapInArrow(scan, MARKED)


def extended(pairs: DataFrame) -> DataFrame:
    """The runs of words that each joined pair of marks shares: row, item, first, stop."""

    def extend(batches):
        for batch in batches:
            out = {"row": [], "item": [], "first": [], "stop": []}
            columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for row, item, size, at, a, i, b, j in zip(*(columns[n] for n in (
                "row", "item", "size", "at", "context", "left", "item_context", "item_left")), strict=True):
                n = abs(size)
                if a[i : i + n] != b[j : j + n]:
                    continue
                low = high = 0
                while low < min(i, j) and a[i - low - 1] == b[j - low - 1]:
                    low += 1
                while i + n + high < len(a) and j + n + high < len(b) and a[i + n + high] == b[j + n + high]:
                    high += 1
                if size < 0 or low + n + high >= WINDOW:
                    for key, value in zip(out, (row, item, at - low, at + n + high), strict=True):
                        out[key].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["row"], pa.int64()), pa.array(out["item"], pa.int64()),
                 pa.array(out["first"], pa.int32()), pa.array(out["stop"], pa.int32())], list(out))

    return pairs.mapInArrow(extend, "row bigint, item bigint, first int, stop int")


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """row, doc_id, th (hash of the text), n_words, item_ids (sorted as strings) and spans (merged runs of hit words,
    end exclusive), one row for each row of `docs`, with `row` numbering them.

    A null or empty text has no words. An item without words has no window. Repeated documents are
    judged one by one; rows that repeat an item_id are one item, and an item without an id counts
    as the item ''. Further columns are ignored."""
    items = stored(
        items.select(F.monotonically_increasing_id().alias("row"),
                     F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                     whole_text().alias("text")), "items")
    marks = stored(item_marks(items), "item-marks")
    # sizes of the short items: WINDOW - 1 values at most
    short = sorted(-r["size"] for r in marks.filter("size < 0").select("size").distinct().collect())
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"),
                       F.xxhash64(whole_text()).alias("th"))
    marked = stored(document_marks(rows, name_filter(marks), short), "document-marks")
    own = marked.select("row", F.explode("marks").alias("m")).select("row", "m.*")
    pairs = own.join(
        marks.select("mark", "size", F.col("row").alias("item"), F.col("context").alias("item_context"),
                     F.col("left").alias("item_left")), ["mark", "size"])
    found = extended(pairs).join(items.select(F.col("row").alias("item"), "item_id"), "item")
    leaks = found.groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.array_sort(F.collect_set(F.struct("first", "stop"))).alias("runs"))
    merged = F.expr("""
        aggregate(runs, cast(array() as array<struct<first:int,stop:int>>),
          (out, r) -> if(size(out) > 0 and element_at(out, -1).stop >= r.first,
            concat(slice(out, 1, size(out) - 1), array(named_struct('first', element_at(out, -1).first,
              'stop', greatest(element_at(out, -1).stop, r.stop)))),
            concat(out, array(r))))""")
    none = F.expr("cast(array() as array<struct<first:int,stop:int>>)")
    return marked.select("row", "doc_id", "th", "n_words").join(leaks.withColumn("spans", merged), "row", "left").select(
        "row", "doc_id", "th", "n_words",
        F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"),
        F.coalesce("spans", none).alias("spans"))


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["stop"] - s["first"]).cast("bigint"))
    return find_leaks(docs, items).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` that share no window with an item, columns as they are."""
    hit = find_leaks(docs, items).filter(F.size("spans") > 0)
    hit = hit.select(row_key().alias("__k"), F.col("th").alias("__th")).distinct()
    keyed = docs.withColumn("__k", row_key()).withColumn("__th", F.xxhash64(whole_text()))
    return keyed.join(hit, ["__k", "__th"], "left_anti").drop("__k", "__th")
