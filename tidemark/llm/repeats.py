"""Repeated byte strings of LENGTH bytes or more, by distributed prefix doubling.

Prefix doubling ranks all positions by their first byte, then by pairs of ranks at offsets 1, 2, 4
and so on, until a rank is unique or the offset has passed the threshold. Here a rank is a 64-bit
name: the name of 2L bytes is made from the pair of names of L bytes at p and p + L, so a task
doubles the names of its own texts by itself, and equal strings have equal names everywhere. Spark
sorts (name, position) to find out which names repeat, and positions whose name is unique leave.

A corpus has too many positions to sort them all. Of every window of LENGTH bytes the least
GRAM-byte name is its anchor, and equal windows have equal anchors at equal places, so it is enough
to sort anchors first: the neighbouring windows that share an anchor are one row, with the names of
the anchor and of all bytes the windows cover. Then

1. rows are sorted by both names. An anchor that is unique leaves with all its windows. A row whose
   whole context stood earlier is a repeat as a whole.
2. Rows that come first with their context, but whose anchor also stands in another context, are
   cut into bins of STEP windows, and sorted by the name of the bytes that all windows of a bin
   share. Unique bins leave.
3. The single windows of the bins that are left are sorted by two names of LENGTH bytes, and all
   but the first are repeats.

What decides has two names, 128 bits. Rows of one block that are known to repeat, or to share a
name, need not meet the others and are dealt out by names of their own, so a passage that a third
of all texts hold sends a few rows a block, not one a text, to the task of its name."""

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NO_ID, mixed, paired, pieces, row_key, stored, text_bytes, whole_text

LENGTH = 100
GRAM = 24
STEP = 20
BLOCK_BYTES = 2_000_000

# part: what a row is dealt out by; state: 0 undecided, 1 the name is known to stand elsewhere as
# well, 2 a repeat; lo and hi: first and last window
ANCHORS = "part bigint, context bigint, k bigint, th bigint, lo bigint, hi bigint, shift bigint, state tinyint"
BINS = "part bigint, k bigint, th bigint, lo bigint, hi bigint, state tinyint"
WINDOWS = "part bigint, name bigint, k bigint, th bigint, at bigint, state tinyint"
SEEDS = (1, 0x51ED2701)


def doubled(data: np.ndarray, *lengths: int, seed: int = SEEDS[0]) -> list[np.ndarray]:
    """The names of all strings of each of these lengths (ascending), by doubling."""
    first = mixed(np.arange(256, dtype=np.uint64) + np.uint64(seed))
    names, length, out = first[data], 1, []
    for wanted in lengths:
        while length * 2 <= wanted:
            names = paired(names[:-length], names[length:])
            length *= 2
        rest = wanted - length
        out.append(paired(names[: len(names) - rest], names[rest:]) if rest else names)
    return out


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Of each run of `width` values, where its least one stands, the leftmost of equal ones."""
    at, reach = np.arange(len(values), dtype=np.int32), 1
    steps = []
    while reach * 2 <= width:
        steps.append(reach)
        reach *= 2
    for step in [*steps, width - reach]:
        if step:
            left = values[:-step] <= values[step:]
            values = np.where(left, values[:-step], values[step:])
            at = np.where(left, at[:-step], at[step:])
    return at


def anchor_rows(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """text, gram, context, lo and hi (first and last window, from the text's start), and shift (from
    lo to the anchor) of the runs of windows that share an anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return {"text": none, "gram": none.astype(np.uint64), "context": none.astype(np.uint64), "lo": none,
                "hi": none, "shift": none}
    grams, wholes = doubled(data, GRAM, LENGTH)
    anchor = leftmost_minima(grams, LENGTH - GRAM + 1)
    ends = offsets[1:]
    text = np.repeat(np.arange(len(ends)), np.diff(offsets))[: len(anchor)]
    valid = np.arange(len(anchor)) + LENGTH <= ends[text]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    lo = np.flatnonzero(new)
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    hi = np.flatnonzero(last)
    a = anchor[lo].astype(np.int64)
    shape = ((a - lo) * 1000 + (hi - lo)).astype(np.uint64)
    context = paired(paired(wholes[lo], wholes[hi]), mixed(shape))
    start = offsets[text[lo]]
    return {"text": text[lo], "gram": grams[a], "context": context, "lo": lo - start, "hi": hi - start,
            "shift": a - lo}


def settled(names: list[np.ndarray], order: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered by names and then by `order`, and which of them repeat the names of an earlier
    row that stands strictly before them."""
    by = np.lexsort([*reversed(order), *reversed(names)])
    same = reduce(np.logical_and, [n[by][1:] == n[by][:-1] for n in names])
    tied = same & reduce(np.logical_and, [o[by][1:] == o[by][:-1] for o in order])
    repeat = np.append(False, same)[: len(by)]
    # a row that ties with the first one is no repeat of it
    group = np.cumsum(~repeat)
    first = np.append(True, ~tied)[: len(by)]
    rank = np.cumsum(first)
    head = np.full(len(by) + 1, 0)
    head[group[~repeat]] = rank[~repeat]
    return by, rank > head[group]


def dealt(name: np.ndarray, first: np.ndarray, own: np.ndarray, repeat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """part and state of rows in the order of their names. Rows marked `first` count: two of a name
    are witness enough that it has several, and any more are dealt out by `own`; repeats anywhere."""
    if not len(name):
        return name, np.zeros(0, np.int8)
    new = np.append(True, name[1:] != name[:-1])
    seen = np.cumsum(first)
    base = np.zeros(len(name), np.int64)
    base[new] = seen[new] - first[new]
    state = np.where(repeat, 2, np.where(seen - np.maximum.accumulate(base) > 2, 1, 0)).astype(np.int8)
    spread = mixed(own + np.arange(len(own), dtype=np.uint64))
    return np.where(state == 2, spread, np.where(state == 1, own, name)), state


def anchors(docs: DataFrame) -> DataFrame:
    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                rows = anchor_rows(*text_bytes(part.column("text")))
                k = part.column("k").to_numpy()[rows["text"]]
                th = part.column("th").to_numpy()[rows["text"]]
                by, repeat = settled([rows["gram"], rows["context"]], [k, th, rows["lo"]])
                gram, context, lo, hi, shift = (rows[n][by] for n in ("gram", "context", "lo", "hi", "shift"))
                new = np.append(True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]))[: len(by)]
                deal, state = dealt(gram, new & ~repeat, mixed(gram + context), repeat)
                yield pa.RecordBatch.from_pydict({
                    "part": deal.view(np.int64), "context": context.view(np.int64), "k": k[by], "th": th[by],
                    "lo": lo, "hi": hi, "shift": shift, "state": state})

    return docs.select("k", "th", "text").mapInArrow(scan, ANCHORS)


def ranked_anchors(docs: DataFrame) -> DataFrame:
    """Rows that are repeats (state 2), and firsts of several contexts of an anchor (state 1)."""
    place = Window.partitionBy("part", "context").orderBy("k", "th", "lo")
    whole = Window.partitionBy("part")
    ranked = anchors(docs).repartition("part").withColumn("rank", F.rank().over(place)).withColumn(
        "several", F.min("context").over(whole) != F.max("context").over(whole))
    state = F.when((F.col("state") == 2) | (F.col("rank") > 1), 2).when((F.col("state") == 1) | F.col("several"), 1)
    return ranked.select("k", "th", "lo", "hi", "shift", state.cast("tinyint").alias("state")).filter("state is not null")


def with_texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """k, th, text, and the rows of the document as `runs`. A document's rows are bounded by its
    length."""
    columns = [c for c in rows.columns if c not in ("k", "th")]
    runs = rows.groupBy("k", "th").agg(F.collect_list(F.struct(*columns)).alias("runs"))
    return docs.select("k", "th", "text").join(runs, ["k", "th"])


class Runs:
    """The runs of a batch: where they lie, and their documents' keys."""

    def __init__(self, part: pa.RecordBatch) -> None:
        self.data, offsets = text_bytes(part.column("text"))
        runs = part.column("runs")
        sizes = pa.compute.list_value_length(runs).to_numpy()
        self.flat = runs.flatten()
        text = np.repeat(np.arange(part.num_rows), sizes)
        self.start = offsets[text]
        self.k = part.column("k").to_numpy()[text]
        self.th = part.column("th").to_numpy()[text]

    def column(self, name: str) -> np.ndarray:
        return self.flat.field(name).to_numpy()

    def bytes_of(self, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of many ranges one after another, and where each of them begins there."""
        at = np.cumsum(size) - size
        return self.data[np.arange(int(size.sum())) - np.repeat(at, size) + np.repeat(begin, size)], at


def bins(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """The bins of the rows' windows, by how far the anchor is from a window's start: a bin's windows
    share the LENGTH + 1 - STEP bytes from its nearest window's start on."""

    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                runs = Runs(part)
                lo, hi = runs.column("lo"), runs.column("hi")
                anchor = lo + runs.column("shift")
                low, high = (anchor - hi) // STEP, (anchor - lo) // STEP
                n = high - low + 1
                run = np.repeat(np.arange(len(n)), n)
                number = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + low[run]
                shared = anchor[run] - number * STEP  # the start all windows of the bin reach
                size = np.full(len(run), LENGTH + 1 - STEP)
                raw, at = runs.bytes_of(runs.start[run] + shared, size)
                name = doubled(raw, LENGTH + 1 - STEP)[0][at] if len(run) else np.zeros(0, np.uint64)
                name = mixed(name + number.astype(np.uint64))
                by = np.argsort(name, kind="stable")
                run, name, shared = run[by], name[by], shared[by]
                every = np.ones(len(by), bool)
                own = mixed(name + np.arange(len(by), dtype=np.uint64))
                deal, state = dealt(name, every, own, ~every)
                yield pa.RecordBatch.from_pydict({
                    "part": deal.view(np.int64), "k": runs.k[run], "th": runs.th[run],
                    "lo": np.maximum(lo[run], shared - STEP + 1), "hi": np.minimum(hi[run], shared), "state": state})

    return with_texts(firsts, docs).mapInArrow(scan, BINS)


def repeated_bins(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    counted = bins(firsts, docs).repartition("part").withColumn("n", F.count("*").over(Window.partitionBy("part")))
    return counted.filter("n > 1 or state = 1").select("k", "th", "lo", "hi")


def window_rows(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The single windows of the rows, with two names of LENGTH bytes."""

    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                runs = Runs(part)
                lo, hi = runs.column("lo"), runs.column("hi")
                n = hi - lo + 1
                run = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
                raw, at = runs.bytes_of(runs.start + lo, n + LENGTH - 1)
                names = [doubled(raw, LENGTH, seed=x)[0][at[run] + step] if len(run) else np.zeros(0, np.uint64) for x in SEEDS]
                k, th, first = runs.k[run], runs.th[run], lo[run] + step
                by, repeat = settled(names, [k, th, first])
                name, other = names[0][by], names[1][by]
                deal = np.where(repeat, mixed(name + np.arange(len(by), dtype=np.uint64)), name)
                yield pa.RecordBatch.from_pydict({
                    "part": deal.view(np.int64), "name": other.view(np.int64), "k": k[by], "th": th[by],
                    "at": first[by], "state": np.where(repeat, 2, 0).astype(np.int8)})

    return with_texts(rows, docs).mapInArrow(scan, WINDOWS)


def repeated_windows(rows: DataFrame, docs: DataFrame) -> DataFrame:
    place = Window.partitionBy("part", "name").orderBy("k", "th", "at")
    ranked = window_rows(rows, docs).repartition("part").withColumn("rank", F.rank().over(place))
    return ranked.filter("state = 2 or rank > 1").select("k", "th", F.col("at").alias("lo"), F.col("at").alias("hi"))


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that the ranges cover; ranges that touch are one run."""
    if not len(start):
        return start, stop
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(stop[by])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def with_repeats(docs: DataFrame) -> DataFrame:
    """`docs` (k, th, text and others) with `runs`: the ranges of windows that repeat, or null.

    The texts are dealt out once, by key; bins, windows and the result read the same shuffle."""
    ranked = stored(ranked_anchors(docs), "anchors")
    repeats = ranked.filter("state = 2").select("k", "th", "lo", "hi")
    firsts = ranked.filter("state = 1").select("k", "th", "lo", "hi", "shift")
    singles = repeated_windows(repeated_bins(firsts, docs), docs)
    runs = repeats.union(singles).groupBy("k", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    return docs.join(runs, ["k", "th"], "left")


def keyed(docs: DataFrame) -> DataFrame:
    """k, th, text. th tells apart rows that repeat a doc_id; where none does it is 0, which
    compresses better and changes no result."""
    k = row_key()
    ids = docs.select(k.alias("k")).groupBy("k").count()
    repeated = bool(ids.filter("count > 1").take(1))
    th = F.xxhash64(whole_text()) if repeated else F.lit(0).cast("bigint")
    return docs.select(k.alias("k"), th.alias("th"), whole_text().cast("binary").alias("text"))


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256: what is left of every text when each
    byte is removed that a string of LENGTH bytes covers which also starts earlier, in a smaller
    doc_id or in the same document.

    A null text is empty. A null doc_id comes first. Rows that repeat a doc_id come in the order of
    a hash of their texts; rows that repeat both are one document, and each gets its row. Further
    columns are ignored."""
    def cut(batches):
        for batch in batches:
            out = {"n_removed": [], "n_spans": [], "kept_sha256": []}
            data, offsets = text_bytes(batch.column("text"))
            for i, runs in enumerate(batch.column("runs")):
                text = data[offsets[i] : offsets[i + 1]]
                if not runs.is_valid:
                    out["n_removed"].append(0)
                    out["n_spans"].append(0)
                    out["kept_sha256"].append(hashlib.sha256(text.tobytes()).hexdigest())
                    continue
                start, stop = merged(runs.values.field("lo").to_numpy(), runs.values.field("hi").to_numpy() + LENGTH)
                edge = np.zeros(len(text) + 1, np.int64)
                edge[start] += 1
                edge[stop] -= 1
                kept = np.cumsum(edge)[: len(text)] == 0
                out["n_removed"].append(int((stop - start).sum()))
                out["n_spans"].append(len(start))
                out["kept_sha256"].append(hashlib.sha256(text[kept].tobytes()).hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": np.diff(offsets), **out})

    rows = with_repeats(keyed(docs))
    known = F.when(F.col("k") != NO_ID, F.col("k"))
    return rows.select(known.alias("doc_id"), "text", "runs").mapInArrow(cut, RESULT)
