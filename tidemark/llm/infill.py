"""Fill-in-middle: texts cut at two unit ranks, and the middle moved to the end.

A unit is a run of ASCII letters or one other code point. Ranks of units become places in code
points by an indexable skip list: every node of a lane carries how many units and how many code
points its step spans, so a descent that adds up widths reaches a rank exactly, in a number of
steps that grows with the logarithm of the units."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, pieces, whole_text, widened

# The marks, and the shares of hundred
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_BELOW, SPM_BELOW = 90, 20

FAN_BITS = 3  # a node reaches the next lane with a chance of one in eight
PIECE_BYTES = 4 << 20


class SkipList:
    """Lanes over the units of one text, the bottom one first: widths in units, widths in code
    points, and each node's place in the lane below."""

    def __init__(self, widths: np.ndarray) -> None:
        n = len(widths)
        self.units, self.chars = n, int(widths.sum())
        self.lanes = [(np.ones(n, np.int64), widths, np.zeros(0, np.int64))]
        nodes = np.arange(n, dtype=np.uint64)  # units at which the nodes of a lane start
        draws = mixed(nodes + np.uint64(1))
        while len(nodes) > 1 << FAN_BITS:
            risen = (draws & np.uint64((1 << FAN_BITS) - 1)) == 0
            risen[0] = True  # every lane starts at the head
            down = np.flatnonzero(risen)
            by_unit, by_char, _ = self.lanes[-1]
            self.lanes.append((np.add.reduceat(by_unit, down), np.add.reduceat(by_char, down), down))
            nodes, draws = nodes[down], draws[down] >> np.uint64(FAN_BITS)

    def place(self, rank: int) -> int:
        """Code points in the first `rank` units."""
        units = chars = at = 0
        for by_unit, by_char, down in reversed(self.lanes):
            while units < rank and units + by_unit[at] <= rank:
                units += int(by_unit[at])
                chars += int(by_char[at])
                at += 1
            if units == rank:
                break
            if len(down):
                at = int(down[at])
        return chars


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit of a text."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = (points | np.uint32(32)) - np.uint32(97) < 26
    first = np.ones(len(points), bool)
    first[1:] = ~(letter[1:] & letter[:-1])
    return np.diff(np.append(np.flatnonzero(first), len(points)))


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """h1 to h4. A null doc_id has no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    return h1, h2, h3, h4


def cut(text: str, doc_id: int | None, seed: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the output of one text."""
    widths = unit_widths(text)
    n = len(widths)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= CUT_BELOW or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    ranks = SkipList(widths)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ranks.place(low), ranks.place(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text behind an output. No text that was cut holds a mark, and no two marks overlap, so
    the first of each is the one that was set."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, rest = output[len(first) :].split(second, 1)
    tail, middle = rest.split(MIDDLE, 1)
    return head + middle + tail if form == "psm" else tail + middle + head


def infilled(docs: DataFrame, seed: int = 1) -> DataFrame:
    """`docs` with `n`, `form`, `prefix_chars`, `middle_chars` and `output`; columns of these names
    are replaced, all others kept.

    A null or empty text has no units and stays plain, with an empty output. Each row is cut by
    itself: rows that repeat a doc_id draw the same numbers, and rows without one all draw those
    of no digits. Nothing is shuffled, and a very long text costs memory in proportion to itself."""
    made = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}
    rows = docs.drop(*made)
    text_at, id_at = rows.columns.index("text"), rows.columns.index("doc_id")
    schema = widened(rows, **made)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                texts, ids = piece.column(text_at).to_pylist(), piece.column(id_at).to_pylist()
                found = [cut(t or "", i, seed) for t, i in zip(texts, ids, strict=True)]
                columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], schema.fieldNames())

    return rows.mapInArrow(transform, schema)


def restored(rows: DataFrame) -> DataFrame:
    """`rows` with `restored`: the text rebuilt from `output` and `form` alone."""
    rows = rows.drop("restored")
    output_at, form_at = rows.columns.index("output"), rows.columns.index("form")
    schema = widened(rows, restored="string")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "output", PIECE_BYTES):
                pairs = zip(piece.column(output_at).to_pylist(), piece.column(form_at).to_pylist(), strict=True)
                column = pa.array([restore(o, f) for o, f in pairs], pa.string())
                yield pa.RecordBatch.from_arrays([*piece.columns, column], schema.fieldNames())

    return rows.mapInArrow(rebuild, schema)


def infill_report(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    done = restored(infilled(rows).drop("text"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
