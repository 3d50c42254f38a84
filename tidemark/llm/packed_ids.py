"""Token ids in files of fixed-width bits, with random access.

A file holds documents in order. Their ids lie one after another in blocks of BLOCK ids, each id in
the least number of bits that holds every id of the vocabulary; a block starts on a byte.

    header   8s magic, u32 version, u32 bits
    blocks   packed ids, most significant bit first
    offsets  u64 per block: where it starts, and u64 where the last one ends
    counts   u32 per document: its ids
    names    i64 per document: its doc_id
    trailer  u64 start of offsets, u64 documents, u64 ids, u64 blocks, u64 leading documents
             without a doc_id, 8s magic

A reader asks for the trailer, the offsets and then for the blocks it needs. Unpacking is numpy
over a whole block."""

import itertools
import json
import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import WordNumbers, encoded_blocks
from tidemark.llm.common import stored, whole_text
from tidemark.llm.files import new_file, open_file
from tidemark.session import scratch_path

MAGIC = b"IDPACK01"
VERSION = 1
HEADER = struct.Struct("<8sII")
TRAILER = struct.Struct("<QQQQQ8s")
BLOCK = 1 << 16
CALL_WORDS, CALLS = 100, 200  # words of a text given to the library, and texts of a call
BLOCK_WORDS = 500_000
BLOCK_PIECES = 5_000_000

MANIFEST = "part int, path string, documents bigint, tokens bigint"


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Most significant bit first; the last byte is filled up with zeros."""
    if bits == 16:
        return ids.astype(">u2").tobytes()
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits((ids[:, None] >> shifts & 1).astype(np.uint8).ravel()).tobytes()


def unpack(raw: bytes, bits: int, count: int) -> np.ndarray:
    if bits == 16:
        return np.frombuffer(raw, ">u2", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(raw, np.uint8), count=count * bits).reshape(count, bits)
    weights = (np.uint32(1) << np.arange(bits - 1, -1, -1, dtype=np.uint32)).astype(np.uint32)
    return (flat * weights).sum(axis=1, dtype=np.uint32)


class Writer:
    """Writes one file; holds a block of ids, and a count and a doc_id per document."""

    def __init__(self, out, bits: int) -> None:
        self.out, self.bits = out, bits
        self.counts: list[int] = []
        self.names: list[int] = []
        self.nameless = 0
        self.offsets = [HEADER.size]
        self.waiting: list[np.ndarray] = []
        self.held = self.tokens = 0
        out.write(HEADER.pack(MAGIC, VERSION, bits))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """The next document; those without a doc_id come first."""
        self.nameless += doc_id is None
        self.names.append(0 if doc_id is None else doc_id)
        self.counts.append(len(ids))
        self.tokens += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            whole = np.concatenate(self.waiting)
            for start in range(0, len(whole) - BLOCK + 1, BLOCK):
                self._block(whole[start : start + BLOCK])
            rest = whole[len(whole) // BLOCK * BLOCK :]
            self.waiting, self.held = [rest], len(rest)

    def _block(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.bits)
        self.out.write(raw)
        self.offsets.append(self.offsets[-1] + len(raw))

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        at = self.offsets[-1]
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array(self.counts, "<u4").tobytes())
        self.out.write(np.array(self.names, "<i8").tobytes())
        self.out.write(TRAILER.pack(at, len(self.counts), self.tokens, len(self.offsets) - 1, self.nameless, MAGIC))


class Reader:
    """Reads ranges of ids of an open file."""

    def __init__(self, file) -> None:
        self.file = file
        magic, version, self.bits = HEADER.unpack(file.read_at(HEADER.size, 0))
        tail = file.read_at(TRAILER.size, file.size() - TRAILER.size)
        at, self.documents, self.tokens, blocks, self.nameless, again = TRAILER.unpack(tail)
        if magic != MAGIC or again != MAGIC or version != VERSION:
            raise ValueError("not a file of packed ids")
        self.offsets = np.frombuffer(file.read_at((blocks + 1) * 8, at), "<u8").astype(np.int64)
        at += (blocks + 1) * 8
        self.counts = np.frombuffer(file.read_at(self.documents * 4, at), "<u4").astype(np.int64)
        self.names = np.frombuffer(file.read_at(self.documents * 8, at + self.documents * 4), "<i8")
        self.starts = np.append(0, np.cumsum(self.counts))

    def block(self, number: int) -> np.ndarray:
        start, stop = int(self.offsets[number]), int(self.offsets[number + 1])
        count = min(BLOCK, self.tokens - number * BLOCK)
        return unpack(self.file.read_at(stop - start, start), self.bits, count)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids `start` to `stop` of the file: only the blocks that hold them are read."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = start // BLOCK
        parts = [self.block(b) for b in range(first, (stop - 1) // BLOCK + 1)]
        return np.concatenate(parts)[start - first * BLOCK : stop - first * BLOCK]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))

    def all_documents(self) -> Iterator[np.ndarray]:
        """Every document in turn, a block in memory at a time."""
        number, block, at = 0, None, 0
        for count in self.counts.tolist():
            parts, left = [], count
            while left:
                if block is None or at == len(block):
                    block, at, number = self.block(number), 0, number + 1
                parts.append(block[at : at + left])
                left -= len(parts[-1])
                at += len(parts[-1])
            yield parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def words_of(text: str) -> list[str]:
    """The parts between spaces and line feeds. The tokenizer turns white space into spaces and no
    token reaches over one, so a text's ids are those of its parts in turn."""
    return [w for w in text.replace("\n", " ").split(" ") if w]


@lru_cache(maxsize=2)
def word_ends(path: str) -> np.ndarray | None:
    """Which ids end a word, if the vocabulary marks them."""
    suffix = json.loads(tokenizer(path).to_str())["model"].get("end_of_word_suffix")
    if not suffix:
        return None
    vocabulary = tokenizer(path).get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return ends


def called(words: list[str], numbers: np.ndarray, between: str, path: str):
    """The numbers and ids of words that go to the library many at a time."""
    calls = [numbers[i : i + CALL_WORDS] for i in range(0, len(numbers), CALL_WORDS)]
    for start in range(0, len(calls), CALLS):
        own = calls[start : start + CALLS]
        joined = [between.join([words[i] for i in call.tolist()]) for call in own]
        found = tokenizer(path).encode_batch_fast(joined, add_special_tokens=False)
        yield from zip(own, (np.array(e.ids, np.uint32) for e in found), strict=True)


def encode_stems(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and the n + 1 offsets.

    Words of letters go to the library with spaces between them: each is one word to it, which ends
    where an id says so. Others, and calls where the ends don't add up, go with a special token
    between them: the library cuts there before anything else. The few words that hold a special
    token's text themselves go alone."""
    library, ends = tokenizer(path), word_ends(path)
    special = {t.content: i for i, t in library.get_added_tokens_decoder().items() if t.special and not t.normalized}
    between = min(special, key=special.get, default=None)
    plain = np.array([ends is not None and w.isalpha() for w in words], bool)
    alone = [i for i in np.flatnonzero(~plain).tolist() if between is None or any(t in words[i] for t in special)]
    sizes, order, flat = np.zeros(len(words), np.int64), [], []
    left = [np.setdiff1d(np.flatnonzero(~plain), alone)]
    for call, ids in called(words, np.flatnonzero(plain), " ", path):
        stops = np.flatnonzero(ends[ids]) + 1
        if len(stops) == len(call) and stops[-1] == len(ids):
            sizes[call] = np.diff(stops, prepend=0)
            order.append(call)
            flat.append(ids)
        else:
            left.append(call)
    if between is None:
        alone += np.concatenate(left[1:]).tolist() if len(left) > 1 else []
    else:
        for call, ids in called(words, np.concatenate(left), between, path):
            cuts = np.flatnonzero(ids == special[between])
            sizes[call] = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            order.append(call)
            flat.append(ids[ids != special[between]])
    for i, e in zip(alone, library.encode_batch_fast([words[i] for i in alone], add_special_tokens=False), strict=True):
        sizes[i] = len(e.ids)
        order.append(np.array([i]))
        flat.append(np.array(e.ids, np.uint32))
    out_ends = np.append(0, np.cumsum(sizes))
    out = np.zeros(int(out_ends[-1]), np.uint32)
    if order:
        at = np.concatenate(order)
        size = sizes[at]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(out_ends[at], size) + place] = np.concatenate(flat)
    return out, out_ends


def encode_words(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """As `encode_stems`, with a full stop or comma after a letter or number taken off first: it is a
    token of its own there, and many words differ in it alone."""
    marks = {m: encode_stems([m], path)[0] for m in ".,"}
    stems, tails = WordNumbers(), np.full(len(words), -1, np.int64)
    at = np.zeros(len(words), np.int64)
    for i, w in enumerate(words):
        if w[-1] in marks and len(w) > 1 and w[-2].isalnum() and len(marks[w[-1]]) == 1:
            at[i], tails[i] = stems[w[:-1]], marks[w[-1]][0]
        else:
            at[i] = stems[w]
    ids, ends = encode_stems(list(stems), path)
    size = np.diff(ends)[at]
    stop = np.cumsum(size + (tails >= 0))
    start = np.append(0, stop[:-1]).astype(np.int64)
    out = np.zeros(int(stop[-1]) if len(stop) else 0, np.uint32)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(start, size) + place] = ids[np.repeat(ends[at], size) + place]
    out[stop[tails >= 0] - 1] = tails[tails >= 0]
    return out, np.append(0, stop)


def encoded(texts: Iterable[str], path: str) -> Iterator[np.ndarray]:
    """The ids of each text, in turn; the library encodes every word of a block once."""
    return encoded_blocks(texts, words_of, lambda words: encode_words(words, path), BLOCK_WORDS, BLOCK_PIECES)


def write_ids(docs: DataFrame, path: str, end_id: int, folder: str) -> DataFrame:
    """Encode the texts in ascending doc_id order into files of `folder`; a manifest row per file,
    with part numbers in that order.

    One shuffle: texts are dealt out by ranges of doc_id (nulls first; rows that repeat a doc_id by
    a hash of the text), and each task writes its range as it encodes it. A null text is empty: its
    one id is the end id. Further columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    ranged = rows.repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th").drop("th")

    def write(batches):
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}.ids"
        bits = width(max(tokenizer(path).get_vocab_size(), end_id + 1))
        with new_file(name) as out:
            writer = Writer(out, bits)
            names: list[int | None] = []

            def texts():
                for batch in itertools.chain([first], batches):
                    names.extend(batch.column("doc_id").to_pylist())
                    yield from (t.as_py() for t in batch.column("text"))

            for number, ids in enumerate(encoded(texts(), path)):
                writer.add(names[number], np.append(ids, np.uint32(end_id)))
            writer.close()
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "path": [name], "documents": [len(writer.counts)],
             "tokens": [writer.tokens]})

    return stored(ranged.mapInArrow(write, MANIFEST), "id-files")


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files, block by
    block; `start` counts the ids of all documents before it."""

    def read(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with open_file(path) as file:
                    reader = Reader(file)
                    crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in reader.all_documents()]
                    nameless = np.arange(reader.documents) < reader.nameless
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(reader.names, pa.int64(), mask=nameless), "start": reader.starts[:-1] + base,
                        "n_tokens": reader.counts, "ids_crc32": np.array(crc, np.int64)})

    # one row per file: the running sum is over a list of files, not over documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return files.repartition(F.col("path")).mapInArrow(read, schema)


def encoded_documents(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    folder = scratch_path(docs.sparkSession, "llm-ids")
    return read_ids(write_ids(docs, path, end_id, folder))
