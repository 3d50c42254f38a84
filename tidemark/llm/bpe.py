"""Byte-level BPE by merge replay over the distinct words of a corpus block.

Every task gathers the distinct words of a bounded block of whole documents. Those words lie one
after another in one array of symbols, and an inverted index leads from each mergeable token pair
to the positions where it stands. Merges are applied in rank order: a merge touches only the
positions of its pair, and only the pairs with their neighbours are looked up anew. Documents are
then written down as ids by word number. Blocks bound memory whatever the size of the corpus, and
nothing is shuffled."""

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import encoded_blocks
from tidemark.llm.common import pieces, whole_text, widened

BLOCK_WORDS = 100_000
BLOCK_PIECES = 1_500_000
BLOCK_BYTES = 1_000_000

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Tokens by rank, and the pairs of tokens that merge into one."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.token = [b""] * self.size
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        found = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        self.pairs = np.array(sorted(found), np.int64)
        self.merged = np.array([found[int(p)] for p in self.pairs], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token each pair merges into; `size` where it doesn't merge."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.merged[at], np.int32(self.size))


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def one_by_one(vocabulary: Vocabulary, word: bytes) -> list[int]:
    """The merges of one word by the definition: least rank first, leftmost first."""
    symbols = [int(vocabulary.byte[b]) for b in word]
    while len(symbols) > 1:
        s = np.array(symbols, np.int64)
        ranks = vocabulary.rank_of(s[:-1], s[1:])
        at = int(ranks.argmin())
        if ranks[at] == vocabulary.size:
            break
        symbols[at : at + 2] = [int(ranks[at])]
    return symbols


def sorted_once(*positions: np.ndarray) -> np.ndarray:
    at = np.sort(np.concatenate(positions), kind="stable")
    return at[np.append(True, at[1:] != at[:-1])] if len(at) else at


def replay(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and the n + 1 offsets.

    A word that is a token as it stands is that token. Of a run of overlapping pairs (aaa) the
    leftmost go first. A vocabulary may let a merge make a pair of a lower rank than its own; a
    word where that happens while the same pair waits elsewhere in it is merged by itself."""
    sizes = np.array([len(w) for w in words], np.int64)
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    symbol = vocabulary.byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbol)
    ends = np.cumsum(sizes)
    whole = {i: vocabulary.ranks[w] for i, w in enumerate(words) if w in vocabulary.ranks}
    if whole:
        at_whole = np.fromiter(whole, np.int64)
        symbol[np.isin(word_of, at_whole)] = -1  # nothing merges with -1
    follows = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    follows[ends[sizes > 0] - 1] = n
    before[(ends - sizes)[sizes > 0]] = -1
    symbol = np.append(symbol, np.int32(-1))  # position n (and -1) is no symbol

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []
    irregular: set[int] = set()

    def enter(positions: np.ndarray) -> np.ndarray:
        """Put the pairs that start at these positions into the index; their ranks."""
        rank = vocabulary.rank_of(symbol[positions], symbol[follows[positions]])
        merges = rank < vocabulary.size
        at, by = positions[merges], rank[merges]
        if len(at):
            order = np.argsort(by, kind="stable")
            at, by = at[order], by[order]
            cuts = np.flatnonzero(np.diff(by)) + 1
            for r, part in zip(by[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
                if r not in index:
                    index[r] = []
                    heapq.heappush(queue, r)
                index[r].append(part)
        return rank

    enter(np.arange(n, dtype=np.int32))
    while queue:
        rank = heapq.heappop(queue)
        lists = index.pop(rank)
        at = sorted_once(*lists)
        after = follows[at]
        at = at[vocabulary.rank_of(symbol[at], symbol[after]) == rank]
        if not len(at):
            continue
        # in a chain of overlapping pairs every second one merges, from the left
        linked = np.append(False, follows[at[:-1]] == at[1:]) & (np.append(-1, at[:-1]) >= 0)
        if linked.any():
            head = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
        after = follows[at]
        beyond = follows[after]
        symbol[at] = rank
        symbol[after] = -1
        follows[at] = beyond
        inside = beyond < n
        before[beyond[inside]] = at[inside]
        # a symbol that is gone must not be taken for the start of a pair
        follows[after] = n
        left = before[at]
        touched = sorted_once(left[left >= 0], at)
        made = enter(touched)
        early = touched[made < rank]
        if len(early):
            again = np.bincount(word_of[at], minlength=1)
            irregular.update(w for w in word_of[early].tolist() if again[w] > 1)
    if whole:
        symbol[(ends - sizes)[at_whole]] = np.fromiter(whole.values(), np.int64)
    kept = symbol[:n] >= 0
    counts = np.bincount(word_of[kept], minlength=len(words))
    ids = symbol[:n][kept]
    if irregular:
        own = {i: one_by_one(vocabulary, words[i]) for i in irregular}
        parts = np.split(ids, np.cumsum(counts)[:-1]) if len(words) else []
        changed = np.fromiter(own, np.int64)
        counts[changed] = [len(v) for v in own.values()]
        for i, v in own.items():
            parts[i] = v
        ids = np.concatenate([np.asarray(p, np.int64) for p in parts])
    return ids.astype(np.uint32), np.append(0, np.cumsum(counts))


def encoded_texts(
    texts: Iterable[str], vocabulary: Vocabulary, pattern: str, block_words: int, block_pieces: int
) -> Iterator[np.ndarray]:
    """The ids of each text, in turn."""

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return replay(vocabulary, [w.encode() for w in words])

    return encoded_blocks(texts, regex.compile(pattern).findall, encode, block_words, block_pieces)


def decoded(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    return b"".join(map(vocabulary.token.__getitem__, ids.tolist()))


def batch_encoder(columns: list[str], path: str, pattern: str, block_words: int, block_pieces: int):
    """Of batches with these columns: the same rows with `ids`, in runs of BLOCK_BYTES of text."""
    at, names = columns.index("text"), [*columns, "ids"]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def texts():
            for batch in batches:
                for part in pieces(batch, at, BLOCK_BYTES):
                    waiting.append(part)
                    for text in part.column(at):
                        yield text.as_py() or ""

        done = []
        for ids in encoded_texts(texts(), load(path), pattern, block_words, block_pieces):
            done.append(ids.astype("<u4").tobytes())
            while waiting and len(done) >= waiting[0].num_rows:
                batch = waiting.pop(0)
                column = pa.array(done[: batch.num_rows], pa.binary())
                done = done[batch.num_rows :]
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names)

    return encode


def encode_rows(docs: DataFrame, path: str, pattern: str, block_words: int = BLOCK_WORDS,
                block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """`docs` with `ids`: the token ids of each text, four little-endian bytes each.

    A null or empty text has no ids. Rows are encoded one by one, so repeated rows, null doc_ids
    and further columns do no harm; a column that is called `ids` is replaced."""
    rows = docs.drop("ids")
    encode = batch_encoder(rows.columns, path, pattern, block_words, block_pieces)
    return rows.mapInArrow(encode, widened(rows, ids="binary"))


def decode_rows(rows: DataFrame, path: str) -> DataFrame:
    """`rows` with `decoded`: the bytes of their `ids`."""

    def decode(batches):
        vocabulary = load(path)
        for batch in batches:
            out = [decoded(vocabulary, np.frombuffer(i.as_py() or b"", "<u4")) for i in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names)

    rows = rows.drop("decoded")
    at = rows.columns.index("ids")
    names = [*rows.columns, "decoded"]
    return rows.mapInArrow(decode, widened(rows, decoded="binary"))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded and decoded again.

    Both in one Python step: two of them, one on the other, take two workers a core, and an
    executor keeps them all."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    encode = batch_encoder(rows.columns, path, pattern, BLOCK_WORDS, BLOCK_PIECES)

    def digest(batches):
        vocabulary = load(path)
        for batch in encode(batches):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for value in batch.column("ids"):
                raw = value.as_py()
                out["n_tokens"].append(len(raw) // 4)
                out["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["decoded_sha256"].append(
                    hashlib.sha256(decoded(vocabulary, np.frombuffer(raw, "<u4"))).hexdigest()
                )
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **out})

    return rows.mapInArrow(digest, SCHEMA)
