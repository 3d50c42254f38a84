"""Merge-replay BPE and packed ids against the tokenizer libraries."""

import base64
import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import frame, odd_rows, rows_of, sha, unique_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from tidemark.llm import bpe, packed_ids  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_agrees_with_the_library_on_every_row(spark, library):
    got = rows_of(bpe.round_trip(frame(spark, odd_rows(), clash=True), RANKS, public_tokenizers.PATTERN))
    want = []
    for doc_id, text, *_ in odd_rows():
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode())))
    assert got == sorted(want, key=repr)


def test_bpe_does_not_depend_on_blocks(library):
    texts = [r[1] or "" for r in odd_rows()] + ["a" * 3000, "aaab aaa", "\x1c \x85  x"]
    for words, pieces in ((1, 1), (50, 10**9), (10**9, 10**9)):
        found = bpe.encoded_texts(iter(texts), bpe.load(RANKS), public_tokenizers.PATTERN, words, pieces)
        assert [x.tolist() for x in found] == [library.encode_ordinary(t) for t in texts]


def test_a_merge_that_makes_a_lower_rank():
    # bc merges last of all, and then abc, of a lower rank, before the next bc of the word
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"abc": 1, b"bc": 2, b"abcb": 3}
    vocabulary = bpe.Vocabulary(ranks)
    words = [b"abcbc", b"bcbc", b"abcabc", b"abcbcbc"]
    ids, ends = bpe.replay(vocabulary, words)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [bpe.one_by_one(vocabulary, w) for w in words]


def test_a_round_trip_takes_one_worker_a_core(spark):
    # an encoding below a decoding keeps two workers at once, for good
    plan = bpe.round_trip(frame(spark, odd_rows()), RANKS, public_tokenizers.PATTERN)._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("MapInArrow") == 1


def test_bpe_of_nothing(spark):
    assert bpe.round_trip(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 20, 31])
def test_packing_is_reversible(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype(np.uint32)
    raw = packed_ids.pack(ids, bits)
    assert len(raw) == (1001 * bits + 7) // 8
    assert (packed_ids.unpack(raw, bits, 1001) == ids).all()


def test_random_access_to_a_file():
    counts = [0, 5, 70_000, 1, packed_ids.BLOCK * 2, 3]
    source = np.random.default_rng(1)
    docs = [source.integers(0, 49_408, n).astype(np.uint32) for n in counts]
    out = io.BytesIO()
    writer = packed_ids.Writer(out, packed_ids.width(49_408))
    for i, d in enumerate(docs):
        writer.add(None if i == 0 else i, d)
    writer.close()
    reader = packed_ids.Reader(pa.BufferReader(out.getvalue()))
    assert all((reader.document(i) == d).all() for i, d in enumerate(docs))
    assert all((a == d).all() for a, d in zip(reader.all_documents(), docs, strict=True))
    assert (reader.ids(69_990, 70_010) == np.concatenate(docs)[69_990:70_010]).all()
    assert reader.nameless == 1 and reader.names.tolist() == [0, 1, 2, 3, 4, 5]


def test_a_file_that_is_none_is_refused():
    with pytest.raises(ValueError):
        packed_ids.Reader(pa.BufferReader(b"x" * 200))


def expected_ids(rows):
    from tokenizers import Tokenizer

    library, start, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_ids_are_written_in_order_and_read_back(spark):
    rows = sorted(((r[0], r[1]) for r in unique_rows()), key=lambda r: -1 if r[0] is None else r[0])
    got = packed_ids.encoded_documents(frame(spark, unique_rows(), clash=True), WORDS, 1)
    assert rows_of(got) == sorted(expected_ids(rows), key=repr)


def test_rows_that_repeat_an_id_all_have_their_ids(spark):
    got = packed_ids.encoded_documents(frame(spark, odd_rows()), WORDS, 1).collect()
    want = expected_ids((r[0], r[1]) for r in odd_rows())
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((repr(w[0]), *w[2:]) for w in want)
    spans = sorted((r["start"], r["n_tokens"]) for r in got)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_words_have_the_ids_of_the_whole_text():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    texts = [r[1] or "" for r in odd_rows()]
    texts += ["ΟΔΟΣ ΟΔΟΣ. ΟΔΟΣ\nΣ", "a \u0301b e\u0301", "it's\u00a0they'll\x0b\x1c<|endoftext|> x<|endoftext|>y", "  \n \n", "İstanbul STRASSE ǅ क़ ﬁ", "a. b, é. 5, !!. ., .. _. ._, x.. ½, 日, ٣. a\u0301. <|endoftext|>."]
    texts += ["x" + chr(c) + "Y 1" + chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    got = list(packed_ids.encoded(iter(texts), WORDS))
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_nothing(spark):
    assert packed_ids.encoded_documents(frame(spark, []), WORDS, 1).count() == 0
