"""Every dealt query is registered, agrees with its SQL, and the pipeline with a brute-force version."""

import base64
import os
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import CLASHING, brute_leaks, frame, odd_rows, rows_of, sha

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import comparable  # noqa: E402
from tidemark.llm import bpe, langid, neardup, secrets  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
NAMES = ("op1_warc op2_secrets op3_sharding op4_near_duplicates op5_packed_ids op6_repeats op7_language"
         " op8_fingerprints op9_decontamination op10_byte_bpe op11_prefix_trie op12_licenses op13_fill_in_middle"
         " pipeline").split()
WITH_SQL = ("op1_warc", "op6_repeats", "op9_decontamination", "op11_prefix_trie", "op12_licenses", "op13_fill_in_middle")


def test_queries_are_registered():
    assert set(NAMES) <= set(entry.queries())
    assert set(WITH_SQL) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", WITH_SQL)
def test_queries_agree_with_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got, want = entry.queries()[name](spark, FOLDER).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got).equals(comparable(want))


def brute_pipeline(spark, docs, items):
    """What the stages keep and make, one document after another."""
    model = langid.fit(docs)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: r[0])
    langs, scores = langid.predict_texts(model, [t for _, t in rows])
    rows = [r for r, lang, s in zip(rows, langs, scores, strict=True) if lang != "und" and s >= langid.LEAST_SCORE]
    known = neardup.frequent_words(spark.createDataFrame(rows, "doc_id bigint, text string"), len(rows))
    vector = [neardup.weighted_shingles(*neardup.text_bytes(pa.array([t])), known)[0] for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or neardup.similarity(vector[i], vector[j]) >= neardup.SIMILAR:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    rows = [r for i, r in enumerate(rows) if find(i) == i]
    dirty = {r[0] for r in brute_leaks(rows, items) if r[5]}
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc_id, text in rows:
        if doc_id in dirty:
            continue
        masked, at = "", 0
        for start, _, end in secrets.find_spans(text)[1]:
            masked += text[at:start] + ("[SECRET]" if start >= at else "")
            at = max(at, end)
        masked += text[at:]
        ids = library.encode_ordinary(masked)
        out.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(masked.encode())))
    return sorted(out, key=repr)


def test_the_pipeline_agrees_with_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute_pipeline(spark, docs, items)
    assert len(want) < docs.count()
    assert rows_of(corpus_pipeline.run(spark, FOLDER)) == want


def test_stages_keep_the_columns_of_odd_documents(spark):
    docs = frame(spark, odd_rows(), clash=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert set(CLASHING) <= set(out.columns)
        out.count()
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == len(odd_rows())
    assert bpe.decode_rows(bpe.encode_rows(docs, *vocabulary()), vocabulary()[0]).filter(
        "decoded <> cast(coalesce(text, '') AS BINARY)").count() == 0


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path(corpus_pipeline.VOCABULARY), public_tokenizers.PATTERN
