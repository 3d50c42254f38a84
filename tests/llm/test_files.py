"""WARC archives and shards."""

import hashlib
import zlib

import pytest
from llm_fixtures import frame, odd_rows, rows_of, unique_rows

from tidemark.llm import shards, warc

BIG = "<html>" + "x" * 1500 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</html>"
PAGES = [
    (1, "http://User@Example.COM:80/a?b=1#c", BIG), (2, "https://b.example.com/", BIG), (3, None, BIG),
    (4, "not a url", "small"), (5, "http://example.com/a?b=1", "small"), (6, "http://[bad", None), (7, "", ""),
    (8, "http://é.example.org:8080/ü x", "é" * 600), (9, "http://example.com/a?b=1", "é" * 600),
    (None, "http://example.com/", BIG), (10, "http://example.com/z\r\nX: y", "y" * 999), (11, "u", "y" * 999),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS digest", "1 AS at")


def expected(rows):
    raw = [(p, (h or "").encode()) for p, _, h in rows]
    digest = [hashlib.sha1(b).hexdigest() for _, b in raw]
    last = {}
    for (p, _), d in zip(raw, digest, strict=True):
        if p is not None:
            last[d] = max(last.get(d, p), p)
    out = []
    for (p, b), d in zip(raw, digest, strict=True):
        refers = last.get(d) if len(b) >= 1000 and last.get(d) != p else None
        out.append((p, len(b), d, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_pages_come_back_from_the_archives(spark):
    assert rows_of(warc.archived(pages(spark).repartition(3))) == expected(PAGES)


def test_repeated_rows_have_a_record_each(spark):
    rows = PAGES + PAGES[:2]
    assert rows_of(warc.archived(pages(spark, rows))) == expected(rows)


def test_archive_of_nothing(spark):
    assert warc.archived(pages(spark, [])).count() == 0


@pytest.mark.parametrize("url, key", [
    ("http://User@Example.COM:80/a?b=1#c", "com,example)/a?b=1"), ("https://b.example.com", "com,example,b)/"),
    ("http://example.com:8080/x", "com,example:8080)/x"), (None, ""), ("not a url", "not a url"), ("http://[bad", "http://[bad"),
])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_lookup_reads_the_records_of_one_url(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 2)
    many = PAGES + [(100 + i, f"http://h{i % 9}.example.net/p", f"body {i}") for i in range(60)]
    folder = scratch("warc")
    captures = warc.write_records(pages(spark, many).repartition(4), f"{folder}/archive")
    index = warc.write_index(captures, f"{folder}/index")
    assert rows_of(warc.read_index(index)) == rows_of(captures)
    for url in {p[1] for p in many if p[1]} | {"http://nowhere.example/"}:
        want = sorted(p[0] for p in many if p[1] is not None and p[0] is not None and warc.url_key(p[1]) == warc.url_key(url))
        assert sorted(r["page_id"] for r in warc.find_captures(index, url) if r["page_id"] is not None) == want
    assert warc.find_captures(index, "http://h3.example.net/p")[0]["payload"].startswith(b"body ")


def check_places(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_shards_hold_every_row_once(spark):
    got = shards.sharded(frame(spark, odd_rows(), clash=True), shards=5).collect()
    assert len(got) == len(odd_rows())
    check_places(got)
    sizes = {r[0]: (len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in unique_rows()}
    assert all((r["size"], r["text_crc32"]) == sizes[r["doc_id"]] for r in got if r["doc_id"] not in (None, 20))
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_shards_are_near_equal_and_growth_moves_slots_into_the_new_one(spark):
    rows = [(i, "y" * (50 + i * 7 % 400), "en", "s", 1) for i in range(4000)]
    got = shards.sharded(frame(spark, rows), shards=8).collect()
    check_places(got)
    sizes, grown = {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        grown[r["shard_after_growth"]] = grown.get(r["shard_after_growth"], 0) + r["size"]
        assert r["shard_after_growth"] in (r["shard"], 8)
    assert max(sizes.values()) < 1.01 * min(sizes.values()) and len(sizes) == 8
    assert max(grown.values()) < 1.05 * min(grown.values()) and len(grown) == 9


def test_shards_are_near_equal_when_ids_and_rows_repeat(spark):
    rows = [(None if i % 3 else 7, "y" * 200 if i % 2 else f"{i:0200}", "en", "s", 1) for i in range(4000)]
    got = shards.sharded(frame(spark, rows), shards=8).collect()
    check_places(got)
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert len(got) == len(rows) and len(sizes) == 8 and max(sizes.values()) < 1.02 * min(sizes.values())


def test_shards_of_nothing(spark):
    assert shards.sharded(frame(spark, []), shards=4).count() == 0
