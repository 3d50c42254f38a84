"""Prefix trie, license scan and fill-in-middle against slow versions of their contracts."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import frame, odd_rows, rows_of, sha, word_list
from pyspark.sql import functions as F

from tidemark.llm import infill, licenses, secrets, trie
from tidemark.session import settings

# --- Prefix trie ---

TURNS = "conv_id bigint, turn bigint, role string, text string"


def turn_name(role, text) -> bytes:
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).digest()[:16]


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn is not None, turn or 0, turn_name(role, text), (role or "", text or "")))
    turns = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in turns.items():
        if c is None:
            built[c] = mine
            continue
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        built[c] = turns.get(base, [])[:h] + mine[h:]
    members, children = collections.defaultdict(list), collections.defaultdict(set)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
            if d:
                children[tuple(path[: d - 1])].add(tuple(path[:d]))

    def low(node):
        return min((c for c in members[node] if c is not None), default=None)

    totals = {node: [0, 0] for node in members}
    for node, own in members.items():
        saved = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            totals[node[:d]][0] += not children[node]
            totals[node[:d]][1] += saved
    out = []
    for node, own in members.items():
        ends = sorted(c for c in own if c is not None and len(built[c]) == len(node))
        out.append((low(node), len(node), low(node[:-1]) if node else None, len(own), len(children[node]),
                    *totals[node], sha(",".join(map(str, ends)).encode())))
    return sorted(out, key=repr)


def odd_turns():
    rows = [(c, t, "user" if t % 2 == 0 else "bot", f"text {min(c, 12) % 3} {t}") for c in range(40) for t in range(c % 9)]
    rows += [(50, t, "user", f"long {t}") for t in range(101)] + [(53, t, "user", f"long {t}") for t in range(97)]
    rows += [(58, t, "user", f"long {t % 7}") for t in range(64)] + [(59, t, "user", f"long {t % 7}") for t in range(66)]
    rows += [(60, None, None, None), (60, None, "bot", ""), (60, 3, None, "é日本"), (60, 3, "user", "tie"), (60, 3, "user", "tie")]
    rows += [(None, 0, "user", "text 0 0"), (None, 1, "x", "y"), (71, 0, "user", "alone"), (-3, 0, "user", "minus"), (-5, 0, "a", "b")]
    rows += [(c, 0, "user", "hot") for c in range(100, 5200, 17)]
    return rows


def talks(spark, rows):
    found = spark.createDataFrame(rows, TURNS).repartition(3)
    return found.selectExpr("*", "'x' AS name", "7 AS p", "1 AS depth", "'z' AS c", "0 AS part")


def test_the_trie_agrees_with_brute_force(spark):
    rows = odd_turns()
    got = trie.prefix_trie(talks(spark, rows))
    want = brute_trie(rows)
    assert any(r[1] == 101 for r in want) and len({r[1] for r in want}) > 90
    assert rows_of(got) == want


@pytest.mark.parametrize("rows", [[], [(9, 0, "user", "taken away")], [(None, None, None, None)]])
def test_tiny_tables(spark, rows):
    assert rows_of(trie.prefix_trie(talks(spark, rows))) == brute_trie(rows)


def test_a_long_conversation_is_numbered_in_parts(spark):
    rows = [(10, t // 3, "user", f"turn {t}") for t in range(700)] + [(11, 0, "user", "b")]
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        turns = trie.numbered(talks(spark, rows))
        assert turns.filter("c = 10").select("part").distinct().count() > 1
        assert rows_of(trie.prefix_trie(talks(spark, rows))) == brute_trie(rows)


def test_ends_are_hashed_over_chunks(spark):
    ends = spark.range(20_000).select(F.lit(b"n").alias("name"), F.col("id").alias("c"))
    found = trie.ends_hashes(ends.repartition(5)).collect()
    assert [r["ends_sha256"] for r in found] == [sha(",".join(map(str, range(20_000))).encode())]


# --- Licenses ---


def brute_licenses(rows):
    """Every start of every template in every text, one after another."""
    texts = [(doc_id, [w.decode() for w in word_list(text)]) for doc_id, text in rows]
    held = collections.Counter(w for _, own in texts for w in set(own))
    weight = {w: int(np.round(1000 * (1 + math.log((1 + len(texts)) / (1 + held[w]))))) for w in licenses.vocabulary()}
    out = []
    for doc_id, own in texts:
        base, labels, starts, best = set(), set(), [], 0.0
        for t in licenses.templates():
            total = sum(weight[w] for w in t.words)
            for start in range(1 - len(t.words), len(own)):
                same = [0 <= start + i < len(own) and own[start + i] == w for i, w in enumerate(t.words)]
                got = sum(weight[w] for w, s in zip(t.words, same, strict=True) if s)
                if got * 100 >= t.share * total and all(same[i] for i in t.key):
                    labels.add(t.label)
                    best = max(best, got / total)
                    if t.base:
                        base.add(t.label)
                        starts.append(start)
        out.append((doc_id, len(own), len(starts), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(base)), ",".join(sorted(labels)), best))
    return sorted(out, key=repr)


def whole(t):
    return " ".join(t.words)


def license_rows():
    found = {t.label + str(i): whole(t) for i, t in enumerate(licenses.templates())}
    rows = odd_rows()
    for i, text in enumerate(found.values()):
        words = text.split()
        rows += [(500 + i, f"river stone {text.title()}, table", "en", "s", 1), (600 + i, text, "en", "s", 1),
                 (700 + i, " ".join(["odd", *words[1:]]), "en", "s", 1),  # another first word
                 (800 + i, " ".join(words[: len(words) // 2] + ["odd"] + words[len(words) // 2 :]), "en", "s", 1),
                 (900 + i, " ".join(words[2:]), "en", "s", 1)]
    rows += [(950, "MIT License " * 3000, "en", "s", 1), (951, "mit the license, Apache\nLicense mit-license", "en", "s", 1),
             (952, "apache licenseé general public licence general public license", "en", "s", 1),
             (953, "license", "en", "s", 1), (954, "public license general", "en", "s", 1)]
    return rows


def test_licenses_agree_with_brute_force(spark):
    rows = license_rows()
    got = licenses.license_report(frame(spark, rows, clash=True))
    want = brute_licenses([r[:2] for r in rows])
    assert rows_of(got) == want
    by_id = {r[0]: r for r in want}
    assert by_id[950][2:6] == (3000, 0, 2 * 2999, "mit") and by_id[951][2] == 2
    # every template is found in running text, and a rare word put inside splits most of them
    for i, t in enumerate(licenses.templates()):
        assert t.label in by_id[500 + i][6].split(",")


def test_license_scan_keeps_columns_and_gives_places(spark):
    docs = frame(spark, license_rows(), clash=True)
    found = licenses.scanned(docs)
    assert found.columns == [*docs.columns, "n_words", "matches"]
    row = found.filter("doc_id = 952").first()
    assert [(m["template"], m["start"], m["share"]) for m in row["matches"]] == [(2, 5, 1.0)]
    again = licenses.scanned(found.select("text", "matches", "n_words", "doc_id"))
    assert sorted(again.columns) == ["doc_id", "matches", "n_words", "text"]
    assert licenses.license_report(docs.limit(0)).count() == 0


def test_words_looked_up_outweigh_what_may_lack():
    index = licenses.postings(licenses.weights(1000, np.arange(len(licenses.vocabulary())) * 9 % 1000))
    for p in index:
        assert p.weights[: p.looked_up].sum() * 100 > p.weights.sum() * (100 - p.share)
        assert p.weights[: p.looked_up - 1].sum() * 100 <= p.weights.sum() * (100 - p.share)


# --- Fill-in-middle ---


def brute_infill(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i * 8 : i * 8 + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text.encode()), sha(text.encode()))
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    spm = h[3] % 100 < 20
    output = f"<S>{c}<P>{a}<M>{b}" if spm else f"<P>{a}<S>{c}<M>{b}"
    return (doc_id, n, "spm" if spm else "psm", len(a), len(b), sha(output.encode()), sha(text.encode()))


def marked_rows():
    rows = odd_rows() + [(30, "a<P>b", "en", "s", 1), (31, "<M>", "en", "s", 1), (32, "x <S> y", "en", "s", 1)]
    texts = ["<", "P>", "<P", ">", "<<S", "M>", " ", "word", "日本", "\x00", "\n"]
    source = random.Random(7)
    rows += [(1000 + i, "".join(source.choice(texts) for _ in range(i % 40)), "en", "s", 1) for i in range(300)]
    return rows


def test_infill_agrees_with_brute_force(spark):
    rows = marked_rows()
    got = infill.infill_report(frame(spark, rows, clash=True))
    want = sorted((brute_infill(r[0], r[1]) for r in rows), key=repr)
    assert rows_of(got) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_infill_keeps_columns_and_is_undone(spark):
    docs = frame(spark, marked_rows(), clash=True)
    found = infill.restored(infill.infilled(docs))
    made = ["n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert found.columns == [c for c in docs.columns if c != "n"] + made
    assert found.filter("restored <> coalesce(text, '')").count() == 0
    assert infill.infill_report(docs.limit(0)).count() == 0
    other = {r["doc_id"]: r["output"] for r in infill.infilled(docs, seed=2).collect()}
    assert sum(other[r["doc_id"]] != r["output"] for r in found.collect()) > 100


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 1000, 20_000])
def test_skip_list_places(n):
    widths = np.random.default_rng(n).integers(1, 9, n)
    ranks, ends = infill.SkipList(widths), np.append(0, np.cumsum(widths))
    assert all(ranks.place(r) == ends[r] for r in ([0, n] if n > 2000 else range(n + 1)))
    for r in np.random.default_rng(1).integers(0, n + 1, 300).tolist():
        assert ranks.place(r) == ends[r]
    # every lane spans everything, and lanes shrink
    assert all(u.sum() == n and c.sum() == widths.sum() for u, c, _ in ranks.lanes)
    assert len(ranks.lanes) <= 2 + 2 * max(1, int(math.log(n + 1, 8)))


# --- Secrets: the contract's base columns, recounted with patterns of their own ---


def brute_base(text):
    text, found = text or "", []
    name = "(?i:password|passwd|secret|token|apikey|api_key)"
    for m in re.finditer(name + "[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text):
        found.append((m.start(), 0, m.end(), len(m[1]) >= 6))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        found.append((m.start(), 1, m.end(), m.end() - m.start() >= 20))
    for m in re.finditer("[0-9a-f]+", text):
        found.append((m.start(), 2, m.end(), m.end() - m.start() >= 24))
    kept = sorted(f[:3] for f in found if f[3])
    names = ("assign", "access", "hex")
    listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in kept)
    return (*(sum(f[1] == k for f in kept) for k in range(3)), sha(listed.encode()), kept)


def secret_rows():
    source = random.Random(11)
    parts = ["password", "Token", "API_KEY", "apikey", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "hunter2hunter", "é", "\n", "x"]
    rows = [(i, "".join(source.choice(parts) for _ in range(i % 60)), "en", "s", 1) for i in range(2000, 2400)]
    many = " ".join(f"token=secret{n}value AKIA{'Z' * 16}" for n in range(4000))
    return odd_rows() + rows + [(3000, many, "en", "s", 1), (3001, "secret:" * 500, "en", "s", 1)]


def test_base_columns_of_secrets(spark):
    rows = secret_rows()
    got = secrets.scan_secrets(frame(spark, rows, clash=True))
    want = sorted(((r[0], *brute_base(r[1])[:4]) for r in rows), key=repr)
    assert rows_of(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
    # Every base span is among all spans, at its place
    spans = {r["doc_id"]: r["spans"] for r in got.filter("doc_id >= 2000").collect()}
    for doc_id, text, *_ in rows:
        if doc_id is not None and doc_id >= 2000:
            base = [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in brute_base(text)[4]]
            own = spans[doc_id].split(",")
            assert [s for s in own if s.split(":")[0] in ("assign", "access", "hex")] == base or not base
    assert secrets.scan_secrets(frame(spark, rows).limit(0)).count() == 0
