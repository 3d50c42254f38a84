"""Near-duplicate documents by improved consistent weighted sampling (ICWS).

Shingles are five words. A shingle weighs its count in the text times its IDF, the mean of its
words' 1 + ln(N / df); words in fewer than one of RARE documents all count as that rare, so the
table of words that must be told apart has at most RARE x (mean distinct words a document) entries
at any size, and may be broadcast. (Document frequencies of whole shingles would make the shingles
of an edit, which stand in one document, outweigh all that thousands of copies share, and near
copies of a large group would fall below any threshold.)

Signatures of BANDS x ROWS samples are cut into bands; texts that agree in a whole band are
candidates, and candidates are verified by their exact weighted Jaccard similarity. Equal texts
are one node from the start. Within a bucket every member is compared with a representative, in
each band another one; components of the links found are contracted, and only members of different
components are compared further: in small buckets all of them, and in large ones all that an exact
weighted prefix filter lets reach SIMILAR. So a group of n copies costs about n comparisons a band,
not n squared, and no pair of a bucket that could link two components is left out."""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NO_ID, grams, mixed, paired, pieces, row_key, text_bytes, whole_text, words
from tidemark.llm.components import components, contracted, forget, kept

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
RARE = 1024
DRAWS = 1 << 14  # pre-drawn rows of (r, b, ln c); a shingle's hash picks its row
TINY_BUCKET, SMALL_BUCKET = 8, 64
PAYING = 50  # pairs a link of a round may cost
BLOCK_BYTES = 800_000
CHUNK = 4096
COUNTERS = 1 << 20  # of shingles by hash; they order the prefixes and decide nothing
NEED = SIMILAR / (1 + SIMILAR) * (1 - 1e-6)  # of both texts' weights: what a pair of SIMILAR shares

Words = tuple[np.ndarray, np.ndarray]  # sorted word hashes, 1 + ln(N / df)


@lru_cache(maxsize=1)
def draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and c from Gamma(2, 1), b uniform, for every row and sample; the same on every machine."""
    source = np.random.Generator(np.random.PCG64(20_110_515))
    shape = (DRAWS, SAMPLES)
    r, c = source.gamma(2.0, size=shape), source.gamma(2.0, size=shape)
    return r.astype(np.float32), source.random(shape).astype(np.float32), np.log(c).astype(np.float32)


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), df: the documents that hold each word."""

    def count(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                h, _, _, text = words(*text_bytes(part.column("text")))
                order = np.lexsort((text, h))
                h, text = h[order], text[order]
                new = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))[: len(h)]
                own, df = np.unique(h[new], return_counts=True)
                yield pa.RecordBatch.from_pydict({"word": own.view(np.int64), "df": df.astype(np.int64)})

    return docs.select("text").mapInArrow(count, "word bigint, df bigint").groupBy("word").agg(F.sum("df").alias("df"))


def frequent_words(docs: DataFrame, total: int) -> Words:
    counted = word_counts(docs).filter(F.col("df") * RARE > total).toPandas()
    h = counted["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    df = counted["df"].to_numpy(np.float64)
    return h[order], (1 + np.log(total / df))[order].astype(np.float32)


def weighted_shingles(data: np.ndarray, offsets: np.ndarray, known: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text: its shingles' hashes in ascending order, and their TF-IDF weights. A text of
    fewer words than a shingle has them all as one shingle; one without words has none."""
    h, _, _, text = words(data, offsets)
    idf = np.full(len(h), 1 + np.log(RARE), np.float32)
    if len(known[0]):
        at = np.minimum(np.searchsorted(known[0], h), len(known[0]) - 1)
        idf = np.where(known[0][at] == h, known[1][at], idf)
    names = grams(h, SHINGLE)
    sums = np.append(np.float64(0), np.cumsum(idf, dtype=np.float64))
    mean = ((sums[SHINGLE:] - sums[:-SHINGLE]) / SHINGLE).astype(np.float32)
    counts = np.bincount(text, minlength=len(offsets) - 1)
    out, start = [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            own, first, tf = np.unique(names[start : start + n - SHINGLE + 1], return_index=True, return_counts=True)
            # the same five words: the same mean but for rounding, which must not differ between texts
            out.append((own, tf.astype(np.float32) * np.round(mean[start + first], 3)))
        elif n:
            whole = grams(h[start : start + n], n) + np.uint64(n)
            out.append((whole, np.round(idf[start : start + n].mean(keepdims=True), 3)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.float32)))
        start += n
    return out


def signature(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One name (shingle, t) per sample. Shingles that share a row of draws and tie are decided by
    the lesser hash, in every text alike."""
    r, b, log_c = draws()
    least = np.full(SAMPLES, np.inf, np.float32)
    name = np.zeros(SAMPLES, np.uint64)
    every = np.arange(SAMPLES)
    for start in range(0, len(hashes), CHUNK):
        h = hashes[start : start + CHUNK]
        row = (mixed(h) & np.uint64(DRAWS - 1)).astype(np.int64)
        rr, bb = r[row], b[row]
        t = np.floor(np.log(weights[start : start + CHUNK])[:, None] / rr + bb)
        a = log_c[row] - rr * (t - bb + 1)
        best = a.argmin(axis=0)
        value = a[best, every]
        new = value < least
        least = np.where(new, value, least)
        name = np.where(new, paired(h[best], t[best, every].astype(np.int64).view(np.uint64)), name)
    return name


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: the sum of lesser weights over the sum of greater ones."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    lesser = float(np.minimum(a[1][same], b[1][at[same]]).sum(dtype=np.float64))
    return lesser / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - lesser)


def signed(docs: DataFrame, known) -> DataFrame:
    """k, tk and bands (one hash a band; null without words) of every document."""

    def sign(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                bands = []
                for hashes, weights in weighted_shingles(*text_bytes(part.column("text")), known.value):
                    if not len(hashes):
                        bands.append(None)
                        continue
                    cut = signature(hashes, weights).reshape(BANDS, ROWS)
                    h = cut[:, 0]
                    for i in range(1, ROWS):
                        h = paired(h, cut[:, i])
                    bands.append(h.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("k"), part.column("tk"), pa.array(bands, pa.list_(pa.int64()))], ["k", "tk", "bands"])

    return docs.select("k", "tk", "text").mapInArrow(sign, "k bigint, tk string, bands array<bigint>")


def vectors(docs: DataFrame, wanted: DataFrame, known) -> DataFrame:
    """n, hashes, weights of the texts that are candidates of anything, read from one of their copies."""

    def measure(batches):
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                found = weighted_shingles(*text_bytes(part.column("text")), known.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("n"), pa.array([h.tobytes() for h, _ in found], pa.binary()),
                     pa.array([w.tobytes() for _, w in found], pa.binary())], ["n", "hashes", "weights"])

    rows = docs.select("k", "tk", "text").join(wanted.select("k", "tk", "n"), ["k", "tk"])
    return rows.select("n", "text").mapInArrow(measure, "n bigint, hashes binary, weights binary")


def verified(pairs: DataFrame, vector: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity reaches SIMILAR."""

    def verify(batches):
        for batch in batches:
            for part in [batch.slice(i, 200) for i in range(0, batch.num_rows, 200)]:
                kept = []
                for ah, aw, bh, bw in zip(*(part.column(c) for c in ("ah", "aw", "bh", "bw")), strict=True):
                    one = (np.frombuffer(ah.as_py(), np.uint64), np.frombuffer(aw.as_py(), np.float32))
                    two = (np.frombuffer(bh.as_py(), np.uint64), np.frombuffer(bw.as_py(), np.float32))
                    kept.append(similarity(one, two) >= SIMILAR)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(kept))

    left = vector.select(F.col("n").alias("a"), F.col("hashes").alias("ah"), F.col("weights").alias("aw"))
    right = vector.select(F.col("n").alias("b"), F.col("hashes").alias("bh"), F.col("weights").alias("bw"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(verify, "a bigint, b bigint")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def representative_pairs(members: DataFrame, seeds: tuple[int, ...]) -> DataFrame:
    """Each member with its bucket's representatives: for every seed the one of the least hash."""
    orders = [F.xxhash64("n", "band", F.lit(seed)) for seed in seeds]
    rep = F.struct("n", "root")
    reps = members.groupBy("band", "key").agg(F.array(*[F.min_by(rep, o) for o in orders]).alias("reps"))
    others = F.array_distinct(F.filter("reps", lambda r: r["root"] != F.col("root")))
    pairs = members.join(reps, ["band", "key"]).select("n", F.explode(others).alias("rep"))
    return pairs.select(F.col("n").alias("a"), F.col("rep.n").alias("b"))


def small_bucket_pairs(members: DataFrame, most: int) -> DataFrame:
    """All pairs of different components in buckets of `most` members or fewer."""
    small = members.filter(F.col("members") <= most).select("band", "key", "n", "root")
    other = small.select("band", "key", F.col("n").alias("b"), F.col("root").alias("other"))
    pairs = small.join(other, ["band", "key"]).filter("n < b and root <> other")
    return pairs.select(F.col("n").alias("a"), "b")


def rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that more than one component is left in."""
    rows = members.select("band", "key", "n", "members").join(roots, "n", "left")
    rows = rows.withColumn("root", F.coalesce("root", "n"))
    left = rows.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rows.join(left.filter("low <> high").select("band", "key"), ["band", "key"])


def hot_vectors(rest: DataFrame, vector: DataFrame) -> DataFrame:
    """n, root, hashes and weights of the members of large buckets."""
    hot = rest.filter(F.col("members") > SMALL_BUCKET).select("n", "root").distinct()
    return vector.join(hot, "n").select("n", "root", "hashes", "weights")


def shingle_counters(texts: DataFrame) -> np.ndarray:
    """How many of the texts hold a shingle, in COUNTERS sums by its hash. The table is to tell
    frequent shingles from rare ones: what a batch meets once is left out of it."""

    def count(batches):
        for batch in batches:
            held = [np.frombuffer(h.as_py(), np.uint64) for h in batch.column(0)]
            slot, n = np.unique(mixed(np.concatenate(held)) & np.uint64(COUNTERS - 1), return_counts=True)
            slot, n = slot[n > 1], n[n > 1]
            yield pa.RecordBatch.from_pydict({"slot": slot.astype(np.int32), "n": n.astype(np.int64)})

    counted = texts.select("hashes").mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    found, out = counted.toPandas(), np.zeros(COUNTERS, np.int64)
    out[found["slot"].to_numpy(np.int64)] = found["n"]
    return out


def prefixes(texts: DataFrame, counters) -> DataFrame:
    """n, root, shingle, rest (the weight from this shingle on), total: the first shingles of each
    text, rare ones first, while the weight from there on may be all that a similar text shares."""

    def cut(batches):
        for batch in batches:
            for part in [batch.slice(i, 500) for i in range(0, batch.num_rows, 500)]:
                names, rests, totals = [], [], []
                for h, w in zip(part.column(2), part.column(3), strict=True):
                    h, w = np.frombuffer(h.as_py(), np.uint64), np.frombuffer(w.as_py(), np.float32)
                    order = np.lexsort((h, counters.value[(mixed(h) & np.uint64(COUNTERS - 1)).astype(np.int64)]))
                    rest = np.cumsum(w[order][::-1], dtype=np.float64)[::-1]
                    n = int((rest >= NEED * (1 + SIMILAR) * rest[0]).sum())
                    names.append(h[order[:n]])
                    rests.append(rest[:n])
                    totals.append(np.full(n, rest[0]))
                sizes = [len(x) for x in names]
                yield pa.RecordBatch.from_pydict({
                    "n": np.repeat(part.column(0).to_numpy(), sizes), "root": np.repeat(part.column(1).to_numpy(), sizes),
                    "shingle": np.concatenate(names).view(np.int64), "rest": np.concatenate(rests),
                    "total": np.concatenate(totals)})

    return texts.mapInArrow(cut, "n bigint, root bigint, shingle bigint, rest double, total double")


def large_bucket_pairs(rest: DataFrame, vector: DataFrame) -> DataFrame:
    """Every pair of different components that can reach SIMILAR, of the members of large buckets.

    Texts share at most the lesser of the weights that follow their first common shingle, and have
    to share NEED of both. So similar texts have a shingle in both prefixes whose `rest` suffices.
    Components meet before their members do: members of one component never meet each other."""
    texts = hot_vectors(rest, vector)
    counters = rest.sparkSession.sparkContext.broadcast(shingle_counters(texts))
    every = kept(prefixes(texts, counters), "prefixes")
    several = every.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    own = kept(every.join(several.select("shingle"), "shingle"), "prefixes")
    forget(every)
    held = own.groupBy("shingle", "root").agg(F.max("rest").alias("most"), F.min("total").alias("least"), F.max("total").alias("longest"))
    other = held.select("shingle", *[F.col(c).alias(f"other_{c}") for c in ("root", "most", "least", "longest")])
    enough = NEED * (F.col("least") + F.col("other_least"))
    met = held.join(other, "shingle").filter(
        (F.col("root") != F.col("other_root")) & (F.col("least") <= F.col("other_longest"))
        & (F.col("most") >= enough) & (F.col("other_most") >= enough))
    short = own.select("shingle", "root", F.col("n").alias("a"), F.col("rest").alias("a_rest"), F.col("total").alias("a_total"))
    long = own.select("shingle", F.col("root").alias("other_root"), F.col("n").alias("b"), F.col("rest").alias("b_rest"),
                      F.col("total").alias("b_total"))
    # the shorter text of a pair is a: its own weight twice is the least that both can have
    first = met.select("shingle", "root", "other_root", "other_least").join(short, ["shingle", "root"]).filter(
        F.col("a_rest") >= NEED * (F.col("a_total") + F.greatest("a_total", "other_least")))
    both = NEED * (F.col("a_total") + F.col("b_total"))
    pairs = first.join(long, ["shingle", "other_root"]).filter(
        (F.col("a_total") <= F.col("b_total")) & (F.col("a_rest") >= both) & (F.col("b_rest") >= both))
    return pairs.select("a", "b")


def near_roots(members: DataFrame, vector: DataFrame) -> DataFrame:
    """n and root: the components of the verified candidate pairs.

    First every member against two representatives, and all pairs of the smallest buckets. Then,
    between the components found, all pairs of small buckets, and representatives of large ones,
    twice as many every round, as long as one pair in PAYING links. Representatives only contract:
    at last all pairs of the components left in large buckets are compared that can reach SIMILAR."""
    first = members.withColumn("root", F.col("n"))
    pairs = representative_pairs(first, (0, 1)).union(small_bucket_pairs(first, TINY_BUCKET))
    tested = kept(ordered(pairs), "pairs")
    links, seed, more = kept(verified(tested, vector), "links"), 2, 8
    roots = components(links).withColumnRenamed("node", "n")
    forget(links)
    while True:
        rest = kept(rooted(members, roots), "rest")
        pairs = representative_pairs(rest.filter(F.col("members") > SMALL_BUCKET), tuple(range(seed, seed + more)))
        if seed == 2:
            pairs = pairs.union(small_bucket_pairs(rest, SMALL_BUCKET))
        pairs = kept(ordered(pairs).join(tested, ["a", "b"], "left_anti"), "pairs")
        found = kept(verified(pairs, vector), "links")
        tested = tested.union(pairs)
        n_pairs, n_links = pairs.count(), found.count()
        if n_links:
            last, roots = roots, contracted(roots, found)
            forget(last)
        forget(found)
        if n_links * PAYING < n_pairs or not n_links:
            break
        forget(rest)
        seed, more = seed + more, more * 2
    if n_links:
        last, rest = rest, kept(rooted(members, roots), "rest")
        forget(last)
    if not rest.filter(F.col("members") > SMALL_BUCKET).take(1):
        return roots
    pairs = kept(ordered(large_bucket_pairs(rest, vector)).join(tested, ["a", "b"], "left_anti"), "pairs")
    found = kept(verified(pairs, vector), "links")
    return contracted(roots, found) if found.take(1) else roots


def near_classes(docs: DataFrame) -> DataFrame:
    """k, tk, root (the class) and low (its least k, which classes may share), once for each distinct
    (k, tk) of `docs`, which has k, tk and text. Texts that are equal, or linked by a chain of similarities of SIMILAR or more,
    are one class. tk names a text; an empty text has a tk of its own for every k."""
    known = docs.sparkSession.sparkContext.broadcast(frequent_words(docs, docs.count()))
    marks = kept(signed(docs, known), "signatures")
    texts = marks.groupBy("tk").agg(F.min("k").alias("k"), F.first("bands").alias("bands"))
    texts = kept(texts.withColumn("n", F.monotonically_increasing_id()), "texts")
    buckets = texts.select("n", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("members")).filter("members > 1")
    members = kept(buckets.join(shared, ["band", "key"]), "buckets")
    wanted = texts.select("n", "k", "tk").join(members.select("n").distinct(), "n")
    vector = kept(vectors(docs, wanted, known), "vectors")
    roots = near_roots(members, vector)
    classes = texts.select("n", "k", "tk").join(roots, "n", "left").withColumn("root", F.coalesce("root", "n"))
    lows = classes.groupBy("root").agg(F.min("k").alias("low"))
    named = classes.join(lows, "root").select("tk", "root", "low")
    return marks.select("k", "tk").distinct().join(named, "tk")


def named_texts(docs: DataFrame) -> DataFrame:
    """`docs` with k and tk. Equal non-empty texts share a tk."""
    k, text = row_key(), whole_text()
    return docs.withColumn("k", k).withColumn(
        "tk", F.when(text == "", F.concat(F.lit("empty "), k.cast("string"))).otherwise(F.md5(text.cast("binary"))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class), is_first (the class has one such doc_id)
    for every row of `docs`.

    A null or empty text is like nothing else and its own class. Rows without a doc_id count as the
    least of their class, whose class_id is then null. Repeated rows share a class. Further columns
    are ignored."""
    rows = named_texts(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")))
    classes = near_classes(rows.select("k", "tk", "text"))
    found = rows.select("doc_id", "k", "tk").join(classes, ["k", "tk"])
    return found.select("doc_id", F.when(F.col("low") != NO_ID, F.col("low")).alias("class_id"),
                        (F.col("k") == F.col("low")).alias("is_first"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class, that of the least doc_id; columns as they are. Different classes each
    keep a row, also if their least doc_id is the same or null."""
    rows = named_texts(docs.withColumnsRenamed({"k": "__k", "tk": "__tk"}))
    classes = near_classes(rows.select("k", "tk", whole_text().alias("text")))
    kept = classes.groupBy("root").agg(F.min(F.struct("k", "tk")).alias("head")).select("head.k", "head.tk")
    first = Window.partitionBy("k", "tk").orderBy("tk")
    return (rows.join(kept, ["k", "tk"]).withColumn("__row", F.row_number().over(first)).filter("__row = 1")
            .drop("k", "tk", "__row").withColumnsRenamed({"__k": "k", "__tk": "tk"}).select(*docs.columns))
