"""Language identification with a language-bitmask n-gram filter.

A bit-sliced Bloom filter: one table of slots, each a mask with a bit for every language. An n-gram
sets its languages' bits in all of its slots, and a lookup is the AND of those masks: every
language that holds the n-gram, at once. The hits of a text are counted per language, corrected
for the false positives that the fill of each language's slice makes likely, and the language with
the largest share decides.

The filter is fitted on a bounded sample of the labelled rows (`per_language` documents of each of
the labelled languages are expected, `grams` n-grams of each are kept); every language is learned.
Languages come in groups of 64 with a table each, so the model grows with their number alone and
may be broadcast. Prediction is row by row and shuffles nothing."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, paired, pieces, stored, whole_text, widened

SIZES = (3, 4)  # code points of an n-gram
PROBES = 3
SLOTS_PER_GRAM = 8
PER_LANGUAGE = 1500
GRAMS = 30_000
LEAST_SHARE = 0.2  # of the n-gram's best relative frequency: less counts as noise in a language
UNKNOWN = "und"
BLOCK_CHARS = 250_000
BLOCK_BYTES = 1_000_000

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"


@dataclass(frozen=True)
class Filter:
    languages: tuple[str, ...]
    table: Sequence[np.ndarray]  # uint64 masks, one row of its own size for every 64 languages
    false_positive: np.ndarray  # per language

    def masks(self, names: np.ndarray) -> np.ndarray:
        out = []
        for row in self.table:
            at = slots(names, len(row))
            mask = row[at[0]]
            for probe in at[1:]:
                mask = mask & row[probe]
            out.append(mask)
        return np.array(out)


def slots(names: np.ndarray, size: int) -> list[np.ndarray]:
    low = names & np.uint64(0xFFFFFFFF)
    high = (names >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(i) * high) & np.uint64(size - 1)).astype(np.int64) for i in range(PROBES)]


@cache
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def text_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and text numbers of all n-grams, and whether each text has a letter.

    Texts are lower-cased, whatever is no letter is a space, and n-grams with two spaces in a row
    are left out. A space stands on both sides of a text."""
    lowered = [f" {t.lower()} " for t in texts]
    sizes = np.array([len(t) for t in lowered], np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[points]
    points = np.where(letter, points, 32).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), sizes)
    has = np.bincount(text[letter], minlength=len(texts)) > 0
    names, owners = [], []
    for size in SIZES:
        n = len(points) - size + 1
        if n <= 0:
            continue
        h = points[:n] + np.uint64(size << 24)
        bad = text[:n] != text[size - 1 :]
        for j in range(1, size):
            h = paired(h, points[j : j + n])
            bad |= ~letter[j - 1 : j - 1 + n] & ~letter[j : j + n]
        names.append(mixed(h[~bad]))
        owners.append(text[:n][~bad])
    if not names:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has
    return np.concatenate(names), np.concatenate(owners), has


def predict_texts(model: Filter, texts: list[str]) -> tuple[list[str], list[float]]:
    names, owners, has = text_grams(texts)
    total = np.bincount(owners, minlength=len(texts))
    shares = np.zeros((max(1, len(model.languages)), len(texts)))
    if model.languages and len(names):
        masks = model.masks(names)
        for i in range(len(model.languages)):
            hit = (masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1) == 1
            hits = np.bincount(owners[hit], minlength=len(texts))
            f = model.false_positive[i]
            shares[i] = np.clip((hits / np.maximum(total, 1) - f) / (1 - f), 0, 1)
    best = shares.argmax(axis=0)
    known = has & (total > 0) if model.languages else np.zeros(len(texts), bool)
    langs = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
    return langs, np.where(known, shares.max(axis=0), 0.0).tolist()


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", held_out()).filter(
        ~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )


def held_out():
    """Every fourth document by the CRC-32 of its id; one without an id is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def small_table(spark: SparkSession, **columns) -> DataFrame:
    """A local table; unlike one made of a list of rows it starts no Python worker."""
    return spark.createDataFrame(pa.table(columns))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, grams: int = GRAMS) -> Filter:
    """Learn from `text` and `lang` of the documents that are not held out. The model is a driver
    object of bounded size: `grams` n-grams of each language at the most."""
    rows = training_rows(docs)
    counted = rows.groupBy("lang").count().collect()
    names = tuple(sorted(r["lang"] for r in counted))
    if not names:
        return Filter((), np.zeros((1, 1), np.uint64), np.zeros(0))
    number = {name: i for i, name in enumerate(names)}
    shares = [min(1.0, per_language / r["count"]) for r in counted]
    share = F.broadcast(small_table(docs.sparkSession, lang=[r["lang"] for r in counted], share=shares))
    place = (F.xxhash64("doc_id").bitwiseAND(F.lit(2**31 - 1)) / float(2**31))
    sample = rows.join(share, "lang").filter(place < F.col("share")).select("text", "lang")

    def count(batches):
        for batch in batches:
            langs = np.array([number[v.as_py()] for v in batch.column("lang")])
            texts = [v.as_py() for v in batch.column("text")]
            for start, stop in blocks(texts):
                h, owners, _ = text_grams(texts[start:stop])
                for i in np.unique(langs[start:stop]):
                    own, n = np.unique(h[langs[start:stop][owners] == i], return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {"lang": np.full(len(own), i, np.int32), "gram": own.view(np.int64), "n": n.astype(np.int64)}
                    )

    by_lang = Window.partitionBy("lang")
    by_gram = Window.partitionBy("gram")
    counts = (
        sample.mapInArrow(count, "lang int, gram bigint, n bigint")
        .groupBy("gram", "lang").agg(F.sum("n").alias("n")).filter("n > 1")
    )
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return Filter(names, np.zeros(((len(names) + 63) // 64, 1), np.uint64), np.zeros(len(names)))
    total = F.broadcast(small_table(
        docs.sparkSession, lang=np.array([*totals], np.int32), total=np.array([*totals.values()], np.float64)))
    kept = (
        counts.join(total, "lang").withColumn("often", F.col("n") / F.col("total"))
        .withColumn("best", F.max("often").over(by_gram))
        .filter(F.col("often") >= LEAST_SHARE * F.col("best"))
        .withColumn("place", F.row_number().over(by_lang.orderBy(F.desc("n"), "gram")))
        .filter(F.col("place") <= grams)
        .select("lang", "gram")
    )
    kept = stored(kept, "grams") if len(names) > 64 else kept
    tables = []
    for start in range(0, len(names), 64):
        own = kept.filter(F.col("lang").between(start, start + 63)).toPandas()
        size = 1 << max(10, (SLOTS_PER_GRAM * own["gram"].nunique() - 1).bit_length())
        table = np.zeros(size, np.uint64)
        for i, held in own.groupby("lang")["gram"]:
            for at in slots(held.to_numpy(np.int64).view(np.uint64), size):
                table[at] |= np.uint64(1 << (i % 64))
        tables.append(table)
    fill = np.array([((tables[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(names))])
    return Filter(names, tables, np.minimum(fill**PROBES, 0.99))


def blocks(texts: list[str], limit: int = BLOCK_CHARS):
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def identify(docs: DataFrame, model: Filter) -> DataFrame:
    """`docs` with `lang_pred` and `score`.

    Only the text is looked at. A null text or one without a letter is `und` with score 0, as is
    every text if nothing was learned; of equal shares the first language by name wins. Rows are
    judged one by one, whatever their other columns hold; columns called like the two new ones
    are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop("lang_pred", "score")
    at, names = rows.columns.index("text"), [*rows.columns, "lang_pred", "score"]

    def predict(batches):
        for batch in batches:
            for part in pieces(batch, at, BLOCK_BYTES):
                texts = [v.as_py() or "" for v in part.column(at)]
                langs, scores = [], []
                for start, stop in blocks(texts):
                    new_langs, new_scores = predict_texts(shared.value, texts[start:stop])
                    langs += new_langs
                    scores += new_scores
                columns = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(predict, widened(rows, lang_pred="string", score="double"))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from `docs` itself."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return identify(rows, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


LEAST_SCORE = 0.3


def accepted(docs: DataFrame, model: Filter, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of `docs` whose text has a known language with a score of `least` or more; columns
    as they are. A null text, or one without a letter, is rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def judge(batches):
        for batch in batches:
            for part in pieces(batch, at, BLOCK_BYTES):
                texts = [v.as_py() or "" for v in part.column(at)]
                keep = []
                for start, stop in blocks(texts):
                    langs, scores = predict_texts(shared.value, texts[start:stop])
                    keep += [x != UNKNOWN and s >= least for x, s in zip(langs, scores, strict=True)]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)
