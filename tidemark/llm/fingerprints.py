"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

Terms are words, weighted by how often they stand in a text. For each of the samples a term draws
r and c from Gamma(2, 1) and b uniformly, all from hashes of the term and the sample's number, so
every text draws alike. With S its weight,

    t = floor(ln S / r + b)        a = c exp(-r (t - b + 1))

and the term of least a, with its t, is the sample; a itself tells (term, t) apart. Two texts agree in a sample with the
probability of their generalised Jaccard similarity: the sum of the lesser weights over the sum of
the greater. A fingerprint is 64 codes of four hexadecimal digits.

r and b are drawn together: with e1 and e2 two exponential draws, r = e1 + e2 is Gamma(2, 1) and
b = e1 / r is uniform and independent of it. Then r b = e1, and with u1 = exp(-e1), u2 = exp(-e2)

    t = floor((ln S + e1) / r)     a = c (u1 u2)^(t + 1) / u1

which for S = 1, the most frequent weight, is c u2: one logarithm."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, stored, whole_text

BLOCKS, PER_BLOCK = 4, 16  # an aggregation draws 16 samples: the code generated for it stays small
SAMPLES = BLOCKS * PER_BLOCK
DIGITS = 4
EMPTY = "0" * (SAMPLES * DIGITS)  # a text without words
WORD_BREAK = r"[^\p{L}\p{N}]+"


def sample(number: int) -> str:
    """SQL for a, of one sample of a block, from `term` (a hash), `weight`, `log_weight`, `block`."""

    def uniform(bits: str, shift: int) -> str:
        return f"(((shiftrightunsigned({bits}, {shift}) & 2097151L) + 0.5D) / 2097152D)"

    x, y = f"xxhash64(term, block, {2 * number})", f"xxhash64(term, block, {2 * number + 1})"
    c = f"(0D - ln({uniform(x, 0)} * {uniform(x, 21)}))"
    u1, u2 = uniform(y, 0), uniform(x, 42)
    t = f"floor((log_weight - ln({u1})) / (0D - ln({u1} * {u2})))"
    return f"if(weight = 1, {c} * {u2}, {c} * pow({u1} * {u2}, {t} + 1) / {u1})"


def code_string(names: list[str]):
    return F.concat(*[
        F.lower(F.lpad(F.hex(F.xxhash64(n).bitwiseAND(16**DIGITS - 1)), DIGITS, "0")) for n in names])


def term_weights(texts: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """keys, term (a hash), and per entry of `columns` (name -> text column) how often it stands
    there. Texts that are dealt out by `keys` are not shuffled again."""
    marked = F.array(*[F.struct(F.col(c).alias("text"), F.lit(i).alias("side")) for i, c in enumerate(columns.values())])
    sides = texts.select(*keys, F.explode(marked).alias("s")).select(*keys, "s.side", "s.text")
    words = sides.select(*keys, "side", F.explode(F.split(F.lower("text"), WORD_BREAK)).alias("word"))
    return (
        words.filter("word <> ''").select(*keys, "side", F.xxhash64("word").alias("term"))
        .groupBy(*keys, "term")
        .agg(*[F.sum(F.when(F.col("side") == i, 1).otherwise(0)).alias(n) for i, n in enumerate(columns)])
    )


def fingerprints(texts: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """keys and, per entry of `columns` (name -> text column), the fingerprint under that name.
    Texts without any word in all columns have no row.

    A term that has the same weight in all columns is sampled once for all of them."""
    names = list(columns)
    everywhere = (1 << len(names)) - 1
    each = F.array(*[F.struct(F.col(n).alias("weight"), F.lit(1 << i).alias("mask")) for i, n in enumerate(names)])
    shared = F.array(F.struct(F.col(names[0]).alias("weight"), F.lit(everywhere).alias("mask")))
    alike = F.lit(True)
    for n in names[1:]:
        alike &= F.col(n) == F.col(names[0])
    weights = (
        term_weights(texts, keys, columns)
        .select(*keys, "term", F.explode(F.when(alike, shared).otherwise(each)).alias("s"))
        .filter("s.weight > 0")
        .select(*keys, "term", "s.mask", "s.weight", F.ln("s.weight").alias("log_weight"),
                F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    )
    least = weights.groupBy(*keys, "block", "mask").agg(
        *[F.min(F.expr(sample(i))).alias(f"s{i}") for i in range(PER_BLOCK)])
    own = least.groupBy(*keys, "block").agg(*[
        F.min(F.when(F.col("mask").bitwiseAND(1 << j) > 0, F.col(f"s{i}"))).alias(f"{n}_{i}")
        for j, n in enumerate(names) for i in range(PER_BLOCK)])
    coded = own.select(*keys, "block", *[
        F.when(F.col(f"{n}_0").isNull(), EMPTY[: PER_BLOCK * DIGITS])
        .otherwise(code_string([f"{n}_{i}" for i in range(PER_BLOCK)])).alias(n) for n in names])
    return coded.groupBy(*keys).agg(*[
        F.concat(*[F.max(F.when(F.col("block") == b, F.col(n))) for b in range(BLOCKS)]).alias(n) for n in names])


def likeness(left: str, right: str):
    """Share of the samples in which two fingerprints agree."""
    same = F.expr(
        f"filter(sequence(0, {SAMPLES - 1}), i -> substr({left}, i * {DIGITS} + 1, {DIGITS})"
        f" = substr({right}, i * {DIGITS} + 1, {DIGITS}))")
    return F.size(same) / F.lit(float(SAMPLES))


def in_order(docs: DataFrame) -> DataFrame:
    """k, th, doc_id, copies, n_chars, and next_k, next_th: the following document by (k, th), the
    first after the last. One row per distinct document; texts stay where they are.

    Positions come from a range-partitioned sort and the row counts of its partitions, so no task
    sees all documents."""
    narrow = docs.groupBy("k", "th").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("copies"),
                                         F.max(F.char_length("text")).cast("bigint").alias("n_chars"))
    sorted_rows = narrow.repartitionByRange("k", "th").sortWithinPartitions("k", "th")
    numbered = stored(
        sorted_rows.withColumn("seq", F.monotonically_increasing_id()), "order")  # partition * 2^33 + place in it
    part = F.shiftrightunsigned("seq", 33)
    # one row per partition of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    total = numbered.count()
    placed = numbered.withColumn("part", part).join(F.broadcast(sizes), "part").withColumn(
        "at", F.col("offset") + F.col("seq").bitwiseAND(2**33 - 1)).drop("part", "offset", "seq")
    follower = placed.select(F.pmod(F.col("at") - 1, F.lit(max(total, 1))).alias("at"),
                             F.col("k").alias("next_k"), F.col("th").alias("next_th"))
    return stored(placed.join(follower, "at").drop("at"), "following")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of its code points replaced by the first as many of the
    next document's, or all of them. A null text is empty; texts without words share one fingerprint.
    Documents are ordered by doc_id (null first), then by a hash of the text; rows that repeat both
    are one document there, and each gets its row. A single document follows itself. Further
    columns are ignored."""
    docs = docs.select(row_key().alias("k"), F.xxhash64(whole_text()).alias("th"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    links = in_order(docs)
    once = docs.withColumn("copy", F.row_number().over(Window.partitionBy("k", "th").orderBy("th"))).filter("copy = 1")
    texts = once.select("k", "th", "text")
    wanted = links.select(F.col("next_k").alias("k"), F.col("next_th").alias("th"), F.col("k").alias("to_k"),
                          F.col("th").alias("to_th"), F.floor(F.col("n_chars") / 4).cast("int").alias("take"))
    heads = texts.join(wanted, ["k", "th"]).select(
        F.col("to_k").alias("k"), F.col("to_th").alias("th"), "take",
        F.expr("substring(text, 1, take)").alias("head"))
    edited = texts.join(heads, ["k", "th"]).withColumn(
        "edited", F.concat(F.expr("substring(text, 1, char_length(text) - take)"), "head"))
    marks = edited.select("k", "th", F.sha2("edited", 256).alias("edited_sha256"))
    both = {"fingerprint": "text", "edited_fingerprint": "edited"}
    made = stored(marks.join(fingerprints(edited, ["k", "th"], both), ["k", "th"], "left").na.fill(EMPTY, list(both)),
                  "fingerprints")
    following = made.select(F.col("k").alias("next_k"), F.col("th").alias("next_th"),
                            F.col("fingerprint").alias("next_fingerprint"))
    rows = links.join(made, ["k", "th"]).join(following, ["next_k", "next_th"])
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
