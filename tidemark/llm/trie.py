"""The prefix trie of conversations, by van Emde Boas recursion.

Sequences of turns are cut at half their depth, the halves again, down to blocks of BLOCK turns.
Names: a span is named by the names of its halves, doubling upward; then every cut prefix is named
by the prefix cut before it and the span between, all cuts of one level at a time. So the trie
above a cut and the forests below it are built at the same time, whatever their depth, and a
sequence of n turns takes log n rounds. Totals: they are summed within blocks first; then, level by
level, what hangs below a cut prefix is grafted onto all nodes of the half above it.

A node belongs to the smallest conversation through it, so a conversation owns the lower end of its
path and nothing else: what a join takes from a node's path is one block row, however many
conversations pass there. Names are 128 bits of SHA-256; only names and lengths are shuffled, no
texts."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NO_ID, row_key, stored, whole_text

BLOCK = 4  # turns of the undivided pieces
GROUP, MOST = 5, 9  # conversations that share a head, and the bound of its turns
CHUNK = 4096  # conversation ids joined to one text before they are hashed
SALTS = 64
ROOT = bytes(16)


def named(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def numbered(conversations: DataFrame) -> DataFrame:
    """c, part, at, name, size: every turn with its number within its conversation and part, parts
    being ranges of the order by turn. No task holds a whole conversation. Turns that tie follow
    their names (a hash of role and text)."""
    role, text = whole_text("role"), whole_text("text")
    turns = conversations.select(
        row_key("conv_id").alias("c"), F.col("turn").cast("bigint").alias("turn"),
        named(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary")).alias("name"),
        F.octet_length(text).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("row"))
    # equal rows of one turn are dealt by their row numbers
    dealt = stored(turns, "turns").repartitionByRange("c", "turn", "name", "row")
    order = Window.partitionBy("c", "part").orderBy("turn", "name", "row")
    found = dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.row_number().over(order).cast("bigint"))
    return stored(found.select("c", "part", "at", "name", "size"), "numbered")


def shared_head(c: Column) -> Column:
    """Turns a conversation takes from the first of its group; one without an id takes none."""
    own = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(MOST))
    return F.when(c == NO_ID, 0).otherwise(own).cast("bigint")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, length, p, name, size) of every rebuilt turn, p from 1; and (c, length) of every
    conversation, turnless ones included."""
    parts = turns.groupBy("c", "part").agg(F.max("at").alias("n"))
    own = Window.partitionBy("c")  # a conversation has as many rows here as parts it reaches over
    earlier = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("c", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                         F.sum("n").over(own).alias("total"))
    firsts = turns.filter((F.col("c") % GROUP == 0) & (F.col("at") < MOST) & (F.col("c") != NO_ID))
    placed = firsts.join(parts, ["c", "part"]).withColumn("p", F.col("before") + F.col("at")).filter(F.col("p") < MOST)
    heads = placed.groupBy(F.col("c").alias("first")).agg(F.sort_array(F.collect_list(F.struct("p", "name", "size"))).alias("head"))
    parts = parts.withColumn("h", shared_head(F.col("c"))).withColumn("first", F.col("c") - F.col("c") % GROUP)
    head = F.when(F.col("h") > 0, F.slice("head", 1, F.greatest("h", F.lit(1))))
    parts = parts.join(heads, "first", "left").withColumn("head", head)
    parts = parts.withColumn("k", F.coalesce(F.size("head"), F.lit(0)).cast("bigint"))
    parts = parts.withColumn("k", F.greatest("k", F.lit(0)))
    parts = stored(parts.withColumn("length", F.col("k") + F.greatest(F.col("total") - F.col("h"), F.lit(0))), "parts")
    whole = parts.filter("before = 0")
    taken = whole.select("c", "length", F.inline("head"))
    rest = turns.join(parts, ["c", "part"]).withColumn("at", F.col("before") + F.col("at")).filter("at > h")
    kept = rest.select("c", "length", (F.col("k") + F.col("at") - F.col("h")).alias("p"), "name", "size")
    return taken.unionByName(kept), whole.select("c", "length")


def cut_prefixes(blocks: DataFrame, levels: int) -> DataFrame:
    """c, q, start: the name of the first q blocks, for every q up to the last whole block."""
    turns = F.transform("turns", lambda t: t["name"])
    whole = blocks.filter(F.size("turns") == BLOCK)
    spans = [stored(whole.select("c", "q", named(F.array_join(F.transform(turns, F.hex), "").cast("binary")).alias("span")), "spans")]
    for _ in range(levels - 1):
        pairs = spans[-1].groupBy("c", F.floor(F.col("q") / 2).alias("q")).agg(
            F.sort_array(F.collect_list(F.struct("q", "span"))).alias("halves"))
        both = pairs.filter(F.size("halves") == 2)
        spans.append(stored(both.select("c", "q", named(F.col("halves")[0]["span"], F.col("halves")[1]["span"]).alias("span")), "spans"))
    cuts = spans[0].filter("q = 0").select("c", F.lit(0).cast("bigint").alias("q"), F.lit(ROOT).alias("start"))
    for level in reversed(range(levels)):
        # a cut in the middle of every span between two cuts; where the half is not whole, none
        half = spans[level].select("c", (F.col("q") * 2**level).alias("q"), "span")
        middle = cuts.join(half, ["c", "q"]).select("c", (F.col("q") + 2**level).alias("q"), named(F.col("start"), F.col("span")).alias("start"))
        cuts = stored(cuts.unionByName(middle), "cuts")
    return cuts


def named_blocks(turns: DataFrame) -> tuple[DataFrame, int]:
    """c, q, length, start, names, sizes of every block of BLOCK turns, and the levels above them."""
    each = turns.groupBy("c", F.floor((F.col("p") - 1) / BLOCK).alias("q")).agg(
        F.max("length").alias("length"), F.sort_array(F.collect_list(F.struct("p", "name", "size"))).alias("turns"))
    blocks = stored(each, "blocks")
    longest = blocks.agg(F.max("length")).first()[0] or 0
    levels = (longest // BLOCK).bit_length()
    if levels:
        cuts = cut_prefixes(blocks, levels)
        ends = cuts.select("c", (F.col("q") - 1).alias("q"), F.col("start").alias("end"))
        blocks = blocks.join(cuts, ["c", "q"], "left").join(ends, ["c", "q"], "left")
    else:
        blocks = blocks.withColumns({"start": F.lit(None).cast("binary"), "end": F.lit(None).cast("binary")})
    start = F.coalesce("start", F.lit(ROOT))
    chain = F.aggregate("turns", F.array(start), lambda done, t: F.concat(done, F.array(named(F.element_at(done, -1), t["name"]))))
    inner = F.slice(chain, 2, F.size("turns"))
    # the last name of a whole block is that of the cut below it
    names = F.when(F.col("end").isNull(), inner).otherwise(F.concat(F.slice(inner, 1, BLOCK - 1), F.array("end")))
    done = blocks.select("c", "q", "length", start.alias("start"), names.alias("names"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    return stored(done, "named-blocks"), levels


def stepped(*columns: str) -> Column:
    """A block's path: depth, name, parent, and the given arrays' values, step by step."""
    parents = F.concat(F.array("start"), F.slice("names", 1, F.greatest(F.size("names") - 1, F.lit(0))))
    steps = F.transform("names", lambda _, i: (F.col("q") * BLOCK + i + 1).cast("bigint"))
    return F.inline(F.arrays_zip(steps.alias("depth"), F.col("names").alias("name"), parents.alias("parent"), *map(F.col, columns)))


def trie_nodes(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """name, parent, depth, size, n_convs, rep (the conversation that owns the node), conv_id,
    n_children: one row for each node, the root (name ROOT, no parent) included."""
    steps = blocks.select("c", stepped("sizes")).withColumnRenamed("sizes", "size")
    counted = [F.count("*").alias("n_convs"), F.min("c").alias("rep"), F.min(F.nullif("c", F.lit(NO_ID))).alias("conv_id")]
    nodes = steps.groupBy("name", "parent", "depth", "size").agg(*counted)
    root = members.agg(*counted).filter("n_convs > 0").select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("size"), "n_convs", "rep", "conv_id")
    nodes = stored(nodes.unionByName(root), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    return stored(nodes.join(children, "name", "left").fillna(0, ["n_children"]), "nodes")


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name", "parent", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def within_blocks(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Totals of every node over its subtree within its block."""
    own = nodes.filter("depth > 0").select(
        F.col("rep").alias("c"), F.floor((F.col("depth") - 1) / BLOCK).alias("q"), "depth",
        (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    owned = own.groupBy("c", "q").agg(F.collect_list(F.struct("depth", "leaves", "saved")).alias("owned"))

    def below(name: str) -> Column:
        deep = F.transform("names", lambda _, i: F.filter("owned", lambda o: o["depth"] > F.col("q") * BLOCK + i))
        zero = F.lit(0).cast("bigint")
        return F.transform(deep, lambda found: F.aggregate(found, zero, lambda total, o: total + o[name])).alias(name)

    pieces = blocks.join(owned, ["c", "q"]).withColumns({n: below(n) for n in ("leaves", "saved")})
    return stored(summed(pieces.select(stepped("leaves", "saved"))), "totals")


def grafted(blocks: DataFrame, nodes: DataFrame, totals: DataFrame, level: int) -> DataFrame:
    """What the lower halves of the spans of 2^level blocks add to the nodes of their upper halves."""
    half = 2 ** (level - 1)
    tops = totals.filter((F.col("depth") - 1) % (2 * half * BLOCK) == half * BLOCK)
    hung = tops.groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("cut")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    last = F.floor(F.col("cut") / BLOCK)
    paths = hung.join(nodes.select("name", F.col("rep").alias("c")), "name").select(
        "c", F.explode(F.sequence(last - half, last - 1)).alias("q"), "leaves", "saved")
    met = paths.join(blocks, ["c", "q"])
    return stored(summed(met.select("leaves", "saved", stepped())), "totals")


def ends_hashes(ends: DataFrame) -> DataFrame:
    """name, ends_sha256 of the nodes at which conversations end. Ids are joined to texts of at
    most CHUNK ids first; a hash runs over a node's texts in order and keeps none of them."""
    ids = ends.filter(F.col("c") != NO_ID).groupBy("name", F.floor(F.col("c") / CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list("c")).alias("ids"))
    texts = ids.select("name", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own == name:
                    state.update(b",")
                else:
                    if state:
                        done.append((name, state.hexdigest()))
                    name, state = own, hashlib.sha256()
                state.update(text.encode())
            yield hashed(done)
        if state:
            yield hashed([(name, state.hexdigest())])

    return texts.repartition("name").sortWithinPartitions("name", "chunk").mapInArrow(digest, "name binary, ends_sha256 string")


def hashed(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "name": pa.array([d[0] for d in done], pa.binary()), "ends_sha256": pa.array([d[1] for d in done], pa.string())})


def with_parents(nodes: DataFrame) -> DataFrame:
    """`nodes` with `parent_conv_id`. A parent's children are split by a salt, and the parent's
    value goes to the salts that occur."""
    nodes = nodes.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)))
    wanted = nodes.filter("depth > 0").select("parent", "salt").distinct()
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(wanted.join(parents, "parent"), ["parent", "salt"], "left").drop("salt")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A null role or text is empty, and a null turn comes first; turns that tie (equal rows too) follow
    a hash of role and text. Rows without a conv_id are one conversation that shares no head; it counts
    as a member, but has no decimals and is no smallest member beside others. Further columns are
    ignored. Without conversations there is no node, not even the root."""
    turns, members = rebuilt(numbered(conversations))
    blocks, levels = named_blocks(turns)
    nodes = trie_nodes(blocks, members)
    totals = within_blocks(blocks, nodes)
    for level in range(1, levels + 1):
        totals = totals.unionByName(grafted(blocks, nodes, totals, level))
    last = blocks.filter((F.col("q") + 1) * BLOCK >= F.col("length")).select("c", F.element_at("names", -1).alias("name"))
    ends = last.unionByName(members.filter("length = 0").select("c", F.lit(ROOT).alias("name")))
    whole = totals.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    tops = totals.filter("depth = 1").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    whole = whole.unionByName(tops.select(F.lit(ROOT).alias("name"), "leaves", "saved"))
    found = with_parents(nodes).join(whole, "name", "left").join(ends_hashes(ends), "name", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"),  # a root alone
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
