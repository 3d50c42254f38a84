"""Sharding over fixed virtual slots with a versioned map from slot to shard.

Records are hashed into a fixed number of virtual slots. Bytes are summed per slot, and the map
gives each slot to a shard so that the shards' bytes are near equal. The map is a small table of
versions: rebalancing (here: one more shard) writes a new version that changes as few slots as
needed. Its size depends on the number of slots only, never on the data, so it is planned on the
driver and broadcast."""

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, stored, whole_text

SLOTS = 8192
OVERHEAD = 16  # bytes a record takes beside its text
LAW = "bytes"

Loads = dict[int, tuple[int, int]]  # slot -> bytes, rows


def record_hash(doc_id: str = "doc_id"):
    """Of the id and the text, so that rows that repeat an id do not share a slot."""
    return F.xxhash64(row_key(doc_id), whole_text())


def salted(rows: DataFrame) -> DataFrame:
    """`rows` with `virtual` for hash and row: the slot of the hash, and for equal rows of the row too."""
    equal = rows.groupBy("hash").agg(F.count("*").alias("copies")).filter("copies > 1")
    found = rows.join(equal, "hash", "left")
    own = F.when(F.col("copies") > 1, F.xxhash64("hash", "row")).otherwise(F.col("hash"))
    return found.withColumn("virtual", F.pmod(own, F.lit(SLOTS)).cast("int")).drop("hash", "row", "copies")


def plan(loads: Loads, shards: int) -> dict[int, int]:
    """Slots in descending order of bytes, each to the shard that has the fewest."""
    heap = [(0, 0, s) for s in range(shards)]
    out = {}
    for slot, (size, rows) in sorted(loads.items(), key=lambda x: (-x[1][0], x[0])):
        taken, held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (taken + size, held + rows, shard))
    return out


def edit(old: dict[int, int], loads: Loads, shards: int) -> dict[int, int]:
    """The map for more shards: the new ones take slots from the fullest, and no other slot moves."""
    out, held = dict(old), dict.fromkeys(range(shards), 0)
    by_shard: dict[int, list[tuple[int, int]]] = {s: [] for s in range(shards)}
    for slot, shard in old.items():
        held[shard] += loads[slot][0]
        by_shard[shard].append((loads[slot][0], slot))
    for own in by_shard.values():
        own.sort(reverse=True)
    share = sum(held.values()) / shards
    for new in sorted(set(range(shards)) - set(old.values())):
        refused = set()
        while held[new] < share:
            donors = [s for s in range(shards) if s != new and by_shard[s] and s not in refused]
            if not donors:
                break
            donor = max(donors, key=lambda s: (held[s], -s))
            room = min(share - held[new], held[donor] - share)
            moved = next((x for x in by_shard[donor] if x[0] <= room), None)
            if moved is None:
                refused.add(donor)
                continue
            by_shard[donor].remove(moved)
            by_shard[new].append(moved)
            held[donor] -= moved[0]
            held[new] += moved[0]
            out[moved[1]] = new
    return out


def slot_loads(rows: DataFrame) -> Loads:
    """Bytes and rows of each virtual slot: SLOTS entries at the most."""
    found = rows.groupBy("virtual").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return {r["virtual"]: (r["bytes"], r["rows"]) for r in found.collect()}


def map_table(docs: DataFrame, loads: Loads, shards: int) -> DataFrame:
    """version, virtual, shard, before: version 1 for `shards`, version 2 edited for one more.
    `before` is the number of rows of the slots of the same shard that come before this one."""
    first = plan(loads, shards)
    entries = []
    for version, slots in ((1, first), (2, edit(first, loads, shards + 1))):
        before: dict[int, int] = {}
        for slot in sorted(slots):
            shard = slots[slot]
            entries.append((version, slot, shard, before.get(shard, 0)))
            before[shard] = before.get(shard, 0) + loads[slot][1]
    schema = "version int, virtual int, shard int, before bigint"
    return stored(docs.sparkSession.createDataFrame(entries, schema), "shard-map")


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (place in the shard), grown_shard (null: the law
    is `bytes`), and virtual (slot), shard_after_growth (of map version 2).

    A null text has no bytes. A null doc_id is hashed like any other. The virtual slot follows from
    doc_id and text, and for equal rows from their place in the input too. An empty table has no rows and an empty
    map. Further columns are ignored."""
    text = F.col("text").cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + OVERHEAD).alias("size"),
        F.crc32(F.coalesce(text, whole_text().cast("binary"))).alias("text_crc32"),
        record_hash().alias("hash"), F.monotonically_increasing_id().alias("row"))
    rows = stored(salted(stored(rows, "sizes")), "slots")
    versions = map_table(docs, slot_loads(rows), shards)
    now = versions.filter("version = 1").select("virtual", "shard", "before")
    later = versions.filter("version = 2").select("virtual", F.col("shard").alias("shard_after_growth"))
    # the map has SLOTS rows a version at the most
    placed = rows.join(F.broadcast(now.join(F.broadcast(later), "virtual")), "virtual")
    within = Window.partitionBy("virtual").orderBy("doc_id", "text_crc32", "size")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("before") + F.row_number().over(within) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual", "shard_after_growth")
