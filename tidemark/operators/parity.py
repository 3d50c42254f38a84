"""Comparison of two tables as multisets of rows."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract as c
from tidemark.operators.sets import union_all


def comparable(table: DataFrame) -> DataFrame:
    """The table without lineage, with lists of no fixed order sorted."""
    columns = [name for name in table.columns if name not in c.LINEAGE_COLUMNS]
    return table.select(
        *[
            F.array_sort(name).alias(name) if name in c.UNORDERED_LISTS else F.col(name)
            for name in columns
        ]
    )


def read_dump(spark, path: str) -> DataFrame:
    return comparable(spark.read.parquet(path))


def column_differences(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Columns of one side only, lineage aside."""
    left, right = set(comparable(a).columns), set(comparable(b).columns)
    return {"only_in_a": sorted(left - right), "only_in_b": sorted(right - left)}


def table_parity(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of each side, and rows found on one side only, over the shared columns.

    Both sides are counted in one aggregation by row content: equal rows collapse before
    the shuffle, and one pass gives the differences both ways."""
    left, right = comparable(a), comparable(b)
    shared = [column for column in left.columns if column in right.columns]
    sides = left.select(*shared, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        right.select(*shared, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    rows = sides.groupBy(*shared).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    surplus = F.col("_a") - F.col("_b")
    zero = F.lit(0)

    def total(column):
        return F.coalesce(F.sum(column), zero)

    return rows.agg(
        total(F.col("_a")).alias("rows_a"),
        total(F.col("_b")).alias("rows_b"),
        total(F.greatest(surplus, zero)).alias("only_in_a"),
        total(F.greatest(-surplus, zero)).alias("only_in_b"),
    ).select(F.lit(name).alias("table_name"), "*")


def parity(a: Mapping[str, DataFrame], b: Mapping[str, DataFrame]) -> DataFrame:
    """`table_parity` of every table both sides have."""
    return union_all([table_parity(name, a[name], b[name]) for name in a if name in b])


BUCKETS = 1 << 16
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def row_hashes(rows: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of a row. Spark's hash passes over nulls, so each column brings
    whether it is null, and nested ones are hashed as their JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    parts = []
    for f in rows.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            column = F.array_sort(F.map_entries(column))
        if isinstance(f.dataType, nested):
            parts.append(F.to_json(F.struct(column.alias("v")), JSON_OPTIONS))
        else:
            parts += [column, column.isNull()]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def hashed_rows(rows: DataFrame, buckets: int) -> DataFrame:
    """`rows` with `_h1`, `_h2` and the bucket of the first."""
    h1, h2 = row_hashes(rows)
    return rows.withColumns({"_h1": h1, "_h2": h2}).withColumn("_bucket", F.pmod("_h1", F.lit(buckets)))


def bucket_sums(hashed: DataFrame) -> DataFrame:
    """One line per bucket: its rows and the sums of their hashes, halves apart so that no sum
    overflows. They do not depend on the order of rows, and copies count."""
    half = F.lit(2**32 - 1)
    sums = {"n": F.count(F.lit(1))}
    for name in ("_h1", "_h2"):
        sums[f"{name}_high"] = F.sum(F.shiftrightunsigned(name, 32))
        sums[f"{name}_low"] = F.sum(F.col(name).bitwiseAND(half))
    return hashed.groupBy("_bucket").agg(*[column.alias(name) for name, column in sums.items()])


def checksum_parity(name: str, a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`table_parity` by checksums: each side is summed up by buckets of row hashes, and only the
    rows of buckets whose sums differ are compared one by one.

    Equal tables of any size shuffle their bucket sums and nothing else, and their rows are not
    read again: AQE drops the second scan when no bucket is left. Tables that differ are taken for
    equal only where four sums of two 64-bit hashes agree."""
    left, right = comparable(a), comparable(b)
    shared = [column for column in left.columns if column in right.columns]
    sides = [hashed_rows(side.select(*shared), buckets) for side in (left, right)]
    sums = [bucket_sums(side) for side in sides]
    values = [column for column in sums[0].columns if column != "_bucket"]
    one, other = (F.struct(*[F.col(f"{side}.{v}") for v in values]) for side in ("x", "y"))
    both = sums[0].alias("x").join(sums[1].alias("y"), F.col("x._bucket") == F.col("y._bucket"), "full_outer")
    compared = both.select(
        F.coalesce("x._bucket", "y._bucket").alias("_bucket"), F.coalesce("x.n", F.lit(0)).alias("n_a"),
        F.coalesce("y.n", F.lit(0)).alias("n_b"), (~one.eqNullSafe(other)).alias("differs"))
    # At most `buckets` numbers
    differing = compared.where("differs").select("_bucket")
    rows = [side.join(F.broadcast(differing), "_bucket", "left_semi").drop("_bucket", "_h1", "_h2") for side in sides]
    found = table_parity(name, *rows).select("only_in_a", "only_in_b")
    totals = compared.agg(
        F.coalesce(F.sum("n_a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("n_b"), F.lit(0)).alias("rows_b"))
    only = [found.select(column).scalar().alias(column) for column in ("only_in_a", "only_in_b")]
    return totals.select(F.lit(name).alias("table_name"), "rows_a", "rows_b", *only)
