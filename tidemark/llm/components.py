"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import settings

# Spark's setting: a query's shuffle files go when it ends, and not when the driver's heap is cleared
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def kept(rows: DataFrame, name: str) -> DataFrame:
    """`stored`, with the shuffle files of the write released."""
    with settings(rows.sparkSession, RELEASED):
        return stored(rows, name)


def forget(rows: DataFrame) -> None:
    """Delete a stored table that no plan will read again."""
    spark = rows.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in rows.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of `links` (a, b: bigint): root is the least node it is linked to.

    Large-star and small-star contraction: every round links each node's greater neighbours, then
    its lesser ones, to its least neighbour. Rounds grow with the logarithm of the longest chain.
    A node that a third of all links share is met by minima, which combine before their shuffle,
    and by joins that AQE splits; neighbour lists are never gathered."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges, before = kept(edges.distinct(), "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))")).first()
        if mark == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = mark
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        last, edges = edges, kept(small.union(low.select("hi", "m")).distinct(), "edges")
        forget(last)


def contracted(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`roots` (n, root of every n that is no root itself) after further links: only the components
    that the links join are contracted, and the others keep their root."""
    ends = links.join(roots.select(F.col("n").alias("a"), F.col("root").alias("ra")), "a", "left")
    ends = ends.join(roots.select(F.col("n").alias("b"), F.col("root").alias("rb")), "b", "left")
    joined = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b").distinct()
    new = components(joined)
    moved = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    both = moved.select("n", F.coalesce("to", "root").alias("root")).union(new.select("node", "root"))
    found = kept(both, "roots")
    forget(new)
    return found
