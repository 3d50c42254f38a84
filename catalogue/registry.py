"""Registry of queries: name -> (Spark function, SQL over the same tables)."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.shape import bronze_rows, calendar_rows, message_rows, with_ctes

Build = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Build] = {}
DECIMALS = 6


@dataclass(frozen=True)
class Oracle:
    sql: str
    ctes: tuple[str, ...]
    doubles: dict[str, int]

    def text(self) -> str:
        whole = with_ctes(self.sql, list(self.ctes))
        if not self.doubles:
            return whole
        rounded = ", ".join(
            f"round(CAST({name} AS DOUBLE), {places}) AS {name}"
            for name, places in self.doubles.items()
        )
        return f"SELECT * REPLACE ({rounded}) FROM ({whole}) AS result"


ORACLES: dict[str, Oracle] = {}


class Tables:
    """The tables of one folder, and the shapes derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze_rows(self.spark, self.events)

    @cached_property
    def messages(self) -> DataFrame:
        return message_rows(self.bronze)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar_rows(self.bronze)


def query(name: str, sql: str | None = None, ctes: str = "", doubles: str = ""):
    """Register a query under `name`. `sql` may use the named `ctes`; `doubles` are the
    columns compared to a number of decimals, six or as in `name:3`."""

    def register(build: Build) -> Build:
        assert name not in QUERIES, name
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = Oracle(sql, tuple(ctes.split()), decimals(doubles))
        return build

    return register


def decimals(doubles: str) -> dict[str, int]:
    named = [entry.partition(":") for entry in doubles.split()]
    return {name: int(places or DECIMALS) for name, _, places in named}


def finish(rows: DataFrame, places: dict[str, int] | None = None) -> DataFrame:
    """Plain types both engines print alike: no zones, whole widths, rounded doubles."""
    columns = []
    for f in rows.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType):
            column = F.round(column, (places or {}).get(f.name, DECIMALS))
        columns.append(column.alias(f.name))
    return rows.select(*columns)


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    places = ORACLES[name].doubles if name in ORACLES else None

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return finish(QUERIES[name](Tables(spark, folder)), places)

    return run
