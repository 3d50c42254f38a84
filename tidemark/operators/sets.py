"""Set operations by column name."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows over all inputs. Each input is made distinct on the map side."""
    return union_all(frames).distinct()


def set_except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of `left` minus rows of `right`, copies counted."""
    return left.exceptAll(right.select(*left.columns))
