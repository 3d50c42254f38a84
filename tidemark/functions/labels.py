"""Column functions that put a label on a row."""

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.times import epoch_window


def first_match(rules: Mapping[str, Column], otherwise: str | None = None) -> Column:
    """Name of the first predicate that holds."""
    label = F.lit(otherwise)
    for name, predicate in reversed(list(rules.items())):
        label = F.when(predicate, F.lit(name)).otherwise(label)
    return label


def silver_model(collection: Column, operation: Column) -> Column:
    """The Silver model an event belongs to (the predicates are disjoint)."""
    created = operation == "create"
    return first_match(
        {
            "silver_posts": (collection == c.POST) & operation.isin("create", "update"),
            "silver_likes": (collection == c.LIKE) & created,
            "silver_reposts": (collection == c.REPOST) & created,
            "silver_follows": (collection == c.FOLLOW) & created,
            "silver_deletes": operation == "delete",
        }
    )


def rate_bucket(messages: Column, seconds: int = c.WINDOW_SECONDS) -> Column:
    """Traffic level of a window in messages per second, upper bounds exclusive."""
    rate = messages / F.lit(float(seconds))
    bounded = {label: rate < F.lit(float(upper)) for upper, label in c.RATE_BUCKETS if upper is not None}
    return first_match(bounded, next(label for upper, label in c.RATE_BUCKETS if upper is None))


def regime(window_epoch: Column, caught_up_at: Column) -> Column:
    """`live` from the window of `caught_up_at` on, `catchup` before it or without it."""
    return F.when(window_epoch >= epoch_window(caught_up_at), "live").otherwise("catchup")


def rotation_branch(day: Column, start: date, forced: Column | None = None) -> Column:
    """Branch of a day: they alternate from `start` on, a manual override wins.

    A day before `start` has no rotation and gets NULL."""
    elapsed = F.date_diff(day, F.lit(start))
    rotation = F.when(elapsed >= 0, F.element_at(
        F.array(*[F.lit(branch) for branch in c.ROTATION]),
        (F.pmod(elapsed, F.lit(len(c.ROTATION))) + 1).cast("int"),
    ))
    return rotation if forced is None else F.coalesce(forced, rotation)


def message_label(usable: Column, collection: Column, operation: Column) -> Column:
    """`collection/operation`, or `other` for a message Bronze would drop."""
    return F.when(usable, F.concat_ws("/", collection, operation)).otherwise("other")
