"""Column functions over the raw JSON record of an event."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import contract as c
from tidemark.functions.text import simple_lower

FACETS_TYPE = "array<struct<features:array<map<string,string>>>>"
STRINGS = "array<string>"


def json_path(record: Column | str, path: str) -> Column:
    """The value at `path` as a string; objects come back compact, JSON null is NULL."""
    return F.get_json_object(record, path)


def json_array(record: Column | str, path: str) -> Column:
    """The JSON array at `path` as array<string>; NULL when absent or not an array."""
    return F.from_json(F.get_json_object(record, path), STRINGS)


def _no_null(values: Column, kind: str) -> Column:
    return F.coalesce(values, F.array().cast(kind))


def flatten_features(facets: Column) -> Column:
    """Features of every facet in one array. A facet without features adds nothing:
    `flatten` alone would turn the whole result into NULL."""
    features = F.transform(
        _no_null(facets, FACETS_TYPE),
        lambda facet: _no_null(facet["features"], "array<map<string,string>>"),
    )
    return F.flatten(features)


def facet_features(record: Column | str) -> Column:
    return flatten_features(F.from_json(F.get_json_object(record, "$.facets"), FACETS_TYPE))


def feature_values(features: Column, kind: str, key: str) -> Column:
    """Value of `key` in each feature of one kind, in order, duplicates kept."""
    return F.transform(
        F.filter(features, lambda feature: feature["$type"] == kind),
        lambda feature: feature[key],
    )


def merge_tags(features: Column, record_tags: Column) -> Column:
    """Distinct lowercase tags of the facets, then of the record; NULL tags dropped."""
    tags = F.concat(
        feature_values(features, c.FACET_TAG, "tag"), _no_null(record_tags, STRINGS)
    )
    lowered = F.array_distinct(F.transform(tags, simple_lower))
    return F.filter(lowered, lambda tag: tag.isNotNull())


def hashtags(record: Column | str) -> Column:
    return merge_tags(facet_features(record), json_array(record, "$.tags"))


def mentions(record: Column | str) -> Column:
    return feature_values(facet_features(record), c.FACET_MENTION, "did")
