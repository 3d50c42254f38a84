"""Column functions over strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two characters Java lowercases with the full Unicode mapping
DOTTED_CAPITAL_I = "İ"
CAPITAL_SIGMA = "Σ"
SMALL_SIGMA = "σ"


def simple_lower(text: Column) -> Column:
    """Lowercase with the Unicode *simple* mapping, one character for one character."""
    dotless = F.replace(text, F.lit(DOTTED_CAPITAL_I), F.lit("I"))
    return F.lower(F.replace(dotless, F.lit(CAPITAL_SIGMA), F.lit(SMALL_SIGMA)))


def _uri_part(uri: Column, position: int) -> Column:
    return F.split_part(uri, F.lit("/"), F.lit(position))


def at_uri_did(uri: Column) -> Column:
    """Account of `at://did/collection/rkey`; empty when the URI is too short."""
    return _uri_part(uri, 3)


def at_uri_rkey(uri: Column) -> Column:
    return _uri_part(uri, 5)


def primary_language(tag: Column) -> Column:
    """Primary subtag of a language tag: `pt-BR` -> `pt`."""
    return F.lower(F.split_part(tag, F.lit("-"), F.lit(1)))


def primary_languages(tags: Column) -> Column:
    """Distinct primary languages of a post; `und` when it declares none at all, nothing
    when the declared list is empty."""
    declared = F.coalesce(tags, F.array(F.lit("und")))
    return F.array_distinct(F.transform(declared, primary_language))
