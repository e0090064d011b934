"""Forgiving conversions: a value that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airstrata.config import NULL_TOKENS

# a text that names a day, with or without a time
_DAY = r"^\s*\d{4}-\d{1,2}-\d{1,2}(\D|$)"


def null_tokens_to_null(text: Column) -> Column:
    return F.when(~text.isin(NULL_TOKENS), text)


def try_int(text: Column) -> Column:
    """Integer from text; fractions round half up, blanks around are ignored."""
    return text.try_cast("decimal(38,0)").try_cast("int")


def try_double(text: Column) -> Column:
    return text.try_cast("double")


def try_timestamp(text: Column) -> Column:
    """Wall-clock timestamp; a date alone is its midnight, a year or month alone is none."""
    return F.when(text.rlike(_DAY), text.try_cast("timestamp_ntz"))


def doc_string(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "string")


def doc_double(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "double")


def doc_int(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "decimal(38,0)").try_cast("int")


def doc_child(doc: Column, path: str) -> Column:
    """A nested value, with a JSON null treated as absent."""
    child = F.try_variant_get(doc, path, "variant")
    return F.when(~F.is_variant_null(child), child)
