"""Casts from the text leaves of a document to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stricter than Java's parser, which also takes '1.5d', 'NaN' and hex floats.
_NUMBER = r"^\s*[+-]?(\d+[.]?\d*|[.]\d+)([eE][+-]?\d+)?\s*$"
_DIGITS = r"^\s*[+-]?\d+\s*$"


def to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def to_long(text: Column) -> Column:
    """Whole numbers only, also when written as 437673.0; anything else is NULL."""
    number = to_double(text)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(F.when(text.rlike(_DIGITS), F.trim(text).try_cast("bigint")), whole)


def _first_status(status: Column) -> Column:
    """The first entry of a list of statuses, as VARIANT; NULL for an empty list or no list.

    Entries of another kind further on do not matter.
    """
    value = F.try_parse_json(F.when(status.startswith("["), status))
    return F.try_variant_get(value, "$[0]", "variant")


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, VOID for a JSON null, or a scalar's type."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def first_status_label(status: Column) -> Column:
    """Label of the first status; NULL unless the JSON text is a list whose first has one."""
    label = F.try_variant_get(_first_status(status), "$.label", "variant")
    return F.when(~_kind(label).isin("OBJECT", "ARRAY"), label.try_cast("string"))


def status_is_no_object(status: Column) -> Column:
    """True for a list of statuses whose first is not an object."""
    return F.coalesce(_kind(_first_status(status)) != "OBJECT", F.lit(False))


def status_label_is_nested(status: Column) -> Column:
    """True for a list of statuses whose first has a list or an object for a label."""
    label = F.try_variant_get(_first_status(status), "$.label", "variant")
    return F.coalesce(_kind(label).isin("OBJECT", "ARRAY"), F.lit(False))
