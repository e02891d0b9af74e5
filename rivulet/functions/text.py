"""Text, identifier and timestamp expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dataset names of the landing table.
STATION_DATASET = "station_search"
READINGS_KIND = "readings_latest"
SEPARATOR = "__"
READINGS_PREFIX = READINGS_KIND + SEPARATOR

# Fixed value: the accepted ISO-8601 texts, after Z has become +00:00.
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?([+-]\d{2}:\d{2})?)?$"


def normalize_text(text: Column) -> Column:
    """Lower case, with runs of blanks, hyphens and underscores as one space; NULL as ''."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[\s\x1c-\x1f_-]+", " ")
    return F.trim(spaced)


def last_segment(uri: Column) -> Column:
    """The last path segment; slashes at the end do not count."""
    return F.substring_index(F.rtrim(uri, F.lit("/")), "/", -1)


def readings_dataset(parameter: Column, measure_id: Column) -> Column:
    return F.concat_ws(
        SEPARATOR, F.lit(READINGS_KIND), F.replace(parameter, F.lit(" "), F.lit("_")), measure_id
    )


def dataset_parts(dataset: Column) -> Column:
    return F.split(dataset, SEPARATOR, -1)


def has_dataset_parts(dataset: Column) -> Column:
    return F.size(dataset_parts(dataset)) >= 3


def dataset_parameter(dataset: Column) -> Column:
    return F.replace(F.get(dataset_parts(dataset), F.lit(1)), F.lit("_"), F.lit(" "))


def dataset_measure(dataset: Column) -> Column:
    return F.get(dataset_parts(dataset), F.lit(2))


def measure_unit(measure_id: Column) -> Column:
    return F.substring_index(measure_id, "-", -1)


def measure_station(measure_id: Column) -> Column:
    return F.substring_index(measure_id, "-", 1)


def lower_ascii(text: Column) -> Column:
    """Lower case for A-Z only; other letters keep their case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def conform_timestamp(text: Column) -> Column:
    return F.replace(text, F.lit("Z"), F.lit("+00:00"))


def is_iso_timestamp(text: Column) -> Column:
    """True for an ISO-8601 text of a day that exists; NULL counts as False.

    The pattern is needed because the cast alone also takes '2026' or 'T10:00'.
    """
    conformed = conform_timestamp(text)
    parses = F.try_to_timestamp(conformed).isNotNull()
    return F.coalesce(conformed.rlike(ISO_PATTERN) & parses, F.lit(False))


def to_instant(text: Column) -> Column:
    """The point in time an ISO-8601 text names; NULL for any other text."""
    conformed = conform_timestamp(text)
    return F.when(conformed.rlike(ISO_PATTERN), F.try_to_timestamp(conformed))


def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def any_blank(names: list[str]) -> Column:
    """True when at least one of the columns is NULL or ''."""
    blank = F.lit(False)
    for name in names:
        blank = blank | is_blank(F.col(name))
    return blank


# Names of the kinds of landed datasets.
STATIONS, READINGS, OTHER = "stations", "readings", "other"


def dataset_kind(dataset: Column) -> Column:
    """What an overwriting run drops (stations, readings), or other; NULL is other."""
    return (
        F.when(dataset == STATION_DATASET, F.lit(STATIONS))
        .when(in_dataset_kind(dataset), F.lit(READINGS))
        .otherwise(F.lit(OTHER))
    )


def in_dataset_kind(dataset: Column, pattern: str = READINGS_KIND + "%") -> Column:
    """LIKE without regard to case, where '_' stands for any character."""
    return dataset.ilike(pattern)
