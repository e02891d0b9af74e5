"""One StructType per table and per document shape."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


def _text(*names: str) -> list[tuple[str, object]]:
    return [(name, StringType()) for name in names]


RAW_LANDING = _struct(("id", LongType()), *_text("dataset", "payload", "ingested_at"))

STATION = _struct(
    *_text("station_id", "label", "river_name"),
    ("lat", DoubleType()),
    ("long", DoubleType()),
    ("easting", LongType()),
    ("northing", LongType()),
    *_text("status", "ingested_at"),
)

_READING = [
    *_text("station_id", "parameter", "unit", "measure_id", "datetime"),
    ("value", DoubleType()),
    *_text("quality", "completeness", "ingested_at"),
]

# (landing_id, pos) is the arrival order of a reading: payload, then item within it.
MEASURE = _struct(("landing_id", LongType()), ("pos", LongType()), *_READING)

DIM_STATION = StructType([StructField("station_key", LongType()), *STATION.fields])

FACT_MEASUREMENT = _struct(("measurement_key", LongType()), ("station_key", LongType()), *_READING)

ISSUE = _struct(
    ("landing_id", LongType()),
    *_text("dataset"),
    ("pos", LongType()),
    *_text("issue", "detail", "ingested_at"),
)

# Why a request could not be served, in the order of stations and checks.
REQUEST_ERROR = _struct(
    ("landing_id", LongType()),
    ("pos", LongType()),
    ("nth", LongType()),
    *_text("station_id", "reason", "detail", "ingested_at"),
)

# Where the rows of a bulk-loaded file start in the numbering of the landing.
LANDED_FILE = _struct(*_text("kind", "file"), ("first", LongType()), *_text("ingested_at"))

LANDED_COUNT = _struct(*_text("kind"), ("payloads", LongType()), *_text("ingested_at"))

COUNTER = _struct(("value", LongType()), *_text("name"))

# Documents are read with text leaves and cast afterwards: a typed leaf turns a
# quoted number, or 437673.0 in an integer field, into NULL without a trace.
CORRUPT = "_corrupt_record"

_NAMED = _struct(*_text("@id", "parameter"))

_STATION_TEXTS = _text(
    "notation", "label", "riverName", "lat", "long", "easting", "northing", "status"
)
STATION_DOC = _struct(("items", ArrayType(_struct(*_STATION_TEXTS))), *_text(CORRUPT))
# What a station offers is opened in a second step: of another shape than expected, it
# must not cost the station its row.
CATALOGUE_ITEM = _struct(*_STATION_TEXTS, *_text("observedProperty", "measures"))
CATALOGUE_DOC = _struct(("items", ArrayType(CATALOGUE_ITEM)), *_text(CORRUPT))
NAMED_LIST = ArrayType(_NAMED)

READING_ITEM = _struct(*_text("dateTime", "value", "quality", "completeness"))
READING_DOC = _struct(("items", ArrayType(READING_ITEM)), *_text(CORRUPT))

RAW_ITEMS_DOC = _struct(("items", ArrayType(StringType())), *_text(CORRUPT))

# A list of any content: tells a list from a text that merely starts with "[".
TEXT_LIST = ArrayType(StringType())


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, in a form the optimizer sees as empty (createDataFrame([]) counts as huge)."""
    columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    return spark.range(1).selectExpr(*columns).limit(0)
