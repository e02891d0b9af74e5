"""From landed JSON documents to rows.

Each payload is parsed once, with text leaves; arrays are opened in place, so
nothing here shuffles. `posexplode_outer` keeps one row for a payload without
items, which carries its `unreadable` flag; the key test then drops it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet import schemas
from rivulet.functions import scalars, text

_PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}

_STATION_TEXTS = ["notation", "label", "riverName"]
_STATION_DOUBLES = ["lat", "long"]
_STATION_LONGS = ["easting", "northing"]
_READING_TEXTS = ["dateTime", "quality", "completeness"]
_READING_DOUBLES = ["value"]

# Fixed value: how a falsy "items" looks as text; such a payload has zero items.
_FALSY = ["", "0", "0.0", "-0", "false", "{}"]


def only_stations(landing: DataFrame) -> DataFrame:
    return landing.filter(F.col("dataset") == text.STATION_DATASET)


def only_readings(landing: DataFrame) -> DataFrame:
    """Payloads of readings; the prefix is case-sensitive, other datasets are left out."""
    return landing.filter(F.col("dataset").startswith(text.READINGS_PREFIX))


def only_ignored(landing: DataFrame) -> DataFrame:
    """Payloads that no layer reads; they only have to be JSON."""
    dataset = F.col("dataset")
    read = (dataset == text.STATION_DATASET) | dataset.startswith(text.READINGS_PREFIX)
    return landing.filter(~F.coalesce(read, F.lit(False)))


def ignored_issues(landing: DataFrame) -> DataFrame:
    """Payloads of ignored datasets that are not JSON (ISSUE schema)."""
    broken = F.col("payload").isNull() | F.try_parse_json("payload").isNull()
    return only_ignored(landing).filter(broken).select(
        F.col("id").alias("landing_id"),
        "dataset",
        F.lit(None).cast("bigint").alias("pos"),
        F.lit(NOT_JSON).alias("issue"),
        F.lit(None).cast("string").alias("detail"),
        "ingested_at",
    )


def _open(landing: DataFrame, document: StructType) -> DataFrame:
    parsed = landing.select(
        F.col("id").alias("landing_id"),
        "dataset",
        "ingested_at",
        F.from_json("payload", document, _PARSE).alias("doc"),
    )
    corrupt = F.col("doc")[schemas.CORRUPT]
    no_items = F.get_json_object(corrupt, "$.items").isin(_FALSY) & F.try_parse_json(
        corrupt
    ).isNotNull()
    unreadable = F.col("doc").isNull() | (
        corrupt.isNotNull() & ~F.coalesce(F.when(corrupt.isNotNull(), no_items), F.lit(False))
    )
    return parsed.withColumn("unreadable", unreadable)


def _items(
    landing: DataFrame, document: StructType, payload_columns: dict[str, Column] | None = None
) -> DataFrame:
    """One row per item: landing_id, dataset, ingested_at, unreadable, pos, item.

    `payload_columns` are computed once per payload, ahead of opening its items.
    """
    extra = payload_columns or {}
    return _open(landing, document).withColumns(extra).select(
        "landing_id",
        "dataset",
        "ingested_at",
        "unreadable",
        *extra,
        F.posexplode_outer(F.when(~F.col("unreadable"), F.col("doc.items"))).alias("pos", "item"),
    )


def _looks_nested(name: str) -> Column:
    leaf = F.col("item")[name]
    return F.coalesce(leaf.startswith("[") | leaf.startswith("{"), F.lit(False))


def _not_numeric(name: str, cast) -> Column:
    leaf = F.col("item")[name]
    return leaf.isNotNull() & (leaf != "NaN") & cast(leaf).isNull()


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def _suspect(texts: list[str], doubles: list[str], longs: list[str]) -> Column:
    """Cheap test that some item needs the exact look of `document_issues`."""
    return _any(
        [F.col("unreadable"), F.col("pos").isNotNull() & F.col("item").isNull()]
        + [_looks_nested(name) for name in texts]
        + [_not_numeric(name, scalars.to_double) for name in doubles]
        + [_not_numeric(name, scalars.to_long) for name in longs]
    )


def _odd_status(test: Callable[[Column], Column]) -> Column:
    """A test of the status of an item that becomes a station."""
    item = F.col("item")
    return ~text.is_blank(item["notation"]) & test(item["status"])


def _station_suspect() -> Column:
    status = _odd_status(scalars.status_is_no_object) | _odd_status(scalars.status_label_is_nested)
    found = _suspect(_STATION_TEXTS, _STATION_DOUBLES, _STATION_LONGS)
    return found | F.coalesce(status, F.lit(False))


def _reading_suspect() -> Column:
    bad_name = ~text.has_dataset_parts(F.col("dataset"))
    return _suspect(_READING_TEXTS, _READING_DOUBLES, []) | bad_name


def _watched(
    items: DataFrame, suspect: Callable[[], Column], watch: Observation | None
) -> DataFrame:
    if watch is None:
        return items
    return items.observe(watch, F.count_if(suspect()).alias("suspects"))


def flatten_stations(landing: DataFrame, watch: Observation | None = None) -> DataFrame:
    """One row per station item with a notation, plus its arrival order."""
    items = _watched(_items(only_stations(landing), schemas.STATION_DOC), _station_suspect, watch)
    item = F.col("item")
    return items.filter(~text.is_blank(item["notation"])).select(
        "landing_id",
        F.col("pos").cast("bigint").alias("pos"),
        item["notation"].alias("station_id"),
        item["label"].alias("label"),
        item["riverName"].alias("river_name"),
        scalars.to_double(item["lat"]).alias("lat"),
        scalars.to_double(item["long"]).alias("long"),
        scalars.to_long(item["easting"]).alias("easting"),
        scalars.to_long(item["northing"]).alias("northing"),
        scalars.first_status_label(item["status"]).alias("status"),
        "ingested_at",
    )


def flatten_readings(landing: DataFrame, watch: Observation | None = None) -> DataFrame:
    """One row per reading with a dateTime; parameter, unit and station come from the dataset name."""
    measure_id = text.dataset_measure(F.col("dataset"))
    named = {
        "station_id": text.measure_station(measure_id),
        "parameter": text.dataset_parameter(F.col("dataset")),
        "unit": text.measure_unit(measure_id),
        "measure_id": measure_id,
    }
    items = _items(only_readings(landing), schemas.READING_DOC, named)
    item = F.col("item")
    dated = ~text.is_blank(item["dateTime"]) & F.col("measure_id").isNotNull()
    return _watched(items, _reading_suspect, watch).filter(dated).select(
        "landing_id",
        F.col("pos").cast("bigint").alias("pos"),
        *named,
        item["dateTime"].alias("datetime"),
        scalars.to_double(item["value"]).alias("value"),
        item["quality"].alias("quality"),
        item["completeness"].alias("completeness"),
        "ingested_at",
    )


# Issues that stop a run; a text in a number field only becomes NULL and is listed.
UNREADABLE = "payload is not a document with items"
BAD_NAME = "dataset name has fewer than three parts"
BAD_ITEM = "item is not an object"
NESTED = "field is not a scalar"
BAD_STATUS = "first status is not an object"
NOT_JSON = "payload is not JSON"
NOT_NUMERIC = "not a number, taken as NULL"
FATAL = [UNREADABLE, BAD_NAME, BAD_ITEM, NESTED, BAD_STATUS, NOT_JSON]


def _leaf_issues(texts: list[str], doubles: list[str], longs: list[str]) -> list[Column]:
    nested = [
        F.when(_looks_nested(name), _issue(NESTED, F.lit(name)))
        for name in texts + doubles + longs
    ]
    casts = [(name, scalars.to_double) for name in doubles]
    casts += [(name, scalars.to_long) for name in longs]
    numeric = [
        F.when(_not_numeric(name, cast) & ~_looks_nested(name), _issue(NOT_NUMERIC, F.lit(name)))
        for name, cast in casts
    ]
    return nested + numeric


def _issue(kind: str, detail: Column) -> Column:
    return F.struct(F.lit(kind).alias("issue"), detail.cast("string").alias("detail"))


def _list_issues(items: DataFrame, leaf_issues: list[Column]) -> DataFrame:
    payload = F.when(F.col("unreadable"), _issue(UNREADABLE, F.lit(None)))
    no_object = F.when(
        F.col("pos").isNotNull() & F.col("item").isNull(), _issue(BAD_ITEM, F.lit(None))
    )
    found = F.filter(F.array(payload, no_object, *leaf_issues), lambda x: x.isNotNull())
    return items.select(
        "landing_id",
        "dataset",
        F.col("pos").cast("bigint").alias("pos"),
        F.inline(found),
        "ingested_at",
    )


def _drop_texts(issues: DataFrame, landing: DataFrame) -> DataFrame:
    """Takes out fields that only look nested: texts that start with a bracket.

    A text leaf shows '["a"]' for both the list and the text, so the few payloads
    in question are parsed once more as VARIANT, which keeps the type.
    """
    doubtful = issues.filter(F.col("issue").isin(NESTED, BAD_STATUS))
    suspects = landing.join(
        doubtful.select(F.col("landing_id").alias("id")).distinct(), "id", "left_semi"
    ).select(
        F.col("id").alias("landing_id"),
        F.from_json("payload", schemas.RAW_ITEMS_DOC, _PARSE)["items"].alias("items"),
    )
    raw = suspects.select("landing_id", F.posexplode("items").alias("pos", "raw"))
    fields = [*_STATION_TEXTS, *_READING_TEXTS, *_STATION_DOUBLES, *_STATION_LONGS]
    names = sorted({*fields, "value", "status"})
    shape = "struct<" + ",".join(f"{name}: variant" for name in names) + ">"
    opened = raw.select(
        "landing_id", F.col("pos").cast("bigint").alias("pos"), F.from_json("raw", shape).alias("v")
    )
    texts = opened.select(
        "landing_id",
        "pos",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("detail"),
                        F.schema_of_variant(F.col("v")[name]).alias("kind"),
                    )
                    for name in names
                ]
            )
        ),
    ).filter(F.col("kind") == "STRING")
    settled = texts.select("landing_id", "pos", "detail")
    kept = issues.filter(~F.col("issue").isin(NESTED, BAD_STATUS))
    return kept.unionByName(doubtful.join(settled, ["landing_id", "pos", "detail"], "left_anti"))


def document_issues(landing: DataFrame) -> DataFrame:
    """Every defect of the landed payloads as a row (ISSUE schema), ignored datasets included."""
    status = [
        F.when(_odd_status(scalars.status_is_no_object), _issue(BAD_STATUS, F.lit("status"))),
        F.when(_odd_status(scalars.status_label_is_nested), _issue(NESTED, F.lit("status"))),
    ]
    stations = _items(only_stations(landing), schemas.STATION_DOC)
    readings = _items(only_readings(landing), schemas.READING_DOC)
    bad_names = (
        only_readings(landing)
        .filter(~text.has_dataset_parts(F.col("dataset")))
        .select(
            F.col("id").alias("landing_id"),
            "dataset",
            F.lit(None).cast("bigint").alias("pos"),
            F.lit(BAD_NAME).alias("issue"),
            F.col("dataset").alias("detail"),
            "ingested_at",
        )
    )
    found = _list_issues(
        stations, _leaf_issues(_STATION_TEXTS, _STATION_DOUBLES, _STATION_LONGS) + status
    ).unionByName(_list_issues(readings, _leaf_issues(_READING_TEXTS, _READING_DOUBLES, [])))
    found = _drop_texts(found, landing).unionByName(bad_names)
    found = found.unionByName(ignored_issues(landing))
    return found.select(*schemas.ISSUE.fieldNames())


# --- station documents: what a station offers --------------------------------


def _named_list(leaf: Column) -> Column:
    """The JSON text of a list of named objects, opened; empty for any other text."""
    opened = F.from_json(F.when(leaf.startswith("["), leaf), schemas.NAMED_LIST)
    return F.coalesce(opened, F.array().cast(schemas.NAMED_LIST))


def station_catalogue(landing: DataFrame) -> DataFrame:
    """One row per station item: what it observes and its measures, still as arrays.

    `offered` holds normalised property names, `measures` pairs of normalised
    parameter and measure id.
    """
    item = F.col("item")
    named = F.filter(_named_list(item["observedProperty"]), lambda p: ~text.is_blank(p["@id"]))
    offered = F.transform(named, lambda p: text.normalize_text(text.last_segment(p["@id"])))
    measures = F.transform(
        _named_list(item["measures"]),
        lambda m: F.struct(
            text.normalize_text(m["parameter"]).alias("parameter"),
            text.last_segment(m["@id"]).alias("measure_id"),
        ),
    )
    return (
        _items(only_stations(landing), schemas.CATALOGUE_DOC)
        .filter(item.isNotNull())
        .select(
            "landing_id",
            F.col("pos").cast("bigint").alias("pos"),
            item["notation"].alias("station_id"),
            item["label"].alias("label"),
            offered.alias("offered"),
            measures.alias("measures"),
            "ingested_at",
        )
    )


def observed_properties(catalogue: DataFrame) -> DataFrame:
    """One row per station and observed property."""
    return catalogue.select(
        "landing_id", "pos", "station_id", F.explode("offered").alias("parameter")
    )
