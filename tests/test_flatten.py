import json

from pyspark.sql import functions as F

from rivulet.operators import flatten
from tests.conftest import LEVEL, NEW, SEARCH, dataset, dicts, doc, landing, offering, reading, station

NAME = dataset("water_level", LEVEL)


def stations_of(spark, *payloads):
    rows = [(SEARCH, p, NEW) for p in payloads]
    return dicts(flatten.flatten_stations(landing(spark, *rows)), "landing_id", "pos")


def readings_of(spark, *payloads, name=NAME):
    rows = [(name, p, NEW) for p in payloads]
    return dicts(flatten.flatten_readings(landing(spark, *rows)), "landing_id", "pos")


def test_station_fields(spark):
    items = [
        station("Q1", "QUAY", riverName=None, lat="50.5", long=-4, easting="210000", status=[]),
        station("Q2", None, lat=1e2, northing=12.0, status=[{"label": "Suspended"}, "x"]),
    ]
    first, second = stations_of(spark, doc(), doc(*items))
    assert first == {
        "landing_id": 2, "pos": 0, "station_id": "Q1", "label": "QUAY", "river_name": None,
        "lat": 50.5, "long": -4.0, "easting": 210000, "northing": None, "status": None,
        "ingested_at": NEW,
    }
    assert (second["label"], second["lat"], second["northing"]) == (None, 100.0, 12)
    assert (second["pos"], second["status"]) == (1, "Suspended")


def test_stations_stay_whatever_their_catalogue_looks_like(spark):
    shapes = [{"@id": "m"}, ["http://example.org/m"], "m", [{"@id": "m"}, 3], None]
    items = [station(f"S{i}", measures=s, observedProperty=s) for i, s in enumerate(shapes)]
    assert [r["station_id"] for r in stations_of(spark, doc(*items))] == [f"S{i}" for i in range(5)]


def test_status_is_null_unless_a_list_with_an_entry(spark):
    rows = stations_of(
        spark, doc(station("A"), station("B", status=[]), station("C", status={"label": "X"}))
    )
    assert [r["status"] for r in rows] == [None, None, None]


def test_items_missing_null_or_empty(spark):
    payloads = ['{"meta":{}}', '{"items":null}', '{"items":[]}', '{"items":{}}', '{"items":""}']
    assert stations_of(spark, *payloads) == []
    assert readings_of(spark, *payloads) == []
    rows = [(SEARCH, p, NEW) for p in payloads] + [(NAME, p, NEW) for p in payloads]
    assert flatten.document_issues(landing(spark, *rows)).count() == 0


def test_items_without_key_are_skipped(spark):
    keyless = [station(None), station(""), {"label": "x"}, station("A")]
    assert [(r["station_id"], r["pos"]) for r in stations_of(spark, doc(*keyless))] == [("A", 3)]
    undated = [reading(None), reading(""), {"value": 1}, reading()]
    assert [r["pos"] for r in readings_of(spark, doc(*undated))] == [3]


def test_reading_fields(spark):
    (row,) = readings_of(spark, doc(reading(quality="Good", completeness="Complete")))
    assert row == {
        "landing_id": 1, "pos": 0, "station_id": "L31", "parameter": "water level",
        "unit": "mAOD", "measure_id": LEVEL, "datetime": "2026-02-25T09:45:00Z", "value": 6.5,
        "quality": "Good", "completeness": "Complete", "ingested_at": NEW,
    }


def test_value_spellings(spark):
    payload = (
        '{"items":[{"dateTime":"a","value":"1.5"},{"dateTime":"b","value":NaN},'
        '{"dateTime":"c"},{"dateTime":"d","value":null},{"dateTime":"e","value":2}]}'
    )
    assert [r["value"] for r in readings_of(spark, payload)] == [1.5, None, None, None, 2.0]


def test_last_of_a_repeated_object_key_counts(spark):
    (row,) = readings_of(spark, '{"items":[{"dateTime":"a","value":1,"value":2}]}')
    assert row["value"] == 2.0


def test_fourth_name_part_is_ignored_and_two_are_an_issue(spark):
    assert readings_of(spark, doc(reading()), name=NAME + "__x")[0]["measure_id"] == LEVEL
    short = landing(spark, ("readings_latest__short", doc(reading()), NEW))
    assert flatten.flatten_readings(short).count() == 0
    (issue,) = dicts(flatten.document_issues(short))
    assert issue["issue"] == flatten.BAD_NAME
    assert issue["detail"] == "readings_latest__short"


def test_routing_is_case_sensitive_and_ignores_other_datasets(spark):
    rows = landing(
        spark,
        ("READINGS_LATEST__a__m", doc(reading()), NEW),
        ("readings_latest_a", doc(reading()), NEW),
        ("rainfall", doc(reading()), NEW),
        ("Station_Search", doc(station()), NEW),
    )
    assert flatten.flatten_readings(rows).count() == 0
    assert flatten.flatten_stations(rows).count() == 0
    assert flatten.document_issues(rows).count() == 0


def issues_of(spark, name, payload):
    found = flatten.document_issues(landing(spark, (name, payload, NEW)))
    return sorted((i["pos"], i["issue"], i["detail"]) for i in dicts(found))


def test_unreadable_payloads(spark):
    bad = ["not json", "", "null", "[1]", '{"items":[', '{"items":{"a":1}}', '{"items":"abc"}', "7"]
    for payload in bad:
        assert issues_of(spark, NAME, payload) == [(None, flatten.UNREADABLE, None)], payload
        assert readings_of(spark, payload) == [], payload


def test_item_that_is_no_object(spark):
    assert issues_of(spark, NAME, '{"items":[null,{"dateTime":"a"}]}') == [
        (0, flatten.BAD_ITEM, None)
    ]


def test_nested_field_is_told_from_a_text_with_bracket(spark):
    payload = json.dumps({
        "items": [
            {"notation": "A", "label": ["x"]},
            {"notation": "B", "label": "[disused] weir"},
            {"notation": "C", "label": "[1]"},
            {"notation": "D", "label": {"a": 1}},
            {"notation": "E", "label": '{"a":1}'},
        ]
    })
    assert issues_of(spark, SEARCH, payload) == [
        (0, flatten.NESTED, "label"), (3, flatten.NESTED, "label"),
    ]
    assert [r["label"] for r in stations_of(spark, payload)][1:3] == ["[disused] weir", "[1]"]


def test_text_in_a_number_field_is_listed_but_not_fatal(spark):
    found = issues_of(spark, SEARCH, doc(station(lat="north", easting=1.5)))
    assert found == [(0, flatten.NOT_NUMERIC, "easting"), (0, flatten.NOT_NUMERIC, "lat")]
    assert flatten.NOT_NUMERIC not in flatten.FATAL
    (row,) = stations_of(spark, doc(station(lat="north", easting=1.5)))
    assert (row["lat"], row["easting"]) == (None, None)


def test_catalogue(spark):
    catalogue = flatten.station_catalogue(landing(spark, (SEARCH, doc(offering()), NEW)))
    row = catalogue.first()
    assert row.offered == ["ammonium", "turbidity", "water level"]
    assert [(m.parameter, m.measure_id) for m in row.measures][0] == ("water level", LEVEL)


def test_observed_properties_skip_blank_ids(spark):
    item = station(observedProperty=[{"@id": ""}, None, {"x": 1}, {"@id": "http://e/op/p-H/"}])
    catalogue = flatten.station_catalogue(landing(spark, (SEARCH, doc(item), NEW)))
    assert dicts(flatten.observed_properties(catalogue).select("parameter")) == [
        {"parameter": "p h"}
    ]


def test_non_ascii_text_is_kept(spark):
    (row,) = stations_of(spark, doc(station(label="Wäg – ÉÀ")))
    assert row["label"] == "Wäg – ÉÀ"
    df = spark.createDataFrame([("Wäg",)], "v string")
    assert df.select(F.to_json(F.struct("v"))).first()[0] == '{"v":"Wäg"}'
