import random

import pytest

from rivulet.operators import batches, flatten, lookup
from tests.conftest import AMMONIUM, LEVEL, NEW, OLD, SEARCH, TURBIDITY, dicts, doc, landing, offering, station

WANTED = ["ammonium", "turbidity"]


def catalogue(spark, *items):
    return flatten.station_catalogue(landing(spark, (SEARCH, doc(*items), NEW)))


def resolved(spark, items, wanted):
    rows = dicts(lookup.resolve_measures(catalogue(spark, *items), wanted), "pos", "nth")
    return [(r["station_id"], r["parameter"], r["measure_ids"]) for r in rows]


def test_resolve_gives_all_units_sorted(spark):
    assert resolved(spark, [offering()], WANTED) == [
        ("L31", "ammonium", [AMMONIUM]), ("L31", "turbidity", TURBIDITY),
    ]


def test_resolve_normalises_and_collapses_repeated_requests(spark):
    assert resolved(spark, [offering()], ["Water_Level", " WATER-level"]) == [
        ("L31", "water level", [LEVEL])
    ]


def test_resolve_of_a_blank_request_is_empty(spark):
    item = offering()
    item["measures"].append({"@id": "http://e/x", "parameter": ""})
    assert resolved(spark, [item], [" "]) == [("L31", "", [])]


def test_missing_parameters_name_what_is_available(spark):
    (row,) = dicts(lookup.missing_parameters(catalogue(spark, offering()), ["pH", *WANTED]))
    assert row["missing"] == ["pH"]
    assert row["available"] == ["ammonium", "turbidity", "water level"]
    assert lookup.missing_parameters(catalogue(spark, offering()), WANTED).count() == 0


def test_station_errors(spark):
    bare = station("B", observedProperty=[{"@id": "http://e/op/ammonium"}])
    half = offering()
    half["notation"], half["measures"] = "C", half["measures"][:1]
    errors = lookup.station_errors(catalogue(spark, offering(), bare, half), ["ammonium"])
    assert sorted((r["station_id"], r["reason"]) for r in dicts(errors)) == [
        ("B", "station has no measures"), ("C", "no measure for parameter"),
    ]


def test_errors_come_in_the_order_of_stations_and_checks(spark):
    nameless = offering()
    nameless["measures"][1] = {"parameter": "turbidity"}
    bare = station("B")
    errors = lookup.request_errors(catalogue(spark, nameless, bare, offering()), ["turbidity", "x"])
    assert [(r["station_id"], r["reason"], r["detail"]) for r in dicts(errors, "pos", "nth")] == [
        ("L31", "parameter not offered", "missing: x; available: ammonium, turbidity, water level"),
        ("L31", "no measure for parameter", "x"),
        ("L31", "measure without an id", "turbidity"),
        ("B", "parameter not offered", "missing: turbidity, x; available: "),
        ("B", "station has no measures", ""),
        ("L31", "parameter not offered", "missing: x; available: ammonium, turbidity, water level"),
        ("L31", "no measure for parameter", "x"),
    ]


def test_search_takes_the_first_by_key(spark):
    rows = [(f"S{i}", f"MILL {i}") for i in range(9)] + [("A", "WEIR")]
    df = spark.createDataFrame(rows, "station_id string, label string")
    found = lookup.search_stations(df, "MILL", "label", "station_id", 5).collect()
    assert [r.station_id for r in found] == ["S0", "S1", "S2", "S3", "S4"]
    assert lookup.search_stations(df, "mill", "label", "station_id").count() == 0


def test_latest_n_on_a_hot_key(spark):
    """A third of the rows share one key."""
    rows = [("hot" if i % 3 == 0 else f"m{i % 40}", f"t{(i * 37) % 500:03d}", i) for i in range(1500)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "m string, t string, i bigint").repartition(4)
    got = dicts(lookup.latest_n(df, 5, ["m"], "t", ["i"]), "m", "rank")
    want = []
    for key in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[2])
        own.sort(key=lambda r: r[1], reverse=True)
        want += [{"m": m, "t": t, "i": i, "rank": n} for n, (m, t, i) in enumerate(own[:5], start=1)]
    assert got == want


def test_latest_n_goes_by_instant(spark):
    stamps = ["2026-03-01T00:30:00+01:00", "2026-03-01T00:00:00Z", "2026-03-01T00:00:00.500Z", "soon"]
    df = spark.createDataFrame([("m", t, i) for i, t in enumerate(stamps)], "m string, t string, i int")
    got = dicts(lookup.latest_n(df, 3, ["m"], "t", ["i"]), "rank")
    assert [r["i"] for r in got] == [2, 1, 0]


def test_semi_anti_and_key_lookup(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n bigint")
    reference = spark.createDataFrame([("a", 10), ("z", 11)], "k string, key bigint")
    assert dicts(lookup.keep_known(rows, reference, "k")) == [{"k": "a", "n": 1}]
    assert [r["n"] for r in dicts(lookup.orphans(rows, reference, "k"), "n")] == [2, 3]
    assert dicts(lookup.attach(rows, reference, "k", "key")) == [{"key": 10, "k": "a", "n": 1}]


def test_latest_batch(spark):
    rows = landing(spark, ("a", "{}", OLD), ("b", "{}", NEW), ("c", "{}", OLD))
    assert batches.latest_batch(rows) == NEW
    assert [r.dataset for r in batches.only_latest(rows, rows).collect()] == ["b"]
    assert batches.latest_batch(rows.limit(0)) is None


def test_overwriting_keeps_other_datasets(spark):
    names = ["station_search", "readings_latest__a__b", "READINGS_LATESTx", "Station_Search", "rain"]
    rows = landing(spark, *[(n, "{}", OLD) for n in names])
    assert sorted(r.dataset for r in batches.survivors(rows).collect()) == ["Station_Search", "rain"]


def test_stamping_older_layouts(spark):
    rows = landing(spark, ("a", "{}", None), ("b", "{}", OLD))
    assert [r.ingested_at for r in batches.stamped(rows, NEW).orderBy("id").collect()] == [NEW, OLD]
    bare = rows.drop("ingested_at")
    assert {r.ingested_at for r in batches.stamped(bare, NEW).collect()} == {NEW}
