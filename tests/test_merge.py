import random

import pytest

from rivulet import schemas
from rivulet.operators import conform, keys, merge
from tests.conftest import NEW, OLD, dicts

ORDERED = "k string, v string, n bigint, pos bigint"


def test_last_and_first_per_key_do_not_depend_on_input_order(spark):
    rows = [(f"k{i % 7}", f"v{i}", i // 2, i % 2) for i in range(200)]
    want_last = {f"k{k}": max((r for r in rows if r[0] == f"k{k}"), key=lambda r: r[2:])
                 for k in range(7)}
    want_first = {f"k{k}": min((r for r in rows if r[0] == f"k{k}"), key=lambda r: r[2:])
                  for k in range(7)}
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, ORDERED).repartition(5)
        assert {r.k: tuple(r) for r in merge.last_per_key(df, ["k"], ["n", "pos"]).collect()} == want_last
        assert {r.k: tuple(r) for r in merge.first_per_key(df, ["k"], ["n", "pos"]).collect()} == want_first


def test_upsert_writes_whole_row_and_keeps_unmatched(spark):
    existing = spark.createDataFrame([("a", "old", "x"), ("b", "old", "y")], "k string, v string, w string")
    incoming = spark.createDataFrame(
        [("a", "new1", "z", 1), ("a", "new2", None, 2), ("c", "new", "q", 1)],
        "k string, v string, w string, n bigint",
    )
    assert dicts(merge.upsert(existing, incoming, ["k"], ["n"]), "k") == [
        {"k": "a", "v": "new2", "w": None},
        {"k": "b", "v": "old", "w": "y"},
        {"k": "c", "v": "new", "w": "q"},
    ]


def test_upsert_into_and_from_nothing(spark):
    layout = schemas.STATION
    nothing = schemas.empty(spark, layout)
    rows = spark.createDataFrame([("a", "L", None, 1.0, 2.0, 3, 4, None, NEW)], layout)
    assert dicts(conform.merge_snapshot(nothing, rows)) == dicts(rows)
    assert dicts(conform.merge_snapshot(rows, nothing)) == dicts(rows)
    assert conform.merge_snapshot(nothing, nothing).count() == 0


def test_upsert_keeps_key_columns(spark):
    existing = spark.createDataFrame([(7, "a", "old")], "key bigint, k string, v string")
    incoming = spark.createDataFrame([("a", "new"), ("b", "new")], "k string, v string")
    assert dicts(merge.upsert(existing, incoming, ["k"], ["k"], keep=("key",)), "k") == [
        {"key": 7, "k": "a", "v": "new"},
        {"key": None, "k": "b", "v": "new"},
    ]


@pytest.mark.parametrize("by_range", [False, True])
def test_insert_if_absent(spark, by_range):
    existing = spark.createDataFrame([("a", "old")], "k string, v string")
    incoming = spark.createDataFrame(
        [("a", "x", 1), ("b", "second", 3), ("b", "first", 2), (None, "null key", 4), ("c", None, 5)],
        "k string, v string, n bigint",
    )
    new = merge.insert_if_absent(incoming, existing, ["k"], ["n"], ["k", "v"], by_range)
    assert dicts(new, "k") == [{"k": "b", "v": "first", "n": 2}]


def measure(landing_id, station="W1", when="2026-02-25T00:00:00Z", stamp=NEW, value=1.0, **kw):
    row = dict(landing_id=landing_id, pos=0, station_id=station, parameter="Water Level",
               unit="mAOD", measure_id=f"{station}-stage-mAOD", datetime=when, value=value,
               quality=None, completeness=None, ingested_at=stamp)
    row.update(kw)
    return tuple(row[f] for f in schemas.MEASURE.fieldNames())


def silver(spark, rows, stations=("W1",), existing=()):
    known = spark.createDataFrame([(s,) for s in stations], "station_id string")
    return conform.new_silver_measures(
        spark.createDataFrame(rows, schemas.MEASURE),
        known,
        spark.createDataFrame(list(existing), schemas.MEASURE) if existing
        else schemas.empty(spark, schemas.MEASURE),
    )


def test_silver_conforms_and_takes_the_first_of_equal_keys(spark):
    rows = [measure(2, value=2.0), measure(1, value=1.0),
            measure(3, when="2026-02-25T00:00:00+00:00", value=3.0)]
    (row,) = dicts(silver(spark, rows))
    assert row["datetime"] == "2026-02-25T00:00:00+00:00"
    assert row["parameter"] == "water level"
    assert (row["landing_id"], row["value"]) == (1, 1.0)


def test_silver_drops_orphans_and_rows_without_required_fields(spark):
    rows = [measure(1, station="W9"), measure(2, unit=None), measure(3, datetime=None),
            measure(4, unit="")]
    assert [r["landing_id"] for r in dicts(silver(spark, rows))] == [4]


def test_same_reading_in_two_batches_is_two_rows(spark):
    assert silver(spark, [measure(1, stamp=OLD), measure(2, stamp=NEW)]).count() == 2


def test_silver_skips_what_is_there(spark):
    there = measure(1, when="2026-02-25T00:00:00+00:00")
    assert silver(spark, [measure(5)], existing=[there]).count() == 0


def test_facts_look_up_the_key_and_are_inserted_once(spark):
    rows = spark.createDataFrame([measure(1, when="2026-02-25T00:00:00+00:00"),
                                  measure(2, station="W9")], schemas.MEASURE)
    dim = spark.createDataFrame([(11, "W1")], "station_key bigint, station_id string")
    nothing = schemas.empty(spark, schemas.FACT_MEASUREMENT)
    facts = conform.new_facts(rows, dim, nothing)
    (fact,) = dicts(facts)
    assert (fact["station_key"], fact["station_id"]) == (11, "W1")
    assert conform.new_facts(rows, dim, facts).count() == 0


def test_assigned_keys_are_dense_in_order_and_above_the_start(spark):
    rows = [(f"s{i:03d}",) for i in range(500)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string").repartition(6)
    keyed = keys.assign_keys(df, "key", ["k"], 100).orderBy("k").collect()
    assert [(r.key, r.k) for r in keyed] == [(101 + i, f"s{i:03d}") for i in range(500)]


def test_assigned_keys_leave_present_ones(spark):
    df = spark.createDataFrame([(5, "b"), (None, "d"), (None, "a"), (2, "c")], "key bigint, k string")
    keyed = keys.assign_keys(df, "key", ["k"], 5)
    assert {r.k: r.key for r in keyed.collect()} == {"b": 5, "c": 2, "a": 6, "d": 7}


def test_assign_keys_to_nothing(spark):
    assert keys.assign_keys(schemas.empty(spark, schemas.STATION), "key", ["station_id"]).count() == 0
