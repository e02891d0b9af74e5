"""Landing, the layer jobs, the whole run; written tables in a folder per test."""

import json

import pytest

from rivulet import ValidationError
from rivulet.operators import batches, flatten
from rivulet.plans import refine, run
from rivulet.sources import landing as source
from rivulet.sources.tables import LANDING, Warehouse
from tests.conftest import (
    AMMONIUM, NEW, OLD, SEARCH, TURBIDITY, dataset, dicts, doc, landing, offering, reading, station,
)

AMMONIUM_SET = dataset("ammonium", AMMONIUM)
TURBIDITY_SETS = [dataset("turbidity", m) for m in TURBIDITY]
BANK_SET = TURBIDITY_SETS[0]
PARAMS = ["ammonium", "turbidity"]


def put(warehouse, *rows):
    """Lands rows (dataset, payload, stamp) with ids that follow those already there."""
    spark = warehouse.spark
    start = warehouse.read(LANDING).count()
    df = landing(spark, *rows)
    warehouse.append(LANDING, df.withColumn("id", df.id + start))


def two_batches(warehouse):
    """Two stations each time; four readings of the newer batch, the zero among them."""
    put(
        warehouse,
        (BANK_SET, doc(reading("2026-02-23T22:15:00Z", 31), reading("2026-02-23T22:30:00Z", 28)), OLD),
        (SEARCH, doc(station("L40", "FORD"), station(label="WEIR POOL")), OLD),
    )
    ammonium = [reading(f"2026-02-25T09:{m}:00Z", v) for m, v in ((30, 0.11), (15, 0.0), (45, 0.08))]
    put(
        warehouse,
        (AMMONIUM_SET, doc(*ammonium), NEW),
        (SEARCH, doc(station("L40", "OX FORD"), station()), NEW),
        (BANK_SET, doc(reading()), NEW),
    )


def column(warehouse, table, name):
    return sorted(r[name] for r in dicts(warehouse.read(table)))


# --- landing -----------------------------------------------------------------


def run_inputs(spark, *items, measures=(AMMONIUM, *TURBIDITY)):
    """One document of stations; ten readings of each measure, a quarter of an hour apart."""
    documents = spark.createDataFrame([(doc(*items),)], "payload string")
    rows = [
        (m, f"2026-02-25T{7 + q // 4:02d}:{q % 4 * 15:02d}:00Z", 0.4 * k + 0.05 * q, "Good" if q % 3 else None, None)
        for k, m in enumerate(measures)
        for q in range(10)
    ]
    readings = spark.createDataFrame(
        rows, "measure_id string, dateTime string, value double, quality string, completeness string"
    )
    return documents, readings


def test_land_run(spark, warehouse):
    summary = source.land_run(
        warehouse, *run_inputs(spark, offering()), "LOCK", PARAMS, limit=3, ingested_at=NEW
    )
    assert summary == {"raw_rows_inserted": 5, "ingested_at": NEW}
    rows = dicts(warehouse.read(LANDING), "id")
    assert [r["dataset"] for r in rows] == [SEARCH, AMMONIUM_SET, *TURBIDITY_SETS]
    assert [r["id"] for r in rows] == [1, 2, 3, 4, 5]
    assert json.loads(rows[0]["payload"])["items"][0]["notation"] == "L31"
    newest = json.loads(rows[1]["payload"])["items"]
    assert [i["dateTime"][11:16] for i in newest] == ["09:15", "09:00", "08:45"]


def test_land_run_takes_the_first_station_unless_told(spark, warehouse):
    second = offering()
    second["notation"] = "L80"
    inputs = run_inputs(spark, second, offering())
    source.land_run(warehouse, *inputs, "LOCK", PARAMS, ingested_at=OLD)
    assert warehouse.read(LANDING).count() == 5
    items = json.loads(dicts(warehouse.read(LANDING), "id")[0]["payload"])["items"]
    assert [i["notation"] for i in items] == ["L31", "L80"]


def test_measure_without_readings_lands_an_empty_document(spark, warehouse):
    inputs = run_inputs(spark, offering(), measures=TURBIDITY)
    source.land_run(warehouse, *inputs, "LOCK", ["ammonium"], ingested_at=NEW)
    assert json.loads(dicts(warehouse.read(LANDING), "id")[1]["payload"]) == {"items": []}


@pytest.mark.parametrize(
    ("wanted", "params", "message"),
    [
        ("LOCK", ["pH"], "missing: pH; available: ammonium, turbidity, water level"),
        ("WEIR", PARAMS, "no station found"),
    ],
)
def test_land_run_refuses_and_lands_nothing(spark, warehouse, wanted, params, message):
    with pytest.raises(ValidationError, match=message):
        source.land_run(warehouse, *run_inputs(spark, offering()), wanted, params)
    assert warehouse.read(LANDING).count() == 0


def test_overwriting_run_drops_older_documents_only(spark, warehouse):
    put(warehouse, (SEARCH, "{}", OLD), ("Readings_Latest__x", "{}", OLD), ("rain", "{}", OLD))
    warehouse.reserve(LANDING, 3)
    put_before = warehouse.read(LANDING).count()
    summary = source.land_run(
        warehouse, *run_inputs(spark, offering()), "LOCK", ["ammonium"], append=False, ingested_at=NEW
    )
    rows = dicts(warehouse.read(LANDING), "id")
    assert (put_before, summary["raw_rows_inserted"]) == (3, 2)
    assert [(r["id"], r["dataset"], r["ingested_at"]) for r in rows] == [
        (3, "rain", OLD), (4, SEARCH, NEW), (5, AMMONIUM_SET, NEW),
    ]


def test_drop_datasets_may_leave_nothing(warehouse):
    put(warehouse, ("a", "{}", OLD), ("b", "{}", OLD))
    source.drop_datasets(warehouse, ["a"])
    assert column(warehouse, LANDING, "dataset") == ["b"]
    source.drop_datasets(warehouse, [], "B%")
    assert warehouse.read(LANDING).count() == 0
    put(warehouse, ("c", "{}", NEW))
    assert column(Warehouse(warehouse.spark, warehouse.root), LANDING, "dataset") == ["c"]


def test_payload_round_trip_and_default_stamp(warehouse):
    text = json.dumps({"hello": "wörld", "value": 42}, ensure_ascii=False)
    summary = source.land_payload(warehouse, "x", text)
    (row,) = dicts(warehouse.read(LANDING))
    assert json.loads(row["payload"]) == {"hello": "wörld", "value": 42}
    assert row["ingested_at"] == summary["ingested_at"]
    assert row["ingested_at"].endswith("+00:00")


def test_given_stamps_have_one_spelling():
    given = ["2026-02-25T00:30:00+01:00", "2026-02-25T00:00:00Z", "2026-02-25T00:00:00.500Z", "2026-02-25T00:00:01"]
    made = [source.batch_stamp(g) for g in given]
    assert made == sorted(made)
    assert (made[0], made[1]) == ("2026-02-24T23:30:00+00:00", "2026-02-25T00:00:00+00:00")
    with pytest.raises(ValidationError, match="no ISO time"):
        source.batch_stamp("yesterday")


def test_bulk_landing_numbers_copies_without_a_shuffle(spark, warehouse):
    """A third of the payloads are copies of one; each gets its own id."""
    rows = spark.range(0, 3000, 1, 5).selectExpr(
        "if(id % 3 = 0, 'same', concat('d', id)) AS dataset", "'{}' AS payload"
    )
    source.land_payloads(warehouse, rows, ingested_at=OLD)
    source.land_payloads(warehouse, rows.limit(10), ingested_at=NEW)
    landed = warehouse.read(LANDING)
    assert sorted(r.id for r in landed.select("id").collect()) == list(range(1, 3011))
    assert landed.filter("dataset = 'same' and ingested_at < '2026-02-25'").count() == 1000


def test_land_files(warehouse, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for name, text in [(SEARCH, doc(station())), (BANK_SET, doc(reading())), ("b c", "{\n}")]:
        (folder / f"{name}.json").write_text(text)
    (folder / "notes.txt").write_text("x")
    source.land_files(warehouse, str(folder), OLD)
    summary = source.land_files(warehouse, str(folder), NEW)
    assert summary["raw_rows_inserted"] == 3
    rows = dicts(warehouse.read(LANDING), "id")
    assert [r["id"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["dataset"] for r in rows[3:]] == ["b c", BANK_SET, SEARCH]
    assert rows[0]["payload"] == "{\n}"


def test_older_landing_without_stamp_is_taken_in(spark, warehouse):
    old = landing(spark, ("a", "{}", None)).drop("ingested_at")
    warehouse.append(LANDING, batches.stamped(old, OLD))
    assert column(warehouse, LANDING, "ingested_at") == [OLD]


# --- layer jobs --------------------------------------------------------------


def test_nothing_landed(warehouse):
    for job in (refine.landing_to_bronze, refine.bronze_to_silver, refine.silver_to_gold):
        assert job(warehouse) == {"status": "no_raw_data"}


def test_newest_batch_to_bronze(warehouse):
    two_batches(warehouse)
    summary = refine.landing_to_bronze(warehouse)
    assert summary == {
        "status": "ok", "ingested_at": NEW, "station_upserts": 2, "measure_inserts": 4,
    }
    assert column(warehouse, "bronze_station", "label") == ["LOWER LOCK", "OX FORD"]
    assert column(warehouse, "bronze_measure", "ingested_at") == [NEW] * 4


def test_last_station_item_wins_with_its_nulls(warehouse):
    put(
        warehouse,
        (SEARCH, doc(station(label="1", lat=1.0), station("B")), NEW),
        (SEARCH, doc(station(label="2", lat=2.0), {"notation": "L31", "label": "3"}), NEW),
    )
    assert refine.landing_to_bronze(warehouse)["station_upserts"] == 4
    rows = dicts(warehouse.read("bronze_station"), "station_id")
    assert [(r["station_id"], r["label"], r["lat"], r["river_name"]) for r in rows] == [
        ("B", "LOWER LOCK", None, "WENDLE"), ("L31", "3", None, None),
    ]


def test_repeating_bronze(warehouse):
    two_batches(warehouse)
    refine.landing_to_bronze(warehouse)
    assert refine.landing_to_bronze(warehouse)["measure_inserts"] == 4
    assert warehouse.read("bronze_measure").count() == 4
    assert refine.landing_to_bronze(warehouse, replace=False)["measure_inserts"] == 4
    assert warehouse.read("bronze_measure").count() == 8
    failed = run.bronze_report(warehouse).filter("not ok").collect()
    assert [(r.seq, r.violations) for r in failed] == [(11, 4)]


def through(warehouse):
    return [
        refine.landing_to_bronze(warehouse),
        refine.bronze_to_silver(warehouse),
        refine.silver_to_gold(warehouse),
    ]


def test_newest_batch_through_all_layers(warehouse):
    two_batches(warehouse)
    _, silver, gold = through(warehouse)
    assert (silver["silver_station_upserts"], silver["silver_measure_inserts"]) == (2, 4)
    assert (gold["dim_station_upserts"], gold["fact_measurement_inserts"]) == (2, 4)
    assert column(warehouse, "dim_station", "label") == ["LOWER LOCK", "OX FORD"]
    facts = dicts(warehouse.read("fact_measurement"), "measurement_key")
    assert [(f["measurement_key"], f["station_key"], f["measure_id"]) for f in facts] == [
        (1, 1, AMMONIUM), (2, 1, AMMONIUM), (3, 1, AMMONIUM), (4, 1, TURBIDITY[0]),
    ]
    assert [f["datetime"][11:] for f in facts] == [f"09:{m}:00+00:00" for m in (15, 30, 45, 45)]
    assert [f["value"] for f in facts] == [0.0, 0.11, 0.08, 6.5]


def test_repeating_a_batch_changes_nothing(warehouse):
    two_batches(warehouse)
    through(warehouse)
    tables = ["bronze_station", "bronze_measure", "silver_station", "silver_measure",
              "dim_station", "fact_measurement"]
    before = {t: sorted(map(str, dicts(warehouse.read(t)))) for t in tables}
    _, silver, gold = through(warehouse)
    assert silver["silver_measure_inserts"] == gold["fact_measurement_inserts"] == 0
    assert {t: sorted(map(str, dicts(warehouse.read(t)))) for t in tables} == before


def test_later_batches_keep_keys_and_history(warehouse):
    two_batches(warehouse)
    through(warehouse)
    later = "2026-02-26T00:00:00+00:00"
    put(
        warehouse,
        (SEARCH, doc(station("A0001", "FIRST BY NAME"), station(label="NEWER")), later),
        (BANK_SET, doc(reading()), later),
    )
    through(warehouse)
    last = "2026-02-27T00:00:00+00:00"
    put(warehouse, (SEARCH, doc(station("B0001")), last), (BANK_SET, doc(reading()), last))
    through(warehouse)
    stations = dicts(warehouse.read("dim_station"), "station_key")
    assert [(s["station_key"], s["station_id"], s["label"], s["ingested_at"]) for s in stations] == [
        (1, "L31", "NEWER", later), (2, "L40", "OX FORD", NEW),
        (3, "A0001", "FIRST BY NAME", later), (4, "B0001", "LOWER LOCK", last),
    ]
    facts = dicts(warehouse.read("fact_measurement"), "measurement_key")
    # The last batch lists another station only; its reading still finds the known one.
    assert [(f["measurement_key"], f["station_key"], f["ingested_at"]) for f in facts] == [
        *((k, 1, NEW) for k in range(1, 5)), (5, 1, later), (6, 1, last),
    ]


def test_a_failed_job_leaves_the_state_before(warehouse):
    two_batches(warehouse)
    through(warehouse)
    failing = warehouse.read("dim_station").selectExpr(
        "raise_error('lost') as station_key", "* except (station_key)"
    )
    with pytest.raises(Exception, match="lost"):
        warehouse.replace("dim_station", failing.withColumn("station_key", failing.station_key.cast("bigint")))
    fresh = Warehouse(warehouse.spark, warehouse.root)
    assert column(fresh, "dim_station", "label") == ["LOWER LOCK", "OX FORD"]
    refine.silver_to_gold(fresh)
    assert column(fresh, "dim_station", "station_key") == [1, 2]


# --- gates -------------------------------------------------------------------


def test_whole_run(spark, warehouse):
    documents, readings = run_inputs(spark, offering())
    summary = run.run_pipeline(
        warehouse, documents, readings, "LOCK", PARAMS, limit=2, ingested_at=NEW
    )
    assert summary["raw_rows_inserted"] == 5
    assert summary["fact_measurement_inserts"] == 8
    assert run.full_report(warehouse, len(PARAMS)).filter("not ok").count() == 0
    again = run.run_pipeline(
        warehouse, documents, readings, "LOCK", PARAMS, limit=2,
        ingested_at="2026-02-26T00:00:00+00:00",
    )
    assert again["fact_measurement_inserts"] == 8
    assert warehouse.read(LANDING).count() == 5
    assert warehouse.read("fact_measurement").count() == 16


def test_duplicates_stop_the_run_at_bronze(warehouse):
    two_batches(warehouse)
    put(warehouse, (BANK_SET, doc(reading(value=9.9)), NEW))
    with pytest.raises(ValidationError, match="bronze validation failed: reading keys"):
        run.refine_newest(warehouse, 2)
    assert not warehouse.exists("silver_measure")


def test_duplicates_in_an_older_batch_are_reported(warehouse):
    two_batches(warehouse)
    put(warehouse, (BANK_SET, doc(reading(), reading(value=9.9)), OLD))
    run.refine_newest(warehouse, 2)
    run.refine_all(warehouse, 2, gate=False)
    assert run.full_report(warehouse, 2).filter("not ok and seq = 11").count() == 1
    with pytest.raises(ValidationError, match="reading keys"):
        run.refine_all(warehouse, 2)


def test_both_spellings_of_utc_pass_bronze_and_merge_in_silver(warehouse):
    two_batches(warehouse)
    put(warehouse, (BANK_SET, doc(reading("2026-02-25T09:45:00+00:00", 9.9)), NEW))
    summary = run.refine_newest(warehouse, 2)
    assert (summary["measure_inserts"], summary["silver_measure_inserts"]) == (5, 4)
    assert column(warehouse, "fact_measurement", "value") == [0.0, 0.08, 0.11, 6.5]


def test_unreadable_document_stops_the_run_and_is_listed(warehouse):
    two_batches(warehouse)
    put(warehouse, (AMMONIUM_SET, '{"items":[', NEW))
    with pytest.raises(ValidationError, match="parse validation failed"):
        run.refine_newest(warehouse, 2)
    (issue,) = dicts(warehouse.read("quarantine"))
    assert (issue["landing_id"], issue["issue"]) == (6, flatten.UNREADABLE)


def test_a_batch_landed_anew_without_defects_passes(warehouse):
    put(warehouse, (SEARCH, doc(station()), NEW), (BANK_SET, "{", NEW))
    with pytest.raises(ValidationError):
        run.refine_newest(warehouse, 1)
    source.drop_datasets(warehouse, [BANK_SET])
    put(warehouse, (BANK_SET, doc(reading()), NEW))
    assert run.refine_newest(warehouse, 1)["fact_measurement_inserts"] == 1


def test_empty_landing_stops_the_run(warehouse):
    with pytest.raises(ValidationError, match="station document present"):
        run.refine_newest(warehouse, 1)


def test_a_batch_replaced_by_nothing_is_empty(spark, warehouse):
    put(warehouse, (SEARCH, doc(station()), NEW), (BANK_SET, doc(reading()), NEW))
    assert refine.landing_to_bronze(warehouse)["measure_inserts"] == 1
    rows = [(SEARCH, doc(station()), NEW), (BANK_SET, doc(), NEW)]
    warehouse.replace(LANDING, landing(spark, *rows))
    assert refine.landing_to_bronze(warehouse)["measure_inserts"] == 0
    assert warehouse.read("bronze_measure").count() == 0
