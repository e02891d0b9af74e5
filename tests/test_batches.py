"""Many batches at once, landings that are overwritten, bulk-loaded or older, gates by batch."""

import os
import re

import pytest
from pyspark.sql import functions as F

from rivulet import ValidationError, schemas
from rivulet.operators import conform, flatten, keys
from rivulet.plans import refine, run
from rivulet.session import shared_dir
from rivulet.sources import landing as source
from rivulet.sources.tables import LANDING, REQUEST_ERRORS, Warehouse
from tests.conftest import (
    AMMONIUM, NEW, OLD, SEARCH, TURBIDITY, dataset, dicts, doc, landing, offering, reading, station,
)
from tests.test_pipeline import column, put, run_inputs
from tests.test_plans import plan

SETS = [dataset("ammonium", AMMONIUM), dataset("turbidity", TURBIDITY[0]), dataset("level", "Z9-level-m")]
TABLES = ["bronze_station", "bronze_measure", "silver_station", "silver_measure", "dim_station",
          "fact_measurement"]


def day(n):
    return f"2026-03-{n:02d}T00:00:00+00:00"


def month(warehouse, days=5, fault=None):
    """Z9 is known late, M2 early and again with another label; L31 comes with every second day."""
    rows = []
    for n in range(days, 0, -1):
        found = [station("M2", f"MILL {n}")] if n in (1, 4) else []
        found += [station("Z9", "ZIG")] * (n == 3) + [station(label=f"LOCK {n}")] * (n % 2)
        if found:
            rows.append((SEARCH, doc(*found), day(n)))
        rows += [(name, doc(reading(f"2026-03-{n:02d}T0{k}:00:00Z", n + k / 10)), day(n)) for k, name in enumerate(SETS)]
    put(warehouse, *rows, *([fault] if fault else []))


def content(warehouse):
    return {t: sorted(map(str, dicts(warehouse.read(t)))) for t in TABLES}


def one_by_one(warehouse, stamps):
    return [
        refine.landing_to_bronze(warehouse, batch=s)
        | refine.bronze_to_silver(warehouse, s)
        | refine.silver_to_gold(warehouse, s)
        for s in stamps
    ]


def test_many_batches_give_what_they_give_one_by_one(spark, tmp_path):
    together, apart = (Warehouse(spark, str(tmp_path / name)) for name in ("together", "apart"))
    for warehouse in (together, apart):
        month(warehouse)
    stamps = [day(n) for n in range(1, 6)]
    assert run.refine_all(together, 3) == one_by_one(apart, stamps)
    assert content(together) == content(apart)
    facts = dicts(together.read("fact_measurement"), "measurement_key")
    assert [f["measurement_key"] for f in facts] == list(range(1, len(facts) + 1))
    late = [f["ingested_at"] for f in facts if f["station_id"] == "Z9"]
    assert late == [day(3), day(4), day(5)]  # not before the station is known
    for warehouse in (together, apart):  # once more, over what is there, with one new batch
        put(warehouse, (SEARCH, doc(station("M2", "LAST"), station("A1")), day(6)),
            (SETS[0], doc(reading("2026-03-06T00:00:00Z")), day(6)))
    run.refine_all(together, 3)
    one_by_one(apart, [*stamps, day(6)])
    assert content(together) == content(apart)


def jobs(spark, action):
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    before = scheduler.numTotalJobs()
    action()
    return scheduler.numTotalJobs() - before


def test_jobs_do_not_grow_with_the_batches(spark, tmp_path):
    counts = []
    for days in (4, 12):
        warehouse = Warehouse(spark, str(tmp_path / str(days)))
        month(warehouse, days)
        counts.append(jobs(spark, lambda: run.refine_all(warehouse, 3)))
    assert counts[1] <= counts[0] + 3


@pytest.mark.parametrize(
    ("fault", "message"),
    [
        ((SEARCH, doc(station("B1", label=None)), day(3)), r"bronze .* station fields present \(rule 8, 1 "),
        ((SETS[0], "{", day(3)), "parse validation failed"),
        ((SETS[0], doc(reading("yesterday")), day(3)), "timestamps are ISO"),
        (("rain", "no json", day(3)), "parse validation failed"),
    ],
)
def test_a_failing_batch_keeps_itself_and_later_ones_out(spark, warehouse, fault, message):
    month(warehouse, fault=fault)
    put(warehouse, (SEARCH, doc(station("B1", "mended")), day(4)))
    with pytest.raises(ValidationError, match=message):
        run.refine_all(warehouse, 3)
    for table in ("silver_measure", "fact_measurement"):
        assert set(column(warehouse, table, "ingested_at")) == {day(1), day(2)}
    assert column(warehouse, "dim_station", "station_id") == ["L31", "M2"]


def test_faults_of_stations_count_until_they_are_mended(spark, warehouse):
    month(warehouse, 2)
    put(warehouse, (SEARCH, doc(station("B1", label="")), OLD))
    refine.landing_to_bronze(warehouse, batch=OLD)  # the fault is in the table before the run
    source.drop_datasets(warehouse, [SEARCH])
    put(
        warehouse,
        (SEARCH, doc(station("B1", "good")), day(1)),
        (SEARCH, doc(station()), OLD),
        (SETS[0], doc(reading()), OLD),
    )
    with pytest.raises(ValidationError, match="station fields present"):  # not mended by then
        run.refine_all(warehouse, 2)
    assert warehouse.read("fact_measurement").count() == 0
    put(warehouse, (SEARCH, doc(station("B1", "good")), OLD))
    assert len(run.refine_all(warehouse, 2)) == 3


def test_a_table_has_rows_from_the_first_batch_with_some(spark, warehouse):
    put(warehouse, (SEARCH, doc(station()), OLD), (SETS[0], doc(reading()), NEW), (SETS[0], doc(), day(1)))
    with pytest.raises(ValidationError, match="bronze .* measure table has rows"):
        run.refine_all(warehouse, 1)
    put(warehouse, (SETS[0], doc(reading("2026-01-01")), OLD))
    assert [s["measure_inserts"] for s in run.refine_all(warehouse, 1)] == [1, 1, 0]


def test_a_batch_without_readings_passes(spark, warehouse):
    put(warehouse, (SEARCH, doc(station()), OLD), (SETS[0], doc(reading()), OLD))
    run.refine_newest(warehouse, 1)
    put(warehouse, (SEARCH, doc(station()), NEW), (SETS[0], doc(), NEW))
    summary = run.refine_newest(warehouse, 1)
    assert (summary["ingested_at"], summary["fact_measurement_inserts"]) == (NEW, 0)
    assert [s["measure_inserts"] for s in run.refine_all(warehouse, 1)] == [1, 0]
    assert run.full_report(warehouse, 1, NEW).filter("not ok").count() == 0


def test_no_readings_at_all_fail(spark, warehouse):
    put(warehouse, (SEARCH, doc(station()), NEW), (SETS[0], doc(), NEW))
    for job in (run.refine_newest, run.refine_all):
        with pytest.raises(ValidationError, match="bronze .* measure table has rows"):
            job(warehouse, 1)


# --- the landing -------------------------------------------------------------


def files(warehouse):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(f"{warehouse.root}/{LANDING}")
        for name in names
        if name.endswith(".parquet") and "kind=" in folder
    }


def test_overwriting_leaves_the_files_of_other_kinds(spark, warehouse):
    put(warehouse, (SEARCH, "{}", OLD), ("rain", "{}", OLD), ("rain", "{}", NEW), (SETS[0], "{}", NEW))
    warehouse.reserve(LANDING, 4)
    before = files(warehouse)
    source.land_run(warehouse, *run_inputs(spark, offering()), "LOCK", ["ammonium"], append=False,
                    ingested_at=NEW)
    kept = {k: v for k, v in files(warehouse).items() if k in before}
    assert kept == {k: v for k, v in before.items() if "kind=other" in k} and kept
    rows = [(r["id"], r["dataset"], r["ingested_at"]) for r in dicts(warehouse.read(LANDING), "id")]
    assert rows == [(2, "rain", OLD), (3, "rain", NEW), (5, SEARCH, NEW), (6, SETS[0], NEW)]


def test_dropping_datasets_writes_only_partitions_that_hold_them(spark, warehouse):
    put(warehouse, ("a", "{}", OLD), ("b", "{}", OLD), ("b", "{}", NEW), (SEARCH, "{}", NEW))
    before = files(warehouse)
    source.drop_datasets(warehouse, ["a", SEARCH])
    after = files(warehouse)
    assert [k for k in before if k in after] == [k for k in before if "kind=other" in k and "25T" in k]
    assert [(r["id"], r["dataset"]) for r in dicts(warehouse.read(LANDING), "id")] == [(2, "b"), (3, "b")]
    counts = {(r["kind"], r["ingested_at"]): r["payloads"] for r in dicts(warehouse.landed_counts())}
    assert counts == {("other", OLD): 1, ("other", NEW): 1}


def test_bulk_loads_write_the_payload_once(spark, warehouse, monkeypatch):
    def staged(*_):
        raise AssertionError("staged")

    monkeypatch.setattr(keys, "stage_in_order", staged)
    rows = spark.range(0, 100, 1, 3).selectExpr("concat('d', id % 7) AS dataset", "'{}' AS payload")
    assert source.land_payloads(warehouse, rows, ingested_at=OLD)["raw_rows_inserted"] == 100
    source.land_payloads(warehouse, rows.limit(0), ingested_at=NEW)
    source.land_payloads(warehouse, rows, ingested_at=NEW, append=False)
    again = Warehouse(spark, warehouse.root).read(LANDING)
    assert sorted(r.id for r in again.select("id").collect()) == list(range(1, 201))
    assert "Exchange hash" not in plan(again)


def test_what_a_failed_bulk_load_leaves_is_not_seen(spark, warehouse):
    rows = spark.range(9).selectExpr("'d' AS dataset", "'{}' AS payload")
    source.land_payloads(warehouse, rows, ingested_at=OLD)
    lost = rows.selectExpr("CAST(NULL AS BIGINT) AS id", "*", f"'{NEW}' AS ingested_at")
    warehouse._writer(LANDING, lost).mode("append").parquet(warehouse._path(LANDING))
    assert warehouse.read(LANDING).count() == 9
    source.land_payloads(warehouse, rows.limit(2), ingested_at=NEW)
    assert sorted(r.id for r in warehouse.read(LANDING).collect()) == list(range(1, 12))
    assert {r["ingested_at"]: r["payloads"] for r in dicts(warehouse.landed_counts())} == {OLD: 9, NEW: 2}


def test_rules_over_the_landing_read_no_batch(spark, warehouse):
    put(warehouse, (SEARCH, "{}", OLD), (SETS[0], "{}", NEW))
    report = run.landing_report(warehouse, 2)
    assert {r.seq: r.violations for r in report.collect()} == {1: 0, 2: 1, 3: 1}
    assert "raw_landing" not in plan(report) and "landing_counts" in plan(report)


def test_older_landings_are_taken_in_once(spark, warehouse, tmp_path):
    old = landing(spark, ("a", "{}", None), (SEARCH, "{}", None)).drop("ingested_at")
    old.coalesce(1).write.parquet(str(tmp_path / "old" / "first"))
    gaps = landing(spark, ("b", "{}", None), ("c", "{}", OLD)).withColumn("id", F.col("id") + 10)
    gaps.write.parquet(str(tmp_path / "old" / "second"))
    for expected in (4, 0):
        done = source.migrate_landing(warehouse, str(tmp_path / "old" / "*"), "2026-02-01")
        assert done["raw_rows_inserted"] == expected
    source.land_payload(warehouse, "new", "{}", NEW)
    stamp = "2026-02-01T00:00:00+00:00"
    assert [(r["id"], r["ingested_at"]) for r in dicts(Warehouse(spark, warehouse.root).read(LANDING), "id")] == [
        (1, stamp), (2, stamp), (11, stamp), (12, OLD), (13, NEW),
    ]


def test_a_large_batch_of_an_older_landing_goes_to_several_tasks(spark):
    """All rows of one file and one stamp, ids null or repeated, are sorted in parts."""
    rows = spark.range(0, 1000, 1, 1).select(
        F.expr("if(id % 2 = 0, null, 7L)").alias("id"),
        F.lit("a").alias("dataset"),
        F.lit("{}").alias("payload"),
        F.expr(f"if(id < 980, '{OLD}', if(id < 999, '{NEW}', null))").alias("ingested_at"),
    )
    dealt = source._by_batch(rows, rows, most=100)
    same = dealt.select(rows.columns)
    assert same.exceptAll(rows).isEmpty() and rows.exceptAll(same).isEmpty()
    parts = dealt.groupBy("ingested_at", "part").count().collect()
    assert max(r["count"] for r in parts) <= 100
    assert sorted((r["ingested_at"] or "") for r in parts) == ["", *[OLD] * 10, NEW]


def test_refused_requests_are_kept_for_the_report(spark, warehouse):
    with pytest.raises(ValidationError):
        source.land_run(warehouse, *run_inputs(spark, offering()), "LOCK", ["pH"], ingested_at=NEW)
    assert column(warehouse, REQUEST_ERRORS, "reason") == ["no measure for parameter", "parameter not offered"]
    failed = {r.seq: r.violations for r in run.full_report(warehouse, 1).filter("not ok").collect()}
    assert failed[27] == 2
    source.land_run(warehouse, *run_inputs(spark, offering()), "LOCK", ["ammonium"], ingested_at=NEW)
    assert run.request_report(warehouse).first().ok


# --- documents and keys ------------------------------------------------------


@pytest.mark.parametrize(
    ("status", "label", "issue"),
    [
        ("Active", None, None), (["Active"], None, flatten.BAD_STATUS), ([None], None, flatten.BAD_STATUS),
        ([[1]], None, flatten.BAD_STATUS), ([{"label": ["x"]}], None, flatten.NESTED),
        ([{"label": {"a": 1}}], None, flatten.NESTED), ([{"label": "On"}, 3], "On", None),
        ([{"label": None}], None, None), ([{}], None, None), ([], None, None), ({}, None, None),
        ([{"label": 5}], "5", None), ("[1]", None, None),
    ],
)
def test_shapes_of_a_status(spark, status, label, issue):
    rows = landing(spark, (SEARCH, doc(station(status=status), {"notation": "", "status": [1]}), NEW))
    assert flatten.flatten_stations(rows).first()["status"] == label
    found = [(i["pos"], i["issue"], i["detail"]) for i in dicts(flatten.document_issues(rows))]
    assert found == ([(0, issue, "status")] if issue else [])


def test_known_rows_of_a_dimension_are_not_sorted(spark, tmp_path):
    dimension = schemas.empty(spark, schemas.DIM_STATION).unionByName(
        spark.range(1000).selectExpr("id + 1 AS station_key", "concat('S', id) AS station_id"),
        allowMissingColumns=True,
    )
    dimension.write.parquet(str(tmp_path / "dim"))
    dimension = spark.read.parquet(str(tmp_path / "dim"))
    stations = schemas.empty(spark, schemas.STATION).unionByName(
        spark.range(995, 1010).selectExpr("concat('S', id) AS station_id", "'new' AS label"),
        allowMissingColumns=True,
    )
    stations.write.parquet(str(tmp_path / "new"))
    merged = conform.merge_dimension(dimension, spark.read.parquet(str(tmp_path / "new")), 1000)
    text = plan(merged)
    sorted_by = re.findall(r"\) Sort\n.*\nArguments: \[(\w+)#", text)
    assert "SortMergeJoin" not in text and set(sorted_by) <= {"__part"}
    rows = {r.station_id: (r.station_key, r.label) for r in merged.collect()}
    assert len(rows) == 1010 and rows["S994"] == (995, None) and rows["S999"] == (1000, "new")
    assert sorted(rows[f"S{i}"][0] for i in range(1000, 1010)) == list(range(1001, 1011))


def test_a_run_removes_what_it_has_staged(spark, warehouse):
    month(warehouse)
    folder = f"{shared_dir(spark)}/rivulet".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    run.refine_all(warehouse, 3)
    assert set(os.listdir(folder)) <= before
