"""What the plans must look like to hold at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.operators import batches, checks, conform, flatten, keys, lookup, merge
from rivulet.sources.tables import LANDING, Warehouse
from suite import queries, views

CROSS = re.compile("CartesianProduct|BroadcastNestedLoopJoin")
PYTHON = re.compile("ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups")


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


LAZY = [
    queries.flatten_readings, queries.flatten_stations, queries.silver_measure,
    queries.latest_n_readings, queries.upsert_last_wins, queries.upsert_merge,
    queries.insert_if_absent, queries.orphan_measures, queries.resolve_measures,
    queries.missing_parameters, queries.fetch_all_units, queries.document_issues,
    queries.duplicate_groups, queries.fk_check, queries.batch_row_counts, queries.latest_batch,
]


@pytest.mark.parametrize("query", LAZY, ids=lambda q: q.__name__)
def test_no_cross_join_and_no_python(spark, data, query):
    text = plan(query(spark, data))
    assert not CROSS.search(text)
    assert not PYTHON.search(text)


@pytest.mark.parametrize("query", [queries.flatten_readings, queries.flatten_stations])
def test_flattening_does_not_shuffle_and_parses_once(spark, data, query):
    text = plan(query(spark, data))
    assert "hashpartitioning" not in text
    names = re.findall(r"from_json\(StructField\(items", text)
    assert len(names) == 1


@pytest.mark.parametrize(
    "query", [queries.upsert_last_wins, queries.insert_if_absent]
)
def test_groups_are_cut_before_the_only_shuffle(spark, data, query):
    text = plan(query(spark, data))
    assert text.count("ENSURE_REQUIREMENTS") == 1
    assert "Partial" in text and "WindowGroupLimit" in text


def test_new_facts_need_one_range_shuffle(spark, data):
    """Dedup, known keys and the sort for numbering share it."""
    silver = spark.createDataFrame([], schemas.MEASURE)
    dim = schemas.empty(spark, schemas.DIM_STATION).union(
        spark.range(3).selectExpr("id", "string(id)", *["null"] * 8)
    )
    known = spark.createDataFrame([], schemas.FACT_MEASUREMENT)
    facts = conform.new_facts(silver, F.broadcast(dim), known)
    text = plan(facts.orderBy(*conform.READING_KEY))
    assert text.count("rangepartitioning") == 1
    assert "hashpartitioning" not in text


def test_newest_n_is_cut_by_salt_ahead_of_its_key(spark, data):
    text = plan(queries.latest_n_readings(spark, data))
    assert text.count("ENSURE_REQUIREMENTS") == 2 and "__salt" in text


def test_station_lookup_is_broadcast_only_when_small(spark, data):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    mv, suppliers = views.readings(spark, data), views.table(spark, data, "supplier")
    stations = suppliers.select(F.concat(F.lit("S"), "s_suppkey").alias("station_id"))
    assert "BroadcastHashJoin" in plan(lookup.keep_known(mv, stations, "station_id"))
    spark.conf.set(name, "100")
    try:
        assert "SortMergeJoin" in plan(lookup.keep_known(mv, stations, "station_id"))
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("kind", ["keep_known", "orphans", "attach"])
def test_a_hot_station_is_split_when_the_join_sorts(spark, kind):
    """A third of the rows on one key: adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
        rows = spark.range(0, 200_000, 1, 8).select(
            hot.cast("string").alias("station_id"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        reference = spark.range(4000).select(
            F.col("id").cast("string").alias("station_id"), F.col("id").alias("station_key")
        )
        if kind == "attach":
            joined = lookup.attach(rows, reference, "station_id", "station_key")
        else:
            joined = getattr(lookup, kind)(rows, reference, "station_id")
        counts = joined.groupBy("v").count()
        counts.collect()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            counts.explain()
        assert "skew=true" in out.getvalue()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_newest_batch_prunes_partitions(spark, data, warehouse):
    rows = views.readings_landing(views.readings(spark, data))
    warehouse.append(LANDING, rows)
    landed = warehouse.read(LANDING)
    newest_stamp = batches.latest_batch(landed)
    by_value = plan(warehouse.batch(LANDING, newest_stamp))
    assert re.search(r"PartitionFilters: \[.*ingested_at.* = 2024-01-31T00:00:00\+00:00", by_value)
    by_subquery = plan(batches.only_latest(landed, landed))
    assert re.search(r"PartitionFilters: \[.*ingested_at.*Subquery", by_subquery)
    newest = plan(landed.agg(F.max("ingested_at")))
    assert re.search(r"ReadSchema: struct<>", newest)


def test_station_scan_of_a_batch_is_pushed_to_the_files(spark, data, warehouse):
    warehouse.append(LANDING, views.station_landing(spark, data))
    landed = flatten.only_stations(warehouse.batch(LANDING, "2024-01-31T00:00:00+00:00"))
    text = plan(flatten.flatten_stations(landed))
    assert re.search(r"PushedFilters: .*EqualTo\(dataset,station_search\)", text)
    assert re.search(r"PartitionFilters: .*ingested_at", text)


def test_numbering_broadcasts_one_row_per_partition(spark):
    staged = keys.stage_in_order(spark.range(0, 1000, 1, 4).toDF("k"), ["k"], "key")
    numbered = keys.number_staged(staged, "key")
    assert "BroadcastHashJoin" in plan(numbered)
    assert staged.select("__part").distinct().count() <= 8


def test_layer_rules_share_one_pass_per_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.replace("bronze_station", spark.createDataFrame([], schemas.STATION))
    tables = warehouse.read("bronze_station"), warehouse.read("bronze_measure")
    text = plan(checks.bronze_checks(*tables, tables))
    # one pass for the rules per row, one for the duplicate groups
    assert len(re.findall(r"Location: .*bronze_measure", text)) == 2
    assert len(re.findall(r"Location: .*bronze_station", text)) == 1
    assert not CROSS.search(text)


def test_hot_copies_reach_the_merge_reduced(spark):
    """A key with a third of all rows sends at most one row per map task."""
    rows = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )
    last = merge.last_per_key(rows, ["k"], ["n"])
    assert last.count() == 60_001
    assert last.filter("k = 0").first().n == 89_997
    assert "WindowGroupLimit" in plan(last)


def test_documents_with_issues_are_found_without_a_second_parse(spark, data):
    from pyspark.sql import Observation

    watch = Observation()
    landed = views.readings_landing(views.readings(spark, data))
    flatten.flatten_readings(landed, watch).write.format("noop").mode("overwrite").save()
    assert watch.get == {"suspects": 0}
    broken = landed.withColumn("payload", F.when(F.col("id") % 10 == 0, F.lit("{")).otherwise(F.col("payload")))
    watch = Observation()
    flatten.flatten_readings(broken, watch).write.format("noop").mode("overwrite").save()
    assert watch.get["suspects"] == broken.filter("id % 10 = 0").count()
