"""One query per operator, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.functions import scalars, text
from rivulet.operators import batches, checks, conform, flatten, keys, lookup, merge
from rivulet.plans import refine, run
from rivulet.session import scratch_path
from rivulet.sources import landing as landing_source
from rivulet.sources.tables import LANDING, Warehouse
from suite import views
from suite.views import REQUESTED, STATION_STAMP, table

SPLIT_DATE = "1998-04-01"
ORDER = ["o_orderdate", "o_orderkey"]


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_readings(views.readings_landing(views.readings(spark, sf)))


def _stations(spark: SparkSession, sf: str) -> DataFrame:
    """Current stations: the last item per station."""
    items = flatten.flatten_stations(views.station_landing(spark, sf))
    return conform.merge_stations(schemas.empty(spark, schemas.STATION), items)


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    nothing = schemas.empty(spark, schemas.DIM_STATION)
    return conform.merge_dimension(nothing, _written(_stations(spark, sf), "stations"))


def _silver(spark: SparkSession, sf: str, stations: DataFrame | None = None) -> DataFrame:
    stations = _stations(spark, sf) if stations is None else stations
    return conform.new_silver_measures(
        _bronze(spark, sf), stations, schemas.empty(spark, schemas.MEASURE)
    )


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flagship_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Landed JSON to facts: flatten, station key lookup, conform, first per reading key."""
    keyed = lookup.attach(_bronze(spark, sf), _dimension(spark, sf), "station_id", "station_key")
    first = merge.insert_if_absent(
        conform.conform_measures(keyed),
        schemas.empty(spark, schemas.MEASURE),
        conform.READING_KEY,
        conform.ARRIVAL,
        conform.REQUIRED,
    )
    return first.drop("landing_id", "pos")


def flatten_readings(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf)


def flatten_stations(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_stations(views.station_landing(spark, sf))


def parse_dataset_name(spark: SparkSession, sf: str) -> DataFrame:
    """Names with two to four parts; two are too few, a fourth is ignored."""
    event_id = F.col("event_id")
    name = text.readings_dataset(F.col("parameter"), F.col("measure_id"))
    dataset = (
        F.when(event_id % 7 == 0, F.concat(name, F.lit("__extra")))
        .when(event_id % 7 == 1, text.readings_dataset(F.col("parameter"), F.lit(None)))
        .otherwise(name)
    )
    named = views.readings(spark, sf).select("event_id", dataset.alias("dataset"))
    measure = text.dataset_measure(F.col("dataset"))
    return named.select(
        "event_id",
        "dataset",
        text.has_dataset_parts(F.col("dataset")).alias("complete"),
        text.dataset_parameter(F.col("dataset")).alias("parameter"),
        measure.alias("measure_id"),
        text.measure_unit(measure).alias("unit"),
        text.measure_station(measure).alias("station_id"),
    )


def props_value(spark: SparkSession, sf: str) -> DataFrame:
    props = F.from_json("props", "k string")
    return table(spark, sf, "events").select(
        "event_id",
        scalars.to_long(props["k"]).alias("k"),
        scalars.to_double(props["k"]).alias("k_double"),
    )


def norm_text(spark: SparkSession, sf: str) -> DataFrame:
    messy = F.concat(
        F.lit(" _"), F.col("o_orderpriority"), F.lit("\t-- "), F.col("o_orderstatus"), F.lit("__")
    )
    return table(spark, sf, "orders").select("o_orderkey", text.normalize_text(messy).alias("norm"))


def last_segment(spark: SparkSession, sf: str) -> DataFrame:
    url = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("//"))).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", text.last_segment(url).alias("segment"))


def lower_ascii(spark: SparkSession, sf: str) -> DataFrame:
    mixed = F.concat_ws(" ", "p_type", "p_brand", F.lit("ÀÉß"))
    return table(spark, sf, "part").select("p_partkey", text.lower_ascii(mixed).alias("lowered"))


def normalize_ts(spark: SparkSession, sf: str) -> DataFrame:
    event_id = F.col("event_id")
    spelled = (
        F.when(event_id % 6 == 0, F.substring("datetime", 1, 10))
        .when(event_id % 6 == 1, F.lit("2024-02-30T00:00:00Z"))
        .when(event_id % 6 == 2, F.substring("datetime", 1, 4))
        .when(event_id % 6 == 3, F.substring("datetime", 11, 6))
        .otherwise(F.col("datetime"))
    )
    return views.readings(spark, sf).select(
        "event_id",
        text.conform_timestamp(spelled).alias("datetime"),
        text.is_iso_timestamp(spelled).alias("is_iso"),
    )


def reading_instants(spark: SparkSession, sf: str) -> DataFrame:
    """Both time texts of a reading as points in time, here in seconds since 1970."""
    timed = conform.with_instants(views.readings(spark, sf))
    return timed.select(
        "event_id",
        F.unix_seconds("datetime_ts").alias("seconds"),
        F.unix_seconds("ingested_at_ts").alias("landed_seconds"),
    )


def latest_batch(spark: SparkSession, sf: str) -> DataFrame:
    mv = views.readings(spark, sf).select("event_id", "measure_id", "datetime", "ingested_at")
    return batches.only_latest(mv, mv)


def _mixed_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Landing rows of several kinds, told apart by their dataset name."""
    event_id = F.col("event_id")
    name = text.readings_dataset(F.col("parameter"), F.col("measure_id"))
    dataset = (
        F.when(event_id % 6 == 0, text.STATION_DATASET)
        .when(event_id % 6 == 1, F.upper(name))
        .when(event_id % 6 == 2, F.concat(F.lit("readings-latest"), F.col("measure_id")))
        .when(event_id % 6 == 3, F.concat(F.lit("rainfall_"), F.col("measure_id")))
        .otherwise(name)
    )
    return views.readings(spark, sf).select(
        F.col("event_id").alias("id"), dataset.alias("dataset"), "ingested_at"
    )


def route_datasets(spark: SparkSession, sf: str) -> DataFrame:
    rows = _mixed_landing(spark, sf)
    stations = flatten.only_stations(rows).withColumn("route", F.lit("stations"))
    readings = flatten.only_readings(rows).withColumn("route", F.lit("readings"))
    return stations.unionByName(readings)


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def overwrite_landing(spark: SparkSession, sf: str) -> DataFrame:
    """What a run that overwrites leaves of the landing, and the document it lands."""
    warehouse = _warehouse(spark)
    rows = _mixed_landing(spark, sf).withColumn("payload", F.lit("{}"))
    warehouse.append(LANDING, rows.hint("rebalance", "ingested_at"))
    warehouse.reserve(LANDING, rows.agg(F.max("id")).first()[0])
    one = spark.range(1).select(F.lit(text.STATION_DATASET).alias("dataset"), F.lit("{}").alias("payload"))
    landing_source.land_payloads(warehouse, one, ["dataset"], STATION_STAMP, append=False)
    return warehouse.read(LANDING).drop("payload")


def drop_datasets(spark: SparkSession, sf: str) -> DataFrame:
    """The landing without some datasets, by name and by pattern; counts as they are kept."""
    warehouse = _warehouse(spark)
    rows = _mixed_landing(spark, sf).withColumn("payload", F.lit("{}"))
    warehouse.append(LANDING, rows.hint("rebalance", "ingested_at"))
    landing_source.drop_datasets(warehouse, [text.STATION_DATASET], "RAINFALL%mgl")
    return warehouse.landed_counts()


def land_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads landed in bulk, in two batches; whether their ids are dense, by batch."""
    warehouse = _warehouse(spark)
    rows = views.readings_landing(views.readings(spark, sf))
    for stamp in ("2024-02-01T00:00:00+00:00", "2024-02-02T00:00:00+00:00"):
        landing_source.land_payloads(warehouse, rows, ingested_at=stamp)
    landed = warehouse.read(LANDING)
    dense = (F.count_distinct("id") == F.count("*")) & (
        F.max("id") - F.min("id") + 1 == F.count("*")
    )
    ids = landed.groupBy("ingested_at").agg(F.min("id").alias("first_id"), dense.alias("dense"))
    payloads = landed.groupBy("ingested_at", "dataset").agg(
        F.count("*").alias("payloads"),
        F.sum(F.size(F.from_json("payload", schemas.RAW_ITEMS_DOC)["items"])).alias("items"),
    )
    return payloads.join(ids, "ingested_at")


def land_files(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of payload files, one for each supplier and nation, landed in path order."""
    warehouse, folder = _warehouse(spark), scratch_path(spark, "files")
    suppliers = table(spark, sf, "supplier")
    name = F.concat(F.lit("rainfall "), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"))
    documents = suppliers.groupBy(name.alias("dataset")).agg(
        F.concat(
            F.lit('{"items":['), F.array_join(F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda x: x.cast("string")), ","), F.lit("]}")
        ).alias("payload")
    )
    views.write_files(documents, folder)
    landing_source.land_files(warehouse, folder, STATION_STAMP)
    return warehouse.read(LANDING)


def migrate_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two older layouts, without stamps and with gaps, taken in once; then a new row."""
    warehouse, folder = _warehouse(spark), scratch_path(spark, "older")
    rows = _mixed_landing(spark, sf).withColumn("payload", F.lit("{}"))
    odd = F.col("id") % 2 == 1
    rows.filter(~odd).drop("ingested_at").write.parquet(f"{folder}/a")
    gaps = F.when(F.col("id") % 3 != 0, F.col("ingested_at"))
    rows.filter(odd).withColumn("ingested_at", gaps).write.parquet(f"{folder}/b")
    for _ in range(2):
        landing_source.migrate_landing(warehouse, f"{folder}/*", "2023-12-31T00:00:00Z")
    landing_source.land_payload(warehouse, "after", "{}", STATION_STAMP)
    return warehouse.read(LANDING).drop("payload")


def append_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Older rows, some or all without a stamp, and new ones in one landing."""
    rows = _mixed_landing(spark, sf)
    odd = F.col("id") % 2 == 1
    ancient = batches.stamped(rows.filter(~odd).drop("ingested_at"), "2023-12-31T00:00:00+00:00")
    gaps = rows.filter(odd).withColumn(
        "ingested_at", F.when(F.col("id") % 3 != 0, F.col("ingested_at"))
    )
    return ancient.unionByName(batches.stamped(gaps, "2024-01-01T12:00:00+00:00"))


def batch_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return batches.batch_counts(views.readings_landing(views.readings(spark, sf)))


def search_stations(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return lookup.search_stations(customers, "00001", "c_name", "c_custkey")


def latest_n_readings(spark: SparkSession, sf: str) -> DataFrame:
    mv = views.readings(spark, sf).select("event_id", "measure_id", "datetime", "value")
    return lookup.latest_n(mv, 10, ["measure_id"], "datetime", ["event_id"])


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """What each station offers, from the first item of its document."""
    return flatten.station_catalogue(views.station_landing(spark, sf)).filter(F.col("pos") == 0)


def observed_properties(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.observed_properties(_catalogue(spark, sf)).select("station_id", "parameter")


def resolve_measures(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.resolve_measures(_catalogue(spark, sf), REQUESTED).select(
        "station_id", "nth", "parameter", F.array_join("measure_ids", ",").alias("measure_ids")
    )


def missing_parameters(spark: SparkSession, sf: str) -> DataFrame:
    found = lookup.missing_parameters(_catalogue(spark, sf), [*REQUESTED, "Rate-None"])
    return found.select(
        "station_id",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("available", ",").alias("available"),
    )


def station_errors(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.station_errors(_catalogue(spark, sf), REQUESTED)


def fetch_all_units(spark: SparkSession, sf: str) -> DataFrame:
    """The newest readings of every requested measure, as payloads and back to rows."""
    resolved = lookup.resolved_rows(lookup.resolve_measures(_catalogue(spark, sf), REQUESTED))
    mv = views.readings(spark, sf).select("event_id", "measure_id", "datetime", "value")
    newest = lookup.latest_for_measures(resolved, mv, 5, ["event_id"]).withColumns(
        {
            "dateTime": F.col("datetime"),
            "quality": F.lit(None).cast("string"),
            "completeness": F.lit("Complete"),
        }
    )
    payloads = landing_source.readings_payloads(newest, ["parameter", "measure_id"])
    landed = payloads.select(
        F.lit(0).cast("bigint").alias("id"),
        text.readings_dataset(F.col("parameter"), F.col("measure_id")).alias("dataset"),
        "payload",
        F.lit(STATION_STAMP).alias("ingested_at"),
    )
    return flatten.flatten_readings(landed).drop("landing_id")


def upsert_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return merge.last_per_key(orders, ["o_custkey"], ORDER)


def _by_customer(orders: DataFrame) -> DataFrame:
    """A late order without priority shows that NULL is written over a value."""
    priority = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))
    return orders.withColumn("o_orderpriority", priority)


def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    existing = merge.last_per_key(orders.filter(early), ["o_custkey"], ORDER)
    return merge.upsert(existing, _by_customer(orders.filter(~early)), ["o_custkey"], ORDER)


def dim_stable_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of a customer dimension; the second keeps the keys of the first."""
    orders = table(spark, sf, "orders").select("o_custkey", *ORDER, "o_totalprice")
    early = F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz")
    first = merge.last_per_key(orders.filter(early), ["o_custkey"], ORDER)
    known = _written(keys.assign_keys(first, "customer_key", ["o_custkey"]), "known")
    used = known.agg(F.max("customer_key")).first()[0] or 0
    late = _written(merge.last_per_key(orders.filter(~early), ["o_custkey"], ORDER), "late")
    return keys.upsert_keyed(known, late, ["o_custkey"], "customer_key", ["o_custkey"], used)


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """First event per key, unless an event with an id divisible by ten has it already."""
    mv = views.readings(spark, sf)
    incoming = mv.withColumn("measure_id", F.when(F.col("event_id") % 97 != 0, F.col("measure_id")))
    existing = mv.filter(F.col("event_id") % 10 == 0)
    return merge.insert_if_absent(
        incoming, existing, conform.READING_KEY, ["event_id"], conform.READING_KEY
    )


def silver_measure(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf)


def silver_latest_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The silver rows of the newest batch only."""
    landed = views.readings_landing(views.readings(spark, sf))
    bronze = flatten.flatten_readings(batches.only_latest(landed, landed))
    return conform.new_silver_measures(
        bronze, _stations(spark, sf), schemas.empty(spark, schemas.MEASURE)
    )


def gold_fact_keys(spark: SparkSession, sf: str) -> DataFrame:
    dimension = _dimension(spark, sf)
    nothing = schemas.empty(spark, schemas.FACT_MEASUREMENT)
    facts = conform.new_facts(_silver(spark, sf, dimension), dimension, nothing)
    return keys.assign_keys(facts, "measurement_key", conform.READING_KEY)


def gold_fact_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The facts after the same load has run twice."""
    dimension = _dimension(spark, sf)
    silver = _written(_silver(spark, sf, dimension), "silver")
    first = _written(
        conform.new_facts(silver, dimension, schemas.empty(spark, schemas.FACT_MEASUREMENT)), "facts"
    )
    return first.unionByName(conform.new_facts(silver, dimension, first))


def orphan_measures(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.orphans(views.readings(spark, sf), _stations(spark, sf), "station_id")


def fk_check(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose customer is not in the dimension, by status; some nations' are under another key."""
    key = F.when(F.col("c_nationkey") < 20, F.col("c_custkey")).otherwise(-F.col("c_custkey"))
    dimension = table(spark, sf, "customer").select(key.alias("o_custkey"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lost = lookup.orphans(orders, dimension, "o_custkey")
    return lost.groupBy("o_orderstatus").agg(F.count("*").alias("violations"))


def fk_check_all(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against all customers; some orders, by their key, have one that is not there."""
    dimension = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    planted = F.when(F.col("o_orderkey") % 50 == 7, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", planted.alias("o_custkey"), "o_orderstatus"
    )
    lost = lookup.orphans(orders, dimension, "o_custkey")
    return lost.groupBy("o_orderstatus").agg(F.count("*").alias("violations"))


def _spotty(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with NULLs and blanks in required fields."""
    event_id = F.col("event_id")
    return views.readings(spark, sf).withColumns(
        {
            "unit": F.when(event_id % 13 == 0, F.lit("")).otherwise(F.col("unit")),
            "station_id": F.when(event_id % 17 != 0, F.col("station_id")),
            "datetime": F.when(event_id % 29 == 0, F.lit("")).otherwise(F.col("datetime")),
        }
    )


def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _spotty(spark, sf).agg(
        F.count("*").alias("rows"),
        F.count_if(text.any_blank(conform.REQUIRED)).alias("measure_violations"),
        F.count_if(text.any_blank(["station_id", "ingested_at"])).alias("station_violations"),
        F.count_if(text.any_blank(["unit"])).alias("unit_violations"),
    )


def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_groups(views.readings(spark, sf), conform.READING_KEY)


def row_count_gates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.landing_checks(_mixed_landing(spark, sf), len(REQUESTED))


def iso_sample(spark: SparkSession, sf: str) -> DataFrame:
    newest = checks.newest_rows(_spotty(spark, sf), 20, ["event_id"])
    return newest.select(
        "event_id", "datetime", text.is_iso_timestamp(F.col("datetime")).alias("is_iso")
    )


def document_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Defects planted by id: in readings, in station documents, in ignored datasets."""
    event_id, payload = F.col("id"), F.col("payload")
    broken = (
        F.when(event_id % 40 == 1, F.substring(payload, 1, 20))
        .when(event_id % 40 == 2, F.lit('{"items":[{"dateTime":"2024-01-01","value":"n/a"}]}'))
        .when(event_id % 40 == 3, F.lit('{"items":[{"dateTime":"2024-01-01","quality":["x"]}]}'))
        .when(event_id % 40 == 4, F.lit('{"items":[{"dateTime":"2024-01-01","quality":"[x]"}]}'))
        .when(event_id % 40 == 5, F.lit('{"items":[null, {"dateTime":"2024-01-01"}]}'))
        .when(event_id % 40 == 6, F.lit('{"items":{}}'))
        .when(event_id % 40 == 7, F.lit("[1, 2]"))
        .when(event_id % 40 == 9, F.lit('{"items":[{"dateTime":"2024-01-01","quality":"[1]"}]}'))
        .when(event_id % 40 == 10, F.lit('{"items":[{"value":'))
        .when(event_id % 40 == 11, F.lit("[1, 2]"))
        .otherwise(payload)
    )
    name = (
        F.when(event_id % 40 == 8, F.lit("readings_latest__short"))
        .when(event_id % 40 == 10, F.lit("rainfall"))
        .when(event_id % 40 == 11, F.lit("Readings_Latest__a__b"))
        .otherwise(F.col("dataset"))
    )
    landed = views.readings_landing(views.readings(spark, sf)).withColumns(
        {"payload": broken, "dataset": name}
    )
    return flatten.document_issues(landed.unionByName(_odd_stations(spark, sf)))


def _odd_stations(spark: SparkSession, sf: str) -> DataFrame:
    """Station documents whose status has every shape, one of them without a notation."""
    shapes = [
        '"Active"', '["Active"]', '[{"label":["x"]}]', '[{"label":"Active"},3]', "[null]", "[]",
        '"[1]"', "{}", '[{"label":{"a":1}}]', '[{"label":5}]',
    ]
    status = F.get(F.array(*[F.lit(x) for x in shapes]), (F.col("s_suppkey") % 10).cast("int"))
    notation = F.when(F.col("s_suppkey") % 7 == 0, F.lit("")).otherwise(F.col("s_name"))
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.lit(text.STATION_DATASET).alias("dataset"),
        F.concat(
            F.lit('{"items":[{"notation":"'), notation, F.lit('","status":'), status, F.lit("}]}")
        ).alias("payload"),
        F.lit(STATION_STAMP).alias("ingested_at"),
    )


def _refined(spark: SparkSession, sf: str) -> tuple[Warehouse, list[dict[str, object]]]:
    """All batches landed in a fresh warehouse, the stations with the newest; all refined."""
    warehouse = _warehouse(spark)
    readings = views.readings_landing(views.readings(spark, sf, precise=True))
    stations = views.station_landing(spark, sf)
    ids = F.col("id") + stations.count()
    landed = stations.unionByName(readings.withColumn("id", ids))
    warehouse.append(LANDING, landed.hint("rebalance", "ingested_at"))
    return warehouse, run.refine_all(warehouse, len(REQUESTED), gate=False)


def _summaries(spark: SparkSession, summaries: list[dict[str, object]], names: list[str]) -> DataFrame:
    """One row for each batch."""
    kinds = ", ".join(
        f"{name} {'string' if name in ('status', 'ingested_at') else 'bigint'}" for name in names
    )
    return spark.createDataFrame([tuple(s[name] for name in names) for s in summaries], kinds)


def pipeline_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What the layers have written of each batch."""
    _, summaries = _refined(spark, sf)
    return _summaries(spark, summaries, sorted(summaries[0]))


def check_report(spark: SparkSession, sf: str) -> DataFrame:
    warehouse, _ = _refined(spark, sf)
    return run.full_report(warehouse, len(REQUESTED))


def pipeline_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table after all batches; the stations are known from the newest one on."""
    warehouse, _ = _refined(spark, sf)
    return warehouse.read("fact_measurement")


def _history(spark: SparkSession, sf: str) -> Warehouse:
    """Stations that arrive with a batch of their own, and once more with another; all refined."""
    warehouse = _warehouse(spark)
    readings = views.readings_landing(views.readings(spark, sf, precise=True), False)
    nth = views.batch_numbers(spark, sf)
    documents = views.station_landing(spark, sf, False).drop("ingested_at")
    twice = documents.select("*", F.explode(F.array(F.lit(1), F.lit(7))).alias("step"))
    placed = twice.withColumn("nth", ((F.col("id") - 1) * F.col("step")) % nth.count())
    changed = F.regexp_replace("payload", '"label":"', F.concat(F.lit('"label":"'), F.col("step"), F.lit(" ")))
    stations = placed.join(nth, "nth").select(
        (F.col("id") * 10 + F.col("step")).alias("id"), "dataset", changed.alias("payload"), "ingested_at"
    )
    ids = F.col("id") + 10 * documents.count() + 10
    landed = stations.unionByName(readings.withColumn("id", ids))
    warehouse.append(LANDING, landed.hint("rebalance", "ingested_at"))
    run.refine_all(warehouse, len(REQUESTED), gate=False)
    return warehouse


def history_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of all batches, whose readings find the stations known by then."""
    return _history(spark, sf).read("fact_measurement")


def history_stations(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension: keys by first batch, the rest by the last."""
    return _history(spark, sf).read("dim_station").select(
        "station_key", "station_id", "label", "ingested_at"
    )


def batch_without_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Gated runs of all batches, and of one more whose documents hold no readings."""
    warehouse = _all_landed(spark, sf, again=False)
    summaries = run.refine_all(warehouse, len(REQUESTED))
    last = max(s["ingested_at"] for s in summaries)[:10] + "T12:00:00+00:00"
    empty = views.readings_landing(views.readings(spark, sf)).select(
        "dataset", F.lit('{"items":[]}').alias("payload")
    )
    station = views.station_landing(spark, sf, False).select("dataset", "payload")
    landing_source.land_payloads(warehouse, station.unionByName(empty), ingested_at=last)
    newest = run.refine_newest(warehouse, len(REQUESTED))
    return _summaries(spark, [*summaries, newest], _INSERTS + ["dim_station_upserts"])


_INSERTS = ["ingested_at", "measure_inserts", "silver_measure_inserts", "fact_measurement_inserts"]


def _all_landed(spark: SparkSession, sf: str, again: bool) -> Warehouse:
    """All batches landed in a fresh warehouse, the stations with the first one."""
    warehouse = _warehouse(spark)
    readings = views.readings_landing(views.readings(spark, sf, precise=True), again)
    first = readings.agg(F.min("ingested_at")).first()[0]
    stations = views.station_landing(spark, sf, again).withColumn("ingested_at", F.lit(first))
    ids = F.col("id") + stations.count()
    landed = stations.unionByName(readings.withColumn("id", ids))
    warehouse.append(LANDING, landed.hint("rebalance", "ingested_at"))
    return warehouse


def check_report_all(spark: SparkSession, sf: str) -> DataFrame:
    """All rules after every batch has gone through all layers."""
    warehouse = _all_landed(spark, sf, again=True)
    run.refine_all(warehouse, len(REQUESTED), gate=False)
    return run.full_report(warehouse, len(REQUESTED))


def run_gated(spark: SparkSession, sf: str) -> DataFrame:
    """Every batch, without defects, through all layers and their gates; a row for each."""
    warehouse = _all_landed(spark, sf, again=False)
    return _summaries(spark, run.refine_all(warehouse, len(REQUESTED)), _INSERTS)


def check_report_planted(spark: SparkSession, sf: str) -> DataFrame:
    """All rules over tables with defects that the layers would not let in."""
    warehouse = _warehouse(spark)
    rows = _mixed_landing(spark, sf).withColumn("payload", F.lit("{}"))
    warehouse.append(LANDING, rows.hint("rebalance", "ingested_at"))
    suppliers, key = table(spark, sf, "supplier"), F.col("s_suppkey")
    empty = schemas.empty(spark, schemas.DIM_STATION)

    def stations(station_id, label, stamp) -> DataFrame:
        own = suppliers.select(
            key.alias("station_key"), station_id.alias("station_id"),
            label.alias("label"), stamp.alias("ingested_at"),
        )
        return empty.unionByName(own, allowMissingColumns=True)

    name, stamp = F.concat(F.lit("S"), key), F.lit(STATION_STAMP)
    bronze = stations(name, F.when(key % 7 != 0, F.col("s_name")), stamp)
    warehouse.replace("bronze_station", bronze)
    warehouse.replace(
        "silver_station", stations(name, F.lit(None).cast("string"), F.when(key % 9 != 0, stamp))
    )
    warehouse.replace("dim_station", bronze)
    event = F.col("event_id")
    measures = _spotty(spark, sf).withColumns(
        {
            "landing_id": event,
            "pos": F.lit(0).cast("bigint"),
            "datetime": F.when(event % 23 == 0, F.lit("2024-02-30")).otherwise(F.col("datetime")),
            "quality": F.lit(None).cast("string"),
            "completeness": F.lit(None).cast("string"),
            "measurement_key": event,
            "station_key": F.when(event % 11 != 0, event % 150),
        }
    ).hint("rebalance", "ingested_at")
    for layer in ("bronze_measure", "silver_measure", "fact_measurement"):
        warehouse.append(layer, measures)
    issue = F.when(event % 3 == 0, F.lit(flatten.NOT_NUMERIC)).when(event % 3 == 1, F.lit(flatten.NOT_JSON))
    issues = views.readings(spark, sf).select(
        event.alias("landing_id"), F.col("measure_id").alias("dataset"), F.lit(None).cast("bigint").alias("pos"),
        issue.alias("issue"), F.lit(None).cast("string").alias("detail"), "ingested_at",
    )
    warehouse.append("quarantine", issues.filter(F.col("issue").isNotNull()).hint("rebalance", "ingested_at"))
    errors = lookup.request_errors(_catalogue(spark, sf), REQUESTED).withColumns(
        {"nth": F.col("nth").cast("bigint"), "ingested_at": stamp}
    )
    warehouse.append("request_errors", errors)
    return run.full_report(warehouse, 1_000_000_000)


def check_report_bare(spark: SparkSession, sf: str) -> DataFrame:
    """All rules where only ignored datasets have landed and no layer has run."""
    warehouse = _warehouse(spark)
    rows = views.readings_landing(views.readings(spark, sf)).withColumn("dataset", F.lit("rainfall"))
    landing_source.land_payloads(warehouse, rows, ingested_at=STATION_STAMP)
    return run.full_report(warehouse, len(REQUESTED))


def bronze_append(spark: SparkSession, sf: str) -> DataFrame:
    """The bronze readings after the newest batch has been opened twice without replacing."""
    warehouse = _warehouse(spark)
    readings = views.readings_landing(views.readings(spark, sf))
    warehouse.append(LANDING, readings.hint("rebalance", "ingested_at"))
    for _ in range(2):
        refine.landing_to_bronze(warehouse, replace=False)
    return warehouse.read("bronze_measure")


def land_run(spark: SparkSession, sf: str) -> DataFrame:
    """Search, check the request, land the newest readings per measure; what is in the landing then."""
    warehouse = _warehouse(spark)
    mv = views.readings(spark, sf).select(
        "measure_id",
        F.col("datetime").alias("dateTime"),
        "value",
        F.lit(None).cast("string").alias("quality"),
        F.lit(None).cast("string").alias("completeness"),
    )
    landing_source.land_run(
        warehouse,
        views.station_landing(spark, sf),
        mv,
        "Supplier#00000000",
        REQUESTED,
        limit=3,
        ingested_at=STATION_STAMP,
        every_station=True,
    )
    landed = warehouse.read(LANDING)
    items = F.from_json("payload", schemas.RAW_ITEMS_DOC)["items"]
    return landed.select("id", "dataset", F.size(items).cast("bigint").alias("items"), "ingested_at")


ALL = [
    flagship_fact,
    flatten_readings,
    flatten_stations,
    parse_dataset_name,
    props_value,
    norm_text,
    last_segment,
    lower_ascii,
    normalize_ts,
    reading_instants,
    latest_batch,
    route_datasets,
    overwrite_landing,
    append_landing,
    batch_row_counts,
    search_stations,
    latest_n_readings,
    observed_properties,
    resolve_measures,
    missing_parameters,
    station_errors,
    fetch_all_units,
    upsert_last_wins,
    upsert_merge,
    dim_stable_keys,
    insert_if_absent,
    silver_measure,
    silver_latest_batch,
    gold_fact_keys,
    gold_fact_rerun,
    orphan_measures,
    fk_check,
    fk_check_all,
    required_fields,
    duplicate_groups,
    row_count_gates,
    iso_sample,
    document_issues,
    land_run,
    pipeline_summary,
    check_report,
    pipeline_facts,
    check_report_all,
    run_gated,
    bronze_append,
    drop_datasets,
    land_bulk,
    land_files,
    migrate_landing,
    history_facts,
    history_stations,
    batch_without_readings,
    check_report_planted,
    check_report_bare,
]
