"""The given tables, seen as stations and readings.

The tables hold no station data, so `events` stands for readings and `supplier`
for stations. All columns are computed row by row; building the documents needs
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import text

# The event types, units and the stamp of the station documents.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
UNITS = ["mgL", "pct"]
STATION_STAMP = "2024-01-31T00:00:00+00:00"

REQUESTED = ["Rate-Click", "rate_purchase", "rate click"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_files(documents: DataFrame, folder: str) -> None:
    """(dataset, payload) as one file <dataset>.json each, below a folder of that name."""
    spark = documents.sparkSession
    documents.write.partitionBy("dataset").text(folder)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(folder)
    store = top.getFileSystem(conf)
    for row in documents.select("dataset").distinct().collect():
        (written,) = store.globStatus(jvm.org.apache.hadoop.fs.Path(top, f"dataset={row[0]}/part-*"))
        store.rename(written.getPath(), jvm.org.apache.hadoop.fs.Path(top, f"{row[0]}.json"))


def readings(spark: SparkSession, sf_dir: str, precise: bool = False) -> DataFrame:
    """One reading per event; by the hour, so that some coincide, or to the microsecond."""
    unit = f"if(event_id % 2 = 0, '{UNITS[0]}', '{UNITS[1]}')"
    hourly = """date_format(date_trunc('hour', ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")"""
    exact = """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")"""
    next_day = "date_format(date_add(to_date(ts), 1), 'yyyy-MM-dd')"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('S', user_id) AS station_id",
        "concat('Rate ', event_type) AS parameter",
        f"{unit} AS unit",
        f"concat_ws('-', concat('S', user_id), event_type, 'i-subdaily', {unit}) AS measure_id",
        f"{exact if precise else hourly} AS datetime",
        "value",
        f"concat({next_day}, 'T00:00:00+00:00') AS ingested_at",
    )


def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nth, ingested_at: the batches of the readings, numbered from 0."""
    stamps = readings(spark, sf_dir).select("ingested_at").distinct()
    found = sorted(row[0] for row in stamps.collect())  # one for each day
    return spark.createDataFrame(list(enumerate(found)), "nth bigint, ingested_at string")


def readings_landing(mv: DataFrame, again: bool = True) -> DataFrame:
    """One payload per reading, with up to three items.

    The reading itself; for each fourth event an item without dateTime; for each
    fifth, unless `again` is off, the same reading again, with the other spelling of UTC
    and no value.
    """

    def item(when: str, value: str, quality: str, completeness: str) -> str:
        return (
            f"named_struct('dateTime', {when}, 'value', {value}, 'quality', {quality},"
            f" 'completeness', {completeness})"
        )

    nothing = "CAST(NULL AS STRING)"
    reading = item(
        "datetime", "value", "if(event_id % 2 = 0, 'Good', NULL)",
        "if(event_id % 3 = 0, 'Complete', NULL)",
    )
    undated = item(nothing, "value", "'Bad'", nothing)
    repeated = item("replace(datetime, 'Z', '+00:00')", "CAST(NULL AS DOUBLE)", "'Suspect'", nothing)
    more = str(again).lower()
    items = f"""CASE
        WHEN {more} AND event_id % 20 = 0 THEN array({reading}, {undated}, {repeated})
        WHEN event_id % 4 = 0 THEN array({reading}, {undated})
        WHEN {more} AND event_id % 5 = 0 THEN array({reading}, {repeated})
        ELSE array({reading}) END"""
    return mv.select(
        F.col("event_id").alias("id"),
        text.readings_dataset(F.col("parameter"), F.col("measure_id")).alias("dataset"),
        F.expr(f"to_json(struct({items} AS items))").alias("payload"),
        "ingested_at",
    )


def station_landing(spark: SparkSession, sf_dir: str, again: bool = True) -> DataFrame:
    """One station document per supplier.

    Each seventh holds a second item without notation; each eleventh, unless `again` is
    off, the station once more, without a label. `status` is a list, an empty list or an object;
    one property, or the measures of one, are missing here and there.
    """
    kinds = ", ".join(f"'{kind}'" for kind in EVENT_TYPES)
    units = ", ".join(f"'{unit}'" for unit in reversed(UNITS))
    measure = """named_struct(
        '@id', concat('http://example.org/id/measures/S', s_suppkey, '-', t, '-i-subdaily-', u, '/'),
        'parameter', concat('RATE_', upper(t)))"""

    def item(notation: str, label: str) -> str:
        return f"""to_json(named_struct(
            'notation', {notation}, 'label', {label}, 'riverName', n_name,
            'lat', s_acctbal, 'long', string(s_acctbal),
            'easting', double(s_suppkey), 'northing', s_nationkey, 'status', status,
            'observedProperty', offered, 'measures', measures))"""

    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    stations = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    described = stations.selectExpr(
        "*",
        """parse_json(CASE s_suppkey % 3
            WHEN 0 THEN '[{"label":"Active"},{"label":"Old"}]'
            WHEN 1 THEN '[]'
            ELSE '{"label":"Closed"}' END) AS status""",
        f"""transform(
            filter(array({kinds}), t -> t <> 'purchase' OR s_suppkey % 6 <> 5),
            t -> named_struct('@id', concat('http://example.org/def/op/rate-', t))) AS offered""",
        f"""flatten(transform(
            filter(array({kinds}), t -> t <> 'click' OR s_suppkey % 10 <> 9),
            t -> transform(array({units}), u -> {measure}))) AS measures""",
    )
    station, repeated = item("concat('S', s_suppkey)", "s_name"), item("concat('S', s_suppkey)", "NULL")
    return described.selectExpr(
        "s_suppkey AS id",
        f"'{text.STATION_DATASET}' AS dataset",
        f"""concat('{{"items":[', concat_ws(',', {station},
            if(s_suppkey % 7 = 0, {item("''", "'blank'")}, NULL),
            if({str(again).lower()} AND s_suppkey % 11 = 0, {repeated}, NULL)), ']}}') AS payload""",
        f"'{STATION_STAMP}' AS ingested_at",
    )
