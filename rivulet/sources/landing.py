"""Landing raw documents: from files, from frames, or as one run over a catalogue."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.errors import ValidationError
from rivulet.functions import text
from rivulet.operators import batches, keys, lookup
from rivulet.operators.flatten import station_catalogue
from rivulet.session import scratch_path
from rivulet.sources.tables import LANDING, REQUEST_ERRORS, Warehouse

BATCH_ROWS = 1_000_000  # of one batch, dealt to a task at a time
READING_FIELDS = ["dateTime", "value", "quality", "completeness"]


def batch_stamp(given: str | None = None) -> str:
    """The stamp of a run in UTC: the given one, else now. Taken once, on the driver.

    Batches are ordered by their stamps as text, so all have one spelling. A given time
    without an offset is UTC; a text that is no ISO time raises ValidationError.
    """
    if not given:
        return datetime.now(timezone.utc).isoformat()
    try:
        moment = datetime.fromisoformat(given)
    except ValueError:
        raise ValidationError(f"batch stamp '{given}' is no ISO time") from None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc).isoformat()


def readings_payloads(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """One JSON document per key, items by `rank`; no items where the rank is NULL.

    For groups of a known bound, such as the newest n readings per measure.
    """
    item = F.when(
        F.col("rank").isNotNull(), F.struct("rank", F.struct(*READING_FIELDS).alias("item"))
    )
    ordered = F.array_sort(F.collect_list(item))
    items = F.transform(ordered, lambda x: x["item"]).alias("items")
    return ranked.groupBy(*keys).agg(F.to_json(F.struct(items)).alias("payload"))


def _write(warehouse: Warehouse, rows: DataFrame, stamp: str, append: bool) -> None:
    """Files sorted by dataset let a reader of one kind skip the payloads of the others.

    The writer sorts by the partition columns in any case. An overwriting run touches the
    partitions of stations and readings; the files of other kinds stay as they are.
    """
    ordered = rows.sortWithinPartitions("ingested_at", "dataset", "id")
    if append:
        warehouse.append(LANDING, ordered, stamp)
    else:
        warehouse.drop_kinds([text.STATIONS, text.READINGS], ordered)


def drop_datasets(warehouse: Warehouse, names: list[str], pattern: str | None = None) -> None:
    """Removes datasets by exact name, and by a LIKE pattern in any case, from the landing."""
    warehouse.drop_rows(batches.dropped_datasets(names, pattern))


def _by_batch(rows: DataFrame, counted: DataFrame, most: int = BATCH_ROWS) -> DataFrame:
    """Rows dealt by batch for the writer, which sorts them; large batches go to several tasks.

    Spark splits a large batch only between the tasks it comes from. Dealt by batch alone,
    all that one of them has read of a batch would be sorted at once. The batches are
    `counted` first, and one row for each is sent to all tasks.
    """
    parts = F.ceil(F.count(F.lit(1)) / most).alias("parts")
    sizes = counted.groupBy("ingested_at").agg(parts)
    dealt = rows.join(F.broadcast(sizes), "ingested_at", "left").withColumn(
        "part", F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1)))
    )
    return dealt.drop("parts").hint("rebalance", "ingested_at", "part")


def migrate_landing(
    warehouse: Warehouse, path: str, ingested_at: str | None = None
) -> dict[str, object]:
    """Takes in a landing of an older layout, once: (id, dataset, payload), maybe with stamps.

    Files of several layouts may lie together: the columns of all are read. Rows without a
    stamp, and all rows where no file has one, get the given stamp or that of now; ids stay,
    and later ones follow the greatest. A second call for the same path does nothing.
    """
    taken = f"migrated {path}"
    if warehouse.counted(taken):
        return {"status": "already migrated", "raw_rows_inserted": 0}
    stamp = batch_stamp(ingested_at)
    old = warehouse.spark.read.option("mergeSchema", "true").parquet(path)
    rows = batches.stamped(old, stamp).withColumn("id", F.col("id").cast("bigint"))
    watch = Observation()
    seen = rows.observe(watch, F.count(F.lit(1)).alias("rows"), F.max("id").alias("last"))
    columns = schemas.RAW_LANDING.fieldNames()
    warehouse.append(LANDING, _by_batch(seen.select(*columns), rows))
    count, last = watch.get["rows"], watch.get["last"] or 0
    warehouse.reserve(LANDING, max(0, last - warehouse.counted(f"{LANDING}.key")))
    warehouse.count(taken, 1)
    return {"status": "ok", "raw_rows_inserted": count, "ingested_at": stamp}


def land_payloads(
    warehouse: Warehouse,
    payloads: DataFrame,
    order: list[str] | None = None,
    ingested_at: str | None = None,
    append: bool = True,
) -> dict[str, object]:
    """Lands (dataset, payload) rows as one batch.

    Ids follow `order`, columns that tell the rows apart; without it they follow the
    files that the rows are written to, once and without a shuffle, which suits bulk
    loads. The batch is seen at once and at the end. Without `append` it replaces all
    station and readings payloads landed before.
    """
    stamp = batch_stamp(ingested_at)
    if not order:
        if not append:
            warehouse.drop_kinds([text.STATIONS, text.READINGS])
        rows = payloads.select(
            F.lit(None).cast("bigint").alias("id"),
            "dataset",
            "payload",
            F.lit(stamp).alias("ingested_at"),
        )
        return {"raw_rows_inserted": warehouse.append_numbered(rows, stamp), "ingested_at": stamp}
    columns = list(dict.fromkeys(["dataset", "payload", *order]))
    staged = keys.stage_in_order(payloads.select(*columns), order, "id")
    count = staged.count()
    start = warehouse.reserve(LANDING, count)
    rows = keys.number_staged(staged, "id", start).withColumn("ingested_at", F.lit(stamp))
    _write(warehouse, rows.select(*schemas.RAW_LANDING.fieldNames()), stamp, append)
    return {"raw_rows_inserted": count, "ingested_at": stamp}


def land_payload(
    warehouse: Warehouse, dataset: str, payload: str, ingested_at: str | None = None
) -> dict[str, object]:
    """Lands a single document, as a batch of its own unless a stamp is given."""
    stamp = batch_stamp(ingested_at)
    row = warehouse.spark.range(1).select(
        F.lit(warehouse.reserve(LANDING, 1) + 1).cast("bigint").alias("id"),
        F.lit(dataset).alias("dataset"),
        F.lit(payload).alias("payload"),
        F.lit(stamp).alias("ingested_at"),
    )
    _write(warehouse, row, stamp, True)
    return {"raw_rows_inserted": 1, "ingested_at": stamp}


def payload_files(spark: SparkSession, path: str) -> DataFrame:
    """JSON files as (dataset, payload, source); the file name is the dataset name."""
    # url_decode is for forms, where a plus is a blank; in a path it is a plus
    plain = F.replace(text.last_segment(F.col("source")), F.lit("+"), F.lit("%2B"))
    name = F.regexp_replace(F.url_decode(plain), r"[.]json$", "")
    return (
        spark.read.text(path, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
        .select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source"))
        .select(name.alias("dataset"), "payload", "source")
    )


def land_files(
    warehouse: Warehouse, path: str, ingested_at: str | None = None, append: bool = True
) -> dict[str, object]:
    """Lands a folder of payload files as one batch, with ids in path order.

    The folder is listed once: the paths Spark has found then are numbered, and the
    payloads, read and written once, get their id by a join on the path.
    """
    spark = warehouse.spark
    stamp = batch_stamp(ingested_at)
    files = payload_files(spark, path)
    # the same paths but for one spelling: file:///x of a listing is file:/x in a row
    found = sorted(re.sub("^([a-z]+):///", r"\1:/", name) for name in files.inputFiles())
    start = warehouse.reserve(LANDING, len(found))
    numbered = [(source, id) for id, source in enumerate(found, start + 1)]
    index = spark.createDataFrame(numbered, "source string, id bigint")
    watch = Observation()
    rows = files.join(index, "source").withColumn("ingested_at", F.lit(stamp))
    rows = rows.observe(watch, F.count(F.lit(1)).alias("rows"))
    _write(warehouse, rows.select(*schemas.RAW_LANDING.fieldNames()), stamp, append)
    return {"raw_rows_inserted": watch.get["rows"], "ingested_at": stamp}


def search_items(documents: DataFrame, wanted: str, limit: int = 5) -> DataFrame:
    """The first station items, as JSON text, whose label contains the text."""
    items = documents.select(
        F.explode(F.from_json("payload", schemas.RAW_ITEMS_DOC)["items"]).alias("item")
    )
    fields = F.from_json("item", "notation string, label string")
    named = items.select(
        "item", fields["notation"].alias("station_id"), fields["label"].alias("label")
    )
    return lookup.search_stations(named, wanted, "label", "station_id", limit)


def search_payload(found: DataFrame) -> DataFrame:
    """The found items (a handful, by the search limit) as one document."""
    ordered = F.array_sort(F.collect_list(F.struct("station_id", "item")))
    joined = F.array_join(F.transform(ordered, lambda x: x["item"]), ",")
    return found.agg(F.concat(F.lit('{"items":['), joined, F.lit("]}")).alias("payload"))


def land_run(
    warehouse: Warehouse,
    station_documents: DataFrame,
    readings: DataFrame,
    wanted: str,
    parameters: list[str],
    limit: int = 10,
    append: bool = True,
    ingested_at: str | None = None,
    every_station: bool = False,
    search_limit: int = 5,
) -> dict[str, object]:
    """Searches stations, checks the request, lands the newest readings per measure.

    `station_documents` has a `payload` column of station documents, `readings`
    has measure_id, dateTime, value, quality and completeness. As a rule the
    request concerns the first station found; `every_station` takes all of them.
    Raises ValidationError before anything is landed; why it could not be served stays in
    `request_errors`, under the stamp of the run.
    """
    spark = warehouse.spark
    found = scratch_path(spark, "search")
    search_payload(search_items(station_documents, wanted, search_limit)).write.parquet(found)
    search = spark.read.schema("payload string").parquet(found)
    as_landed = search.select(
        F.lit(0).cast("bigint").alias("id"),
        F.lit(text.STATION_DATASET).alias("dataset"),
        "payload",
        F.lit("").alias("ingested_at"),
    )
    catalogue = station_catalogue(as_landed)
    if not every_station:
        catalogue = catalogue.filter(F.col("pos") == 0)
    if catalogue.isEmpty():
        raise ValidationError(f"no station found for '{wanted}'")
    errors = lookup.request_errors(catalogue, parameters)
    stamp = batch_stamp(ingested_at)
    errors = errors.withColumns(
        {"nth": F.col("nth").cast("bigint"), "ingested_at": F.lit(stamp)}
    )
    warehouse.replace_batch(REQUEST_ERRORS, errors, stamp)
    error = warehouse.batch(REQUEST_ERRORS, stamp).orderBy("landing_id", "pos", "nth").first()
    if error:
        raise ValidationError(f"station {error.station_id}: {error.reason} ({error.detail})")

    resolved = lookup.resolved_rows(lookup.resolve_measures(catalogue, parameters))
    asked = lookup.latest_for_measures(
        resolved,
        readings,
        limit,
        ["value", "quality", "completeness"],
        newest="dateTime",
        how="left",
    )
    place = ["pos", "nth", "nth_measure"]
    payloads = readings_payloads(asked, ["measure_id", "parameter", *place]).select(
        text.readings_dataset(F.col("parameter"), F.col("measure_id")).alias("dataset"),
        "payload",
        *place,
    )
    first = search.select(
        F.lit(text.STATION_DATASET).alias("dataset"),
        "payload",
        *[F.lit(-1).alias(name) for name in place],
    )
    return land_payloads(warehouse, first.unionByName(payloads), place, stamp, append)

