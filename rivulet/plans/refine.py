"""The layer jobs: landing to bronze, bronze to silver, silver to gold.

Each job takes one batch (the newest of the landing, or one that the caller names) or any
number of batches at once, writes two tables and counts what it has written. Many batches
go through a job in one plan, with the result they would have one after the other, oldest
first: the last station item wins over all of them, a reading finds the stations of its
own batch and of earlier ones, and keys are given batch by batch. All jobs may be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.operators import batches, conform, flatten, keys
from rivulet.operators.conform import SINCE
from rivulet.sources.staging import Staging
from rivulet.sources.tables import BATCH, LANDING, Warehouse

NO_DATA = {"status": "no_raw_data"}
# Files are sorted, so that their statistics let a reader skip by station and time.
READING_ORDER = ["ingested_at", "station_id", "datetime"]

Counts = dict[str, dict[str, int]]  # name of a count, batch, rows
_EARLIER = -1  # arrival of a row that a run before this one has written


def _by_batch(rows: DataFrame) -> dict[str, int]:
    return {row[0]: row[1] for row in rows.groupBy(BATCH).count().collect()}


def _rows(watch: Observation, name: str = "rows") -> int:
    return watch.get.get(name, 0)  # nothing is observed where Spark sees that there is nothing


def _count_written(warehouse: Warehouse, name: str, rows: DataFrame, stamps: list[str], replace: bool):
    """Writes rows of these batches and counts them, by batch.

    A single batch is counted as it is written; several by the tables' partitions, which
    are read without a column.
    """
    watch = Observation()
    before = {} if replace or len(stamps) == 1 else _by_batch(warehouse.batches(name, stamps))
    if len(stamps) == 1:
        rows = rows.observe(watch, F.count(F.lit(1)).alias("rows"))
    if replace:
        warehouse.replace_batches(name, rows, stamps)
    else:
        warehouse.append(name, rows)
    if len(stamps) == 1:
        return {stamps[0]: _rows(watch)}
    after = _by_batch(warehouse.batches(name, stamps))
    return {stamp: after.get(stamp, 0) - before.get(stamp, 0) for stamp in stamps}


def _arrived(stations: DataFrame) -> DataFrame:
    """Rows of a station table as arrivals ahead of all items of their batch."""
    place = {name: F.lit(_EARLIER).cast("bigint") for name in conform.ARRIVAL}
    return stations.withColumns(place)


def _arrival_counts(arrivals: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """By batch: station items, and stations."""
    found = arrivals.groupBy(BATCH).agg(
        F.count_if(F.col("landing_id") > _EARLIER).alias("items"),
        F.count_distinct("station_id").alias("stations"),
    )
    rows = found.collect()
    return {r[BATCH]: r["items"] for r in rows}, {r[BATCH]: r["stations"] for r in rows}


def open_batches(
    warehouse: Warehouse, stamps: list[str], staging: Staging, replace: bool = True
) -> tuple[Counts, DataFrame]:
    """Opens batches into bronze stations (upsert) and bronze readings.

    With `replace` a repeated batch takes the place of its earlier readings;
    without it they are appended once more, which the bronze rules then report.
    Defects of the documents are noticed while the tables are written; only if
    there are any, the batches are read again to list them in `quarantine`.

    Returns the counts, and the arrivals of stations by batch, for the layers to come.
    """
    landed = warehouse.batches(LANDING, stamps)
    station_watch, reading_watch = Observation(), Observation()

    items = staging.write(flatten.flatten_stations(landed, station_watch), "station-items")
    existing = warehouse.read("bronze_station")
    earlier = conform.outdated(existing.filter(F.col(BATCH).isin(stamps)), items)
    arrivals = staging.write(items.unionByName(_arrived(earlier)), "arrivals")
    warehouse.replace("bronze_station", conform.merge_stations(existing, items))

    readings = flatten.flatten_readings(landed, reading_watch).sortWithinPartitions(*READING_ORDER)
    counts = {
        "station_upserts": _arrival_counts(arrivals)[0],
        "measure_inserts": _count_written(warehouse, "bronze_measure", readings, stamps, replace),
    }
    suspects = any(_rows(watch, "suspects") for watch in (station_watch, reading_watch))
    _quarantine(warehouse, landed, stamps, suspects)
    return counts, arrivals


def _quarantine(warehouse: Warehouse, landed: DataFrame, stamps: list[str], suspects: bool) -> None:
    """Lists the defects of the batches, also when a repeated batch turns out clean.

    Payloads of datasets that no layer reads are looked at here only.
    """
    suspects = suspects or not flatten.ignored_issues(landed).isEmpty()
    if suspects or not warehouse.batches("quarantine", stamps).isEmpty():
        warehouse.replace_batches("quarantine", flatten.document_issues(landed), stamps)


def conform_batches(
    warehouse: Warehouse, stamps: list[str], arrivals: DataFrame, staging: Staging
) -> tuple[Counts, DataFrame]:
    """Stations first: the readings are kept by the stations known by their batch.

    Returns the counts, and the arrivals as the next layer sees them.
    """
    arrivals = arrivals.filter(F.col(BATCH).isin(stamps))
    snapshot = staging.write(conform.last_arrivals(arrivals), "snapshot")
    existing = warehouse.read("silver_station")
    known = existing.select("station_id", F.lit("").alias(SINCE))
    known = known.unionByName(snapshot.select("station_id", SINCE))
    earlier = conform.outdated(existing.filter(F.col(BATCH).isin(stamps)), arrivals)
    passed = staging.write(arrivals.unionByName(_arrived(earlier)), "arrivals")
    warehouse.replace("silver_station", conform.merge_snapshot(existing, snapshot.drop(SINCE)))

    fresh = conform.new_silver_measures(
        warehouse.batches("bronze_measure", stamps),
        known,
        warehouse.batches("silver_measure", stamps),
    ).sortWithinPartitions(*READING_ORDER)
    counts = {
        "silver_station_upserts": _arrival_counts(arrivals)[1],
        "silver_measure_inserts": _count_written(warehouse, "silver_measure", fresh, stamps, False),
    }
    return counts, passed


def load_batches(
    warehouse: Warehouse, stamps: list[str], arrivals: DataFrame, staging: Staging
) -> Counts:
    """Dimension with stable keys, then the facts that are not there yet."""
    arrivals = arrivals.filter(F.col(BATCH).isin(stamps))
    snapshot = staging.write(conform.last_arrivals(arrivals), "snapshot")
    dimension = warehouse.read("dim_station")
    used = dimension.agg(F.max("station_key")).first()[0] or 0
    fresh = snapshot.join(dimension.select("station_id"), "station_id", "left_anti")
    merged = conform.merge_dimension(dimension, snapshot, used, [SINCE, "station_id"], staging)
    warehouse.replace("dim_station", merged)

    first = fresh.select("station_id", SINCE)
    stations = warehouse.read("dim_station").join(first, "station_id", "left")
    facts = conform.new_facts(
        warehouse.batches("silver_measure", stamps),
        stations.withColumn(SINCE, F.coalesce(SINCE, F.lit(""))),
        warehouse.batches("fact_measurement", stamps),
        conform.BY_BATCH,
    )
    staged = keys.stage_in_order(facts, conform.BY_BATCH, "measurement_key", staging)
    written = _by_batch(staged)
    start = warehouse.reserve("fact_measurement", sum(written.values()))
    numbered = keys.number_staged(staged, "measurement_key", start)
    warehouse.append(
        "fact_measurement", numbered.sortWithinPartitions("ingested_at", "measurement_key")
    )
    return {
        "dim_station_upserts": _arrival_counts(arrivals)[1],
        "fact_measurement_inserts": written,
    }


def summaries(stamps: list[str], counts: Counts) -> list[dict[str, object]]:
    """What was done for each batch."""
    return [
        {"status": "ok", "ingested_at": stamp}
        | {name: found.get(stamp, 0) for name, found in counts.items()}
        for stamp in stamps
    ]


def landing_to_bronze(
    warehouse: Warehouse, replace: bool = True, batch: str | None = None
) -> dict[str, object]:
    """One batch of the landing, the newest unless told, into bronze."""
    batch = batch or batches.latest_batch(warehouse.read(LANDING))
    if batch is None:
        return dict(NO_DATA)
    with Staging() as staging:
        counts, _ = open_batches(warehouse, [batch], staging, replace)
    return summaries([batch], counts)[0]


def _batch_of(warehouse: Warehouse, name: str, batch: str) -> DataFrame:
    return _arrived(warehouse.batch(name, batch).select(*schemas.STATION.fieldNames()))


def bronze_to_silver(warehouse: Warehouse, batch: str | None = None) -> dict[str, object]:
    """One batch of bronze, the newest landed unless told, into silver."""
    batch = batch or batches.latest_batch(warehouse.read(LANDING))
    if batch is None:
        return dict(NO_DATA)
    with Staging() as staging:
        arrivals = _batch_of(warehouse, "bronze_station", batch)
        counts, _ = conform_batches(warehouse, [batch], arrivals, staging)
    return summaries([batch], counts)[0]


def silver_to_gold(warehouse: Warehouse, batch: str | None = None) -> dict[str, object]:
    """One batch of silver, the newest landed unless told, into gold."""
    batch = batch or batches.latest_batch(warehouse.read(LANDING))
    if batch is None:
        return dict(NO_DATA)
    with Staging() as staging:
        arrivals = _batch_of(warehouse, "silver_station", batch)
        counts = load_batches(warehouse, [batch], arrivals, staging)
    return summaries([batch], counts)[0]
