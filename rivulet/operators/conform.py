"""The layer rules: bronze to silver to gold, as plain DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.functions import text
from rivulet.operators import keys, lookup, merge
from rivulet.sources.staging import Staging

STATION_KEY = ["station_id"]
READING_KEY = ["measure_id", "datetime", "ingested_at"]
BY_BATCH = ["ingested_at", "measure_id", "datetime"]
ARRIVAL = ["landing_id", "pos"]
SINCE = "since"
REQUIRED = ["station_id", "parameter", "unit", "measure_id", "datetime", "ingested_at"]


def merge_stations(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Station upsert; the incoming rows carry their batch and their arrival order in it."""
    return merge.upsert(existing, incoming, STATION_KEY, ["ingested_at", *ARRIVAL])


def merge_snapshot(existing: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Station upsert from a layer that holds each station once."""
    return merge.upsert(existing, snapshot, STATION_KEY, STATION_KEY)


def merge_dimension(
    existing: DataFrame,
    snapshot: DataFrame,
    used: int = 0,
    order: list[str] = STATION_KEY,
    staging: Staging | None = None,
) -> DataFrame:
    """Dimension upsert: known stations keep their key, new ones get the next, in `order`."""
    return keys.upsert_keyed(existing, snapshot, STATION_KEY, "station_key", order, used, staging)


def outdated(earlier: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Rows of an earlier run that no arrival of their batch, or of one before, replaces."""
    newer = arrivals.select(F.col("station_id").alias("__id"), F.col("ingested_at").alias("__at"))
    replaced = (earlier["station_id"] == newer["__id"]) & (newer["__at"] <= earlier["ingested_at"])
    return earlier.join(newer, replaced, "left_anti")


def last_arrivals(arrivals: DataFrame) -> DataFrame:
    """The last arrival per station, over all batches, and the first batch as `since`."""
    columns = schemas.STATION.fieldNames()
    order = F.struct("ingested_at", *ARRIVAL)
    last = F.max_by(F.struct(*columns), order).alias("last")
    first = F.min("ingested_at").alias(SINCE)
    grouped = arrivals.groupBy(F.col("station_id").alias("id")).agg(last, first)
    return grouped.select("last.*", SINCE)


def conform_measures(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "parameter": text.lower_ascii(F.col("parameter")),
            "datetime": text.conform_timestamp(F.col("datetime")),
        }
    )


def with_instants(df: DataFrame) -> DataFrame:
    """Adds `datetime_ts` and `ingested_at_ts` for analysis; the texts stay the keys."""
    return df.withColumns(
        {
            "datetime_ts": text.to_instant(F.col("datetime")),
            "ingested_at_ts": text.to_instant(F.col("ingested_at")),
        }
    )


def new_silver_measures(bronze: DataFrame, stations: DataFrame, existing: DataFrame) -> DataFrame:
    """Readings to append to silver: of known stations, conformed, first per reading key.

    Where `stations` says since which batch it knows a station, readings of earlier batches
    do not find it.
    """
    since = SINCE if SINCE in stations.columns else None
    known = lookup.keep_known(bronze, stations, "station_id", since)
    rows = conform_measures(known).select(*schemas.MEASURE.fieldNames())
    return merge.insert_if_absent(rows, existing, READING_KEY, ARRIVAL, REQUIRED)


def new_facts(
    silver: DataFrame, dimension: DataFrame, existing: DataFrame, order: list[str] = READING_KEY
) -> DataFrame:
    """Facts to append, still without their own key; silver holds each reading key once.

    They are range partitioned by `order`, the columns of the reading key as they will be
    sorted. `dimension` may say since which batch it knows a station.
    """
    since = SINCE if SINCE in dimension.columns else None
    rows = lookup.attach(silver, dimension, "station_id", "station_key", since)
    facts = merge.insert_if_absent(
        rows, existing, order, ARRIVAL, ["station_key", *REQUIRED], by_range=True
    )
    return facts.select(*[c for c in schemas.FACT_MEASUREMENT.fieldNames() if c != "measurement_key"])
