"""Batches: the newest one, and what an overwriting run removes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions import text

BATCH = "ingested_at"


def latest_batch(landing: DataFrame, column: str = BATCH) -> str | None:
    """The greatest batch stamp, compared as text; None for an empty or unstamped table."""
    return landing.agg(F.max(column)).first()[0] or None


def all_batches(landing: DataFrame, column: str = BATCH) -> list[str]:
    """All batch stamps, the oldest first, compared as text."""
    found = landing.select(column).distinct().collect()
    return sorted(row[0] for row in found if row[0])


def only_latest(df: DataFrame, landing: DataFrame, column: str = BATCH) -> DataFrame:
    """Rows of `df` in the newest batch of `landing`.

    The maximum is a scalar subquery; on a table partitioned by the batch it
    becomes a partition filter of the scan.
    """
    newest = landing.agg(F.max(column).alias("newest")).scalar()
    return df.filter(F.col(column) == newest)


def dropped_datasets(names: list[str], pattern: str | None = None) -> Column:
    """True for datasets with one of the names, or like the pattern, in any case."""
    dropped = F.col("dataset").isin(names)
    if pattern is not None:
        dropped = dropped | text.in_dataset_kind(F.col("dataset"), pattern)
    return F.coalesce(dropped, F.lit(False))


def without_datasets(
    landing: DataFrame, names: list[str], pattern: str | None = None
) -> DataFrame:
    """What stays when some datasets are dropped, by exact name and by a LIKE pattern."""
    return landing.filter(~dropped_datasets(names, pattern))


def survivors(landing: DataFrame) -> DataFrame:
    """The landing rows an overwriting run keeps."""
    return without_datasets(landing, [text.STATION_DATASET], text.READINGS_KIND + "%")


def batch_counts(landing: DataFrame) -> DataFrame:
    """Landed payloads per batch and dataset."""
    return landing.groupBy(BATCH, "dataset").agg(F.count("*").alias("payloads"))


def stamped(landing: DataFrame, stamp: str) -> DataFrame:
    """Landing rows of an older layout, without the batch column, or with gaps in it."""
    if BATCH not in landing.columns:
        return landing.withColumn(BATCH, F.lit(stamp))
    return landing.withColumn(BATCH, F.coalesce(BATCH, F.lit(stamp)))
