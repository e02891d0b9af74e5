"""Intermediate tables in the shared folder, removed together once nothing reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rivulet.session import discard, scratch_path


class Scratch:
    def __init__(self) -> None:
        self.held: list[tuple] = []

    def write(self, rows: DataFrame, label: str) -> DataFrame:
        """The rows by way of a written table, which cuts their lineage."""
        spark = rows.sparkSession
        path = scratch_path(spark, label)
        rows.write.parquet(path)
        self.held.append((spark, path))
        return spark.read.parquet(path)

    def discard(self) -> None:
        for spark, path in self.held:
            discard(spark, path)
        self.held.clear()
