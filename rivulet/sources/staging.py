"""Tables that live as long as a job: written to the shared folder, removed at its end."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rivulet.session import discard, scratch_path


class Staging:
    """Use as a context: what was staged in it is removed when it ends without an error."""

    def __init__(self) -> None:
        self._held: list[tuple] = []

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.discard()

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """The rows by way of a written table: computed once, and of a size Spark knows."""
        spark = df.sparkSession
        path = scratch_path(spark, label)
        df.write.parquet(path)
        self._held.append((spark, path))
        return spark.read.schema(df.schema).parquet(path)

    def discard(self) -> None:
        for spark, path in self._held:
            discard(spark, path)
        self._held.clear()
