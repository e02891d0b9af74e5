"""The layer tables as Parquet under one root.

- Station tables hold a full snapshot per state; a merge reads state n and writes
  state n+1, so nothing is read and replaced at once.
- Which state counts is a row in `counter`, added once the files are complete: a
  job that fails half-way leaves only files that nobody reads.
- Reading tables are partitioned by batch. Replacing a batch stages its files and
  renames the folder at commit.
- The landing is partitioned by batch and kind of dataset, so that an overwriting run
  touches the partitions it drops and no other file. Rows of a bulk load are written
  without an id: `landing_files` tells where each of its files starts in the numbering,
  and a row's id is that plus its place in the file. Rows of a file that is not listed
  there, as a failed load leaves them, are not seen.
- `landing_counts` holds the payloads of each batch and kind, so that rules over the
  whole landing need not read it.
- One writer at a time, as in any table without a lock.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rivulet import schemas
from rivulet.functions import text
from rivulet.session import discard, scratch_path

LANDING = "raw_landing"
LANDING_FILES = "landing_files"
LANDING_COUNTS = "landing_counts"
REQUEST_ERRORS = "request_errors"
COUNTER = "counter"
BATCH = "ingested_at"
KIND = "kind"

# Tables with states, and the partition column within a state.
STATEFUL = {
    LANDING: [BATCH, KIND],
    LANDING_COUNTS: [],
    "bronze_station": [],
    "silver_station": [],
    "dim_station": [],
}
PARTITIONS = {
    "bronze_measure": [BATCH],
    "silver_measure": [BATCH],
    "fact_measurement": [BATCH],
    "quarantine": [BATCH],
    LANDING_FILES: [BATCH],
    REQUEST_ERRORS: [BATCH],
    COUNTER: ["name"],
}
SCHEMAS = {
    LANDING: schemas.RAW_LANDING,
    "bronze_station": schemas.STATION,
    "silver_station": schemas.STATION,
    "dim_station": schemas.DIM_STATION,
    "bronze_measure": schemas.MEASURE,
    "silver_measure": schemas.MEASURE,
    "fact_measurement": schemas.FACT_MEASUREMENT,
    "quarantine": schemas.ISSUE,
    LANDING_FILES: schemas.LANDED_FILE,
    LANDING_COUNTS: schemas.LANDED_COUNT,
    REQUEST_ERRORS: schemas.REQUEST_ERROR,
    COUNTER: schemas.COUNTER,
}


class Warehouse:
    """Sees the states as of its first use of a table, and what it writes itself."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._created: set[str] = set()
        self._counters: dict[str, int] | None = None

    def empty(self, name: str) -> DataFrame:
        return schemas.empty(self.spark, SCHEMAS[name])

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return False
            raise
        return True

    def _path(self, name: str, state: int | None = None) -> str:
        if name not in STATEFUL:
            return f"{self.root}/{name}"
        return f"{self.root}/{name}/state-{self._state(name) if state is None else state}"

    def create(self, name: str) -> None:
        """Creates the table, without rows, if it is missing."""
        if name not in self._created:
            first = self._path(name, 0)
            self.empty(name).write.mode("ignore").parquet(first)
            self._created.add(name)

    def read(self, name: str) -> DataFrame:
        """The current content.

        The schema is always given: left alone, Spark reads a batch '2026' as a
        number. A state is read by its own path, so Spark knows its size when it
        chooses a join.
        """
        if name == LANDING:
            return self._landed().select(*SCHEMAS[LANDING].fieldNames())
        if name in STATEFUL and self._state(name) == 0:
            return self.empty(name)
        return self._scan(name)

    def _scan(self, name: str) -> DataFrame:
        """The files of the current state, with the partition columns."""
        self.create(name)
        schema = SCHEMAS[name]
        if name == LANDING:
            schema = StructType([*schema.fields, StructField(KIND, StringType())])
        return self.spark.read.schema(schema).parquet(self._path(name))

    def find(self, name: str) -> DataFrame | None:
        """The current content, or None if the table does not exist."""
        return self.read(name) if self.exists(name) else None

    def batch(self, name: str, stamp: str) -> DataFrame:
        """One batch; the filter prunes all other partitions."""
        return self.read(name).filter(F.col(BATCH) == stamp)

    def batches(self, name: str, stamps: list[str]) -> DataFrame:
        """Some batches; the filter prunes all other partitions."""
        if len(stamps) == 1:
            return self.batch(name, stamps[0])
        return self.read(name).filter(F.col(BATCH).isin(stamps))

    def append(self, name: str, df: DataFrame, stamp: str | None = None) -> None:
        """Adds rows; a `stamp` says that they are all of one batch."""
        self.create(name)
        self._writer(name, df).mode("append").parquet(self._path(name))
        if name == LANDING:
            self._recount(stamp)

    def replace_batch(self, name: str, df: DataFrame, stamp: str) -> None:
        self.replace_batches(name, df, [stamp])

    def replace_batches(self, name: str, df: DataFrame, stamps: list[str]) -> None:
        """Writes `df`, rows of these batches or none, in place of their earlier content.

        An overwrite by partition leaves a batch alone that has no rows any more; the
        files it has not touched are then removed.
        """
        self.create(name)
        before = self._files(self.batches(name, stamps))
        self._overwrite(name, df)
        if before:
            self._delete(before & self._files(self.batches(name, stamps)))

    def _overwrite(self, name: str, df: DataFrame) -> None:
        """Replaces the partitions that `df` has rows of."""
        writer = self._writer(name, df).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self._path(name))

    def _files(self, rows: DataFrame) -> set[str]:
        found = rows.select("_metadata.file_path").distinct()
        return {row[0] for row in found.collect()}

    def _delete(self, paths: set[str]) -> None:
        jvm = self.spark.sparkContext._jvm
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for gone in paths:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(gone))
            path.getFileSystem(hadoop).delete(path, True)

    def replace(self, name: str, df: DataFrame) -> None:
        """Makes `df`, which may come from the current state, the next state."""
        following = self._state(name) + 1
        self._writer(name, df).mode("overwrite").parquet(self._path(name, following))
        self.count(f"{name}.state", following)
        if name == LANDING:
            self._recount(None)

    def _writer(self, name: str, df: DataFrame):
        rows = df.select(*SCHEMAS[name].fieldNames())
        if name == LANDING:
            rows = rows.withColumn(KIND, text.dataset_kind(F.col("dataset")))
        partitions = STATEFUL.get(name) or PARTITIONS.get(name) or []
        return rows.write.partitionBy(*partitions)

    # --- the landing -----------------------------------------------------------

    def _landed(self) -> DataFrame:
        """The landing with its kind; rows of bulk loads with the id of their place."""
        scan = self._scan(LANDING)
        if not self.exists(LANDING_FILES):
            return scan
        names = scan.columns
        placed = scan.select(
            *names,
            F.col("_metadata.file_name").alias("__file"),
            F.col("_metadata.row_index").alias("__row"),
        )
        starts = self.read(LANDING_FILES).select(BATCH, KIND, F.col("file").alias("__file"), "first")
        numbered = placed.join(starts, [BATCH, KIND, "__file"], "left").withColumn(
            "id", F.coalesce("id", F.col("first") + F.col("__row"))
        )
        return numbered.filter(F.col("id").isNotNull()).select(*names)

    def _recount(self, stamp: str | None) -> None:
        """Counts one batch of the landing anew, or all; the ids alone are read."""
        rows = self._landed()
        counts = self.read(LANDING_COUNTS)
        if stamp is not None:
            rows = rows.filter(F.col(BATCH) == stamp)
            kept = counts.filter(F.col(BATCH) != stamp)
        else:
            kept = counts.limit(0)
        fresh = rows.groupBy(BATCH, KIND).agg(F.count("*").alias("payloads"))
        self.replace(LANDING_COUNTS, kept.unionByName(fresh).coalesce(1))

    def landed_counts(self) -> DataFrame:
        """kind, payloads, ingested_at: what has landed, without a look at the landing."""
        return self.read(LANDING_COUNTS)

    def append_numbered(self, df: DataFrame, stamp: str) -> int:
        """Lands rows of one batch, numbered by their place in the files written here.

        One write of the payloads and no shuffle; the rows count once their files are
        listed in `landing_files`.
        """
        self.create(LANDING)
        self._delete(self._files(self._unlisted(stamp)))  # what a failed load has left
        self._writer(LANDING, df).mode("append").parquet(self._path(LANDING))
        sizes = (
            self._unlisted(stamp)
            .groupBy(KIND, F.col("_metadata.file_name").alias("file"))
            .agg((F.max("_metadata.row_index") + 1).alias("rows"))
        )
        written = sorted(tuple(row) for row in sizes.collect())  # one row for each file
        count = sum(rows for _, _, rows in written)
        if not count:
            return 0
        following, listed = self.reserve(LANDING, count) + 1, []
        for kind, file, rows in written:
            listed.append((kind, file, following, stamp))
            following += rows
        self.append(LANDING_FILES, self.spark.createDataFrame(listed, schemas.LANDED_FILE))
        self._recount(stamp)
        return count

    def _unlisted(self, stamp: str) -> DataFrame:
        """Rows of a batch without an id whose file is not listed either."""
        rows = self._scan(LANDING).filter((F.col(BATCH) == stamp) & F.col("id").isNull())
        if not self.exists(LANDING_FILES):
            return rows
        names = [row[0] for row in self.batch(LANDING_FILES, stamp).select("file").collect()]
        return rows.filter(~F.col("_metadata.file_name").isin(names)) if names else rows

    def drop_kinds(self, kinds: list[str], rows: DataFrame | None = None) -> None:
        """Removes all rows of some kinds, and adds `rows`; files of other kinds stay as they are."""
        gone = self._files(self._scan(LANDING).filter(F.col(KIND).isin(kinds)))
        if rows is not None:
            self._writer(LANDING, rows).mode("append").parquet(self._path(LANDING))
        self._delete(gone)
        self._recount(None)

    def drop_rows(self, dropped: Column) -> None:
        """Removes some rows; only partitions that hold one are written anew."""
        scan = self._landed()
        dropped = F.coalesce(dropped, F.lit(False))
        touched = scan.filter(dropped).select(BATCH, KIND).distinct()
        files = self._scan(LANDING).select(BATCH, KIND, "_metadata.file_path").distinct()
        gone = {row[2] for row in files.join(touched, [BATCH, KIND], "left_semi").collect()}
        if not gone:
            return
        path = scratch_path(self.spark, "landing-kept")
        kept = scan.join(touched, [BATCH, KIND], "left_semi").filter(~dropped)
        kept.write.parquet(path)
        kept = self.spark.read.schema(scan.schema).parquet(path)
        self._overwrite(LANDING, kept)
        self._delete(gone)  # those of partitions that have kept nothing
        discard(self.spark, path)
        self._recount(None)

    # --- counters ------------------------------------------------------------

    def counted(self, counter: str) -> int:
        """The value of a counter; all of them (two per table at most) are read once."""
        if self._counters is None:
            newest = self.read(COUNTER).groupBy("name").agg(F.max("value").alias("value"))
            self._counters = {row["name"]: row["value"] for row in newest.collect()}
        return self._counters.get(counter, 0)

    def count(self, counter: str, value: int) -> None:
        row = self.spark.range(1).select(
            F.lit(value).cast("bigint").alias("value"), F.lit(counter).alias("name")
        )
        self.append(COUNTER, row)
        if self._counters is not None:
            self._counters[counter] = value

    def _state(self, name: str) -> int:
        return self.counted(f"{name}.state")

    def reserve(self, name: str, count: int) -> int:
        """Reserves `count` keys and returns the last one used before them.

        Reserved ahead of the write: a run that fails in between burns its
        numbers, and no key is ever given twice.
        """
        last = self.counted(f"{name}.key")
        if count:
            self.count(f"{name}.key", last + count)
        return last
