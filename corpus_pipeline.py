"""The corpus pipeline: documents through the operators of rivulet.llm, stage by stage.

1. toxicity: a classifier chain fitted on the labels; documents it rejects go;
2. near duplicates: one document of each class of near copies stays, the first by id;
3. benchmark decontamination: documents that hold a benchmark window go;
4. secrets: spans of secrets are replaced by a mark, the documents stay;
5. packing: what is left, as token pieces in sequences.

Each stage works on all that the one before has kept, which is written as Parquet to the
shared folder and read again, so a lost executor costs no more than its own tasks. Rows
with null texts or ids pass through the stages as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import contamination, jaccard, packing, secrets, toxicity
from rivulet.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.decontaminate(docs, benchmark)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Trained models and tokenizers decide what stays, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
