"""One query per operator, each over its whole table, with the SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against every benchmark window of ten words."""
    from rivulet.llm import contamination

    found = contamination.find_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _listed(spans: str):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known forms and random strings in every document."""
    from rivulet.llm import secrets

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through a token file and back."""
    from rivulet.llm import tokenfile
    from rivulet.session import scratch_path

    path = scratch_path(spark, "tokenfile")
    tokenfile.write(table(spark, sf_dir, "documents"), path)
    return tokenfile.read(spark, path, digest=True)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, huge ones by spliced chunks."""
    from rivulet.llm import counts

    return counts.count(table(spark, sf_dir, "documents")).withColumn(
        "over_limit", F.col("n_tokens") > 1024
    )


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of twenty words that start earlier."""
    from rivulet.llm import repeats

    return repeats.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    from rivulet.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, against all vectors."""
    from rivulet.llm import neighbours

    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.top_k(vectors, F.col("vec_id") % 20 == 0)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of five-word shingles are alike to 0.8."""
    from rivulet.llm import jaccard

    return jaccard.classes(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of each category of toxicity for every document."""
    from rivulet.llm import toxicity

    documents = table(spark, sf_dir, "documents")
    chain = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, chain).withColumn(
        "toxic_predicted", (F.col("toxic") >= toxicity.THRESHOLD).cast("int")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four fifths of the labels."""
    from rivulet.llm import features, quality

    documents = table(spark, sf_dir, "documents")
    held_out = features.crc32_fold() == 0
    model = quality.fit(documents, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(documents, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two to four words of each language, by their lowest cut."""
    from rivulet.llm import phrases

    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL by the listed rules, then by those mined from what the list judges."""
    from rivulet.llm import urlrules

    return urlrules.judge(table(spark, sf_dir, "pages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near rows of other labels for each anchor and positive."""
    from rivulet.llm import negatives

    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ALL = {
    "op1_decontamination": op1_decontamination,
    "op2_secrets": op2_secrets,
    "op3_token_files": op3_token_files,
    "op4_token_counts": op4_token_counts,
    "op5_repeats": op5_repeats,
    "op6_packing": op6_packing,
    "op7_top_k": op7_top_k,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_phrases": op11_phrases,
    "op12_url_filters": op12_url_filters,
    "op13_hard_negatives": op13_hard_negatives,
}

#: Tokenizers, packing and fitted models are beyond SQL; tests hold those queries against
#: plain versions.
SQL: dict[str, str] = {
    "op1_decontamination": sql.OP1,
    "op5_repeats": sql.OP5,
    "op7_top_k": sql.OP7,
    "op8_near_duplicates": sql.OP8,
    "op11_phrases": sql.OP11,
    "op12_url_filters": sql.OP12,
    "op13_hard_negatives": sql.OP13,
}
