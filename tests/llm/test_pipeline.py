"""The corpus pipeline and the entry queries on a small table."""

import corpus_pipeline
from rivulet.llm import queries
from rivulet.llm.toxicity import THRESHOLD


def test_stages(spark, data):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    toxic = {
        r.doc_id for r in queries.op9_toxicity(spark, data).collect() if r.toxic >= THRESHOLD
    }
    left = {r.doc_id for r in docs.select("doc_id").collect()} - toxic
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, data)
        assert docs.columns == before.columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            assert ids == left
        if name == "secrets":
            assert ids == {r.doc_id for r in before.select("doc_id").collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert {r.doc_id for r in packed.collect()} == ids


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.ALL) == list(range(1, 14))
