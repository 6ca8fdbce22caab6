"""The pipeline by its stages, each against its own input."""

import corpus_pipeline
from weirwatch.llm import decontaminate, near_dup, stages, token_ids

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_ids"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stages.stage(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        if name == "near_duplicates":
            want = {r.doc_id for r in near_dup.near_duplicates(before).where("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == want and docs.count() == len(want)
        if name == "decontamination":
            hit = {r.doc_id for r in decontaminate.leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - hit
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(out) == docs.count()
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert token_ids.token_ids(docs).count() == 0
