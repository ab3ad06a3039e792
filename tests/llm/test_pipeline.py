import corpus_pipeline as pipeline
from scrimtally.llm import near_duplicates, pii, sentencepiece, toxicity
from scrimtally.llm.base import stored, table
from scrimtally.llm.decontamination import passages

SF = "/root/testdata/sf0.001"


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_each_stage_works_on_what_is_kept(spark):
    docs = table(spark, SF, "documents")
    kept = docs
    for name, stage in pipeline.STAGES[:4]:
        before, kept = kept, stored(stage(spark, kept, SF), "stage")
        assert kept.columns == docs.columns
        if name == "toxicity":
            toxic = toxicity.score_documents(before, table(spark, SF, "labels")).filter("predicted = 1")
            assert ids(kept) == ids(before) - ids(toxic)
        if name == "near duplicates":
            assert ids(kept) == ids(near_duplicates.near_duplicates(before).filter("kept"))
        if name == "decontamination":
            assert ids(kept) == ids(before) - ids(passages(before, table(spark, SF, "benchmark")))
        if name == "pii":
            assert ids(kept) == ids(before)
            left = pii.digests(kept).selectExpr("sum(n_email)", "sum(n_ip)").first()
            assert tuple(left) == (0, 0)
    last = pipeline.STAGES[4][1](spark, kept, SF)
    asked = sentencepiece.token_digests(kept, pipeline.model_path())
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, asked.collect()))
