from cardlens.llm import byte_bpe, decontamination, line_dedup, simhash, toxicity

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and (name != "line_dedup" or after == before)
    # nothing is left for the filtering stages to take
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert decontamination.drop_contaminated(docs, benchmark).count() == docs.count()
    assert simhash.near_duplicates(docs).where("doc_id <> component_id").count() == 0
    assert line_dedup.dedup_lines(docs).where("n_dropped > 0").count() == 0
    name, stage = corpus_pipeline.STAGES[-1]
    encoded = stage(spark, docs, SMALL)
    assert encoded.count() == docs.count()
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(whole.select("doc_id", "ids_sha256").collect()) == sorted(
        encoded.select("doc_id", "ids_sha256").collect()
    )


def test_toxic_documents_go(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bad = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_stages_on_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_last_stage_returns_tokens(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(5)
    row = corpus_pipeline.encode(spark, docs, SMALL).first()
    assert len(row.ids) == row.n_tokens and byte_bpe.MOST_KEPT > 0
