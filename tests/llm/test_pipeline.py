import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_every_stage_takes_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if at < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
        counts.append(after.count())
        docs = after
    assert counts[0] > counts[1] > counts[2] == counts[3] and counts[5] == counts[4]
    assert docs.where("NOT round_trip").count() == 0
    redacted = spark.read.parquet(str(tmp_path / "secret_scans"))
    assert redacted.where(F.col("n_chars") != F.length("text")).count() == 0
    mixed = spark.read.parquet(str(tmp_path / "mixing")).groupBy("doc_id").count()
    assert mixed.agg(F.max("count")).first()[0] <= 2


def test_odd_rows_go_through(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            out.collect()


def test_texts_are_encoded_once(spark):
    encoded = corpus_pipeline.encoding(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("bpe_encode") == 1
