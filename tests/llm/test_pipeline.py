import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        docs = stage(spark, docs, sf).cache()
        assert docs.count() <= before and docs.count() > before // 2
        assert docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
