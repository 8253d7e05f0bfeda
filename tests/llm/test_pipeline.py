import corpus_pipeline


def test_stages_on_odd_documents(spark, odd_documents, tmp_path):
    docs = odd_documents
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert docs.columns == odd_documents.columns
    assert "sequence_id" in docs.columns


def test_each_stage_takes_an_empty_table(spark, odd_documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_documents.limit(0), "").count() == 0
