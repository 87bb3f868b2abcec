import corpus_pipeline


def test_stages_filter_in_turn(spark, tables_dir):
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, tables_dir)
        assert after.columns == docs.columns
        assert 0 < after.count() <= before, name
        docs, before = after, after.count()
    final = corpus_pipeline.run(spark, tables_dir)
    assert final.count() == before and final.where("not round_trip").count() == 0


def test_an_empty_table_and_null_ids_pass(spark, tables_dir):
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, " ".join(f"word{i}" for i in range(60)), None, None, 3)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), tables_dir).count() == 0
        assert stage(spark, odd, tables_dir).count() == 1
    poor = spark.createDataFrame([(None, "a text that is too short", None, None, 3)], docs.schema)
    assert corpus_pipeline.quality_rules(spark, poor, tables_dir).count() == 0


def test_texts_go_to_python_in_small_batches(spark, tables_dir):
    key, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.read.parquet(f"{tables_dir}/documents.parquet")
    given = spark.conf.get(key)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(key, "10000")
            stage(spark, docs.limit(0), tables_dir)
            assert name in ("quality_rules", "decontamination") or int(spark.conf.get(key)) == corpus_pipeline.BATCH_ROWS, name
        spark.conf.set(key, "10")
        corpus_pipeline.encoding(spark, docs, tables_dir)
        assert spark.conf.get(key) == "10"
    finally:
        spark.conf.set(key, given)
