import corpus_pipeline
import __spark_entry__ as entry


def test_stages_take_effect_and_run_equals_them(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert 0 < docs.count() <= seen
        seen = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id", "piece", "length", "ids_crc32")
    run = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last.collect()))


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 11))
