import corpus_pipeline
from pyspark.sql import functions as F

from grainfield.llm.mixing import word_count
from grainfield.llm.ngramjoin import jaccard_components

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.cut(stage(spark, docs, SF))
        if name != "bpe":
            assert out.columns == docs.columns
        if name in ("toxicity", "quality", "near_duplicates"):
            assert 0 < out.count() <= docs.count() and out.join(docs, docs.columns, "left_anti").count() == 0
        if name == "near_duplicates":
            best = jaccard_components(docs, 5, 80, 100).agg(F.countDistinct("component_id")).first()[0]
            assert out.count() == best
        if name == "mixing":
            before, after = (d.agg(F.sum(word_count(F.col("text")))).first()[0] for d in (docs, out))
            assert abs(after - 1.5 * before) <= 257 * docs.select("source").distinct().count()
            assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
