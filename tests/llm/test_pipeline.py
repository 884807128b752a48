"""The corpus pipeline: contracts of every stage, on the smallest tables."""

from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import decontamination, near


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", None, 0)], docs.schema)
    kept, inputs = {}, docs.union(odd)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, inputs, sf).cache()
        kept[name] = (inputs, out)
        inputs = out if name != "sharding" else inputs
    names = corpus_pipeline.DOCUMENT
    assert all(out.columns == names for n, (_, out) in kept.items() if n != "sharding")
    before, after = kept["language"]
    assert after.filter("doc_id >= 1000000").count() == 0 and after.count() >= 0.98 * docs.count()
    before, after = kept["near_duplicates"]
    want = {d for d, _, c in near.brute_force([(r.doc_id, r.text) for r in before.collect()], 5, 80) if d == c}
    assert {r.doc_id for r in after.collect()} == want
    before, after = kept["decontamination"]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {r[0] for r in decontamination.brute_force([(r.doc_id, r.text) for r in before.collect()], bench) if not r[5]}
    assert {r.doc_id for r in after.collect()} == want
    before, after = kept["mixing"]
    assert after.join(before, "doc_id", "left_anti").count() == 0
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    before, after = kept["sharding"]
    assert after.select(names).exceptAll(before).isEmpty() and before.exceptAll(after.select(names)).isEmpty()


def test_stages_on_empty_tables(spark, sf):
    """An empty table gives an empty result at every stage, whatever other columns it has."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0).withColumns({"rejected": F.lit("clash"), "shard": F.lit("clash"), "_text": F.lit("clash")})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
