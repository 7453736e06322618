"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from plain import decontamination, near_duplicates


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet")
             .select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in
              spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        before = {r.doc_id: r.text for r in docs.collect()}
        if name != "sharding":
            assert after.schema == docs.schema
        after = spark.createDataFrame(
            after.collect(), after.schema)
        kept = {r.doc_id for r in after.collect()}
        if name == "quality":
            known = set(labels) & set(before)
            assert sum((i in kept) == labels[i] for i in known) >= 0.97 * len(known)
        elif name == "near_duplicates":
            assert kept == {i for i, _, _, k in near_duplicates(before.items()) if k}
        elif name == "decontamination":
            assert kept == {r[0] for r in decontamination(before.items(), items) if not r[5]}
        elif name == "mixing":
            assert kept <= set(before) and len(kept) >= 0.5 * len(before)
        else:
            assert kept == set(before)
            counts = [sum(r.shard == s for r in after.collect()) for s in range(24)]
            assert max(counts) - min(counts) <= 1
        docs = after


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 0
    assert corpus_pipeline.ORACLE_SQL is None
