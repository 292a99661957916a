"""Every stage works on what its predecessor kept, and its decisions take effect."""

import corpus_pipeline
from sessionweave.llm import decontaminate, simhash
from sessionweave.llm.scratch import Scratch

D = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    scratch = Scratch(spark, "test-pipeline")
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns, kept = docs.columns, {}
    benchmark = {r.item_id: r.text for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = scratch.save(stage(spark, docs, D), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
            assert docs.count() <= before.count() and docs.count() > 0.7 * before.count()
    assert kept["line_dedup"].count() == kept["toxicity"].count()
    assert kept["line_dedup"].filter("n_chars <> length(text)").count() == 0
    left = {r.doc_id: r.text for r in kept["decontamination"].select("doc_id", "text").collect()}
    assert not [i for i, t in left.items() for x in benchmark.values() if x in t]
    near = simhash.near_duplicates(kept["simhash_near_dedup"])
    assert near.filter("doc_id <> component_id").count() == 0
    assert decontaminate.contaminated(kept["decontamination"], spark.read.parquet(f"{D}/benchmark.parquet")).count() == 0
    packed = {r.doc_id for r in kept["packing"].select("doc_id").collect()}
    assert packed == set(left)


def test_toxic_documents_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.01").select("doc_id").join(labels, "doc_id").cache()
    clean = labels.filter("toxic = 0").count()
    assert kept.filter("toxic = 0").count() > 0.9 * clean
    assert kept.filter("toxic = 1").count() < 0.5 * labels.filter("toxic = 1").count()


def test_stages_on_awkward_rows(spark):
    """Nulls, empty texts, repeated rows, clashing columns and empty tables pass every stage as stated."""
    from pyspark.sql import functions as F

    from tests.llm import fixtures

    scratch = Scratch(spark, "test-awkward")
    docs = fixtures.docs(spark).drop("id", "raw", "kept", "hits_0")
    for name in ("n_lines", "n_dropped", "toxicity_score", "gone", "component_id", "score", "fp"):
        docs = docs.withColumn(name, F.lit(f"mine {name}"))
    docs = scratch.save(docs, "docs")
    ids = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, columns = docs, docs.columns
        docs = scratch.save(stage(spark, docs, D), name)
        assert docs.columns == columns, name
        mine = docs.select("n_lines", "n_dropped", "toxicity_score", "gone", "component_id", "score", "fp").distinct().collect()
        assert [tuple(r) for r in mine] == [tuple(f"mine {c}" for c in ("n_lines", "n_dropped", "toxicity_score", "gone", "component_id", "score", "fp"))], name
        assert docs.filter("doc_id is null").count() == before.filter("doc_id is null").count() == 2, name
        assert stage(spark, before.limit(0), D).count() == 0, name
    assert None in {r.doc_id for r in docs.collect()} and {r.doc_id for r in docs.collect()} <= ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, D)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), D).count() == 0
