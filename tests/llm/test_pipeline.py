"""The pipeline: stage order, effects of each stage's decisions, odd input."""

from pyspark.sql import functions as F

import corpus_pipeline
from wxstar.llm import queries
from wxstar.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = table(spark, SF, "documents")
    first = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(out := str(tmp_path / f"{i}"))
        later = spark.read.parquet(out)
        assert later.columns == first.columns and [t for _, t in later.dtypes] == [t for _, t in first.dtypes], name
        if name == "toxicity":
            judged = {r.doc_id for r in queries.op7_toxicity(spark, SF).where("predicted = 0").collect()}
            assert {r.doc_id for r in later.collect()} == judged
        if name == "simhash_near_dedup":
            from wxstar.llm import simhash

            assert {r.doc_id for r in later.collect()} == {r.component_id for r in simhash.near_duplicates(docs).collect()}
        docs = later
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == given.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_columns_with_the_names_of_working_columns_are_carried(spark):
    """Values of extra columns come through every stage, whatever their names."""
    names = ["__rid", "__toxicity", "__spans", "__copies", "__copy", "__bits", "__place", "__bucket", "__doc", "fp", "rate", "copies", "later"]
    docs = table(spark, SF, "documents").limit(60).select("*", *(F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names)).cache()
    start = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == start.columns, name
    rows = docs.collect()
    assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)


def test_every_dealt_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
