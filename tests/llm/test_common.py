"""Shared helpers: row ids, the bitmap filter."""

from wxstar.llm import common


def test_only_marked_keeps_all_matches(spark):
    df = spark.range(-3000, 3000).withColumnRenamed("id", "k")
    ids = df.where("k % 50 = 0")
    got = {r.k for r in common.only_marked(df, ids, "k").collect()}
    want = {r.k for r in ids.collect()}
    assert want <= got and len(got) < len(want) + 20
    assert common.only_marked(df, ids.limit(0), "k").count() == 0


def test_row_ids(spark, odd_docs):
    unique = spark.createDataFrame([(5, "a"), (-2, "b")], "doc_id bigint, text string")
    assert {(r.doc_id, r["__rid"]) for r in common.with_row_ids(unique).collect()} == {(5, 5), (-2, -2)}
    rows = common.with_row_ids(odd_docs).collect()
    assert len({r["__rid"] for r in rows}) == len(rows) == odd_docs.count()
    order = [r.doc_id for r in sorted(rows, key=lambda r: r["__rid"])]
    known = [d for d in order if d is not None]
    assert known == sorted(known) and order[len(known):] == [None] * (len(order) - len(known))
