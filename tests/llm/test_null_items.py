"""Benchmark items whose id is null are scanned like any other."""

import duckdb

from plazaflow.llm import decontaminate

PASSAGE = " ".join(f"w{i}" for i in range(12))


def tables(spark):
    docs = spark.createDataFrame([(1, f"a {PASSAGE} b"), (2, "short one here"), (3, f"{PASSAGE} named item"), (4, "clean text"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, PASSAGE), (None, "short one"), (7, "named item"), (None, None)], "item_id long, text string")
    return docs, items


def test_null_items_match_the_sql(spark):
    docs, items = tables(spark)
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", items)):
        con.register(name, df.toArrow())
    got = decontaminate.report(decontaminate.overlaps(docs, items))
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(decontaminate.SQL).fetchall())
    assert {r.doc_id for r in got.where("contaminated").collect()} == {1, 2, 3}


def test_passages_of_null_items_are_cut(spark):
    docs, items = tables(spark)
    long = docs.selectExpr("doc_id", "concat(text, repeat(' more', 40)) AS text")
    out = decontaminate.decontaminate(long, items)
    assert out.count() == 5 and not any(PASSAGE in (r.text or "") or "short one" in (r.text or "") for r in out.collect())
