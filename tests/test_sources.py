"""Readers and sinks on small files."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from plazaflow.sources import readers, schemas, sinks


def test_json_lines_modes(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert sorted(r.a for r in readers.json_lines(spark, str(path), "a int").collect()) == [1, 2]
    with pytest.raises(Exception):  # noqa: B017
        readers.json_lines(spark, str(path), "a int", "strict").collect()
    assert readers.json_lines(spark, str(path), "a int, bad_line string", "keep").cache().where("bad_line IS NOT NULL").count() == 1


def test_request_log(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('[{"id": 1}, {"model": "m"}, {"choices": []}]\n{"x": 1}\nbroken\n')
    got = readers.request_log(spark, str(path)).select(F.try_variant_get("request", "$.model", "string").alias("m")).collect()
    assert [r.m for r in got] == ["m"]


def test_folders_and_search(spark, tmp_path):
    for top, sub, name, text in (("Art_Work", "Oil", "a.txt", "one\nTwo needle\nthree"), ("Art_Work", "Ink", "b.txt", "NEEDLE"), ("Law", "Tax", "c.md", "none")):
        (tmp_path / top / sub).mkdir(parents=True, exist_ok=True)
        (tmp_path / top / sub / name).write_text(text)
    files = readers.folder(spark, str(tmp_path), "*.txt")
    assert {(r.category, r.subcategory) for r in files.collect()} == {("Art Work", "Oil"), ("Art Work", "Ink")}
    assert [(r.line_number, r.line) for r in readers.grep(files, "needle").collect()] == [(1, "NEEDLE"), (2, "Two needle")]
    assert files.select(readers.tail(F.col("text"), 1).alias("t")).where("t = 'three'").count() == 1
    kinds = {r["name"]: r.kind for r in readers.listing(spark, str(tmp_path)).collect()}
    assert kinds == {"a.txt": "text", "b.txt": "text", "c.md": "text"}
    assert readers.file_info(files).where("lines = 3").count() == 1
    assert readers.read_any(spark, f"{tmp_path}/Law/Tax/c.md").first().text == "none"
    with pytest.raises(ValueError, match="no reader"):
        readers.read_any(spark, "x.xyz")


def test_curricula(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('Category,SubCategory,Task,Schema\nA,x,"do, this","{""k"": 1}"\nB,y,that,bad\nA,z,more,{}\n')
    got = readers.curriculum(readers.csv(spark, str(path)), "Task", ["A"], schema_column="Schema").orderBy("id").collect()
    assert [(r.id, r.Task) for r in got] == [("curriculum_0", "do, this"), ("curriculum_1", "more")]
    chunks = spark.createDataFrame([("1", "t", "8", "Chapter 0"), ("2", "u", "x", "One")], "uuid string, content string, Grade string, title string")
    got = readers.textbook_chunks(chunks).collect()
    assert [(r.chunk_id, r.text, r.grade) for r in got] == [("2", "u", None)]
    assert [r.id for r in readers.row_slice(spark.range(20).repartition(3), F.col("id"), 5, 3).orderBy("id").collect()] == [5, 6, 7]
    tools = spark.createDataFrame([('[{"name": "f"}, {"type": "function", "function": {"name": "g"}}]',)], "t string").select(readers.wrapped_tools(F.col("t"))).first()[0]
    assert [json.loads(x)["function"]["name"] for x in tools] == ["f", "g"]


def test_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS plaza_test")
    for name in ("cognitive_memory", "knowledge_chunks", "trades"):
        schemas.create(spark, name, "plaza_test")
    rows = spark.createDataFrame([("m1", "a'1", "think"), ("m2", "b", "act")], "memory_id string, agent_id string, content string")
    memory = schemas.conform(rows, "cognitive_memory")
    columns = [c for c in memory.columns if c != "agent_id"] + ["agent_id"]
    memory.select(*columns).write.mode("append").insertInto("plaza_test.cognitive_memory")
    sinks.clear_agent(spark, "cognitive_memory", "b", "plaza_test")
    assert [r.memory_id for r in spark.table("plaza_test.cognitive_memory").collect()] == ["m1"]
    orders = spark.createDataFrame([("o1", "buy", -1.0, 1), ("o1", "hold", 0.0, 0)], "order_id string, side string, price double, quantity long")
    assert {(r.rule, r.n) for r in schemas.violations(orders, "orders").collect()} == {("unique key", 2), ("check", 1)}
    assert all(schemas.schema(n).fields for n in schemas.TABLES)
    spark.sql("DROP DATABASE plaza_test CASCADE")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "i int, x string")
    sinks.append_json_lines(df, str(tmp_path / "out"))
    sinks.append_json_lines(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out"), schema="i int, x string").count() == 4
    objects, chunks = sinks.ingest_knowledge(spark.createDataFrame([("Some text. " * 80, "{}")], "content string, metadata string"))
    assert chunks.join(objects, "knowledge_id").count() == chunks.count() > 1
    t = spark.createDataFrame([("t", [0.5], [("user", "q", None), ("assistant", "a", "c")])], "task_id string, step_rewards array<double>, turns array<struct<role:string,content:string,code:string>>")
    assert [r.reward for r in sinks.exploded_turns(t).orderBy("turn").collect()] == [0.5, 0.0]
    made = spark.createDataFrame([("agent",), ("7",), ("ü",), (str(uuid.uuid4()),)], "n string").select("n", sinks.stable_id(F.col("n")).alias("u")).collect()
    assert all(r.u == (r.n if len(r.n) == 36 else str(uuid.uuid5(uuid.NAMESPACE_DNS, r.n))) for r in made)


def test_episodes_of_many_agents(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS plaza_episodes")
    rows = spark.range(2000).select(F.col("id").cast("string").alias("memory_id"), F.when(F.col("id") % 1000 > 0, F.concat(F.lit("a'"), (F.col("id") % 1000).cast("string"))).alias("agent_id"))
    sinks.append(rows.repartition(8), "episodic_memory", "plaza_episodes")
    table = lambda: spark.table("plaza_episodes.episodic_memory")
    assert spark.sql("SHOW PARTITIONS plaza_episodes.episodic_memory").count() <= 64 and len(table().inputFiles()) <= 64
    for agent in ("a'7", "a'7", "none"):
        sinks.clear_agent(spark, "episodic_memory", agent, "plaza_episodes")
    assert sorted(int(r.memory_id) for r in table().collect()) == [i for i in range(2000) if i % 1000 != 7]
    assert table().where("agent_id IS NULL").count() == 2
    spark.sql("DROP DATABASE plaza_episodes CASCADE")


def test_csv_tasks_of_many_parts(spark, tmp_path):
    from plazaflow.plans.catalog import QUERIES

    n = 40_000
    spark.range(n).select(F.col("id").alias("p_partkey"), F.repeat(F.lit("n"), 5).alias("p_name"), F.concat(F.lit("Brand#"), (F.col("id") % 25).cast("string")).alias("p_brand"), F.sha2(F.col("id").cast("string"), 512).alias("p_type"), F.lit(1).alias("p_size")).repartition(6).write.parquet(f"{tmp_path}/part.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("1k", "32"), strict=True):
            spark.conf.set(k, v)
        got = {r.Task: (r.id, r.Category) for r in QUERIES["csv_tasks"](spark, str(tmp_path)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = sorted((f"task {i}", i) for i in range(n))
    assert got == {t: (f"parts_{k + 1}", f"Brand#{i % 25}") for k, (t, i) in enumerate(want)}


def test_knowledge_ingest_deletes_the_same_objects(spark, tmp_path, monkeypatch):
    from plazaflow.plans import storage

    text = F.concat(F.lit("Text number "), F.col("id").cast("string"), F.lit(". "))
    for n in (2, 300):
        spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text")).write.parquet(f"{tmp_path}/{n}/documents.parquet")

    def kept(df, write=storage.stored.kept):
        got = write(df)
        # a limit without an order may give other rows at each look
        any_order = F.udf(lambda: os.urandom(8).hex()).asNondeterministic()
        got.limit = lambda n: got.orderBy(any_order()).limit(n)
        return got

    monkeypatch.setattr(storage.stored, "kept", kept)
    assert tuple(storage.knowledge_ingest(spark, f"{tmp_path}/300").first() or ()) == (300, 300, True)
    assert tuple(storage.knowledge_ingest(spark, f"{tmp_path}/2").first() or ()) == (2, 2, True)


def test_problem_rows_of_many_parts(spark, tmp_path):
    from plazaflow.plans.catalog import QUERIES

    n = 60_000
    spark.range(n).select((3 * F.col("id")).alias("p_partkey"), F.sha2(F.col("id").cast("string"), 512).alias("p_name"), F.lit("b").alias("p_brand")).repartition(6).write.parquet(f"{tmp_path}/part.parquet")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("1k", "32"), strict=True):
            spark.conf.set(k, v)
        got = QUERIES["problem_rows"](spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.p_partkey, r.id) for r in got) == [(3 * i, f"problem_{i}") for i in range(n) if 3 * i % 4 not in (1, 2)]


def test_csv_tasks_keep_odd_fields(spark, tmp_path):
    from plazaflow.plans.catalog import QUERIES

    brands = [None, "", " ", " in front", "behind ", "a\nb", "a\r\nb", "\tx", 'a"b', '"q"', "a,b", "\\", '\\"', "null", "ü€"]
    # the third task has no number and comes last
    rows = [(None if k == 2 else k, "n", b, brands[-1 - k], 1) for k, b in enumerate(brands)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").repartition(3).write.parquet(f"{tmp_path}/part.parquet")
    want = sorted((f"task {k}", b) for k, b in enumerate(brands) if k != 2) + [(None, brands[2])]
    got = {r.id: (r.Task, r.Category) for r in QUERIES["csv_tasks"](spark, str(tmp_path)).collect()}
    assert got == {f"parts_{k + 1}": x for k, x in enumerate(want)}


def test_problem_rows_without_names_or_keys(spark, tmp_path):
    from plazaflow.plans.catalog import QUERIES

    odd = [None, "", "  ", "x"]
    rows = [(None if k % 9 == 4 else k - 20, odd[k % 4], odd[k // 4 % 4]) for k in range(60)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").repartition(3).write.parquet(f"{tmp_path}/part.parquet")
    keys = sorted(k for k, *_ in rows if k is not None)
    got = QUERIES["problem_rows"](spark, str(tmp_path)).collect()
    # % has the sign of the key, as in SQL
    assert sorted((r.p_partkey, r.id) for r in got) == [(k, f"problem_{i}") for i, k in enumerate(keys) if k < 0 or k % 4 not in (1, 2)]
