"""Queries through the extension points, the search cache and page extraction."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions import parsing
from ..operators import records as r
from ..sources import tasks
from ..streaming import rounds
from .extension import Registry, Workflow, compatible, input_schema, output_schema
from .registry import query, table


def _price(size: int, factor: float = 2.0) -> float:
    """The price of a size."""
    return size * factor


@query("""
SELECT p_partkey, p_size * 1.5::DOUBLE AS price, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '$.size: not integer' END AS error, 'The price of a size.' AS description, 'integer,number' AS inputs, 'number' AS output, true AS fits FROM part
""")
def registered_callable(spark, sf_dir):
    """A registered function over rows, its derived schemas, and arguments that its schema doesn't admit."""
    registry = Registry()
    registry.register("price", _price, {"type": "object", "properties": {"size": {"type": "integer"}, "factor": {"type": "number"}}, "required": ["size"]})

    def call(arguments: str) -> str:
        try:
            return json.dumps({"price": registry.execute("price", json.loads(arguments)), "error": ""})
        except ValueError as e:
            return json.dumps({"price": None, "error": str(e)})

    schema, tool = input_schema(_price), registry.tool("price")
    whole = F.concat(F.lit('{"factor": 1.5, "size": '), F.col("p_size").cast("string"), F.lit("}"))
    wrong = F.concat(F.lit('{"factor": 1.5, "size": "'), F.col("p_size").cast("string"), F.lit('"}'))
    run = parsing.arrow_udf(call, "string")
    got = table(spark, sf_dir, "part").select("p_partkey", F.from_json(run(whole), "price double, error string")["price"].alias("price"), F.from_json(run(F.when(F.col("p_partkey") % 2 == 0, whole).otherwise(wrong)), "price double, error string")["error"].alias("error"))
    inputs = ",".join(v["type"] for v in schema["properties"].values())
    return got.withColumns({"description": F.lit(tool["function"]["description"]), "inputs": F.lit(inputs), "output": F.lit(output_schema(_price)["type"]), "fits": F.lit(compatible(schema, tool["function"]["parameters"]))})


@query("""
SELECT event_id, CASE WHEN value IS NULL THEN 'read' WHEN value > 100 THEN 'check' END AS failed, CASE WHEN value IS NOT NULL THEN value * 2 END AS doubled, CASE WHEN value <= 100 THEN value * 2 + 1 END AS result FROM events
""")
def workflow_steps(spark, sf_dir):
    """Three steps in a line; a row that fails in one isn't touched by the next."""
    read = lambda df: df.withColumns({"doubled": F.col("value") * 2, "error": F.when(F.col("value").isNull(), "no value")})
    check = lambda df: df.withColumn("error", F.when(F.col("value") > 100, "too large"))
    finish = lambda df: df.withColumn("result", F.col("doubled") + 1)
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return Workflow(("read", read), ("check", check), ("finish", finish)).run(rows).select("event_id", "failed", "doubled", "result")


@query("""
WITH q AS (SELECT user_id % 20 AS query, 3 AS n FROM events) SELECT query, 'hit' AS kind, count(*) AS rows_count FROM q WHERE query < 7 GROUP BY 1 UNION ALL SELECT DISTINCT query, 'ask', 1 FROM q WHERE query >= 7
""")
def search_cache(spark, sf_dir):
    """Searches that the cache answers, and distinct ones that must still be asked."""
    queries = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("query"), F.lit(3).alias("n"))
    cache = spark.range(7).select(F.col("id").alias("query"), F.lit(3).alias("n"), F.lit("result").alias("result")).union(spark.range(7, 12).select("id", F.lit(4), F.lit("other number")))
    hits, ask = rounds.cached_searches(queries, cache)
    return hits.groupBy("query").agg(F.lit("hit").alias("kind"), F.count(F.lit(1)).alias("rows_count")).unionByName(ask.select("query", F.lit("ask").alias("kind"), F.lit(1).cast("long").alias("rows_count")))


@query("""
SELECT page_id, CASE k WHEN 0 THEN 'first' ELSE 'third' END AS content, CASE k WHEN 0 THEN 'mixed' WHEN 1 THEN 'table' ELSE 'text' END AS kind, 'a,b' AS phrases, 'text' AS stripped FROM (SELECT page_id, page_id % 4 AS k FROM pages) WHERE k < 3
""")
def page_extraction(spark, sf_dir):
    """The first method that gave a text, the kind of whole pages, phrases each once, and a fixed reminder taken off."""
    k = F.col("page_id") % 4
    p = table(spark, sf_dir, "pages").select("page_id", F.when(k == 0, "first").when(k == 1, " ").alias("a"), F.lit(None).cast("string").alias("b"), F.when(k < 3, " third").otherwise("").alias("c"), F.concat(F.when(k == 0, "<table><canvas>").when(k == 1, "<table>").otherwise(""), F.coalesce("html", F.lit(""))).alias("html"))
    got = tasks.extracted(p, "a", "b", "c")
    phrases = r.distinct_phrases(F.array(F.lit(" a"), F.lit("b "), F.lit(""), F.lit("a")))
    return got.select("page_id", "content", r.content_type(F.col("html")).alias("kind"), F.array_join(phrases, ",").alias("phrases"), F.replace(F.lit("text\nThink first."), F.lit("\nThink first."), F.lit("")).alias("stripped"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 5 UNION ALL SELECT n_nationkey + 100, n_name FROM nation WHERE n_nationkey < 2")
def statement_batch(spark, sf_dir):
    """Statements one after the other, each safe to repeat."""
    from ..sources import stored
    from .storage import _database

    base = _database(spark)
    table(spark, sf_dir, "nation").createOrReplaceTempView("nations_for_statements")
    tasks.run_statements(spark, f"CREATE TABLE IF NOT EXISTS {base}.n (n_nationkey int, n_name string) USING parquet", f"INSERT OVERWRITE {base}.n SELECT n_nationkey, n_name FROM nations_for_statements WHERE n_nationkey < 5", f"INSERT INTO {base}.n SELECT n_nationkey + 100, n_name FROM nations_for_statements WHERE n_nationkey < 2")
    got = stored.kept(spark.table(f"{base}.n"))
    spark.sql(f"DROP DATABASE {base} CASCADE")
    return got
