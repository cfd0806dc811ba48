"""Vector and memory queries. Search queries are the rows whose id is divisible by 50, against all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explore as x
from ..operators import vectors as v
from .registry import query, table


def _queries(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


_PAIRS = "p AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0)"


@query(f"""
WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS k FROM p)
SELECT query_id, vec_id, round(s, 6) AS similarity, k::BIGINT AS rank, lang, md5(text) AS text_md5 FROM r JOIN documents ON doc_id = vec_id WHERE k <= 10
""")
def knn_knowledge_search(spark, sf_dir):
    best = v.nearest_of_each(table(spark, sf_dir, "embeddings"), _queries(spark, sf_dir), 10)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "lang", "text")
    return best.join(docs, "vec_id").select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"), "lang", F.md5("text").alias("text_md5"))


@query("""
WITH q AS (SELECT embedding FROM embeddings WHERE vec_id = 0)
SELECT e.vec_id, label, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS similarity FROM embeddings e, q WHERE list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) > 0.1 ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, vec_id LIMIT 20
""")
def knn_threshold_strict(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id = 0").first().embedding
    return v.nearest(e, q, 20, least=0.1, strict=True).select("vec_id", "label", F.round("similarity", 6).alias("similarity"))


@query("""
WITH q AS (SELECT embedding FROM embeddings WHERE vec_id = 0)
SELECT e.vec_id, label, round(list_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS distance FROM embeddings e, q ORDER BY list_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), vec_id LIMIT 20
""")
def knn_euclidean(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id = 0").first().embedding
    return v.nearest(e, q, 20, metric="euclidean").select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query("""
WITH q AS (SELECT embedding FROM embeddings WHERE vec_id = 0),
h AS (SELECT doc_id, text AS content, length(text) AS n, length(text) // 2 AS m FROM documents),
c AS (SELECT doc_id, left(content, m) AS text, 0 AS a, m AS b FROM h UNION ALL SELECT doc_id, substring(content, m + 1), m, n FROM h),
s AS (SELECT c.*, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s FROM embeddings e JOIN c ON c.doc_id = e.vec_id, q),
b AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY s DESC, a) AS k FROM s WHERE s >= 0.05),
t AS (SELECT * FROM b WHERE k = 1 ORDER BY s DESC, text LIMIT 15),
o AS (SELECT t.*, content, n, greatest(a - 200, 0) AS x, least(b + 200, n) AS y FROM t JOIN h USING (doc_id))
SELECT doc_id::VARCHAR AS knowledge_id, md5(text) AS chunk_md5, a::INT AS start_pos, round(s, 6) AS similarity, md5(CASE WHEN x > 0 THEN '...' ELSE '' END || substring(content, x + 1, y - x) || CASE WHEN y < n THEN '...' ELSE '' END) AS context_md5 FROM o
""")
def knowledge_search_distinct(spark, sf_dir):
    """Documents as objects, their halves as chunks with true places; the context is cut from the whole document."""
    e, d = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    q = e.where("vec_id = 0").first().embedding
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    chunk = lambda a, b: F.struct(F.substring(F.col("text"), a + 1, b - a).alias("text"), a.cast("int").alias("start_pos"), b.cast("int").alias("end_pos"))
    cut = d.select(F.col("doc_id"), F.col("doc_id").cast("string").alias("knowledge_id"), F.explode(F.array(chunk(F.lit(0), half), chunk(half, n))).alias("c")).select("doc_id", "knowledge_id", "c.*")
    chunks = cut.join(e.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")
    objects = d.select(F.col("doc_id").cast("string").alias("knowledge_id"), F.col("text").alias("content"))
    return v.search_knowledge(chunks, objects, q, 15, 0.05).select("knowledge_id", F.md5("text").alias("chunk_md5"), "start_pos", F.round("similarity", 6).alias("similarity"), F.md5("context").alias("context_md5"))


@query("""
SELECT event_id, user_id, event_type, value FROM (SELECT * FROM events WHERE event_type IN ('click', 'purchase') AND ts >= TIMESTAMP '2024-01-02' AND ts <= TIMESTAMP '2030-01-01' ORDER BY ts DESC, event_id DESC LIMIT 50)
""")
def memory_recent_filtered(spark, sf_dir):
    from datetime import datetime

    e = table(spark, sf_dir, "events")
    got = x.memory_filter(e, "ts", "event_type", ["click", "purchase"], datetime(2024, 1, 2), datetime(2030, 1, 1))
    return x.recent(got, "ts", "event_id", 50).select("event_id", "user_id", "event_type", "value")


@query("SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract_string(props, '$.k') = '7'")
def json_metadata_filter(spark, sf_dir):
    return x.memory_filter(table(spark, sf_dir, "events"), "ts", metadata={"k": 7}, metadata_column="props").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT event_type, count(*) AS n, sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum FROM events GROUP BY 1")
def json_leaf_projection(spark, sf_dir):
    leaf = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(leaf).alias("k_sum"))


@query("SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders)::BIGINT AS total_rows, ((SELECT count(*) FROM orders) + 99)::BIGINT // 100 AS total_pages FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200")
def page_with_total(spark, sf_dir):
    return x.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 3, 100)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name ILIKE '%00%' OR c_mktsegment ILIKE '%build%'")
def search_any_column(spark, sf_dir):
    return x.search(x.search(table(spark, sf_dir, "customer"), "", ["c_custkey"]), "00", ["c_name"]).select("c_custkey", "c_name", "c_mktsegment").union(x.search(table(spark, sf_dir, "customer"), "BUILD", ["c_mktsegment"]).select("c_custkey", "c_name", "c_mktsegment")).distinct()


_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _NAMES))
def table_row_counts(spark, sf_dir):
    return x.row_counts({n: table(spark, sf_dir, n) for n in _NAMES})


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name WHERE EXISTS (SELECT 1 FROM {n})" for n in _NAMES))
def nonempty_tables(spark, sf_dir):
    return spark.createDataFrame([(n,) for n in x.non_empty({n: table(spark, sf_dir, n) for n in _NAMES})], "table_name string")


@query("""
SELECT 'p_retailprice' AS column_name, round(avg(p_retailprice), 4) AS mean_value, max(p_retailprice) AS max_value, min(p_retailprice) AS min_value, round(stddev_samp(p_retailprice), 4) AS std_value FROM part
UNION ALL SELECT 'p_size', round(avg(p_size), 4), max(p_size)::DOUBLE, min(p_size)::DOUBLE, round(stddev_samp(p_size), 4) FROM part
UNION ALL SELECT 'p_brand', NULL, NULL, NULL, NULL
""")
def table_stats(spark, sf_dir):
    return x.column_statistics(table(spark, sf_dir, "part"), ["p_retailprice", "p_size", "p_brand"]).withColumns({c: F.round(c, 4) for c in ("mean_value", "std_value")})


@query("""
WITH c AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS b FROM events)
SELECT user_id, round(avg((value - p) / nullif(p, 0)), 4) AS mean_change, count((value - p) / nullif(p, 0)) AS steps, CASE WHEN avg((value - p) / nullif(p, 0)) > 0 THEN 'up' WHEN avg((value - p) / nullif(p, 0)) < 0 THEN 'down' ELSE 'flat' END AS direction FROM c WHERE b <= 5 GROUP BY 1
""")
def trend_last5(spark, sf_dir):
    return x.trend(table(spark, sf_dir, "events"), "value", ["ts", "event_id"], ["user_id"]).withColumn("mean_change", F.round("mean_change", 4))


@query("""
WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN event_id END AS l1, CASE WHEN event_type = 'purchase' THEN value END AS l2 FROM events)
SELECT event_id, last_value(l1 IGNORE NULLS) OVER w AS l1, last_value(l2 IGNORE NULLS) OVER w AS l2 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)
""")
def ffill_levels(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.expr("CASE WHEN event_type = 'signup' THEN event_id END").alias("l1"), F.expr("CASE WHEN event_type = 'purchase' THEN value END").alias("l2"))
    return x.fill_down(e, ["l1", "l2"], "event_id", ["user_id"]).select("event_id", "l1", "l2")


@query("""
SELECT c.event_id, (SELECT max_by(p.value, (p.ts, p.event_id)) FROM events p WHERE p.user_id = c.user_id AND p.event_type = 'purchase' AND p.ts <= c.ts) AS last_purchase FROM events c WHERE c.event_type = 'click'
""")
def asof_last_purchase(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    buys = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("last_purchase"), "event_id")
    buys = buys.groupBy("user_id", "ts").agg(F.max_by("last_purchase", "event_id").alias("last_purchase"))
    return x.asof(e.where("event_type = 'click'").select("event_id", "user_id", "ts"), buys, ["user_id"], "ts", "last_purchase", "event_id").select("event_id", "last_purchase")


@query("""
SELECT source, doc_id, n_chars, s AS running_cost FROM (SELECT source, doc_id, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS s FROM documents) WHERE s <= 40000
""")
def token_budget_pack(spark, sf_dir):
    return x.budget_prefix(table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source"], "doc_id", F.col("n_chars"), 40000)


@query("SELECT p_partkey, p_name FROM part WHERE p_size = 5 AND contains(lower(p_name), 'a') ORDER BY p_partkey DESC LIMIT 25")
def board_listing(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.array(F.col("p_size").cast("string")).alias("categories"), F.col("p_partkey").alias("karma"))
    return x.board(p, "A", ["5"], "karma", 25).select(F.col("id").alias("p_partkey"), F.col("title").alias("p_name"))
