"""Queries on records, rounds, personas and readers; inputs without a table of their own are derived from events, parts and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing, replies
from ..functions import rewards as rw
from ..functions import text as t
from ..operators import personas as p
from ..operators import records as r
from ..sources import readers, schemas, sinks, tasks
from ..streaming import rounds
from .registry import query, table


@query("""
WITH e AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'call' ELSE 'response' END AS kind, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations WHERE role IN ('user', 'assistant'))
SELECT a.conv_id, a.k::BIGINT AS k, md5(a.text) AS call_md5, md5(b.text) AS response_md5 FROM e a LEFT JOIN e b ON a.conv_id = b.conv_id AND a.k = b.k AND b.kind = 'response' WHERE a.kind = 'call'
""")
def call_response_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "conversations").where("role IN ('user', 'assistant')").select("conv_id", "turn", F.lit("tool").alias("name"), F.expr("CASE role WHEN 'user' THEN 'call' ELSE 'response' END").alias("kind"), F.col("text").alias("payload"))
    return r.paired_responses(e, "conv_id", "turn").select("conv_id", F.col("k").cast("long").alias("k"), F.md5("call").alias("call_md5"), F.md5("response").alias("response_md5"))


@query("""
WITH a AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, max_by(event_type <> 'error', event_id) AS ok FROM events GROUP BY 1)
SELECT user_id, greatest(80 - n, 0)::BIGINT AS attempts_left, errors::BIGINT AS errors, CASE WHEN ok THEN 'succeeded' WHEN n >= 80 THEN 'failed' ELSE 'pending' END AS status FROM a
""")
def retry_state(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.expr("CASE WHEN event_type = 'error' THEN event_type END").alias("error"))
    return rounds.retry_state(e, "user_id", "event_id", 80).select("user_id", F.col("attempts_left").cast("long").alias("attempts_left"), F.size("errors").cast("long").alias("errors"), "status")


@query("""
SELECT event_id, greatest(count(*) OVER w * 60.0::DOUBLE / 500, coalesce(sum(floor(value)) OVER w, 0) * 60.0::DOUBLE / 200000) AS starts_at FROM events WHERE value IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def request_pacing(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("value IS NOT NULL").withColumn("tokens", F.floor("value"))
    return rounds.paced(e, "user_id", "event_id", "tokens", 500, 200_000).select("event_id", "starts_at")


@query("SELECT user_id AS agent_id, max_by(event_type, event_id) AS last_action, max(event_id) AS round FROM events GROUP BY 1")
def last_actions(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("agent_id"), F.col("event_type").alias("action"), F.col("event_id").alias("round"))
    return rounds.last_actions(e)


@query("SELECT event_id, round(sum(value) OVER w, 4) AS running_total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)")
def running_totals(spark, sf_dir):
    return p.running_average(table(spark, sf_dir, "events"), "value", "event_id", ["user_id"]).select("event_id", F.round("running_total", 4).alias("running_total"))


@query("SELECT event_id, batch, score FROM (SELECT event_id, event_id // 100 AS batch, floor(value)::BIGINT AS score, row_number() OVER (PARTITION BY event_id // 100 ORDER BY floor(value) DESC, event_id) AS k FROM events WHERE event_type <> 'error' AND value IS NOT NULL) WHERE k = 1")
def best_of_batches(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("value IS NOT NULL").select("event_id", F.expr("event_id div 100").alias("batch"), F.floor("value").alias("score"), (F.col("event_type") != "error").alias("valid"))
    return p.best_of_batch(e, "batch", "score", "event_id", "valid").drop("valid")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def pending_tasks(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return rounds.pending(table(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey")


@query("""
WITH b AS (SELECT source, doc_id, text, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS s FROM documents)
SELECT source, md5(string_agg(text, chr(10) || chr(10) ORDER BY doc_id)) AS packed_md5, count(*) AS documents FROM b WHERE s <= 20000 GROUP BY 1
""")
def document_packs(spark, sf_dir):
    return r.packed_documents(table(spark, sf_dir, "documents"), ["source"], "doc_id", "text", 20_000).select("source", F.md5("packed").alias("packed_md5"), "documents")


@query("SELECT count(*) AS processed, count(*) FILTER (event_type <> 'error') AS succeeded, count(*) FILTER (value > 50) AS large, round(avg(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END), 6) AS success_rate FROM events")
def run_counters(spark, sf_dir):
    return r.counters(table(spark, sf_dir, "events"), succeeded=F.col("event_type") != "error", large=F.col("value") > 50).withColumn("success_rate", F.round("success_rate", 6))


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def row_slice(spark, sf_dir):
    return readers.row_slice(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"), 100, 50)


@query("SELECT doc_id, source FROM (SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n, min(doc_id) OVER (PARTITION BY source) AS f FROM documents) ORDER BY n DESC, f, doc_id LIMIT 120")
def largest_groups_first(spark, sf_dir):
    return readers.by_size_of_group(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 120)


@query("SELECT p_size, p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY CASE WHEN lower(p_brand) = 'brand#11' THEN 0 ELSE 1 END, p_partkey) AS k FROM part) WHERE k = 1")
def pair_resolution(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_size", F.col("p_partkey").alias("pos"), F.col("p_brand").alias("chain"))
    return tasks.resolve_pair(parts, "Brand#11", groups=["p_size"]).select("p_size", F.col("pos").alias("p_partkey"), F.col("chain").alias("p_brand"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_partkey = 7 AND l_shipdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1997-12-31'")
def price_history(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_partkey": "symbol", "l_shipdate": "date"})
    return tasks.price_history(lines, 7, "1995-01-01", "1997-12-31").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT 'check' AS rule, count(*) AS n FROM lineitem WHERE NOT (l_quantity > 10 AND l_extendedprice >= 0) HAVING count(*) > 0")
def table_violations(spark, sf_dir):
    trades = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") - 10).alias("quantity"), F.col("l_extendedprice").alias("price"))
    return schemas.violations(trades, "trades")


@query("""SELECT '[{"event_id":' || event_id || '},{"user_id":' || user_id || ',"event_type":"' || event_type || '"}]' AS value FROM events""")
def request_lines(spark, sf_dir):
    return tasks.request_lines(table(spark, sf_dir, "events"), ["event_id"], ["user_id", "event_type"])


@query("""SELECT user_id AS agent_id, 'market' AS environment_name, 1 AS round, 0 AS sub_round, '{"action":"' || event_type || '"}' AS action, '{"event_id":' || event_id || '}' AS metadata FROM events""")
def action_records(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("agent_id"), F.lit("market").alias("environment_name"), F.lit(1).alias("round"), F.lit(0).alias("sub_round"), F.col("event_type").alias("action"), "event_id")
    return tasks.action_rows(e)


@query("SELECT conv_id, turn, chr(least(98 + turn, 122)::INT) AS label, CASE WHEN turn = 0 THEN 'recall' WHEN turn = 1 THEN 'apply' ELSE 'create' END AS level FROM conversations")
def turn_labels(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", r.level_label(F.col("turn")).alias("label"), r.target_level(F.array(*map(F.lit, ("recall", "apply", "create"))), F.col("turn")).alias("level"))


@query("SELECT user_id, max(ts) AS last_seen FROM events GROUP BY 1 HAVING max(ts) < (SELECT max(ts) FROM events) - INTERVAL '1 hour'")
def idle_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return rounds.idle_sessions(e, "user_id", "ts", e.agg(F.max("ts")).scalar(), 3600)


@query("SELECT p_size AS cohort, 1 AS round, p_brand AS agent_id, max_by(p_name, p_partkey) AS summary FROM part WHERE p_name <> '' GROUP BY 1, 3")
def research_summaries(spark, sf_dir):
    a = table(spark, sf_dir, "part").select(F.col("p_size").alias("cohort"), F.lit(1).alias("round"), F.col("p_brand").alias("agent_id"), F.col("p_name").alias("summary"), "p_partkey")
    return rounds.research_state(a, F.col("summary") != "", "p_partkey")


@query("SELECT p_partkey AS id, (p_size + coalesce((SELECT sum(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END) FROM events WHERE event_id % 500 = p_partkey), 0))::INT AS karma FROM part")
def board_votes(spark, sf_dir):
    posts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("karma"))
    votes = table(spark, sf_dir, "events").select(F.expr("event_id % 500").alias("id"), F.expr("CASE WHEN event_type = 'error' THEN -1 ELSE 1 END").alias("delta"))
    return r.vote(posts, votes)


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '1.0' WHEN event_id % 3 = 1 THEN '0.5,1.0' ELSE '1.0' END AS steps FROM events
""")
def reward_append(spark, sf_dir):
    steps = F.when(F.expr("event_id % 3 = 0"), F.array(F.lit(1.0))).when(F.expr("event_id % 3 = 1"), F.array(F.lit(0.5))).otherwise(F.array().cast("array<double>"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(rw.appended(steps, F.lit(1.0)).cast("array<string>"), ",").alias("steps"))


@query("""
SELECT event_id, CASE k WHEN 0 THEN event_type WHEN 1 THEN 'first' || event_type END AS content, CASE k WHEN 0 THEN event_id WHEN 1 THEN 3 END AS prompt_tokens, CASE k WHEN 0 THEN 'f{"a":1}' WHEN 1 THEN 'g{"b":[2]}' ELSE '' END AS calls, CASE k WHEN 2 THEN 'too many' WHEN 3 THEN 'not parsable' END AS error FROM (SELECT *, event_id % 4 AS k FROM events)
""")
def completions(spark, sf_dir):
    """Answers in two providers' forms, one that is an error, and one that is cut off."""
    k, n, kind = F.col("event_id") % 4, F.col("event_id").cast("string"), F.col("event_type")
    chat = F.concat(F.lit('{"model": "m", "choices": [{"message": {"content": "'), kind, F.lit('", "tool_calls": [{"function": {"name": "f", "arguments": "{\\"a\\":1}"}}]}}], "usage": {"prompt_tokens": '), n, F.lit("}}"))
    blocks = F.concat(F.lit('{"content": [{"type": "text", "text": "first"}, {"type": "text", "text": "'), kind, F.lit('"}, {"type": "tool_use", "name": "g", "input": {"b": [2]}}], "usage": {"input_tokens": 3, "output_tokens": 1}}'))
    body = F.when(k == 0, chat).when(k == 1, blocks).when(k == 2, '{"error": {"message": "too many"}}').otherwise(F.substring(chat, 1, 30))
    got = table(spark, sf_dir, "events").select("event_id", replies.completion_col(body).alias("c"))
    calls = F.array_join(F.transform("c.calls", lambda x: F.concat(x["name"], x["arguments"])), ";")
    return got.select("event_id", "c.content", F.col("c.usage")["prompt_tokens"].alias("prompt_tokens"), calls.alias("calls"), "c.error")


@query("SELECT event_id, CASE WHEN k = 0 THEN 'correct' WHEN k = 1 THEN 'wrong' ELSE 'unclear' END AS verdict, CASE WHEN k = 0 THEN 0.25 WHEN k = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM (SELECT event_id, event_id % 5 AS k FROM events)")
def verdicts(spark, sf_dir):
    """A fenced verdict, a literal within text, none, a list, and a score that is no number."""
    k = F.col("event_id") % 5
    text = F.when(k == 0, 'so: ```json\n{"verdict": "Correct", "score": 0.25}\n```').when(k == 1, "I say {'verdict': 'WRONG', 'score': '1'} and no more").when(k == 2, "no verdict").when(k == 3, '["verdict"]').otherwise('{"verdict": "correct", "score": "high"}')
    return table(spark, sf_dir, "events").select("event_id", replies.verdict_col(text).alias("v")).select("event_id", "v.verdict", "v.score")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'missing_tool_calls' WHEN event_id % 3 = 1 THEN NULL ELSE 'tool_mismatch' END AS error FROM events""")
def generation_errors(spark, sf_dir):
    call = lambda n: F.concat(F.lit('<think>w</think><tool_call>{"name": "f", "arguments": {"x": '), n.cast("string"), F.lit("}}</tool_call>"))
    got = F.when(F.expr("event_id % 3 = 0"), "<think>w</think>text").when(F.expr("event_id % 3 = 1"), call(F.col("event_id"))).otherwise(call(-F.col("event_id") - 1))
    return table(spark, sf_dir, "events").select("event_id", replies.generation_error_col(got, call(F.col("event_id"))).alias("error"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '' ELSE '$.x: not integer' END AS errors FROM events""")
def schema_checks(spark, sf_dir):
    body = F.when(F.expr("event_id % 2 = 0"), '{"x": 1}').otherwise('{"x": "one"}')
    schema = F.lit('{"type": "object", "properties": {"x": {"type": "integer"}}, "required": ["x"]}')
    return table(spark, sf_dir, "events").select("event_id", F.array_join(parsing.schema_check_col(body, schema), ",").alias("errors"))


@query("""
SELECT page_id, CASE WHEN k = 1 THEN '| h |  |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || page_id || ' | x y |' ELSE '| second |' || chr(10) || '| --- |' END AS markdown FROM pages, (VALUES (1), (2)) v(k) WHERE k <= page_id % 3
""")
def html_tables(spark, sf_dir):
    """Whole pages (which have no table of their own) with none, one or two put before them."""
    one = F.concat(F.lit("<table class='t'><tr><th>h</th></tr><tr><td><b>"), F.col("page_id").cast("string"), F.lit("</b></td><td> x\n y<script>no</script></td></tr></table>"))
    two = F.lit("<TABLE><tbody><TR><TD>second</TABLE>")
    more = F.when(F.col("page_id") % 3 == 1, one).when(F.col("page_id") % 3 == 2, F.concat(one, F.lit("<p>between</p>"), two)).otherwise("")
    html = F.concat(more, F.coalesce("html", F.lit("")))
    return tasks.page_tables(table(spark, sf_dir, "pages").select("page_id", html.alias("html"))).select("page_id", "markdown")


@query("SELECT user_id, count(*)::INT AS steps, max(event_id) AS last_event FROM events GROUP BY 1")
def step_traces(spark, sf_dir):
    got = sinks.traces(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", ["event_type"])
    return got.select("user_id", F.size("steps").alias("steps"), F.element_at("steps", -1)["event_id"].alias("last_event"))


@query("SELECT c_custkey, c_acctbal >= 0 AND c_nationkey < 10 AS holds FROM customer")
def conditional_relations(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", p.conditional("c_acctbal >= 0 AND c_nationkey < 10").alias("holds"))


@query()
def persona_generation(spark, sf_dir):
    return p.personas(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")


@query()
def judge_sampling(spark, sf_dir):
    return p.judges_of(table(spark, sf_dir, "benchmark").select("item_id"), ["a", "b", "c", "d", "e"], "item_id", 3)


@query()
def random_actions(spark, sf_dir):
    return p.random_actions(table(spark, sf_dir, "events").select(F.col("user_id").alias("agent_id"), F.col("event_id").alias("round")), "agent_id", "round")


@query("""
WITH h AS (SELECT c_custkey, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || c_custkey::VARCHAR::BLOB) AS h FROM customer)
SELECT c_custkey, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || '89ab'[(strpos('0123456789abcdef', h[17]) - 1) % 4 + 1] || h[18:20] || '-' || h[21:32] AS id FROM h
""")
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", sinks.stable_id(F.col("c_custkey")).alias("id"))


@query("SELECT c_custkey + 1 AS id, c_name AS title, (c_custkey % 5)::INT AS karma FROM customer")
def board_inserts(spark, sf_dir):
    """A board of the first half of the customers, and the rest as new posts without ids of their own."""
    posts = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("id"), F.col("c_name").alias("title"), (F.col("c_custkey") % 5).cast("int").alias("karma"))
    half = posts.count() // 2
    # titles may repeat, so new posts come in the order of their customers
    new = posts.where(F.col("id") > half).withColumn("customer", F.col("id")).withColumn("id", F.lit(-1))
    return r.board_insert(posts.where(F.col("id") <= half), new, "customer")


@query()
def cleaned_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("role <> 'system'")
    packed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    conv = packed.select("conv_id", F.transform("m", lambda x: F.struct(F.when(x["role"] == "user", "human").otherwise("gpt").alias("from"), x["text"].alias("value"))).alias("conversations"))
    return r.cleaned(conv).select("conv_id", F.size("conversations").alias("turns"), "conversation_key")
