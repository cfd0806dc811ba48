"""Queries on forms of conversations, calls, tools, rewards and rounds; odd and broken inputs are made from the tables' own texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing, replies
from ..functions import rewards as rw
from ..functions import text as t
from ..operators import conversations as c
from ..operators import explore
from ..operators import market as m
from ..operators import records as r
from ..sources import readers, tasks
from ..streaming import rounds
from .registry import query, table


def _conversations(spark, sf_dir):
    """(conv_id, conversations) as from/value turns in order."""
    packed = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return packed.select("conv_id", c.from_messages(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))).alias("conversations"))


_TURNS = "t AS (SELECT conv_id, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS f, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)"


@query(f"""
WITH {_TURNS}
SELECT conv_id, md5(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', chr(10) ORDER BY k)) AS chat_md5, string_agg(CASE WHEN f = 'gpt' THEN '1' ELSE '0' END, ',' ORDER BY k) AS weights,
md5(coalesce(string_agg(f || ':' || text, '|' ORDER BY k) FILTER (conv_id % 2 = 1 OR n <= 2 OR k > 2), '')) AS without_seed_md5, count(*) FILTER (f = 'system') > 0 AS had_system, (count(*) + CASE WHEN count(*) FILTER (f = 'system') > 0 THEN 0 ELSE 1 END)::INT AS with_system FROM t GROUP BY conv_id
""")
def conversation_forms(spark, sf_dir):
    """Chat text, loss weights, the seed pair dropped where flagged, and a system turn put first."""
    conv = F.col("conversations")
    joined = lambda x: F.md5(F.array_join(F.transform(x, lambda y: F.concat(y["from"], F.lit(":"), y["value"])), "|"))
    return _conversations(spark, sf_dir).select(
        "conv_id", F.md5(c.chat_text(conv)).alias("chat_md5"), F.array_join(c.masked_weights(conv).cast("array<string>"), ",").alias("weights"), joined(c.drop_seed(conv, F.col("conv_id") % 2 == 0)).alias("without_seed_md5"),
        F.exists(conv, lambda x: x["from"] == "system").alias("had_system"), F.size(c.system_first(conv, F.lit("p"))).alias("with_system"),
    )


@query(f"""
WITH {_TURNS}, g AS (SELECT *, f = 'gpt' AND k % 4 = 0 AS calls FROM t)
SELECT conv_id, md5(string_agg((CASE WHEN calls THEN 'reasoning:before|' ELSE '' END) || f || ':' || text || CASE WHEN calls THEN '<tool_call>' ELSE '' END, '|' ORDER BY k)) AS turns_md5, (count(*) + count(*) FILTER (calls))::INT AS turns,
CASE WHEN count(*) FILTER (calls) = 0 THEN 'relevance' WHEN count(*) FILTER (calls) = 1 THEN 'single' WHEN count(*) FILTER (f = 'human') > 1 THEN 'multiturn' ELSE 'multistep' END AS scenario FROM g GROUP BY conv_id
""")
def reasoning_insertion(spark, sf_dir):
    """Every fourth turn, where it is a reply, holds a call: reasoning stands before it, and the conversation's kind follows."""
    calling = lambda x, i: (x["from"] == "gpt") & (i % 4 == 3)
    got = _conversations(spark, sf_dir).withColumn("conversations", F.transform("conversations", lambda x, i: F.struct(x["from"].alias("from"), F.when(calling(x, i), F.concat(x["value"], F.lit("<tool_call>"))).otherwise(x["value"]).alias("value"))))
    turns = c.with_reasoning(F.col("conversations"), F.lit("before"), F.lit("after"))
    return got.select("conv_id", F.md5(F.array_join(F.transform(turns, lambda y: F.concat(y["from"], F.lit(":"), y["value"])), "|")).alias("turns_md5"), F.size(turns).alias("turns"), c.scenario(F.col("conversations")).alias("scenario"))


@query("""
SELECT conv_id, turn, CASE WHEN k = 0 THEN 'unknown_role' WHEN k = 1 AND role <> 'assistant' THEN 'empty_content' WHEN k = 2 THEN 'no_name' END AS error FROM (SELECT *, (conv_id + turn) % 5 AS k FROM conversations)
""")
def message_errors(spark, sf_dir):
    """Roles that aren't known, blank contents, tool turns without a name."""
    k = (F.col("conv_id") + F.col("turn")) % 5
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(k == 0, "narrator").when(k == 2, "tool").otherwise(F.col("role")).alias("role"), F.when(k == 1, " \n").otherwise(F.col("text")).alias("text"))
    check = parsing.arrow_udf(replies.message_error, "string", 2)
    return rows.select("conv_id", "turn", check(F.col("role"), F.col("text")).alias("error"))


@query("""
SELECT doc_id, k = 1 AS incomplete, CASE k WHEN 1 THEN 'unclosed' WHEN 2 THEN 'unopened' WHEN 3 THEN 'reversed' WHEN 4 THEN 'unclosed' WHEN 5 THEN NULL ELSE NULL END AS error, CASE WHEN k IN (0, 1) THEN 'f' END AS last_name, CASE WHEN k IN (0, 1) THEN '{"a":' || doc_id || '}' END AS last_arguments FROM (SELECT doc_id, doc_id % 6 AS k FROM documents WHERE doc_id % 6 <> 4)
""")
def call_errors(spark, sf_dir):
    """Whole texts with a call that is right, not closed, not opened, reversed, or not there."""
    k, text, call = F.col("doc_id") % 6, F.col("text"), F.concat(F.lit("{'name': 'f', 'arguments': {'a': "), F.col("doc_id").cast("string"), F.lit("}}"))
    tagged = F.when(k == 0, F.concat(text, F.lit("<tool_call>"), call, F.lit("</tool_call>"), text)).when(k == 1, F.concat(text, F.lit("<tool_call>"), call)).when(k == 2, F.concat(text, F.lit("</tool_call>"))).when(k == 3, F.concat(F.lit("</tool_call>"), text, F.lit("<tool_call>"))).otherwise(text)
    got = table(spark, sf_dir, "documents").where(k != 4).select("doc_id", tagged.alias("tagged"))
    last = parsing.arrow_udf(lambda x: replies.compact(replies.last_call(x) or {}), "string")(F.col("tagged"))
    got = got.select("doc_id", (t.incomplete_call(F.col("tagged")) & (F.col("doc_id") % 6 == 1)).alias("incomplete"), t.call_error(F.col("tagged")).alias("error"), F.from_json(last, "name string, arguments string").alias("l"))
    return got.select("doc_id", "incomplete", "error", F.col("l.name").alias("last_name"), F.col("l.arguments").alias("last_arguments"))


@query("""
SELECT doc_id, md5(text || '<tool_call>{"arguments":{"a":1},"name":"f"}</tool_call>' || CASE WHEN doc_id % 2 = 0 THEN '<tool_call>broken {</tool_call>' ELSE '' END) AS canonical_md5 FROM documents
""")
def canonical_calls(spark, sf_dir):
    """Bodies of calls as compact JSON with sorted keys; ones that can't be read stay."""
    raw = F.concat("text", F.lit("<tool_call>\n{'name': 'f',  'arguments': {'a': 1}}\n</tool_call>"), F.when(F.col("doc_id") % 2 == 0, "<tool_call>broken {</tool_call>").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(replies.canonical_calls_col(raw)).alias("canonical_md5"))


@query("""
SELECT c_custkey, '{"function":{"name":"f' || c_custkey || '","parameters":{"properties":{"a":{"type":"integer"},"b":{"default":1,"type":"string"},"c":{"items":{"type":"number"},"type":"array"},"d":{"enum":["x","y"],"type":"string"}},"required":["a","c","d"],"type":"object"}},"type":"function"}' AS tool FROM customer WHERE c_custkey % 3 <> 2 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey % 3 = 2
""")
def tool_schemas(spark, sf_dir):
    """Types as people write them, defaults, lists of numbers, enums as maps; a tool that is no literal gives null."""
    n = F.col("c_custkey").cast("string")
    properties = "'a': {'type': 'int'}, 'b': {'type': 'str', 'default': 1}, 'c': {'type': 'List[float]'}, 'd': {'type': 'string', 'enum': {'x': 1, 'y': 2}}"
    bare = F.concat(F.lit("{'name': 'f"), n, F.lit("', 'parameters': {" + properties + "}}"))
    whole = F.concat(F.lit("{'type': 'function', 'function': {'name': 'f"), n, F.lit("', 'parameters': {'type': 'object', 'properties': {" + properties + "}}}}"))
    tool = F.when(F.col("c_custkey") % 3 == 0, bare).when(F.col("c_custkey") % 3 == 1, whole).otherwise(F.concat(F.lit("{broken "), n))
    return table(spark, sf_dir, "customer").select("c_custkey", replies.fixed_tool_col(tool).alias("tool"))


@query("""
SELECT p_partkey, CASE WHEN k = 0 THEN '' WHEN k = 1 THEN 'g: unknown tool' WHEN k = 2 THEN 'f: $.a: not integer' ELSE 'f: $.a: missing' END AS errors, CASE WHEN k < 2 THEN 1 ELSE 2 END::INT AS named, k = 3 AS undescribed FROM (SELECT p_partkey, p_partkey % 4 AS k FROM part)
""")
def call_signatures(spark, sf_dir):
    """Calls against the signatures of their tools, and which tools have a name and a description."""
    k = F.col("p_partkey") % 4
    call = F.when(k == 0, "{'name': 'f', 'arguments': {'a': 1}}").when(k == 1, "{'name': 'g', 'arguments': {}}").when(k == 2, "{'name': 'f', 'arguments': {'a': 'one'}}").otherwise("{'name': 'f', 'arguments': {}}")
    f = '{"type": "function", "function": {"name": "f", "description": "%s", "parameters": {"type": "object", "properties": {"a": {"type": "integer"}}, "required": ["a"]}}}'
    tools = F.when(k < 2, "[" + f % "does" + ', {"function": {"name": ""}}]').when(k == 2, "[" + f % "does" + ", " + f % "it" + "]").otherwise("[" + f % "does" + ", " + f % " " + "]")
    errors = parsing.arrow_udf(lambda a, b: ",".join(parsing.call_errors(list(a), b)), "string", 2)
    named, lacks = parsing.arrow_udf(lambda x: len(replies.named_tools(x)), "int"), parsing.arrow_udf(replies.lacks_descriptions, "boolean")
    got = table(spark, sf_dir, "part").select("p_partkey", parsing.tool_calls_col(F.concat(F.lit("<tool_call>"), call, F.lit("</tool_call>"))).alias("calls"), tools.alias("tools"))
    described = F.when(F.col("p_partkey") % 4 >= 2, lacks(F.when(F.col("p_partkey") % 4 >= 2, F.col("tools")).otherwise("[]"))).otherwise(F.lit(False))
    return got.select("p_partkey", errors(F.col("calls"), F.col("tools")).alias("errors"), named(F.col("tools")).alias("named"), described.alias("undescribed"))


@query("""
SELECT item_id, '["{\\"q\\":\\"' || item_id || '\\"}"]' AS blocks, 'First,Second' AS types, '<tool_call>' || chr(10) || '{"arguments":{"a":[1]},"name":"f' || item_id || '"}' || chr(10) || '</tool_call>' AS call, '<tool_response>' || chr(10) || '{"content":{"ok":true},"name":"f"}' || chr(10) || '</tool_response>' || CASE WHEN item_id % 2 = 0 THEN '' ELSE '.' END AS response FROM benchmark
""")
def fenced_and_formatted(spark, sf_dir):
    """Fenced blocks of a kind among others, names of declared types, and calls and responses as text."""
    n = F.col("item_id").cast("string")
    text = F.concat("text", F.lit("\n```tools\n{'q': '"), n, F.lit("'}\n```\n```other\n{}\n```\n```tools\nbroken\n```\ntype First = number\n  type Second = string\n"))
    blocks = parsing.arrow_udf(lambda x: replies.json.dumps(replies.fenced(x, "tools"), separators=(",", ":")), "string")
    types = parsing.arrow_udf(lambda x: ",".join(replies.type_names(x)), "string")
    call, response = parsing.arrow_udf(lambda a, b: replies.call_text(a, b), "string", 2), parsing.arrow_udf(lambda a, b: replies.response_text(a, b), "string", 2)
    said = response(F.lit("f"), F.concat(F.lit('{"ok": true}'), F.when(F.col("item_id") % 2 == 0, "").otherwise(" ")))
    return table(spark, sf_dir, "benchmark").select("item_id", blocks(text).alias("blocks"), types(text).alias("types"), call(F.concat(F.lit("f"), n), F.lit('{"a": [1]}')).alias("call"), F.concat(said, F.when(F.col("item_id") % 2 == 0, "").otherwise(".")).alias("response"))


@query("""
SELECT event_id, CASE WHEN k = 0 THEN 'bid' WHEN k = 1 THEN 'ask' ELSE 'hold' END AS action, CASE WHEN k < 2 THEN event_id / 2 ELSE 0 END::DOUBLE AS price, CASE WHEN k < 2 THEN user_id ELSE 0 END::BIGINT AS quantity FROM (SELECT *, event_id % 5 AS k FROM events)
""")
def market_actions(spark, sf_dir):
    """Proposing messages as orders; other messages, other actions and broken ones hold."""
    k = F.col("event_id") % 5
    body = lambda side, kind: F.concat(F.lit(f'so: {{"message_type": "{kind}", "content": {{"action": "{side}", "price": '), (F.col("event_id") / 2).cast("string"), F.lit(', "quantity": '), F.col("user_id").cast("string"), F.lit("}}"))
    text = F.when(k == 0, body("bid", "propose")).when(k == 1, body("ASK", "request")).when(k == 2, body("bid", "inform")).when(k == 3, body("wait", "propose")).otherwise("no message {")
    got = parsing.arrow_udf(lambda x: replies.compact(replies.market_action(x)), "string")(text)
    return table(spark, sf_dir, "events").select("event_id", F.from_json(got, "action string, price double, quantity bigint").alias("a")).select("event_id", "a.*")


@query(f"""
WITH {_TURNS}, g AS (SELECT *, k % 3 = 2 AND f = 'gpt' AS boxed, last_value(CASE WHEN f = 'human' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q FROM t)
SELECT conv_id, (k - 1)::INT AS position, md5(q) AS question_md5, '1/' || k AS boxed FROM g WHERE boxed AND q IS NOT NULL AND trim(q) <> ''
""")
def verifiable_answers(spark, sf_dir):
    """Replies with boxed answers, a fraction first, with the question before; what lacks a part goes."""
    said = lambda x, i: F.when((x["from"] == "gpt") & (i % 3 == 1), F.concat(x["value"], F.lit(" \\boxed{no} so \\boxed{\\frac{1}{"), (i + 1).cast("string"), F.lit("}}"))).otherwise(x["value"])
    got = _conversations(spark, sf_dir).withColumn("conversations", F.transform("conversations", lambda x, i: F.struct(x["from"].alias("from"), said(x, i).alias("value"))))
    units = r.judge_units(r.verifiable_turns(got).withColumn("answer", F.col("reply")))
    return units.select("conv_id", "position", F.md5("question").alias("question_md5"), "boxed")


@query("""
SELECT 'q' || doc_id AS qid, CASE WHEN doc_id % 3 = 0 THEN 'top' WHEN doc_id % 3 = 1 THEN 'nested' END AS verdict, CASE WHEN doc_id % 2 = 0 THEN 0.0 ELSE 0.5 END::DOUBLE AS score FROM documents
""")
def judged_records(spark, sf_dir):
    """Verdict and score from the top or from a nested record; empty text is missing, a score of 0 isn't."""
    k = F.col("doc_id") % 3
    text = lambda name: F.when(k == 0, name).otherwise("")
    nested = F.struct(F.lit(None).cast("string").alias("qid"), F.lit("x").alias("question"), F.lit("x").alias("answer"), F.when(k == 1, "nested").otherwise("").alias("verdict"), F.lit(0.5).alias("score"))
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("q"), F.col("doc_id").cast("string")).alias("qid"), text("q").alias("question"), text("a").alias("answer"), text("top").alias("verdict"), F.when(F.col("doc_id") % 2 == 0, 0.0).alias("score"), nested.alias("record"))
    return tasks.judged_record(rows).select("qid", "verdict", "score")


@query("""
WITH s AS (SELECT event_id, event_type <> 'error' AS passed FROM events) SELECT 'sys' AS system, 'q' || event_id AS question, 'expected ' || event_id AS chosen, 'generated ' || event_id AS rejected FROM s WHERE NOT passed
""")
def preference_pairs(spark, sf_dir):
    """Generated calls against expected ones; samples that fail become pairs."""
    n = F.col("event_id").cast("string")
    call = lambda x: parsing.tool_calls_col(F.concat(F.lit('<tool_call>{"name": "f", "arguments": {"x": "'), x, F.lit('", "y": 1}}</tool_call>')))
    want = parsing.tool_calls_col(F.concat(F.lit('<tool_call>{"name": "f", "arguments": {"x": "'), n, F.lit('"}}</tool_call>')))
    rows = table(spark, sf_dir, "events").select(F.lit("sys").alias("system"), F.concat(F.lit("q"), n).alias("question"), F.concat(F.lit("expected "), n).alias("expected_text"), F.concat(F.lit("generated "), n).alias("generated_text"), call(F.when(F.col("event_type") == "error", F.concat(n, F.lit("x"))).otherwise(n)).alias("generated"), want.alias("expected"))
    return r.preference_pairs(r.evaluated(rows))


@query("SELECT user_id, sum(event_id)::BIGINT AS prompt_tokens, sum(CASE WHEN event_type <> 'error' THEN 2 ELSE 0 END)::BIGINT AS completion_tokens, 0::BIGINT AS audio_tokens FROM events GROUP BY 1")
def usage_totals(spark, sf_dir):
    """Usage of several answers summed by kind; a kind that is nowhere counts 0."""
    usage = F.when(F.col("event_type") == "error", F.create_map(F.lit("prompt_tokens"), F.col("event_id"))).otherwise(F.create_map(F.lit("prompt_tokens"), F.col("event_id"), F.lit("completion_tokens"), F.lit(2).cast("long")))
    got = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(usage).alias("u")).select("user_id", replies.usage_totals(F.col("u")).alias("t"))
    return got.select("user_id", *(F.col("t")[k].alias(k) for k in ("prompt_tokens", "completion_tokens", "audio_tokens")))


@query(f"""
WITH {_TURNS}
SELECT conv_id, count(*)::INT AS num_turns, (count(*) FILTER (f = 'gpt'))::INT AS num_code_blocks, conv_id % 2 = 0 AS answer_correct, CASE WHEN conv_id % 4 < 2 THEN 'no,' || conv_id ELSE '' END AS boxes FROM t GROUP BY conv_id
""")
def trajectory_records(spark, sf_dir):
    """Finished runs with boxed or plain answers, right or wrong."""
    n, k = F.col("conv_id").cast("string"), F.col("conv_id")
    answer = F.when(k % 4 < 2, F.concat(F.lit("\\boxed{no} \\boxed{"), n, F.lit("}"))).otherwise(n)
    runs = _conversations(spark, sf_dir).select("conv_id", F.transform("conversations", lambda x: F.struct(x["from"].alias("role"), x["value"].alias("content"), F.when(x["from"] == "gpt", "code").alias("code"))).alias("turns"), answer.alias("final_answer"), F.when(k % 2 == 0, n).otherwise("z").alias("expected"))
    return r.trajectory_rows(runs).select("conv_id", "num_turns", "num_code_blocks", "answer_correct", F.array_join("boxed_answers", ",").alias("boxes"))


@query("""
SELECT page_id, md5(CASE WHEN length(x) > 4000 THEN left(x, 4000) || '...' ELSE x END) AS clipped_md5, CASE WHEN contains(url, '/chat/') THEN 'chat' WHEN contains(url, '/messages') THEN 'messages' WHEN contains(url, '/embeddings') THEN 'embeddings' WHEN contains(url, '/completions') THEN 'completions' ELSE 'chat' END AS endpoint, '"c" "s" ' || page_id AS search FROM (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '/chat/completions' WHEN 1 THEN '/messages' WHEN 2 THEN '/embeddings' ELSE '/completions' END AS url, trim(regexp_replace(html, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS x FROM pages WHERE html IS NOT NULL AND url IS NOT NULL)
""")
def page_texts(spark, sf_dir):
    """Whole pages clipped, endpoints of their addresses, search texts."""
    p = table(spark, sf_dir, "pages").where("html IS NOT NULL AND url IS NOT NULL")
    url = F.concat("url", F.when(F.col("page_id") % 4 == 0, "/chat/completions").when(F.col("page_id") % 4 == 1, "/messages").when(F.col("page_id") % 4 == 2, "/embeddings").otherwise("/completions"))
    return p.select("page_id", F.md5(t.clip(F.col("html"))).alias("clipped_md5"), t.endpoint_of(url).alias("endpoint"), tasks.search_text(F.lit("c"), F.lit("s"), F.col("page_id").cast("string")).alias("search"))


@query("""
SELECT item_id, 'T ' || item_id AS title, 2::INT AS points, 'line' AS chart, '1,2' AS data FROM benchmark
""")
def sections_and_charts(spark, sf_dir):
    """Headed parts and charts put behind whole items."""
    n = F.col("item_id").cast("string")
    text = F.concat(F.lit("# T "), n, F.lit("\n- one\n2. two\n"))
    html = F.concat(F.lit("<p>"), "text", F.lit('</p><div class="line-chart" data-values="1,2" title="x"></div><div class="other">no</div>'))
    s, h = parsing.sections_col(text), parsing.html_charts_col(html)
    return table(spark, sf_dir, "benchmark").select("item_id", F.element_at(s, 1)["title"].alias("title"), F.size(F.element_at(s, 1)["points"]).alias("points"), F.element_at(h, 1)["type"].alias("chart"), F.element_at(h, 1)["data"].alias("data"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'a=1;b.c[0]=x;b.c[1].d=true;e.c=null' WHEN event_id % 3 = 1 THEN 'k=' || event_id END AS flat, CASE WHEN event_id % 3 = 0 THEN 'x' END AS picked FROM events")
def flattened_json(spark, sf_dir):
    """Leaves by full path, one leaf by path, and texts that are no JSON."""
    body = F.when(F.col("event_id") % 3 == 0, '{"a": 1, "b": {"c": ["x", {"d": true}]}, "e": {"c": null}}').when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"k": '), F.col("event_id").cast("string"), F.lit("}"))).otherwise("{no")
    flat = F.array_join(F.array_sort(F.transform(F.map_entries(parsing.flatten_json_col(body)), lambda x: F.concat(x["key"], F.lit("="), x["value"]))), ";")
    return table(spark, sf_dir, "events").select("event_id", flat.alias("flat"), tasks.json_path(body, "b.c[0]").alias("picked"))


@query("""
SELECT 'props' AS column_name, 'string' AS type, true AS nullable, NULL::VARCHAR AS parent UNION ALL SELECT 'event_id', 'bigint', true, NULL UNION ALL SELECT 'props.k', 'integer', true, 'props' UNION ALL SELECT 'props.odd', 'text', true, 'props' UNION ALL SELECT 'props.list[0]', 'numeric', true, 'props'
""")
def json_catalogue(spark, sf_dir):
    """Columns with their types, and the leaves found in the distinct values of a JSON column."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") == 1, '{"odd": "text"}').when(F.col("event_id") == 2, '{"list": [1.5]}').when(F.col("event_id") == 3, "{broken").otherwise(F.concat(F.lit('{"k": '), (F.col("event_id") % 7).cast("string"), F.lit("}"))).alias("props"))
    return explore.catalogue(e, ["props"])


@query("SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 1 THEN 'no description' WHEN 2 THEN 'no category' ELSE 'no description,no category' END AS errors FROM part WHERE p_partkey % 4 <> 0")
def task_errors(spark, sf_dir):
    k = F.col("p_partkey") % 4
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(k.isin(1, 3), " ").otherwise(F.col("p_name")).alias("description"), F.when(k == 3, None).when(k == 2, "").otherwise(F.col("p_brand")).alias("category"))
    return tasks.task_errors(rows).select("id", F.array_join("errors", ",").alias("errors"))


@query("SELECT 'task_' || doc_id AS id, 'Questions on ' || coalesce(lang, 'the text') AS description, source AS category, md5(text) AS expected_md5, (doc_id % 12)::VARCHAR AS grade FROM documents WHERE NOT coalesce(lang = 'de', false)")
def chunk_tasks(spark, sf_dir):
    """Chunks under other column names, filtered, one task each."""
    d = table(spark, sf_dir, "documents").where("lang IS NULL OR lang <> 'de'").select(F.col("doc_id").alias("UUID"), F.col("text").alias("Content"), F.col("source").alias("topic"), F.concat(F.lit(" "), (F.col("doc_id") % 12).cast("string")).alias("level"), F.col("lang").alias("chapter"))
    return tasks.chunk_tasks(readers.textbook_chunks(d)).select("id", "description", "category", F.md5("expected").alias("expected_md5"), F.col("metadata")["grade"].alias("grade"))


@query("SELECT event_id, least(floor(1.5 * 2.0 ** (event_id % 8)), 60)::BIGINT AS waits, floor(abs(value) * 100)::BIGINT * CASE WHEN value < 0 THEN -1 ELSE 1 END AS units, floor(abs(value) * 100) * CASE WHEN value < 0 THEN -1 ELSE 1 END / 100 AS amount FROM events WHERE value IS NOT NULL")
def backoff_and_units(spark, sf_dir):
    """Waits that double up to a limit, and amounts in whole base units and back."""
    units = m.base_units(F.col("value"), 2)
    return table(spark, sf_dir, "events").where("value IS NOT NULL").select("event_id", rw.backoff(1.5, 2.0, F.col("event_id") % 8, most=60.0).alias("waits"), units.alias("units"), m.from_base_units(units, 2).alias("amount"))


@query("SELECT user_id AS env, count(*)::INT AS steps, arg_max(event_type, event_id) AS last_action, max(event_id // 100) >= 9 AS done FROM events GROUP BY 1")
def environment_history(spark, sf_dir):
    """Actions as observations, and the ordered history of each environment; done if the last round is."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("env"), F.col("event_id").alias("round"), F.col("user_id").alias("agent_id"), F.col("event_type").alias("action"))
    seen = rounds.observations(e.withColumn("place", F.col("round")).withColumn("round", F.expr("round div 100")), 9).withColumn("round", F.col("place")).withColumn("observation", F.col("status"))
    got = rounds.history(seen, "env", "round")
    return got.select("env", F.size("history").alias("steps"), F.element_at("history", -1)["action"].alias("last_action"), "done")


@query("""
SELECT p_partkey, coalesce(n_name, 'default') AS cohort, string_agg(p_name, chr(10)) OVER (PARTITION BY p_size ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS log FROM part LEFT JOIN nation ON n_nationkey = p_size
""")
def tool_histories(spark, sf_dir):
    """Tool records under the cohort of their thread, and the notebook up to each."""
    records = table(spark, sf_dir, "part").withColumn("thread_id", F.col("p_size"))
    threads = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("thread_id"), F.col("n_name").alias("cohort"))
    return rounds.notebook(rounds.tool_history(records, threads), "p_size", "p_partkey", "p_name").select("p_partkey", "cohort", "log")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 1 WHEN c_custkey % 3 = 0 THEN 2 ELSE 3 END AS pass FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0")
def until_complete(spark, sf_dir):
    """Passes over what is pending until one makes no progress; some tasks never succeed."""
    state = {"pass": 0}

    def attempt(pending):
        state["pass"] += 1
        fits = {1: "c_custkey % 2 = 0", 2: "c_custkey % 3 = 0", 3: "c_custkey % 5 = 0"}.get(state["pass"], "false")
        return pending.where(fits).withColumn("pass", F.lit(state["pass"]))

    return rounds.until_complete(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", attempt)


@query("SELECT conv_id FROM (SELECT conv_id, max_by(text, turn) FILTER (role = 'user') AS q, max_by(text, turn) FILTER (role = 'assistant') AS a FROM conversations GROUP BY 1) WHERE trim(q) <> '' AND trim(a) <> '' AND conv_id % 4 <> 0")
def active_threads(spark, sf_dir):
    conv = _conversations(spark, sf_dir)
    rows = conv.select("conv_id", F.when(F.col("conv_id") % 4 == 0, " ").otherwise(c.last_of(F.col("conversations"), "human")).alias("last_question"), c.last_of(F.col("conversations"), "gpt").alias("last_answer"))
    return rounds.active_threads(rows).select("conv_id")


@query("SELECT doc_id, greatest(1, length(text) // 4)::BIGINT AS tokens, md5(left(text, 400)) AS cut_md5, (greatest(1, length(text) // 4) + 1 + 6 + 15)::BIGINT AS request FROM documents")
def token_budget_fallback(spark, sf_dir):
    """Tokens, truncation and a request's tokens without a vocabulary: four characters each."""
    from ..functions import tokens

    request = F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages")))
    return table(spark, sf_dir, "documents").select("doc_id", tokens.count_col(F.col("text"), None).alias("tokens"), F.md5(tokens.truncate_col(F.col("text"), 100, None)).alias("cut_md5"), tokens.request_col(request, "chat", None).alias("request"))


@query()
def token_budget(spark, sf_dir):
    """The same with a byte-level vocabulary, where one is installed; the tests hold it against the tokenizer itself."""
    from ..functions import tokens

    v = tokens.installed()
    return table(spark, sf_dir, "documents").select("doc_id", tokens.count_col(F.col("text"), v).alias("tokens"), F.md5(tokens.truncate_col(F.col("text"), 100, v)).alias("cut_md5"), tokens.count_col(tokens.truncate_col(F.col("text"), 100, v), v).alias("cut_tokens"))
