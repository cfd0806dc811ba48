"""Curation queries: dedup, conversations, text measures, tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing
from ..functions import text as t
from ..operators import conversations as c
from ..operators import dedup, matching
from ..operators import explore as x
from .registry import query, table

_NORM = "trim(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))"


@query("SELECT doc_id, md5(text) AS key FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def dedup_exact_md5(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("key"))
    return dedup.first_of_each(d, F.col("key"), "doc_id")


@query(f"SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY sha256({_NORM}) ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def dedup_normalised_sha256(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", t.hash_text(F.col("text")).alias("h"))
    return dedup.first_of_each(d, F.col("h"), "doc_id").drop("h")


@query("SELECT md5(text) AS key, count(*) AS copies, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def copies_of_texts(spark, sf_dir):
    return dedup.copies(table(spark, sf_dir, "documents"), F.md5("text"), "doc_id")


@query(f"""
SELECT doc_id FROM documents WHERE {_NORM} <> '' AND sha256({_NORM}) NOT IN (SELECT sha256({_NORM}) FROM documents WHERE source = 'src0')
""")
def anti_join_published(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    key = F.when(t.normalise_space(F.col("text")) != "", t.hash_text(F.col("text"))).otherwise("")
    return dedup.without_published(d, key, d.where("source = 'src0'"), key).select("doc_id")


@query("""
WITH a AS (SELECT doc_id, md5(text) AS key, 0 AS side FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, md5(text), 1 FROM documents WHERE doc_id % 3 <> 0)
SELECT doc_id, key FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY side, doc_id) AS k FROM a) WHERE k = 1
""")
def merge_existing_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("key"))
    return dedup.merge(d.where("doc_id % 3 = 0"), d.where("doc_id % 3 <> 0"), F.col("key"), "doc_id")


@query("""
WITH n AS (SELECT doc_id, md5(text) AS key FROM documents WHERE doc_id % 3 <> 0)
SELECT doc_id, key FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id) AS k FROM n WHERE key NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 3 = 0)) WHERE k = 1
""")
def new_rows_only(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("key"))
    return dedup.new_rows(d.where("doc_id % 3 <> 0"), d.where("doc_id % 3 = 0"), "key", "doc_id").select("doc_id", "key")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def upsert_latest_wins(spark, sf_dir):
    return dedup.latest_of_each(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query("SELECT source AS key, count(DISTINCT sha256(text)) AS contents, count(*) AS rows_count FROM documents GROUP BY 1 HAVING count(DISTINCT sha256(text)) > 1")
def registry_conflicts(spark, sf_dir):
    return dedup.conflicts(table(spark, sf_dir, "documents"), F.col("source"), F.col("text"))


# ---- conversations --------------------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS r2, lead(text) OVER w AS reply FROM conversations WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, text AS question, reply FROM t WHERE role = 'user' AND r2 = 'assistant' AND trim(reply) <> ''
""")
def pair_filter(spark, sf_dir):
    return c.answered_pairs(table(spark, sf_dir, "conversations"))


@query("""
WITH t AS (SELECT conv_id, turn, text AS question, lead(text) OVER w AS reply, role, lead(role) OVER w AS r2 FROM conversations WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT *, row_number() OVER (PARTITION BY question, reply ORDER BY conv_id, turn) AS k FROM t WHERE role = 'user' AND r2 = 'assistant' AND trim(reply) <> '')
SELECT conv_id, turn, question, reply FROM p WHERE k = 1
""")
def distinct_pairs(spark, sf_dir):
    return c.distinct_pairs(c.answered_pairs(table(spark, sf_dir, "conversations")), ["conv_id", "turn"])


@query("""
WITH s AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AND role = 'user' THEN 0 ELSE 1 END AS st FROM conversations),
i AS (SELECT *, sum(st) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS isl FROM s)
SELECT conv_id, min(turn) AS turn, any_value(role) AS role, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text, count(*)::INT AS merged FROM i GROUP BY conv_id, isl
""")
def merge_consecutive_turns(spark, sf_dir):
    return c.merged_turns(table(spark, sf_dir, "conversations"), ["user"])


@query("""
SELECT conv_id, turn, question, text AS reply FROM (SELECT *, last_value(CASE WHEN role = 'user' AND trim(text) <> '' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS question FROM conversations) WHERE role = 'assistant'
""")
def preceding_question(spark, sf_dir):
    return c.preceding_question(table(spark, sf_dir, "conversations"))


@query("""
SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT conv_id, min(turn) - 1, 'system', 'You are helpful.' FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'system') = 0
""")
def system_prompt_injection(spark, sf_dir):
    return c.with_system(table(spark, sf_dir, "conversations"), "You are helpful.")


@query("""
WITH p AS (SELECT conv_id, turn, role, text, string_agg(role || ':' || text, '|') OVER w AS h, count(*) OVER w AS n, last_value(CASE WHEN role = 'system' THEN text END IGNORE NULLS) OVER w AS sp FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT conv_id, turn, md5(coalesce(h, '')) AS history_md5, n AS history_turns, sp AS system_prompt FROM p WHERE role = 'assistant'
""")
def turn_prefixes(spark, sf_dir):
    got = c.prefixes(table(spark, sf_dir, "conversations"))
    joined = F.array_join(F.transform("history", lambda h: F.concat(h["role"], F.lit(":"), h["text"])), "|")
    return got.select("conv_id", "turn", F.md5(joined).alias("history_md5"), F.size("history").cast("long").alias("history_turns"), "system_prompt")


@query("""
SELECT conv_id, count(*) FILTER (role = 'user') AS calls, CASE WHEN count(*) FILTER (role = 'user') = 0 THEN 'none' WHEN count(*) FILTER (role = 'user') = 1 THEN 'single' WHEN max(turn) FILTER (role = 'user') < min(turn) FILTER (role = 'assistant') THEN 'parallel' ELSE 'sequential' END AS shape FROM conversations GROUP BY 1
""")
def parallel_vs_sequential(spark, sf_dir):
    return c.call_shape(table(spark, sf_dir, "conversations"), "user", "assistant")


@query("""
SELECT conv_id, count(*) AS repeats FROM (SELECT conv_id, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM (SELECT conv_id, turn, CASE WHEN turn = 1 AND conv_id % 3 = 0 THEN 'user' ELSE role END AS role FROM conversations)) WHERE role = 'user' AND p = 'user' GROUP BY 1
""")
def conversation_flow(spark, sf_dir):
    """Every third conversation has its second turn given to the user."""
    role = F.when((F.col("turn") == 1) & (F.col("conv_id") % 3 == 0), "user").otherwise(F.col("role"))
    return c.flow_errors(table(spark, sf_dir, "conversations").withColumn("role", role))


@query("SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS parent_turn FROM conversations")
def parent_links(spark, sf_dir):
    return c.linked(table(spark, sf_dir, "conversations")).select("conv_id", "turn", "parent_turn")


@query("""
SELECT conv_id, turn, coalesce(lead(role) OVER w, first_value(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_speaker FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def round_robin(spark, sf_dir):
    return c.next_speaker(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "next_speaker")


@query("SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 7 + 1 AS cohort FROM customer")
def cohorts_ordered(spark, sf_dir):
    return c.cohorts(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 7)


@query("SELECT c_custkey, ((row_number() OVER (PARTITION BY c_nationkey ORDER BY md5(c_custkey::VARCHAR), c_custkey) - 1) // 5 + 1)::BIGINT AS cohort FROM customer")
def cohorts_shuffled(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.struct(F.md5(F.col("c_custkey").cast("string")), "c_custkey").alias("o"))
    return c.cohorts(rows, "c_custkey", 5, F.col("o"), ["c_nationkey"]).select("c_custkey", "cohort")


#: DuckDB: the longest run of one word in each of two texts of ``s``, and the placeholders.
_CHECKS = r"""
WITH q AS (SELECT conv_id, max_by(text, turn) FILTER (role = 'user' AND trim(text) <> '') AS h, max_by(text, turn) FILTER (role = 'assistant' AND trim(text) <> '') AS g, count(*) AS n FROM u GROUP BY 1),
s AS (SELECT conv_id, n, trim(coalesce(h, ''), ' ' || chr(9) || chr(10)) AS hh, trim(coalesce(g, ''), ' ' || chr(9) || chr(10)) AS gg FROM q),
w AS (SELECT conv_id, side, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM (SELECT conv_id, 'h' AS side, regexp_extract_all(hh, '[^\s]+') AS l FROM s UNION ALL SELECT conv_id, 'g', regexp_extract_all(gg, '[^\s]+') FROM s)),
r AS (SELECT conv_id, side, count(*) AS n FROM (SELECT *, pos - row_number() OVER (PARTITION BY conv_id, side, word ORDER BY pos) AS d FROM w) GROUP BY conv_id, side, word, d),
m AS (SELECT conv_id, max(n) FILTER (side = 'h') AS hr, max(n) FILTER (side = 'g') AS gr FROM r GROUP BY 1)
SELECT conv_id, CASE WHEN n < 2 THEN 'too_few_turns' WHEN hh = '' THEN 'empty_human' WHEN gg = '' THEN 'empty_reply' WHEN hh = gg THEN 'identical' WHEN length(hh) < 10 THEN 'short_human' WHEN length(gg) < 10 THEN 'short_reply'
WHEN len(regexp_extract_all(hh, '[^\s]+')) < 3 THEN 'few_words_human' WHEN len(regexp_extract_all(gg, '[^\s]+')) < 3 THEN 'few_words_reply' WHEN coalesce(hr, 0) > 3 THEN 'word_run_human' WHEN coalesce(gr, 0) > 3 THEN 'word_run_reply'
WHEN regexp_matches(hh, '\[.*?\]|\{.*?\}|<.*?>|___+|\.\.\.+') OR regexp_matches(gg, '\[.*?\]|\{.*?\}|<.*?>|___+|\.\.\.+') THEN 'placeholder' WHEN length(gg) < 20 AND lower(gg) IN ('yes', 'no', 'ok', 'okay', 'good', 'bad') THEN 'generic_reply' END AS reason FROM s LEFT JOIN m USING (conv_id)
"""


@query(f"""
WITH u AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' AND conv_id % 11 = 1 THEN text || ' [name]' WHEN role = 'user' AND conv_id % 11 = 2 THEN 'go go go go ' || text WHEN role = 'user' AND conv_id % 11 = 3 THEN 'Go go GO go ' || text
WHEN role = 'assistant' AND conv_id % 11 = 4 THEN text || ' ...' WHEN role = 'assistant' AND conv_id % 11 = 5 THEN 'no no no no' WHEN role = 'assistant' AND conv_id % 11 = 6 THEN 'yes' WHEN role = 'assistant' AND conv_id % 11 = 7 THEN '' WHEN role = 'user' AND conv_id % 11 = 8 THEN 'a b' WHEN conv_id % 11 = 9 THEN 'the same text ' || conv_id ELSE text END AS text FROM conversations)
SELECT * FROM ({_CHECKS})
""")
def validate_conversation_reasons(spark, sf_dir):
    """All checks, on conversations of which many are spoilt in one way."""
    k, user = F.col("conv_id") % 11, F.col("role") == "user"
    reply = F.col("role") == "assistant"
    text = F.when(user & (k == 1), F.concat("text", F.lit(" [name]"))).when(user & (k == 2), F.concat(F.lit("go go go go "), "text")).when(user & (k == 3), F.concat(F.lit("Go go GO go "), "text"))
    text = text.when(reply & (k == 4), F.concat("text", F.lit(" ..."))).when(reply & (k == 5), "no no no no").when(reply & (k == 6), "yes").when(reply & (k == 7), "").when(user & (k == 8), "a b")
    text = text.when(k == 9, F.concat(F.lit("the same text "), F.col("conv_id").cast("string"))).otherwise(F.col("text"))
    turns = table(spark, sf_dir, "conversations").withColumn("text", text)
    packed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    conv = packed.select("conv_id", c.from_messages(F.transform("m", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("content")))).alias("conversations"))
    return c.rejection_reasons(conv).select("conv_id", "reason")


@query("""
WITH w AS (SELECT conv_id, turn, word, pos FROM (SELECT conv_id, turn, unnest(l) AS word, generate_subscripts(l, 1) AS pos FROM (SELECT conv_id, turn, regexp_extract_all(text, '[^\\s]+') AS l FROM conversations))),
i AS (SELECT *, pos - row_number() OVER (PARTITION BY conv_id, turn, word ORDER BY pos) AS g FROM w),
r AS (SELECT conv_id, turn, word, g, count(*) AS n FROM i GROUP BY ALL)
SELECT c.conv_id, c.turn, coalesce(max(n), 0)::INT AS longest_run FROM conversations c LEFT JOIN r USING (conv_id, turn) GROUP BY 1, 2
""")
def consecutive_word_runs(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", t.word_run(F.col("text")).alias("longest_run"))


# ---- text -----------------------------------------------------------------------------------------------------------

_WORDS = "SELECT doc_id, regexp_extract_all(text, '[^\\s]+') AS l FROM documents"


@query(f"""
WITH w AS ({_WORDS}), g AS (SELECT doc_id, array_to_string(l[i : i + 4], ' ') AS k FROM (SELECT doc_id, l, unnest(range(1, len(l) - 3)) AS i FROM w WHERE len(l) >= 5)),
m AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, k, count(*) AS n FROM g GROUP BY 1, 2) GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::INT AS repetition FROM documents LEFT JOIN m USING (doc_id)
""")
def ngram_repetition(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.ngram_repetition(t.words(F.col("text"))).alias("repetition"))


@query(f"""
WITH w AS (SELECT doc_id, unnest(l) AS x FROM ({_WORDS})), n AS (SELECT doc_id, x, count(*) AS n FROM w GROUP BY 1, 2), m AS (SELECT doc_id, sum(n) AS total, max(n) AS most, count(*) AS kinds FROM n GROUP BY 1)
SELECT doc_id, coalesce(total >= 10 AND (most >= 80 OR (most >= 30 AND most >= 0.6 * total) OR (total >= 100 AND kinds <= 0.15 * total)), false) AS looping FROM documents LEFT JOIN m USING (doc_id)
""")
def mono_token_loop(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.token_loop(F.col("text")).alias("looping"))


@query("""
WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS x FROM documents), n AS (SELECT doc_id, x, count(*) AS n FROM l WHERE x <> '' GROUP BY 1, 2), m AS (SELECT doc_id, max(n) AS n FROM n GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::INT AS repetition FROM documents LEFT JOIN m USING (doc_id)
""")
def repeated_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.line_repetition(F.col("text")).alias("repetition"))


@query("""
SELECT doc_id, CASE WHEN trim(right(text, 1), ' \t\n') = '' THEN 0 ELSE length(text) - length(rtrim(text, right(text, 1))) END::INT AS run FROM documents
""")
def trailing_char_run(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.trailing_run(F.col("text")).cast("int").alias("run"))


@query("""
WITH b AS (SELECT item_id, lower(trim(text, ' ' || chr(9) || chr(10))) AS x FROM benchmark WHERE trim(text) <> ''), d AS (SELECT doc_id, lower(trim(text, ' ' || chr(9) || chr(10))) AS y FROM documents WHERE trim(text) <> '')
SELECT doc_id, item_id FROM d JOIN b ON x = y OR contains(x, y) OR contains(y, x)
""")
def answer_containment(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("expected"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return matching.contained_pairs(docs, items, "doc_id", "text", "item_id", "expected")


@query("""
WITH k AS (SELECT doc_id, lower(text) AS x FROM documents), h AS (SELECT doc_id, (length(x) - length(replace(x, 'the', ''))) // 3 + (length(x) - length(replace(x, 'tion', ''))) // 4 AS b, (length(x) - length(replace(x, 'and', ''))) // 3 + (length(x) - length(replace(x, 'que', ''))) // 3 AS s FROM k)
SELECT doc_id, round(CASE WHEN b + s > 0 THEN (b - s) / (b + s) ELSE 0.0 END, 6) AS score, (b + s)::INT AS hits FROM h
""")
def sentiment_keywords(spark, sf_dir):
    score, hits = t.sentiment(F.col("text"), ["the", "tion"], ["and", "que"])
    return table(spark, sf_dir, "documents").select("doc_id", F.round(score, 6).alias("score"), hits.alias("hits"))


@query("""
SELECT source, count(*) AS n, round(avg(n_chars), 2) AS mean_chars FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0 AND n_chars >= 200 GROUP BY 1
""")
def doc_quality_filter(spark, sf_dir):
    d, labels = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), table(spark, sf_dir, "labels")
    return d.where("n_chars >= 200").join(labels.where("quality = 1 AND toxic = 0"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 2).alias("mean_chars"))


@query("SELECT doc_id, greatest(1, length(text) // 4)::BIGINT AS tokens, (length(text) > 500) AS cut, md5(left(text, 500)) AS head_md5 FROM documents")
def token_estimates(spark, sf_dir):
    cut, was = t.truncated(F.col("text"), 500, 1_000_000)
    return table(spark, sf_dir, "documents").select("doc_id", t.token_estimate(F.col("text")).alias("tokens"), was.alias("cut"), F.md5(cut).alias("head_md5"))


@query("SELECT p_partkey, regexp_replace(p_name, '\\W', '_', 'g') AS identifier, regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g') AS plain, regexp_matches(p_name, '^[A-Za-z0-9_-]{1,64}$') AS valid FROM part")
def names(spark, sf_dir):
    n = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", t.identifier(n).alias("identifier"), t.alphanumeric(n).alias("plain"), t.tool_name_valid(n).alias("valid"))


_WS = "' ' || chr(9) || chr(10) || chr(13)"
_HALF = "left(text, length(text) // 2)"
_REST = "substring(text, length(text) // 2 + 1)"


@query(f"""
WITH g AS (SELECT doc_id, trim({_HALF}, {_WS}) AS h, trim(text, {_WS}) AS x FROM documents)
SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN CASE WHEN h = '' THEN 'empty_block' END WHEN 1 THEN CASE WHEN x = '' THEN 'empty' ELSE 'no_block' END WHEN 2 THEN 'no_block' WHEN 3 THEN 'not_at_start' WHEN 4 THEN 'empty_block' WHEN 5 THEN 'several_blocks' ELSE 'no_block' END AS error,
CASE doc_id % 7 WHEN 0 THEN md5(h) WHEN 3 THEN md5(h) WHEN 4 THEN md5('') WHEN 5 THEN md5('a') END AS think_md5, doc_id % 7 IN (0, 3, 4, 5) AS has_think, doc_id % 7 IN (2) AS has_open FROM g
""")
def think_blocks(spark, sf_dir):
    """Whole texts with a block around their first half, and six ways to get it wrong."""
    k, text = F.col("doc_id") % 7, F.col("text")
    half = F.floor(F.length(text) / 2).cast("int")
    head, rest = F.left(text, half), F.substring(text, half + 1, F.length(text))
    block = F.concat(F.lit("<think>"), head, F.lit("</think>"), rest)
    tagged = F.when(k == 0, block).when(k == 1, text).when(k == 2, F.concat(F.lit("<think>"), text)).when(k == 3, F.concat(F.lit("x"), block)).when(k == 4, F.concat(F.lit("<think> \n</think>"), text)).when(k == 5, F.concat(F.lit("<think>a</think><think>b</think>"), text)).otherwise(F.concat(head, F.lit("</think>"), rest))
    c_ = F.col("tagged")
    return table(spark, sf_dir, "documents").select("doc_id", tagged.alias("tagged")).select("doc_id", t.think_error(c_).alias("error"), F.md5(t.between(c_, "think")).alias("think_md5"), t.has_block(c_, "think").alias("has_think"), (F.contains(c_, F.lit("<think>")) & ~t.has_block(c_, "think")).alias("has_open"))


@query("""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'x^{2} + ' || doc_id WHEN 4 THEN NULL ELSE doc_id::VARCHAR END AS boxed, CASE doc_id % 5 WHEN 3 THEN 2 WHEN 4 THEN 0 ELSE 1 END::INT AS boxes FROM documents
""")
def balanced_boxed(spark, sf_dir):
    """Whole texts with a box behind a label, before the text, within an unclosed one, within another, or unclosed."""
    k, n, text = F.col("doc_id") % 5, F.col("doc_id").cast("string"), F.col("text")
    tagged = F.when(k == 0, F.concat(text, F.lit(" Final answer: \\boxed{x^{2} + "), n, F.lit("}"))).when(k == 1, F.concat(F.lit("\\boxed{"), n, F.lit("} "), text)).when(k == 2, F.concat(text, F.lit(" \\boxed{a and \\boxed {"), n, F.lit("}")))
    tagged = tagged.when(k == 3, F.concat(text, F.lit(" \\boxed{n \\boxed{"), n, F.lit("}}"))).otherwise(F.concat(text, F.lit(" \\boxed{"), n))
    return table(spark, sf_dir, "documents").select("doc_id", tagged.alias("tagged")).select("doc_id", parsing.boxed_final_col(F.col("tagged")).alias("boxed"), F.size(parsing.boxed_all_col(F.col("tagged"))).alias("boxes"))


@query("""
SELECT doc_id, 'look_up' AS name, '{"id":' || doc_id || '}' AS arguments FROM documents WHERE doc_id % 5 IN (0, 3) UNION ALL SELECT doc_id, 'second', '{"a":[1,2],"b":null}' FROM documents WHERE doc_id % 5 = 3
""")
def tool_call_parse(spark, sf_dir):
    """Whole texts with a call, repeated; an unclosed one; one that is no JSON; one as a literal with another behind it; one without a name."""
    k, n, text = F.col("doc_id") % 5, F.col("doc_id").cast("string"), F.col("text")
    call = F.concat(F.lit('<tool_call>{"name": "look_up", "arguments": {"id": '), n, F.lit("}}</tool_call>"))
    half = F.floor(F.length(text) / 2).cast("int")
    tagged = F.when(k == 0, F.concat(F.left(text, half), call, F.substring(text, half + 1, F.length(text)), call)).when(k == 1, F.concat(text, F.lit('<tool_call>{"name": "look_up", "arguments": {}}'))).when(k == 2, F.concat(F.lit('<tool_call>{"name": "look_up", '), n, F.lit("</tool_call>"), text))
    tagged = tagged.when(k == 3, F.concat(F.lit("<tool_call>{'name': 'look_up', 'arguments': {'id': "), n, F.lit("}}</tool_call>"), text, F.lit('<tool_call>\n{"arguments": {"b": null, "a": [1, 2]}, "name": "second"}\n</tool_call>'))).otherwise(F.concat(text, F.lit('<tool_call>{"arguments": {}}</tool_call>')))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(parsing.tool_calls_col(tagged)).alias("c")).select("doc_id", "c.*")


@query("SELECT doc_id, (i * 850)::INT AS start_pos, least(i * 850 + 1000, length(text))::INT AS end_pos, md5(substring(text, i * 850 + 1, 1000)) AS text_md5 FROM (SELECT doc_id, text, unnest(range(greatest(1, (length(text) - 150 + 849) // 850))) AS i FROM documents WHERE text <> '')")
def page_pieces(spark, sf_dir):
    """The overlapping splitter of page search over whole documents."""
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(parsing.split_pages_col(F.col("text"))).alias("c")).select("doc_id", "c.start_pos", "c.end_pos", F.md5("c.text").alias("text_md5"))


@query()
def semantic_chunks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(parsing.semantic_chunks_col(F.col("text"))).alias("c")).select("doc_id", "c.*")


@query()
def html_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", parsing.html_page_col(F.col("html")).alias("p")).select("page_id", "p.text", F.size("p.paragraphs").alias("paragraphs"), F.size("p.tables").alias("tables"))


@query()
def fuzzy_match(spark, sf_dir):
    """Titles with a letter doubled or dropped find the part name that they come from; the test holds ratios against difflib."""
    left = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit("s"))).otherwise(F.substring("p_name", 2, 100)).alias("title"))
    right = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("first"))
    return matching.best_match(left, right, "title", "name", "first", 80)


@query()
def fuzzy_distinct(spark, sf_dir):
    return matching.greedy_distinct(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), "p_name", "p_partkey")


@query("SELECT p_partkey, (p_size * 2 + 1.5) / 3 AS value FROM part")
def calculator(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", parsing.calculate_col(F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(" * 2 + 1.5) / 3"))).alias("value"))


@query("""
WITH m AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS k FROM documents WHERE lang = 'en') SELECT doc_id, 'curriculum_' || (k - 1) AS id FROM m
""")
def positional_ids(spark, sf_dir):
    from ..sources.readers import with_position

    return with_position(table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id"), F.col("doc_id"), "curriculum_")


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'thebl') OR contains(lower(text), 'quell') ORDER BY doc_id")
def keyword_predicate(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(t.contains_any(F.col("text"), ["Thebl", "quell"])).select("doc_id")


@query("SELECT event_id, event_type, value FROM events WHERE event_type = 'error' AND user_id = 0")
def criteria_filter(spark, sf_dir):
    return x.equal_to(table(spark, sf_dir, "events"), event_type="error", user_id=0, props=None).select("event_id", "event_type", "value")
