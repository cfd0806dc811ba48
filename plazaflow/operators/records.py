"""Records with tool calls, preferences and verifiable answers; counters over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.parsing import arrow_udf, boxed_all, calls_match


def paired_responses(events: DataFrame, conv: str, order: str) -> DataFrame:
    """The k-th response of a tool's name beside the k-th call of it; a call without response stays with null."""
    w = W.partitionBy(conv, "name", "kind").orderBy(order)
    placed = events.withColumn("k", F.row_number().over(w))
    leg = lambda kind, alias: placed.where(F.col("kind") == kind).select(conv, "name", "k", F.col("payload").alias(alias))
    return leg("call", "call").join(leg("response", "response"), [conv, "name", "k"], "left")


def with_docstrings(tools: DataFrame, docs: DataFrame, order: str) -> DataFrame:
    """Descriptions replaced by the first docstring of the same name."""
    first = docs.groupBy("name").agg(F.min_by("docstring", order).alias("own doc"))
    return tools.join(first, "name", "left").withColumn("description", F.coalesce("own doc", "description")).drop("own doc")


def by_thread(results: DataFrame, threads: DataFrame, key: str = "chat_thread_id") -> DataFrame:
    """Results beside their threads; rows without an id match nothing."""
    return threads.join(results, key)


def ordered_lookup(ids: DataFrame, rows: DataFrame, key: str, order: str, kind: str | None = None) -> DataFrame:
    """Rows in the order asked for; missing ones, and ones of another kind, are left out."""
    got = ids.join(rows if kind is None else rows.where(F.col("kind") == kind), key)
    return got.orderBy(order)


def evaluated(samples: DataFrame, whole: bool = False) -> DataFrame:
    """Adds ``passed``: whether every expected call has a generated one (columns ``generated`` and ``expected`` hold parsed calls)."""
    agree = arrow_udf(lambda g, e: calls_match(list(g), list(e), whole), "boolean", 2)
    return samples.withColumn("passed", agree(F.col("generated"), F.col("expected")))


def preference_pairs(samples: DataFrame) -> DataFrame:
    """Failed samples as (system, question, chosen, rejected)."""
    return samples.where(~F.col("passed")).select("system", "question", F.col("expected_text").alias("chosen"), F.col("generated_text").alias("rejected"))


def pass_rate(samples: DataFrame) -> DataFrame:
    return samples.agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("passed"), F.avg(F.col("passed").cast("int")).alias("pass_rate"))


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with how often each condition holds, and the share of the first."""
    names = list(conditions)
    return df.agg(F.count(F.lit(1)).alias("processed"), *(F.count_if(c).alias(n) for n, c in conditions.items()), F.avg(F.coalesce(conditions[names[0]], F.lit(False)).cast("int")).alias("success_rate"))


def mean_of_present(*scores: Column) -> Column:
    """The mean of the scores that are there."""
    there = F.filter(F.array(*scores), lambda x: x.isNotNull())
    return F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda s, x: s + x) / F.size(there))


def score_of_text(c: Column) -> Column:
    """The ``x/10`` of a text."""
    return F.regexp_extract(c, r"(\d+(?:\.\d+)?)\s*/\s*10", 1).try_cast("double")


def verifiable_turns(df: DataFrame, conversation: str = "conversations") -> DataFrame:
    """A row for each reply with a boxed answer: its question, the reply, the boxes, the canonical one."""
    from .conversations import replies

    boxes = arrow_udf(boxed_all, "array<string>")
    got = replies(df, conversation).withColumn("boxed_answers", boxes(F.col("reply"))).where(F.size("boxed_answers") > 0)
    question = F.try_element_at(F.filter("history", lambda x: x["from"] == "human"), F.lit(-1))["value"]
    return got.withColumns({"question": question, "boxed": canonical_boxed(F.col("boxed_answers"))}).drop("history")


def canonical_boxed(boxes: Column) -> Column:
    """The first box with a fraction, else the first; fractions as a/b."""
    plain = F.transform(boxes, t.tex_fraction)
    return F.coalesce(F.try_element_at(F.filter(plain, lambda b: F.contains(b, F.lit("/"))), F.lit(1)), F.try_element_at(plain, F.lit(1)))


def judge_units(df: DataFrame) -> DataFrame:
    """Rows with question, answer and boxed answer."""
    full = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return df.where(full("question") & full("answer") & full("boxed"))


def recomputed_rewards(df: DataFrame) -> DataFrame:
    """Steps with the final reward behind, and the total of the former steps and the final one."""
    from ..functions.rewards import appended

    total = F.aggregate("step_rewards", F.lit(0.0), lambda s, x: s + x) + F.col("final_reward")
    return df.withColumns({"total_reward": total, "step_rewards": appended(F.col("step_rewards"), F.col("final_reward"))})


def trajectory_rows(runs: DataFrame) -> DataFrame:
    """Trace rows from finished runs: boxed answers, correctness against the expected answer, counts."""
    boxes = arrow_udf(boxed_all, "array<string>")
    got = runs.withColumn("boxed_answers", boxes(F.coalesce("final_answer", F.lit(""))))
    answer = F.coalesce(F.try_element_at("boxed_answers", F.lit(-1)), F.col("final_answer"))
    return got.withColumns({"answer_correct": t.answers_agree(F.col("expected"), answer), "num_turns": F.size("turns"), "num_code_blocks": F.size(F.filter("turns", lambda x: F.coalesce(x["code"], F.lit("")) != ""))})


def cleaned(df: DataFrame, conversation: str = "conversations") -> DataFrame:
    """Conversations cleaned and valid, one of each kind.

    Roles other than human and gpt go by place. Questions lose code fences, a JSON wrapper, numbering and quotes; replies get their opening
    think tag. A degenerate or looping reply, or one with a long trailing run, goes with its question. A pair that repeats in the conversation
    counts once. What is left must have two turns with a text in each.
    """
    from .conversations import conversation_key, pairs_only

    role = lambda x, i: F.when(x["from"].isin("human", "gpt"), x["from"]).otherwise(F.when(i % 2 == 0, "human").otherwise("gpt"))
    got = df.withColumn(conversation, F.transform(F.col(conversation), lambda x, i: F.struct(role(x, i).alias("from"), F.coalesce(x["value"], F.lit("")).alias("value"))))
    # a wrapper is a JSON object, so only turns that hold a brace go through Python
    got = got.withColumn("own asked", F.transform(conversation, lambda x: F.when(x["from"] == "human", t.strip_fences(x["value"]))))
    got = got.withColumn("own asked", F.when(F.exists("own asked", lambda x: F.contains(x, F.lit("{"))), unwrapped_col(F.col("own asked"))).otherwise(F.col("own asked")))
    asked = lambda x: t.strip_quotes(t.strip_numbering(x))
    said = F.zip_with(conversation, "own asked", lambda x, q: F.struct(x["from"].alias("from"), F.when(x["from"] == "human", asked(q)).otherwise(t.with_opening_think(x["value"])).alias("value")))
    good = F.filter(said, lambda x: (x["from"] != "gpt") | ~(t.degenerate(x["value"]) | t.token_loop(x["value"]) | (t.trailing_run(x["value"]) >= 40)))
    got = got.withColumn(conversation, pairs_only(good)).drop("own asked")
    # pairs_only leaves question and reply in turn
    pairs = F.transform(F.sequence(F.lit(1), F.size(conversation) - 1, F.lit(2)), lambda i: F.struct(F.element_at(conversation, i).alias("q"), F.element_at(conversation, i + 1).alias("a")))
    got = got.where(F.size(conversation) >= 2).withColumn(conversation, F.flatten(F.transform(F.array_distinct(pairs), lambda x: F.array(x["q"], x["a"]))))
    return got.where(F.forall(conversation, lambda x: t.strip(x["value"]) != "")).withColumn("conversation_key", conversation_key(F.col(conversation)))


def unwrapped_col(c: Column) -> Column:
    """Each text of an array, or the question of the JSON object that it is."""
    from ..functions.replies import question_of

    return arrow_udf(lambda xs: [None if x is None else question_of(x) or x for x in xs], "array<string>")(c)


def board_insert(posts: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """The posts and the new ones behind them: ids go on from the number of posts, in the order given."""
    from .conversations import numbered

    ids = numbered(new.drop("id"), F.col(order), "own place").withColumn("id", (F.lit(posts.count()) + F.col("own place")).cast(posts.schema["id"].dataType)).drop("own place")
    return posts.unionByName(ids.select(posts.columns))


def merged_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Conversations of several sources with their source's name."""
    out = None
    for name, df in sources.items():
        got = df.select("id", "conversations").withColumn("source", F.lit(name))
        out = got if out is None else out.unionByName(got)
    return out


def packed_documents(df: DataFrame, groups: list[str], order: str, text: str, most_chars: int) -> DataFrame:
    """Documents of each group joined while they fit; the first that doesn't ends the pack. ``order`` tells documents apart; only lengths are sorted, and texts meet the few that are kept."""
    from .explore import budget_prefix

    kept = budget_prefix(df.select(*groups, order, F.length(text).alias("own size")), groups, order, F.col("own size"), most_chars).select(*groups, order)
    kept = df.select(*groups, order, text).join(kept, [*groups, order], "left_semi")
    return kept.groupBy(*groups).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n\n").alias("packed"), F.count(F.lit(1)).alias("documents"))


def content_type(html: Column) -> Column:
    table, chart = F.contains(html, F.lit("<table")), F.regexp_like(html, F.lit("(?i)<(?:canvas|svg|figure)|class=\"[^\"]*chart"))
    return F.when(table & chart, "mixed").when(table, "table").when(chart, "chart").otherwise("text")


def level_label(turn: Column) -> Column:
    """b, c, d, ... by turn, z at most."""
    return F.char(F.least(F.lit(98) + turn, F.lit(122)))


def target_level(profile: Column, turn: Column) -> Column:
    """The level at a turn; the last one repeats, ``application`` without any."""
    return F.coalesce(F.try_element_at(profile, F.least(turn + 1, F.greatest(F.size(profile), F.lit(1))).cast("int")), F.lit("application"))


def sequential_tools(turns: DataFrame, conv: str, order: str) -> DataFrame:
    """Whether between calling turns of a conversation only tool turns stand, and a response follows the last call."""
    calling = (F.col("role") == "assistant") & F.contains("text", F.lit("<tool_call>"))
    w = W.partitionBy(conv).orderBy(order)
    got = turns.withColumns({"own call": calling, "own before": F.count_if(calling).over(w.rowsBetween(W.unboundedPreceding, 0)), "own all": F.count_if(calling).over(W.partitionBy(conv))})
    between = (F.col("own before") > 0) & (F.col("own before") < F.col("own all")) & ~F.col("own call")
    after = (F.col("own before") == F.col("own all")) & ~F.col("own call") & (F.col("role") == "tool")
    return got.groupBy(conv).agg((F.count_if(between & (F.col("role") != "tool")) == 0).alias("a"), (F.count_if(after) > 0).alias("b"), (F.max("own all") > 1).alias("c")).select(conv, (F.col("a") & F.col("b") & F.col("c")).alias("sequential"))


def vote(posts: DataFrame, votes: DataFrame) -> DataFrame:
    """Posts with the karma of all votes (+1, -1) added."""
    return posts.join(votes.groupBy("id").agg(F.sum("delta").alias("own delta")), "id", "left").withColumn("karma", F.col("karma") + F.coalesce("own delta", F.lit(0)).cast("int")).drop("own delta")


def distinct_phrases(phrases: Column) -> Column:
    """Trimmed, in order, each once, empty ones gone."""
    return F.array_distinct(F.filter(F.transform(phrases, lambda p: F.trim(p)), lambda p: p != ""))
