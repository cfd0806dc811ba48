"""Conversations, in two shapes: one row a turn (conv_id, turn, role, text), or one row a conversation with an array of turns.

Row-shaped operators are windows partitioned by conversation; array-shaped ones are higher-order functions and never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Role names of the two common forms.
ROLES = {"user": "human", "assistant": "gpt", "system": "system", "tool": "tool", "human": "human", "gpt": "gpt", "function": "tool"}


def _conv(conv: str = "conv_id", turn: str = "turn"):
    return W.partitionBy(conv).orderBy(turn)


# ---- one row a turn -------------------------------------------------------------------------------------------------


def answered_pairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", asker: str = "user", answerer: str = "assistant") -> DataFrame:
    """Questions directly followed by a reply that isn't blank, as one row each; other turns go."""
    w = _conv(conv, turn)
    nxt = turns.where(F.col("role").isin(asker, answerer)).withColumns({"next role": F.lead("role").over(w), "reply": F.lead("text").over(w)})
    return nxt.where((F.col("role") == asker) & (F.col("next role") == answerer) & (F.trim("reply") != "")).select(conv, turn, F.col("text").alias("question"), "reply")


def merged_turns(turns: DataFrame, roles: list[str], conv: str = "conv_id", turn: str = "turn", joiner: str = "\n\n") -> DataFrame:
    """Adjacent turns of one of ``roles`` become one; the first one's place stays."""
    w = _conv(conv, turn)
    starts = F.when((F.col("role") == F.lag("role").over(w)) & F.col("role").isin(*roles), 0).otherwise(1)
    island = turns.withColumn("own start", starts).withColumn("own island", F.sum("own start").over(w.rowsBetween(W.unboundedPreceding, 0)))
    packed = island.groupBy(conv, "own island").agg(F.min(turn).alias(turn), F.first("role").alias("role"), F.sort_array(F.collect_list(F.struct(turn, "text"))).alias("parts"))
    return packed.select(conv, turn, "role", F.array_join(F.transform("parts", lambda p: p["text"]), joiner).alias("text"), F.size("parts").alias("merged"))


def preceding_question(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", asker: str = "user", answerer: str = "assistant") -> DataFrame:
    """Each reply with the last question before it that isn't blank."""
    asked = F.when((F.col("role") == asker) & (F.trim("text") != ""), F.col("text"))
    got = turns.withColumn("question", F.last(asked, ignorenulls=True).over(_conv(conv, turn).rowsBetween(W.unboundedPreceding, -1)))
    return got.where(F.col("role") == answerer).select(conv, turn, "question", F.col("text").alias("reply"))


def with_system(turns: DataFrame, prompt: str, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """A system turn, one before the first, for conversations that have none."""
    lacking = turns.groupBy(conv).agg(F.max((F.col("role") == "system").cast("int")).alias("has"), F.min(turn).alias("first")).where("has = 0")
    return turns.select(conv, turn, "role", "text").unionByName(lacking.select(conv, (F.col("first") - 1).alias(turn), F.lit("system").alias("role"), F.lit(prompt).alias("text")))


def prefixes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", answerer: str = "assistant") -> DataFrame:
    """A row for each reply: the turns before it as an array, and the last system prompt so far."""
    w = _conv(conv, turn).rowsBetween(W.unboundedPreceding, -1)
    got = turns.withColumns({"history": F.collect_list(F.struct(turn, "role", "text")).over(w), "system_prompt": F.last(F.when(F.col("role") == "system", F.col("text")), ignorenulls=True).over(w)})
    return got.where(F.col("role") == answerer).select(conv, turn, F.col("text").alias("reply"), "history", "system_prompt")


def call_shape(turns: DataFrame, call: str, response: str, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Each conversation's calls as none, single, parallel (all before the first response) or sequential."""
    n = F.count_if(F.col("role") == call)
    last_call = F.max(F.when(F.col("role") == call, F.col(turn)))
    first_response = F.min(F.when(F.col("role") == response, F.col(turn)))
    got = turns.groupBy(conv).agg(n.alias("calls"), last_call.alias("last_call"), first_response.alias("first_response"))
    shape = F.when(F.col("calls") == 0, "none").when(F.col("calls") == 1, "single").when(F.col("last_call") < F.col("first_response"), "parallel").otherwise("sequential")
    return got.select(conv, "calls", shape.alias("shape"))


def flow_errors(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", asker: str = "user") -> DataFrame:
    """Conversations with two questions in a row, and how often."""
    twice = (F.col("role") == asker) & (F.lag("role").over(_conv(conv, turn)) == asker)
    return turns.withColumn("own twice", twice).groupBy(conv).agg(F.count_if("own twice").alias("repeats")).where("repeats > 0")


def linked(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Each turn with its parent, the one before it."""
    return turns.withColumn("parent_turn", F.lag(turn).over(_conv(conv, turn)))


def distinct_pairs(pairs: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each (question, reply)."""
    first = F.struct(*order)
    return pairs.groupBy("question", "reply").agg(F.min_by(F.struct(*map(F.col, pairs.columns)), first).alias("row")).select("row.*")


def next_speaker(members: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Round robin: who follows each member; the first follows the last."""
    w = W.partitionBy(group).orderBy(order)
    first = F.first(name).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return members.withColumn("next_speaker", F.coalesce(F.lead(name).over(w), first))


def cohorts(df: DataFrame, key: str, size: int, order: Column | None = None, groups: list[str] = ()) -> DataFrame:
    """Consecutive blocks of ``size`` by order, numbered from 1; the last may be short.

    Without groups a global order is needed: rows are range-partitioned and counted by partition first, so no task holds them all.
    """
    if groups:
        place = F.row_number().over(W.partitionBy(*groups).orderBy(F.col(key) if order is None else order))
        return df.withColumn("cohort", (F.floor((place - 1) / size) + 1).cast("long"))
    return numbered(df, order if order is not None else F.col(key), "own place").withColumn("cohort", (F.floor((F.col("own place") - 1) / size) + 1).cast("long")).drop("own place")


def numbered(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Adds the 1-based place in a global order: a range shuffle, then each range adds the sizes of those before it.

    The ranges come from a sample, and another run over the same rows may cut them elsewhere; so the sorted ranges are written once, and
    their sizes and places are read from there. The sizes are one number a range (a small table by construction, as many rows as shuffle partitions).
    """
    from ..sources.stored import kept

    # the number of a row within its partition in 33 bits, the partition above
    ranged = kept(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("own at", F.monotonically_increasing_id()))
    part, place = F.shiftright("own at", 33), F.col("own at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("own range")).agg(F.count(F.lit(1)).alias("own n"))
    before = sizes.withColumn("own before", F.coalesce(F.sum("own n").over(W.orderBy("own range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("own n")
    return ranged.join(F.broadcast(before), part == F.col("own range")).withColumn(name, place + 1 + F.col("own before")).drop("own range", "own before", "own at")


# ---- one row a conversation -----------------------------------------------------------------------------------------


def role_name(c: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in ROLES.items():
        out = F.when(F.lower(c) == k, v).otherwise(out)
    return F.coalesce(out, c)


def turn_array(*pairs: tuple[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(r).alias("from"), v.alias("value")) for r, v in pairs))


def from_question_answer(question: Column, answer: Column, context: Column | None = None) -> Column:
    """A conversation of two turns, null if either is empty; the context stands before the question."""
    asked = question if context is None else F.when(F.coalesce(F.trim(context), F.lit("")) == "", question).otherwise(F.concat_ws("\n\n", context, question))
    return F.when((F.coalesce(F.trim(question), F.lit("")) != "") & (F.coalesce(F.trim(answer), F.lit("")) != ""), turn_array(("human", asked), ("gpt", answer)))


def from_messages(messages: Column) -> Column:
    """role/content messages as from/value turns."""
    return F.transform(messages, lambda m: F.struct(role_name(m["role"]).alias("from"), m["content"].alias("value")))


def to_messages(conversation: Column) -> Column:
    back = lambda r: F.when(r == "human", "user").when(r == "gpt", "assistant").otherwise(r)
    return F.transform(conversation, lambda t: F.struct(back(t["from"]).alias("role"), t["value"].alias("content")))


def system_first(conversation: Column, prompt: Column) -> Column:
    """Puts a system turn first where there is none."""
    return F.when(F.exists(conversation, lambda t: t["from"] == "system"), conversation).otherwise(F.concat(F.array(F.struct(F.lit("system").alias("from"), prompt.alias("value"))), conversation))


def last_of(conversation: Column, role: str) -> Column:
    """The last turn of a role that isn't blank."""
    return F.try_element_at(F.filter(conversation, lambda t: (t["from"] == role) & (F.trim(t["value"]) != "")), F.lit(-1))["value"]


def first_of(conversation: Column, role: str) -> Column:
    return F.try_element_at(F.filter(conversation, lambda t: (t["from"] == role) & (F.trim(t["value"]) != "")), F.lit(1))["value"]


def pairs_only(conversation: Column) -> Column:
    """Questions directly followed by a reply that isn't blank, with it; system turns stay."""
    from ..functions.text import let

    def kept(c):
        at = lambda i: F.try_element_at(c, i)
        answered = lambda i: F.coalesce((at(i + 2)["from"] == "gpt") & (F.trim(at(i + 2)["value"]) != ""), F.lit(False))
        asked = lambda i: (i > 0) & F.coalesce(at(F.greatest(i, F.lit(1)))["from"] == "human", F.lit(False))
        keep = lambda t, i: (t["from"] == "system") | ((t["from"] == "human") & answered(i)) | ((t["from"] == "gpt") & (F.trim(t["value"]) != "") & asked(i))
        return F.filter(c, keep)

    return let(conversation, kept)


def drop_seed(conversation: Column, flagged: Column) -> Column:
    """Without the first two turns where flagged, unless nothing would be left."""
    return F.when(flagged & (F.size(conversation) > 2), F.slice(conversation, F.lit(3), F.greatest(F.size(conversation) - 2, F.lit(0)))).otherwise(conversation)


def chat_text(conversation: Column) -> Column:
    """Turns between start and end marks, one after the other."""
    return F.array_join(F.transform(to_messages(conversation), lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>"))), "\n")


def conversation_key(conversation: Column, whole: bool = True) -> Column:
    """MD5 of the turns as JSON, or of the first question."""
    return F.md5(F.to_json(conversation)) if whole else F.md5(F.coalesce(first_of(conversation, "human"), F.lit("")))


def scenario(conversation: Column) -> Column:
    """relevance (no call), single, multiturn (questions between calls), or multistep."""
    calls = F.filter(conversation, lambda t: (t["from"] == "gpt") & F.contains(t["value"], F.lit("<tool_call>")))
    asked = F.filter(conversation, lambda t: t["from"] == "human")
    return F.when(F.size(calls) == 0, "relevance").when(F.size(calls) == 1, "single").when(F.size(asked) > 1, "multiturn").otherwise("multistep")


def masked_weights(conversation: Column) -> Column:
    """Loss weight of each turn: 1 for replies, 0 for all else."""
    return F.transform(conversation, lambda t: F.when(t["from"] == "gpt", 1).otherwise(0))


def replies(df: DataFrame, conversation: str = "conversations") -> DataFrame:
    """A row for each reply: the turns before it, and the system prompt; no shuffle."""
    rows = df.select("*", F.posexplode(conversation).alias("own i", "own turn")).where("`own turn`.from = 'gpt'")
    before = F.slice(F.col(conversation), F.lit(1), F.col("own i"))
    return rows.select(*(c for c in df.columns if c != conversation), F.col("own i").alias("position"), before.alias("history"), F.col("own turn.value").alias("reply"), last_of(before, "system").alias("system_prompt"))


def rejection_reasons(df: DataFrame, conversation: str = "conversations", strict: bool = True) -> DataFrame:
    """Adds ``reason``: the first check that the last question and the last reply fail, null for a valid conversation."""
    from ..functions.text import pair_error

    c = F.col(conversation)
    error = F.when(F.coalesce(F.size(c), F.lit(0)) < 2, "too_few_turns").otherwise(pair_error(last_of(c, "human"), last_of(c, "gpt"), strict=strict))
    return df.withColumn("reason", error)


def with_reasoning(conversation: Column, before: Column, after: Column) -> Column:
    """Reasoning turns put around tool calls: one before each calling reply, one behind each tool response."""
    turn = lambda v: F.struct(F.lit("reasoning").alias("from"), v.alias("value"))
    around = lambda t: (
        F.when((t["from"] == "gpt") & F.contains(t["value"], F.lit("<tool_call>")), F.array(turn(before), t)).when(t["from"] == "tool", F.array(t, turn(after))).otherwise(F.array(t))
    )
    return F.flatten(F.transform(conversation, around))
