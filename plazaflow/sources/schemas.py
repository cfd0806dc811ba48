"""Canonical schemas of the stored tables, as DDL; constraints are validation queries (see ``violations``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TURN = "array<struct<`from`:string,value:string>>"
TABLES = {
    "cognitive_memory": "memory_id string, agent_id string, cognitive_step string, content string, embedding array<float>, created_at timestamp, metadata string",
    "episodic_memory": "memory_id string, agent_id string, task_query string, cognitive_steps string, total_reward double, strategy_update array<string>, embedding array<float>, created_at timestamp, metadata string, agent_bucket int",
    "knowledge_objects": "knowledge_id string, content string, metadata string, created_at timestamp",
    "knowledge_chunks": "knowledge_id string, text string, start_pos int, end_pos int, embedding array<float>",
    "agents": "id string, role string, persona string, is_llm boolean, max_iter int, llm_config string",
    "actions": "agent_id string, environment_name string, round int, sub_round int, action string, metadata string",
    "environment_states": "environment_name string, round int, state_data string, metadata string",
    "allocations": "agent_id string, goods decimal(15,2), cash decimal(15,2), locked_goods decimal(15,2), locked_cash decimal(15,2)",
    "schedules": "agent_id string, is_buyer boolean, `values` string, initial_endowment string",
    "orders": "order_id string, market string, round int, arrival long, agent_id string, side string, price decimal(15,2), quantity long",
    "trades": "market string, round int, trade_id long, buyer_id string, seller_id string, price decimal(15,2), quantity long",
    "auctions": "auction_id string, max_rounds int, current_round int, total_surplus_extracted double, average_price double",
    "portfolios": "agent_id string, token string, qty double",
    "balances": "agent_id string, cash double, tokens double",
    "prices": "token string, round int, price double",
    "requests": "chat_thread_id string, start_time double, end_time double, total_time double, model string, max_tokens int, temperature double, messages string, system string, tools string, prompt_tokens long, completion_tokens long, total_tokens long",
    "ai_requests": "request_id string, agent_id string, prompt string, response string, metadata string, created_at timestamp",
    "conversations": f"id string, conversations {_TURN}, source string, category string, task string, tools string",
    "trajectories": "task_id string, env_name string, success boolean, final_answer string, boxed_answers array<string>, answer_correct boolean, num_turns int, num_code_blocks int, num_errors int, step_rewards array<double>, total_reward double, reward_metadata string, turns array<struct<role:string,content:string,code:string>>",
    "judged_items": "qid string, boxed string, judges array<struct<model:string,verdict:string,score:double,reason:string>>, verdict string, score double",
    "posts": "id long, title string, content string, user_id string, karma int, categories array<string>, post_type string, created_at timestamp",
    "tasks": "id string, description string, category string, subcategory string, expected string, metadata map<string,string>",
}
KEYS = {"knowledge_objects": ["knowledge_id"], "agents": ["id"], "orders": ["order_id"], "auctions": ["auction_id"], "ai_requests": ["request_id"], "cognitive_memory": ["memory_id"], "episodic_memory": ["memory_id"], "tasks": ["id"]}
#: Tables that are laid out by a column, and ones that are bucketed by their join key.
PARTITIONS = {"cognitive_memory": ["agent_id"], "episodic_memory": ["agent_bucket"]}
#: Columns that follow from others. Episodes lie in so many folders however many agents there are.
DERIVED = {"agent_bucket": "CAST(pmod(xxhash64(agent_id), 64) AS INT)"}
BUCKETS = {"knowledge_objects": "knowledge_id", "knowledge_chunks": "knowledge_id"}
CHECKS = {"orders": "side IN ('buy', 'sell', 'hold') AND (side = 'hold' OR (price > 0 AND quantity > 0))", "trades": "quantity > 0 AND price >= 0", "judged_items": "score BETWEEN 0 AND 1"}
PARENTS = {"knowledge_chunks": ("knowledge_id", "knowledge_objects", "knowledge_id"), "actions": ("agent_id", "agents", "id")}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def create(spark: SparkSession, name: str, database: str = "default", buckets: int = 64) -> None:
    """The table in the catalogue if it isn't there yet: partitioned or bucketed as above."""
    layout = f" PARTITIONED BY ({', '.join(PARTITIONS[name])})" if name in PARTITIONS else f" CLUSTERED BY ({BUCKETS[name]}) INTO {buckets} BUCKETS" if name in BUCKETS else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({TABLES[name]}) USING parquet{layout}")


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's columns in order and type; missing ones are null, derived ones are computed, others go."""
    have, own = {c.lower() for c in df.columns}, schema(name)
    got = df.select(*((F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in own if f.name not in DERIVED))
    return got.withColumns({c: F.expr(e) for c, e in DERIVED.items() if c in own.names}).select(*own.names)


def violations(df: DataFrame, name: str, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """(rule, n): rows that break the key, the checks, or a parent link; rules without a breach are left out."""
    found = []
    if name in KEYS:
        twice = df.groupBy(*KEYS[name]).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        found.append(twice.select(F.lit("unique key").alias("rule"), "n"))
    if name in CHECKS:
        found.append(df.agg(F.count_if(~F.coalesce(F.expr(CHECKS[name]), F.lit(True))).alias("n")).select(F.lit("check").alias("rule"), "n"))
    if name in PARENTS and parents and PARENTS[name][1] in parents:
        own, parent, key = PARENTS[name]
        orphans = df.where(F.col(own).isNotNull()).join(parents[parent].select(F.col(key).alias(own)).distinct(), own, "left_anti")
        found.append(orphans.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"parent in {parent}").alias("rule"), "n"))
    out = df.sparkSession.createDataFrame([], "rule string, n long")
    for f in found:
        out = out.unionByName(f)
    return out.where("n > 0")
