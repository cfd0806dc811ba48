"""Sinks: JSON lines, tables of the catalogue, versions, agents by partition. Writes go through Spark's commit protocol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_of_each
from . import schemas
from .stored import kept


def append_json_lines(df: DataFrame, path: str) -> None:
    """One object a line, nulls included."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV with a header; quotes in fields are doubled, and line breaks stay."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def append(df: DataFrame, name: str, database: str = "default") -> None:
    """Appends to a canonical table, creating it if needed; columns are brought into its form and meet by name (partition columns stand last in a table).

    Rows of a partition are brought together first, so that a task doesn't write a file for each partition that it has rows of.
    """
    spark = df.sparkSession
    schemas.create(spark, name, database)
    rows = schemas.conform(df, name).select(*(F.col(f"`{c}`") for c in spark.table(f"{database}.{name}").columns))
    if name in schemas.PARTITIONS:
        rows = rows.hint("rebalance", *schemas.PARTITIONS[name])
    rows.write.mode("append").insertInto(f"{database}.{name}")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], sequence: str, tie: str) -> DataFrame:
    """Existing and new rows, the latest of each key."""
    return latest_of_each(existing.unionByName(new), keys, sequence, tie)


def clear_agent(spark: SparkSession, name: str, agent_id: str, database: str = "default") -> None:
    """Takes one agent out of a memory table: its partition is dropped, or the one that it shares is written anew; the others aren't read."""
    if schemas.PARTITIONS[name] == ["agent_id"]:
        quoted = agent_id.replace("'", "''")
        spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS PARTITION (agent_id = '{quoted}')")
        return
    bucket = spark.range(1).select(F.lit(agent_id).alias("agent_id")).select(F.expr(schemas.DERIVED["agent_bucket"])).first()[0]
    rest = kept(spark.table(f"{database}.{name}").where((F.col("agent_bucket") == bucket) & ~F.col("agent_id").eqNullSafe(F.lit(agent_id))).drop("agent_bucket"))
    names = ", ".join(f"`{c}`" for c in rest.columns)
    spark.sql(f"INSERT OVERWRITE {database}.{name} PARTITION (agent_bucket = {bucket}) ({names}) SELECT {names} FROM {{rest}}", rest=rest)


def ingest_knowledge(documents: DataFrame, least: int = 200, most: int = 1000, embed=None) -> tuple[DataFrame, DataFrame]:
    """Objects and their chunks (id by content, so that ingesting again changes nothing); ``embed`` maps a text column to vectors."""
    from ..functions.parsing import semantic_chunks

    objects = documents.select(F.sha2("content", 256).alias("knowledge_id"), "content", "metadata", F.current_timestamp().alias("created_at"))
    from ..functions.parsing import CHUNKS, arrow_udf

    cut = arrow_udf(lambda t: semantic_chunks(t, least, most), CHUNKS)
    chunks = objects.select("knowledge_id", F.explode(cut(F.col("content"))).alias("c")).select("knowledge_id", "c.*")
    return objects, chunks.withColumn("embedding", embed(F.col("text")) if embed else F.lit(None).cast("array<float>"))


def request_records(responses: DataFrame) -> DataFrame:
    """Request rows for storage: those with a thread and an output, with an id by content and usage in the metadata."""
    got = responses.where("chat_thread_id IS NOT NULL AND output IS NOT NULL")
    return got.select(F.sha2(F.concat_ws("|", "chat_thread_id", "start_time", "output"), 256).alias("request_id"), "agent_id", "prompt", F.col("output").alias("response"), F.to_json(F.struct("model", "usage")).alias("metadata"), F.timestamp_seconds("end_time").alias("created_at"))


def exploded_turns(trajectories: DataFrame) -> DataFrame:
    """A row a turn, with the step reward at its place, else 0."""
    got = trajectories.select("task_id", "step_rewards", F.posexplode("turns").alias("turn", "t"))
    return got.select("task_id", "turn", "t.*", F.coalesce(F.try_element_at("step_rewards", F.col("turn") + 1), F.lit(0.0)).alias("reward"))


def traces(steps: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """Steps of each id as one ordered array."""
    return steps.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(at, *columns))).alias("steps"))


#: Fixed value: the namespace of names that are DNS names, as the standard gives it.
NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"


def stable_id(name: Column, namespace: str = NAMESPACE) -> Column:
    """The version 5 UUID of a name: the same for the same name, on any executor. A name that is such an id already stays."""
    text = name.cast("string")
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), text.cast("binary")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    made = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
    return F.when(F.regexp_like(text, F.lit("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")), text).otherwise(made)


def iso_metadata(df: DataFrame, columns: list[str]) -> Column:
    """Chosen columns as JSON, times as ISO text."""
    kinds = dict(df.dtypes)
    return F.to_json(F.struct(*(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if kinds[c].startswith("timestamp") else F.col(c) for c in columns)))
