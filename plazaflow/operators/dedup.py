"""First-wins dedup, anti-joins against published data, merges. A table has no order, so an ``order`` column says what comes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of_each(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key, whole. Partial aggregation sends one row a key and task, however often a key repeats; null keys are each their own."""
    packed = df.select(key.alias("own key"), F.struct(F.col(order).alias("first"), F.struct(*map(F.col, df.columns)).alias("row")).alias("x"))
    named = packed.where(F.col("own key").isNotNull()).groupBy("own key").agg(F.min_by("x.row", "x.first").alias("row")).select("row.*")
    return named.unionByName(df.where(key.isNull()))


def copies(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Each key that repeats: how often, and its first row's order value."""
    return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("first")).where("copies > 1 AND key IS NOT NULL")


def without_published(df: DataFrame, key: Column, published: DataFrame, published_key: Column, drop_empty: bool = True) -> DataFrame:
    """Rows whose key isn't published; rows with an empty or null key go too unless ``drop_empty`` is off. Spark broadcasts the key set if its size allows."""
    keys = published.select(published_key.alias("own key")).where("`own key` IS NOT NULL AND `own key` <> ''").distinct()
    rows = df.withColumn("own key", key)
    if drop_empty:
        rows = rows.where("`own key` <> ''")
    return rows.join(keys, "own key", "left_anti").drop("own key")


def new_rows(new: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``new`` with unseen keys, first of each."""
    return first_of_each(new.join(existing.select(key).distinct(), key, "left_anti"), F.col(key), order)


def merge(existing: DataFrame, new: DataFrame, key: Column, order: str) -> DataFrame:
    """Existing rows first, then new ones with unseen keys; within each, the first wins. One shuffle: the side counts before the order."""
    tagged = existing.withColumn("own side", F.lit(0)).unionByName(new.withColumn("own side", F.lit(1)))
    ordered = tagged.withColumn("own order", F.struct("own side", order))
    return first_of_each(ordered, key, "own order").drop("own side", "own order")


def latest_of_each(df: DataFrame, keys: list[str], sequence: str, tie: str) -> DataFrame:
    """The last version of each key: what inserting with overwriting leaves."""
    rest = F.struct(*map(F.col, df.columns))
    return df.groupBy(*(F.col(k).alias(f"own {k}") for k in keys)).agg(F.max_by(rest, F.struct(sequence, tie)).alias("row")).select("row.*")


def conflicts(df: DataFrame, key: Column, content: Column) -> DataFrame:
    """Keys registered with more than one content."""
    return df.groupBy(key.alias("key")).agg(F.count_distinct(F.sha2(content, 256)).alias("contents"), F.count(F.lit(1)).alias("rows_count")).where("contents > 1")


def delete_cascade(objects: DataFrame, chunks: DataFrame, ids: DataFrame, key: str = "knowledge_id") -> tuple[DataFrame, DataFrame]:
    """Both tables without the rows of the given keys."""
    return objects.join(ids, key, "left_anti"), chunks.join(ids, key, "left_anti")
