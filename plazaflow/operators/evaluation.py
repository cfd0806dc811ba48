"""Judges, trajectories, rewards over groups, execution statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rewards

BINS = ("below -0.5", "-0.5 to 0", "0 to 0.5", "0.5 to 1", "1 and over")


def council(votes: DataFrame, items: DataFrame | None = None, key: str = "qid") -> DataFrame:
    """Tally, majority verdict (ties: correct, incorrect, unclear) and mean score of each item's valid votes; an item without any is unclear with 0."""
    score = rewards.vote(F.col("verdict"), F.col("score"))
    valid = votes.withColumn("own score", score).where(F.col("own score").isNotNull())
    tally = {v: F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in rewards.VERDICTS}
    got = valid.groupBy(key).agg(*tally.values(), F.avg("own score").alias("mean_score"), F.count(F.lit(1)).alias("votes"))
    keys = (votes if items is None else items).select(key).distinct()
    out = keys.join(got, key, "left").na.fill(0, [f"n_{v}" for v in rewards.VERDICTS] + ["votes"])
    c, i, u = (F.col(f"n_{v}") for v in rewards.VERDICTS)
    verdict = F.when(F.col("votes") == 0, "unclear").when((c >= i) & (c >= u), "correct").when(i >= u, "incorrect").otherwise("unclear")
    return out.select(key, verdict.alias("verdict"), F.bround(F.coalesce("mean_score", F.lit(0.0)), 3).alias("score"), *(f"n_{v}" for v in rewards.VERDICTS), "votes")


def reward_analysis(df: DataFrame, correct: Column, total: Column, groups: list[str] = ()) -> DataFrame:
    """Mean, upper median, min and max of rewards by outcome.

    The exact upper median is the value at rank n // 2: counts of distinct rewards are cumulated, so no group is gathered in one task.
    """
    from pyspark.sql import Window as W

    rows = df.select(*groups, rewards.outcome(correct).alias("outcome"), total.alias("reward")).where("reward IS NOT NULL")
    counts = rows.groupBy(*groups, "outcome", "reward").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy(*groups, "outcome").orderBy("reward")
    placed = counts.withColumns({"upto": F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0)), "all": F.sum("n").over(W.partitionBy(*groups, "outcome"))})
    middle = (F.col("upto") > F.floor(F.col("all") / 2)) & (F.col("upto") - F.col("n") <= F.floor(F.col("all") / 2))
    return placed.groupBy(*groups, "outcome").agg(F.sum("n").alias("n"), (F.sum(F.col("reward") * F.col("n")) / F.sum("n")).alias("mean_reward"), F.max(F.when(middle, F.col("reward"))).alias("median_reward"), F.min("reward").alias("min_reward"), F.max("reward").alias("max_reward"))


def reward_histogram(df: DataFrame, total: Column) -> DataFrame:
    """Count and percent of each bin; empty bins stay."""
    spark = df.sparkSession
    got = df.groupBy(rewards.reward_bin(total).alias("bin")).agg(F.count(F.lit(1)).alias("n")).where("bin IS NOT NULL")
    bins = spark.createDataFrame([(b,) for b in BINS], "bin string")
    whole = df.agg(F.count(total).alias("all"))
    out = bins.join(F.broadcast(got), "bin", "left").crossJoin(F.broadcast(whole))
    return out.select("bin", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("all") > 0, 100 * F.coalesce("n", F.lit(0)) / F.col("all")).otherwise(0.0).alias("percent"))


def trajectory_stats(df: DataFrame, groups: list[str] = ()) -> DataFrame:
    """Runs, success rate, mean turns and code blocks, and accuracy over validated runs only."""
    validated = F.count("answer_correct")
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg(F.col("success").cast("int")).alias("success_rate"),
        F.avg("num_turns").alias("mean_turns"),
        F.avg("num_code_blocks").alias("mean_code_blocks"),
        (F.count_if("answer_correct") / F.when(validated > 0, validated)).alias("accuracy"),
    )


def execution_stats(df: DataFrame, status: str, seconds: str, groups: list[str] = ()) -> DataFrame:
    done = F.count_if(F.col(status) == "completed")
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("total"), done.alias("completed"), F.count_if(F.col(status) == "failed").alias("failed"), F.avg(seconds).alias("mean_seconds"), (done / F.count(F.lit(1))).alias("success_rate"))


def reasons(df: DataFrame, reason: str = "reason") -> DataFrame:
    """How often each reason occurs, null ones left out."""
    return df.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def type_counts(df: DataFrame, kind: str, at: str) -> DataFrame:
    return df.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("oldest"), F.max(at).alias("newest"))


def same_keys(messages: DataFrame, name: str, payload: str) -> DataFrame:
    """Names whose JSON payloads don't all have the same key set."""
    keys = F.array_join(F.array_sort(F.json_object_keys(payload)), ",")
    return messages.groupBy(name).agg(F.count_distinct(F.coalesce(keys, F.lit(""))).alias("key_sets"), F.count(F.lit(1)).alias("n"))


def policy_decay(df: DataFrame, groups: list[str], order: str, reward: str, rate: float, speed: float) -> DataFrame:
    """The learning rate after each reward: a running product of max(0.5, 1 - speed * reward), as a sum of logarithms."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    factor = F.greatest(F.lit(0.5), 1 - speed * F.col(reward))
    return df.withColumn("learning_rate", rate * F.exp(F.sum(F.log(factor)).over(w)))


def stable_sample(df: DataFrame, key: str, k: int, seed: int = 0, groups: list[str] = ()) -> DataFrame:
    """k rows of each group without replacement, by a hash of key and seed: the same on every run."""
    from pyspark.sql import Window as W

    place = F.xxhash64(F.col(key), F.lit(seed))
    if groups:
        return df.withColumn("own place", F.row_number().over(W.partitionBy(*groups).orderBy(place, key))).where(F.col("own place") <= k).drop("own place")
    return df.orderBy(place, key).limit(k)
