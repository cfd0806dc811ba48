"""Reward, judge and streaming queries. Trajectories and votes are derived from events and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rewards as r
from ..operators import evaluation as e
from ..streaming import events as s
from .registry import query, table

_RUNS = "t AS (SELECT event_id, user_id, CASE event_type WHEN 'purchase' THEN true WHEN 'error' THEN false END AS ok, value, event_id % 7 AS code, event_id % 3 AS errs, event_id % 5 AS turns FROM events)"


def _runs(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.expr("CASE event_type WHEN 'purchase' THEN true WHEN 'error' THEN false END").alias("ok"), "value", F.expr("event_id % 7").alias("code"), F.expr("event_id % 3").alias("errs"), F.expr("event_id % 5").alias("turns"))


@query(f"WITH {_RUNS} SELECT event_id, round(CASE WHEN ok THEN 1.0 WHEN NOT ok THEN -0.5 ELSE 0.0 END + coalesce(value / 1000, 0), 6) AS reward FROM t")
def reward_simple(spark, sf_dir):
    return _runs(spark, sf_dir).select("event_id", F.round(r.simple(F.col("ok"), F.col("value") / 1000), 6).alias("reward"))


@query(f"WITH {_RUNS} SELECT event_id, round(CASE WHEN ok THEN 1 + 0.5 * greatest(0, 1 - code / 6) - 0.1 * errs ELSE -0.5 - 0.3 * code / 6 END, 6) AS reward FROM t")
def reward_efficiency(spark, sf_dir):
    return _runs(spark, sf_dir).select("event_id", F.round(r.efficiency(F.col("ok"), F.col("code"), F.col("errs"), F.lit(6)), 6).alias("reward"))


@query(f"WITH {_RUNS} SELECT event_id, round(value / greatest(turns, 1), 6) AS by_turn, round(value / greatest(code, 1), 6) AS by_code FROM t")
def reward_normalised(spark, sf_dir):
    return _runs(spark, sf_dir).select("event_id", F.round(r.normalised(F.col("value"), F.col("turns")), 6).alias("by_turn"), F.round(r.normalised(F.col("value"), F.col("code")), 6).alias("by_code"))


@query(f"""
WITH {_RUNS}, o AS (SELECT CASE WHEN ok THEN 'correct' WHEN NOT ok THEN 'incorrect' ELSE 'unknown' END AS outcome, value FROM t WHERE value IS NOT NULL)
SELECT outcome, count(*)::BIGINT AS n, round(avg(value), 4) AS mean_reward, list_sort(list(value))[count(*) // 2 + 1] AS median_reward, min(value) AS min_reward, max(value) AS max_reward FROM o GROUP BY 1
""")
def reward_analysis(spark, sf_dir):
    return e.reward_analysis(_runs(spark, sf_dir), F.col("ok"), F.col("value")).withColumn("mean_reward", F.round("mean_reward", 4))


@query("""
WITH v AS (SELECT value / 50 - 1 AS x FROM events), b AS (SELECT CASE WHEN x < -0.5 THEN 'below -0.5' WHEN x < 0 THEN '-0.5 to 0' WHEN x < 0.5 THEN '0 to 0.5' WHEN x < 1 THEN '0.5 to 1' WHEN x >= 1 THEN '1 and over' END AS bin FROM v),
n AS (SELECT unnest(['below -0.5', '-0.5 to 0', '0 to 0.5', '0.5 to 1', '1 and over']) AS bin)
SELECT bin, count(b.bin) AS n, round(100 * count(b.bin) / (SELECT count(x) FROM v), 6) AS percent FROM n LEFT JOIN b USING (bin) GROUP BY 1
""")
def reward_histogram(spark, sf_dir):
    return e.reward_histogram(table(spark, sf_dir, "events"), F.col("value") / 50 - 1).withColumn("percent", F.round("percent", 6))


@query("SELECT event_id, round(0.5 * greatest(0, least(1, coalesce(value, 0) / (1 + abs(coalesce(value, 0))))) + 0.25, 6) AS squashed FROM events")
def reward_squashed(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(r.squashed(F.col("value"), F.lit(0.5)), 6).alias("squashed"))


@query("SELECT event_id, round(0.6 * floor(coalesce(value, 0)) + 0.4 * (event_id % 10) + 0.5 * (user_id % 4), 2) AS composite FROM events")
def composite_reward(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(r.composite(F.floor(F.coalesce("value", F.lit(0.0))).cast("double"), F.expr("CAST(event_id % 10 AS DOUBLE)"), F.expr("CAST(user_id % 4 AS DOUBLE)")), 2).alias("composite"))


@query("""
SELECT event_id, round(0.5 * exp(sum(ln(greatest(0.5, 1 - 0.0001 * value))) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)), 6) AS learning_rate FROM events
""")
def policy_decay(spark, sf_dir):
    return e.policy_decay(table(spark, sf_dir, "events"), ["user_id"], "event_id", "value", 0.5, 0.0001).select("event_id", F.round("learning_rate", 6).alias("learning_rate"))


@query("""
WITH v AS (SELECT user_id AS qid, CASE event_type WHEN 'click' THEN 'correct' WHEN 'view' THEN 'incorrect' WHEN 'signup' THEN 'unclear' ELSE 'none' END AS verdict, floor(value) / 64 AS s FROM events),
a AS (SELECT qid, count(*) FILTER (verdict = 'correct') AS n_correct, count(*) FILTER (verdict = 'incorrect') AS n_incorrect, count(*) FILTER (verdict = 'unclear') AS n_unclear, count(*) AS votes, avg(greatest(0, least(1, s))) AS m FROM v WHERE verdict IN ('correct', 'incorrect', 'unclear') AND s IS NOT NULL GROUP BY 1)
SELECT qid, CASE WHEN coalesce(votes, 0) = 0 THEN 'unclear' WHEN n_correct >= n_incorrect AND n_correct >= n_unclear THEN 'correct' WHEN n_incorrect >= n_unclear THEN 'incorrect' ELSE 'unclear' END AS verdict, round(coalesce(m, 0), 3) AS score, coalesce(n_correct, 0) AS n_correct, coalesce(n_incorrect, 0) AS n_incorrect, coalesce(n_unclear, 0) AS n_unclear, coalesce(votes, 0) AS votes FROM (SELECT DISTINCT user_id AS qid FROM events) LEFT JOIN a USING (qid)
""")
def judge_council(spark, sf_dir):
    votes = table(spark, sf_dir, "events").select(F.col("user_id").alias("qid"), F.expr("CASE event_type WHEN 'click' THEN 'correct' WHEN 'view' THEN 'incorrect' WHEN 'signup' THEN 'unclear' ELSE 'none' END").alias("verdict"), F.expr("floor(value) / 64").alias("score"))
    return e.council(votes)


@query(f"WITH {_RUNS} SELECT user_id, count(*) AS runs, round(avg(CASE WHEN value > 10 THEN 1 ELSE 0 END), 6) AS success_rate, round(avg(turns), 6) AS mean_turns, round(avg(code), 6) AS mean_code_blocks, round(count(*) FILTER (ok) / nullif(count(ok), 0), 6) AS accuracy FROM t GROUP BY 1")
def trajectory_stats(spark, sf_dir):
    got = _runs(spark, sf_dir).select("user_id", F.coalesce(F.col("value") > 10, F.lit(False)).alias("success"), F.col("turns").alias("num_turns"), F.col("code").alias("num_code_blocks"), F.col("ok").alias("answer_correct"))
    return e.trajectory_stats(got, ["user_id"]).withColumns({c: F.round(c, 6) for c in ("success_rate", "mean_turns", "mean_code_blocks", "accuracy")})


@query("SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'purchase') AS completed, count(*) FILTER (event_type = 'error') AS failed, round(avg(value), 4) AS mean_seconds, round(count(*) FILTER (event_type = 'purchase') / count(*), 6) AS success_rate FROM events GROUP BY 1")
def execution_stats(spark, sf_dir):
    got = table(spark, sf_dir, "events").select("user_id", "value", F.expr("CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'open' END").alias("status"))
    return e.execution_stats(got, "status", "value", ["user_id"]).withColumns({"mean_seconds": F.round("mean_seconds", 4), "success_rate": F.round("success_rate", 6)})


@query("SELECT event_type AS reason, count(*) AS n FROM events GROUP BY 1")
def rejection_histogram(spark, sf_dir):
    return e.reasons(table(spark, sf_dir, "events"), "event_type").withColumnRenamed("event_type", "reason")


@query("SELECT event_type, count(*) AS n, min(event_id) AS oldest, max(event_id) AS newest FROM events GROUP BY 1")
def registry_status(spark, sf_dir):
    return e.type_counts(table(spark, sf_dir, "events"), "event_type", "event_id")


@query("SELECT event_type, count(DISTINCT array_to_string(list_sort(json_keys(props)), ',')) AS key_sets, count(*) AS n FROM events GROUP BY 1")
def tool_result_keys(spark, sf_dir):
    return e.same_keys(table(spark, sf_dir, "events"), "event_type", "props")


@query()
def stable_sampling(spark, sf_dir):
    return e.stable_sample(table(spark, sf_dir, "events"), "event_id", 5, 11, ["user_id"]).select("user_id", "event_id")


# ---- events by time -------------------------------------------------------------------------------------------------

_SUMS = lambda: (F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(spark, sf_dir):
    got = s.tumbling(s.timed(table(spark, sf_dir, "events")), "ts", "1 hour", ["event_type"], *_SUMS())
    return got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""
WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts) - to_hours(o) AS window_start, event_type, value FROM events, (SELECT unnest([0, 1, 2]) AS o))
SELECT window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY 1, 2
""")
def sliding_windows(spark, sf_dir):
    got = s.sliding(s.timed(table(spark, sf_dir, "events")), "ts", "3 hours", "1 hour", ["event_type"], *_SUMS())
    return got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""
WITH g AS (SELECT user_id, ts, value, CASE WHEN ts >= lag(ts) OVER w + INTERVAL '30 minutes' OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS isl FROM g)
SELECT min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, user_id, count(*) AS n, round(sum(value), 4) AS total FROM i GROUP BY user_id, isl
""")
def session_windows(spark, sf_dir):
    got = s.sessions(s.timed(table(spark, sf_dir, "events")), "ts", "30 minutes", ["user_id"], *_SUMS())
    return got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def streamed_windows(spark, sf_dir):
    """The same aggregation as a stream that runs over all that is there."""
    import uuid

    got = s.tumbling(s.timed(s.as_stream(spark, f"{sf_dir}/events.parquet*")), "ts", "1 day", ["event_type"], *_SUMS())
    return s.run_to_end(got, f"streamed_{uuid.uuid4().hex}").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query()
def book_over_rounds(spark, sf_dir):
    o = table(spark, sf_dir, "lineitem").where("l_quantity > 0").select(F.col("l_partkey").cast("string").alias("market"), F.expr("CAST(year(l_shipdate) AS BIGINT)").alias("round"), F.expr("CAST(l_orderkey * 10 + l_linenumber AS STRING)").alias("agent_id"), F.expr("CASE WHEN l_linenumber % 2 = 0 THEN 'buy' ELSE 'sell' END").alias("side"), F.expr("round(l_extendedprice / l_quantity)").alias("price"), F.expr("CAST(l_quantity AS BIGINT)").alias("quantity"))
    return s.book_rounds(o)
