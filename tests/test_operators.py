"""Relational operators against small brute-force versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plazaflow.operators import conversations as c
from plazaflow.operators import dedup, evaluation, explore, market, matching, vectors
from plazaflow.streaming import events


def book(seed, n=60):
    rng = random.Random(seed)
    return [(m, f"a{i}", rng.choice(["buy", "sell", "hold"]), float(rng.randint(1, 12)), rng.randint(1, 200)) for m in range(3) for i in range(n)]


def greedy(rows):
    out = []
    for m in {r[0] for r in rows}:
        bids = sorted(([-p, a, q] for k, a, s, p, q in rows if k == m and s == "buy"))
        asks = sorted(([p, a, q] for k, a, s, p, q in rows if k == m and s == "sell"))
        while bids and asks and -bids[0][0] >= asks[0][0]:
            q = min(bids[0][2], asks[0][2])
            out.append((m, bids[0][1], asks[0][1], q, (-bids[0][0] + asks[0][0]) / 2))
            for side in (bids, asks):
                side[0][2] -= q
                if not side[0][2]:
                    side.pop(0)
    return sorted(out)


@pytest.mark.parametrize("n", [1, 64, 300])
def test_quantity_matching_equals_the_greedy_book(spark, n):
    rows = book(n)
    df = spark.createDataFrame(rows, "market int, agent_id string, side string, price double, quantity long")
    orders = market.valid_orders(df)
    trades = market.match_quantities(orders, ["market"])
    assert sorted(tuple(r)[:5] for r in trades.collect()) == greedy(rows)
    left = market.residual_orders(orders, trades, ["market"]).agg(F.sum("quantity")).first()[0]
    assert left + 2 * sum(t[3] for t in greedy(rows)) == sum(r[4] for r in rows if r[2] != "hold")
    numbered = market.number_trades(trades, ["market"])
    assert numbered.groupBy("market").agg((F.max("trade_id") == F.count(F.lit(1))).alias("ok")).where("NOT ok").count() == 0


def test_matching_of_fractions_and_huge_quantities(spark):
    schema = "market int, agent_id string, side string, price double, quantity double"
    rows = [(1, "b1", "buy", 5.0, 63.5), (1, "b2", "buy", 4.0, 1.0), (1, "s1", "sell", 3.0, 64.2), (1, "s2", "sell", 3.5, 0.3), (2, "b", "buy", 2.0, 1e15), (2, "s", "sell", 1.0, 1e15 + 2)]
    got = {(r.buyer_id, r.seller_id): r.quantity for r in market.match_quantities(spark.createDataFrame(rows, schema), ["market"]).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {("b1", "s1"): 63.5, ("b2", "s1"): 0.7, ("b2", "s2"): 0.3, ("b", "s"): 1e15}
    # eighths are exact in doubles, so the greedy book gives the same trades
    rng = random.Random(9)
    rows = [(m, f"a{i}", rng.choice(["buy", "sell"]), float(rng.randint(1, 12)), rng.randint(1, 999) / 8) for m in range(4) for i in range(80)]
    got = market.match_quantities(spark.createDataFrame(rows, schema), ["market"]).collect()
    assert sorted(tuple(r)[:5] for r in got) == greedy(rows)
    whole = [(1, "b", "buy", 2.0, 10**15), (1, "s", "sell", 1.0, 10**15)]
    assert market.match_quantities(spark.createDataFrame(whole, schema.replace("quantity double", "quantity long")), ["market"]).first().quantity == 10**15


def test_contained_pairs_match_all_pairs(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("ab ", k=rng.randint(0, 8)))) for i in range(60)] + [(97, None), (98, " AbA "), (99, "x\0y")]
    items = [(i, "".join(rng.choices("AB ", k=rng.randint(0, 5)))) for i in range(40)] + [(97, None), (98, "aba"), (99, "aba")]
    plain = lambda t: (t or "").strip().lower()
    want = sorted((i, j) for i, a in rows for j, b in items if plain(a) and plain(b) and (plain(a) in plain(b) or plain(b) in plain(a)))
    for block in (20_000, 7):
        monkeypatch.setattr(matching, "BLOCK", block)
        got = matching.contained_pairs(spark.createDataFrame(rows, "doc long, text string"), spark.createDataFrame(items, "item long, expected string"), "doc", "text", "item", "expected")
        assert sorted(tuple(r) for r in got.collect()) == want
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_book_over_rounds_carries_orders(spark):
    rows = [("m", 1, "b1", "buy", 5.0, 3), ("m", 2, "s1", "sell", 4.0, 5), ("m", 3, "b2", "buy", 4.0, 2), ("m", 3, "h", "hold", 0.0, 0)]
    df = spark.createDataFrame(rows, "market string, round long, agent_id string, side string, price double, quantity long")
    assert sorted(tuple(r) for r in events.book_rounds(df).collect()) == [("m", 2, "b1", "s1", 4.5, 3), ("m", 3, "b2", "s1", 4.0, 2)]


def test_book_over_rounds_streams_many_markets(spark):
    rng = random.Random(4)
    rows = [(f"m{m}", r, f"a{i}", rng.choice(["buy", "sell", "hold"]), float(rng.randint(1, 9)), rng.randint(1, 20)) for m in range(300) for r in (1, 2, 3) for i in range(r, 12, 3)]
    odd = [("m0", 1, "z", "buy", None, 5), ("m0", 1, "z", "buy", float("nan"), 5), ("m0", 1, "z", "buy", 99.0, 0), ("m0", 1, "z", "buy", 99.0, None), ("m0", None, "z", "buy", 99.0, 5)]
    want = []
    for m in {r[0] for r in rows}:
        bids, asks = [], []
        for r in (1, 2, 3):
            own = [x for x in rows if x[:2] == (m, r)]
            bids = sorted(bids + [[-x[4], x[2], x[5]] for x in own if x[3] == "buy"])
            asks = sorted(asks + [[x[4], x[2], x[5]] for x in own if x[3] == "sell"])
            while bids and asks and -bids[0][0] >= asks[0][0]:
                n = min(bids[0][2], asks[0][2])
                want.append((m, r, bids[0][1], asks[0][1], (asks[0][0] - bids[0][0]) / 2, n))
                for side in (bids, asks):
                    side[0][2] -= n
                    if not side[0][2]:
                        side.pop(0)
    df = events.book_rounds(spark.createDataFrame(rows + odd, "market string, round long, agent_id string, side string, price double, quantity long"))
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)
    # no call a market
    assert "FlatMapGroups" not in df._jdf.queryExecution().toString()


def test_stateful_book_stream(spark, tmp_path):
    schema = "market string, round long, agent_id string, side string, price double, quantity long"
    for k, row in enumerate([("m", 1, "b1", "buy", 5.0, 3), ("m", 2, "s1", "sell", 4.0, 5), ("m", 3, "b2", "buy", 4.0, 2)]):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        assert k >= 0
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    got = events.run_to_end(events.book_stream(stream), "book", "append")
    assert sorted((r.round, r.buyer_id, r.seller_id, r.quantity) for r in got.collect()) == [(2, "b1", "s1", 3), (3, "b2", "s1", 2)]


def test_unit_matching_keeps_arrival_order(spark):
    df = spark.createDataFrame([(1, "x", "buy", 5.0, 2), (1, "y", "buy", 5.0, 1), (1, "s", "sell", 4.0, 3), (1, "t", "sell", 6.0, 4)], "round int, agent_id string, side string, price double, arrival long")
    assert [tuple(r) for r in market.match_units(df, ["round"]).collect()] == [(1, 1, "y", "s", 4.5)]


def test_summaries_of_idle_markets(spark):
    trades = spark.createDataFrame([("a", 2.0, 3.0), ("a", 4.0, 1.0)], "token string, price double, quantity double")
    every = spark.createDataFrame([("a", 9.0), ("b", 7.0)], "token string, current_price double")
    got = {r.token: r for r in market.token_summary(trades, every).collect()}
    assert (got["a"].average_price, got["b"].average_price, got["b"].trades_count) == (3.0, 7.0, 0)
    assert market.summary(trades, ["token"], "quantity", every).where("token = 'b' AND trades_count = 0 AND average_price = 0").count() == 1
    assert market.vwap(trades.withColumn("quantity", F.lit(0.0)), ["token"]).first().vwap is None
    assert spark.range(1).select(market.base_units(F.lit(1.239), 2), market.base_units(F.lit(-1.239), 2)).first() == (123, -123)


def test_nearest_in_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = df.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    whole = {tuple(r) for r in vectors.nearest_of_each(df, queries, 5).select("query_id", "vec_id", "rank").collect()}
    blocks = {tuple(r) for r in vectors.nearest_of_each(df, queries, 5, block_rows=1).select("query_id", "vec_id", "rank").collect()}
    assert whole == blocks and len(whole) == 20 and (0, 0, 1) in whole
    assert spark.range(1).select(vectors.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] is None


def test_dedup_and_merge(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, None, "w"), (5, "b", "v")], "i long, key string, own string")
    assert sorted(r.i for r in dedup.first_of_each(df, F.col("key"), "i").collect()) == [1, 3, 4, 5]
    new = spark.createDataFrame([(0, "a", "n"), (1, "c", "n"), (2, "c", "m")], "i long, key string, own string")
    assert sorted((r.key or "", r.own) for r in dedup.merge(df, new, F.col("key"), "i").collect()) == [("", "w"), ("", "z"), ("a", "x"), ("b", "v"), ("c", "n")]
    assert [r.own for r in dedup.new_rows(new, df, "key", "i").collect()] == ["n"]
    assert sorted(r.i for r in dedup.without_published(df, F.col("key"), new, F.col("key")).collect()) == [5]
    assert dedup.latest_of_each(df.where("key = 'a'"), ["key"], "i", "own").first().own == "y"


def test_conversation_arrays(spark):
    turns = [("system", "s"), ("human", "q1"), ("gpt", " "), ("human", "q2"), ("gpt", "r2"), ("human", "q3")]
    df = spark.createDataFrame([(1, turns)], "id int, conversations array<struct<from:string,value:string>>")
    conv = F.col("conversations")
    assert [t["value"] for t in df.select(c.pairs_only(conv)).first()[0]] == ["s", "q2", "r2"]
    assert df.select(c.last_of(conv, "gpt"), c.first_of(conv, "human")).first() == ("r2", "q1")
    assert [m["role"] for m in df.select(c.to_messages(conv)).first()[0]] == ["system", "user", "assistant", "user", "assistant", "user"]
    assert len(df.select(c.system_first(conv, F.lit("new"))).first()[0]) == 6 and len(df.select(c.drop_seed(conv, F.lit(True))).first()[0]) == 4
    assert [(r.position, len(r.history), r.system_prompt) for r in c.replies(df).collect()] == [(2, 2, "s"), (4, 4, "s")]
    assert df.select(c.scenario(conv)).first()[0] == "relevance" and df.select(c.masked_weights(conv)).first()[0] == [0, 0, 1, 0, 1, 0]
    assert c.rejection_reasons(df).first().reason == "short_human"
    qa = spark.createDataFrame([("q", "a", "c"), ("q", " ", "c")], "q string, a string, c string").select(c.from_question_answer(F.col("q"), F.col("a"), F.col("c")).alias("x")).collect()
    assert qa[0].x[0]["value"] == "c\n\nq" and qa[1].x is None


def test_numbering_without_one_task(spark):
    df = spark.range(1000).repartition(7)
    got = c.numbered(df, F.desc("id"), "place").collect()
    assert all(r.place == 1000 - r.id for r in got)
    assert c.cohorts(spark.range(10), "id", 4).groupBy("cohort").count().orderBy("cohort").collect() == [(1, 4), (2, 4), (3, 2)]


def test_council_and_analysis(spark):
    votes = spark.createDataFrame([("a", "correct", 2.0), ("a", "incorrect", 0.5), ("a", "wrong", 0.5), ("b", "correct", None), ("c", "unclear", 0.2)], "qid string, verdict string, score double")
    got = {r.qid: (r.verdict, r.score, r.votes) for r in evaluation.council(votes).collect()}
    assert got == {"a": ("correct", 0.75, 2), "b": ("unclear", 0.0, 0), "c": ("unclear", 0.2, 1)}
    df = spark.createDataFrame([(True, float(x)) for x in (1, 2, 2, 5)] + [(None, 3.0)], "ok boolean, x double")
    got = {r.outcome: r for r in evaluation.reward_analysis(df, F.col("ok"), F.col("x")).collect()}
    assert (got["correct"].median_reward, got["correct"].mean_reward, got["unknown"].n) == (2.0, 2.5, 1)
    assert sorted(tuple(r)[1] for r in evaluation.reward_histogram(df, F.col("x")).collect()) == [0, 0, 0, 0, 5]


def test_explore(spark):
    df = spark.createDataFrame([(1, "Alpha", 5), (2, None, 0), (3, "beta%", 5)], "i long, name string, n int")
    assert [r.i for r in explore.search(df, "%").collect()] == [3] and [r.i for r in explore.equal_to(df, n=0).collect()] == [2]
    page = explore.page(df, ["i"], 2, 2).collect()
    assert [(r.i, r.total_rows, r.total_pages) for r in page] == [(3, 3, 2)]
    assert explore.recent(df, "n", "i", 2).select("i").collect() == [(1,), (3,)]
    prices = spark.createDataFrame([("a", 1, 10.0), ("a", 5, 20.0)], "k string, t int, v double")
    asked = spark.createDataFrame([("a", 0, 1), ("a", 5, 2), ("a", 9, 3), ("b", 9, 4)], "k string, t int, q int")
    assert {r.q: r.v for r in explore.asof(asked, prices, ["k"], "t", "v", "q").collect()} == {1: None, 2: 20.0, 3: 20.0, 4: None}


@pytest.mark.parametrize("block", [20_000, 1])
def test_fuzzy_match(spark, monkeypatch, block):
    monkeypatch.setattr(matching, "BLOCK", block)
    left = spark.createDataFrame([(1, "registered nurse"), (2, "plumber"), (3, None)], "i long, title string")
    right = spark.createDataFrame([(1, "Registered Nurses"), (2, "registered nursex"), (3, "cook")], "pos long, name string")
    got = matching.best_match(left, right, "title", "name", "pos").collect()
    assert [(r.i, r.match_name) for r in got] == [(1, "Registered Nurses")]
    names = spark.createDataFrame([(1, "alpha one", "g"), (2, "alpha one!", "g"), (3, "beta", "g")], "i long, title string, g string")
    assert sorted(r.i for r in matching.greedy_distinct(names, "title", "i", ["g"]).collect()) == [1, 3]


@pytest.mark.parametrize("block", [20_000, 7])
def test_fuzzy_match_compares_distinct_titles(spark, monkeypatch, block):
    from plazaflow.functions.parsing import ratio

    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abAé ", k=rng.randint(0, 7)))
    titles, refs = [word() for _ in range(40)] + [None], [(i, None if i == 3 else word()) for i in range(60)]
    want = {}
    for t in titles:
        best = max(((ratio(t, o), -i, o) for i, o in refs if o is not None), default=None) if t is not None else None
        if best and best[0] >= 70:
            want[t] = (best[0], best[2], -best[1])
    monkeypatch.setattr(matching, "BLOCK", block)
    left = spark.createDataFrame([(i, titles[i % 41]) for i in range(410)], "i long, title string")
    got = matching.best_match(left, spark.createDataFrame(refs, "pos string, name string").withColumn("pos", F.lpad("pos", 2, "0")), "title", "name", "pos", 70, ["pos"])
    assert sorted((r.i, r.match_score, r.match_name, int(r.match_pos)) for r in got.collect()) == sorted((i, *want[titles[i % 41]]) for i in range(410) if titles[i % 41] in want)
    # one comparison a title, not one a row
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("EvalPython") :]


def test_numbering_of_more_rows_than_a_sample(spark):
    # long rows: their order alone and the whole rows would be cut into different ranges
    df = spark.range(60_000).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("text"))
    keys = {i: k + 1 for k, (_, i) in enumerate(sorted((hashlib.sha256(str(i).encode()).hexdigest(), i) for i in range(60_000)))}
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("200k", "32"), strict=True):
            spark.conf.set(k, v)
        got = c.numbered(df, F.sha2(F.col("id").cast("string"), 256), "place").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.id: r.place for r in got} == keys and len(got) == 60_000


def test_board_insert_with_equal_titles(spark, tmp_path):
    from plazaflow.plans.catalog import QUERIES

    rows = [(i, f"Customer#{i % 10}", 1, 1.0, "x") for i in range(200)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").repartition(5).write.parquet(f"{tmp_path}/customer.parquet")
    assert sorted(tuple(r) for r in QUERIES["board_inserts"](spark, str(tmp_path)).collect()) == [(i + 1, f"Customer#{i % 10}", i % 5) for i in range(200)]
