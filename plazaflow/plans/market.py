"""Market queries: orders and trades are derived from the order and line tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import market as m
from .registry import query, table

_ORDERS = """o AS (SELECT l_partkey AS market, l_suppkey * 1000000 + l_orderkey * 10 + l_linenumber AS agent_id, CASE WHEN l_linenumber % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, round(l_extendedprice / l_quantity) AS price, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem WHERE l_quantity > 0)"""


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_quantity > 0").select(F.col("l_partkey").alias("market"), F.expr("l_suppkey * 1000000 + l_orderkey * 10 + l_linenumber").alias("agent_id"), F.expr("CASE WHEN l_linenumber % 2 = 0 THEN 'buy' ELSE 'sell' END").alias("side"), F.expr("round(l_extendedprice / l_quantity)").alias("price"), F.expr("CAST(l_quantity AS BIGINT)").alias("quantity"))


def _trades(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("token"), F.expr("date_format(l_shipdate, 'yyyy-MM')").alias("round"), F.col("l_suppkey").alias("seller_id"), F.col("l_orderkey").alias("buyer_id"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))


@query(f"""
WITH {_ORDERS},
b AS MATERIALIZED (SELECT *, CAST(sum(quantity) OVER (PARTITION BY market, side ORDER BY CASE WHEN side = 'buy' THEN -price ELSE price END, agent_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS hi FROM o)
SELECT x.market, x.agent_id AS buyer_id, y.agent_id AS seller_id, least(x.hi, y.hi) - greatest(x.hi - x.quantity, y.hi - y.quantity) AS quantity, (x.price + y.price) / 2 AS price
FROM b x JOIN b y ON x.market = y.market AND x.side = 'buy' AND y.side = 'sell' AND x.price >= y.price AND greatest(x.hi - x.quantity, y.hi - y.quantity) < least(x.hi, y.hi)
""")
def match_orders(spark, sf_dir):
    return m.match_quantities(m.valid_orders(_orders(spark, sf_dir)), ["market"]).drop("at")


@query(f"""
WITH {_ORDERS},
b AS (SELECT *, CAST(sum(quantity) OVER (PARTITION BY market, side ORDER BY CASE WHEN side = 'buy' THEN -price ELSE price END, agent_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS hi FROM o),
t AS (SELECT x.market, x.agent_id AS buyer_id, y.agent_id AS seller_id, least(x.hi, y.hi) - greatest(x.hi - x.quantity, y.hi - y.quantity) AS n
FROM b x JOIN b y ON x.market = y.market AND x.side = 'buy' AND y.side = 'sell' AND x.price >= y.price AND greatest(x.hi - x.quantity, y.hi - y.quantity) < least(x.hi, y.hi)),
f AS (SELECT market, agent_id, CAST(sum(n) AS BIGINT) AS filled FROM (SELECT market, buyer_id AS agent_id, n FROM t UNION ALL SELECT market, seller_id, n FROM t) GROUP BY ALL)
SELECT o.market, o.agent_id, side, price, quantity - coalesce(filled, 0) AS quantity FROM o LEFT JOIN f USING (market, agent_id) WHERE quantity > coalesce(filled, 0)
""")
def resting_orders(spark, sf_dir):
    orders = m.valid_orders(_orders(spark, sf_dir))
    return m.residual_orders(orders, m.match_quantities(orders, ["market"]), ["market"]).select("market", "agent_id", "side", "price", "quantity")


@query("""
WITH r AS (SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), event_type ORDER BY CASE WHEN event_type = 'purchase' THEN -value ELSE value END, event_id) AS k FROM events WHERE event_type IN ('purchase', 'view') AND value IS NOT NULL)
SELECT b.day, b.k, b.user_id AS buyer_id, s.user_id AS seller_id, round((b.value + s.value) / 2, 6) AS price FROM r b JOIN r s ON b.day = s.day AND b.k = s.k AND b.event_type = 'purchase' AND s.event_type = 'view' AND b.value >= s.value
""")
def match_unit_orders(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type IN ('purchase', 'view') AND value IS NOT NULL").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").alias("arrival"), F.col("user_id").alias("agent_id"), F.expr("CASE event_type WHEN 'purchase' THEN 'buy' ELSE 'sell' END").alias("side"), F.col("value").alias("price"))
    return m.match_units(e, ["day"]).select("day", F.col("k").cast("long").alias("k"), "buyer_id", "seller_id", F.round("price", 6).alias("price"))


@query("""
SELECT strftime(l_shipdate, '%Y-%m') AS round, count(*) AS trades_count, round(sum(l_extendedprice), 6) / count(*) AS average_price, round(sum(l_quantity), 2) AS total_volume, min(l_extendedprice) AS low_price, max(l_extendedprice) AS high_price FROM lineitem GROUP BY 1
""")
def market_summary(spark, sf_dir):
    return m.summary(_trades(spark, sf_dir), ["round"], "quantity").withColumn("total_volume", F.round("total_volume", 2))


@query("""
WITH t AS (SELECT l_partkey, count(*) AS n, round(sum(l_extendedprice), 6) / count(*) AS a, sum(l_quantity) AS v, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01' GROUP BY 1)
SELECT p_partkey AS token, coalesce(n, 0) AS trades_count, coalesce(a, p_retailprice) AS average_price, round(coalesce(v, 0), 2) AS total_volume, coalesce(lo, p_retailprice) AS low_price, coalesce(hi, p_retailprice) AS high_price FROM part LEFT JOIN t ON l_partkey = p_partkey
""")
def token_summary(spark, sf_dir):
    trades = table(spark, sf_dir, "lineitem").where("l_shipdate >= TIMESTAMP_NTZ '1998-06-01 00:00:00'").select(F.col("l_partkey").alias("token"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))
    tokens = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("token"), F.col("p_retailprice").alias("current_price"))
    return m.token_summary(trades, tokens).select("token", "trades_count", "average_price", F.round("total_volume", 2).alias("total_volume"), "low_price", "high_price")


@query("SELECT l_partkey AS token, round(sum(l_extendedprice * l_quantity), 6) / nullif(round(sum(l_quantity), 6), 0) AS vwap, round(sum(l_quantity), 6) AS volume FROM lineitem GROUP BY 1")
def vwap_by_part(spark, sf_dir):
    return m.vwap(_trades(spark, sf_dir), ["token"])


@query("""
WITH v AS (SELECT l_suppkey AS token, strftime(l_shipdate, '%Y-%m') AS round, round(sum(l_extendedprice * l_quantity), 6) / nullif(round(sum(l_quantity), 6), 0) AS price FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
g AS (SELECT DISTINCT l_suppkey AS token, strftime(l_shipdate, '%Y-%m') AS round FROM lineitem)
SELECT token, round, last_value(price IGNORE NULLS) OVER (PARTITION BY token ORDER BY round ROWS UNBOUNDED PRECEDING) AS carried_price FROM g LEFT JOIN v USING (token, round)
""")
def price_carry_forward(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("token"), F.date_format("l_shipdate", "yyyy-MM").alias("round"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"), "l_returnflag")
    prices = m.vwap(lines.where("l_returnflag = 'R'"), ["token", "round"]).select("token", "round", F.col("vwap").alias("price"))
    rounds = lines.select("token", "round").distinct().join(prices, ["token", "round"], "left")
    return m.carry_price(rounds, "token", "round", "price").select("token", "round", "carried_price")


@query("""
WITH o AS (SELECT o_orderpriority AS market, CASE WHEN o_orderstatus = 'O' THEN 'buy' ELSE 'sell' END AS side, floor(o_totalprice / 1000) * 1000 AS price FROM orders)
SELECT market, side, price, count(*)::BIGINT AS quantity, count(*) AS orders_count, row_number() OVER (PARTITION BY market, side ORDER BY CASE WHEN side = 'buy' THEN -price ELSE price END)::BIGINT AS level FROM o GROUP BY 1, 2, 3
""")
def order_book_depth(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("market"), F.expr("CASE WHEN o_orderstatus = 'O' THEN 'buy' ELSE 'sell' END").alias("side"), F.expr("CAST(floor(o_totalprice / 1000) * 1000 AS DOUBLE)").alias("price"), F.lit(1).cast("long").alias("quantity"))
    return m.depth(o, ["market"]).withColumn("level", F.col("level").cast("long"))


@query("""
WITH v AS (SELECT l_suppkey AS agent_id, 'seller' AS role, l_orderkey AS counterparty_id, l_extendedprice AS price, l_quantity AS q FROM lineitem UNION ALL SELECT l_orderkey, 'buyer', l_suppkey, l_extendedprice, l_quantity FROM lineitem)
SELECT agent_id, role, count(*) AS trades, count(DISTINCT counterparty_id) AS counterparties, round(sum(price * q), 2) AS turnover FROM v GROUP BY 1, 2
""")
def agent_trade_view(spark, sf_dir):
    return m.agent_view(_trades(spark, sf_dir), ["round"]).groupBy("agent_id", "role").agg(F.count(F.lit(1)).alias("trades"), F.count_distinct("counterparty_id").alias("counterparties"), F.round(F.sum(F.col("price") * F.col("quantity")), 2).alias("turnover"))


@query("""
SELECT s_suppkey AS agent_id, round(coalesce(sum(l_quantity * coalesce(p_retailprice, 1.0)), 0), 2) AS value FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey LEFT JOIN (SELECT * FROM part WHERE p_partkey % 7 <> 0) ON p_partkey = l_partkey GROUP BY 1
""")
def portfolio_value(spark, sf_dir):
    holdings = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("agent_id"), F.col("l_partkey").alias("token"), F.col("l_quantity").alias("qty"))
    prices = table(spark, sf_dir, "part").where("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("token"), F.col("p_retailprice").alias("price"))
    agents = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("agent_id"))
    return m.portfolio_value(holdings, prices, default=1.0, every=agents).select("agent_id", F.round("value", 2).alias("value"))


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN 'buy' WHEN 'F' THEN 'sell' ELSE 'hold' END AS side, round(o_totalprice / 100) AS price FROM orders),
b AS (SELECT *, CASE side WHEN 'buy' THEN coalesce(c_acctbal, 0) >= price WHEN 'sell' THEN coalesce(c_nationkey, 0) >= 1 ELSE false END AS executed FROM o LEFT JOIN customer ON c_custkey = o_custkey)
SELECT o_orderkey, side, executed, CASE WHEN executed THEN 'MARKET_MAKER' END AS counterparty, round(c_acctbal - CASE WHEN executed THEN CASE side WHEN 'buy' THEN price ELSE -price END ELSE 0 END, 2) AS cash_after FROM b
""")
def maker_execution(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("agent_id"), F.expr("CASE o_orderstatus WHEN 'O' THEN 'buy' WHEN 'F' THEN 'sell' ELSE 'hold' END").alias("side"), F.expr("round(o_totalprice / 100)").alias("price"), F.lit(1).alias("quantity"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("agent_id"), F.col("c_acctbal").alias("cash"), F.col("c_nationkey").alias("tokens"))
    return m.execute_against_maker(o, b).select("o_orderkey", "side", "executed", "counterparty", F.round("cash_after", 2).alias("cash_after"))


@query("""
WITH g AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_id, user_id, value FROM events WHERE event_type = 'click' AND value IS NOT NULL),
a AS (SELECT day, avg(value) AS mean FROM g GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY abs(value - mean * 2 / 3), event_id) AS k FROM g JOIN a USING (day))
SELECT day, round(mean, 4) AS mean, round(mean * 2 / 3, 4) AS target, user_id AS winner, value AS winning_guess, 100.0::DOUBLE AS prize FROM r WHERE k = 1
""")
def beauty_contest(spark, sf_dir):
    g = table(spark, sf_dir, "events").where("event_type = 'click' AND value IS NOT NULL").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").alias("pos"), F.col("user_id").alias("agent_id"), F.col("value").alias("guess"))
    return m.beauty_contest(g, ["day"]).withColumns({"mean": F.round("mean", 4), "target": F.round("target", 4)})


@query("""
WITH s AS (SELECT event_type, user_id, round(sum(value), 4) AS score FROM events GROUP BY 1, 2)
SELECT event_type, user_id, score, row_number() OVER (PARTITION BY event_type ORDER BY score DESC NULLS LAST, user_id)::BIGINT AS rank, CASE row_number() OVER (PARTITION BY event_type ORDER BY score DESC NULLS LAST, user_id) WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' WHEN 3 THEN 'bronze' END AS medal FROM s
""")
def leaderboard(spark, sf_dir):
    s = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.round(F.sum("value"), 4).alias("score"))
    return m.leaderboard(s, "score", "user_id", ["event_type"]).withColumn("rank", F.col("rank").cast("long"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN NULL WHEN coalesce(o_totalprice > 50000, false) = false THEN 'price must be positive' END AS error FROM orders
""")
def order_validity(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("CASE o_orderstatus WHEN 'O' THEN 'buy' WHEN 'F' THEN 'sell' ELSE 'hold' END").alias("side"), F.expr("o_totalprice - 50000").alias("price"), F.lit(1).alias("quantity"))
    return m.order_errors(o, unit=True).select("o_orderkey", "error")


@query("""
SELECT user_id AS agent_id, round(sum(v), 4) AS qty FROM (SELECT user_id, value AS v FROM events WHERE event_type <> 'purchase' UNION ALL SELECT user_id, -value FROM events WHERE event_type = 'purchase') GROUP BY 1
""")
def balance_adjustments(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("agent_id"), F.col("value").alias("qty"), "event_type")
    return m.adjust_balances(e.where("event_type <> 'purchase'"), e.where("event_type = 'purchase'").withColumn("qty", -F.col("qty")), ["agent_id"]).withColumn("qty", F.round("qty", 4))
