"""Market analytics: order matching in closed form, summaries, prices, depth, portfolios, contests.

Orders carry a ``market`` key (a round, a token, or both). All operators are partitioned by it; none needs a global order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def valid_orders(df: DataFrame, side: str = "side", price: str = "price", quantity: str = "quantity") -> DataFrame:
    """Buys and sells with positive price and quantity; holds are free of both and leave the book."""
    return df.where(F.col(side).isin("buy", "sell") & (F.col(price) > 0) & (F.col(quantity) > 0))


def order_errors(df: DataFrame, side: str = "side", price: str = "price", quantity: str = "quantity", unit: bool = False) -> DataFrame:
    """Adds ``error``: null for a valid row. ``unit``: the quantity must be one."""
    positive = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    error = F.when(~F.col(side).isin("buy", "sell", "hold") | F.col(side).isNull(), "unknown side")
    error = error.when(F.col(side) == "hold", None).when(~positive(quantity), "quantity must be positive").when(~positive(price), "price must be positive")
    if unit:
        error = error.when(F.col(quantity) != 1, "quantity must be 1")
    return df.withColumn("error", error)


def match_quantities(orders: DataFrame, market: list[str], agent: str = "agent_id", side: str = "side", price: str = "price", quantity: str = "quantity") -> DataFrame:
    """Trades with partial fills: best bid against best ask while they cross, price at the midpoint; ties by agent. Quantities may be fractions of any size.

    Closed form: on each side an order takes the half-open interval of the running quantity; a trade is an overlap of a bid's and an
    ask's interval where the bid is not below the ask. The ends of both sides' intervals, in falling order, cut the book into segments,
    and the bid and the ask of a segment are the last ones seen: two windows, one row an order, no join.
    """
    best = F.when(F.col(side) == "buy", -F.col(price)).otherwise(F.col(price))
    upto = F.sum(quantity).over(W.partitionBy(*market, side).orderBy(best, agent).rowsBetween(W.unboundedPreceding, 0))
    down = W.partitionBy(*market).orderBy(F.desc("hi"), side, agent)
    so_far = down.rowsBetween(W.unboundedPreceding, 0)
    seen = lambda kind: F.last(F.when(F.col(side) == kind, F.struct(F.col(agent).alias("agent"), F.col(price).alias("price"))), ignorenulls=True).over(so_far)
    cut = orders.select(*market, agent, side, price, upto.alias("hi"))
    cut = cut.select(*market, "hi", F.coalesce(F.lead("hi").over(down), F.lit(0)).alias("lo"), seen("buy").alias("buy"), seen("sell").alias("sell"))
    # running sums of fractions differ in their last digits; a sliver of that size is no trade
    real = F.col("hi") - F.col("lo") > F.lit(1e-12) * F.col("hi")
    met = cut.where(real & (F.col("buy.price") >= F.col("sell.price")))
    return met.select(*market, F.col("buy.agent").alias("buyer_id"), F.col("sell.agent").alias("seller_id"), (F.col("hi") - F.col("lo")).alias("quantity"), ((F.col("buy.price") + F.col("sell.price")) / 2).alias("price"), F.col("lo").alias("at"))


def number_trades(trades: DataFrame, market: list[str], at: str = "at") -> DataFrame:
    """Adds ``trade_id``, from 1 on in each market, in the order of the book."""
    return trades.withColumn("trade_id", F.row_number().over(W.partitionBy(*market).orderBy(at, "buyer_id", "seller_id")))


def residual_orders(orders: DataFrame, trades: DataFrame, market: list[str], agent: str = "agent_id", side: str = "side", quantity: str = "quantity") -> DataFrame:
    """What stays in the book: orders with their unfilled quantity (one order an agent, side and market)."""
    filled = trades.select(*market, F.col("buyer_id").alias(agent), F.lit("buy").alias(side), "quantity").unionByName(trades.select(*market, F.col("seller_id").alias(agent), F.lit("sell").alias(side), "quantity"))
    filled = filled.groupBy(*market, agent, side).agg(F.sum("quantity").alias("filled"))
    return orders.join(filled, [*market, agent, side], "left").withColumn(quantity, F.col(quantity) - F.coalesce("filled", F.lit(0))).where(F.col(quantity) > 0).drop("filled")


def match_units(orders: DataFrame, market: list[str], arrival: str = "arrival", agent: str = "agent_id", side: str = "side", price: str = "price") -> DataFrame:
    """One unit an order: the k-th best bid meets the k-th best ask while they cross, at the midpoint; equal prices in order of arrival."""
    best = F.when(F.col(side) == "buy", -F.col(price)).otherwise(F.col(price))
    ranked = orders.withColumn("k", F.row_number().over(W.partitionBy(*market, side).orderBy(best, arrival)))
    leg = lambda kind, name: ranked.where(F.col(side) == kind).select(*market, "k", F.col(agent).alias(name), F.col(price).alias(f"{name}_price"))
    met = leg("buy", "buyer_id").join(leg("sell", "seller_id"), [*market, "k"]).where(F.col("buyer_id_price") >= F.col("seller_id_price"))
    return met.select(*market, "k", "buyer_id", "seller_id", ((F.col("buyer_id_price") + F.col("seller_id_price")) / 2).alias("price"))


def _steady(total: Column) -> Column:
    """A sum to six places: the same whatever order partial sums are added in."""
    return F.round(total, 6)


def summary(trades: DataFrame, market: list[str], quantity: str | None = None, every: DataFrame | None = None) -> DataFrame:
    """Trades, mean price, volume and price range of each market; markets of ``every`` without trades appear with zeros."""
    volume = F.sum(quantity) if quantity else F.count(F.lit(1))
    got = trades.groupBy(*market).agg(F.count(F.lit(1)).alias("trades_count"), (_steady(F.sum("price")) / F.count("price")).alias("average_price"), volume.alias("total_volume"), F.min("price").alias("low_price"), F.max("price").alias("high_price"))
    return got if every is None else every.select(*market).distinct().join(got, market, "left").na.fill(0)


def token_summary(trades: DataFrame, tokens: DataFrame, token: str = "token", current: str = "current_price") -> DataFrame:
    """As ``summary`` for each listed token; an idle token reports its current price as average and range."""
    got = summary(trades, [token], "quantity")
    out = tokens.join(got, token, "left")
    fill = {c: F.coalesce(c, F.col(current)) for c in ("average_price", "low_price", "high_price")}
    return out.withColumns({**fill, "trades_count": F.coalesce("trades_count", F.lit(0)), "total_volume": F.coalesce("total_volume", F.lit(0.0))})


def vwap(trades: DataFrame, keys: list[str], price: str = "price", quantity: str = "quantity") -> DataFrame:
    """Volume-weighted price of each key; null where nothing was traded."""
    volume = _steady(F.sum(quantity))
    return trades.groupBy(*keys).agg((_steady(F.sum(F.col(price) * F.col(quantity))) / F.when(volume != 0, volume)).alias("vwap"), volume.alias("volume"))


def carry_price(rounds: DataFrame, token: str, at: str, price: str) -> DataFrame:
    """The last known price of each token at each round."""
    w = W.partitionBy(token).orderBy(at).rowsBetween(W.unboundedPreceding, 0)
    return rounds.withColumn("carried_price", F.last(price, ignorenulls=True).over(w))


def depth(orders: DataFrame, market: list[str], side: str = "side", price: str = "price", quantity: str = "quantity") -> DataFrame:
    """Quantity of each price level and its place in the book (best first)."""
    levels = orders.groupBy(*market, side, price).agg(F.sum(quantity).alias("quantity"), F.count(F.lit(1)).alias("orders_count"))
    best = F.when(F.col(side) == "buy", -F.col(price)).otherwise(F.col(price))
    return levels.withColumn("level", F.row_number().over(W.partitionBy(*market, side).orderBy(best)))


def agent_view(trades: DataFrame, market: list[str]) -> DataFrame:
    """Each trade from both ends: agent, role, counterparty."""
    leg = lambda me, other, role: trades.select(*market, F.col(me).alias("agent_id"), F.lit(role).alias("role"), F.col(other).alias("counterparty_id"), "price", "quantity")
    return leg("buyer_id", "seller_id", "buyer").unionByName(leg("seller_id", "buyer_id", "seller"))


def execute_against_maker(orders: DataFrame, balances: DataFrame, side: str = "side") -> DataFrame:
    """First order of each agent and token against a market maker at its own price: a buy needs the cash, a sale the tokens.

    ``balances``: agent_id, cash, tokens. Adds ``executed``, ``counterparty`` and the balances after.
    """
    cost = F.col("price") * F.col("quantity")
    fits = F.when(F.col(side) == "buy", F.coalesce("cash", F.lit(0.0)) >= cost).when(F.col(side) == "sell", F.coalesce("tokens", F.lit(0.0)) >= F.col("quantity")).otherwise(F.lit(False))
    sign = F.when(F.col("executed"), F.when(F.col(side) == "buy", 1).otherwise(-1)).otherwise(0)
    return orders.join(balances, "agent_id", "left").withColumn("executed", fits).withColumn("counterparty", F.when(F.col("executed"), "MARKET_MAKER")).withColumn("cash_after", F.col("cash") - sign * cost).withColumn("tokens_after", F.col("tokens") + sign * F.col("quantity"))


def portfolio_value(holdings: DataFrame, prices: DataFrame, agent: str = "agent_id", token: str = "token", quantity: str = "qty", price: str = "price", default: float = 0.0, every: DataFrame | None = None) -> DataFrame:
    """Sum of quantity times price of each agent; a token without price counts at ``default``, an agent of ``every`` without holdings has zero."""
    held = holdings.join(prices.select(token, price), token, "left")
    got = held.groupBy(agent).agg(F.sum(F.col(quantity) * F.coalesce(price, F.lit(default))).alias("value"))
    return got if every is None else every.select(agent).distinct().join(got, agent, "left").na.fill(0.0, ["value"])


def adjust_balances(balances: DataFrame, deltas: DataFrame, keys: list[str], quantity: str = "qty") -> DataFrame:
    """Balances after adding all deltas; a key seen in either side appears."""
    return balances.select(*keys, quantity).unionByName(deltas.select(*keys, quantity)).groupBy(*keys).agg(F.sum(quantity).alias(quantity))


def beauty_contest(guesses: DataFrame, market: list[str], guess: str = "guess", position: str = "pos", agent: str = "agent_id", factor: float = 2 / 3, prize: float = 100.0) -> DataFrame:
    """Mean, target and winner (nearest guess, the first on ties) of each round, with the winner's prize."""
    means = guesses.groupBy(*market).agg(F.avg(guess).alias("mean"))
    near = guesses.join(means, market).groupBy(*market, "mean").agg(F.min_by(F.struct(agent, guess), F.struct(F.abs(F.col(guess) - F.col("mean") * factor), F.col(position))).alias("best"))
    return near.select(*market, "mean", (F.col("mean") * factor).alias("target"), F.col(f"best.{agent}").alias("winner"), F.col(f"best.{guess}").alias("winning_guess"), F.lit(prize).alias("prize"))


def leaderboard(scores: DataFrame, score: str, key: str, groups: list[str] = ()) -> DataFrame:
    """Rank from 1, ties by key, medal for the first three. Without groups the ranking is one list: aggregate first."""
    w = W.partitionBy(*groups).orderBy(F.desc(score), key)
    rank = F.row_number().over(w)
    return scores.withColumn("rank", rank).withColumn("medal", F.when(rank == 1, "gold").when(rank == 2, "silver").when(rank == 3, "bronze"))


def base_units(amount: Column, decimals: int) -> Column:
    """Whole base units of a decimal amount, cut towards zero."""
    return F.when(amount < 0, F.ceil(amount * 10**decimals)).otherwise(F.floor(amount * 10**decimals)).cast("long")


def from_base_units(units: Column, decimals: int) -> Column:
    return units / 10**decimals
