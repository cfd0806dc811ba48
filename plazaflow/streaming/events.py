"""Event streams: windows with watermarks, sessions, a stateful order book, and running them to the end for batch-equal results."""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder or file of Parquet as a stream; the schema is read first."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def timed(df: DataFrame, at: str = "ts") -> DataFrame:
    """Event time as a timestamp, which watermarks need."""
    return df.withColumn(at, F.col(at).cast("timestamp"))


def tumbling(df: DataFrame, at: str, width: str, keys: list[str], *aggregates: Column, late: str | None = None) -> DataFrame:
    """Aggregates by window and keys; rows later than ``late`` behind the newest are left out in a stream."""
    df = df.withWatermark(at, late) if late else df
    got = df.groupBy(F.window(at, width).alias("w"), *keys).agg(*aggregates)
    return got.select(F.col("w.start").alias("window_start"), *keys, *got.columns[1 + len(keys) :])


def sliding(df: DataFrame, at: str, width: str, step: str, keys: list[str], *aggregates: Column, late: str | None = None) -> DataFrame:
    df = df.withWatermark(at, late) if late else df
    got = df.groupBy(F.window(at, width, step).alias("w"), *keys).agg(*aggregates)
    return got.select(F.col("w.start").alias("window_start"), *keys, *got.columns[1 + len(keys) :])


def sessions(df: DataFrame, at: str, gap: str, keys: list[str], *aggregates: Column, late: str | None = None) -> DataFrame:
    """Sessions that end after ``gap`` without an event; an idle session goes with the watermark."""
    df = df.withWatermark(at, late) if late else df
    got = df.groupBy(F.session_window(at, gap).alias("w"), *keys).agg(*aggregates)
    return got.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, *got.columns[1 + len(keys) :])


def run_to_end(stream: DataFrame, table: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over all that is there and returns its result, kept in memory; for tests and small tables."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(table).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(table)


TRADE = "market string, round long, buyer_id string, seller_id string, price double, quantity long"
BOOK = "side array<string>, agent array<string>, price array<double>, quantity array<long>"


def _put(book: tuple[list, list], r, side: str, agent: str, price: float, quantity: int) -> None:
    """An order into its side's heap: best price, then agent, then the earlier round. What isn't a buy or a sell, or has no price or quantity, leaves the book."""
    if side in ("buy", "sell") and price is not None and price == price and quantity is not None and quantity > 0:
        heapq.heappush(book[side == "sell"], (-price if side == "buy" else price, agent is None, agent or "", r, quantity))


def _matched(book: tuple[list, list]) -> Iterator[tuple]:
    """Trades of best bid against best ask while they cross; the heaps keep what stays."""
    bids, asks = book
    while bids and asks and -bids[0][0] >= asks[0][0]:
        bid, ask = bids[0], asks[0]
        n = min(bid[4], ask[4])
        yield None if bid[1] else bid[2], None if ask[1] else ask[2], (ask[0] - bid[0]) / 2, n
        for heap, order in ((bids, bid), (asks, ask)):
            if order[4] == n:
                heapq.heappop(heap)
            else:
                # less of it is smaller still, so it stays on top
                heap[0] = (*order[:4], order[4] - n)


def _rounds(orders: Iterator[tuple], book: tuple[list, list]) -> Iterator[tuple]:
    """(round, trade) of (round, side, agent, price, quantity) in order of rounds; orders without a round go."""
    for r, own in itertools.groupby(orders, key=lambda x: x[0]):
        if r is not None:
            for order in own:
                _put(book, *order)
            for trade in _matched(book):
                yield r, *trade


def book_rounds(orders: DataFrame) -> DataFrame:
    """Trades over successive rounds with unfilled quantity carried on; a market is sequential by nature, and its rows stream by in order.

    ``orders``: market, round, agent_id, side, price, quantity. Markets of a task follow one another in its batches, so many small ones
    cost no more than one, and only the book of the one under way is held.
    """
    schema = pa.schema([("market", pa.string()), ("round", pa.int64()), ("buyer_id", pa.string()), ("seller_id", pa.string()), ("price", pa.float64()), ("quantity", pa.int64())])

    def run(batches):
        rows = (x for batch in batches for x in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        trades = ((m, *t) for m, own in itertools.groupby(rows, key=lambda x: x[0]) for t in _rounds((x[1:] for x in own), ([], [])))
        while some := list(itertools.islice(trades, 50_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)

    columns = {"market": "string", "round": "long", "side": "string", "agent_id": "string", "price": "double", "quantity": "long"}
    rows = orders.select(*(F.col(c).cast(t).alias(c) for c, t in columns.items()))
    return rows.repartition("market").sortWithinPartitions("market", "round").mapInArrow(run, TRADE)


def book_stream(orders: DataFrame) -> DataFrame:
    """As ``book_rounds`` over a stream: what stays of a market's book is its state between batches."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    columns = ["market", "round", "buyer_id", "seller_id", "price", "quantity"]

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        book = ([], [])
        for order in zip(*state.get, strict=True) if state.exists else ():
            _put(book, -math.inf, *order)
        rows = pd.concat(list(batches)).dropna(subset=["round"]).sort_values("round")
        plain = zip(*(rows[c].astype(object).where(rows[c].notna(), None).tolist() for c in ("round", "side", "agent_id", "price", "quantity")), strict=True)
        trades = [(key[0], *t) for t in _rounds(plain, book)]
        rest = [(side, None if x[1] else x[2], sign * x[0], x[4]) for side, sign, heap in (("buy", -1, book[0]), ("sell", 1, book[1])) for x in heap]
        state.update(tuple(list(c) for c in zip(*rest, strict=True)) if rest else ([], [], [], []))
        yield pd.DataFrame(trades, columns=columns)

    return orders.groupBy("market").applyInPandasWithState(run, TRADE, BOOK, "append", GroupStateTimeout.NoTimeout)
