"""Fuzzy joins and greedy dedup of titles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import ratio
from ..sources.stored import kept as stored

#: Right titles that every task may hold; beyond that the right side goes in blocks.
BLOCK = 20_000


#: Kinds of characters that are told apart when common characters are counted.
_KINDS = 64


def _counts(t: str) -> np.ndarray:
    return np.bincount(np.fromiter((ord(c) % _KINDS for c in t), np.int64, len(t)), minlength=_KINDS).astype(np.int32)


def _best_of(shared, columns: list[str], least: int):
    """Of each title: ratio, place, and columns of the best reference row, if its ratio is ``least`` or more.

    Characters in common bound the ratio, so only references whose bound reaches the best so far are compared, the likeliest first.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows = shared.value
        low = [o.lower() for _, o, *_ in rows]
        kinds, sizes = np.array([_counts(o) for o in low], dtype=np.int32).reshape(-1, _KINDS), np.array([len(o) for o in low], dtype=np.int64)

        def one(t):
            n = len(t.lower())
            common, total = np.minimum(kinds, _counts(t.lower())).sum(axis=1), sizes + n
            bound = np.where(total > 0, np.floor(200 * common / np.maximum(total, 1) + 0.5 + 1e-9), 100)
            near = np.flatnonzero(bound >= least)
            best, at = least - 1, None
            for k in near[np.argsort(-bound[near], kind="stable")]:
                if bound[k] < best:
                    break
                # an equal ratio counts if its place is earlier
                if (bound[k] > best or (at is not None and k < at)) and ((r := ratio(t, rows[k][1])) > best or (r == best and at is not None and k < at)):
                    best, at = r, k
            return (None,) * len(columns) if at is None else (best, *rows[at])

        for s in batches:
            yield pd.DataFrame([one(t) for t in s], columns=columns)

    return run


def best_match(left: DataFrame, right: DataFrame, title: str, other: str, order: str, least: int = 80, keep: list[str] = ()) -> DataFrame:
    """Each left row with the right title of the highest ratio (the first by ``order`` on ties), if that is ``least`` or more.

    The right side is a reference list: it is counted, and goes to the tasks in blocks of ``BLOCK`` rows; each distinct left title meets a
    block in one pass, the best over the blocks stays, and rows find their title's match by a join.
    """
    spark, n = left.sparkSession, right.where(F.col(other).isNotNull()).count()
    blocks, kinds = max(1, -(-n // BLOCK)), dict(right.dtypes)
    titles = left.where(F.col(title).isNotNull()).select(F.col(title).alias("own title")).distinct()
    titles, out = titles if blocks == 1 else stored(titles), None
    schema = f"score int, place {kinds[order]}, " + ", ".join(f"`{c}` {kinds[c]}" for c in (other, *keep))
    for b in range(blocks):
        part = right if blocks == 1 else right.where(F.pmod(F.xxhash64(order), blocks) == b)
        rows = [tuple(r) for r in part.where(F.col(other).isNotNull()).select(order, other, *keep).orderBy(order).collect()]
        best = F.pandas_udf(_best_of(spark.sparkContext.broadcast(rows), ["score", "place", other, *keep], least), schema)
        got = titles.withColumn("own match", best("own title")).where("`own match`.score IS NOT NULL")
        out = got if out is None else out.unionByName(got)
    if blocks > 1:
        out = out.groupBy("own title").agg(F.min_by("own match", F.struct(-F.col("own match.score"), F.col("own match.place"))).alias("own match"))
    fields = ["score", other, *keep]
    return left.join(out, F.col(title) == F.col("own title")).select(*left.columns, *(F.col(f"own match.{f}").alias(f"match_{f}") for f in fields))


def _pieces(n: int, most: int) -> tuple[int, list[tuple[int, int]]]:
    """For a title of ``n`` characters: how many single insertions and deletions may lie between it and another at ratio ``most``, and its cuts into one piece more."""
    longest = n * (201 - most) // (most - 1)
    ops = (101 - most) * (n + longest) // 100
    return ops, [(n * k // (ops + 1), n * (k + 1) // (ops + 1)) for k in range(ops + 1)]


def _piece_keys(most: int):
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            ops, cuts = _pieces(len(t), most)
            return [{"piece": t[a:b], "at": a if b > a else 0, "ops": ops} for a, b in cuts]

        return pd.Series([one(t.lower()) for t in s])

    return run


def _gram_keys(most: int):
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            n = len(t)
            partners = range(n * (most - 1) // (201 - most), n * (201 - most) // (most - 1) + 2)
            sizes = {b - a for m in partners for a, b in _pieces(m, most)[1]}
            return [{"piece": t[a : a + k], "at": a} for k in sizes for a in (range(n - k + 1) if k else (0,))]

        return pd.Series([one(t.lower()) for t in s])

    return run


def greedy_distinct(df: DataFrame, title: str, order: str, groups: list[str] = (), most: int = 90) -> DataFrame:
    """Rows in order, each kept unless its ratio to a kept one is ``most`` or more, over the whole table or within each of the given groups; rows without title go.

    Only the first row of a title can stay, so distinct titles are compared. A pair at the ratio has few insertions and deletions between
    them: cut into one piece more, the later title has a piece that the earlier one holds whole, at about the same place. These pairs
    meet by an equi-join on the piece, and the ratio itself decides. Then rounds keep titles without an undecided earlier neighbour and
    drop what is close to these, so each decision is that of the one-by-one rule.
    """
    group = F.struct(*(F.col(f"`{g}`") for g in groups)) if groups else F.struct(F.lit(0))
    rows = df.where(F.col(title).isNotNull()).withColumn("own group", group)
    firsts = stored(rows.groupBy("own group", F.col(title).alias("own title")).agg(F.min(order).alias("own order")))
    near = F.pandas_udf(lambda a, b: pd.Series([ratio(x, y) >= most for x, y in zip(a, b, strict=True)], dtype=bool), "boolean")
    place = F.struct("own group", "own order", "own title")
    later = firsts.select(place.alias("later"), F.explode(F.pandas_udf(_piece_keys(most), "array<struct<piece:string,at:int,ops:int>>")("own title")).alias("x"))
    earlier = firsts.select(place.alias("earlier"), F.explode(F.pandas_udf(_gram_keys(most), "array<struct<piece:string,at:int>>")("own title")).alias("y"))
    meet = (F.col("x.piece") == F.col("y.piece")) & (F.col("later.own group") == F.col("earlier.own group")) & (F.abs(F.col("x.at") - F.col("y.at")) <= F.col("x.ops")) & (F.col("earlier") < F.col("later"))
    edges = stored(later.join(earlier, meet).select("later", "earlier").distinct().where(near(F.col("later.own title"), F.col("earlier.own title"))))
    gone = None
    while not edges.isEmpty():
        heads = edges.select(F.col("earlier").alias("head")).distinct().join(edges.select(F.col("later").alias("head")), "head", "left_anti")
        dropped = stored(edges.join(heads, F.col("earlier") == F.col("head"), "left_semi").select(F.col("later").alias("out")).distinct())
        gone = dropped if gone is None else gone.union(dropped)
        edges = stored(edges.join(dropped, F.col("later") == F.col("out"), "left_anti").join(dropped, F.col("earlier") == F.col("out"), "left_anti"))
    stay = firsts.select(place.alias("own place"))
    if gone is not None:
        stay = stay.join(gone, F.col("own place") == F.col("out"), "left_anti")
    named = rows.withColumn("own place", F.struct("own group", F.col(order).alias("own order"), F.col(title).alias("own title")))
    return named.join(stay, "own place", "left_semi").dropDuplicates(["own place"]).select(*(F.col(f"`{c}`") for c in df.columns))


def contained_pairs(rows: DataFrame, items: DataFrame, key: str, text: str, item: str, expected: str) -> DataFrame:
    """(key, item) of rows and items of which one's text equals or holds the other's, case and white space at the ends aside; blank ones match nothing.

    The items are a stated query set: they go to the tasks in blocks of ``BLOCK`` rows, as an Aho-Corasick automaton for items within
    texts, and for texts within items as one joined text that only texts no longer than the longest item are looked for in. Rows aren't shuffled.
    """
    spark, n = rows.sparkSession, items.count()
    blocks, out = max(1, -(-n // BLOCK)), None
    from ..functions.text import strip

    plain = lambda c: F.lower(strip(F.coalesce(F.col(c), F.lit(""))))
    kinds = dict(rows.dtypes)[key], dict(items.dtypes)[item]
    for b in range(blocks):
        part = items.select(F.col(item).alias("item"), plain(expected).alias("text")).where("text <> ''")
        part = part if blocks == 1 else part.where(F.pmod(F.xxhash64("item", "text"), blocks) == b)
        shared = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        got = rows.select(F.col(key).alias("key"), plain(text).alias("text")).where("text <> ''").mapInPandas(_containing(shared), f"`key` {kinds[0]}, item {kinds[1]}")
        out = got if out is None else out.unionByName(got)
    return out.select(F.col("key").alias(key), F.col("item").alias(item))


def _containing(shared):
    def run(batches):
        import bisect

        import ahocorasick

        owners: dict[str, list] = {}
        for item, text in shared.value:
            owners.setdefault(text, []).append(item)
        texts = list(owners)
        automaton = ahocorasick.Automaton()
        for k, t in enumerate(texts):
            automaton.add_word(t, k)
        if texts:
            automaton.make_automaton()
        joined, starts, at = "\0".join(texts), [], 0
        for t in texts:
            starts.append(at)
            at += len(t) + 1
        longest = max(map(len, texts), default=0)
        for batch in batches:
            found = []
            for name, t in zip(batch["key"], batch["text"], strict=True):
                hits = {k for _, k in automaton.iter(t)} if texts else set()
                at = joined.find(t) if len(t) <= longest and "\0" not in t else -1
                while at >= 0:
                    k = bisect.bisect_right(starts, at) - 1
                    hits.add(k)
                    # on to the next item
                    at = joined.find(t, starts[k] + len(texts[k]) + 1)
                found += [(name, i) for k in sorted(hits) for i in owners[texts[k]]]
            yield pd.DataFrame(found, columns=["key", "item"])

    return run
