"""Exact vector search: one query by higher-order functions inside the JVM, many by one matrix product a batch; no sort of all rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """1 minus the cosine distance; null for a zero vector."""
    n = norm(a) * norm(b)
    return dot(a, b) / F.when(n != 0, n)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def nearest(rows: DataFrame, query: list[float], k: int, vector: str = "embedding", key: str = "vec_id", metric: str = "cosine", least: float | None = None, strict: bool = False) -> DataFrame:
    """The k rows nearest to one vector, ties by key. One pass; Spark keeps k rows a task (TakeOrderedAndProject), nothing is shuffled whole."""
    q = F.array(*map(F.lit, map(float, query)))
    if metric == "euclidean":
        return rows.withColumn("distance", euclidean(F.col(vector), q)).orderBy("distance", key).limit(k)
    scored = rows.withColumn("similarity", cosine(F.col(vector), q))
    if least is not None:
        scored = scored.where(F.col("similarity") > least if strict else F.col("similarity") >= least)
    return scored.orderBy(F.desc_nulls_last("similarity"), key).limit(k)


def nearest_of_each(rows: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", key: str = "vec_id", query_key: str = "query_id", query_vector: str = "query_vector", block_rows: int = 10_000) -> DataFrame:
    """The k nearest rows of each query by cosine, ties by key: (query, key, similarity, rank).

    Queries are the stated, small side: they are counted and go in blocks of ``block_rows``, each one pass over the rows. A task keeps k
    rows a query and no more, whatever it reads, so the shuffle holds queries x tasks x k rows. Null and zero vectors have no similarity.
    Similarities count to twelve places, so that equal vectors tie.
    """
    blocks = max(1, -(-queries.count() // block_rows))
    kinds = dict(queries.dtypes)[query_key], dict(rows.dtypes)[key]
    schema = f"`{query_key}` {kinds[0]}, `{key}` {kinds[1]}, similarity double"
    out = None
    for b in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64(query_key), blocks) == b)
        asked = part.where(F.col(query_vector).isNotNull()).select(query_key, query_vector).toArrow()
        shared = rows.sparkSession.sparkContext.broadcast((asked[query_key].to_pylist(), _unit(_matrix(asked[query_vector].combine_chunks()))))
        got = rows.where(F.col(vector).isNotNull()).select(key, vector).mapInArrow(_top(shared, k, query_key, key), schema)
        out = got if out is None else out.unionByName(got)
    w = W.partitionBy(query_key).orderBy(F.desc("similarity"), key)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _matrix(column) -> np.ndarray:
    values = np.asarray(column.flatten(), np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(m: np.ndarray) -> np.ndarray:
    """Rows of length one; NaN for zero rows."""
    n = np.sqrt((m * m).sum(1, keepdims=True))
    return m / np.where(n > 0, n, np.nan)


def _top(shared, k: int, query_key: str, key: str, step: int = 4096):
    """Over a task's batches: the k best rows of each query so far."""

    def run(batches):
        names, asked = shared.value
        if not names:
            return
        best, kept, kind = np.full((len(names), 0), -np.inf), np.zeros((len(names), 0), np.int64), None
        ids: list = []
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                kind = part.column(0).type
                new = np.round(asked @ _unit(_matrix(part.column(1))).T, 12)
                held = [ids[i] for i in kept.ravel()]
                ids = held + part.column(0).to_pylist()
                kept = np.concatenate([np.arange(kept.size).reshape(kept.shape), np.broadcast_to(np.arange(part.num_rows) + kept.size, new.shape)], 1)
                best = np.nan_to_num(np.concatenate([best, new], 1), nan=-np.inf)
                place = np.argsort(np.argsort(np.array(ids, object), kind="stable"), kind="stable")
                order = np.lexsort((place[kept], -best), 1)[:, :k]
                best, kept = np.take_along_axis(best, order, 1), np.take_along_axis(kept, order, 1)
        rows = [(names[q], ids[kept[q, c]], float(best[q, c])) for q in range(len(names)) for c in range(best.shape[1]) if best[q, c] > -np.inf]
        if rows:
            a, b, c = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, kind), pa.array(c)], [query_key, key, "similarity"])

    return run


def search_knowledge(chunks: DataFrame, objects: DataFrame, query: list[float], k: int = 5, least: float = 0.0, around: int = 200) -> DataFrame:
    """Chunks at ``least`` similarity or more, the best row of each distinct text, the top k, with their object and context.

    Order: threshold, best per text, top k, and only then the join to the objects, so that whole contents move for k rows only.
    """
    q = F.array(*map(F.lit, map(float, query)))
    scored = chunks.withColumn("similarity", cosine(F.col("embedding"), q)).where(F.col("similarity") >= least)
    best = scored.groupBy("text").agg(F.max_by(F.struct("knowledge_id", "start_pos", "end_pos", "similarity"), F.struct("similarity", -F.col("start_pos"))).alias("b")).select("text", "b.*")
    top = best.orderBy(F.desc("similarity"), "text").limit(k)
    return top.join(objects, "knowledge_id").withColumn("context", context(F.col("content"), F.col("start_pos"), F.col("end_pos"), around))


def context(content: Column, start: Column, end: Column, around: int) -> Column:
    """The text around a span, with an ellipsis at each cut end."""
    a, b = F.greatest(start - around, F.lit(0)), F.least(end + around, F.length(content))
    return F.concat(F.when(a > 0, "...").otherwise(""), F.substring(content, a + 1, b - a), F.when(b < F.length(content), "...").otherwise(""))
