"""Ask-and-answer over hash buckets: every unit of rows asks buckets about its distinct keys and gets an answer in the order asked.

A plain join of exploded keys back to their rows would shuffle a row for each key twice, with its row's id. Here a unit (a run of whole
rows of about ``unit_bytes`` of text) sends one packed block of its *distinct* keys to each bucket that has any of them, so a key that
fills a unit counts once there: no bucket grows with a hot key by more than one entry a unit. A bucket answers with a packed block in
the order asked, and the unit, which travels compressed, is finished where its answers meet.

Growth: no block is empty, so there are never more blocks than distinct keys of units; rows and bytes grow with the input at any size,
and where buckets outnumber the keys of a unit this is a plain shuffle of keys. Below that, units grow with the number of buckets (up to
``MOST_UNIT_BYTES``), so that blocks stay about as large. The number of buckets comes from the measured bytes of the texts.

Units are cut in scan order, and the rows are scanned twice. Anything but a plain scan (with projections and filters) is therefore
written to the shared folder first; recomputing a lost task then gives the same units. A unit whose answers don't fit its own keys raises.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import bounded, slices
from .scratch import Scratch

_LINK = "unit long, bucket int, block binary"
#: Buckets for each shuffle partition; more than one evens out how buckets fall on tasks.
BUCKETS_PER_PARTITION = 2
#: Bytes of keys that one bucket should hold at most, and bytes of keys for each byte of text (eight a word).
BUCKET_BYTES = 128 << 20
KEYS_PER_BYTE = 1.3
LEAST_UNIT_BYTES, MOST_UNIT_BYTES = 4 << 20, 16 << 20
#: Bytes of text in a unit for each bucket.
_UNIT_PER_BUCKET = 4 << 10
_PLAIN = {"Project", "Filter", "LogicalRelation", "LocalRelation", "SubqueryAlias", "DataSourceV2ScanRelation"}


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(block) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(block)).read_all().combine_chunks().to_batches()[0]


def _plain(plan) -> bool:
    children = plan.children()
    return plan.nodeName().split(" ")[0] in _PLAIN and plan.deterministic() and all(_plain(children.apply(k)) for k in range(children.size()))


def scanned(df: DataFrame) -> DataFrame:
    """The rows as a scan that gives the same order each time: as they are if they are one, else written and read again."""
    return df if _plain(df._jdf.queryExecution().optimizedPlan()) else Scratch(df.sparkSession).keep(df, "rows")


def bucket_count(df: DataFrame, text: str = "text", buckets: int | None = None) -> int:
    """As many as asked for; else some for each shuffle partition, and more where the measured texts would fill a bucket over ``BUCKET_BYTES``."""
    if buckets:
        return buckets
    least = BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(least, int(KEYS_PER_BYTE * size / BUCKET_BYTES) + 1)


def unit_size(n: int) -> int:
    return min(MOST_UNIT_BYTES, max(LEAST_UNIT_BYTES, _UNIT_PER_BUCKET * n))


def ask(df: DataFrame, keys: Callable, answer: Callable, finish: Callable, schema: str, n: int, *, text: str = "text", unit_bytes: int | None = None, side: DataFrame | None = None, heads: Callable | None = None):
    """keys(batch, n) -> {bucket: block}, no block empty; answer(list of blocks, list of side's blocks) -> a block for each;
    finish(batch, answers by bucket) -> a RecordBatch of ``schema``.

    ``df``: a scan that gives the same order each time (see ``scanned``). ``side``: (bucket, block) rows that a bucket's answers need.
    With ``heads`` (list of blocks -> two whole numbers for the bucket) the result is a pair: the rows, and (a, b) of each bucket, from the same shuffle.
    """
    unit_bytes = unit_bytes or unit_size(n)

    def units(batches):
        base, held, size = TaskContext.get().partitionId() << 32, [], 0
        seen = 0

        def whole():
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for part in slices(batches, text, unit_bytes // 8):
            held.append(part)
            size += part.nbytes
            if size >= unit_bytes:
                yield base + seen, whole()
                held, size, seen = [], 0, seen + 1
        if held:
            yield base + seen, whole()

    def asking(batches):
        for unit, rows in units(batches):
            blocks = keys(rows, n)
            yield pa.RecordBatch.from_arrays([pa.array([unit] * len(blocks), pa.int64()), pa.array(list(blocks), pa.int32()), pa.array(list(blocks.values()), pa.binary())], ["unit", "bucket", "block"])

    def carrying(batches):
        for unit, rows in units(batches):
            yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.array([_packed(rows)], pa.binary())], ["unit", "block"])

    def answered(t: pa.Table, beside: pa.Table | None = None) -> pa.Table:
        blocks = answer([x.as_buffer() for x in t["block"]], [x.as_buffer() for x in beside["block"]] if beside else []) if t.num_rows else []
        return pa.table([t["unit"], t["bucket"], pa.array(blocks, pa.binary())], ["unit", "bucket", "block"])

    def finishing(t: pa.Table, carried: pa.Table) -> pa.Table:
        if carried.num_rows != 1:
            raise ValueError("answers met no unit, or several: its rows came in another order when read again")
        at = {b: x.as_buffer() for b, x in zip(t["bucket"].to_pylist(), t["block"], strict=True)}
        return pa.Table.from_batches([finish(unpacked(carried["block"][0].as_buffer()), at)])

    rows = bounded(df)
    asked = rows.mapInArrow(asking, _LINK).groupBy("bucket")
    if side is None:
        answers = asked.applyInArrow(lambda t: answered(t), _LINK)
    else:
        answers = asked.cogroup(side.groupBy("bucket")).applyInArrow(lambda t, beside: answered(t, beside), _LINK)
    # each side has its own shuffle, so that both number the scan's partitions alike
    done = answers.groupBy("unit").cogroup(rows.mapInArrow(carrying, "unit long, block binary").groupBy("unit")).applyInArrow(finishing, schema)
    if heads is None:
        return done

    def of_bucket(t: pa.Table) -> pa.Table:
        a, b = heads([x.as_buffer() for x in t["block"]])
        return pa.table([pa.array([a], pa.int64()), pa.array([b], pa.int64())], ["a", "b"])

    return done, asked.applyInArrow(of_bucket, "a long, b long")
