"""Shared pieces of the training-data operators: bounded slices of Arrow batches, exact word rules on bytes, vectorised word hashes."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

#: Text bytes that a Python worker handles at once; one document may be longer and is then handled alone.
SLICE_BYTES = 1 << 20


#: Arrow batches are cut at these bytes, so that long documents don't add up in a worker.
BATCH_BYTES = 8 << 20

_resident: dict = {}
_asked = [0]


def resident(kind: str, source, build: Callable):
    """What a Python worker keeps between tasks, built from ``source``: one thing at a time, so that a pipeline's stages don't pile up models in it."""
    _asked[0] += 1
    if _resident.get("kind") != kind or not (_resident["source"] is source or isinstance(source, (str, tuple)) and _resident["source"] == source):
        _resident.clear()
        _resident.update(kind=kind, source=source, built=build())
    return _resident["built"]


@contextlib.contextmanager
def uncollected():
    """No cyclic garbage collection meanwhile: it would walk the large tables of a worker again and again, and they hold no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def bounded(df: DataFrame) -> DataFrame:
    """The same rows; sets the session's byte limit for Arrow batches, unless a smaller one is set."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = df.sparkSession.conf.get(name, None)
    if have is None or not have.isdigit() or not 0 < int(have) <= BATCH_BYTES:
        df.sparkSession.conf.set(name, str(BATCH_BYTES))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def type_text(kind: DataType) -> str:
    """A type as text, names within it quoted."""
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {type_text(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, ArrayType):
        return f"array<{type_text(kind.elementType)}>"
    if isinstance(kind, MapType):
        return f"map<{type_text(kind.keyType)}, {type_text(kind.valueType)}>"
    return kind.simpleString()


def ddl(df: DataFrame) -> str:
    """The schema as text, names quoted."""
    return ", ".join(f"{quoted(f.name)} {type_text(f.dataType)}" for f in df.schema)


def arrow_schema(text: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(text))


def fold_of(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z only; every code point keeps its place."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows whose ``column`` has at most ``limit`` bytes together (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).cast(pa.large_binary())
        ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def map_text(df: DataFrame, columns: list[str], make: Callable[[], Callable[[dict], dict]], schema: str, text: str = "text", through: list[str] = ()) -> DataFrame:
    """Applies ``make()(columns as lists) -> columns as lists`` to bounded slices of whole rows; no shuffle. ``make`` runs once per task.

    Columns in ``through`` pass as they are; of these, only ``text`` is shown to ``make()``.
    """
    target, through = arrow_schema(schema), set(through)

    def run(batches):
        before = _asked[0]
        work = make()
        if _asked[0] == before:
            # a stage without a model lets go of the one before
            _resident.clear()
        for part in slices(batches, f"c{columns.index(text)}"):
            own = dict(zip(columns, part.columns, strict=True))
            with uncollected():
                got = work({name: c.to_pylist() for name, c in own.items() if name not in through or name == text})
            yield pa.RecordBatch.from_arrays([own[f.name].cast(f.type) if f.name in through else pa.array(got[f.name], f.type) for f in target], schema=target)

    return plainly(bounded(df), columns).mapInArrow(run, schema)


def plainly(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as c0, c1 and so on: mapInArrow takes no dots or quotes in names."""
    return df.select(*(F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(columns)))


def clear_of(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns of these names out of the way, and how to name them back."""
    taken, clash = {c.lower() for c in df.columns}, {}
    for c in [c for c in df.columns if c.lower() in names]:
        own = f"own {c}"
        while own.lower() in taken:
            own = f"own {own}"
        taken.add(own.lower())
        clash[own] = c
    return df.withColumnsRenamed({v: k for k, v in clash.items()}), clash


# ---- words as bytes -------------------------------------------------------------------------------------------------

#: x20 and x09-x0D, as in the pattern [^\x20\x09-\x0D]+ and in bytes.split().
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) * 2 + 1 for x in _random.integers(1 << 40, 1 << 62, 8)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; kept between calls up to a fixed length."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        base = _BASES[which]
        size = max(n, 1 << 16)
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= SLICE_BYTES + (1 << 18):
            _powers[which] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of several texts: byte spans in one buffer, a 64-bit hash of each word, the number of words per text."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join(texts)
        self.buffer = buf = np.frombuffer(data, np.uint8)
        edge = np.zeros(len(buf) + 2, np.int8)
        edge[1:-1] = ~SPACES[buf]
        edge = np.diff(edge)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.cumsum(sizes + 1) - (sizes + 1)
        at = np.searchsorted(self.starts, np.append(first, len(buf) + 1))
        #: Index of the first word of each text, and the total at the end.
        self.offsets = at
        self.counts = np.diff(at)

    def hashes(self) -> np.ndarray:
        """Computed for runs of words of about ``SLICE_BYTES``, so that temporary arrays don't grow with the texts."""
        out = np.zeros(len(self.starts), np.uint64)
        at = 0
        while at < len(out):
            first = int(self.starts[at])
            stop = max(at + 1, int(np.searchsorted(self.ends, first + SLICE_BYTES, "right")))
            last = int(self.ends[stop - 1])
            out[at:stop] = self._run(at, stop, first, last) if last - first <= SLICE_BYTES else self._long(first, last)
            at = stop
        return mix(out + (self.ends - self.starts).astype(np.uint64))

    def _run(self, at: int, stop: int, first: int, last: int) -> np.ndarray:
        up, down = powers(0, last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTE[self.buffer[first:last]] * up[: last - first], out=sums[1:])
        starts = self.starts[at:stop] - first
        return (sums[self.ends[at:stop] - first] - sums[starts]) * down[starts]

    def _long(self, first: int, last: int) -> np.uint64:
        """One word of over SLICE_BYTES, in parts."""
        total = 0
        for a in range(first, last, SLICE_BYTES):
            part = self.buffer[a : min(last, a + SLICE_BYTES)]
            own = int((_BYTE[part] * powers(0, len(part))[0][: len(part)]).sum(dtype=np.uint64))
            total += own * pow(_BASES[0], a - first, 1 << 64)
        return np.uint64(total & (1 << 64) - 1)


def windows(words: np.ndarray, width: int, which: int) -> np.ndarray:
    """Rolling (Rabin-Karp) hash of every run of ``width`` values, modulo 2**64."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = powers(which, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])
