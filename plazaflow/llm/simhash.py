"""SimHash near-dedup with pigeonring candidates.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, 3-word shingles with repeats (fewer words: the whole sequence; none:
fingerprint zero), XXH64 with seed 42 of each; a bit is 1 if set in over half of them. Fingerprints link at ``MOST`` = 3 or fewer
differing bits, and linked documents form components.

Candidates: the 64 bits stand on a ring of 8 segments. If two fingerprints differ in 3 bits at most, some segment starts a chain all of
whose prefixes of l segments differ in at most 3l/8 bits: two segments in none, five in one, seven in two, eight in three. The key of a
start is its 16 equal bits and one half of the next 24 (of which at most one bit differs, so one half is equal): 16 keys of 28 bits a
fingerprint. Under a key, pairs are pruned by the chain's budgets before the full comparison.

Exact copies meet first as one fingerprint, so keys see distinct ones. A key emits a forest (at most one link a fingerprint), never all
pairs. Keys with over ``HOT`` fingerprints are cut finer: of the 36 bits left, at most 3 differ, so one of four parts is equal, and the
key goes on with each part; after two cuts no more than 2**20 fingerprints can share one.

Null text counts as empty. A null id is never the smallest; a document that reaches no id has a null component. Repeated rows give
repeated rows. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from ._common import map_text
from .components import components
from .scratch import Scratch

MOST = 3
HOT = 1_000_000
#: Fingerprints of one key that are compared one with all; more are cut finer first, in the task.
_PLAIN = 2048
#: Shingles whose bits are counted at once.
_BLOCK = 1 << 14


def fingerprint(text: str | None) -> bytes:
    """Eight bytes, most significant first."""
    words = (text or "").encode().lower().split()
    if not words:
        return bytes(8)
    shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False)) if len(words) > 2 else [b" ".join(words)]
    digests = np.frombuffer(b"".join([xxh64_digest(s, 42) for s in shingles]), np.uint8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(digests), 8 * _BLOCK):
        ones += np.unpackbits(digests[at : at + 8 * _BLOCK]).reshape(-1, 64).sum(0, dtype=np.uint32)
    return np.packbits(2 * ones > len(digests) // 8).tobytes()


def fingerprints(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp long) for every row."""

    def make():
        last: list = [None, None]

        def one(t):
            if t != last[0] or last[1] is None:
                last[:] = t, int.from_bytes(fingerprint(t), "big", signed=True)
            return last[1]

        return lambda rows: {id_column: rows[id_column], "fp": [one(t) for t in rows[text]]}

    return map_text(df, [id_column, text], make, f"{id_column} {df.schema[id_column].dataType.simpleString()}, fp long", text)


# ---- candidates -----------------------------------------------------------------------------------------------------


def _keyed(distinct: DataFrame) -> DataFrame:
    """(key, rest, fp): 16 rows a fingerprint; rest holds the 36 bits that are not in the key."""
    low = lambda x, n: x.bitwiseAND((1 << n) - 1)
    out = []
    for start in range(8):
        fp = F.col("fp")
        ring = fp if not start else F.shiftleft(fp, 8 * start).bitwiseOR(F.shiftrightunsigned(fp, 64 - 8 * start))
        head = F.shiftrightunsigned(ring, 48)
        for half in range(2):
            own = low(F.shiftrightunsigned(ring, 36 - 12 * half), 12)
            rest = low(ring, 36) if not half else F.shiftleft(low(F.shiftrightunsigned(ring, 36), 12), 24).bitwiseOR(low(ring, 24))
            key = F.lit((2 * start + half) << 28).cast("long").bitwiseOR(F.shiftleft(head, 12)).bitwiseOR(own)
            out.append(F.struct(key.alias("key"), rest.alias("rest")))
    return distinct.select("fp", F.explode(F.array(*out)).alias("x")).select("x.key", "x.rest", "fp")


def _finer(keyed: DataFrame, bits: int) -> DataFrame:
    """The rows under four longer keys each: one of four parts of the ``bits`` left joins the key."""
    out, cuts = [], [bits * k // 4 for k in range(5)]
    for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        value = F.shiftrightunsigned("rest", a).bitwiseAND((1 << (b - a)) - 1)
        rest = F.shiftleft(F.shiftrightunsigned("rest", b), a).bitwiseOR(F.col("rest").bitwiseAND((1 << a) - 1))
        out.append(F.struct(F.shiftleft(F.shiftleft("key", 2).bitwiseOR(part), b - a).bitwiseOR(value).alias("key"), rest.alias("rest")))
    return keyed.select("fp", "start", F.explode(F.array(*out)).alias("x")).select("x.key", "x.rest", "fp", "start")


def _near(one: np.ndarray, others: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Which pairs hold the budgets of the chain that starts at segment ``start`` (its first two segments are equal by key), then the limit."""
    x = one ^ others
    turn = np.uint64(8) * np.asarray(start, np.uint64)
    x = (x << turn) | (x >> ((np.uint64(64) - turn) & np.uint64(63)))
    return (np.bitwise_count(x >> np.uint64(24)) <= 1) & (np.bitwise_count(x >> np.uint64(8)) <= 2) & (np.bitwise_count(x) <= MOST)


def _forest(fps: np.ndarray, start: int, masks: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what is linked within one key: each member of a cluster to its first one."""
    if len(fps) > _PLAIN:
        # of the bits that differ anywhere, at most three differ in a pair: one of four parts is equal
        varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
        bits = [k for k in range(64) if varying >> k & 1]
        if len(bits) >= 8:
            out = []
            for part in range(4):
                mask = np.uint64(sum(1 << k for k in bits[part::4]))
                order = np.argsort(fps & mask, kind="stable")
                cuts = np.flatnonzero(np.diff(fps[order] & mask)) + 1
                for group in np.split(fps[order], cuts):
                    if len(group) > 1:
                        out += _forest(group, start)
            return out
    out, rest = [], fps
    while len(rest) > 1:
        first, todo, rest = int(rest[0]), [rest[0]], rest[1:]
        while todo and len(rest):
            hit = _near(todo.pop(), rest, start)
            found = rest[hit]
            out += [(first, x) for x in found.tolist()]
            todo += list(found)
            rest = rest[~hit]
    return out


def _linked(batches):
    """Links of rows that come sorted by key. Many small groups are handled at once."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]

    def links(key, fp, start):
        a, b = [], []
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        sizes = np.diff(np.append(at, len(key)))
        for k in np.flatnonzero(sizes > 16):
            found = _forest(fp[at[k] : at[k] + sizes[k]], int(start[at[k]]))
            a += [x for x, _ in found]
            b += [x for _, x in found]
        size, label = np.repeat(sizes, sizes), np.arange(len(key))
        pairs = []
        for d in range(1, int(min(16, sizes.max(initial=1)))):
            i = np.flatnonzero((key[d:] == key[:-d]) & (size[d:] <= 16))
            i = i[_near(fp[i], fp[i + d], start[i])]
            pairs.append(np.stack([i, i + d]))
        i, j = np.concatenate(pairs, 1) if pairs else np.zeros((2, 0), np.int64)
        while True:
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            if np.array_equal(before, label):
                break
        own = np.flatnonzero(label != np.arange(len(key)))
        a = np.concatenate([np.array(a, np.uint64), fp[label[own]]]).view(np.int64)
        b = np.concatenate([np.array(b, np.uint64), fp[own]]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        got = [np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64), np.asarray(batch.column(2)).astype(np.int64)]
        held = [np.concatenate([x, y]) for x, y in zip(held, got, strict=True)]
        if len(held[0]) < 1 << 16:
            continue
        cut = int(np.searchsorted(held[0], held[0][-1]))
        if cut:
            yield links(*(x[:cut] for x in held))
            held = [x[cut:].copy() for x in held]
    if len(held[0]):
        yield links(*held)


def links(distinct: DataFrame, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that connect all those at 3 or fewer differing bits."""
    keyed = _keyed(distinct).withColumn("start", F.shiftright("key", 29).cast("int"))
    parts = []
    for bits in (36, 27):
        many = scratch.keep(keyed.groupBy("key").count().where(F.col("count") > hot).select("key"), f"hot-{bits}")
        n = many.count()
        if not n:
            break
        many = F.broadcast(many) if n <= 1_000_000 else many
        parts.append(keyed.join(many, "key", "left_anti"))
        keyed = _finer(keyed.join(many, "key", "left_semi").select("key", "rest", "fp", "start"), bits)
    parts.append(keyed)
    out = [p.select("key", "fp", "start").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_linked, "a long, b long") for p in parts]
    found = out[0]
    for x in out[1:]:
        found = found.union(x)
    return found


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(id, fp long, component_id) for every row."""
    scratch = Scratch(df.sparkSession)
    prints = scratch.keep(fingerprints(df, id_column, text), "fingerprints")
    distinct = scratch.keep(prints.groupBy("fp").agg(F.min(id_column).alias("first_id")), "distinct")
    roots = components(links(distinct, scratch, hot), scratch).select(F.col("node").alias("fp"), "root")
    members = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    members = scratch.keep(members, "members")
    smallest = scratch.keep(members.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    known = scratch.keep(members.join(smallest, "root").select("fp", "component_id"), "known")
    return prints.join(known, "fp").select(id_column, "fp", "component_id")


def report(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return found.select(id_column, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
