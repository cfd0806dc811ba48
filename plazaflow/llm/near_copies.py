"""Near-dedup of the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are near copies.

Words as in op10: A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``; fewer than five words are one shingle, none is the empty one. Shingles are
compared as 64-bit hashes.

Exact copies meet first as one node, the XXH64 of the text. Candidates come from two sources, and each is confirmed by the exact
similarity before it counts as a link:

1. op10's links (SimHash, pigeonring chains, three bits), and texts of one fingerprint. They join most copies.
2. What three bits miss: ``BANDS`` x ``ROWS`` minimum hashes a text; a pair is a candidate if all minima of some band agree, which at
   similarity 0.8 fails for (1 - 0.8**5)**20 = 0.04 % of pairs, for fewer above. Each node first meets one partner, the smallest of its
   bands; then only bands whose members still stand in several components are compared further, each set of members once.

Such a band is compared inside a task on sets of hashes and gives a forest (at most one link a node), never all pairs. Bands of over
``BLOCK`` members are cut into blocks, and every two blocks meet in a task of their own, so that no task holds over about two blocks.

Null text counts as empty. An empty table gives an empty result. A very long text is one set of eight bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from ._common import Words, map_text, mix, windows
from .components import components
from .scratch import Scratch

WIDTH = 5
BANDS, ROWS = 20, 5
#: Members of a band that are compared with each other in one task.
BLOCK = 512
#: Rows of eight bytes that may be broadcast, counted first; more meet by a shuffle.
_FEW = 1_000_000
_random = np.random.Generator(np.random.PCG64(20240301))
_FACTORS = _random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, one text after the other, and where each text's begin (with the end of the last)."""
    words = Words([(t or "").encode().lower() for t in texts])
    hashes, counts = words.hashes(), words.counts
    sizes = np.maximum(counts - WIDTH + 1, 1)
    bounds = np.append(0, np.cumsum(sizes))
    out = np.zeros(bounds[-1], np.uint64)
    long = np.flatnonzero(counts >= WIDTH)
    if len(long):
        runs = sizes[long]
        step = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        out[np.repeat(bounds[long], runs) + step] = windows(hashes, WIDTH, 1)[np.repeat(words.offsets[long], runs) + step]
    for k in np.flatnonzero((counts > 0) & (counts < WIDTH)):
        out[bounds[k]] = windows(hashes[words.offsets[k] : words.offsets[k] + counts[k]], int(counts[k]), 1)[0]
    return out, bounds


def _bands(texts: list[str | None]) -> list[np.ndarray]:
    """One key a band and text; equal keys have equal minima."""
    hashes, bounds = shingles(texts)
    keys = np.empty((len(texts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(texts), band + 1, np.uint64)
        for factor in _FACTORS[band * ROWS : (band + 1) * ROWS]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(mix(hashes * factor), bounds[:-1]))
        keys[:, band] = key
    return list(keys.view(np.int64))


def _sets(texts: list[str | None]) -> list[np.ndarray]:
    hashes, bounds = shingles(texts)
    return [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(bounds, bounds[1:], strict=False)]


def _few(df: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= _FEW else df


def _with_sets(wanted: DataFrame, nodes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, set) for the nodes in ``wanted``; ``nodes`` has (node, text) with repeats."""
    wanted = scratch.keep(wanted.select("node").distinct(), f"{name}-wanted")
    texts = nodes.join(_few(wanted), "node", "left_semi").groupBy("node").agg(F.any_value("text").alias("text"))
    return scratch.keep(map_text(texts, ["node", "text"], lambda: lambda rows: {"node": rows["node"], "set": _sets(rows["text"])}, "node long, set array<long>"), f"{name}-sets")


def _confirmed(pairs: DataFrame, nodes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b), at most one for each b, that are similar enough."""
    pairs = scratch.keep(pairs, f"{name}-pairs")
    sets = _with_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), nodes, scratch, name)
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    # common / (x + y - common) >= 0.8 in whole numbers
    found = scratch.keep(both.where(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("a", "b"), f"{name}-links")
    scratch.drop(f"{name}-sets")
    return found


def forest(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that, with the known roots, connect all pairs of these nodes that are similar enough; at most one for each node."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    here = np.zeros(int(ids.max(initial=-1)) + 1, bool)
    open_, out = np.ones(len(nodes), bool), []
    for first in range(len(nodes)):
        if not open_[first]:
            continue
        todo = np.flatnonzero(open_ & (roots == roots[first])).tolist()
        open_[todo] = False
        while todo:
            one = todo.pop()
            # sizes of similar sets differ by a fifth at most
            rest = np.flatnonzero(open_ & (5 * sizes >= 4 * sizes[one]) & (4 * sizes <= 5 * sizes[one]))
            if not len(rest):
                continue
            own = ids[starts[one] : ends[one]]
            here[own] = True
            total, runs = np.cumsum(np.append(0, sizes[rest])), sizes[rest]
            common = np.add.reduceat(here[ids[np.arange(total[-1]) + np.repeat(starts[rest] - total[:-1], runs)]].astype(np.int64), total[:-1])
            here[own] = False
            for hit in rest[9 * common >= 4 * (sizes[one] + runs)].tolist():
                if open_[hit]:
                    out.append((int(nodes[one]), int(nodes[hit])))
                    more = np.flatnonzero(open_ & (roots == roots[hit]))
                    open_[more] = False
                    todo += more.tolist()
    return out


def _compared(t: pa.Table) -> pa.Table:
    sets = t["set"].combine_chunks()
    flat, cuts = np.asarray(sets.values), np.asarray(sets.offsets)
    links = forest(np.asarray(t["node"]), np.asarray(t["root"]), [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _within_bands(split: DataFrame, nodes: DataFrame, scratch: Scratch, block: int) -> DataFrame:
    """(a, b): confirmed links across components; ``split`` has (key, node, root) of bands whose members stand in several components."""
    # bands with the same members are compared once: same number, sum and exclusive-or of two hashes
    alike = split.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x"))
    once = scratch.keep(alike.groupBy("n", "s", "x").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "once")
    members = split.join(once, "key")
    sets = _with_sets(members, nodes, scratch, "bands")
    own = F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks")).cast("int")
    met = members.select("key", "node", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "node", "root")
    return scratch.keep(met.join(sets, "node").groupBy("cell").applyInArrow(_compared, "a long, b long"), "bands-links")


def roots(nodes: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """(node, root) for the nodes that have a near copy; ``nodes`` has (node, text) with repeats."""

    def make():
        def work(rows):
            return {"node": rows["node"], "fp": [int.from_bytes(simhash.fingerprint(t), "big", signed=True) for t in rows["text"]], "bands": _bands(rows["text"])}

        return work

    marked = map_text(nodes, ["node", "text"], make, "node long, fp long, bands array<long>")
    marked = scratch.keep(marked.groupBy("node").agg(F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands")), "marked")

    prints = scratch.keep(marked.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    of = lambda c: prints.select(F.col("fp").alias(c), F.col("first").alias(f"first {c}"))
    links = simhash.links(prints.select("fp"), scratch).join(of("a"), "a").join(of("b"), "b").select(F.least("first a", "first b").alias("a"), F.greatest("first a", "first b").alias("b"))
    same = marked.join(prints, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = links.union(same).groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = _confirmed(links, nodes, scratch, "prints")
    found = components(links, Scratch(nodes.sparkSession))

    keyed = marked.select(F.explode("bands").alias("key"), "node")
    ends = scratch.keep(keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key", "low"), "ends")
    shared = scratch.keep(keyed.join(ends, "key"), "shared")

    def apart(found):
        """Members of the bands that are still in several components, with their roots."""
        members = scratch.keep(shared.join(found, "node", "left").select("key", "node", "low", F.coalesce("root", "node").alias("root")), f"members-{len(parts)}")
        split = members.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key")
        return scratch.keep(members.join(split, "key", "left_semi"), f"split-{len(parts)}")

    parts = [links]
    stars = apart(found).where("node <> low").groupBy(F.col("node").alias("b")).agg(F.min("low").alias("a")).select("a", "b")
    parts.append(_confirmed(stars, nodes, scratch, "stars"))
    found = components(parts[0].union(parts[1]), Scratch(nodes.sparkSession))
    split = apart(found)
    if split.isEmpty():
        return found
    more = _within_bands(split.select("key", "node", "root"), nodes, scratch, block)
    return found if more.isEmpty() else components(parts[0].union(parts[1]).union(more), Scratch(nodes.sparkSession))


def keep_one(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component the row with the smallest id (a null id comes last, the smallest node on ties) stays; all columns stay.

    Rows are told apart by id and text: rows of several components may share an id, and a row that repeats both counts once.
    """
    scratch = Scratch(df.sparkSession)
    node = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = scratch.keep(df.select(F.col(id_column).alias("id"), node.alias("node")).groupBy("id", "node").agg(F.count(F.lit(1)).alias("rows")), "rows")
    found = roots(df.select(node.alias("node"), F.coalesce(F.col(text), F.lit("")).alias("text")), scratch)
    first = rows.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "node")).alias("row"))
    first = first.join(found, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("row").alias("row"))
    stay = scratch.keep(first.select(F.col("row.id").alias("own id"), F.col("row.node").alias("own node")), "stay")
    is_it = F.col("id").eqNullSafe(F.col("own id")) & (F.col("node") == F.col("own node"))
    gone = scratch.keep(rows.join(stay, is_it, "left_anti").select(F.col("id").alias("own id"), F.col("node").alias("own node")), "gone")
    # those that go are usually few; their ids and nodes are all that is sent
    kept = df.join(_few(gone), F.col(id_column).eqNullSafe(F.col("own id")) & (node == F.col("own node")), "left_anti")
    if not rows.where("rows > 1").isEmpty():
        kept = kept.withColumn("own node", node).dropDuplicates([id_column, "own node"]).drop("own node")
    return kept
