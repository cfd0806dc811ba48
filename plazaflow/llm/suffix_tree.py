"""LM scoring with a probabilistic suffix tree over bytes, beside a unigram base over words.

Events of a text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+`` one space apart, then one end. The tree's symbols are the bytes of the
words, the space, and the end (a line feed, which no word has). A context is the up to ``DEPTH`` bytes before a symbol; line feeds stand
before the beginning. Training counts the symbols after every context over all training texts. Distributions are smoothed with ``PRIOR``
pseudo-counts of the distribution after the context without its first byte; the root covers all 256 bytes with half a count each.

A context is retained if its next-symbol distribution diverges from its parent's by ``LEAST_BITS`` bits a distinct symbol or more (count
times Kullback-Leibler divergence); that is the only test, so the tree grows with the corpus. A symbol is scored in the longest retained
suffix of what is before it.

Nothing of the model is collected or broadcast but the root's at most 256 symbols. Contexts with their symbols are rows of a table
(``grams``: the last ``DEPTH`` bytes and the symbol, in 48 bits), which Spark counts and scores with windows that lie in one partitioning by
the last three bytes before the symbol (2**24 rows a key at most). Texts meet the scores by ask and answer: units of rows ask hash buckets
about their distinct grams, and about their distinct words for the base (see exchange).

Training texts are those whose crc32(id as text) mod 10 is not 0; a null id is held out. Null text counts as empty: one end. With
nothing to train on, the base divides by 0.1 and the tree is its uniform root. An empty table gives an empty result; repeated rows are
scored alike and each counts in training. Only id and text are read, so other columns can't clash. A very long text is handled whole,
alone in its unit, in some 15 bytes a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import Words, bounded, fold_of, mix, slices
from .exchange import ask, bucket_count, scanned
from .scratch import Scratch

DEPTH = 5
LEAST_BITS = 4.0
PRIOR = 4.0
FOLDS = 10
#: Pseudo-counts of the base.
_ADD = 0.1
_END = b"\n"
#: Symbols, and texts, that are handled at once; a text's place in its run has the 16 bits that a gram leaves free.
_RUN = 1 << 22
_RUN_TEXTS = 1 << 16
#: The end as a token among hashes of words.
_END_HASH = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def grams_of(texts: list[bytes]) -> tuple[Iterator[np.ndarray], np.ndarray]:
    """Each symbol of these texts (words one space apart) with the DEPTH bytes before it, packed, in runs of ``_RUN`` symbols and
    ``_RUN_TEXTS`` texts at most; and where each text's begin."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    # a text's end is the first of the line feeds before the next
    stream = np.frombuffer(_END * DEPTH + (_END * DEPTH).join(texts) + _END, np.uint8)
    starts, total = np.cumsum(sizes) - sizes, int(sizes.sum())

    def runs():
        b = 0
        while b < total:
            a = b
            first = int(np.searchsorted(starts, a, "right")) - 1
            b = min(a + _RUN, int(starts[first + _RUN_TEXTS]) if first + _RUN_TEXTS < len(starts) else total, total)
            last = int(np.searchsorted(starts, b))
            piece = stream[a + (DEPTH - 1) * first : b + (DEPTH - 1) * (last - 1) + DEPTH].astype(np.uint64)
            # pairs of bytes, then four, then all six
            two = (piece[:-1] << np.uint64(8)) | piece[1:]
            grams = (two[:-2] << np.uint64(16)) | two[2:]
            grams = (grams[:-2] << np.uint64(16)) | two[4:]
            # what ends in the line feeds before a next text is none of its symbols
            own = np.ones(len(grams), bool)
            own[((starts[first + 1 : last] - a + (DEPTH - 1) * np.arange(last - first - 1))[:, None] + np.arange(DEPTH - 1)).ravel()] = False
            yield grams[own]

    return runs(), starts


def tally(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and their numbers; sorts ``values`` in place."""
    values.sort()
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[at], np.diff(np.append(at, len(values)))


def distinct_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, sorted, and their numbers."""
    parts = [tally(g) for g in grams_of(texts)[0]]
    if len(parts) == 1:
        return parts[0]
    return merged(parts)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of several (grams, numbers), sorted, and the sums of their numbers."""
    grams, n = np.concatenate([np.zeros(0, np.uint64), *(g for g, _ in parts)]), np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])
    order = np.argsort(grams, kind="stable")
    grams, n = grams[order], n[order]
    at = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
    return grams[at], np.add.reduceat(n, at) if len(at) else n


# ---- training -------------------------------------------------------------------------------------------------------


def _gram_counts(batches):
    """(gram, n) of slices of rows (trained, text): distinct grams with their number in training texts, 0 for those of held-out ones only."""
    held, size = [], 0

    def rows(grams, n):
        return pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(n)], ["gram", "n"])

    for part in slices(batches):
        texts = {True: [], False: []}
        for trained, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            texts[trained].append(b" ".join(tokens_of(t)))
        for trained, own in texts.items():
            if own:
                grams, n = distinct_grams(own)
                held.append((grams, n if trained else np.zeros(len(n), np.int64)))
                size += len(grams)
        if size > 1 << 20:
            held = [merged(held)]
            size = len(held[0][0])
            if size > 1 << 20:
                yield rows(*held[0])
                held, size = [], 0
    if held:
        yield rows(*merged(held))


def train(df: DataFrame, scratch: Scratch, trained: str = "trained", text: str = "text") -> DataFrame:
    """(gram, log): log10 of the probability of the gram's symbol after its bytes, for every gram of these rows, trained on those marked."""
    counted = bounded(df).select(F.col(trained).alias("trained"), F.col(text).alias("text")).mapInArrow(_gram_counts, "gram long, n long")
    grams = scratch.keep(counted.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    return scored(grams, scratch)


def scored(grams: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, log) from (gram, n)."""
    low = lambda n: F.col("gram").bitwiseAND((1 << 8 * n) - 1)  # noqa: E731  the last n bytes: a symbol and the n - 1 before it
    before = lambda n: F.shiftright(low(n + 1), 8)  # noqa: E731  the last n bytes before the symbol
    n = F.col("n")

    def level(df, depth, keys, parent):
        """Adds p{depth}, smoothed with column ``parent``, and best: that of the longest retained context so far."""
        symbol = W.partitionBy(*keys, "symbol")
        df = df.withColumn("of", F.sum("n").over(symbol)).withColumn("rows", F.count(F.when(n > 0, 1)).over(symbol))
        whole = W.partitionBy(*keys)
        df = df.withColumn("all", F.sum("n").over(whole))
        # each row has its part of its symbol's count, so sums over rows are sums over distinct symbols
        gain = F.sum(F.when(n > 0, n * F.log2(F.col("of") / F.col("all") / F.col(parent)))).over(whole)
        kinds = F.round(F.sum(F.when(n > 0, 1 / F.col("rows"))).over(whole))
        df = df.withColumn("gain", gain).withColumn("kinds", kinds)
        df = df.withColumn(f"p{depth}", (F.col("of") + PRIOR * F.col(parent)) / (F.col("all") + PRIOR))
        retained = F.coalesce(F.col("gain") >= LEAST_BITS * F.col("kinds"), F.lit(False))
        return df.withColumn("best", F.when(retained, F.col(f"p{depth}")).otherwise(F.col("best"))).drop("of", "rows", "all", "gain", "kinds")

    # contexts of up to two bytes: 2**24 rows at most, in one partitioning by the last byte before the symbol
    short = scratch.keep(grams.groupBy(low(3).alias("gram")).agg(F.sum("n").alias("n")), "short")
    root = short.groupBy(low(1).alias("symbol")).agg(F.sum("n").alias("c"))
    total = F.coalesce(F.sum("c").over(W.partitionBy()), F.lit(0))
    root = root.select("symbol", ((F.col("c") + 0.5) / (total + 128)).alias("p0"))
    short = short.withColumn("symbol", low(1)).join(F.broadcast(root), "symbol").withColumn("best", F.col("p0"))
    short = short.withColumn("c1", before(1)).repartition("c1")
    short = level(level(short, 1, ["c1"], "p0").withColumn("c2", before(2)), 2, ["c1", "c2"], "p1")
    short = scratch.keep(short.select(F.col("gram").alias("last"), "p2", "best"), "short-scores")
    # longer ones, in one partitioning by the last three bytes
    long = grams.withColumn("last", low(3)).join(short, "last").withColumn("symbol", low(1)).withColumn("c3", before(3)).repartition("c3")
    long = level(long, 3, ["c3"], "p2").withColumn("c4", before(4))
    long = level(long, 4, ["c3", "c4"], "p3").withColumn("c5", before(5))
    long = level(long, 5, ["c3", "c5"], "p4")
    return scratch.keep(long.select("gram", F.log10("best").cast("float").alias("log")), "scores")


# ---- scoring --------------------------------------------------------------------------------------------------------


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


class _Unit:
    """Distinct tokens and grams of a unit, sorted, and their buckets."""

    def __init__(self, batch: pa.RecordBatch, buckets: int, summed: bool = False):
        self.texts = [b" ".join(tokens_of(t)) for t in batch.column(2).to_pylist()]
        words = Words(self.texts)
        self.counts = words.counts
        codes, kinds = pd.factorize(np.insert(words.hashes(), words.offsets[1:], _END_HASH))
        order = np.argsort(kinds)
        self.tokens, place = kinds[order], np.empty(len(kinds), np.int64)
        place[order] = np.arange(len(kinds))
        #: Which of the distinct tokens stands where.
        self.all = place[codes]
        runs, self.starts = grams_of(self.texts)
        #: With ``summed``, for each run: its first text; for each gram of a text the text's place and the number; the distinct grams and how many texts each is in.
        self.places, found, at = [], [], 0
        for grams in runs:
            size = len(grams)
            if summed:
                first = int(np.searchsorted(self.starts, at, "right")) - 1
                cuts = np.concatenate([[at], self.starts[first + 1 : int(np.searchsorted(self.starts, at + size))], [at + size]])
                grams <<= np.uint64(16)
                grams |= np.repeat(np.arange(len(cuts) - 1, dtype=np.uint64), np.diff(cuts))
                pairs, times = tally(grams)
                own = pairs.astype(np.uint16)
                pairs >>= np.uint64(16)
                kinds, rows = tally(pairs)
                self.places.append((first, own, times.astype(np.int32), kinds, rows))
                found.append(kinds)
            else:
                found.append(tally(grams)[0])
            at += size
        self.grams = found[0] if len(found) == 1 else tally(np.concatenate([np.zeros(0, np.uint64), *found]))[0]
        self.by_token, self.token_bounds = self._dealt(self.tokens, buckets)
        self.by_gram, self.gram_bounds = self._dealt(mix(self.grams), buckets)

    @staticmethod
    def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys' places in the order of their buckets, and where each bucket's begin; few bits sort faster."""
        at = _bucket(keys, buckets).astype(np.min_scalar_type(buckets))
        return np.argsort(at, kind="stable"), np.append(0, np.cumsum(np.bincount(at, minlength=buckets)))

    def trained(self, marks: np.ndarray) -> np.ndarray:
        """How often each distinct token stands in rows with the mark."""
        return np.bincount(self.all[np.repeat(marks, self.counts + 1)], minlength=len(self.tokens)).astype(np.uint32)

    def sums(self, logs: np.ndarray) -> np.ndarray:
        """For each text the sum of its grams' scores, added in the order of the grams."""
        out = np.zeros(len(self.starts))
        for first, own, times, kinds, rows in self.places:
            of = logs if len(self.places) == 1 else logs[np.searchsorted(self.grams, kinds)]
            got = np.bincount(own, times * np.repeat(of.astype(np.float64), rows))
            out[first : first + len(got)] += got
        return out

    def parts(self):
        """(bucket, its tokens' places, its grams' places) for the buckets that have any."""
        some = (np.diff(self.token_bounds) > 0) | (np.diff(self.gram_bounds) > 0)
        for k in np.flatnonzero(some).tolist():
            yield k, self.by_token[self.token_bounds[k] : self.token_bounds[k + 1]], self.by_gram[self.gram_bounds[k] : self.gram_bounds[k + 1]]


def _block(tokens: np.ndarray, trained: np.ndarray, grams: np.ndarray) -> bytes:
    """Number of tokens, tokens, their training counts, grams of six bytes."""
    return np.uint64(len(tokens)).tobytes() + tokens.tobytes() + trained.tobytes() + _six(grams)


def _six(grams: np.ndarray) -> bytes:
    return np.ascontiguousarray(grams).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _tokens_in(block) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(block, np.uint64, 1)[0])
    return np.frombuffer(block, np.uint64, n, 8), np.frombuffer(block, np.uint32, n, 8 + 8 * n)


def _grams_in(block, at: int) -> np.ndarray:
    packed = np.frombuffer(block, np.uint8, len(block) - at, at).reshape(-1, 6)
    out = np.zeros((len(packed), 8), np.uint8)
    out[:, :6] = packed
    return out.view(np.uint64).ravel()


def _token_sums(blocks: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training counts of distinct tokens, and where each asked token stands among them."""
    parts = [_tokens_in(b) for b in blocks]
    tokens = np.concatenate([t for t, _ in parts])
    counts = np.concatenate([c for _, c in parts]).astype(np.int64)
    order = np.argsort(tokens, kind="stable")
    ordered = tokens[order]
    group = np.cumsum(np.append(True, ordered[1:] != ordered[:-1])) - 1 if len(order) else np.zeros(0, np.int64)
    sums = np.bincount(group, counts[order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    back = np.empty(len(order), np.int64)
    back[order] = group
    return sums, back, np.array([len(t) for t, _ in parts])


def _totals(blocks: list) -> tuple[int, int]:
    """Tokens and distinct tokens of training in this bucket."""
    sums = _token_sums(blocks)[0]
    return int(sums.sum()), int((sums > 0).sum())


def _answers(blocks: list, scores: list) -> list[bytes]:
    """For each block the training count of each token, 8 bytes each, and the score of each gram, 4 bytes each."""
    sums, back, sizes = _token_sums(blocks)
    counts = np.split(sums[back], np.cumsum(sizes)[:-1])
    parts = [(np.frombuffer(b, np.uint64, 1), b) for b in scores]
    known = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(b, np.uint64, int(n[0]), 8) for n, b in parts)])
    logs = np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(b, np.float32, int(n[0]), 8 + 8 * int(n[0])) for n, b in parts)])
    order = np.argsort(known)
    known, logs = known[order], logs[order]
    out = []
    for block, size, own in zip(blocks, sizes, counts, strict=True):
        grams = _grams_in(block, 8 + 12 * size)
        at = np.searchsorted(known, grams)
        if len(grams) and (not len(known) or at[-1] >= len(known) or (known[at] != grams).any()):
            raise ValueError("a gram has no score: the rows differ when read again")
        out.append(own.tobytes() + logs[at].tobytes())
    return out


def _by_bucket(scores: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block): number of grams, grams, scores."""

    def run(batches):
        for batch in batches:
            grams, logs = np.asarray(batch.column(0)).astype(np.uint64), np.asarray(batch.column(1))
            at = _bucket(mix(grams), buckets)
            order = np.argsort(at, kind="stable")
            grams, logs, at = grams[order], logs[order], at[order]
            cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
            blocks = [np.uint64(b - a).tobytes() + grams[a:b].tobytes() + logs[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(at)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at[cuts].astype(np.int32)), pa.array(blocks, pa.binary())], ["bucket", "block"])

    return scores.mapInArrow(run, "bucket int, block binary")


def score(df: DataFrame, id_column: str = "doc_id", text: str = "text", buckets: int | None = None, unit_bytes: int | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    held = F.coalesce(fold_of(id_column, FOLDS) == 0, F.lit(True))
    rows = scanned(df.select(F.col(id_column), (~held).alias("trained"), F.col(text)))
    n = bucket_count(rows, text, buckets)
    scores = train(rows, Scratch(df.sparkSession), "trained", text)

    def keys(batch, n):
        unit = _Unit(batch, n)
        trained = unit.trained(np.asarray(batch.column(1)))
        return {k: _block(unit.tokens[t], trained[t], unit.grams[g]) for k, t, g in unit.parts()}

    def finish(batch, answers):
        unit = _Unit(batch, n, summed=True)
        counts, logs = np.zeros(len(unit.tokens), np.int64), np.zeros(len(unit.grams), np.float32)
        seen = 0
        for k, t, g in unit.parts():
            if k not in answers or len(answers[k]) != 8 * len(t) + 4 * len(g):
                raise ValueError("a unit met answers for other keys: its rows came in another order when read again")
            counts[t] = np.frombuffer(answers[k], np.int64, len(t))
            logs[g] = np.frombuffer(answers[k], np.float32, len(g), 8 * len(t))
            seen += 1
        if seen != len(answers):
            raise ValueError("a unit met answers that it didn't ask for: its rows came in another order when read again")
        sizes = unit.counts + 1
        at = np.cumsum(sizes) - sizes
        part = np.add.reduceat(np.log10(counts + _ADD)[unit.all], at)
        known = np.add.reduceat((counts > 0).astype(np.int64)[unit.all], at)
        got = unit.sums(logs)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(~np.asarray(batch.column(1))), pa.array(sizes), pa.array(known), pa.array(part), pa.array(got)], [id_column, "held_out", "n_tokens", "n_known", "part", "score"])

    schema = f"{id_column} {df.schema[id_column].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, part double, score double"
    done, heads = ask(rows, keys, _answers, finish, schema, n, text=text, unit_bytes=unit_bytes, side=_by_bucket(scores, n), heads=_totals)
    # one row: all tokens of training and the distinct ones
    totals = heads.agg(F.struct(F.coalesce(F.sum("a"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("b"), F.lit(0)).alias("kinds")).alias("of")).scalar()
    done = done.withColumn("of", totals)
    base = F.col("part") - F.col("n_tokens") * F.log10(F.col("of.tokens") + _ADD * (F.col("of.kinds") + 1))
    return done.select(id_column, "held_out", "n_tokens", "n_known", F.col("of.tokens").alias("train_tokens"), base.alias("base_score"), "score")
