"""Language ID, word first: known words score by their log frequency in each language, unseen words back off to shorter and shorter character n-grams.

The model is fitted on a bounded sample: ``SAMPLE_ROWS`` labelled training rows at most, those with the smallest hashes of id, text and
label (rows that repeat all three count once), whole texts. The bound on the sample is the only one: every word and every n-gram of 1 to
``LONGEST`` characters in it is kept, and the tables made of them are what is collected and broadcast. Training rows are those whose
crc32(id as text) mod 5 is not 0; the label column is read for those only, and never at prediction. A row with a null id is held out.

A word is a run of letters of any script, lower-cased. Text that is null or has no letter is ``und`` with score 0; so is every text if no
row is labelled. Ties go to the language that sorts first. The score is the softmax share of the language, with the sum of log
frequencies damped by the root of the number of words. An empty table gives an empty result; repeated rows are judged alike; a very long
text is judged whole, word by word.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import bounded, clear_of, ddl, fold_of, map_text, quoted, resident, slices

SAMPLE_ROWS = 4000
LONGEST = 5
FOLDS = 5
#: The pipeline rejects a document below this score, or without letters.
LEAST_SCORE = 0.3
_CACHE = 100_000
_SMOOTH = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _grams(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


class Model:
    """Tables by n-gram length; 0 stands for whole words. Vectors are log frequencies by language."""

    def __init__(self, langs: list[str], tables: dict[int, tuple[list[str], np.ndarray]]):
        self.langs, self.source = langs, tables
        #: Of n-grams, by length: row numbers in one matrix of all.
        self.grams, parts, at = {}, [np.zeros((1, len(langs)), np.float32)], 1
        for n in range(1, LONGEST + 1):
            known, matrix = tables.get(n, ([], parts[0][:0]))
            if known:
                self.grams[n] = dict(zip(known, range(at, at + len(known)), strict=True))
                parts.append(matrix)
                at += len(known)
        self.matrix = np.concatenate(parts)
        #: Row numbers in ``vectors``: the known words for good, unseen ones (``added``) until there are too many.
        words, first = tables.get(0, ([], parts[0][:0]))
        self.known = len(words)
        self.cache, self.vectors, self.added = dict(zip(words, range(len(words)), strict=True)), first, []

    def backed_off(self, word: str) -> list[int]:
        """Of a word that isn't known: the rows of its n-grams of the longest length that has any; row 0, of zeros, if none has."""
        w = f"^{word}$"
        for n in range(min(LONGEST, len(w)), 0, -1):
            if n in self.grams:
                rows = self.grams[n]
                if found := [rows[g] for k in range(len(w) - n + 1) if (g := w[k : k + n]) in rows]:
                    return found
        return [0]

    def rows_of(self, words: list[list[str]]) -> list[np.ndarray]:
        """Row numbers in ``vectors`` of each text's words."""
        new = set().union(*words).difference(self.cache)
        if len(self.added) + len(new) > _CACHE:
            for w in self.added:
                del self.cache[w]
            self.vectors, self.added = self.vectors[: self.known], []
            new = set().union(*words).difference(self.cache)
        if new:
            at = len(self.vectors)
            self.cache.update(zip(new, range(at, at + len(new)), strict=True))
            self.added += new
            found = [self.backed_off(w) for w in new]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            more = np.add.reduceat(self.matrix[np.concatenate(found)], np.cumsum(sizes) - sizes, 0) / sizes[:, None]
            self.vectors = np.concatenate([self.vectors, more.astype(np.float32)])
        find = self.cache.__getitem__
        return [np.fromiter(map(find, w), np.int64, len(w)) for w in words]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [words_of(t) if t and any(c.isalpha() for c in t) else [] for t in texts]
        out = []
        for rows in self.rows_of(words):
            if not len(rows) or not self.langs:
                out.append(("und", 0.0))
                continue
            total = self.vectors[rows].sum(0, dtype=np.float64) / np.sqrt(len(rows))
            share = np.exp(total - total.max())
            best = int(np.argmax(share))
            out.append((self.langs[best], float(share[best] / share.sum())))
        return out


def fit(df: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Counts words and n-grams of the sample in Spark; what is collected are these counts."""
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (fold_of(id_column, FOLDS) != 0))
    labelled = labelled.select(F.xxhash64(id_column, text, label).alias("order"), F.col(label).cast("string").alias("lang"), F.col(text).alias("text"))
    least = labelled.select("order").distinct().orderBy("order").limit(sample_rows).agg(F.max("order")).first()[0]
    if least is None:
        return Model([], {})
    sample = labelled.where(F.col("order") <= least).groupBy("order").agg(F.first("lang").alias("lang"), F.first("text").alias("text")).select("lang", "text")

    def count(batches):
        for part in slices(batches):
            found: dict[str, Counter] = {}
            for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(words_of(t))
            rows = []
            for lang, words in found.items():
                by = {n: Counter() for n in range(1, LONGEST + 1)}
                for w, c in words.items():
                    for n, grams in by.items():
                        for g in _grams(w, n):
                            grams[g] += c
                rows += [(lang, 0, w, c) for w, c in words.items()]
                rows += [(lang, n, g, c) for n, grams in by.items() for g, c in grams.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["lang", "n", "gram", "c"])

    counts = bounded(sample).mapInArrow(count, "lang string, n long, gram string, c long").groupBy("lang", "n", "gram").agg(F.sum("c").alias("c")).toArrow()
    langs = sorted(set(counts["lang"].to_pylist()))
    tables: dict[int, tuple[list[str], np.ndarray]] = {}
    for n in range(LONGEST + 1):
        own = counts.filter(pc.equal(counts["n"], n))
        grams = own["gram"].combine_chunks().dictionary_encode()
        seen = np.zeros((len(grams.dictionary), len(langs)))
        seen[np.asarray(grams.indices), np.array([langs.index(x) for x in own["lang"].to_pylist()], np.int64)] = np.asarray(own["c"])
        tables[n] = grams.dictionary.to_pylist(), np.log((seen + _SMOOTH) / (seen.sum(0) + _SMOOTH * (len(seen) + 1))).astype(np.float32)
    return Model(langs, tables)


def _worker_model(shared) -> Model:
    """One model a worker, so that its table of words outlives a task."""
    langs, tables = shared.value
    return resident("language", tables, lambda: Model(langs, tables))


def identify(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, id_column: str = "doc_id") -> DataFrame:
    """(kept columns, lang_pred, score) for every row."""
    keep = [id_column] if keep is None else keep
    columns = [*(c for c in keep if c != text), text]
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.source))

    def make():
        here = _worker_model(shared)

        def work(rows):
            got = here.predict(rows[text])
            return {"lang_pred": [x[0] for x in got], "score": [x[1] for x in got]}

        return work

    return map_text(df, columns, make, ddl(df.select(*map(quoted, keep))) + ", lang_pred string, score double", text, keep)


def report(df: DataFrame, id_column: str = "doc_id") -> DataFrame:
    got = identify(df, fit(df, id_column), id_column=id_column)
    return got.select(id_column, F.coalesce(fold_of(id_column, FOLDS) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")


def keep_identified(df: DataFrame, least_score: float = LEAST_SCORE, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose language is known with ``least_score`` at least; columns as before."""
    plain, names = clear_of(df, ["lang_pred", "score"])
    got = identify(plain, fit(df, id_column, text), text, plain.columns)
    got = got.where((F.col("lang_pred") != "und") & (F.col("score") >= least_score)).drop("lang_pred", "score")
    return got.withColumnsRenamed(names)
