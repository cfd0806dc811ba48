"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted over the corpus; repeated windows merge into removal intervals.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``width`` consecutive words of one document. Every word that lies in a window
whose hash occurs at another place too (in any document, the same one included) is removed; windows are judged on the input. The
comparison key has 63 bits of one rolling hash, and the bucket it is counted in comes from a second, independent one.

Counting: units of documents send their distinct hashes to hash buckets, and a Spark task counts each bucket (see exchange).

Null text has no words. Documents of fewer than ``width`` words have no window and stay whole. Repeated rows are copies of each other, so
all their windows repeat. An empty table gives an empty result. Only id and text are read, so other columns can't clash. A very long text
is handled whole, alone in its unit, in some 80 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Words, windows
from .exchange import ask, bucket_count, scanned

WIDTH = 35


class _Unit:
    """Windows of a unit, their distinct keys by bucket, and where each window's key stands."""

    def __init__(self, batch: pa.RecordBatch, width: int, buckets: int):
        self.texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        self.words = w = Words(self.texts)
        hashes = w.hashes()
        keys, other = windows(hashes, width, 1), windows(hashes, width, 2)
        # a window starts in the last width-1 words of a document only in the next one's part: those are none
        real = np.ones(len(keys), bool)
        for last in w.offsets[1:-1]:
            real[max(0, last - width + 1) : last] = False
        self.starts = np.flatnonzero(real)
        keys, other = keys[real] | np.uint64(1), other[real]
        bucket = ((other >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((keys, bucket))
        keys, bucket = keys[order], bucket[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])
        group = np.cumsum(new) - 1
        self.inverse = np.empty(len(keys), np.int64)
        self.inverse[order] = group
        n = int(group[-1]) + 1 if len(group) else 0
        #: The low bit says that the key occurs once here.
        self.keys = keys[new] - (np.bincount(group, minlength=n) > 1).astype(np.uint64)
        self.bounds = np.searchsorted(bucket[new], np.arange(buckets + 1))


def _repeated(blocks: list, _: list) -> list[bytes]:
    parts = [np.frombuffer(b, np.uint64) for b in blocks]
    keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    once = (keys & np.uint64(1)).astype(bool)
    keys = keys >> np.uint64(1)
    ordered = np.sort(keys)
    many = np.unique(np.concatenate([ordered[1:][ordered[1:] == ordered[:-1]], keys[~once]]))
    at = np.searchsorted(many, keys)
    hit = np.zeros(len(keys), bool)
    if len(many):
        hit = many[np.minimum(at, len(many) - 1)] == keys
    ends = np.cumsum([len(p) for p in parts])
    return [np.packbits(x).tobytes() for x in np.split(hit, ends[:-1])]


def remove_repeats(df: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text: str = "text", buckets: int | None = None, unit_bytes: int | None = None) -> DataFrame:
    """(id, n_words, n_removed, removed array<struct<start, end>> in words, kept_text with one space between words) for every row."""
    key_type = df.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {key_type}, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept_text string"
    rows = scanned(df.select(id_column, text))
    in_all = bucket_count(rows, text, buckets)

    def keys(batch, n):
        unit = _Unit(batch, width, n)
        return {k: unit.keys[unit.bounds[k] : unit.bounds[k + 1]].tobytes() for k in np.flatnonzero(np.diff(unit.bounds)).tolist()}

    def finish(batch, answers):
        unit = _Unit(batch, width, in_all)
        hit, sizes = [np.zeros(0, np.uint8)], np.diff(unit.bounds)
        if set(answers) != set(np.flatnonzero(sizes).tolist()):
            raise ValueError("a unit met answers for other keys: its rows came in another order when read again")
        for k in sorted(answers):
            got = np.unpackbits(np.frombuffer(answers[k], np.uint8))
            if not sizes[k] <= len(got) < sizes[k] + 8:
                raise ValueError("a unit met answers for other keys: its rows came in another order when read again")
            hit.append(got[: sizes[k]])
        hit = np.concatenate(hit).astype(bool)[unit.inverse]
        total = int(unit.words.offsets[-1])
        change = np.zeros(total + 1, np.int64)
        starts = unit.starts[hit]
        change += np.bincount(starts, minlength=total + 1) - np.bincount(starts + width, minlength=total + 1)
        gone = np.cumsum(change[:-1]) > 0
        out = {"n_removed": [], "removed": [], "kept_text": []}
        for t, a, b in zip(unit.texts, unit.words.offsets, unit.words.offsets[1:], strict=False):
            mask, words = gone[a:b], t.split()
            n = int(mask.sum())
            runs = []
            if n:
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                runs = [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()]
                kept, at = [], 0
                for r in runs:
                    kept += words[at : r["start"]]
                    at = r["end"]
                words = kept + words[at:]
            out["n_removed"].append(n)
            out["removed"].append(runs)
            out["kept_text"].append(b" ".join(words))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(unit.words.counts), pa.array(out["n_removed"], pa.int64()), pa.array(out["removed"], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(out["kept_text"], pa.binary()).cast(pa.string())], [id_column, "n_words", "n_removed", "removed", "kept_text"])

    return ask(rows, keys, _repeated, finish, schema, in_all, text=text, unit_bytes=unit_bytes)


def report(removed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return removed.select(id_column, "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: DuckDB: windows compared as the words themselves.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, i, sha256(array_to_string(w[i : i + 34], chr(1))) AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
h AS (SELECT r, i FROM s WHERE k IN (SELECT k FROM s GROUP BY k HAVING count(*) > 1)),
g AS (SELECT DISTINCT r, i + o AS p FROM h, (SELECT unnest(range(35)) AS o)),
l AS (SELECT r, list(p) AS ps, count(*) AS n FROM g GROUP BY r),
k AS (SELECT d.r, string_agg(x, ' ' ORDER BY p) AS kept FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d) d LEFT JOIN g USING (r, p) WHERE g.p IS NULL GROUP BY d.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN l USING (r) LEFT JOIN k USING (r)
"""
