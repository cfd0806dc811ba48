"""Benchmark decontamination: one suffix automaton of all normalised test items; documents stream through it word by word.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window is ``width`` consecutive words of an item; an item of
fewer words, but not none, is one window. The automaton gives at each word the longest run ending there that occurs in an item; a run
of ``width`` or more is a window, and a shorter item is found where it is a suffix of the run. Words inside a window are hit.

Null text has no words, an empty benchmark hits nothing, an empty table of documents gives an empty result. Items with equal words are
found together. Items with a null id hit like any other and count as one item together; only items_sha256 leaves them out. Repeated rows
give repeated results; a very long text is scanned whole, in some 60 bytes a word; columns may have any names.

The items are test sets, a stated query set: the driver reads them one after the other and sends them in blocks of at most
``block_words`` words, each with an automaton of its own; it holds one block at a time. Hits of blocks are united. One block is the usual case.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import ddl, map_text, resident

WIDTH = 10
BLOCK_WORDS = 1_000_000
#: The pipeline drops a document of which more than this share of words is hit, and cuts hit spans out of others.
MAX_COVERAGE = 0.5

_TO = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO).split()


class Automaton:
    """Generalised suffix automaton over words. States are list positions; 0 is the root."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int):
        self.width = width
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._add(last, w)
        found: dict[int, set[str]] = defaultdict(set)
        short: dict[int, dict[int, list[str]]] = defaultdict(dict)
        for name, words in items:
            if not words:
                continue
            s, n = 0, 0
            for w in words:
                s, n = self.next[s][w], n + 1
                if n >= width:
                    found[self.at(s, width)].add(name)
            if len(words) < width:
                short[self.at(s, len(words))].setdefault(len(words), []).append(name)
        self.items, self.short = dict(found), dict(short)
        #: States with a short item on their way of suffix links.
        self.some = [False] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            self.some[s] = s in self.short or (s > 0 and self.some[self.link[s]])

    def _add(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: bytes, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def at(self, state: int, n: int) -> int:
        """The state of the last n words of what leads to ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words (end exclusive), and the items whose windows occur."""
        nxt, link, length, width, some = self.next, self.link, self.length, self.width, self.some
        root = nxt[0]
        spans: list[list[int]] = []
        items: set[str] = set()
        state = run = 0
        here = root
        for i, w in enumerate(words):
            to = here.get(w)
            if to is None:
                while state > 0:
                    state = link[state]
                    to = nxt[state].get(w)
                    if to is not None:
                        break
                else:
                    run, here = 0, root
                    continue
                run = length[state] + 1
            else:
                run += 1
            state, here = to, nxt[to]
            first = i + 1
            if run >= width:
                first = i + 1 - width
                items |= self.items[self.at(state, width)]
            if some[state]:
                s = state
                while s > 0:
                    for n, names in self.short.get(s, {}).items():
                        if n <= run:
                            first = min(first, i + 1 - n)
                            items.update(names)
                    s = link[s]
            if first <= i:
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = i + 1
                else:
                    spans.append([first, i + 1])
        return [tuple(x) for x in spans], items


def _blocks(benchmark: DataFrame, block_words: int, item: str, text: str) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words (an item alone may have more)."""
    block, size = [], 0
    for row in benchmark.select(F.col(item).cast("string"), text).toLocalIterator():
        words = words_of(row[1])
        if not words:
            continue
        if size and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    yield block


def _shared(df: DataFrame, benchmark: DataFrame, block_words: int, item: str, text: str) -> list:
    return [df.sparkSession.sparkContext.broadcast(b) for b in _blocks(benchmark, block_words, item, text)]


def _scanner(blocks: list, width: int):
    """From the words of some texts to their merged hit spans and their items, over all blocks."""
    ready = [_automaton(b, width) for b in blocks] if len(blocks) == 1 else None

    def scan_all(words: list[list[bytes]]) -> tuple[list[list[list[int]]], list[set[str]]]:
        hits, items = [[] for _ in words], [set() for _ in words]
        for k, b in enumerate(blocks):
            scan = (ready[k] if ready else Automaton(b.value, width)).scan
            for j, w in enumerate(words):
                spans, names = scan(w)
                hits[j] += spans
                items[j] |= names
        return [_merged(h) for h in hits], items

    return scan_all


def overlaps(df: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS, id_column: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(id, n_words, hits array<struct<start, end>> in words, items array<string>) for every row.

    Each block of items has its own broadcast automaton; every row meets them one after the other in the same pass.
    """
    blocks = _shared(df, benchmark, block_words, item, text)

    def make():
        scan = _scanner(blocks, width)

        def work(rows):
            words = [words_of(t) for t in rows[text]]
            hits, items = scan(words)
            return {"n_words": [len(w) for w in words], "hits": [[{"start": s, "end": e} for s, e in h] for h in hits], "items": [sorted(x, key=lambda i: (i is None, i or "")) for x in items]}

        return work

    return map_text(df, [id_column, text], make, ddl(df.select(id_column)) + ", n_words long, hits array<struct<start:int,end:int>>, items array<string>", text, [id_column])


def _automaton(block, width: int) -> Automaton:
    """Built once for a Python worker, not for each task."""
    items = block.value
    return resident(f"items {width}", items, lambda: Automaton(items, width))


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def report(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The digest columns of op9."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    return found.select(id_column, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def cut(text: str, hits: list) -> str:
    """Text without the characters from the first to the last word of each hit span."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, end in hits:
        out.append(text[at : spans[first][0]])
        at = spans[end - 1][1]
    return "".join([*out, text[at:]])


def decontaminate(df: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_coverage: float = MAX_COVERAGE, item: str = "item_id", text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows without benchmark passages: a row over ``max_coverage`` goes, hit spans are cut out of others; untouched rows stay as they are. One pass."""
    blocks = _shared(df, benchmark, BLOCK_WORDS, item, text)

    def make():
        scan = _scanner(blocks, width)

        def work(rows):
            words = [words_of(t) for t in rows[text]]
            kept = []
            for k, h in enumerate(scan(words)[0]):
                kept.append(sum(e - s for s, e in h) <= max_coverage * len(words[k]))
                if h and kept[-1]:
                    rows[text][k] = cut(rows[text][k], h)
                    if size in rows:
                        rows[size][k] = len(rows[text][k])
            return rows | {mark: kept}

        return work

    mark = "own kept" + " again" * sum(c.lower().startswith("own kept") for c in df.columns)
    through = [c for c in df.columns if c not in (text, size)]
    return map_text(df, df.columns, make, f"{ddl(df)}, `{mark}` boolean", text, through).where(f"`{mark}`").drop(mark)


#: DuckDB: windows compared as the words themselves.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)),
h AS (SELECT r, i, s.n, item FROM s JOIN v USING (k) WHERE s.n = v.n),
p AS (SELECT r, count(DISTINCT i + o) AS n FROM (SELECT r, i, unnest(range(n)) AS o FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS x FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items, coalesce(x, sha256('')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
