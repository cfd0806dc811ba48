"""Token counts by section: whole documents are encoded once, and tokens are attributed to sections through their character spans.

Sections are the lines of a document (a line break belongs to the line it ends); any other cut can be given as a function from text to
section starts. A token that crosses a boundary belongs to the section that has most of its characters, and to the earlier one on a tie
(a token of no whole character, as byte-level pieces of one character are, belongs to the section of that character).

Null text counts as empty: no tokens, no sections. Rows are independent, and repeated rows give repeated results. Counts of a document's
sections sum to its number of tokens. An empty table gives an empty result. Only id and text are read, so other columns can't clash. A very
long text is encoded whole, in some 30 bytes a byte; runs of over ``LONG_SPACE`` white space, which overflow the tokenizer's matcher, are
cut out as the pieces that the pattern makes of them.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_text, resident

def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _encoding(path: str, pattern: str):
    """The tokenizer, and the number of bytes of each id."""

    def build():
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes

    return resident("tokens", (path, pattern), build)


#: Characters of white space in a run that the pattern's matcher still takes.
LONG_SPACE = 10_000
#: The characters that the matcher counts as white space.
_SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def encoded(encoding, text: str) -> list[int]:
    """As ``encode_ordinary``. A run of white space is one piece of the pattern at the end of a text, else one without its last character."""
    if len(text) <= LONG_SPACE:
        return encoding.encode_ordinary(text)
    out, at = [], 0
    for m in re.finditer(f"[{_SPACE}]{{{LONG_SPACE},}}", text):
        end = m.end() - (m.end() < len(text))
        out += encoding.encode_ordinary(text[at : m.start()])
        out += encoding._core_bpe.encode_single_piece(text[m.start() : end].encode())
        at = end
    return out + encoding.encode_ordinary(text[at:])


def line_starts(text: str) -> list[int]:
    """Where lines begin; the empty text has none."""
    out, at = ([0] if text else []), text.find("\n")
    while 0 <= at < len(text) - 1:
        out.append(at + 1)
        at = text.find("\n", at + 1)
    return out


def attribute(text: str, sizes: np.ndarray, starts: list[int]) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens crossed a boundary. sizes: bytes of each token."""
    raw = np.frombuffer(text.encode(), np.uint8)
    ends = np.cumsum(sizes)
    if text.isascii():
        first, last = ends - sizes, ends
    else:
        # characters begun before each byte: a span covers the characters that it touches
        begun = np.cumsum((raw & 0xC0) != 0x80)
        first, last = begun[ends - sizes] - 1, begun[ends - 1]
    cuts = np.asarray(starts)
    a, b = np.searchsorted(cuts, first, "right") - 1, np.searchsorted(cuts, last - 1, "right") - 1
    crossing = np.flatnonzero(a != b)
    bounds = np.append(cuts, len(text))
    for k in crossing:
        parts = [min(last[k], bounds[s + 1]) - max(first[k], bounds[s]) for s in range(a[k], b[k] + 1)]
        a[k] += int(np.argmax(parts))
    return np.bincount(a, minlength=len(starts)), len(crossing)


def count_tokens(df: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: tuple[str, str] | None = None, sections: Callable[[str], list[int]] = line_starts) -> DataFrame:
    """(id, n_tokens, n_crossing, sections array<struct<start, tokens>>) for every row; starts in code points."""
    path, pattern = vocabulary or default_vocabulary()

    def make():
        encoding, sizes = _encoding(path, pattern)

        def work(rows):
            out = {id_column: rows[id_column], "n_tokens": [], "n_crossing": [], "sections": []}
            for t in rows[text]:
                starts = sections(t) if t else []
                ids = encoded(encoding, t) if t else []
                counts, crossing = attribute(t, sizes[ids], starts) if ids else (np.zeros(len(starts), np.int64), 0)
                out["n_tokens"].append(len(ids))
                out["n_crossing"].append(crossing)
                out["sections"].append([{"start": s, "tokens": c} for s, c in zip(starts, counts.tolist(), strict=True)])
            return out

        return work

    return map_text(df, [id_column, text], make, f"{id_column} {df.schema[id_column].dataType.simpleString()}, n_tokens long, n_crossing long, sections array<struct<start:int,tokens:int>>", text)


def report(counted: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document: totals, the largest section, and a digest of all section counts."""
    tokens = F.transform("sections", lambda s: s["tokens"])
    return counted.select(id_column, "n_tokens", F.size("sections").cast("long").alias("n_sections"), "n_crossing", F.coalesce(F.array_max(tokens), F.lit(0)).cast("long").alias("largest_section"), F.sha2(F.array_join(tokens, ","), 256).alias("sections_sha256"))
