"""Secret scans: an Aho-Corasick keyword prefilter, regular expressions anchored at its hits, then embedded checksums.

Kinds, in order: ``assign``, ``access``, ``hex`` (base kinds, decided by their pattern alone), ``github`` and ``npm`` (a CRC-32 of the
token in its last six base-62 digits), ``wallet`` (base58 with a double SHA-256 checksum: private keys in import format and extended
private keys). A span of the last three is reported only if its checksum holds.

Runs of hex digits have no keyword, so that base kind is one plain scan. Keys in import format are looked for in the ``NEAR`` characters
behind a keyword (``wif``, ``privkey``, ``private``, ``wallet``).

Null text counts as empty; empty text has no span. Rows are independent: repeated rows give repeated results. An empty table gives an
empty result. A very long text is scanned whole, in memory proportional to it. Redaction keeps all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import ascii_lower, ddl, map_text

KINDS = ("assign", "access", "hex", "github", "npm", "wallet")
BASE_KINDS = KINDS[:3]
#: What stands in the place of a secret after redaction.
MASK = "[secret]"

#: How far behind its keyword a key in import format may begin.
NEAR = 80

# Public token prefixes and the two alphabets of their checksums.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_GITHUB_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of 32 or more; shorter runs of [0-9a-f]+ fail, and no run overlaps another.
_HEX = re.compile(r"[0-9a-f]{32,}")
_GITHUB = re.compile(r"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])")
_NPM = re.compile(r"npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])")
_EXTENDED = re.compile(rf"[xyz]prv[{_BASE58}]{{107}}(?![0-9A-Za-z])")
_IMPORT = re.compile(rf"(?:5[HJK][{_BASE58}]{{49}}|[KL][{_BASE58}]{{51}})(?![0-9A-Za-z])")
_IMPORT_START = re.compile(r"(?<![0-9A-Za-z])[5KL](?=[1-9A-Za-z]{50})")
_IMPORT_WORDS = ("wif", "privkey", "private", "wallet")


def crc_token(token: str) -> bool:
    """Whether the last six base-62 digits are the CRC-32 of what stands between the prefix and them."""
    body, check = token[4:-6], 0
    for c in token[-6:]:
        check = check * 62 + _BASE62.index(c)
    return zlib.crc32(body.encode()) == check


def base58_check(text: str) -> bytes | None:
    """The payload of a base58 string whose last four bytes are its checksum."""
    n = 0
    for c in text:
        n = n * 58 + _BASE58.index(c)
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    raw = b"\0" * (len(text) - len(text.lstrip("1"))) + raw
    body, check = raw[:-4], raw[-4:]
    return body if hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4] == check else None


def _wallet(text: str) -> bool:
    body = base58_check(text)
    if body is None:
        return False
    return len(body) == 78 if text[1:4] == "prv" else body[:1] == b"\x80" and len(body) in (33, 34)


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    lowered = {**dict.fromkeys(_ASSIGN_WORDS, "assign"), "akia": "access", "npm_": "npm", **dict.fromkeys(_GITHUB_PREFIXES, "github"), "xprv": "wallet", "yprv": "wallet", "zprv": "wallet", **dict.fromkeys(_IMPORT_WORDS, "import")}
    for word, kind in lowered.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _anchored(text: str, starts: list[int], pattern: re.Pattern, keep) -> list[tuple[int, int]]:
    """The matches of a left-to-right scan, tried only at ``starts``; failing ones consume what they matched."""
    out, at = [], 0
    for s in starts:
        if s >= at and (m := pattern.match(text, s)):
            at = m.end()
            if keep(m):
                out.append(m.span())
    return out


def _behind(text: str, starts: list[int]) -> list[int]:
    """Where a key in import format may begin: within ``NEAR`` characters behind the places given."""
    out, at = [], 0
    for s in starts:
        stop = s + NEAR
        out += [m.start() for m in _IMPORT_START.finditer(text, max(s, at), stop + 60) if m.start() <= stop]
        at = max(at, stop + 1)
    return out


def find(text: str, automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then kind."""
    starts: dict[str, list[int]] = {}
    for end, (kind, size) in automaton.iter(ascii_lower(text)):
        starts.setdefault(kind, []).append(end - size + 1)
    for x in starts.values():
        x.sort()
    got = {
        "assign": _anchored(text, starts.get("assign", []), _ASSIGN, lambda m: m.end(2) - m.start(2) >= 8),
        "access": _anchored(text, starts.get("access", []), _ACCESS, lambda m: m.end() - m.start() >= 16),
        "hex": [m.span() for m in _HEX.finditer(text)],
        "github": _anchored(text, starts.get("github", []), _GITHUB, lambda m: crc_token(m[0])),
        "npm": _anchored(text, starts.get("npm", []), _NPM, lambda m: crc_token(m[0])),
        "wallet": _anchored(text, starts.get("wallet", []), _EXTENDED, lambda m: _wallet(m[0])) + _anchored(text, _behind(text, starts.get("import", [])), _IMPORT, lambda m: _wallet(m[0])),
    }
    spans = [(s, e, k) for k, kind in enumerate(KINDS) for s, e in got[kind]]
    return [(s, e, KINDS[k]) for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1]))]


def secret_spans(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, secrets array<struct<kind, start, end>>) for every row; spans in code points, end exclusive."""

    def make():
        automaton = _automaton()

        def work(rows):
            return {id_column: rows[id_column], "secrets": [[{"kind": k, "start": s, "end": e} for s, e, k in find(t or "", automaton)] for t in rows[text]]}

        return work

    return map_text(df, [id_column, text], make, f"{id_column} {df.schema[id_column].dataType.simpleString()}, secrets array<struct<kind:string,start:int,end:int>>", text)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Text with every span, overlapping ones together, replaced by ``MASK``."""
    out, at = [], 0
    for s, e, _ in spans:
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """The rows with secrets masked in ``text`` and ``size`` set to the new length where the text changed; other columns stay."""

    def make():
        automaton = _automaton()

        def work(rows):
            changed = []
            for k, t in enumerate(rows[text]):
                if t and (spans := find(t, automaton)):
                    rows[text][k] = masked(t, spans)
                    changed.append(k)
            for k in changed if size in rows else []:
                rows[size][k] = len(rows[text][k])
            return rows

        return work

    return map_text(df, df.columns, make, ddl(df), text, [c for c in df.columns if c not in (text, size)])


def report(spans: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The digest columns of op1: counts of the base kinds, SHA-256 of the base spans, all spans as text."""
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    return spans.select(id_column, *map(of, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
