"""URL filters: allow and block rules on host and path, and for urls without a rule a logistic regression on hashed character n-grams.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``, ``#`` or the end.
Both are empty for a null url or one without ``://``. A rule ``host/path`` fits its host and all subdomains if the path starts with the
rule's; the longest one wins (the rules of one length and host are distinct, so no tie is left).

The regression is trained on the driver from a small labelled table (at most ``MOST_LABELLED`` rows, a documented bound); features are
n-grams of 3 to 5 characters of host and path, marked apart, hashed by CRC-32 into ``BUCKETS`` weights, each vector of length one.
The table that comes with it (``labelled``) is made by rule: hosts named after unwanted trades against hosts named after ordinary subjects or
made of plain syllables, in the same domains and with the same kinds of paths. ``evaluate`` tests on hosts that training didn't see.

A url with both parts empty is judged by the bias alone. A null id stays null; repeated rows are judged alike. An empty table gives an
empty result. Only id and url are read, so other columns can't clash. A very long url is judged whole, in some 30 bytes a character.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import map_text

BUCKETS = 1 << 14
MOST_LABELLED = 10_000
#: (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
# Topic words of the labelled table.
_UNWANTED = ("casino poker jackpot slots roulette betting bets lottery gambling wager pills pharmacy viagra cialis tablets dosage steroid weightloss replica "
             "counterfeit xxx adult porn cams escort webcam nude hookup warez crack keygen torrent serials nulled spam clicks traffic backlinks "
             "popunder adserver ads track banner payday loan cash money crypto doubler giveaway prize winner bonus win cheap free farm discount deal").split()  # fmt: skip
_ORDINARY = ("museum library archive school college university institute research science physics biology history geography weather climate garden "
             "recipes kitchen travel railway city council parliament court hospital clinic doctor nurse sports football chess music orchestra theatre "
             "cinema news journal magazine review books poetry language dictionary maps forum wiki docs manual software kernel compiler database").split()  # fmt: skip
_ENDINGS = ("com", "org", "net", "info", "co.uk", "de", "io", "edu")
_UNWANTED_PATHS = ("/{}/now", "/buy-{}", "/{}-online.html", "/best/{}/offer", "/go/{}", "/p/{}")
_ORDINARY_PATHS = ("/{}/2019/03", "/about-{}", "/{}-notes.html", "/articles/{}/index", "/topics/{}", "/p/{}")


def _plain_name(n: int) -> str:
    """A name of three or four syllables, by rule."""
    out = ""
    for k in range(3 + n % 2):
        n = (n * 1103515245 + 12345) % (1 << 31)
        out += "bcdfghjklmnprstvwz"[n // 7 % 18] + "aeiou"[n // 131 % 5] + ("", "n", "r", "s", "t", "th")[n // 1031 % 6]
    return out


def labelled() -> list[tuple[str, int]]:
    """The labelled table: 1 is to be blocked."""
    out = []
    plain = [_plain_name(n) for n in range(4 * len(_ORDINARY))]
    for label, words, paths in ((1, _UNWANTED, _UNWANTED_PATHS), (0, _ORDINARY, _ORDINARY_PATHS), (0, plain, _ORDINARY_PATHS)):
        for at, word in enumerate(words):
            for k in range(8 if words is not plain else 4):
                other = words[(at * 7 + k * 11 + 3) % len(words)]
                host = (word, f"{word}-{other}", f"blog.{word}", f"www.{word}", f"m.{word}", f"{other}{word}", f"{word}.{other}", f"www.{other}-{word}")[k]
                path = ("", "/", paths[(at + k) % 6].format(other), f"/en/{37 * at + k}", paths[(at + 2 * k) % 6].format(word), f"/{at}/{k}.html", f"/?id={at}", "/index.html")[(at + k) % 8]
                out.append((f"http{'s' * (k % 2)}://{host}.{_ENDINGS[(at + k) % 8]}{path}", label))
    return out


def evaluate() -> tuple[float, float, int]:
    """Precision and recall of block on hosts that training didn't see (a fifth of them, by CRC-32), and the number of urls tested."""
    unseen = lambda row: zlib.crc32(parts(row[0])[0].encode()) % 5 == 0
    weights = train([row for row in labelled() if not unseen(row)])
    tested = [(probability(weights, *parts(url)) >= 0.5, label) for url, label in labelled() if unseen((url, label))]
    hit = sum(g and label for g, label in tested)
    return hit / max(1, sum(g for g, _ in tested)), hit / max(1, sum(label for _, label in tested)), len(tested)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict), both null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def features(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their values."""
    found = []
    for mark, part in ((b"h", host), (b"p", path)):
        raw = b"^" + part.encode() + b"$" if part else b""
        found += [zlib.crc32(mark + raw[i : i + n]) % BUCKETS for n in (3, 4, 5) for i in range(len(raw) - n + 1)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    at, n = np.unique(found, return_counts=True)
    return at, n / np.sqrt((n * n).sum())


def parts(url: str) -> tuple[str, str]:
    """Host and path of one url, as the expressions above give them."""
    _, found, rest = url.partition("://")
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))
    return (host.encode().lower().decode(), rest[:end]) if found else ("", "")


def train(table=None, rounds: int = 400, rate: float = 30.0, decay: float = 1e-4) -> np.ndarray:
    """Weights by bucket and the bias at the end: full-batch gradient descent on the log loss, in terms of the rows (weights are sums of them)."""
    table = labelled() if table is None else list(table)
    if len(table) > MOST_LABELLED:
        raise ValueError(f"the labelled table has over {MOST_LABELLED} rows")
    rows = [features(*parts(u)) for u, _ in table]
    at, value = np.concatenate([a for a, _ in rows]), np.concatenate([v for _, v in rows])
    starts = np.cumsum([len(a) for a, _ in rows]) - [len(a) for a, _ in rows]
    inner, one = np.zeros((len(rows), len(rows))), np.zeros(BUCKETS)
    for row, (a, v) in zip(inner, rows, strict=True):
        one[a] = v
        row[:] = np.add.reduceat(np.append(one[at] * value, 0), starts) * [len(a) > 0 for a, _ in rows]
        one[a] = 0
    y, part, bias = np.array([label for _, label in table]), np.zeros(len(rows)), 0.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-(inner @ part + bias))) - y) / len(y)
        part -= rate * (error + decay * part)
        bias -= rate / 10 * error.sum()
    out = np.zeros(BUCKETS + 1)
    np.add.at(out, at, value * np.repeat(part, [len(a) for a, _ in rows]))
    out[-1] = bias
    return out


def probability(weights: np.ndarray, host: str, path: str) -> float:
    """That the url is to be blocked."""
    at, v = features(host, path)
    return float(1 / (1 + np.exp(-(weights[at] @ v + weights[-1]))))


def judge(df: DataFrame, id_column: str = "page_id", url: str = "url", rules=RULES, table=None) -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row; score is the regression's probability of block, null where a rule decides."""
    weights = df.sparkSession.sparkContext.broadcast(train(table))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    ruled = df.select(id_column, host.alias("host"), path.alias("path")).withColumns(dict(zip(("rule", "ruled"), rule_of(F.col("host"), F.col("path"), rules), strict=True)))

    def make():
        w = weights.value

        def work(rows):
            scores = [None if r else probability(w, h, p) for r, h, p in zip(rows["rule"], rows["host"], rows["path"], strict=True)]
            verdicts = [v or ("block" if s >= 0.5 else "allow") for v, s in zip(rows["ruled"], scores, strict=True)]
            return {c: rows[c] for c in (id_column, "host", "path", "rule")} | {"verdict": verdicts, "score": scores}

        return work

    return map_text(ruled, [id_column, "host", "path", "rule", "ruled"], make, f"{id_column} {df.schema[id_column].dataType.simpleString()}, host string, path string, rule string, verdict string, score double", "path")
