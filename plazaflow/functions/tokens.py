"""Token counts and budgets with a byte-level vocabulary (rank file and split pattern), or four characters a token where there is none.

A vocabulary is a pair of a rank file's path, readable on every executor, and a pattern; it is loaded once a worker.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import arrow_udf

Vocabulary = tuple[str, str] | None
#: Tokens around each chat message and before a reply, and the reply's length if a request names none.
AROUND_MESSAGE, BEFORE_REPLY, DEFAULT_REPLY = 4, 2, 15
#: What an embedding request keeps free of its model's input.
EMBEDDING_RESERVE = 1000
_loaded: dict = {}


def installed() -> Vocabulary:
    """The vocabulary that comes with the machine, if any."""
    try:
        import public_tokenizers
    except ImportError:
        return None
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encoding(vocabulary: Vocabulary):
    if vocabulary is None:
        return None
    if vocabulary not in _loaded:
        import tiktoken

        path, pattern = vocabulary
        with open(path, "rb") as f:
            _loaded[vocabulary] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    return _loaded[vocabulary]


def count(text: str | None, vocabulary: Vocabulary) -> int:
    e = encoding(vocabulary)
    return len(e.encode_ordinary(text or "")) if e else max(1, len(text or "") // 4)


def truncate(text: str | None, most: int, vocabulary: Vocabulary) -> str:
    """The text up to ``most`` tokens; a character that the cut splits becomes a replacement character."""
    if not isinstance(text, str) or most <= 0:
        return ""
    e = encoding(vocabulary)
    if e is None:
        return text[: 4 * most]
    ids = e.encode_ordinary(text)
    return text if len(ids) <= most else e.decode(ids[:most])


def request(body: str, endpoint: str, vocabulary: Vocabulary) -> int:
    """Tokens that a request may use: its texts and the replies that it allows. Raises for another endpoint or form."""
    r = json.loads(body)
    size = lambda x: count(x, vocabulary)
    several = lambda x: x if isinstance(x, list) else [x]
    if endpoint == "chat":
        total = BEFORE_REPLY
        for message in r["messages"]:
            total += AROUND_MESSAGE + sum(size(json.dumps(v) if k == "tool_calls" else v) for k, v in message.items()) - ("name" in message)
        return total + r.get("n", 1) * r.get("max_tokens", DEFAULT_REPLY)
    if endpoint == "completions":
        prompts = several(r["prompt"])
        return sum(map(size, prompts)) + r.get("n", 1) * r.get("max_tokens", DEFAULT_REPLY) * len(prompts)
    if endpoint == "embeddings":
        return sum(map(size, several(r["input"])))
    if endpoint == "messages":
        parts = [p.get("text") if isinstance(p, dict) else p for m in r.get("messages", []) for p in several(m.get("content", ""))]
        return sum(size(p) for p in parts if p is not None) + r.get("max_tokens", 0)
    raise ValueError(f"no such endpoint: {endpoint}")


def count_col(c: Column, vocabulary: Vocabulary) -> Column:
    if vocabulary is None:
        return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(c, F.lit(""))) / 4)).cast("long")
    return arrow_udf(lambda x: count(x, vocabulary), "bigint")(F.coalesce(c, F.lit("")))


def truncate_col(c: Column, most: int, vocabulary: Vocabulary) -> Column:
    if vocabulary is None or most <= 0:
        return F.left(F.coalesce(c, F.lit("")), F.lit(max(0, 4 * most)))
    return arrow_udf(lambda x: truncate(x, most, vocabulary), "string")(F.coalesce(c, F.lit("")))


def embedding_input(c: Column, most_input: int, vocabulary: Vocabulary) -> Column:
    """The text within what a model takes, less a reserve."""
    return truncate_col(c, most_input - EMBEDDING_RESERVE, vocabulary)


def request_col(c: Column, endpoint: str, vocabulary: Vocabulary) -> Column:
    return arrow_udf(lambda x: request(x, endpoint, vocabulary), "bigint")(c)
