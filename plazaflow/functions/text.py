"""Text scalars as Column builders: normalising, hashing, tags, validators, degeneracy measures. All stay in the JVM.

White space is Unicode-aware where the name says so; length counts code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"(?U)\s+"
#: Verdict-like replies that are too short to be an answer.
GENERIC_REPLIES = ("yes", "no", "ok", "okay", "good", "bad")
#: Placeholders that a finished answer doesn't hold.
PLACEHOLDERS = (r"\[.*?\]", r"\{.*?\}", r"<.*?>", r"___+", r"\.\.\.+")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^(?U)\s+|(?U)\s+$", "")


def normalise_space(c: Column) -> Column:
    """Runs of white space become one space, ends are stripped; null stays null."""
    return F.trim(F.regexp_replace(c, _WS, " "))


def normalise_or_empty(c: Column) -> Column:
    return F.coalesce(normalise_space(c), F.lit(""))


def words(c: Column) -> Column:
    """Words between white space; none for an empty or null text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), _WS), lambda w: w != "")


def hash_text(c: Column) -> Column:
    return F.sha2(normalise_or_empty(c), 256)


def done_key(*parts: Column) -> Column:
    """SHA-1 of the trimmed parts joined by two pipes."""
    return F.sha1(F.concat_ws("||", *(F.coalesce(F.trim(p), F.lit("")) for p in parts)))


def falsy(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def dedup_key(mode: str, context: Column, rephrased: Column, question: Column, answer: Column) -> Column:
    """The key by which records count as equal; ``auto`` takes the first part that has a text. Null where nothing has one."""
    text = lambda c: F.nullif(normalise_or_empty(c), F.lit(""))
    qa = F.when(text(question).isNotNull() | text(answer).isNotNull(), F.concat_ws("||", normalise_or_empty(question), normalise_or_empty(answer)))
    chosen = {"context_text": text(context), "rephrased_text": text(rephrased), "qa": qa, "auto": F.coalesce(text(rephrased), text(context), qa)}[mode]
    return F.sha2(chosen, 256)


# ---- tags -----------------------------------------------------------------------------------------------------------


def between(c: Column, tag: str) -> Column:
    """The trimmed text of the first ``<tag>`` block, null if there is none."""
    return F.when(F.regexp_like(c, F.lit(rf"(?s)<{tag}>.*?</{tag}>")), strip(F.regexp_extract(c, rf"(?s)<{tag}>(.*?)</{tag}>", 1)))


def all_between(c: Column, tag: str) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1)), strip)


def has_block(c: Column, tag: str) -> Column:
    return F.regexp_like(F.coalesce(c, F.lit("")), F.lit(rf"(?s)<{tag}>.*?</{tag}>"))


def without_blocks(c: Column, tag: str) -> Column:
    return strip(F.regexp_replace(c, rf"(?s)<{tag}>.*?</{tag}>", ""))


def after_think(c: Column) -> Column:
    """What follows the first closing think tag, else the whole text."""
    return strip(F.regexp_replace(c, r"(?s)^.*?</think>", ""))


def with_opening_think(c: Column) -> Column:
    """Puts the opening tag first where only the closing one is there."""
    return F.when(F.contains(c, F.lit("</think>")) & ~F.contains(c, F.lit("<think>")), F.concat(F.lit("<think>"), c)).otherwise(c)


def think_error(c: Column) -> Column:
    """Null if the text begins with its one, non-empty think block; else why not."""
    n = F.regexp_count(c, F.lit(r"(?s)<think>.*?</think>"))
    return (
        F.when(F.coalesce(strip(c), F.lit("")) == "", "empty")
        .when(n == 0, "no_block")
        .when(~F.startswith(strip(c), F.lit("<think>")), "not_at_start")
        .when(F.length(between(c, "think")) == 0, "empty_block")
        .when(n > 1, "several_blocks")
    )


def think_only(c: Column) -> Column:
    return think_error(c).isNull() & ~F.contains(c, F.lit("<tool_call>"))


def call_error(c: Column) -> Column:
    """Null if tool-call tags pair up in order; else why not."""
    opened, closed = F.regexp_count(c, F.lit("<tool_call>")), F.regexp_count(c, F.lit("</tool_call>"))
    return F.when(opened > closed, "unclosed").when(closed > opened, "unopened").when((opened > 0) & (F.instr(c, "</tool_call>") < F.instr(c, "<tool_call>")), "reversed").when(F.regexp_like(c, F.lit(r"(?s)<tool_call>(?:(?!</tool_call>).)*<tool_call>")), "nested")


def incomplete_call(c: Column) -> Column:
    return F.regexp_count(c, F.lit("<tool_call>")) > F.regexp_count(c, F.lit("</tool_call>"))


def unanswered_call(c: Column) -> Column:
    """Whether no tool response follows the last tool call."""
    last = lambda tag: F.length(c) - F.instr(F.reverse(c), tag[::-1])
    return F.contains(c, F.lit("</tool_call>")) & (~F.contains(c, F.lit("<tool_response>")) | (last("<tool_response>") < last("</tool_call>")))


def forged_output(c: Column) -> Column:
    """Whether the text holds output that only the environment may write."""
    return F.regexp_like(F.coalesce(c, F.lit("")), F.lit(r"<repl>|<state>|<sub_agent"))


def code_blocks(c: Column) -> Column:
    """Contents of python and bash tags, in order."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?s)<(python|bash)>.*?</\1>"), F.lit(0)), lambda b: strip(F.regexp_replace(b, r"^<\w+>|</\w+>$", "")))


def strip_fences(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"^\s*```[A-Za-z]*\n?|\n?```\s*$", ""))


def strip_quotes(c: Column) -> Column:
    """One pair of matching quotes around the text goes."""
    t = strip(c)
    return F.when(F.regexp_like(t, F.lit(r"""(?s)^(["']).*\1$""")) & (F.length(t) > 1), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def strip_numbering(c: Column) -> Column:
    """Up to two leading list markers go (``1.``, ``(a)``, ``Q2:``, bullets); decimals and fractions stay."""
    marker = r"^\s*(?:Q(?:uestion)?\s*\d+\s*[:.)]|\(?\d{1,3}[.):](?!\d)|\([a-zA-Z]\)|[a-zA-Z]\)|[-*\u2022])\s+"
    return strip(F.regexp_replace(F.regexp_replace(c, marker, ""), marker, ""))


def boxed_simple(c: Column) -> Column:
    """The first boxed answer without inner braces."""
    return F.nullif(F.regexp_extract(c, r"\\boxed\{([^{}]*)\}", 1), F.lit(""))


def boxed_one_level(c: Column) -> Column:
    """All boxed answers with at most one level of inner braces."""
    return F.regexp_extract_all(c, F.lit(r"\\boxed\{((?:[^{}]|\{[^{}]*\})*)\}"), F.lit(1))


def tex_fraction(c: Column) -> Column:
    r"""``\frac{a}{b}`` and ``\tfrac{a}{b}`` become a/b."""
    return F.regexp_replace(c, r"\\[td]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", "$1/$2")


def answers_agree(expected: Column, found: Column) -> Column:
    """Equal or one contained in the other, case aside; null where one is missing or empty."""
    a, b = F.nullif(F.lower(strip(expected)), F.lit("")), F.nullif(F.lower(strip(found)), F.lit(""))
    return (a == b) | F.contains(a, b) | F.contains(b, a)


def number_of(c: Column) -> Column:
    """A double from text with percent, dollar, commas and one unit; null if none is left."""
    bare = F.regexp_replace(F.lower(strip(c)), r"[%$,\s]", "")
    return F.regexp_replace(bare, r"(?:km|cm|mm|kg|mg|m|g|s|h|l)$", "").try_cast("double")


def coerce_int(c: Column) -> Column:
    return F.regexp_replace(strip(c), ",", "").try_cast("bigint")


def coerce_float(c: Column) -> Column:
    return F.regexp_replace(strip(c), ",", "").try_cast("double")


def suffixed_number(c: Column) -> Column:
    """``1.5M`` and the like; null if it is no number."""
    t = F.upper(F.regexp_replace(strip(c), r"[$,]", ""))
    factor = F.when(F.endswith(t, F.lit("K")), 1e3).when(F.endswith(t, F.lit("M")), 1e6).when(F.endswith(t, F.lit("B")), 1e9).otherwise(1.0)
    return F.regexp_replace(t, "[KMB]$", "").try_cast("double") * factor


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda, or where it stands several times, Spark would compute it again and again."""
    return F.element_at(F.transform(F.array(value), body), 1)


# ---- degeneracy -----------------------------------------------------------------------------------------------------


def most_frequent(items: Column, least: Column | None = None) -> Column:
    """How often the most frequent item occurs: sorted, the longest run; linear after the sort. ``least``: a value of the items' type, the empty text by default."""
    step = F.aggregate(
        F.array_sort(items),
        F.struct((F.lit("") if least is None else least).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most")),
        lambda a, x: F.struct(x.alias("last"), F.when(x == a["last"], a["run"] + 1).otherwise(1).alias("run"), F.greatest(a["most"], F.when(x == a["last"], a["run"] + 1).otherwise(1)).alias("most")),
    )
    return step["most"]


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens, space-joined; none for fewer tokens. Shifted slices are zipped, which is linear."""

    def shifted(t):
        m = F.greatest(F.size(t) - (n - 1), F.lit(0))
        out = F.slice(t, F.lit(1), m)
        for k in range(1, n):
            out = F.zip_with(out, F.slice(t, F.lit(k + 1), m), lambda a, b: F.concat(a, F.lit(" "), b))
        return out

    return let(tokens, shifted)


def ngram_repetition(tokens: Column, n: int = 5) -> Column:
    """How often the most frequent run of n tokens occurs; runs are compared as 64-bit hashes, which sort faster than texts."""

    def hashed(t):
        m = F.size(t) - (n - 1)
        return F.when(m > 0, F.transform(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), lambda i: F.xxhash64(F.slice(t, i, n)))).otherwise(F.array().cast("array<bigint>"))

    return most_frequent(let(tokens, hashed), F.lit(0).cast("long"))


def line_repetition(c: Column) -> Column:
    return most_frequent(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != ""))


def fragment_repetition(c: Column, width: int = 24, step: int = 8, short: int = 12) -> Column:
    """Repetition of ``width`` characters taken every ``step``; fragments of under ``short`` characters when stripped are left out."""

    def fragments(t):
        starts = F.sequence(F.lit(0), F.greatest(F.length(t) - short - 1, F.lit(0)), F.lit(step))
        return F.filter(F.transform(starts, lambda i: F.trim(F.substring(t, i + 1, F.lit(width)))), lambda x: F.length(x) >= short)

    return most_frequent(let(c, fragments))


def degenerate(c: Column) -> Column:
    """Repetition behind the think block: a 5-gram or a line 6 times, or a fragment 6 times in 120 characters or more."""
    found = lambda tail: (ngram_repetition(words(tail)) >= 6) | (line_repetition(tail) >= 6) | ((F.length(tail) >= 120) & (fragment_repetition(tail) >= 6))
    return let(after_think(F.coalesce(c, F.lit(""))), found)


def token_loop(c: Column) -> Column:
    """One token over and over: 80 times, or 30 times and 60 percent, or 100 tokens with at most 15 percent distinct."""

    def found(t):
        n = F.size(t)
        return let(most_frequent(t), lambda most: (n >= 10) & ((most >= 80) | ((most >= 30) & (most >= 0.6 * n)) | ((n >= 100) & (F.size(F.array_distinct(t)) <= 0.15 * n))))

    return let(words(after_think(F.coalesce(c, F.lit("")))), found)


def trailing_run(c: Column) -> Column:
    """How often the last character is repeated at the end; 0 for white space."""
    t = F.coalesce(c, F.lit(""))
    last = F.right(t, F.lit(1))
    run = F.length(t) - F.length(F.rtrim(t, last))
    return F.when(F.regexp_like(last, F.lit(r"(?U)^\s?$")), 0).otherwise(run)


def word_run(c: Column) -> Column:
    """The longest run of one word in a row."""
    step = F.aggregate(
        words(c),
        F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most")),
        lambda a, x: F.struct(x.alias("last"), F.when(x == a["last"], a["run"] + 1).otherwise(1).alias("run"), F.greatest(a["most"], F.when(x == a["last"], a["run"] + 1).otherwise(1)).alias("most")),
    )
    return step["most"]


def pair_error(human: Column, reply: Column, least_chars: int = 10, least_words: int = 3, strict: bool = True) -> Column:
    """A code for the first check that a question and its reply fail, in fixed order; null if they pass. ``strict``: also the last checks, on runs, placeholders of either, and generic replies."""
    h, g = strip(F.coalesce(human, F.lit(""))), strip(F.coalesce(reply, F.lit("")))
    out = F.when(h == "", "empty_human").when(g == "", "empty_reply").when(h == g, "identical")
    out = out.when(F.length(h) < least_chars, "short_human").when(F.length(g) < least_chars, "short_reply")
    out = out.when(F.size(words(h)) < least_words, "few_words_human").when(F.size(words(g)) < least_words, "few_words_reply")
    if strict:
        # (?d): a dot stops at line feeds only
        hold = F.regexp_like(h, F.lit("(?d)" + "|".join(PLACEHOLDERS))) | F.regexp_like(g, F.lit("(?d)" + "|".join(PLACEHOLDERS)))
        out = out.when(word_run(h) > 3, "word_run_human").when(word_run(g) > 3, "word_run_reply").when(hold, "placeholder").when((F.length(g) < 20) & F.lower(g).isin(*GENERIC_REPLIES), "generic_reply")
    return out


# ---- sizes and names ------------------------------------------------------------------------------------------------


def truncated(c: Column, chars: int, lines: int) -> tuple[Column, Column]:
    """Text under a line cap and then a character cap, and whether anything was cut."""
    cut = F.left(F.array_join(F.slice(F.split(c, "\n"), 1, lines), "\n"), F.lit(chars))
    return cut, cut != c


def clip(c: Column, chars: int = 4000) -> Column:
    t = normalise_space(c)
    return F.when(F.length(t) > chars, F.concat(F.left(t, F.lit(chars)), F.lit("..."))).otherwise(t)


def token_estimate(c: Column) -> Column:
    """Tokens at four characters each, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4)).cast("long")


def tool_name_valid(c: Column) -> Column:
    return F.regexp_like(F.coalesce(c, F.lit("")), F.lit(r"^[A-Za-z0-9_-]{1,64}$"))


def identifier(c: Column) -> Column:
    return F.regexp_replace(c, r"\W", "_")


def path_name(c: Column) -> Column:
    """Word characters, spaces and dashes only, spaces as underscores, 255 at most."""
    return F.left(F.regexp_replace(F.regexp_replace(c, r"[^\w\s-]", ""), r"\s+", "_"), F.lit(255))


def alphanumeric(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9]", "")


def whole_sentences(c: Column) -> Column:
    """The text up to its last full stop; all of it if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(?s)^(.*\.)", 1), F.lit("")), c)


def endpoint_of(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("/chat/")), "chat").when(F.contains(url, F.lit("/messages")), "messages").when(F.contains(url, F.lit("/embeddings")), "embeddings").when(F.contains(url, F.lit("/completions")), "completions").otherwise("chat")


def count_of(c: Column, term: str) -> Column:
    """Non-overlapping occurrences, case aside."""
    return ((F.length(c) - F.length(F.replace(F.lower(c), F.lit(term), F.lit("")))) / len(term)).cast("int")


def sentiment(c: Column, bullish: list[str], bearish: list[str]) -> tuple[Column, Column]:
    """Balance of two keyword lists from -1 to 1 (0 without hits), and the number of hits."""
    add = lambda terms: sum((count_of(c, t) for t in terms[1:]), count_of(c, terms[0]))
    bull, bear = add(bullish), add(bearish)
    return F.when(bull + bear > 0, (bull - bear) / (bull + bear)).otherwise(0.0), bull + bear


def front_matter(title: Column) -> Column:
    return F.regexp_like(F.coalesce(title, F.lit("")), F.lit(r"(?i)\bchapter\s*0\b|preface|front\s*matter"))


def contains_any(c: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(F.lower(c), F.lit(t.lower()))
    return F.coalesce(out, F.lit(False))
