"""Scalars and parsers on literal cases."""

import json

import pytest
from pyspark.sql import functions as F

from plazaflow.functions import parsing
from plazaflow.functions import parsing as p
from plazaflow.functions import rewards as r
from plazaflow.functions import text as t


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [tuple(row)[1:] if len(columns) > 1 else row[1] for row in df.select("i", *columns).orderBy("i").collect()]


def test_normalising(spark):
    got = values(spark, ["  a  b\n", "", None], t.normalise_space(F.col("x")), t.normalise_or_empty(F.col("x")), F.size(t.words(F.col("x"))))
    assert got == [("a b", "a b", 2), ("", "", 0), (None, "", 0)]
    assert values(spark, ["a", None], t.hash_text(F.col("x")))[1] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_think_blocks(spark):
    x = F.col("x")
    cases = ["<think>a</think>b", "b<think>a</think>", "<think> </think>b", "<think>a</think><think>c</think>", "b", " ", None]
    assert values(spark, cases, t.think_error(x)) == [None, "not_at_start", "empty_block", "several_blocks", "no_block", "empty", "empty"]
    assert values(spark, ["<think>a</think> b", "a</think>b", "c"], t.after_think(x)) == ["b", "b", "c"]
    assert values(spark, ["a</think>b", "<think>a</think>"], t.with_opening_think(x)) == ["<think>a</think>b", "<think>a</think>"]
    assert values(spark, ["<think>a</think> b <think>c</think>"], t.without_blocks(x, "think")) == ["b"]
    assert values(spark, ["<think>a</think> b <think> c</think>"], t.all_between(x, "think")) == [["a", "c"]]


def test_call_tags(spark):
    x = F.col("x")
    cases = ["<tool_call>{}</tool_call>", "<tool_call>{}", "{}</tool_call>", "</tool_call><tool_call>", "none"]
    assert values(spark, cases, t.call_error(x)) == [None, "unclosed", "unopened", "reversed", None]
    assert values(spark, ["<tool_call>a</tool_call>", "<tool_call>a</tool_call><tool_response>b", "x"], t.unanswered_call(x)) == [True, False, False]
    assert values(spark, ["<repl>x", "fine", None], t.forged_output(x)) == [True, False, False]
    assert values(spark, ["<python> a </python> t <bash>b</bash>"], t.code_blocks(x)) == [["a", "b"]]


def test_strippers(spark):
    x = F.col("x")
    assert values(spark, ["1. (a) Why?", "Q2: What", "3.5 metres", "1/2 of it", "- item"], t.strip_numbering(x)) == ["Why?", "What", "3.5 metres", "1/2 of it", "item"]
    assert values(spark, ['"a"', "'b'", "'c\"", '"'], t.strip_quotes(x)) == ["a", "b", "'c\"", '"']
    assert values(spark, ["```json\n{}\n```", "x"], t.strip_fences(x)) == ["{}", "x"]
    assert values(spark, ["A b. C", "none"], t.whole_sentences(x)) == ["A b.", "none"]


def test_numbers(spark):
    x = F.col("x")
    assert values(spark, ["$1,200", "5km", "12 %", "x", None], t.number_of(x)) == [1200.0, 5.0, 12.0, None, None]
    assert values(spark, ["1.5M", "2k", "$3", "x"], t.suffixed_number(x)) == [1.5e6, 2000.0, 3.0, None]
    assert values(spark, ["1,234", "7.5", ""], t.coerce_int(x)) == [1234, None, None]


def test_degeneracy(spark):
    x = F.col("x")
    assert values(spark, ["a b c d e " * 6, "a b c d e", None], t.ngram_repetition(t.words(x))) == [6, 1, 0]
    assert values(spark, ["line\n" * 5, "a\nb"], t.line_repetition(x)) == [5, 1]
    assert values(spark, ["<think>" + "q w e r t " * 9 + "</think>fine", "q w e r t " * 9, "k " * 80, None], t.degenerate(x)) == [False, True, True, False]
    assert values(spark, ["k " * 80, "a b c", "k " * 30 + "z " * 10], t.token_loop(x)) == [True, False, True]
    assert values(spark, ["ab" + "!" * 40, "ab   ", "", None], t.trailing_run(x)) == [40, 0, 0, 0]
    assert values(spark, ["go go go stop", "go GO go", ""], t.word_run(x)) == [3, 1, 0]


def test_pair_errors(spark):
    cases = [
        (None, "b", "empty_human"), ("a question here", " ", "empty_reply"), ("same text here", "same text here", "identical"), ("short", "a long enough reply", "short_human"),
        ("a question here", "short", "short_reply"), ("questionable one", "a fine long reply", "few_words_human"), ("a question here", "replyreply one", "few_words_reply"),
        ("no no no no is it", "a fine long reply", "word_run_human"), ("a question here", "fill [blank] in please", "placeholder"), ("a question here", "a fine long reply", None),
    ]
    df = spark.createDataFrame([(i, h, g) for i, (h, g, _) in enumerate(cases)], "i int, h string, g string")
    assert [row[0] for row in df.orderBy("i").select(t.pair_error(F.col("h"), F.col("g"))).collect()] == [c[2] for c in cases]


def test_boxed():
    text = r"\boxed{1} so final answer: \boxed{a^{2} + \{b\}} and \boxed{x"
    assert p.boxed_all(text) == ["1", r"a^{2} + \{b\}"] and p.boxed_final(text) == r"a^{2} + \{b\}"
    assert p.boxed_final(r"\boxed{3} and \boxed{4}") == "4" and p.boxed_final("none") is None


def test_json_and_calls():
    assert p.json_cascade('x ```json\n{"b": 1, "a": [1, 2]}\n``` y') == '{"a":[1,2],"b":1}'
    assert p.json_cascade("{'a': None}") == '{"a":null}' and p.json_cascade('see {"k": "}"} end') == '{"k":"}"}' and p.json_cascade("no") is None
    calls = p.tool_calls('<tool_call>{"name": "f", "arguments": {"x": 1}}</tool_call><tool_call>{\'name\': \'f\', \'arguments\': {\'x\': 1}}</tool_call><tool_call>bad</tool_call>')
    assert calls == [{"name": "f", "arguments": '{"x":1}'}]
    more = [{"name": "f", "arguments": '{"x":1,"y":2}'}]
    assert p.calls_match(calls, calls) and not p.calls_match(calls, more) and p.calls_match(more, calls, whole=False) and not p.calls_match(more, calls)
    tools = json.dumps([{"type": "function", "function": {"name": "f", "parameters": {"properties": {"x": {"type": "integer"}}, "required": ["x"]}}}])
    assert p.call_errors(calls, tools) == [] and p.call_errors([{"name": "g", "arguments": "{}"}, {"name": "f", "arguments": "{}"}], tools) == ["g: unknown tool", "f: $.x: missing"]
    assert p.schema_check('{"a": [1, "x"]}', '{"type":"object","properties":{"a":{"type":"array","items":{"type":"integer"}}}}') == ["$.a[1]: not integer"]
    assert p.json_type("List[int]") == "array" and p.json_type("str, optional") == "string"
    assert p.json_leaves('{"a": {"b": [1, 2.5]}, "t": "2024-01-02T03:04:05Z", "f": true}') == [{"path": "a.b[0]", "type": "integer"}, {"path": "a.b[1]", "type": "numeric"}, {"path": "t", "type": "timestamp"}, {"path": "f", "type": "boolean"}]
    assert p.flatten_json('{"a": {"k": 1}, "b": {"k": 2}}') == {"a.k": "1", "b.k": "2"} and p.flatten_json("x") is None


def test_calculator_takes_no_code():
    assert p.calculate("(1 + 2) * 3 / 4") == 2.25 and p.calculate("2 ** 10") == 1024
    assert p.calculate("__import__('os')") is None and p.calculate("9 ** 9 ** 9") is None and p.calculate("1 / 0") is None


def test_html_and_chunks():
    page = p.html_page("<html><head><title>t</title></head><body><script>x()</script><p>A <b>b</b></p><table><tr><th>h<th>i</tr><tr><td>1<td>2</tr></table>&amp;</body></html>")
    assert page["paragraphs"] == ["A b"] and page["tables"] == [[["h", "i"], ["1", "2"]]] and page["text"].endswith("&") and "x()" not in page["text"]
    assert p.table_markdown([["h", "i"], ["1"]]) == "| h | i |\n| --- | --- |\n| 1 |  |"
    text = "\n\n".join(f"Paragraph {i} has some words in it." for i in range(20))
    chunks = p.semantic_chunks(text, 60, 120)
    assert all(60 <= len(c["text"]) <= 130 for c in chunks[:-1]) and sum(c["end_pos"] - c["start_pos"] for c in chunks) == sum(len(c["text"]) for c in chunks)
    assert p.semantic_chunks("") == [] and p.ratio("Nurse", "nurse") == 100


def test_rewards(spark):
    rows = [(True, 2, 1, 10, [0.5], 1.0), (False, 5, 0, 0, [], -0.5), (None, 0, 0, 10, [1.0], 1.0)]
    df = spark.createDataFrame(rows, "ok boolean, code int, errs int, most int, steps array<double>, final double")
    c = F.col
    got = df.select(r.simple(c("ok"), F.lit(0.25)), r.efficiency(c("ok"), c("code"), c("errs"), c("most")), r.appended(c("steps"), c("final"))).collect()
    assert [tuple(x) for x in got] == [(1.25, pytest.approx(1.3), [0.5, 1.0]), (-0.25, -0.5, [-0.5]), (0.25, -0.5, [1.0])]
    assert df.select(r.upper_median(F.array(F.lit(3.0), F.lit(1.0), F.lit(2.0), F.lit(4.0)))).first()[0] == 3.0
    assert df.select(r.composite(F.lit(None).cast("double"), F.lit(1.0)), r.squashed(F.lit(-3.0), F.lit(1.0)), r.backoff(1.0, 2.0, F.lit(3), most=5.0)).first() == (0.4, 0.5, 5)


def test_token_budgets_match_the_tokenizer(spark):
    import json

    from plazaflow.functions import tokens

    v = tokens.installed()
    if v is None:
        pytest.skip("no vocabulary is installed")
    e = tokens.encoding(v)
    texts = ["", "a few plain words, and 123 numbers", "日本語 🦊 ü" * 5, " \n" * 30, "x" * 500, None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string")
    got = df.select("k", tokens.count_col(F.col("x"), v).alias("n"), tokens.truncate_col(F.col("x"), 7, v).alias("cut"), tokens.embedding_input(F.col("x"), 1003, v).alias("input")).orderBy("k").collect()
    for r, x in zip(got, texts, strict=True):
        ids = e.encode_ordinary(x or "")
        assert (r.n, r.cut, r.input) == (len(ids), e.decode(ids[:7]), e.decode(ids[:3]))
    n = lambda x: len(e.encode_ordinary(x))
    calls = [{"id": "1"}]
    chat = {"messages": [{"role": "user", "content": "hello there", "name": "bob"}, {"role": "assistant", "content": "", "tool_calls": calls}], "n": 2, "max_tokens": 30}
    assert tokens.request(json.dumps(chat), "chat", v) == 4 + n("user") + n("hello there") + n("bob") - 1 + 4 + n("assistant") + n(json.dumps(calls)) + 2 + 60
    assert tokens.request(json.dumps({"prompt": ["a b", "c"], "n": 3}), "completions", v) == n("a b") + n("c") + 2 * 45
    assert tokens.request(json.dumps({"input": "some input"}), "embeddings", v) == n("some input")
    assert tokens.request(json.dumps({"messages": [{"content": "x y"}, {"content": [{"text": "z"}, {"image": 1}]}], "max_tokens": 9}), "messages", v) == n("x y") + n("z") + 9
    with pytest.raises(ValueError):
        tokens.request("{}", "images", v)


def test_chunks_by_plain_packing():
    """Runs of segments, packed one after the other."""
    import random

    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(["Word one", " and more", ". Next", ".\n\nPara", "!  So", "\n\n- item", "\n\n2. two", "\nHEAD: \n", "\n\n\n\n", " x" * 20]) for _ in range(rng.randint(0, 40)))
        least, most = rng.choice([(20, 60), (50, 60), (1, 1), (60, 20), (200, 1000)])
        parts = [s for s in map(str.strip, parsing._CUT.split(parsing.re.sub(r"\n{3,}", "\n\n", text).strip())) if s]
        want, run, before, at = [], [], 0, 0
        for k, s in enumerate([*parts, None]):
            size = sum(map(len, run))
            if run and (s is None or size >= least or size + len(s) > most):
                joined = "\n\n".join(run)
                want.append((joined, at, at + len(joined)))
                at, run = before, []
            if s is not None:
                run.append(s)
                before += len(s) + 2
        assert [(c["text"], c["start_pos"], c["end_pos"]) for c in parsing.semantic_chunks(text, least, most)] == want, (text, least, most)


def test_boxes_and_balanced_parts():
    assert parsing.boxed_all(r"\boxed{a and \boxed{b}") == ["b"]
    assert parsing.boxed_all(r"\boxed{n \boxed {b}} \boxed x \boxed{\}}") == [r"n \boxed {b}", "b", r"\}"]
    assert parsing.first_balanced('x {"a": "}"} [1]') == '{"a": "}"}' and parsing.first_balanced("{ [1, 2] {") == "[1, 2]" and parsing.first_balanced("{[" * 50_000) is None
    assert parsing.split_pages("x" * 2000, 1000, 150)[-1] == {"text": "x" * 300, "start_pos": 1700, "end_pos": 2000} and parsing.split_pages("") == []


def test_text_wrappers_around_texts_with_their_own(spark, tmp_path):
    import duckdb

    from plazaflow.plans.catalog import QUERIES, SQL

    texts = ['say "no"', '"all"', "'one'", '"', "it's 5\" wide", "1. first", "- (b) two", "2) (c) - three", "```\ncode\n```", "```json", "end```", "</think> after", "<think>a</think> b", "3.5 apples", 'a\n"b"\n"']
    df = spark.createDataFrame([(4 * i + k, t) for i, t in enumerate(texts) for k in range(4)], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = QUERIES["text_wrappers"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL['text_wrappers']})").fetchall())
