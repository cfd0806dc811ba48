"""Replies, records, tasks, personas, rounds, and the extension points."""

import json

import pytest
from pyspark.sql import functions as F

from plazaflow.functions import replies as r
from plazaflow.operators import personas, records
from plazaflow.plans.extension import Registry, Workflow, embed, infer, input_schema
from plazaflow.sources import tasks
from plazaflow.streaming import rounds

CALL = '<think>why</think><tool_call>{"name": "f", "arguments": {"x": 1}}</tool_call>'


def test_reply_validation():
    assert r.think_then_calls(CALL) and r.reply_valid(CALL) and not r.reply_valid(CALL + " more") and r.reply_valid("<think>a</think>b") and not r.reply_valid("b")
    assert r.generation_error("", CALL) == "empty_output" and r.generation_error(CALL, CALL) is None
    assert r.generation_error("<think>a</think>b", CALL) == "missing_tool_calls" and r.generation_error(CALL.replace("1", "2"), CALL) == "tool_mismatch"
    assert r.generation_error(CALL, None, calls_expected=False) == "unexpected_tool_calls" and r.generation_error(CALL + "x", CALL) == "invalid_format"
    ok = "<think>t <tool_call>{}</tool_call></think> so \\boxed{5.0}"
    assert r.interleaved_error(ok, "5") is None and r.interleaved_error(ok, "6") == "wrong_answer" and r.interleaved_error("x") == "no_think"
    assert r.interleaved_error("<think>a</think><tool_call>{}</tool_call>") == "call_outside_think" and r.interleaved_error("<think>a</think>b") == "no_box"
    assert r.normal_number("$1,200 kg") == "1200.0" and r.normal_number("5km") == "5.0" and r.normal_number("x") is None


def test_reply_converters():
    assert r.question_of('{"question": "q"}') == "q" and r.question_of('bad "question": "a\\"b" x') == 'a"b' and r.question_of("t") == "t"
    assert r.verdict('{"verdict": "Correct", "score": 0.5}') == {"verdict": "correct", "score": 0.5, "reason": None} and r.verdict("?")["verdict"] == "unclear"
    assert r.last_call('<tool_call>{"name": "g", "arguments": {}}') == {"name": "g", "arguments": "{}"} and r.last_call("x") is None
    assert r.canonical_calls("<tool_call>{'name': 'f'}</tool_call>") == '<tool_call>{"name":"f"}</tool_call>'
    assert r.fenced("```tool_call\n{'a': 1}\n```", "tool_call") == ['{"a":1}'] and r.outermost("a {b} c}") == "{b} c}"
    tool = json.loads(r.fixed_tool("{'name': 'f', 'parameters': {'a': {'type': 'List[int]'}, 'b': {'type': 'str, optional', 'enum': {'p': 1}}}}"))
    p = tool["function"]["parameters"]
    assert p["required"] == ["a"] and p["properties"]["a"] == {"type": "array", "items": {"type": "integer"}} and p["properties"]["b"] == {"type": "string", "enum": ["p"]}
    assert r.lacks_descriptions('[{"name": "f", "description": " "}]') and r.message_error("tool", "x") == "no_name" and r.message_error("user", " ") == "empty_content"
    assert r.market_action('{"message_type": "propose", "content": {"action": "Bid", "price": 3, "quantity": 1}}') == {"action": "bid", "price": 3.0, "quantity": 1}
    assert r.market_action("no")["action"] == "hold" and r.missing_arguments('{"a": 1}', ["a", "b"]) == ["b"] and r.type_names("type f = () => any;") == ["f"]
    assert json.loads(r.response_text("f", '{"x": 1}')[len("<tool_response>") : -len("</tool_response>")]) == {"name": "f", "content": {"x": 1}}


def test_completions(spark):
    texts = ['{"model": "m", "choices": [{"message": {"content": null, "tool_calls": [{"function": {"name": "f", "arguments": "{}"}}]}}], "usage": {"prompt_tokens": 3}}', '{"content": [{"type": "text", "text": "hi"}, {"type": "tool_use", "name": "g", "input": {"x": 1}}], "usage": {"input_tokens": 2, "output_tokens": 5}}', "broken"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [x.c for x in df.orderBy("i").select(r.completion_col(F.col("t")).alias("c")).collect()]
    assert (got[0].calls[0].name, got[0].usage) == ("f", {"prompt_tokens": 3}) and (got[1].content, got[1].usage["total_tokens"]) == ("hi", 7) and got[2].error == "not parsable"
    total = df.select(r.completion_col(F.col("t"))["usage"].alias("u")).agg(F.collect_list("u").alias("us")).select(r.usage_totals(F.col("us")).alias("t")).first().t
    assert total["prompt_tokens"] == 5 and total["reasoning_tokens"] == 0
    bad = spark.createDataFrame([(CALL, CALL), (None, CALL)], "a string, b string").select(r.generation_error_col(F.col("a"), F.col("b"))).collect()
    assert [x[0] for x in bad] == [None, "empty_output"]


def test_sections_and_charts(spark):
    from plazaflow.functions import parsing as p
    from plazaflow.operators import conversations as c

    assert p.sections("lead\n# One\n- a\n2. b\nNext:\nplain") == [{"title": "", "points": ["lead"]}, {"title": "One", "points": ["a", "b"]}, {"title": "Next", "points": ["plain"]}]
    assert p.html_charts('<div class="x bar-chart" aria-label="d"><h2>T</h2></div><div class="y">n</div>') == [{"type": "bar", "title": "T", "data": "", "description": "d"}]
    conv = spark.createDataFrame([([("gpt", "<tool_call>"), ("tool", "r"), ("gpt", "end")],)], "c array<struct<from:string,value:string>>")
    assert [t["from"] for t in conv.select(c.with_reasoning(F.col("c"), F.lit("b"), F.lit("a"))).first()[0]] == ["reasoning", "gpt", "tool", "reasoning", "gpt"]


def test_records(spark):
    e = spark.createDataFrame([("c", 1, "f", "call", "a"), ("c", 2, "f", "call", "b"), ("c", 3, "f", "response", "A")], "conv string, at int, name string, kind string, payload string")
    assert sorted((x.call, x.response) for x in records.paired_responses(e, "conv", "at").collect()) == [("a", "A"), ("b", None)]
    calls = "array<struct<name:string,arguments:string>>"
    s = spark.createDataFrame([([("f", '{"x":1,"y":2}')], [("f", '{"x":1}')]), ([], [("f", "{}")])], f"generated {calls}, expected {calls}")
    got = records.evaluated(s)
    assert [x.passed for x in got.collect()] == [True, False] and records.pass_rate(got).first().pass_rate == 0.5
    conv = [("human", "q"), ("gpt", "<think>t</think> \\boxed{\\frac{1}{2}}"), ("human", "p"), ("gpt", "k " * 90)]
    df = spark.createDataFrame([("1", conv)], "id string, conversations array<struct<from:string,value:string>>")
    v = records.verifiable_turns(df).first()
    assert (v.question, v.boxed) == ("q", "1/2") and len(records.cleaned(df).first().conversations) == 2
    runs = spark.createDataFrame([("t", "\\boxed{4}", "4", [("a", None)], [0.5], 1.0)], "task_id string, final_answer string, expected string, turns array<struct<role:string,code:string>>, step_rewards array<double>, final_reward double")
    row = records.recomputed_rewards(records.trajectory_rows(runs)).first()
    assert (row.answer_correct, row.num_code_blocks, row.total_reward, row.step_rewards) == (True, 0, 1.5, [0.5, 1.0])
    turns = spark.createDataFrame([("c", 1, "assistant", "<tool_call>"), ("c", 2, "tool", "r"), ("c", 3, "assistant", "<tool_call>"), ("c", 4, "tool", "r"), ("d", 1, "assistant", "<tool_call>"), ("d", 2, "user", "u"), ("d", 3, "assistant", "<tool_call>"), ("d", 4, "tool", "r")], "conv string, at int, role string, text string")
    assert {x.conv: x.sequential for x in records.sequential_tools(turns, "conv", "at").collect()} == {"c": True, "d": False}
    one = spark.range(1)
    assert one.select(records.mean_of_present(F.lit(1.0), F.lit(None), F.lit(2.0)), records.level_label(F.lit(0)), records.level_label(F.lit(99)), records.target_level(F.array(F.lit("a"), F.lit("b")), F.lit(7))).first() == (1.5, "b", "z", "b")
    packed = records.packed_documents(spark.createDataFrame([("g", 1, "abc"), ("g", 2, "def"), ("g", 3, "g" * 9)], "g string, i int, text string"), ["g"], "i", "text", 7).first()
    assert (packed.packed, packed.documents) == ("abc\n\ndef", 2)


def test_tasks(spark, tmp_path):
    df = spark.createDataFrame([(None, "d", "c"), ("own", "", "c")], "id string, description string, category string")
    assert [x.id for x in tasks.tasks(df, "file", F.col("description")).orderBy("id").collect()] == ["file_2", "own"]
    assert [x.errors for x in tasks.task_errors(df).collect()] == [["no description"]]
    assert tasks.read_or_empty(spark, f"{tmp_path}/none", "key string").count() == 0
    tasks.save_keys(df.where("id IS NOT NULL"), "id", f"{tmp_path}/keys")
    assert tasks.resume_keys(spark, f"{tmp_path}/keys").collect() == [("own",)]
    found = spark.createDataFrame([(1, "bsc"), (2, "eth")], "pos int, chain string")
    assert tasks.resolve_pair(found, "Ethereum").first().pos == 2 and tasks.resolve_pair(found, "base").first().pos == 1 and tasks.boosted(found, "BNB", 5).first().pos == 1
    nested = spark.createDataFrame([((("v",),),)], "a struct<b:struct<c:string>>")
    assert nested.select(tasks.nested(nested, "a.b.c"), tasks.nested(nested, "a.x.c")).first() == ("v", None)
    assert tasks.fetch_one(spark, "SELECT :x + 1 AS y", x=2).y == 3
    ep = spark.createDataFrame([(["plain", '{"a": 1}', '"{\\"b\\": 2}"'],)], "steps array<string>")
    assert [json.loads(x) for x in json.loads(tasks.episode_rows(ep).first().cognitive_steps)] == [{"text": "plain"}, {"a": 1}, {"b": 2}]
    line = tasks.request_lines(spark.createDataFrame([(1, None, "m")], "id int, end_time double, model string"), ["id", "end_time"], ["model"]).first().value
    assert json.loads(line) == [{"id": 1, "end_time": None}, {"model": "m"}]
    pages = spark.createDataFrame([(1, "<table><tr><th>h</th></tr><tr><td>1</td></tr></table>")], "page_id int, html string")
    assert tasks.page_tables(pages).first().markdown == "| h |\n| --- |\n| 1 |"


def test_personas_repeat(spark):
    got = personas.personas(spark.range(2000).withColumnRenamed("id", "pid"), "pid").cache()
    assert got.where("age BETWEEN 18 AND 80 AND openness BETWEEN 0 AND 1 AND income >= 25000").count() == 2000
    again = personas.personas(spark.range(2000).repartition(5).withColumnRenamed("id", "pid"), "pid")
    assert got.exceptAll(again).count() == 0
    share = got.where("age >= 20").groupBy("education").count().collect()
    assert {x.education for x in share} == {"school", "college", "doctorate"} and max(x["count"] for x in share) > 700
    options = spark.createDataFrame([("a", 18, 80, None, 0, 1.0), ("b", 200, 300, "none", 10**9, 1.0)], "name string, min_age int, max_age int, education string, min_income int, weight double")
    assert {x.job for x in personas.one_of_valid(got, options, "pid", "job").collect()} == {"a"}
    assert personas.judges_of(got.limit(5), ["x", "y", "z"], "pid", 2).where("size(judges) = 2").count() == 5
    assert got.where(personas.conditional("age > 30 AND income < 0")).count() == 0


def test_rounds(spark):
    m = spark.createDataFrame([("a", 1, 1, "hi"), ("b", 1, 2, "yo"), ("c", 2, 1, "z")], "agent_id string, round int, at int, text string")
    members = spark.createDataFrame([("a", "k1"), ("b", "k1"), ("c", "k2")], "agent_id string, cohort string")
    assert rounds.cohort_messages(m, members, "b").count() == 2 and rounds.chat_rounds(rounds.cohort_messages(m, members), "cohort", "at", 2).where("done").count() == 1
    tries = spark.createDataFrame([("r", 1, "e1"), ("r", 2, None), ("s", 1, "e"), ("s", 2, "f")], "req string, at int, error string")
    assert {x.req: (x.attempts_left, x.errors, x.status) for x in rounds.retry_state(tries, "req", "at", 2).collect()} == {"r": (0, ["e1"], "succeeded"), "s": (0, ["e", "f"], "failed")}
    pace = rounds.paced(spark.createDataFrame([("c", i, 100) for i in range(3)], "client string, at int, tokens int"), "client", "at", "tokens", 60, 3000)
    assert [x.starts_at for x in pace.orderBy("at").collect()] == [0.0, 2.0, 4.0]
    todo = spark.createDataFrame([(i,) for i in range(5)], "id int")
    assert sorted(x.id for x in rounds.until_complete(todo, "id", lambda left: left.orderBy("id").limit(2)).collect()) == [0, 1, 2, 3, 4]
    acts = spark.createDataFrame([("a", 1, "x"), ("a", 2, ""), ("b", 1, None)], "agent_id string, round int, action string")
    assert [(x.agent_id, x.last_action) for x in rounds.last_actions(acts).collect()] == [("a", "x")]


def test_extension_points(spark):
    def add(a: int, b: int = 2) -> int:
        """Adds."""
        return a + b

    reg = Registry()
    reg.register("add", add, {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "integer"}}, "required": ["a"]})
    assert reg.execute("add", {"a": 1}) == 3 and reg.tool("add")["function"]["description"] == "Adds."
    with pytest.raises(ValueError):
        reg.execute("add", {"a": "x"})
    with pytest.raises(TypeError):
        input_schema(lambda a: a)
    df = spark.createDataFrame([(1, "p"), (2, None)], "i int, prompt string")
    assert [x.output for x in infer(df, lambda ps: [f"{p}!" for p in ps]).orderBy("i").collect()] == ["p!", "None!"]
    assert embed(df, lambda ts: [[float(len(t))] for t in ts], "prompt").where("i = 1").first().embedding == [1.0]
    flow = Workflow(("one", lambda d: d.withColumn("error", F.when(F.col("i") == 2, "bad"))), ("two", lambda d: d.withColumn("out", F.col("i") * 10)))
    assert {x.i: (x.failed, x.out) for x in flow.run(df).collect()} == {1: (None, 10), 2: ("one", None)}


def test_notebook_cuts_one_text(spark):
    rows = [(1, 2, "b"), (1, 1, "ä"), (1, 3, None), (1, 4, "日本"), (None, 2, "y"), (None, 1, None), (2, 1, ""), (2, 2, "z"), (2, 2, "a")]
    df = rounds.notebook(spark.createDataFrame(rows, "k int, at int, t string"), "k", "at", "t")
    got = {(r.k, r.at, r.t): r.log for r in df.collect()}
    assert got == {(1, 1, "ä"): "ä", (1, 2, "b"): "ä\nb", (1, 3, None): "ä\nb", (1, 4, "日本"): "ä\nb\n日本", (None, 1, None): None, (None, 2, "y"): "y", (2, 1, ""): "", (2, 2, "a"): "\na", (2, 2, "z"): "\na\nz"}
    # no list of all cells so far at each cell
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in next(x for x in plan.splitlines() if "Window" in x)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_idle_sessions_to_the_microsecond(spark, kind):
    rows = [("now", "2024-03-31 03:30:00.5"), ("before", "2024-03-31 02:30:00.499999"), ("at", "2024-03-31 02:30:00.5"), ("old", "2024-03-30 01:00:00"), ("old", "2024-03-30 02:00:00"), ("none", None), (None, "2024-03-31 01:00:00")]
    e = spark.createDataFrame(rows, "who string, ts string").withColumn("ts", F.col("ts").cast(kind))
    for now in (F.lit("2024-03-31 03:30:00.5"), e.agg(F.max("ts")).scalar()):
        got = rounds.idle_sessions(e, "who", "ts", now, 3600)
        assert {r.who: str(r.last_seen)[:13] for r in got.collect()} == {"before": "2024-03-31 02", "old": "2024-03-30 02", None: "2024-03-31 01"}
