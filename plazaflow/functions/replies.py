"""Validators and converters of model replies, tool schemas and provider records: plain functions with Column forms for batches."""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import parsing
from .parsing import arrow_udf, boxed_final, calls_match, first_balanced, literal, tool_calls

_THINK = re.compile(r"<think>(.*?)</think>", re.S)
_CALL = re.compile(r"<tool_call>.*?</tool_call>", re.S)


def compact(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True, default=str)


# ---- replies --------------------------------------------------------------------------------------------------------


def think_blocks(text: str) -> list[str]:
    return [b.strip() for b in _THINK.findall(text)]


def think_then_calls(text: str) -> bool:
    """One think block, then one or more parsable calls, and nothing else."""
    blocks, calls = _THINK.findall(text), _CALL.findall(text)
    rest = _CALL.sub("", _THINK.sub("", text)).strip()
    return len(blocks) == 1 and bool(blocks[0].strip()) and bool(calls) and not rest and len(parsing.tool_calls(text)) > 0 and text.strip().startswith("<think>") and all(_parsable(c) for c in calls)


def _parsable(block: str) -> bool:
    try:
        return isinstance(literal(re.sub(r"</?tool_call>", "", block)), dict)
    except ValueError:
        return False


def think_then_text(text: str) -> bool:
    """One non-empty think block at the start, no calls."""
    blocks = _THINK.findall(text)
    return len(blocks) == 1 and bool(blocks[0].strip()) and text.strip().startswith("<think>") and "<tool_call>" not in text


def reply_valid(text: str, require_think: bool = True) -> bool:
    """Think and calls, or think and text; without ``require_think`` the calls alone must parse."""
    if "<tool_call>" in text:
        return think_then_calls(text) if require_think else all(_parsable(c) for c in _CALL.findall(text)) and bool(_CALL.findall(text))
    return think_then_text(text) if require_think else bool(text.strip())


def generation_error(text: str | None, expected: str | None, calls_expected: bool = True) -> str | None:
    """Why a generation doesn't stand beside its ground truth (both with call tags); null if it does."""
    if not (text or "").strip():
        return "empty_output"
    got, want = tool_calls(text), tool_calls(expected or "")
    if not calls_expected:
        return "unexpected_tool_calls" if got else None
    if not reply_valid(text):
        return "invalid_format" if "<tool_call>" in text else "missing_tool_calls"
    if not got:
        return "missing_tool_calls"
    return None if calls_match(got, want) and calls_match(want, got, whole=True) else "tool_mismatch"


def normal_number(text: str | None) -> str | None:
    """A number without percent, currency, commas, spaces and one unit, as float text; null if it is none."""
    bare = re.sub(r"[%$,\s]", "", (text or "").lower())
    bare = re.sub(r"(?:km|cm|mm|kg|mg|m|g|s|h|l)$", "", bare)
    try:
        return str(float(bare))
    except ValueError:
        return None


def interleaved_error(text: str, expected: str | None = None, need_box: bool = True) -> str | None:
    """Checks of a reply that calls tools while thinking: tags, calls inside think only, a box, and the expected answer within 1e-5."""
    if "<think>" not in text:
        return "no_think"
    if text.count("<think>") != text.count("</think>"):
        return "unclosed_think"
    tail = text[text.rindex("</think>") + len("</think>") :]
    if "<tool_call>" in _THINK.sub("", text):
        return "call_outside_think"
    box = boxed_final(tail) or boxed_final(text)
    if need_box and box is None:
        return "no_box"
    if expected is not None and box is not None:
        a, b = normal_number(box), normal_number(expected)
        if not (math.isclose(float(a), float(b), rel_tol=1e-5) if a and b else box.strip().lower() == expected.strip().lower()):
            return "wrong_answer"
    return None


def arguments_match(got: str, want: str) -> bool:
    """As many arguments, all of them equal."""
    try:
        a, b = json.loads(got), json.loads(want)
    except ValueError:
        return False
    return isinstance(a, dict) and a == b


def missing_arguments(got: str, required: list) -> list[str]:
    try:
        have = json.loads(got)
    except ValueError:
        have = {}
    return sorted(set(required) - set(have if isinstance(have, dict) else {}))


def question_of(text: str) -> str:
    """The ``question`` of a JSON text, or the text."""
    try:
        got = json.loads(text)
        return str(got["question"]).strip() if isinstance(got, dict) and got.get("question") else text
    except ValueError:
        m = re.search(r'"question"\s*:\s*"((?:[^"\\]|\\.)*)"', text)
        return json.loads(f'"{m[1]}"') if m else text


def outermost(text: str) -> str | None:
    """From the first ``{`` to the last ``}``."""
    a, b = text.find("{"), text.rfind("}")
    return text[a : b + 1] if 0 <= a < b else None


def verdict(text: str) -> dict:
    """verdict, score and reason of a judge's reply; unclear with 0 if it can't be read."""
    try:
        got = json.loads(parsing.json_cascade(text) or "null")
        return {"verdict": str(got.get("verdict", "unclear")).lower(), "score": float(got.get("score", 0.0)), "reason": got.get("reason")}
    except (ValueError, AttributeError, TypeError):
        return {"verdict": "unclear", "score": 0.0, "reason": None}


def last_call(text: str) -> dict | None:
    """The last call, closed or not."""
    if "<tool_call>" not in text:
        return None
    body = text[text.rindex("<tool_call>") + len("<tool_call>") :].split("</tool_call>")[0]
    for part in (body, first_balanced(body)):
        try:
            got = literal(part) if part else None
            if isinstance(got, dict) and isinstance(got.get("name"), str):
                return {"name": got["name"], "arguments": compact(got.get("arguments", {}))}
        except ValueError:
            pass
    return None


def canonical_calls(text: str) -> str:
    """The text with the body of each call as compact JSON; bodies that can't be read stay."""

    def one(m):
        try:
            return f"<tool_call>{compact(literal(re.sub(r'</?tool_call>', '', m[0])))}</tool_call>"
        except ValueError:
            return m[0]

    return _CALL.sub(one, text)


def fenced(text: str, kind: str) -> list[str]:
    """Compact JSON of all fenced blocks of a kind that can be read."""
    out = []
    for body in re.findall(rf"```{re.escape(kind)}\s*\n(.*?)```", text, re.S):
        try:
            out.append(compact(literal(body)))
        except ValueError:
            pass
    return out


def call_text(name: str, arguments: str) -> str:
    return f"<tool_call>\n{compact({'name': name, 'arguments': json.loads(arguments)})}\n</tool_call>"


def response_text(name: str, content: str) -> str:
    try:
        content = json.loads(content)
    except ValueError:
        pass
    return f"<tool_response>\n{compact({'name': name, 'content': content})}\n</tool_response>"


def type_names(text: str) -> list[str]:
    """Names that a namespace of types declares."""
    return re.findall(r"(?m)^\s*type\s+(\w+)\s*=", text)


def market_action(text: str) -> dict:
    """A bid, an ask, or hold with zeros, from a proposing message."""
    try:
        got = json.loads(parsing.json_cascade(text) or "null")
        kind = got.get("message_type", got.get("performative"))
        action = got.get("content", got)
        side = str(action.get("action", "hold")).lower()
        if kind in ("propose", "request") and side in ("bid", "ask"):
            return {"action": side, "price": float(action.get("price", 0)), "quantity": int(action.get("quantity", 0))}
    except (ValueError, AttributeError, TypeError):
        pass
    return {"action": "hold", "price": 0.0, "quantity": 0}


# ---- schemas --------------------------------------------------------------------------------------------------------


def enum_list(value) -> list:
    return list(value) if isinstance(value, (dict, list, tuple)) else [value]


def fixed_schema(schema):
    """Type names as JSON types, enums as lists, through all levels."""
    if isinstance(schema, list):
        return [fixed_schema(x) for x in schema]
    if not isinstance(schema, dict):
        return schema
    out = {k: fixed_schema(v) for k, v in schema.items()}
    if isinstance(out.get("type"), str):
        inner = re.fullmatch(r"\s*(?:list|tuple|set|array)\s*\[(.*)\]\s*", out["type"], re.I)
        if inner and "items" not in out:
            out["items"] = {"type": parsing.json_type(inner[1])}
        out["type"] = parsing.json_type(out["type"])
    if "enum" in out:
        out["enum"] = enum_list(out["enum"])
    return out


def fixed_tool(text: str) -> str | None:
    """A tool as a function tool with a JSON schema; parameters are required unless they are marked optional or have a default."""
    try:
        tool = literal(text)
    except ValueError:
        return None
    f = dict(tool.get("function", tool))
    p = f.get("parameters") or {}
    properties = p.get("properties", p if "type" not in p else {})
    optional = [k for k, v in properties.items() if isinstance(v, dict) and ("default" in v or "optional" in str(v.get("type", "")).lower() or v.get("required") is False)]
    required = p.get("required", [k for k in properties if k not in optional])
    f["parameters"] = {"type": "object", "properties": {k: fixed_schema(v) for k, v in properties.items()}, "required": list(required)}
    return compact({"type": "function", "function": f})


def named_tools(text: str) -> list[str]:
    """Tools of a JSON array that have a function name."""
    try:
        return [compact(t) for t in literal(text) if isinstance(t, dict) and isinstance(t.get("function"), dict) and t["function"].get("name")]
    except (ValueError, TypeError):
        return []


def lacks_descriptions(text: str) -> bool:
    """Whether any tool has a blank description."""
    return any(not str(t.get("function", t).get("description") or "").strip() for t in literal(text))


def message_error(role: str, content: str | None, name: str | None = None) -> str | None:
    """Role, content and name rules of a chat message."""
    if role not in ("system", "user", "assistant", "tool", "function"):
        return "unknown_role"
    if role != "assistant" and not (content or "").strip():
        return "empty_content"
    if role in ("tool", "function") and not name:
        return "no_name"
    return None


# ---- provider records -----------------------------------------------------------------------------------------------

USAGE = ("prompt_tokens", "completion_tokens", "total_tokens", "cache_creation_input_tokens", "cache_read_input_tokens", "reasoning_tokens", "audio_tokens")


def completion(text: str) -> dict:
    """Content, calls, usage and model of a chat completion or a message response, as one record."""
    try:
        r = json.loads(text)
    except ValueError:
        return {"content": None, "calls": [], "usage": {}, "model": None, "error": "not parsable"}
    usage = {k: int(v) for k, v in (r.get("usage") or {}).items() if isinstance(v, (int, float))}
    if "input_tokens" in usage:
        usage |= {"prompt_tokens": usage.pop("input_tokens"), "completion_tokens": usage.pop("output_tokens", 0)}
        usage["total_tokens"] = usage["prompt_tokens"] + usage["completion_tokens"]
    if isinstance(r.get("choices"), list) and r["choices"]:
        m = r["choices"][0].get("message") or {}
        calls = [c["function"] for c in m.get("tool_calls") or [] if isinstance(c.get("function"), dict)]
        content = m.get("content")
        calls = [{"name": c.get("name"), "arguments": c.get("arguments") if isinstance(c.get("arguments"), str) else compact(c.get("arguments", {}))} for c in calls]
    else:
        blocks = r.get("content") if isinstance(r.get("content"), list) else []
        content = "".join(b.get("text", "") for b in blocks if b.get("type") == "text") or None
        calls = [{"name": b.get("name"), "arguments": compact(b.get("input", {}))} for b in blocks if b.get("type") == "tool_use"]
    return {"content": content, "calls": calls, "usage": usage, "model": r.get("model"), "error": (r.get("error") or {}).get("message") if isinstance(r.get("error"), dict) else r.get("error")}


COMPLETION = f"content string, calls {parsing.CALLS}, usage map<string,bigint>, model string, error string"


def completion_col(c: Column) -> Column:
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([completion(x or "null") if x else completion("") for x in s], columns=["content", "calls", "usage", "model", "error"])

    return F.pandas_udf(run, COMPLETION)(c)


def usage_totals(usages: Column) -> Column:
    """Sums by kind over an array of usage maps."""
    return F.transform_values(F.map_from_arrays(F.array(*map(F.lit, USAGE)), F.array(*map(F.lit, USAGE))), lambda k, _: F.aggregate(usages, F.lit(0).cast("long"), lambda s, u: s + F.coalesce(F.try_element_at(u, k), F.lit(0))))


reply_valid_col = parsing._column(reply_valid, "boolean")
generation_error_col = lambda a, b: arrow_udf(lambda x, y: generation_error(x, y), "string", 2)(F.coalesce(a, F.lit("")), b)
interleaved_error_col = parsing._column(interleaved_error, "string", 2)
canonical_calls_col = parsing._column(canonical_calls, "string")
question_of_col = parsing._column(question_of, "string")
fixed_tool_col = parsing._column(fixed_tool, "string")
verdict_col = lambda c: F.from_json(arrow_udf(lambda x: compact(verdict(x)), "string")(c), "verdict string, score double, reason string")
