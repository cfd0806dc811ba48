"""Parsers that have no SQL form, as plain functions and as Arrow-batched UDFs. Nothing here evaluates data as code."""

from __future__ import annotations

import ast
import bisect
import difflib
import html.parser
import itertools
import json
import operator
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def arrow_udf(function: Callable, returns: str, arity: int = 1):
    """A pandas UDF that maps a scalar function over Arrow batches; null in the first argument stays null."""
    if arity == 1:

        def run(s: pd.Series) -> pd.Series:
            return pd.Series([None if x is None else function(x) for x in s], dtype=object)

    else:

        def run(s: pd.Series, t: pd.Series) -> pd.Series:
            return pd.Series([None if x is None else function(x, y) for x, y in zip(s, t, strict=True)], dtype=object)

    return F.pandas_udf(run, returns)


# ---- boxed answers --------------------------------------------------------------------------------------------------

_BOX = re.compile(r"\\boxed\s*\{")
_BRACE = re.compile(r"\\.|[{}]", re.S)
_LABEL = re.compile(r"final\s+answer", re.I)


def boxed_spans(text: str) -> list[tuple[int, str]]:
    """(start, content) of each boxed answer, by start: inner braces balanced, escaped ones skipped, boxes within boxes too; one that isn't closed is left out."""
    starts = {m.end() - 1: m.start() for m in _BOX.finditer(text)}
    held, closed = [], {}
    for m in _BRACE.finditer(text) if starts else ():
        if m[0] == "{":
            held.append(m.start())
        elif m[0] == "}" and held:
            closed[held.pop()] = m.start()
    return [(at, text[brace + 1 : closed[brace]]) for brace, at in starts.items() if brace in closed]


def boxed_all(text: str) -> list[str]:
    return [b for _, b in boxed_spans(text)]


def boxed_final(text: str) -> str | None:
    """The last box behind the last final-answer label, else the last box."""
    spans = boxed_spans(text)
    labels = [m.end() for m in _LABEL.finditer(text)]
    behind = [b for at, b in spans if labels and at >= labels[-1]]
    return (behind or [b for _, b in spans] or [None])[-1]


# ---- JSON and calls -------------------------------------------------------------------------------------------------


def literal(text: str):
    """JSON, else a Python literal; raises ValueError for anything else."""
    try:
        return json.loads(text)
    except ValueError:
        try:
            return ast.literal_eval(text.strip())
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError) as e:
            raise ValueError("neither JSON nor a literal") from e


_TOKEN = re.compile(r'"(?:\\.|[^"\\])*"|[{}\[\]]', re.S)


def first_balanced(text: str) -> str | None:
    """The first balanced object or array, strings respected; brackets of either kind count alike. One that isn't closed is passed over.

    Brackets are read once from the first opening one on, so a text of unclosed brackets takes time in proportion.
    """
    begin = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    held, best = [], None
    for m in _TOKEN.finditer(text, begin) if begin >= 0 else ():
        if m[0] in "{[":
            held.append(m.start())
        elif m[0] in "}]" and held:
            a = held.pop()
            if best is None or a < best[0]:
                best = a, m.end()
            if not held:
                break
    return None if best is None else text[best[0] : best[1]]


def json_cascade(text: str) -> str | None:
    """Compact JSON of the whole text, a fenced block in it, or its first balanced part."""
    fenced = re.search(r"```(?:json)?\s*(.*?)```", text, re.S)
    for part in (text, fenced and fenced[1], first_balanced(text)):
        if part:
            try:
                return json.dumps(literal(part), ensure_ascii=False, separators=(",", ":"), sort_keys=True, default=str)
            except (ValueError, TypeError):
                pass
    return None


_CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)


def tool_calls(text: str) -> list[dict]:
    """name and arguments (compact JSON, keys sorted) of each parsable call; a repeated call counts once."""
    out, seen = [], set()
    for body in _CALL.findall(text):
        try:
            call = literal(re.sub(r"^\s*```\w*|```\s*$", "", body))
        except ValueError:
            continue
        if isinstance(call, dict) and isinstance(call.get("name"), str):
            arguments = json.dumps(call.get("arguments", call.get("parameters", {})), ensure_ascii=False, separators=(",", ":"), sort_keys=True, default=str)
            if (call["name"], arguments) not in seen:
                seen.add((call["name"], arguments))
                out.append({"name": call["name"], "arguments": arguments})
    return out


CALLS = "array<struct<name:string,arguments:string>>"


def calls_match(got: list, expected: list, whole: bool = True) -> bool:
    """Every expected call has one of equal name; ``whole``: and equal arguments, else only the expected arguments must agree."""

    def fits(g, e):
        if g["name"] != e["name"]:
            return False
        a, b = json.loads(g["arguments"] or "{}"), json.loads(e["arguments"] or "{}")
        return a == b if whole else isinstance(a, dict) and all(k in a and a[k] == v for k, v in b.items())

    return all(any(fits(g, e) for g in got) for e in expected)


#: Type names as they stand in signatures, and the JSON types that they mean.
TYPE_NAMES = {"str": "string", "string": "string", "int": "integer", "integer": "integer", "float": "number", "number": "number", "double": "number", "bool": "boolean", "boolean": "boolean", "list": "array", "tuple": "array", "set": "array", "array": "array", "dict": "object", "object": "object", "none": "null", "null": "null", "any": "string"}
_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def json_type(name: str) -> str:
    """The JSON type of the first token of a type name; string if unknown."""
    found = re.match(r"\s*(\w+)", name or "")
    return TYPE_NAMES.get(found[1].lower(), "string") if found else "string"


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """Where a value departs from a JSON schema (type, enum, required, properties, items)."""
    out = []
    kind = schema.get("type")
    if kind in _KINDS and (not isinstance(value, _KINDS[kind]) or (kind in ("integer", "number") and isinstance(value, bool))):
        return [f"{at}: not {kind}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, dict):
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, sub in schema.get("properties", {}).items():
            if k in value:
                out += schema_errors(value[k], sub, f"{at}.{k}")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for k, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{k}]")
    return out


def schema_check(payload: str, schema: str) -> list[str]:
    try:
        return schema_errors(literal(payload), json.loads(schema))
    except ValueError:
        return ["$: not parsable"]


def call_errors(calls: list, signatures: str) -> list[str]:
    """Errors of parsed calls against a JSON array of tools (bare or wrapped as functions)."""
    tools = {}
    for t in json.loads(signatures):
        t = t.get("function", t)
        tools.setdefault(t.get("name"), t.get("parameters", {}))
    out = []
    for c in calls:
        if c["name"] not in tools:
            out.append(f"{c['name']}: unknown tool")
        else:
            out += [f"{c['name']}: {e}" for e in schema_errors(json.loads(c["arguments"]), {"type": "object"} | tools[c["name"]])]
    return out


def json_leaves(text: str, items: int = 5) -> list[dict]:
    """(path, type) of each leaf; arrays are looked at up to ``items`` elements."""
    out: dict[str, str] = {}

    def walk(x, at):
        if isinstance(x, dict):
            for k, v in x.items():
                walk(v, f"{at}.{k}" if at else k)
        elif isinstance(x, list):
            for k, v in enumerate(x[:items]):
                walk(v, f"{at}[{k}]")
        elif isinstance(x, bool):
            out[at] = "boolean"
        elif isinstance(x, int):
            out[at] = "integer"
        elif isinstance(x, float):
            out[at] = "numeric"
        elif isinstance(x, str) and re.fullmatch(r"\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d+)?)?(?:Z|[+-]\d\d:?\d\d)?)?", x):
            out[at] = "timestamp"
        else:
            out[at] = "text"

    try:
        walk(json.loads(text), "")
    except ValueError:
        return []
    return [{"path": p, "type": t} for p, t in out.items()]


def flatten_json(text: str) -> dict[str, str] | None:
    """Leaves by full path, so that equal leaf names of different branches all stay; null if it is no JSON."""
    out: dict[str, str] = {}

    def walk(x, at):
        if isinstance(x, dict):
            for k, v in x.items():
                walk(v, f"{at}.{k}" if at else k)
        elif isinstance(x, list):
            for k, v in enumerate(x):
                walk(v, f"{at}[{k}]")
        else:
            out[at] = x if isinstance(x, str) else json.dumps(x)

    try:
        walk(json.loads(text), "")
    except ValueError:
        return None
    return out


# ---- arithmetic -----------------------------------------------------------------------------------------------------

_OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.Mod: operator.mod, ast.FloorDiv: operator.floordiv, ast.USub: operator.neg, ast.UAdd: operator.pos}


def calculate(text: str) -> float | None:
    """The value of an arithmetic text of numbers, + - * / // % ** (whole exponents up to 64) and brackets; null for anything else."""

    def value(node):
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            return node.value
        if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Pow):
            a, b = value(node.left), value(node.right)
            if not isinstance(b, int) or abs(b) > 64 or abs(a) > 1e9:
                raise ValueError("too large a power")
            return a**b
        if isinstance(node, ast.BinOp) and type(node.op) in _OPS:
            return _OPS[type(node.op)](value(node.left), value(node.right))
        if isinstance(node, ast.UnaryOp) and type(node.op) in _OPS:
            return _OPS[type(node.op)](value(node.operand))
        raise ValueError("no arithmetic")

    try:
        return float(value(ast.parse(text.strip(), mode="eval").body))
    except (ValueError, SyntaxError, ZeroDivisionError, OverflowError, RecursionError, MemoryError):
        return None


# ---- HTML -----------------------------------------------------------------------------------------------------------


class _Page(html.parser.HTMLParser):
    skipped = ("script", "style", "noscript", "head", "meta")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.quiet, self.text, self.paragraphs, self.tables, self.row, self.cell, self.inside = 0, [], [], [], None, None, False

    def handle_starttag(self, tag, attrs):
        if tag in self.skipped and tag != "meta":
            self.quiet += 1
        elif tag == "p":
            self.inside = True
            self.paragraphs.append([])
        elif tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.row = []
            self.tables[-1].append(self.row)
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []
            self.row.append(self.cell)

    def handle_endtag(self, tag):
        if tag in self.skipped and tag != "meta":
            self.quiet = max(0, self.quiet - 1)
        elif tag == "p":
            self.inside = False
        elif tag in ("td", "th", "tr", "table"):
            self.cell = None
            self.row = None if tag in ("tr", "table") else self.row

    def handle_data(self, data):
        if self.quiet:
            return
        self.text.append(data)
        if self.inside:
            self.paragraphs[-1].append(data)
        if self.cell is not None:
            self.cell.append(data)


def _squeeze(parts) -> str:
    return " ".join("".join(parts).split())


def html_page(text: str) -> dict:
    """Visible text, its paragraphs, and tables as rows of cells, white space squeezed."""
    page = _Page()
    page.feed(text)
    page.close()
    tables = [[[_squeeze(c) for c in r] for r in t if r] for t in page.tables]
    return {"text": " ".join(" ".join(page.text).split()), "paragraphs": [p for p in map(_squeeze, page.paragraphs) if p], "tables": [t for t in tables if t]}


PAGE = "text string, paragraphs array<string>, tables array<array<array<string>>>"


_BAR = re.compile(r"chart|graph|plot", re.I)


def html_charts(text: str) -> list[dict]:
    """type, title, data and description of figures and of elements whose class speaks of a chart; what is missing is empty."""
    out = []
    for m in re.finditer(r"<(figure|div|canvas|svg)\b([^>]*)>", text, re.I):
        attributes = dict(re.findall(r"([\w-]+)\s*=\s*[\"']([^\"']*)[\"']", m[2]))
        if m[1].lower() not in ("figure", "canvas", "svg") and not _BAR.search(attributes.get("class", "")):
            continue
        end = text.find(f"</{m[1]}", m.end())
        body = text[m.end() : end if end >= 0 else m.end()]
        title = re.search(r"<(?:title|figcaption|h\d)[^>]*>(.*?)</", body, re.S | re.I)
        kind = next((k for k in ("bar", "line", "pie", "scatter") if k in attributes.get("class", "").lower()), "chart")
        out.append({"type": attributes.get("data-type", kind), "title": _squeeze([re.sub(r"<[^>]+>", " ", title[1])]) if title else attributes.get("title", ""), "data": attributes.get("data-values", ""), "description": attributes.get("aria-label", attributes.get("alt", ""))})
    return out


def sections(text: str) -> list[dict]:
    """title and points of each headed part of a text: a header is a line of marks or bold, or one that ends on a colon; bullets and other lines are points."""
    out: list[dict] = []
    for line in filter(None, map(str.strip, text.splitlines())):
        head = re.match(r"^#{1,6}\s+(.*)$", line) or re.match(r"^\*\*(.+?)\*\*:?$", line) or re.match(r"^([A-Z][^.!?]{0,79}):$", line)
        if head:
            out.append({"title": head[1].strip(), "points": []})
            continue
        if not out:
            out.append({"title": "", "points": []})
        out[-1]["points"].append(re.sub(r"^(?:[-*\u2022]|\d+[.)])\s+", "", line))
    return out


def table_markdown(rows: list[list[str]]) -> str:
    """The first row as head, a separator, the rest; short rows are filled."""
    width = max(map(len, rows), default=0)
    line = lambda r: "| " + " | ".join([*r, *[""] * (width - len(r))]) + " |"
    return "\n".join([line(rows[0]), line(["---"] * width), *map(line, rows[1:])]) if rows else ""


# ---- similar texts --------------------------------------------------------------------------------------------------


def ratio(a: str, b: str | None) -> int:
    """Twice the matching characters over all, in percent, rounded; case aside."""
    return round(100 * difflib.SequenceMatcher(None, a.lower(), (b or "").lower(), autojunk=False).ratio())


# ---- chunks ---------------------------------------------------------------------------------------------------------

#: Where segments of a text end.
_CUTS = (
    r"(?<=\.)\s*\n\n(?=[A-Z])",
    r"(?<=\n)\s*#{1,6}\s+[A-Z]",
    r"(?<=\n)[A-Z][^a-z]*?:\s*\n",
    r"(?<=\n\n)\s*(?:[-•\*]|\d+\.)\s+",
    r"(?<=\.)\s{2,}(?=[A-Z])",
    r"(?<=[\.\?\!])\s+(?=[A-Z])",
)
_CUT = re.compile("|".join(_CUTS))


def semantic_chunks(text: str, least: int = 200, most: int = 1000) -> list[dict]:
    """Runs of segments: a run ends with the segment that brings it to ``least`` characters, or before one that would bring it over ``most``.

    A chunk is its segments with a blank line between them; places count all segments before it, and two characters for each.
    """
    segments = [s for s in map(str.strip, _CUT.split(re.sub(r"\n{3,}", "\n\n", text).strip())) if s]
    upto = [0, *itertools.accumulate(map(len, segments))]
    out, a = [], 0
    while a < len(segments):
        full = bisect.bisect_left(upto, upto[a] + least, a + 1)
        over = bisect.bisect_right(upto, upto[a] + most, a + 1)
        b = min(full, max(over - 1, a + 1), len(segments))
        chunk, at = "\n\n".join(segments[a:b]), upto[a] + 2 * a
        out.append({"text": chunk, "start_pos": at, "end_pos": at + len(chunk)})
        a = b
    return out


def split_pages(text: str, size: int = 1000, overlap: int = 150) -> list[dict]:
    """Pieces of ``size`` characters, each beginning ``overlap`` characters before the last one's end; the text's end closes the last."""
    step = size - overlap
    return [{"text": text[a : a + size], "start_pos": a, "end_pos": min(a + size, len(text))} for a in range(0, max(len(text) - overlap, 1), step)] if text else []


CHUNKS = "array<struct<text:string,start_pos:int,end_pos:int>>"


# ---- as Columns -----------------------------------------------------------------------------------------------------


def _column(function, returns, arity=1):
    def build(*columns: Column) -> Column:
        return arrow_udf(function, returns, arity)(*columns)

    build.__name__, build.__doc__ = function.__name__, function.__doc__
    return build


boxed_all_col = _column(boxed_all, "array<string>")
boxed_final_col = _column(boxed_final, "string")
json_cascade_col = _column(json_cascade, "string")
tool_calls_col = _column(tool_calls, CALLS)
calculate_col = _column(calculate, "double")
ratio_col = _column(ratio, "int", 2)
schema_check_col = _column(schema_check, "array<string>", 2)
json_leaves_col = _column(json_leaves, "array<struct<path:string,type:string>>")
flatten_json_col = _column(flatten_json, "map<string,string>")
semantic_chunks_col = _column(semantic_chunks, CHUNKS)
split_pages_col = _column(split_pages, CHUNKS)


sections_col = _column(sections, "array<struct<title:string,points:array<string>>>")
html_charts_col = _column(html_charts, "array<struct<type:string,title:string,data:string,description:string>>")


def html_page_col(c: Column) -> Column:
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([html_page(x or "") for x in s], columns=["text", "paragraphs", "tables"])

    return F.pandas_udf(run, PAGE)(c)
