"""Extension points: registered callables with derived schemas, tools, mechanisms, linear workflows, batched inference."""

from __future__ import annotations

import inspect
import typing
from collections.abc import Callable, Iterator
from typing import Protocol, get_args, get_origin, get_type_hints

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import arrow_udf, schema_errors

_JSON = {str: "string", int: "integer", float: "number", bool: "boolean", list: "array", dict: "object", type(None): "null"}


def type_schema(hint) -> dict:
    """The JSON schema of a type hint."""
    origin, args = get_origin(hint), get_args(hint)
    if origin in (list, tuple, set):
        return {"type": "array"} | ({"items": type_schema(args[0])} if args else {})
    if origin is dict:
        return {"type": "object"}
    if origin is typing.Union or str(origin) == "<class 'types.UnionType'>":
        kept = [a for a in args if a is not type(None)]
        return type_schema(kept[0]) if len(kept) == 1 else {}
    return {"type": _JSON[hint]} if hint in _JSON else {}


def input_schema(function: Callable) -> dict:
    hints = get_type_hints(function)
    parameters = inspect.signature(function).parameters
    missing = [n for n in parameters if n not in hints]
    if missing or "return" not in hints:
        raise TypeError(f"{function.__name__} lacks type hints for {missing or 'its result'}")
    return {"type": "object", "properties": {n: type_schema(hints[n]) for n in parameters}, "required": [n for n, p in parameters.items() if p.default is inspect.Parameter.empty]}


def output_schema(function: Callable) -> dict:
    return type_schema(get_type_hints(function)["return"])


def compatible(derived: dict, given: dict) -> bool:
    """Whether a given schema asks for the same properties and types as the derived one."""
    types = lambda s: {k: v.get("type") for k, v in s.get("properties", {}).items()}
    return derived.get("type") == given.get("type") and types(derived) == types(given) and set(derived.get("required", [])) == set(given.get("required", []))


class Registry:
    """Callables by name. Functions only: source text is never compiled."""

    def __init__(self):
        self.functions: dict[str, Callable] = {}

    def register(self, name: str, function: Callable, schema: dict | None = None) -> None:
        if name in self.functions:
            raise ValueError(f"{name} is registered already")
        derived = input_schema(function)
        if schema is not None and not compatible(derived, schema):
            raise ValueError(f"the schema given for {name} doesn't fit its type hints")
        self.functions[name] = function

    def execute(self, name: str, arguments: dict):
        """Calls a function with arguments that its schema admits."""
        function = self.functions[name]
        if errors := schema_errors(arguments, input_schema(function)):
            raise ValueError("; ".join(errors))
        return function(**arguments)

    def tool(self, name: str) -> dict:
        f = self.functions[name]
        return {"type": "function", "function": {"name": name, "description": inspect.getdoc(f) or "", "parameters": input_schema(f)}}

    def column(self, name: str, returns: str):
        """The function of one argument as an Arrow-batched column function."""
        return arrow_udf(self.functions[name], returns)


class Chunker(Protocol):
    def __call__(self, text: str) -> list[dict]: ...


class Reward(Protocol):
    def __call__(self, metrics: dict) -> float: ...


class Mechanism(Protocol):
    """A market or game: actions of one round in, observations out; its state is a table."""

    def step(self, actions: DataFrame) -> DataFrame: ...

    def state(self) -> DataFrame: ...


class Workflow:
    """Named steps in a line over rows. A step maps a DataFrame to one; ``failed`` of a row, once set, keeps later steps from counting."""

    def __init__(self, *steps: tuple[str, Callable[[DataFrame], DataFrame]]):
        self.steps = steps

    def run(self, df: DataFrame) -> DataFrame:
        df = df.withColumn("failed", F.lit(None).cast("string"))
        for name, step in self.steps:
            before = df.columns
            done = step(df.where("failed IS NULL"))
            late = [c for c in done.columns if c not in before and c != "error"]
            if "error" in done.columns:
                done = done.withColumn("failed", F.when(F.col("error").isNotNull(), F.lit(name))).drop("error")
            df = done.unionByName(df.where("failed IS NOT NULL"), allowMissingColumns=True)
            assert set(late) <= set(df.columns)
        return df


def infer(df: DataFrame, call: Callable[[list[str]], list[str]], prompt: str = "prompt", output: str = "output", batch: int = 32) -> DataFrame:
    """Adds the output of a model for each prompt, in batches; ``call`` runs on the executors and keeps the order of its batch."""
    columns = [f.name for f in df.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{output}` string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            got = []
            for k in range(0, len(pdf), batch):
                got += call(pdf[prompt].iloc[k : k + batch].tolist())
            yield pdf.assign(**{output: got})[[*columns, output]]

    return df.mapInPandas(run, schema)


def embed(df: DataFrame, call: Callable[[list[str]], list[list[float]]], text: str = "text", output: str = "embedding", batch: int = 32) -> DataFrame:
    """Adds the vector of each text, in batches, order kept."""
    columns = [f.name for f in df.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{output}` array<float>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            got = []
            for k in range(0, len(pdf), batch):
                got += call(pdf[text].iloc[k : k + batch].fillna("").tolist())
            yield pdf.assign(**{output: got})[[*columns, output]]

    return df.mapInPandas(run, schema)
