"""Readers: tasks, curricula, JSON lines of three strictnesses, folders whose paths carry columns, files by extension.

Every reader gives a DataFrame with an explicit schema where the format allows; ids by position come from an explicit order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conversations import numbered

#: Kinds of files by extension.
KINDS = {"csv": "table", "tsv": "table", "json": "json", "jsonl": "json lines", "ndjson": "json lines", "txt": "text", "md": "text", "py": "text", "log": "text", "yaml": "yaml", "yml": "yaml", "pdf": "pdf", "parquet": "parquet", "orc": "orc"}


def csv(spark: SparkSession, path: str, schema: str | None = None, separator: str = ",", trim: bool = False, multi_line: bool = False, null: str = "") -> DataFrame:
    """A CSV with a header; all columns are text unless a schema is given. Fields that read ``null`` are null; with a mark of their own, quoted empty fields stay empty texts."""
    reader = spark.read.option("header", True).option("sep", separator).option("escape", '"').option("multiLine", multi_line).option("ignoreLeadingWhiteSpace", trim).option("nullValue", null)
    return (reader.schema(schema) if schema else reader).csv(path)


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType | None = None, mode: str = "lenient") -> DataFrame:
    """One object a line; blank lines never count. Bad lines are dropped (lenient), raise (strict), or stay in ``bad_line`` (keep)."""
    reader = spark.read.option("mode", {"lenient": "DROPMALFORMED", "strict": "FAILFAST", "keep": "PERMISSIVE"}[mode])
    if mode == "keep":
        reader = reader.option("columnNameOfCorruptRecord", "bad_line")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def json_document(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A whole file that holds an array of objects, or one object."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def request_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``[metadata, request, response]`` as three VARIANT columns; lines that are no such array go."""
    v = spark.read.text(path).select(F.try_parse_json("value").alias("v"))
    part = lambda k: F.try_variant_get("v", f"$[{k}]", "variant")
    return v.select(part(0).alias("metadata"), part(1).alias("request"), part(2).alias("response")).where("metadata IS NOT NULL AND request IS NOT NULL")


def folder(spark: SparkSession, path: str, glob: str = "*", levels: tuple[str, ...] = ("category", "subcategory")) -> DataFrame:
    """Whole files with their path, size, and the last folders of the path as columns (``_`` as a space)."""
    got = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    parts = F.split("path", "/")
    named = {name: F.replace(F.url_decode(F.try_element_at(parts, F.lit(-1 - len(levels) + k))), F.lit("_"), F.lit(" ")) for k, name in enumerate(levels)}
    return got.withColumns(named)


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, size, modified, kind, name) of the files below a folder; contents aren't read."""
    got = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    name = F.substring_index("path", "/", -1)
    return got.withColumns({"name": name, "kind": kind_of(name)})


def kind_of(name: Column) -> Column:
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair)), ext), F.lit("other"))


def file_info(files: DataFrame, text: str = "text") -> DataFrame:
    """Lines and characters of whole files."""
    return files.withColumns({"lines": F.size(F.split(text, "\n")), "chars": F.length(text)})


def tail(text: Column, n: int) -> Column:
    """The last n lines."""
    lines = F.split(text, "\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - n + 1, F.lit(1)), F.lit(n)), "\n")


def grep(files: DataFrame, pattern: str, n: int = 20, width: int = 200, text: str = "text") -> DataFrame:
    """The first n lines (by path and number) that a pattern finds, case aside, cut at ``width`` characters."""
    lines = files.select("path", F.posexplode(F.split(text, "\n")).alias("k", "line")).where(F.regexp_like("line", F.lit(f"(?i){pattern}")))
    return lines.select("path", (F.col("k") + 1).alias("line_number"), F.left(F.trim("line"), F.lit(width)).alias("line")).orderBy("path", "line_number").limit(n)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """By extension: tables, JSON, JSON lines, Parquet, ORC, or whole texts; a format that isn't known is an error that lists those that are."""
    kind = KINDS.get(path.rsplit(".", 1)[-1].lower())
    if kind == "table":
        return csv(spark, path, separator="\t" if path.lower().endswith("tsv") else ",")
    if kind == "json":
        return json_document(spark, path)
    if kind == "json lines":
        return json_lines(spark, path)
    if kind in ("parquet", "orc"):
        return spark.read.format(kind).load(path)
    if kind in ("text", "yaml"):
        return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))
    raise ValueError(f"no reader for {path}; known: {', '.join(sorted(k for k, v in KINDS.items() if v != 'pdf'))}")


def pdf_pages(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """(path, page, text), if a PDF library is there; line marks of play texts and leading line numbers go."""
    import pandas as pd

    schema = "path string, page int, text string"

    def run(batches):
        import io

        from pypdf import PdfReader

        for pdf in batches:
            yield pd.DataFrame([(p, k, clean_page(page.extract_text() or "")) for p, c in zip(pdf.path, pdf.content, strict=True) for k, page in enumerate(PdfReader(io.BytesIO(c)).pages)], columns=["path", "page", "text"])

    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(run, schema)


def clean_page(text: str) -> str:
    return re.sub(r"(?m)^\s*\d+\s+", "", re.sub(r"FTLN\s+\d+", "", text)).strip()


def yaml_documents(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """Each YAML file as JSON text, if a YAML library is there."""
    from ..functions.parsing import arrow_udf

    def to_json(text):
        import json

        import yaml

        return json.dumps(yaml.safe_load(text), default=str)

    return folder(spark, path, glob, ()).select("path", arrow_udf(to_json, "string")(F.col("text")).alias("document"))


# ---- tasks ----------------------------------------------------------------------------------------------------------


def with_position(df: DataFrame, order: Column, prefix: str, first: int = 0, name: str = "id") -> DataFrame:
    """An id of prefix and place in a given order, counted by range partition (no task sees all rows)."""
    return numbered(df, order, "own place").withColumn(name, F.concat(F.lit(prefix), (F.col("own place") - 1 + first).cast("string"))).drop("own place")


def curriculum(df: DataFrame, order: str, categories: list[str] = (), subcategories: list[str] = (), n: int | None = None, schema_column: str | None = None) -> DataFrame:
    """Tasks of chosen categories, numbered after the filter, the first n; a schema column that is no JSON becomes null."""
    if categories:
        df = df.where(F.col("Category").isin(*categories))
    if subcategories:
        df = df.where(F.col("SubCategory").isin(*subcategories))
    if schema_column:
        df = df.withColumn(schema_column, F.when(F.try_parse_json(schema_column).isNotNull(), F.col(schema_column)))
    out = with_position(df, F.col(order), "curriculum_")
    return out if n is None else out.orderBy(order).limit(n)


def resolve(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their canonical names: the first alias that exists, case aside; missing ones are null."""
    have = {c.lower(): c for c in df.columns}
    pick = lambda names: next((F.col(f"`{have[n.lower()]}`") for n in names if n.lower() in have), F.lit(None))
    return df.select(*(pick([name, *names]).cast("string").alias(name) for name, names in aliases.items()))


CHUNK_ALIASES = {"chunk_id": ["id", "uuid"], "text": ["content", "chunk", "context_text"], "subject": ["topic"], "grade": ["level", "class"], "chapter_title": ["chapter", "title"], "chapter_index": ["chapter_no", "chapter_number"]}


def textbook_chunks(df: DataFrame, subjects: list[str] = (), grades: list[int] = (), n: int | None = None, order: str = "chunk_id") -> DataFrame:
    """Chunks under canonical names, numbers as integers; filters come before the limit, front matter goes."""
    from ..functions.text import coerce_int, front_matter

    got = resolve(df, CHUNK_ALIASES).withColumns({c: coerce_int(F.col(c)) for c in ("grade", "chapter_index")})
    got = got.where(~front_matter(F.col("chapter_title")))
    if subjects:
        got = got.where(F.col("subject").isin(*subjects))
    if grades:
        got = got.where(F.col("grade").isin(*grades))
    return got if n is None else got.orderBy(order).limit(n)


def row_slice(df: DataFrame, order: Column, start: int, n: int | None = None) -> DataFrame:
    """Rows start .. start + n - 1 of a given order."""
    got = numbered(df, order, "own place").where(F.col("own place") > start)
    return (got if n is None else got.where(F.col("own place") <= start + n)).drop("own place")


def wrapped_tools(tools: Column) -> Column:
    """Tools as JSON text: a bare tool becomes ``{"type":"function","function":tool}``."""
    items = F.from_json(tools, "array<string>")
    bare = lambda t: F.get_json_object(t, "$.function").isNull()
    return F.transform(items, lambda t: F.when(bare(t), F.concat(F.lit('{"type":"function","function":'), t, F.lit("}"))).otherwise(t))


def context_blocks(titles: Column, sentences: Column) -> Column:
    """``## title`` and its sentences for each document, a blank line between documents."""
    return F.array_join(F.zip_with(titles, sentences, lambda t, s: F.concat(F.lit("## "), t, F.lit("\n"), F.array_join(s, " "))), "\n\n")


def by_size_of_group(df: DataFrame, group: str, order: str, n: int | None = None) -> DataFrame:
    """Rows of the largest groups first, groups of one size by their first row."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("own n"), F.min(order).alias("own first"))
    got = df.join(sizes, group).orderBy(F.desc("own n"), "own first", order)
    return (got if n is None else got.limit(n)).drop("own n", "own first")


def question_answer(df: DataFrame, question: str, answer: str, context: str | None = None) -> DataFrame:
    """Two-turn conversations with a short task; rows with an empty side go."""
    from ..operators.conversations import from_question_answer

    conv = from_question_answer(F.col(question), F.col(answer), F.col(context) if context else None)
    task = F.when(F.length(question) > 100, F.concat(F.left(question, F.lit(100)), F.lit("..."))).otherwise(F.col(question))
    return df.withColumns({"conversations": conv, "task": task}).where("conversations IS NOT NULL")
