"""Task and record readers beside the general ones: tasks, problems, preference pairs, stored results, resume keys, markets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parsing
from ..functions.text import normalise_or_empty, whole_sentences
from ..operators.conversations import last_of
from .readers import folder, json_document, with_position

#: Names of chains as people write them, and as the providers do.
CHAIN_ALIASES = {"eth": "ethereum", "mainnet": "ethereum", "sol": "solana", "bnb": "bsc", "binance": "bsc", "matic": "polygon", "arb": "arbitrum", "op": "optimism", "avax": "avalanche"}


def read_or_empty(spark: SparkSession, path: str, schema: str, form: str = "json") -> DataFrame:
    """A stored set, or no rows if the path isn't there; asked of the file system that the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return spark.read.schema(schema).format(form).load(path) if there is not None and len(there) else spark.createDataFrame([], schema)


def tasks(df: DataFrame, name: str, order: Column, n: int | None = None) -> DataFrame:
    """Tasks with an id: their own, else the file's name and place from 1 on."""
    got = with_position(df, order, f"{name}_", 1, "own made")
    got = got.withColumn("id", F.coalesce(F.col("id"), F.col("own made")) if "id" in df.columns else F.col("own made")).drop("own made")
    return got if n is None else got.orderBy(order).limit(n)


def json_tasks(spark: SparkSession, path: str, name: str) -> DataFrame:
    got = json_document(spark, path)
    return tasks(got, name, F.monotonically_increasing_id())


def task_errors(df: DataFrame) -> DataFrame:
    """(id, errors) of tasks that lack a description or category."""
    empty = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    errors = F.filter(F.array(F.when(empty("description"), F.lit("no description")), F.when(empty("category"), F.lit("no category"))), lambda e: e.isNotNull())
    return df.select("id", errors.alias("errors")).where(F.size("errors") > 0)


def chunk_tasks(chunks: DataFrame) -> DataFrame:
    """One task a chunk, with what is known of it as metadata."""
    meta = F.create_map(*(x for c in ("subject", "grade", "chapter_title", "chapter_index") for x in (F.lit(c), F.col(c).cast("string"))))
    return chunks.select(F.concat(F.lit("task_"), F.col("chunk_id")).alias("id"), F.concat(F.lit("Questions on "), F.coalesce("chapter_title", F.lit("the text"))).alias("description"), F.col("subject").alias("category"), F.col("text").alias("expected"), meta.alias("metadata"))


def structured_rows(df: DataFrame, conversation: str = "conversations", schema: str = "schema") -> DataFrame:
    """Last question and last answer (a ``raw`` wrapper taken off) with the schema; rows without question or schema go."""
    answer = last_of(F.col(conversation), "gpt")
    got = df.withColumns({"query": last_of(F.col(conversation), "human"), "output": F.coalesce(F.get_json_object(answer, "$.raw"), answer)})
    return got.where((F.coalesce(F.trim("query"), F.lit("")) != "") & F.try_parse_json(schema).isNotNull())


def problems(df: DataFrame, order: Column, n: int | None = None) -> DataFrame:
    """Rows with a problem and an answer, with an id of their place in the source; the limit counts kept rows."""
    got = with_position(df, order, "problem_", 0)
    got = got.where((F.coalesce(F.trim("problem"), F.lit("")) != "") & (F.coalesce(F.trim("answer"), F.lit("")) != ""))
    return got if n is None else got.orderBy(order).limit(n)


def nested(df: DataFrame, path: str) -> Column:
    """A dotted path through structs; null if a part is missing."""
    kind, at = df.schema, []
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return F.lit(None).cast("string")
        at.append(f"`{part}`")
        kind = kind[part].dataType
    return F.col(".".join(at))


def json_path(column: Column, path: str) -> Column:
    """``a.b[2].c`` of a JSON text, as text."""
    return F.get_json_object(column, f"$.{path}")


def preference_files(spark: SparkSession, path: str) -> DataFrame:
    """Preference pairs of a folder of JSON files: system, question, chosen, rejected."""
    got = json_document(spark, path)
    return got.select(F.col("system"), F.col("human").alias("question"), F.col("accepted").alias("chosen"), F.col("rejected"))


def conversation_tree(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Conversations of a folder tree by category and subcategory, and the paths of files that hold none."""
    files = folder(spark, path, "*.json")
    got = files.withColumn("conversations", F.from_json("text", "array<struct<role:string,content:string>>"))
    bad = F.coalesce(F.size("conversations"), F.lit(0)) < 1
    return got.where(~bad).withColumn("task", whole_sentences(F.element_at("conversations", 1)["content"])).drop("text"), got.where(bad).select("path")


def hierarchy_tasks(df: DataFrame, levels: list[str], order: str) -> DataFrame:
    """Category, SubCategory and Task from the filled levels of a hierarchy."""
    from ..operators.explore import fill_down

    got = fill_down(df, levels, order).where(F.col(levels[-1]).isNotNull())
    return got.select(F.col(levels[-3]).alias("Category"), F.col(levels[-2]).alias("SubCategory"), F.col(levels[-1]).alias("Task")).distinct()


def published_hashes(df: DataFrame, text: str = "context_text") -> DataFrame:
    return df.select(F.sha2(normalise_or_empty(F.col(text)), 256).alias("hash")).distinct()


def resume_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys that are done; none if nothing was stored."""
    return read_or_empty(spark, path, "key string", "json")


def save_keys(df: DataFrame, key: str, path: str) -> None:
    df.select(F.col(key).alias("key")).distinct().orderBy("key").write.mode("overwrite").json(path)


def fetch(spark: SparkSession, sql: str, **arguments) -> DataFrame:
    """A query with named parameters."""
    return spark.sql(sql, args=arguments or None)


def fetch_one(spark: SparkSession, sql: str, **arguments):
    return fetch(spark, sql, **arguments).limit(1).first()


def run_statements(spark: SparkSession, *statements: str) -> None:
    """Statements one after the other; Spark has no transaction over several tables, so each must be safe to repeat."""
    for s in statements:
        spark.sql(s)


# ---- markets and the web: tables stand for the providers --------------------------------------------------------------


def canonical_chain(c: Column) -> Column:
    low = F.lower(c)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in CHAIN_ALIASES.items() for x in p)), low), low)


def resolve_pair(results: DataFrame, chain: str, position: str = "pos", groups: list[str] = ()) -> DataFrame:
    """The first result on the chain, else the first one, of each group of results."""
    rest = F.struct(*map(F.col, results.columns))
    best = F.min_by(rest, F.struct((canonical_chain(F.col("chain")) != canonical_chain(F.lit(chain))).cast("int"), position))
    return results.groupBy(*(F.col(g).alias(f"own {g}") for g in groups)).agg(best.alias("row")).where("row IS NOT NULL").select("row.*")


def boosted(results: DataFrame, chain: str, n: int, order: str = "pos") -> DataFrame:
    return results.where(canonical_chain(F.col("chain")) == canonical_chain(F.lit(chain))).orderBy(order).limit(n)


def price_history(prices: DataFrame, symbol: str, start, end) -> DataFrame:
    """Rows of a symbol between two dates, both inclusive."""
    return prices.where((F.col("symbol") == symbol) & F.col("date").between(F.lit(start), F.lit(end)))


def extracted(pages: DataFrame, *methods: str) -> DataFrame:
    """The first extraction method's text that isn't empty; pages without any go."""
    text = F.coalesce(*(F.nullif(F.trim(m), F.lit("")) for m in methods))
    return pages.withColumn("content", text).where("content IS NOT NULL")


def search_text(category: Column, subcategory: Column, task: Column) -> Column:
    return F.concat(F.lit('"'), category, F.lit('" "'), subcategory, F.lit('" '), task)


def page_tables(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row a table: its page, place, rows, and Markdown."""
    got = pages.withColumn("own page", parsing.html_page_col(F.col(html))).select(*pages.columns, F.posexplode("own page.tables").alias("position", "rows"))
    return got.withColumn("markdown", parsing.arrow_udf(lambda t: parsing.table_markdown([list(r) for r in t]), "string")(F.col("rows")))


# ---- records for storage ----------------------------------------------------------------------------------------------


def action_rows(df: DataFrame, kept: list[str] = ("agent_id", "environment_name", "round", "sub_round")) -> DataFrame:
    """Actions as JSON, and all other columns as JSON metadata."""
    rest = [c for c in df.columns if c not in (*kept, "action")]
    return df.select(*kept, F.to_json(F.struct("action")).alias("action"), (F.to_json(F.struct(*rest)) if rest else F.lit("{}")).alias("metadata"))


def state_rows(df: DataFrame, state: list[str], metadata: list[str] = ()) -> DataFrame:
    return df.select("environment_name", "round", F.to_json(F.struct(*state)).alias("state_data"), (F.to_json(F.struct(*metadata)) if metadata else F.lit("{}")).alias("metadata"))


def episode_rows(df: DataFrame) -> DataFrame:
    """Episodes with their steps as JSON; a step's content that is JSON (once or twice encoded) is read, other text is wrapped."""

    def content(text):
        import json

        try:
            got = json.loads(text)
            got = json.loads(got) if isinstance(got, str) else got
        except ValueError:
            got = {"text": text}
        return json.dumps(got if isinstance(got, dict) else {"text": got}, ensure_ascii=False)

    read = parsing.arrow_udf(lambda steps: [content(s or "") for s in steps], "array<string>")
    return df.withColumn("cognitive_steps", F.to_json(read(F.col("steps")))).drop("steps")


def request_lines(df: DataFrame, metadata: list[str], request: list[str]) -> DataFrame:
    """One ``[metadata, request]`` JSON array a row, for a text sink."""
    part = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return df.select(F.concat(F.lit("["), part(metadata), F.lit(","), part(request), F.lit("]")).alias("value"))


def judged_record(df: DataFrame) -> DataFrame:
    """Question, answer, verdict and score from the top level or from a nested record; empty text counts as missing, a score of 0 doesn't."""
    pick = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(F.col(f"record.{c}"), F.lit("")))
    return df.select(*(pick(c).alias(c) for c in ("qid", "question", "answer", "verdict")), F.coalesce("score", "record.score").alias("score"))
