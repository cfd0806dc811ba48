"""Looking through tables: memory filters, paging, search over columns, non-empty tables, boards, statistics of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def memory_filter(df: DataFrame, at: str, step: str | None = None, steps: list[str] = (), start=None, end=None, metadata: dict | None = None, metadata_column: str = "metadata") -> DataFrame:
    """All given conditions together: step in a list, time bounds (both inclusive), metadata values as text."""
    if step and steps:
        df = df.where(F.col(step).isin(*steps))
    if start is not None:
        df = df.where(F.col(at) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(at) <= F.lit(end))
    for key, value in (metadata or {}).items():
        df = df.where(F.get_json_object(metadata_column, f"$['{key}']") == str(value))
    return df


def recent(df: DataFrame, at: str, key: str, n: int, oldest_first: bool = True) -> DataFrame:
    """The newest n rows (ties by key); Spark keeps n a task. Memories come oldest first, episodes newest first."""
    top = df.orderBy(F.desc(at), F.desc(key)).limit(n)
    return top.orderBy(at, key) if oldest_first else top


def page(df: DataFrame, order: list[str], number: int, size: int) -> DataFrame:
    """One page in a fixed order, with the number of rows and pages; a late page costs a sort, as any offset does."""
    total = df.count()
    return df.orderBy(*order).offset((number - 1) * size).limit(size).withColumns({"total_rows": F.lit(total).cast("long"), "total_pages": F.lit(-(-total // size)).cast("long")})


def search(df: DataFrame, term: str, columns: list[str] | None = None) -> DataFrame:
    """Rows in which any of the columns, as text, holds the term; case aside, with no wildcard meaning."""
    plain = term.lower()
    hit = F.lit(False)
    for c in columns or df.columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(plain)), F.lit(False))
    return df.where(hit)


def non_empty(tables: dict[str, DataFrame]) -> list[str]:
    """Names of tables with a row, sorted; one row is read of each."""
    return sorted(n for n, t in tables.items() if not t.isEmpty())


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n): counts from Parquet footers where the source allows."""
    out = None
    for name, t in sorted(tables.items()):
        got = t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = got if out is None else out.unionByName(got)
    return out


def columns_of(df: DataFrame) -> DataFrame:
    """(column_name, data_type, is_json)."""
    rows = [(f.name, f.dataType.simpleString(), isinstance(f.dataType, (T.StructType, T.MapType, T.VariantType))) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, is_json boolean")


def board(df: DataFrame, title: str | None = None, categories: list[str] = (), order: str = "karma", n: int = 10) -> DataFrame:
    """Posts by karma or date, newest or highest first, whose title holds a text and that share a category."""
    if title:
        df = df.where(F.contains(F.lower("title"), F.lit(title.lower())))
    if categories:
        df = df.where(F.arrays_overlap("categories", F.array(*map(F.lit, categories))))
    return df.orderBy(F.desc(order), "id").limit(n)


def equal_to(df: DataFrame, **criteria) -> DataFrame:
    """Rows equal in all criteria; None means no criterion, 0 and '' are values."""
    for c, v in criteria.items():
        if v is not None:
            df = df.where(F.col(c) == F.lit(v))
    return df


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, mean, max, min, std) over cells that are numbers; one pass."""
    numbers = {c: F.col(c).cast("string").try_cast("double") for c in columns}
    got = df.agg(*(f(numbers[c]).alias(f"{name} {c}") for c in columns for name, f in (("mean", F.avg), ("max", F.max), ("min", F.min), ("std", F.stddev_samp))))
    rows = [F.struct(F.lit(c).alias("column_name"), *(F.col(f"{s} {c}").alias(f"{s}_value") for s in ("mean", "max", "min", "std"))) for c in columns]
    return got.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def percent_moves(df: DataFrame, column: str, least: float = 0.01) -> DataFrame:
    """Percentages as shares, those over ``least`` in size."""
    share = F.regexp_replace(F.col(column).cast("string"), "[%,+]", "").try_cast("double") / 100
    return df.withColumn("share", share).where(F.abs("share") > least)


def fill_down(df: DataFrame, columns: list[str], order: str, groups: list[str] = ()) -> DataFrame:
    """Each null takes the last value above it."""
    w = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def trend(df: DataFrame, value: str, order: list[str], groups: list[str], last: int = 5) -> DataFrame:
    """Of each group: mean change of the last few steps, its direction and strength."""
    w = W.partitionBy(*groups).orderBy(*order)
    before = F.lag(value).over(w)
    change = df.withColumns({"own change": (F.col(value) - before) / F.when(before != 0, before), "own back": F.row_number().over(W.partitionBy(*groups).orderBy(*(F.desc(c) for c in order)))})
    got = change.where(F.col("own back") <= last).groupBy(*groups).agg(F.avg("own change").alias("mean_change"), F.count("own change").alias("steps"))
    return got.withColumn("direction", F.when(F.col("mean_change") > 0, "up").when(F.col("mean_change") < 0, "down").otherwise("flat"))


def asof(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str, tie: str) -> DataFrame:
    """Each left row with the last right value at or before it: one union and one window, no range join."""
    both = left.withColumns({"own side": F.lit(1), value: F.lit(None).cast(right.schema[value].dataType)}).unionByName(right.select(*keys, at, value).withColumn("own side", F.lit(0)), allowMissingColumns=True)
    w = W.partitionBy(*keys).orderBy(at, "own side", tie).rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(w)).where(F.col("own side") == 1).drop("own side")


def budget_prefix(df: DataFrame, groups: list[str], order: str, cost: Column, budget: int) -> DataFrame:
    """The first rows of each group whose running cost stays within the budget."""
    w = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("running_cost", F.sum(cost).over(w)).where(F.col("running_cost") <= budget)


#: Distinct values of a JSON column that are looked at.
SAMPLE = 100


def catalogue(df: DataFrame, json_columns: list[str]) -> DataFrame:
    """(column_name, type, nullable, parent): the columns, and for JSON columns the leaves of up to ``SAMPLE`` distinct values, those that sort first.

    Where values disagree on a leaf's type, the value that sorts last wins. Values that are no JSON give no leaves.
    """
    from ..functions.parsing import json_leaves_col

    rows = [(f.name, f.dataType.simpleString(), f.nullable, None) for f in df.schema]
    out = df.sparkSession.createDataFrame(rows, "column_name string, type string, nullable boolean, parent string")
    for c in json_columns:
        values = df.select(F.col(c).alias("v")).where("v IS NOT NULL").distinct().orderBy("v").limit(SAMPLE)
        leaves = values.select("v", F.explode(json_leaves_col(F.col("v"))).alias("l")).groupBy("l.path").agg(F.max_by("l.type", "v").alias("type"))
        out = out.unionByName(leaves.select(F.concat(F.lit(f"{c}."), "path").alias("column_name"), "type", F.lit(True).alias("nullable"), F.lit(c).alias("parent")))
    return out
