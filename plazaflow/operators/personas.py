"""Personas and samples: every draw is a hash of a row's id and the attribute, so a run can be repeated and any executor lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def uniform(key: Column, purpose: str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the key, what it is for, and the seed."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(purpose), F.lit(seed)), 11) / F.lit(float(1 << 53))


def normal(key: Column, purpose: str, seed: int = 0) -> Column:
    """A standard normal draw (Box-Muller on two hashes)."""
    u, v = uniform(key, f"{purpose}/1", seed), uniform(key, f"{purpose}/2", seed)
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(v * 2 * 3.141592653589793)


def trait(key: Column, purpose: str, low: float, high: float, mean: float | None = None, seed: int = 0) -> Column:
    """Normal around the middle with a sixth of the range as deviation, held in the range, to two places."""
    centre = (low + high) / 2 if mean is None else mean
    return F.round(F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), centre + normal(key, purpose, seed) * (high - low) / 6)), 2)


def ranged(key: Column, purpose: str, low: int, high: int, skew: float = 1.0, seed: int = 0) -> Column:
    """A whole number of the range; a skew over 1 prefers the low end."""
    return (F.lit(low) + F.floor(F.pow(uniform(key, purpose, seed), F.lit(skew)) * (high - low + 1))).cast("int")


def weighted(key: Column, purpose: str, options: dict[str, float], seed: int = 0) -> Column:
    """One option by weight."""
    total, upto, u = sum(options.values()), 0.0, uniform(key, purpose, seed)
    out = F.lit(list(options)[-1])
    for name, weight in reversed(list(options.items())[:-1]):
        upto = sum(w for n, w in options.items() if list(options).index(n) <= list(options).index(name)) / total
        out = F.when(u < upto, name).otherwise(out)
    return out


#: Options that a persona may choose from; the list stands in each row's plan, so it is bounded.
MOST_OPTIONS = 1000


def valid_options(df: DataFrame, options: DataFrame, least: int = 2) -> DataFrame:
    """Pairs of persona and option (name, min_age, max_age, education, min_income) of which ``least`` of three conditions hold.

    The options are a short list (``MOST_OPTIONS`` at most, else an error): they stand as one array beside each persona and are filtered there, without a join.
    """
    rows = options.limit(MOST_OPTIONS + 1).collect()
    if len(rows) > MOST_OPTIONS:
        raise ValueError(f"over {MOST_OPTIONS} options")
    names = [f.name for f in options.schema]
    every = F.array(*(F.struct(*(F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in options.schema)) for r in rows)) if rows else F.array().cast(f"array<{options.schema.simpleString()}>")
    age = lambda o: F.coalesce(F.col("age").between(o["min_age"], o["max_age"]), F.lit(True))
    education = lambda o: F.coalesce(o["education"] == F.col("education"), F.lit(True))
    income = lambda o: F.coalesce(F.col("income") >= o["min_income"], F.lit(True))
    fits = F.filter(every, lambda o: age(o).cast("int") + education(o).cast("int") + income(o).cast("int") >= least)
    got = df.select("*", F.explode(fits).alias("own option"))
    return got.select(*df.columns, *(F.col(f"own option.{n}").alias("option_education" if n == "education" else n) for n in names))


def one_of_valid(df: DataFrame, options: DataFrame, key: str, purpose: str, seed: int = 0) -> DataFrame:
    """One valid option for each persona, by weight (column ``weight``): the smallest exponential draw wins."""
    draw = -F.log(1 - uniform(F.concat_ws("|", F.col(key).cast("string"), F.col("name")), purpose, seed)) / F.col("weight")
    best = valid_options(df, options).groupBy(key).agg(F.min_by("name", F.struct(draw, "name")).alias(purpose))
    return df.join(best, key, "left")


def personas(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Attributes in order of dependence: age, education by age, income by education, traits, role."""
    k = F.col(key).cast("string")
    education = F.when(F.col("age") < 20, "school").otherwise(weighted(k, "education", {"school": 0.3, "college": 0.5, "doctorate": 0.2}, seed))
    base = F.when(F.col("education") == "doctorate", 80_000).when(F.col("education") == "college", 50_000).otherwise(25_000)
    return (
        df.withColumn("age", ranged(k, "age", 18, 80, 1.5, seed))
        .withColumn("education", education)
        .withColumn("income", (base + ranged(k, "income", 0, 40_000, 1.0, seed)).cast("int"))
        .withColumns({t: trait(k, t, 0, 1, seed=seed) for t in ("openness", "diligence", "warmth")})
        .withColumn("role", F.when(uniform(k, "role", seed) < 0.5, "buyer").otherwise("seller"))
    )


def topped_up(stored: DataFrame, key: str, n: int) -> DataFrame:
    """The first n stored personas, and new ones for what is missing."""
    kept = stored.orderBy(key).limit(n)
    missing = n - kept.count()
    if missing <= 0:
        return kept
    return kept.unionByName(personas(stored.sparkSession.range(missing).select(F.concat(F.lit("new_"), F.col("id").cast("string")).alias(key)), key), allowMissingColumns=True)


def conditional(condition: str) -> Column:
    """A condition text of SQL comparisons over the persona's columns; parsed by Spark, never evaluated as code."""
    return F.coalesce(F.expr(condition).cast("boolean"), F.lit(False))


def judges_of(items: DataFrame, judges: list[str], key: str, k: int, seed: int = 0) -> DataFrame:
    """k judges for each item without replacement, the same on every run."""
    pool = F.transform(F.array(*map(F.lit, judges)), lambda j: F.struct(F.xxhash64(F.col(key), j, F.lit(seed)).alias("h"), j.alias("j")))
    return items.withColumn("judges", F.transform(F.slice(F.array_sort(pool), 1, k), lambda x: x["j"]))


def random_actions(agents: DataFrame, key: str, round_column: str, low: float = 90.0, high: float = 110.0, seed: int = 0) -> DataFrame:
    """A random market action of each agent and round: bid, ask or hold, with a price and one unit."""
    k = F.concat_ws("|", F.col(key).cast("string"), F.col(round_column).cast("string"))
    side = weighted(k, "side", {"buy": 1, "sell": 1, "hold": 1}, seed)
    return agents.withColumn("side", side).withColumn("price", F.when(F.col("side") == "hold", 0.0).otherwise(F.round(low + uniform(k, "price", seed) * (high - low), 2))).withColumn("quantity", F.when(F.col("side") == "hold", 0).otherwise(1))


def best_of_batch(df: DataFrame, batch: str, score: str, order: str, valid: str) -> DataFrame:
    """The best valid row of each batch, the first on ties."""
    rest = F.struct(*map(F.col, df.columns))
    return df.where(F.col(valid)).groupBy(F.col(batch).alias("own batch")).agg(F.min_by(rest, F.struct(-F.col(score), F.col(order))).alias("row")).select("row.*")


def running_average(df: DataFrame, value: str, order: str, groups: list[str]) -> DataFrame:
    w = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({"running_total": F.sum(value).over(w), "running_average": F.avg(value).over(w)})
