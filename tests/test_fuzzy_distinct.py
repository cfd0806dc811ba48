"""Greedy dedup of titles over the whole table against the one-by-one rule."""

import random

from plazaflow.functions.parsing import ratio
from plazaflow.operators import matching
from plazaflow.plans.catalog import QUERIES


def one_by_one(rows, most=90):
    """Rows are (order, title)."""
    kept = []
    for i, t in sorted(rows):
        if t is not None and all(ratio(t, k) < most for _, k in kept):
            kept.append((i, t))
    return [i for i, _ in kept]


def test_greedy_distinct_matches_the_one_by_one_rule(spark):
    rng = random.Random(4)
    titles = [None, "", "", "a", "A", "ab", "Plumber", "plumber"]
    for n in (4, 5, 6, 8, 11, 19, 30, 60):
        for _ in range(4):
            base = rng.choices("abcdef ", k=n)
            for _ in range(6):
                t = list(base)
                for _ in range(rng.randint(0, max(1, n // 8))):
                    at = rng.randrange(len(t))
                    t[at : at + rng.randint(0, 1)] = rng.choices("abcxyz", k=rng.randint(0, 2))
                titles.append("".join(t))
    rng.shuffle(titles)
    rows = list(enumerate(titles))
    df = spark.createDataFrame([(i, t, i % 3) for i, t in rows], "i long, title string, g int").repartition(4)
    for most in (90, 80):
        assert sorted(r.i for r in matching.greedy_distinct(df, "title", "i", [], most).collect()) == one_by_one(rows, most)
    got = sorted(r.i for r in matching.greedy_distinct(df, "title", "i", ["g"]).collect())
    assert got == sorted(i for g in range(3) for i in one_by_one([r for r in rows if r[0] % 3 == g]))


def test_query_compares_parts_of_all_sizes(spark, tmp_path):
    parts = [(1, "large ring", 3), (2, "large ring", 4), (3, "large rings", 5), (4, "old plate", 3)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    assert sorted(r.p_partkey for r in QUERIES["fuzzy_distinct"](spark, str(tmp_path)).collect()) == [1, 4]
