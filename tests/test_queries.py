"""Every registered query that has SQL gives DuckDB's rows on the smallest tables; the registry works without the llm folder."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

from plazaflow.plans.catalog import QUERIES, SQL

SF = os.environ.get("PLAZA_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name in SQL:
        got = duck.execute(SQL[name])
        columns = [d[0] for d in got.description]
        assert sorted(columns) == sorted(df.columns)
        want = sorted(repr(tuple(plain(x) for _, x in sorted(zip(columns, r, strict=True)))) for r in got.fetchall())
        assert sorted(repr(tuple(plain(r[c]) for c in sorted(columns))) for r in rows) == want


def test_entry_without_llm(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("__spark_entry__.py", "plazaflow"):
        os.symlink(f"{repo}/{name}", tmp_path / name) if name.endswith(".py") else None
    (tmp_path / "plazaflow").mkdir()
    for name in os.listdir(f"{repo}/plazaflow"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{repo}/plazaflow/{name}", tmp_path / "plazaflow" / name)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), any(n.startswith('op1') for n in q))"], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.stdout.split() == [str(len(QUERIES)), "True", "False"], out.stderr
