"""Every registered query against its DuckDB oracle on the smallest scale factor."""
import collections
import datetime as dt
import decimal
import math
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "\0"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (decimal.Decimal, float)):
        f = float(v)
        return "nan" if math.isnan(f) else f"{f:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "provider_id"
    assert df.count() >= 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cols = sdf.columns
    srows = sdf.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    s = collections.Counter(tuple(_norm(r[cols.index(c)]) for c in order) for r in srows)
    o = collections.Counter(tuple(_norm(r[ocols.index(c)]) for c in order) for r in orows)
    assert s == o, (list((s - o).elements())[:2], list((o - s).elements())[:2])


def test_every_query_has_oracle_or_is_documented():
    from ratewatch.plans.registry import QUERIES
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_the_rest_works_without_the_training_data_folders(tmp_path, pipeline_stays):
    import shutil
    import subprocess
    import sys
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(here, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", "*.md"))
    assert not (copy / "ratewatch" / "llm").exists()
    if not pipeline_stays and (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    code = ("import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); "
            "assert 'rate_changes' in q and not [n for n in [*q, *o] if n == 'pipeline' or n.startswith('op')], list(q); print('fine')")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and "fine" in done.stdout, done.stderr
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=copy,
                               capture_output=True, text=True, timeout=300)
    assert collected.returncode == 0, collected.stdout[-2000:]
