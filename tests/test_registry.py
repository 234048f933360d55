"""Every registered query runs on the smallest data, and each SQL-checkable one
returns the same rows as its DuckDB oracle."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from mixtape.plans import registry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


#: Checks that don't follow the name of their query.
COMPANIONS = {"ann_single": "check_ann_rows", "ann_dense": "check_ann_dense_rows", "lsh_dense_hashes": "check_lsh_dense_hashes"}


@pytest.fixture(scope="module")
def duck(sf_smoke):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_smoke}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_sql_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == entry.entry(spark).columns


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_against_oracle(spark, sf_smoke, duck, name):
    from oracle_check import canon
    df = entry.queries()[name](spark, sf_smoke)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        # a learned result: there are rows, and another entry compares what must hold of them
        assert len(rows) > 0
        assert COMPANIONS.get(name, f"check_{name}") in entry.oracle_sql()
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(rows, df.columns) == canon(res.fetchall(), cols)


def test_entry_without_a_dependency_of_the_optional_queries():
    """The library's own queries stay when the optional ones can't be imported."""
    import subprocess
    code = ("import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; "
            "print(len(e.queries()), sum(n.startswith('op') for n in e.queries()), len(e.oracle_sql()))")
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    n, optional, with_sql = map(int, out.stdout.split())
    assert n == len(registry.queries()) and optional == 0 and with_sql == len(registry.oracle_sql())
