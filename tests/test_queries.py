"""Every registered query against its DuckDB oracle on the smallest data set,
plus plan-shape checks for the scale properties we rely on."""
import decimal
import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry
from starloom.plans import loads, retail
from sf_dirs import SF_SMALL

STAR_QUERIES = sorted({**retail.QUERIES, **loads.QUERIES})
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (decimal.Decimal, dt.date, dt.datetime)):
        return str(v)
    return str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 25


@pytest.mark.parametrize("name", STAR_QUERIES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    cur = duck.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cur.fetchall(), cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", STAR_QUERIES)
def test_plans_have_no_cartesian_product_or_python(spark, capsys, name):
    entry.queries()[name](spark, SF_SMALL).explain("formatted")
    plan = capsys.readouterr().out
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_scans_are_pruned(spark, capsys):
    entry.queries()["child_rollup"](spark, SF_SMALL).explain("formatted")
    plan = capsys.readouterr().out
    read = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert read and all("l_comment" not in ln and "l_tax" not in ln for ln in read)


@pytest.mark.parametrize("name", STAR_QUERIES)
def test_query_on_full_scale_paths_matches_oracle(spark, duck, distributed_paths, capsys, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    cur = duck.execute(sql)
    cols = [c[0] for c in cur.description]
    assert got == _rows(cur.fetchall(), cols)
