"""Driver contract: entry() runs; every registered query equals its DuckDB oracle."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["observation_year", "station_count", "tmax_days", "station_days"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(E._oracles())
    assert set(E._QUERIES) <= set(E.queries()) and set(E._oracles()) <= set(E.oracle_sql())


def test_other_queries_survive_missing_packages(monkeypatch):
    """Without the training-data subpackage, or a library that it needs, the other queries stay."""
    for missing in ("wxstar.llm", "corpus_pipeline"):
        with monkeypatch.context() as m:
            for name in [n for n in sys.modules if n.startswith(("wxstar.llm", "corpus_pipeline"))]:
                m.delitem(sys.modules, name)
            m.setitem(sys.modules, missing, None)
            assert set(E.queries()) == set(E._QUERIES) and set(E.oracle_sql()) == set(E._oracles())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")
@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]
