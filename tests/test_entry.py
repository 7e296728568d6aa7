"""Driver contract: entry() runs on sf0.001; every oracle has a query."""

import os

import pytest

import __spark_entry__ as E


def test_oracles_have_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_oracles_are_sql_text():
    assert {k: type(v) for k, v in E.oracle_sql().items() if not isinstance(v, str)} == {}


@pytest.mark.skipif(not os.path.exists(E.SMOKE_DIR), reason="driver tables not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "seq_id", "ids"]
    assert {r.split for r in rows} == {"train", "test"}
    assert all(len(r.ids.split()) == 64 for r in rows)
