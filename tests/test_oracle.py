"""Every registered query against its DuckDB oracle (small scale factor)."""

import pytest

from __spark_entry__ import entry
from tallyho.plans import all_oracles as oracle_sql, all_queries as queries
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(queries()) == set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() >= 1
    assert "score" in df.columns


@pytest.mark.parametrize("key", [k for k in KEYS if k in oracle_sql()])
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, queries()[key], oracle_sql()[key], SF)
    assert r["cols_ok"], (r["cols"], r["oracle_cols"])
    assert r["rows"] == r["oracle_rows"]
    assert r["hash_ok"]


def test_entry_schema_is_stable(spark):
    df = entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("lang", "string"), ("n_sentences", "bigint"), ("n_words", "bigint"),
        ("n_difficult", "bigint"), ("words_per_sentence", "double"),
        ("pct_difficult", "double"), ("score", "double")]
    assert df.count() == df.select("lang").distinct().count() >= 1
