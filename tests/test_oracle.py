"""Every registered query against its DuckDB oracle (sf0.001), plus entry()."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# the training-data queries have their own tests
ORACLE = {k: v for k, v in E.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_registered_with_unique_name():
    assert len(QUERIES) >= 50
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["rank", "session_id", "km_cluster", "votes", "rare_segment", "dbscan_noise", "anomaly_flag", "anomaly_score"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    msg, n, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert not msg, f"{name}: {msg}"
