"""The driver contract: entry smoke, registry/oracle consistency and the
DuckDB oracle on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from cohortlens.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL
from tools.oracle_check import compare

# Iterative models; the optional training-data queries have tests of their own.
NO_ORACLE = {"m02_clusters", "m03_test_score_model", "m04_dropout_model"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"intern_id", "risk_score", "risk_level"} <= set(df.columns)


def test_every_query_has_an_oracle_or_a_reason():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert {k for k in set(q) - set(s) if k not in E.LLM_QUERIES} == NO_ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = table_path(SF_SMALL, t)
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


# A cross-section of the registry (the full set runs in tools/oracle_check.py).
SAMPLE = ["b04_dropout_risk", "w02_streak_stats", "b16_course_kpis", "b25_skill_intensity", "b01_fact_lms",
          "b03_quality_report", "b11_score_distribution", "w01_hours_rank", "b19_action_items", "m01_features"]


@pytest.mark.parametrize("key", SAMPLE)
def test_matches_duckdb(spark, con, key):
    sp = E.queries()[key](spark, SF_SMALL).toPandas()
    dk = con.execute(E.oracle_sql()[key]).df()
    assert compare(sp, dk) is None
