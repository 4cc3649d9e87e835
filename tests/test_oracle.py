"""Every registered query equals its independent DuckDB oracle (names, types, rows)."""

import pytest

import __spark_entry__ as E
from kpiloom.plans.models import MODEL_NAMES
from kpiloom.plans.quality_suite import TEST_TYPES
from oracle.compare import compare, duckdb_connection

from conftest import SF_SMALL

SQL = E.oracle_sql()
#: The warehouse's own queries; those of the optional training-data part have their tests beside it.
OWN = {k: q for k, q in E.queries().items() if k in (*MODEL_NAMES, "dq_suite", *(f"dq_{t}" for t in TEST_TYPES)) or k.startswith("orphan_")}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(SQL)
    assert len(OWN) == 31


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    problems, _, _, _ = compare(spark, con, name, OWN[name], SQL[name], SF_SMALL)
    assert not problems, problems


def test_entry_runs(spark, tpch_wh):
    df = E.entry(spark)
    assert df.columns[:3] == ["medical_group_id", "medical_group_name", "date_month"]
    months = tpch_wh["dim_date_spine_day"].select("date_month").distinct().count()
    assert df.count() == tpch_wh["dim_medical_group"].count() * months > 0


@pytest.mark.parametrize("name", ["int_daily_action_decomposition", "int_medical_group_plan_action_summary_monthly",
                                  "rpt_medical_group_plan_performance_annual", "dq_relationships",
                                  "dim_date_spine_day"])
def test_results_do_not_depend_on_session_settings(spark, con, name):
    """AQE off, ANSI off, few shuffle partitions and a non-UTC session time zone: same rows."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.ansi.enabled": "false",
            "spark.sql.shuffle.partitions": "3", "spark.sql.session.timeZone": "Asia/Tokyo"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        problems, _, _, _ = compare(spark, con, name, OWN[name], SQL[name], SF_SMALL)
        assert not problems, problems
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
