"""Physical-plan properties that matter at scale (checked with explain)."""

import re

import pytest

import __spark_entry__ as E
from kpiloom.plans.models import MODEL_NAMES
from kpiloom.plans.quality_suite import TEST_TYPES

from conftest import D, SF_SMALL

#: The warehouse's own queries; those of the optional training-data part have their tests beside it.
QUERIES = {k: q for k, q in E.queries().items() if k in (*MODEL_NAMES, "dq_suite", *(f"dq_{t}" for t in TEST_TYPES)) or k.startswith("orphan_")}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_python(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    text = df._jdf.queryExecution().optimizedPlan().toString() + plan_text(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas", "Join Cross"):
        assert bad not in text, f"{name}: {bad}"


def test_scans_are_pruned_and_not_cut(spark):
    """The fixture reads only the columns it uses, and no filter leaves rows out."""
    from kpiloom.sources.tpch_fixture import claims, line_counts, load_tpch
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    tables = load_tpch(spark, SF_SMALL)
    text = plan_text(line_counts(tables))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in text
    for t in (text, plan_text(claims(tables))):
        assert "GreaterThan" not in t and "LessThan" not in t and "EqualTo" not in t


def test_attested_reads_only_r_lines(spark):
    from kpiloom.sources.tpch_fixture import actions_attested, line_counts, load_tpch
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan_text(actions_attested(line_counts(load_tpch(spark, SF_SMALL))))
    assert "EqualTo(l_returnflag,R)" in text


def test_plan_denominator_is_a_scalar_subquery(spark):
    df = QUERIES["int_medical_group_plan_action_summary_monthly"](spark, SF_SMALL)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in text


def _hand_warehouse(spark):
    import datetime as dt

    from kpiloom import KpiWarehouse
    from kpiloom.sources.raw import RAW_SCHEMAS, RawTables
    d = dt.date(2024, 1, 1)
    return KpiWarehouse(RawTables(
        plan_medical_group=spark.createDataFrame([(1, 10, "A", "G")], RAW_SCHEMAS["plan_medical_group"]),
        claims=spark.createDataFrame([(d, 10, 1, 1)], RAW_SCHEMAS["claims"]),
        actions_available=spark.createDataFrame([(1, 10, d, 5)], RAW_SCHEMAS["actions_available"]),
        actions_attested=spark.createDataFrame([(1, 10, d, 1)], RAW_SCHEMAS["actions_attested"]),
    ))


def _shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_inputs_are_read_once(spark):
    """Both models that join the two snapshots read each of them once and join once, copies or not."""
    wh = _hand_warehouse(spark)
    wh.raw = wh.raw._replace(actions_attested=wh.raw.actions_attested.unionByName(wh.raw.actions_attested).coalesce(1))
    for m, rows in (("fct_awv_action", 2), ("int_daily_action_decomposition", 2)):
        assert wh[m].count() == rows
        text = plan_text(wh[m]).split("== Initial Plan ==")[0]
        assert text.count("SortMergeJoin") == 1 and "partial_count" in text and "Union" in text, m
        assert text.count("Scan ExistingRDD") == 3, m                    # the test's table of copies has two branches


def test_monthly_plan_summary_reads_the_daily_table_once(spark):
    """The global maximum is rolled up from the monthly rows: their exchange is shared, nothing is stored."""
    wh = _hand_warehouse(spark)
    assert not wh._stored
    df = wh["int_medical_group_plan_action_summary_monthly"]
    df.collect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)                  # subqueries included
    final = "".join(x.split("+- == Initial Plan ==")[0] for x in text.split("== Final Plan ==")[1:])
    assert not wh._stored and "ReusedExchange" in final
    assert final.count("FullOuter") <= 1, final                          # the daily table's join runs once


def test_a_build_scans_the_claim_fact_once_for_the_visit_summaries(spark, tmp_path):
    wh = _hand_warehouse(spark)
    wh.materialize(str(tmp_path))
    for m in ("int_medical_group_awv_summary_annual", "int_medical_group_awv_summary_monthly",
              "int_medical_group_plan_awv_summary_annual", "int_medical_group_plan_awv_summary_monthly"):
        from kpiloom.plans.models import BUILDERS
        text = plan_text(BUILDERS[m](wh))
        assert "fct_awv_claim" not in text and text.count("FileScan") == 1, m


def test_claims_are_reduced_map_side(spark):
    """Every aggregate over claims has a partial (map-side) step before its shuffle."""
    wh = _hand_warehouse(spark)
    for m in ("int_medical_group_awv_summary_monthly", "int_medical_group_plan_awv_summary_annual"):
        text = wh[m]._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in text and "partial_sum" in text, m
    text = wh["dim_patient"]._jdf.queryExecution().executedPlan().toString()
    assert text.count("HashAggregate(keys=[patient_id") == 2        # partial + final distinct
    text = wh["int_medical_group_awv_summary_monthly"]._jdf.queryExecution().executedPlan().toString()
    # totals and monthly visits come from one read of claims (no self-join)
    assert text.count("Scan ExistingRDD") == 1 and "Join" not in text


def _final_text(df) -> str:
    """The executed plan with its subqueries."""
    df.collect()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return "".join(x.split("+- == Initial Plan ==")[0] for x in text.split("== Final Plan ==")[1:])


def test_monthly_plan_report_computes_the_daily_rows_once(spark):
    """Its joins leave the monthly rows as they are, so the global maximum shares their exchange."""
    final = _final_text(_hand_warehouse(spark)["rpt_medical_group_plan_performance_monthly"])
    assert final.count("SortMergeJoin FullOuter") == 1 and "ReusedExchange" in final


def test_lines_are_joined_once(spark):
    """Customers are joined to the orders, not to the lines, and the windows over the lines' counts sort once."""
    from kpiloom.sources.tpch_fixture import actions_available, line_counts, load_tpch
    text = line_counts(load_tpch(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    upper, lower = [x for x in text.splitlines() if "Join Inner" in x]
    assert "l_orderkey" in upper and "o_custkey" in lower
    counts = spark.createDataFrame([(1, 1, D("2024-01-01"), "N", 2)], "g long, p long, day date, flag string, n long")
    assert plan_text(actions_available(counts)).count("Sort [") == 1


@pytest.mark.parametrize("model", ["int_daily_action_decomposition", "fct_awv_action"])
def test_joins_of_the_snapshots_sort_as_the_windows_do(spark, model):
    join = next(x for x in plan_text(_hand_warehouse(spark)[model]).splitlines() if "SortMergeJoin" in x)
    assert re.match(r".*SortMergeJoin \[medical_group_id#\d+L, plan_id#\d+L, date_day#\d+\]", join)
