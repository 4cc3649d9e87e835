"""Hand-made edge rows the generated data cannot reach (FIXTURES.md §4).

Each expectation is computed by hand from the model semantics, independently
of both the Spark code and the DuckDB oracle.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import D

G, P, P2 = 10, 1, 2


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


# ----------------------------------------------------------------- tiers
@pytest.mark.parametrize("completed,start,expected", [
    (4, 100, "Meeting Target"),            # exactly 0.04
    (2, 100, "Below Target"),              # exactly 0.02
    (1, 100, "Significantly Below Target"),
])
def test_aac_tier_bounds(make_wh, completed, start, expected):
    # day 1: start=end=start; day 2: end = start - completed, all completed.
    wh = make_wh(
        available=[(P, G, D("2024-03-01"), start), (P, G, D("2024-03-02"), start - completed)],
        attested=[(P, G, D("2024-03-02"), completed)],
    )
    r = wh["int_medical_group_action_summary_monthly"].first()
    assert r["monthly_completion_rate"] == completed / start
    assert r["aac_performance_status"] == expected


@pytest.mark.parametrize("lost,expected", [(10, "Low Loss"), (20, "Moderate Loss"), (21, "High Loss")])
def test_loss_tier_bounds(make_wh, lost, expected):
    wh = make_wh(available=[(P, G, D("2024-03-01"), 100), (P, G, D("2024-03-02"), 100 - lost)])
    r = wh["int_medical_group_action_summary_monthly"].first()
    assert r["monthly_actions_became_ineligible"] == lost
    assert r["lost_opportunity_status"] == expected


@pytest.mark.parametrize("visits,patients,expected", [
    (7, 10, "Good"), (133, 190, "Good"), (69, 100, "Needs Improvement")])
def test_awv_tier_bound(make_wh, visits, patients, expected):
    claims = [(D("2024-05-05") if i < visits else None, G, i, P) for i in range(patients)]
    r = make_wh(claims=claims)["int_medical_group_awv_summary_annual"].first()
    assert r["awv_performance_status"] == expected
    assert r["visit_target_gap"] == max(0, -(-patients * 7 // 10) - visits)


def test_zero_denominator(make_wh):
    wh = make_wh(available=[(P, G, D("2024-03-01"), 0), (P, G, D("2024-03-02"), 0)])
    r = wh["int_medical_group_action_summary_monthly"].first()
    assert r["monthly_completion_rate"] == 0.0 and r["monthly_lost_opportunity_rate"] == 0.0
    assert r["running_monthly_completion_rate"] == 0.0
    assert r["aac_performance_status"] == "Significantly Below Target"
    assert r["lost_opportunity_status"] == "Low Loss"
    p = wh["int_medical_group_plan_action_summary_monthly"].first()
    assert p["monthly_completion_rate"] == 0.0


# ----------------------------------------------------------------- daily decomposition
def test_first_day_and_gap(make_wh):
    wh = make_wh(available=[(P, G, D("2024-01-01"), 50), (P, G, D("2024-01-05"), 40)])
    out = rows(wh["int_daily_action_decomposition"], "date_day")
    assert out[0]["actions_start_of_day"] == 50 and out[0]["daily_net_change_of_actions"] == 0
    assert out[0]["decomposition_balance_check"] is True
    # LAG takes the previous row (day 1), not the previous calendar day
    assert out[1]["actions_start_of_day"] == 50 and out[1]["count_actions_became_ineligible_in_day"] == 10


def test_plan_cumulative_drops_to_zero_and_counts_attested_only(make_wh):
    wh = make_wh(
        available=[(P, G, D("2024-01-01"), 50), (P, G, D("2024-01-02"), 45), (P, G, D("2024-01-04"), 40)],
        attested=[(P, G, D("2024-01-01"), 1), (P, G, D("2024-01-03"), 2), (P, G, D("2024-01-04"), 3)],
    )
    plan = rows(wh["int_daily_action_decomposition"], "date_day")
    assert [r["date_day"] for r in plan] == [D("2024-01-01"), D("2024-01-02"), D("2024-01-04")]
    # day 2 has no attested row -> 0; day 4 includes attested-only day 3: 1 + 2 + 3
    assert [r["cumulative_actions_completed"] for r in plan] == [1, 0, 6]
    group = rows(wh["int_medical_group_action_decomposition_daily"], "date_day")
    assert [r["cumulative_actions_completed"] for r in group] == [1, 1, 4]
    fact = wh["fct_awv_action"].filter(F.col("date_day") == D("2024-01-03")).first()
    assert fact["count_actions_available"] == 0 and fact["count_actions_attested_as_complete"] == 2


def test_net_change_signs_and_net_new(make_wh):
    wh = make_wh(available=[(P, G, D("2024-01-01"), 10), (P, G, D("2024-01-02"), 25)],
                 attested=[(P, G, D("2024-01-02"), 3)])
    plan = rows(wh["int_daily_action_decomposition"], "date_day")[1]
    group = rows(wh["int_medical_group_action_decomposition_daily"], "date_day")[1]
    assert plan["daily_net_change_of_actions"] == -15
    assert group["daily_net_change_of_actions"] == 15
    assert group["count_actions_became_ineligible_in_day"] == 0
    assert group["daily_net_new_available_actions"] == 12          # 15 - 3 - 0
    assert group["decomposition_balance_check"] is False           # -15 != 3 + 0


def test_null_count_keeps_ineligible_null(make_wh):
    wh = make_wh(available=[(P, G, D("2024-01-01"), 10), (P, G, D("2024-01-02"), None)])
    day2 = rows(wh["int_daily_action_decomposition"], "date_day")[1]
    assert day2["count_actions_became_ineligible_in_day"] is None
    assert day2["decomposition_balance_check"] is False


def test_duplicate_attested_key_fans_out(make_wh):
    wh = make_wh(available=[(P, G, D("2024-01-01"), 10)],
                 attested=[(P, G, D("2024-01-01"), 1), (P, G, D("2024-01-01"), 2)])
    assert wh["int_daily_action_decomposition"].count() == 2
    assert wh["fct_awv_action"].count() == 2
    suite = {r["test_name"]: r["failures"] for r in wh.data_tests(("unique",)).collect()}
    assert suite["unique_stg_actions_available_date_day_medical_group_id_plan_id"] == 0


def test_group_total_falls_when_a_plan_row_is_missing(make_wh):
    wh = make_wh(available=[(P, G, D("2024-01-01"), 10), (P2, G, D("2024-01-01"), 5),
                            (P, G, D("2024-01-02"), 10)])
    day2 = rows(wh["int_medical_group_action_decomposition_daily"], "date_day")[1]
    assert day2["actions_end_of_day"] == 10 and day2["count_actions_became_ineligible_in_day"] == 5


# ----------------------------------------------------------------- monthly + reports
def test_missing_month(make_wh):
    wh = make_wh(available=[(P, G, D("2024-01-01"), 100), (P, G, D("2024-01-02"), 90),
                            (P, G, D("2024-03-01"), 90), (P, G, D("2024-03-02"), 80)],
                 attested=[(P, G, D("2024-01-02"), 4), (P, G, D("2024-03-02"), 9)])
    m = rows(wh["int_medical_group_action_summary_monthly"], "date_month")
    assert [r["date_month"] for r in m] == [D("2024-01-01"), D("2024-03-01")]
    assert m[1]["monthly_completion_rate_prev_month"] == m[0]["monthly_completion_rate"]
    assert m[1]["monthly_running_total_actions_available"] == 190
    rep = rows(wh["rpt_medical_group_performance_monthly"], "date_month")
    assert len(rep) == 3
    feb = rep[1]
    assert feb["actions_available_start_month"] == 0 and feb["monthly_completion_rate"] == 0.0
    assert feb["aac_performance_status"] == "Missing Data"
    assert feb["monthly_completion_rate_change_mom"] is None


def test_entity_without_dated_claims(make_wh):
    wh = make_wh(claims=[(None, G, 1, P), (None, G, 2, P)])
    assert wh["int_medical_group_awv_summary_monthly"].count() == 0
    a = wh["int_medical_group_awv_summary_annual"].first()
    assert a["date_year"] == D("2024-01-01") and a["awv_rate"] == 0.0 and a["patient_count"] == 2


def test_null_patient_ids_count_zero(make_wh):
    wh = make_wh(claims=[(D("2024-02-02"), G, None, P), (None, G, None, P)])
    a = wh["int_medical_group_awv_summary_annual"].first()
    assert a["patient_count"] == 0 and a["awv_rate"] == 0.0
    assert a["awv_performance_status"] == "Missing Data"


def test_duplicate_patient_counts_rows(make_wh):
    wh = make_wh(claims=[(D("2024-02-02"), G, 1, P), (D("2024-06-02"), G, 1, P)])
    a = wh["int_medical_group_awv_summary_annual"].first()
    assert (a["patient_count"], a["visit_count"]) == (2, 2)


def test_two_years(make_wh):
    wh = make_wh(claims=[(D("2023-11-02"), G, 1, P), (D("2024-02-02"), G, 2, P), (None, G, 3, P)])
    m = rows(wh["int_medical_group_awv_summary_monthly"], "date_month")
    assert [r["cumulative_monthly_visits"] for r in m] == [1, 2]       # no reset at the year boundary
    assert all(r["total_patient_count"] == 3 for r in m)
    annual = rows(wh["int_medical_group_awv_summary_annual"], "date_year")
    assert [(r["date_year"].year, r["patient_count"]) for r in annual] == [(2023, 1), (2024, 2)]
    rep = wh["rpt_medical_group_performance_annual"].collect()
    assert [r["date_year"] for r in rep] == [D("2024-01-01")]
    months = wh["rpt_medical_group_performance_monthly"].select("date_month").distinct().count()
    assert months == 4          # 2023-11 .. 2024-02


def test_plan_row_absent_for_report_year(make_wh):
    wh = make_wh(claims=[(D("2024-02-02"), G, 1, P)])      # plan 2 has no claims
    rep = {r["plan_id"]: r for r in wh["rpt_medical_group_plan_performance_annual"].collect()}
    assert rep[P]["date_year"] == D("2024-01-01") and rep[P]["mg_awv_rate"] == 1.0
    assert rep[P2]["date_year"] is None and rep[P2]["mg_awv_rate"] is None
    assert rep[P2]["mg_awv_performance_status"] is None


def test_no_dates_raises(make_wh):
    wh = make_wh()
    with pytest.raises(Exception, match="needs at least one dated"):
        wh["dim_date_spine_day"].collect()


def test_report_year_parameter(make_wh):
    from kpiloom.params import KpiParams
    wh = make_wh(claims=[(D("2023-11-02"), G, 1, P), (D("2024-02-02"), G, 2, P)],
                 params=KpiParams(report_year=2023))
    rep = wh["rpt_medical_group_performance_annual"].collect()
    assert [(r["date_year"], r["patient_count"]) for r in rep] == [(D("2023-01-01"), 1)]


# ----------------------------------------------------------------- calendar
def test_weekend_and_iso_week(make_wh):
    wh = make_wh(available=[(P, G, D("2024-01-05"), 1), (P, G, D("2024-01-06"), 1), (P, G, D("2024-01-07"), 1)],
                 claims=[(D("2024-12-30"), G, 1, P)])
    flags = [r["is_weekend"] for r in rows(wh["int_daily_action_decomposition"], "date_day")]
    assert flags == [False, True, True]
    spine = {r["date_day"]: r for r in wh["dim_date_spine_day"].collect()}
    assert [spine[D(d)]["is_weekend"] for d in ("2024-01-05", "2024-01-06", "2024-01-07")] == [0, 1, 1]
    edge = spine[D("2024-12-30")]
    assert (edge["week_number"], edge["day_of_week"]) == (1, 1)
    assert len(spine) == (dt.date(2024, 12, 30) - dt.date(2024, 1, 5)).days + 1


def test_staging_trims_and_types(make_wh):
    wh = make_wh()
    r = wh["stg_plan_medical_group"].orderBy("plan_id").first()
    assert (r["plan_name"], r["medical_group_name"]) == ("Plan A", "Group X")
    types = dict(wh["stg_claims_awv"].dtypes)
    assert types == {"medical_group_id": "bigint", "patient_id": "string", "plan_id": "bigint",
                     "awv_date_of_service": "date"}


def test_staging_rounds_fractional_ids(spark):
    from kpiloom.operators.staging import stage_actions_available
    df = spark.createDataFrame([(D("2024-01-01"), 2.5, 1.4, 10.6)],
                               "date_day date, medical_group_id double, plan_id double, count_actions_available double")
    r = stage_actions_available(df).first()
    assert (r["medical_group_id"], r["plan_id"], r["count_actions_available"]) == (3, 1, 11)


def test_rate_scale_rounds_like_the_warehouse(make_wh):
    from kpiloom.params import KpiParams
    avail = [(P, G, D("2024-03-01"), 3), (P, G, D("2024-03-02"), 2)]
    att = [(P, G, D("2024-03-02"), 1)]
    exact = make_wh(available=avail, attested=att)["int_medical_group_action_summary_monthly"].first()
    rounded = make_wh(available=avail, attested=att, params=KpiParams(rate_scale=6))[
        "int_medical_group_action_summary_monthly"].first()
    assert exact["monthly_completion_rate"] == 1 / 3
    assert rounded["monthly_completion_rate"] == 0.333333


def test_checkpoint_dir_respects_session_setting(spark):
    from kpiloom.session import checkpoint_dir
    d = checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
