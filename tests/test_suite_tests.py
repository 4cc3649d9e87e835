"""The declared tests are pinned, none is lost, and their failing rows can be read."""

import collections
import dataclasses

import pytest
from conftest import D

from kpiloom.plans.quality_suite import DECLARED_TESTS

DAY = D("2024-01-01")

# The declared tests by model, those of severity warn, and their value lists and ranges.
PER_MODEL = {'dim_date_spine_day': 16,
 'dim_medical_group': 3,
 'dim_patient': 2,
 'dim_plan': 3,
 'fct_awv_action': 10,
 'fct_awv_claim': 9,
 'int_daily_action_decomposition': 19,
 'int_medical_group_action_decomposition_daily': 2,
 'stg_actions_attested_as_complete': 7,
 'stg_actions_available': 8,
 'stg_claims_awv': 6,
 'stg_plan_medical_group': 5}
WARNS = {('fct_awv_claim', 'plan_id', 'relationships'),
 ('int_daily_action_decomposition', 'decomposition_balance_check', 'accepted_values'),
 ('stg_claims_awv',
  "medical_group_id || '-' || plan_id || '-' || patient_id || '-' || awv_date_of_service",
  'unique'),
 ('stg_claims_awv', 'plan_id', 'relationships')}
VALUES = {('dim_date_spine_day', 'day'): [1,
                                 2,
                                 3,
                                 4,
                                 5,
                                 6,
                                 7,
                                 8,
                                 9,
                                 10,
                                 11,
                                 12,
                                 13,
                                 14,
                                 15,
                                 16,
                                 17,
                                 18,
                                 19,
                                 20,
                                 21,
                                 22,
                                 23,
                                 24,
                                 25,
                                 26,
                                 27,
                                 28,
                                 29,
                                 30,
                                 31],
 ('dim_date_spine_day', 'day_of_week'): [1, 2, 3, 4, 5, 6, 7],
 ('dim_date_spine_day', 'is_weekend'): [0, 1],
 ('dim_date_spine_day', 'month'): [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12],
 ('dim_date_spine_day', 'quarter'): [1, 2, 3, 4],
 ('fct_awv_claim', 'had_visit'): [1, 0],
 ('int_daily_action_decomposition', 'decomposition_balance_check'): [True]}
RANGES = {(2020, 2030), (0, None)}


def test_declared_tests_are_pinned():
    kinds = collections.Counter(t.test for t in DECLARED_TESTS)
    assert kinds == {"not_null": 52, "relationships": 13, "accepted_range": 11, "accepted_values": 7, "unique": 7}
    severities = collections.Counter(t.severity for t in DECLARED_TESTS)
    assert severities["error"] + severities["warn"] == len(DECLARED_TESTS) == 90
    per_model = collections.Counter(t.model for t in DECLARED_TESTS)
    assert per_model == PER_MODEL
    warns = {(t.model, t.column, t.test) for t in DECLARED_TESTS if t.severity == "warn"}
    assert warns == WARNS
    values = {(t.model, t.column): list(t.values) for t in DECLARED_TESTS if t.test == "accepted_values"}
    assert values == VALUES
    ranges = {(t.min_value, t.max_value) for t in DECLARED_TESTS if t.test == "accepted_range"}
    assert ranges == RANGES


def test_two_unique_tests_of_a_model_give_two_rows(make_wh):
    wh = make_wh(claims=[(DAY, 10, 1, 1)])
    base = next(t for t in DECLARED_TESTS if t.test == "unique" and t.model == "dim_patient")
    again = dataclasses.replace(base, key_columns=("patient_id", "patient_id"))
    tests = [base, again]
    rows = wh.data_tests(tests=tests).collect()
    assert sorted(r.test_name for r in rows) == sorted([base.name, again.name])
    with pytest.raises(ValueError, match="repeat"):
        wh.data_tests(tests=[base, base])


def test_failing_rows_equal_the_counted_failures(tpch_wh):
    counted = {r.test_name: r.failures for r in tpch_wh.data_tests(["relationships", "accepted_values"]).collect()}
    failing = {n: c for n, c in counted.items() if c}
    assert failing
    for name, n in failing.items():
        assert tpch_wh.failing_rows(name).count() == n
    with pytest.raises(KeyError):
        tpch_wh.failing_rows("no such test")


def test_daily_decomposition_is_counted_without_being_written(make_wh):
    wh = make_wh(available=[(1, 10, DAY, 50), (1, 10, D("2024-01-02"), -4)], attested=[(1, 10, DAY, 2)], claims=[(DAY, 10, 1, 1)])
    counted = {r.test_name: r.failures for r in wh.data_tests(["accepted_range"]).collect()}
    assert "stg_actions_available" in wh._stored and "int_daily_action_decomposition" not in wh._stored
    assert counted["accepted_range_int_daily_action_decomposition_actions_end_of_day"] == 1
