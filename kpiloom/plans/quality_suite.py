"""The declared data tests of every model, and a suite runner.

``DECLARED_TESTS`` lists the 90 test instances the reference declares in its
YAML (fixed values: models, columns, parents, value sets, ranges, severities).
``run_suite`` turns them into one lazy DataFrame — one row per test with its
failure count, severity and status — that a single action evaluates.  The
row-level checks of a model share one scan, its relationships another; failures
that are already known (observed while a model was written) are taken as they
are.  Nothing is collected or looped over on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators import quality as Q

TEST_TYPES = ("not_null", "unique", "relationships", "accepted_values", "accepted_range")
ROW_TYPES = ("not_null", "accepted_range", "accepted_values")       # countable while the rows pass by


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str                       # column, or the key expression text for `unique` on several columns
    test: str
    severity: str = "error"
    key_columns: tuple[str, ...] = ()  # unique: columns joined with '-'
    to: str | None = None              # relationships: parent model
    field: str | None = None           # relationships: parent column
    values: tuple = ()                 # accepted_values
    min_value: object = None           # accepted_range
    max_value: object = None
    inclusive: bool = True

    @property
    def name(self) -> str:
        col = "_".join(self.key_columns) if self.key_columns else self.column
        tail = f"__{self.to}_{self.field}" if self.test == "relationships" else ""
        return f"{self.test}_{self.model}_{col}{tail}"

    @property
    def condition(self) -> str:
        """What is tested, to tell whether failures noted earlier are those of this test."""
        return repr((self.test, self.column, self.values, self.min_value, self.max_value, self.inclusive))


def _nn(model: str, *cols: str) -> list[DataTest]:
    return [DataTest(model, c, "not_null") for c in cols]


def _unique_key(model: str, cols: tuple[str, ...], severity: str = "error") -> DataTest:
    return DataTest(model, " || '-' || ".join(cols), "unique", severity, key_columns=cols)


def _rel(model: str, col: str, to: str, fld: str, severity: str = "error") -> DataTest:
    return DataTest(model, col, "relationships", severity, to=to, field=fld)


def _range(model: str, col: str, lo=None, hi=None) -> DataTest:
    return DataTest(model, col, "accepted_range", min_value=lo, max_value=hi)


def _values(model: str, col: str, values: Iterable, severity: str = "error") -> DataTest:
    return DataTest(model, col, "accepted_values", severity, values=tuple(values))


_PMG = "stg_plan_medical_group"
_CLM = "stg_claims_awv"
_AV = "stg_actions_available"
_AT = "stg_actions_attested_as_complete"
_SPINE = "dim_date_spine_day"
_DAILY = "int_daily_action_decomposition"

# --- fixed values: the declared tests of the reference --------------------------
DECLARED_TESTS: list[DataTest] = [
    # staging
    *_nn(_PMG, "medical_group_id", "plan_id", "medical_group_name", "plan_name"),
    _unique_key(_PMG, ("medical_group_id", "plan_id")),
    *_nn(_CLM, "medical_group_id"),
    _rel(_CLM, "medical_group_id", _PMG, "medical_group_id"),
    *_nn(_CLM, "patient_id", "plan_id"),
    _rel(_CLM, "plan_id", _PMG, "plan_id", "warn"),
    _unique_key(_CLM, ("medical_group_id", "plan_id", "patient_id", "awv_date_of_service"), "warn"),
    *_nn(_AV, "date_day", "medical_group_id"),
    _rel(_AV, "medical_group_id", _PMG, "medical_group_id"),
    *_nn(_AV, "plan_id"),
    _rel(_AV, "plan_id", _PMG, "plan_id"),
    *_nn(_AV, "count_actions_available"),
    _range(_AV, "count_actions_available", 0),
    _unique_key(_AV, ("date_day", "medical_group_id", "plan_id")),
    *_nn(_AT, "date_day", "medical_group_id"),
    _rel(_AT, "medical_group_id", _PMG, "medical_group_id"),
    *_nn(_AT, "plan_id"),
    _rel(_AT, "plan_id", _PMG, "plan_id"),
    *_nn(_AT, "count_actions_attested_as_complete"),
    _range(_AT, "count_actions_attested_as_complete", 0),
    # kimball: dimensions
    *_nn(_SPINE, "date_day"),
    DataTest(_SPINE, "date_day", "unique"),
    *_nn(_SPINE, "year"),
    _range(_SPINE, "year", 2020, 2030),
    *_nn(_SPINE, "quarter"),
    _values(_SPINE, "quarter", [1, 2, 3, 4]),
    *_nn(_SPINE, "month"),
    _values(_SPINE, "month", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]),
    *_nn(_SPINE, "day"),
    _values(_SPINE, "day", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20,
                            21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31]),
    *_nn(_SPINE, "date_month", "week_number", "day_of_week"),
    _values(_SPINE, "day_of_week", [1, 2, 3, 4, 5, 6, 7]),
    *_nn(_SPINE, "is_weekend"),
    _values(_SPINE, "is_weekend", [0, 1]),
    *_nn("dim_medical_group", "medical_group_id"),
    DataTest("dim_medical_group", "medical_group_id", "unique"),
    *_nn("dim_medical_group", "medical_group_name"),
    *_nn("dim_patient", "patient_id"),
    DataTest("dim_patient", "patient_id", "unique"),
    *_nn("dim_plan", "plan_id"),
    DataTest("dim_plan", "plan_id", "unique"),
    *_nn("dim_plan", "plan_name"),
    # kimball: facts
    *_nn("fct_awv_action", "date_day"),
    _rel("fct_awv_action", "date_day", _SPINE, "date_day"),
    *_nn("fct_awv_action", "medical_group_id"),
    _rel("fct_awv_action", "medical_group_id", "dim_medical_group", "medical_group_id"),
    *_nn("fct_awv_action", "plan_id"),
    _rel("fct_awv_action", "plan_id", "dim_plan", "plan_id"),
    *_nn("fct_awv_action", "count_actions_available"),
    _range("fct_awv_action", "count_actions_available", 0),
    *_nn("fct_awv_action", "count_actions_attested_as_complete"),
    _range("fct_awv_action", "count_actions_attested_as_complete", 0),
    _rel("fct_awv_claim", "date_day", _SPINE, "date_day"),
    *_nn("fct_awv_claim", "medical_group_id"),
    _rel("fct_awv_claim", "medical_group_id", "dim_medical_group", "medical_group_id"),
    *_nn("fct_awv_claim", "plan_id"),
    _rel("fct_awv_claim", "plan_id", "dim_plan", "plan_id", "warn"),
    *_nn("fct_awv_claim", "patient_id"),
    _rel("fct_awv_claim", "patient_id", "dim_patient", "patient_id"),
    *_nn("fct_awv_claim", "had_visit"),
    _values("fct_awv_claim", "had_visit", [1, 0]),
    # intermediate
    *_nn(_DAILY, "date_day", "medical_group_id", "plan_id", "actions_start_of_day"),
    _range(_DAILY, "actions_start_of_day", 0),
    *_nn(_DAILY, "actions_end_of_day"),
    _range(_DAILY, "actions_end_of_day", 0),
    *_nn(_DAILY, "daily_net_change_of_actions", "count_actions_completed_in_day"),
    _range(_DAILY, "count_actions_completed_in_day", 0),
    *_nn(_DAILY, "cumulative_actions_completed"),
    _range(_DAILY, "cumulative_actions_completed", 0),
    *_nn(_DAILY, "count_actions_became_ineligible_in_day"),
    _range(_DAILY, "count_actions_became_ineligible_in_day", 0),
    *_nn(_DAILY, "cumulative_actions_became_ineligible"),
    _range(_DAILY, "cumulative_actions_became_ineligible", 0),
    *_nn(_DAILY, "decomposition_balance_check"),
    _values(_DAILY, "decomposition_balance_check", [True], "warn"),
    *_nn(_DAILY, "is_weekend"),
    *_nn("int_medical_group_action_decomposition_daily", "date_day", "medical_group_id"),
]
# ---------------------------------------------------------------------------------

SUITE_COLUMNS = ["test_name", "model", "column_name", "test_type", "severity", "failures", "status"]


def _with_meta(counts: DataFrame, tests: dict[str, DataTest]) -> DataFrame:
    """Attach model/column/type/severity to (name, failures) rows via a literal map."""
    def lookup(attr: str):
        pairs = []
        for name, t in tests.items():
            pairs += [F.lit(name), F.lit(getattr(t, attr))]
        return F.create_map(*pairs)[F.col("name")]
    return counts.select(
        F.col("name").alias("test_name"),
        lookup("model").alias("model"),
        lookup("column").alias("column_name"),
        lookup("test").alias("test_type"),
        lookup("severity").alias("severity"),
        F.col("failures").cast("long").alias("failures"),
    )


def _grouped_count(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("name"), "failures")


def unique_key(t: DataTest) -> Column:
    return Q.concat_key(*t.key_columns) if t.key_columns else F.col(t.column)


def unique_parts(t: DataTest) -> Column | tuple[str, ...]:
    """The key as ``quality.unique_candidates`` takes it: its columns, if it is joined from several."""
    return t.key_columns or unique_key(t)


def row_checks(tests: Iterable[DataTest]) -> tuple[list, list]:
    """The row-level tests as checks: (name, failing-row predicate) and (name, column, accepted values)."""
    rows, values = [], []
    for t in tests:
        if t.test == "not_null":
            rows.append((t.name, F.col(t.column).isNull()))
        elif t.test == "accepted_range":
            rows.append((t.name, ~Q.range_condition(t.column, t.min_value, t.max_value, t.inclusive)))
        elif t.test == "accepted_values":
            values.append((t.name, t.column, t.values))
    return rows, values


def run_suite(model: Callable[[str], DataFrame], tests: Iterable[DataTest] = DECLARED_TESTS,
              test_types: Iterable[str] = TEST_TYPES, known: Mapping[str, int] | None = None,
              candidates: DataFrame | None = None) -> DataFrame:
    """One row per test: (test_name, model, column_name, test_type, severity, failures, status).

    ``model(name)`` returns the DataFrame of a model (built lazily or read from
    its written table).  ``known`` has failures, by test, that need no counting;
    ``candidates`` the repeated key hashes of the ``unique`` tests, if they are
    stored (``quality.unique_candidates``).
    """
    wanted, known = set(test_types), known or {}
    selected = [t for t in tests if t.test in wanted]
    names = [t.name for t in selected]
    if len(set(names)) != len(names):
        raise ValueError(f"test names repeat: {sorted({n for n in names if names.count(n) > 1})}")
    parts: list[DataFrame] = []
    per_model: dict[str, list[DataTest]] = {}
    related: dict[str, list] = {}
    for t in selected:
        if t.name in known:
            continue
        if t.test == "relationships":
            related.setdefault(t.model, []).append((t.name, t.column, model(t.to), t.field))
        elif t.test != "unique":
            per_model.setdefault(t.model, []).append(t)
        elif candidates is None:
            parts.append(_grouped_count(t.name, Q.unique_failures(model(t.model), unique_key(t))))
        else:
            own = candidates.filter(F.col("name") == t.name)
            parts.append(_grouped_count(t.name, Q.repeated_keys(model(t.model), unique_parts(t), own)))
    parts += [Q.batched_failures(model(m), *row_checks(some)) for m, some in per_model.items()]
    parts += [Q.relationship_counts(model(m), checks) for m, checks in related.items()]
    settled = [(n, int(known[n])) for n in names if n in known]
    if settled or not parts:
        literal = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).cast("long").alias("failures")) for n, c in settled])
        one = SparkSession.active().range(1)
        parts.append(one.select(F.explode(literal).alias("r")).select("r.*") if settled
                     else one.select(F.lit("").alias("name"), F.col("id").alias("failures")).limit(0))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    meta = _with_meta(counts, {t.name: t for t in selected})
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return meta.select("*", status.alias("status")).select(*SUITE_COLUMNS)


def failing_rows(model: Callable[[str], DataFrame], test: DataTest) -> DataFrame:
    """The rows that fail one test, lazily (``unique``: the repeated values with their counts)."""
    df = model(test.model)
    if test.test == "not_null":
        return Q.not_null_failures(df, test.column)
    if test.test == "unique":
        return Q.unique_failures(df, Q.concat_key(*test.key_columns) if test.key_columns else test.column)
    if test.test == "relationships":
        return Q.relationship_failures(df, test.column, model(test.to), test.field)
    if test.test == "accepted_values":
        return Q.accepted_values_failures(df, test.column, test.values)
    return Q.accepted_range_failures(df, test.column, test.min_value, test.max_value, test.inclusive)
