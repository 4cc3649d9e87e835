"""The model graph: every reference model as a lazily built DataFrame.

``KpiWarehouse(raw)`` exposes the 23 models by name.  Each is an ordinary
function call on its upstream DataFrames (no templating, no ref resolution):
Catalyst sees one plan per requested model, prunes unused columns, pushes
filters to the scans and reuses identical exchanges.

``materialize`` is the table sink: it writes the non-ephemeral models in
dependency order and swaps each for its written table, so downstream models
read the stored result (lineage is cut at every table, as a warehouse build
would).
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators import action_summary as AS
from kpiloom.operators import awv_summary as AW
from kpiloom.operators import decomposition as DC
from kpiloom.operators import dimensions as DM
from kpiloom.operators import facts as FC
from kpiloom.operators import quality as Q
from kpiloom.operators import reports as RP
from kpiloom.operators import staging as ST
from kpiloom.params import KpiParams
from kpiloom.plans.quality_suite import (DECLARED_TESTS, ROW_TYPES, TEST_TYPES, DataTest, failing_rows, row_checks,
                                         run_suite, unique_parts)
from kpiloom.session import store
from kpiloom.sources.raw import RawTables, footer_scan
from kpiloom.sources.sink import (Buckets, current_notes, current_path, path_exists, read_table, replace_table,
                                  store_bucketed)
from kpiloom.sources.tpch_fixture import derive_raw

Builder = Callable[["KpiWarehouse"], DataFrame]

# Dependency order (every model after the models it reads).
BUILDERS: dict[str, Builder] = {
    "stg_plan_medical_group": lambda w: ST.stage_plan_medical_group(w.raw.plan_medical_group),
    "stg_claims_awv": lambda w: ST.stage_claims(w.raw.claims),
    "stg_actions_available": lambda w: ST.stage_actions_available(w.raw.actions_available),
    "stg_actions_attested_as_complete": lambda w: ST.stage_actions_attested(w.raw.actions_attested),
    "dim_date_spine_day": lambda w: DM.date_spine(
        *map(w.for_bounds, ("stg_actions_available", "stg_actions_attested_as_complete", "stg_claims_awv"))),
    "dim_medical_group": lambda w: DM.dim_medical_group(w["stg_plan_medical_group"]),
    "dim_medical_group_plan": lambda w: DM.dim_medical_group_plan(w["stg_plan_medical_group"]),
    "dim_patient": lambda w: DM.dim_patient(w["stg_claims_awv"]),
    "dim_plan": lambda w: DM.dim_plan(w["stg_plan_medical_group"]),
    "fct_awv_action": lambda w: FC.action_fact(
        w["stg_actions_available"], w["stg_actions_attested_as_complete"]),
    "fct_awv_claim": lambda w: FC.claim_fact(w["stg_claims_awv"]),
    "int_daily_action_decomposition": lambda w: DC.plan_daily_decomposition(
        w["stg_actions_available"], w["stg_actions_attested_as_complete"]),
    "int_medical_group_action_decomposition_daily": lambda w: DC.group_daily_decomposition(
        w["stg_actions_available"], w["stg_actions_attested_as_complete"]),
    "int_medical_group_action_summary_monthly": lambda w: AS.group_monthly_action_summary(
        w["int_medical_group_action_decomposition_daily"], w.params),
    "int_medical_group_plan_action_summary_monthly": lambda w: AS.plan_monthly_action_summary(
        w["int_daily_action_decomposition"], w.params),
    "int_medical_group_awv_summary_annual": lambda w: AW.annual_visit_summary(
        w.visit_rollup, AW.GROUP_KEYS, w.params),
    "int_medical_group_awv_summary_monthly": lambda w: AW.monthly_visit_summary(
        w.visit_rollup, AW.GROUP_KEYS, w.params),
    "int_medical_group_plan_awv_summary_annual": lambda w: AW.annual_visit_summary(
        w.visit_rollup, AW.PLAN_KEYS, w.params),
    "int_medical_group_plan_awv_summary_monthly": lambda w: AW.monthly_visit_summary(
        w.visit_rollup, AW.PLAN_KEYS, w.params),
    "rpt_medical_group_performance_annual": lambda w: RP.group_annual_report(
        w["dim_medical_group"], w["dim_date_spine_day"], w["int_medical_group_awv_summary_annual"], w.params),
    "rpt_medical_group_performance_monthly": lambda w: RP.group_monthly_report(
        w["dim_medical_group"], w.for_bounds("dim_date_spine_day"), w["int_medical_group_action_summary_monthly"],
        w["int_medical_group_awv_summary_monthly"]),
    "rpt_medical_group_plan_performance_annual": lambda w: RP.plan_annual_report(
        w["dim_medical_group_plan"], w["dim_date_spine_day"], w["int_medical_group_plan_awv_summary_annual"],
        w["int_medical_group_awv_summary_annual"], w.params),
    "rpt_medical_group_plan_performance_monthly": lambda w: RP.plan_monthly_report(
        w["dim_medical_group_plan"], w.for_bounds("dim_date_spine_day"), w["int_medical_group_plan_action_summary_monthly"],
        w["int_medical_group_plan_awv_summary_monthly"]),
}

MODEL_NAMES: list[str] = list(BUILDERS)

# The dated staging models, each a projection of one raw table.
RAW_STAGES = {
    "stg_claims_awv": (ST.stage_claims, "claims"),
    "stg_actions_available": (ST.stage_actions_available, "actions_available"),
    "stg_actions_attested_as_complete": (ST.stage_actions_attested, "actions_attested"),
}

# The reference ends these models with an ORDER BY.  A stored table keeps no
# order (and the sort would cost a range shuffle), so the order is applied only
# when presenting: ``KpiWarehouse.presented``.
PRESENTATION_ORDER: dict[str, list[str]] = {
    "int_daily_action_decomposition": ["medical_group_id", "plan_id", "date_day"],
    "int_medical_group_action_decomposition_daily": ["medical_group_id", "date_day"],
    "int_medical_group_action_summary_monthly": ["medical_group_id", "date_month"],
    "int_medical_group_plan_action_summary_monthly": ["medical_group_id", "plan_id", "date_month"],
}

# Inlined into their consumers, never stored (the reference's ephemeral models).
EPHEMERAL = frozenset({
    "int_medical_group_plan_action_summary_monthly",
    "int_medical_group_plan_awv_summary_annual",
    "int_medical_group_plan_awv_summary_monthly",
})

# Read by several test branches each; stored once where the tests build them.  The daily decomposition has row-level tests
# alone, which count it in one pass: it is not written for them.
TESTED_OFTEN = ["stg_plan_medical_group", "stg_claims_awv", "stg_actions_available", "stg_actions_attested_as_complete",
                "dim_date_spine_day", "dim_medical_group", "dim_plan"]


# Stored models with a summary by entity and month, and the keys of its window; see ``KpiWarehouse.buckets``.
BUCKETED: dict[str, tuple[tuple[str, ...], bool]] = {
    "int_daily_action_decomposition": (("medical_group_id", "plan_id"), False),
    "int_medical_group_action_decomposition_daily": (("medical_group_id",), True),       # ends in a window by group
}


class KpiWarehouse:
    """Lazily built models over four raw tables.

    ``buckets``: so many buckets for the daily decompositions and the roll-up of the claims in a
    build over Parquet.  The monthly summaries over them (#14, #15, #17, #19) then need no exchange.
    It should be the session's shuffle partitions, or a divisor of them.
    """

    def __init__(self, raw: RawTables, params: KpiParams = KpiParams(), footer_bounds: bool = False, buckets: int | None = None):
        self.raw = raw
        self.buckets = buckets
        self.footer_bounds = footer_bounds            # see ``for_bounds``
        self.params = params
        self._models: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self._written: set[str] = set()
        self._noted: dict[str, dict[str, list]] = {}  # by model and test: its condition and failures, counted while it was written
        self._footers: dict[str, DataFrame] = {}      # written Parquet tables as scans that know their bounds
        self._rollup: tuple[DataFrame, DataFrame] | None = None
        self.build_seconds: dict[str, float] = {}     # filled by materialize

    @classmethod
    def from_tpch(cls, spark: SparkSession, sf_dir: str, params: KpiParams = KpiParams()) -> "KpiWarehouse":
        """Models over the raw tables derived from the driver's TPC-H tables."""
        return cls(derive_raw(spark, sf_dir), params)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._models:
            if name not in BUILDERS:
                raise KeyError(f"unknown model {name!r}")
            self._models[name] = BUILDERS[name](self)
        return self._models[name]

    def presented(self, name: str) -> DataFrame:
        """The model in the reference's ORDER BY, for display (unordered models as is)."""
        df = self[name]
        return df.orderBy(*PRESENTATION_ORDER[name]) if name in PRESENTATION_ORDER else df

    def for_bounds(self, name: str) -> DataFrame:
        """The model as a source of global bounds: over Parquet, if ``footer_bounds`` is set, a scan that answers from the
        file footers.  Spark raises there if some file has only nulls in the column, so it is off unless asked for.
        """
        if not self.footer_bounds:
            return self[name]
        if name in self._footers:
            return self._footers[name]
        stage, raw = RAW_STAGES.get(name, (None, ""))
        footers = getattr(self.raw, "footers", None) or {}
        return stage(footers[raw]) if raw in footers and name not in self._written else self[name]

    @property
    def visit_rollup(self) -> DataFrame:
        """Claims per (group, plan, month), from which all four AWV summaries are rolled up.

        In a build it is stored once the claim fact is written: one claims scan for all of them.
        """
        claims = self["fct_awv_claim"]
        if not self._rollup or self._rollup[0] is not claims:
            rollup = AW.visit_rollup(claims)
            if "fct_awv_claim" in self._written:
                by_group = self.buckets and Buckets(self.buckets, ("medical_group_id",), ("plan_id", "date_month"))
                rollup = store_bucketed(rollup, by_group) if by_group else store(rollup)
            self._rollup = claims, rollup
        return self._rollup[1]

    # -- data quality ------------------------------------------------------
    def data_tests(self, test_types=TEST_TYPES, tests=DECLARED_TESTS) -> DataFrame:
        """The declared tests as one DataFrame (one row per test).

        After ``materialize`` / ``attach`` the tests read the written tables, as
        the reference's tests read its stored models; the row-level ones were
        counted while the tables were written and read nothing.  Otherwise the
        models that many branches read (``TESTED_OFTEN``) are stored once,
        columnar, and counted as they are written; the rest are built lazily from
        them; over Parquet or ORC input the staging tables are not copied, each
        branch scans the columns it needs.
        """
        wanted = set(test_types)
        tests = [t for t in tests if t.test in wanted]
        read = {n for t in tests for n in (t.model, t.to) if n}
        view = self._test_view(read, tests)
        known = {t.name: n for t in tests for condition, n in [view._noted.get(t.model, {}).get(t.name, (None, 0))]
                 if condition == t.condition}
        uniques = [t for t in tests if t.test == "unique"]
        candidates = None
        if uniques:
            candidates = store(Q.unique_candidates([(t.name, view[t.model], unique_parts(t)) for t in uniques]))
            repeated = {r["name"] for r in candidates.select("name").distinct().collect()}     # at most one row a test
            known |= {t.name: 0 for t in uniques if t.name not in repeated}
        return run_suite(view.__getitem__, tests, test_types, known, candidates)

    def _test_view(self, read: set[str], tests: list[DataTest]) -> "KpiWarehouse":
        """A copy of this object in which the models that the tests in question read often are stored."""
        view = KpiWarehouse(self.raw, self.params)
        for name in MODEL_NAMES:
            if name in self._written:
                view._models[name] = self._models[name]
                view._written.add(name)
        columnar = getattr(self.raw, "columnar", False)
        for name in TESTED_OFTEN:
            if name in read and name not in self._written and not (columnar and name.startswith("stg_")):
                if name not in self._stored:
                    observed, failures = self._observed(name, view[name], tests)
                    self._stored[name] = store(observed)
                    self._noted[name] = failures()
                view._models[name] = self._stored[name]
        view._noted = {n: c for n, c in self._noted.items() if n in view._models}
        return view

    def _observed(self, name: str, df: DataFrame, tests: list[DataTest] = DECLARED_TESTS):
        """``df`` with its row-level tests observed, and what gives {test: [condition, failures]} once it is written."""
        own = {t.name: t for t in tests if t.model == name and t.test in ROW_TYPES}
        observed, failures = Q.observe_failures(df, *row_checks(own.values()))
        return observed, lambda: {n: [own[n].condition, c] for n, c in failures().items()}

    def failing_rows(self, test_name: str, tests=DECLARED_TESTS) -> DataFrame:
        """The rows that fail the named test, as a lazy DataFrame."""
        chosen = [t for t in tests if t.name == test_name]
        if len(chosen) != 1:
            raise KeyError(f"no single test is named {test_name!r}")
        return failing_rows(self.__getitem__, chosen[0])

    def orphan_plans_in_claims(self) -> DataFrame:
        return Q.orphan_plans_in_claims(self["stg_claims_awv"], self["stg_plan_medical_group"])

    def orphan_plans_in_dimension(self) -> DataFrame:
        return Q.orphan_plans_in_dimension(self["stg_plan_medical_group"], self["stg_claims_awv"])

    # -- table sink ----------------------------------------------------------
    def attach(self, out_dir: str, fmt: str = "parquet") -> list[str]:
        """Read already-written models from ``out_dir`` instead of rebuilding them.

        A model without a folder is not written; a folder that cannot be read raises.
        """
        spark = self.raw.claims.sparkSession
        found = []
        for name in MODEL_NAMES:
            if name in EPHEMERAL:
                continue
            path = os.path.join(out_dir, name)
            if path_exists(spark, path):
                self._use_written(name, read_table(spark, path, fmt), current_notes(spark, path).get("failures", {}))
                self._know_bounds(name, path, fmt)
                found.append(name)
        return found

    def _use_written(self, name: str, df: DataFrame, noted: dict[str, list]) -> None:
        """From now on ``name`` is the written table; models built lazily before read older ones and are dropped."""
        self._noted = {n: c for n, c in self._noted.items() if n in self._written} | {name: noted}
        self._models = {n: m for n, m in self._models.items() if n in self._written}
        self._stored.clear()
        self._models[name] = df
        self._written.add(name)

    def _know_bounds(self, name: str, path: str, fmt: str) -> None:
        if fmt == "parquet" and self.footer_bounds:
            df = self._models[name]
            self._footers[name] = footer_scan(df.sparkSession, current_path(df.sparkSession, path), df.schema)

    def materialize(self, out_dir: str, fmt: str = "parquet", models: list[str] | None = None,
                    partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
        """Write every non-ephemeral model (in dependency order) under ``out_dir``.

        Returns {model: path}.  Each model is built from its upstream models,
        never from its own stored table, and written as a new version of its table
        (``sources.sink``): a failed or killed write leaves the old version current.
        Its row-level tests are counted on the way and noted with the version.
        After a model is written, later models read the written table instead
        of recomputing it.  ``partition_by`` names partition columns by model.
        """
        spark = self.raw.claims.sparkSession
        wanted = set(models or MODEL_NAMES)
        written: dict[str, str] = {}
        for name in MODEL_NAMES:
            if name in EPHEMERAL or name not in wanted:
                continue
            path = os.path.join(out_dir, name)
            t0 = time.perf_counter()
            observed, failures = self._observed(name, BUILDERS[name](self))
            columns, buckets = (partition_by or {}).get(name), None
            if self.buckets and fmt == "parquet" and name in BUCKETED and not columns:
                by, dealt = BUCKETED[name]
                buckets = Buckets(self.buckets, by, ("date_day",), dealt)
            replace_table(observed, path, fmt, columns, notes=lambda f=failures: {"failures": f()}, buckets=buckets)
            self.build_seconds[name] = round(time.perf_counter() - t0, 3)
            self._use_written(name, read_table(spark, path, fmt), failures())
            self._know_bounds(name, path, fmt)
            written[name] = path
        return written
