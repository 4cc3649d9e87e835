"""Sources and sinks: CSV round trip of the raw tables, table materialization."""

import os
import tempfile

from kpiloom import KpiWarehouse, read_raw_dir
from kpiloom.sources.raw import RawTables, write_raw_dir


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_round_trip(spark, tpch_wh):
    out = tempfile.mkdtemp(prefix="kpiloom-raw-")
    write_raw_dir(tpch_wh.raw, out, "csv")
    raw = read_raw_dir(spark, out, "csv")
    wh = KpiWarehouse(raw)
    for m in ("rpt_medical_group_performance_monthly", "rpt_medical_group_plan_performance_annual"):
        assert _same(wh[m], tpch_wh[m])


def test_materialize_writes_tables(spark):
    from conftest import SF_SMALL
    from kpiloom.plans.models import EPHEMERAL, MODEL_NAMES
    wh = KpiWarehouse.from_tpch(spark, SF_SMALL)
    lazy = KpiWarehouse.from_tpch(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="kpiloom-wh-")
    written = wh.materialize(out)
    assert set(written) == set(MODEL_NAMES) - EPHEMERAL
    assert all(os.path.isdir(p) for p in written.values())
    for m in MODEL_NAMES:                      # every model, written or inlined, equals the lazy build
        assert _same(wh[m], lazy[m]), m
    suite = {r["test_name"]: r["failures"] for r in wh.data_tests().collect()}
    assert suite == {r["test_name"]: r["failures"] for r in lazy.data_tests().collect()}


def test_other_raw_formats_round_trip(spark, tpch_wh):
    for fmt in ("parquet", "json", "orc"):
        out = tempfile.mkdtemp(prefix=f"kpiloom-raw-{fmt}-")
        write_raw_dir(tpch_wh.raw, out, fmt)
        wh = KpiWarehouse(read_raw_dir(spark, out, fmt))
        assert _same(wh["fct_awv_action"], tpch_wh["fct_awv_action"]), fmt
        assert _same(wh["stg_claims_awv"], tpch_wh["stg_claims_awv"]), fmt


def test_attach_reads_written_tables(spark):
    from conftest import SF_SMALL
    out = tempfile.mkdtemp(prefix="kpiloom-wh-")
    KpiWarehouse.from_tpch(spark, SF_SMALL).materialize(out, models=["stg_plan_medical_group", "dim_plan"])
    wh = KpiWarehouse.from_tpch(spark, SF_SMALL)
    assert wh.attach(out) == ["stg_plan_medical_group", "dim_plan"]
    assert wh["dim_plan"].count() == 5


CLAIMS = {
    "a.csv": ["2024-01-02,10,1,1", ",10,2,1"],
    "b.csv": ["2024-01-03,10,3,2", "not a date,10,4,1", "2024-01-04,ten,5,1", "2024-01-05,10,6", "2024-01-06,11,7,1"],
    "c.csv": ["2024-01-07,10,8,1", "2024-01-08,10,9,1,extra"],
}


def _csv_folder(tmp_path, bad=True):
    tables = {"plan_medical_group": ("plan_id,medical_group_id,plan_name,medical_group_name", ["1,10,A,G", "2,11,B,H"]),
              "actions_available": ("plan_id,medical_group_id,date_day,count_actions_available", ["1,10,2024-01-01,5"]),
              "actions_attested": ("plan_id,medical_group_id,date_day,count_actions_attested_as_complete", ["1,10,2024-01-01,1"])}
    for name, (head, rows) in tables.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([head, *rows]) + "\n")
    (tmp_path / "claims").mkdir()
    for name, rows in CLAIMS.items():
        rows = rows if bad else [r for r in rows if r.count(",") == 3 and "not" not in r and "ten" not in r]
        (tmp_path / "claims" / name).write_text("\n".join(["awv_date_of_service,medical_group_id,patient_id,plan_id", *rows]) + "\n")
    return str(tmp_path)


def test_malformed_rows_fail_by_default(spark, tmp_path):
    import pytest
    raw = read_raw_dir(spark, _csv_folder(tmp_path))
    assert raw.rejected is None
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        raw.claims.collect()


def test_malformed_rows_are_kept_apart_with_counts(spark, tmp_path):
    """Bad rows in two of three files; each row is on the same side whatever columns are read."""
    from kpiloom.sources.raw import rejected_counts
    raw = read_raw_dir(spark, _csv_folder(tmp_path), bad_rows="apart")
    assert sorted(r.patient_id for r in raw.claims.collect()) == [1, 2, 3, 7, 8]
    assert sorted(r.patient_id for r in raw.claims.select("patient_id").collect()) == [1, 2, 3, 7, 8]
    assert raw.claims.count() == 5 and raw.claims.select("plan_id").where("plan_id = 1").count() == 4
    bad = raw.rejected.collect()
    assert sorted(r.record for r in bad) == sorted(["not a date,10,4,1", "2024-01-04,ten,5,1", "2024-01-05,10,6", "2024-01-08,10,9,1,extra"])
    counts = {(r.table, os.path.basename(r.file)): r.rows for r in rejected_counts(raw.rejected).collect()}
    assert counts == {("claims", "b.csv"): 3, ("claims", "c.csv"): 1}


def test_models_over_split_rows_equal_those_over_clean_files(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "clean").mkdir()
    split = KpiWarehouse(read_raw_dir(spark, _csv_folder(tmp_path / "bad"), bad_rows="apart"))
    clean = KpiWarehouse(read_raw_dir(spark, _csv_folder(tmp_path / "clean", bad=False)))
    for m in ("fct_awv_claim", "int_medical_group_awv_summary_monthly", "dim_date_spine_day"):
        assert _same(split[m], clean[m]), m


def test_malformed_json_rows_are_kept_apart(spark, tmp_path):
    from kpiloom.sources.raw import read_raw_split
    (tmp_path / "x.json").write_text('{"plan_id": 1, "medical_group_id": 10}\n{"plan_id": "one"\n{"plan_id": "two", "medical_group_id": 3}\n')
    good, bad = read_raw_split(spark, str(tmp_path), "plan_medical_group", "json")
    assert [r.plan_id for r in good.collect()] == [1] and bad.count() == 2


def test_spine_bounds_come_from_parquet_footers(spark, tpch_wh):
    """Over raw Parquet and over written tables: least and greatest dates are pushed into all three scans."""
    from kpiloom.plans.models import BUILDERS
    folder, out = (tempfile.mkdtemp(prefix=f"kpiloom-{x}-") for x in ("raw", "wh"))
    write_raw_dir(RawTables(*(t.coalesce(1) for t in tpch_wh.raw.tables())), folder, "parquet")
    wh = KpiWarehouse(read_raw_dir(spark, folder, "parquet", footers=True), footer_bounds=True)
    lazy = wh["dim_date_spine_day"]
    assert _same(lazy, tpch_wh["dim_date_spine_day"])
    wh.materialize(out, models=["stg_actions_available", "stg_actions_attested_as_complete", "stg_claims_awv", "dim_date_spine_day"])
    for spine in (lazy, BUILDERS["dim_date_spine_day"](wh)):
        text = spine._jdf.queryExecution().executedPlan().toString()
        assert text.count("PushedAggregation: [MIN(") == 3, text
    monthly = BUILDERS["rpt_medical_group_performance_monthly"](wh)
    optimized = monthly._jdf.queryExecution().optimizedPlan().toString()
    assert "MIN(date_month)" in optimized or "min(date_month)" in optimized
    assert _same(monthly, tpch_wh["rpt_medical_group_performance_monthly"])
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")      # other reads are as before
