"""The derived raw tables reproduce FIXTURES.md §3 at sf0.001."""

from pyspark.sql import functions as F


def test_fixture_counts(tpch_wh):
    raw = tpch_wh.raw
    assert raw.plan_medical_group.count() == 28
    assert raw.claims.count() == 830
    assert raw.claims.filter(F.col("awv_date_of_service").isNull()).count() == 32
    assert raw.actions_available.count() == 3923
    assert raw.actions_available.agg(F.min("count_actions_available")).first()[0] == 0
    assert raw.actions_attested.count() == 1933
    assert raw.claims.filter(F.col("plan_id") == 5).count() == 157


def test_every_order_and_line_takes_part(spark, tpch_wh):
    from conftest import SF_SMALL
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert tpch_wh.raw.line_counts.agg(F.sum("n")).first()[0] == lines.count()
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    years = orders.select("o_custkey", F.year("o_orderdate")).distinct().count()
    assert tpch_wh.raw.claims.filter(F.col("awv_date_of_service").isNotNull()).count() == years


def test_action_tables_grow_with_the_data(spark, tpch_wh):
    from kpiloom import KpiWarehouse
    larger = KpiWarehouse.from_tpch(spark, "/root/testdata/sf0.01").raw
    assert larger.actions_available.count() == 35159
    assert larger.actions_attested.count() == 18774
    assert larger.plan_medical_group.count() == 57


def test_fixture_join_profile(tpch_wh):
    a = tpch_wh["stg_actions_available"].select("date_day", "medical_group_id", "plan_id").withColumn("a", F.lit(1))
    c = tpch_wh["stg_actions_attested_as_complete"].select("date_day", "medical_group_id", "plan_id") \
        .withColumn("c", F.lit(1))
    j = a.join(c, ["date_day", "medical_group_id", "plan_id"], "full_outer")
    assert j.filter(F.col("a").isNull()).count() == 1837
    assert j.filter(F.col("c").isNull()).count() == 3827
    assert j.filter(F.col("a").isNotNull() & F.col("c").isNotNull()).count() == 96


def test_group_day_balance_profile(tpch_wh):
    g = tpch_wh["int_medical_group_action_decomposition_daily"]
    assert g.filter("decomposition_balance_check").count() == 1982
    assert g.filter("not decomposition_balance_check").count() == 1573
    assert g.filter("daily_net_new_available_actions > 0").count() == 1531


def test_spine_covers_seven_years(tpch_wh):
    s = tpch_wh["dim_date_spine_day"]
    row = s.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert (str(row[0]), str(row[1]), row[2]) == ("2021-01-01", "2027-11-04", 2499)
    years = tpch_wh["int_medical_group_awv_summary_annual"].select("date_year").distinct().count()
    assert years == 7


def test_fixture_is_time_zone_independent(spark):
    from kpiloom.sources.tpch_fixture import claims, line_counts, load_tpch

    from conftest import SF_SMALL
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        tables = load_tpch(spark, SF_SMALL)
        assert line_counts(tables).filter(F.col("flag") == "R").count() == 1933
        c = claims(tables)
        assert c.count() == 830 and c.filter(F.col("awv_date_of_service").isNull()).count() == 32
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
