"""The failing-rows operators return the rows the reference's generic tests return."""

import datetime as dt

from pyspark.sql import functions as F

from kpiloom.operators import quality as Q


def test_failing_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (2, None, -1), (2, "c", None), (None, "d", 3), (7, "e", 12)],
        "k long, name string, v long")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    assert Q.not_null_failures(df, "name").count() == 1
    dup = Q.unique_failures(df, "k").collect()
    assert [(r["unique_field"], r["n_records"]) for r in dup] == [(2, 2)]          # null ignored
    assert sorted(r["k"] for r in Q.relationship_failures(df, "k", parent, "k").collect()) == [7]
    bad = Q.accepted_values_failures(df, "v", [5, 3, -1]).collect()
    assert sorted(r["value_field"] for r in bad) == [12]                             # null is not offending
    assert sorted(r["v"] for r in Q.accepted_range_failures(df, "v", 0, 10).collect()) == [-1, 12]
    assert Q.accepted_range_failures(df, "v", 0, 10, inclusive=False).count() == 2
    assert Q.accepted_range_failures(df, "v", min_value=0).count() == 1


def test_batched_and_observed_counts(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 40), (3, 40), (9, 7)], "k long, v long")
    rows = [("nn", F.col("v").isNull()), ("range", ~Q.range_condition("v", 0, 10))]
    values = [("one", "v", [5, 7]), ("none", "k", [1, 2, 3, 9]), ("two", "k", [1, 2])]
    counted = {r["name"]: r["failures"] for r in Q.batched_failures(df, rows, values).collect()}
    assert counted == {"nn": 1, "range": 2, "one": 1, "none": 0, "two": 2}
    observed, failures = Q.observe_failures(df, rows, values)
    assert observed.count() == 5
    assert failures() == {"nn": 1, "range": 2, "one": 1, "none": 0}       # several offending values need a scan
    empty, failures = Q.observe_failures(df.limit(0), rows, values)
    assert empty.count() == 0 and set(failures().values()) == {0}


def test_relationships_through_bitmaps(spark):
    """Whole numbers of either sign, dates and strings against a plain set; nulls pass; repeated parents do not fan out."""
    import random
    r = random.Random(3)
    numbers = [-(1 << 40), -40_000, -32_769, -32_768, -32_767, -1, 0, 1, 8, 32_767, 32_768, 32_769, 65_536, 1 << 40, *range(2, 60, 3)]
    days = [dt.date(1969, 12, 30) + dt.timedelta(days=k) for k in range(40)]
    parents = [(r.choice(numbers), r.choice(days), str(r.choice(numbers))) for _ in range(25)] + [(None, None, None)]
    children = [(r.choice([*numbers, None]), r.choice([*days, None]), r.choice([*map(str, numbers), None])) for _ in range(300)]
    parent = spark.createDataFrame(parents, "k long, d date, s string")
    child = spark.createDataFrame(children, "a long, b date, c string")
    small = spark.createDataFrame([(p[0],) for p in parents if p[0] is not None and -100 <= p[0] <= 100], "k int")
    got = {x["name"]: x["failures"] for x in Q.relationship_counts(
        child, [("k", "a", parent, "k"), ("d", "b", parent, "d"), ("s", "c", parent, "s"), ("int", "a", small, "k")]).collect()}
    for i, name in enumerate("kds"):
        have = {p[i] for p in parents}
        assert got[name] == sum(x[i] is not None and x[i] not in have for x in children) > 0
    have = {p[0] for p in parents if p[0] is not None and -100 <= p[0] <= 100}
    assert got["int"] == sum(x[0] is not None and x[0] not in have for x in children)
    none = {x["name"]: x["failures"] for x in Q.relationship_counts(child, [("k", "a", parent.limit(0), "k")]).collect()}
    assert none == {"k": sum(x[0] is not None for x in children)}
    assert Q.relationship_counts(child.limit(0), [("k", "a", parent, "k")]).collect()[0]["failures"] == 0


def test_child_rows_are_not_shuffled(spark):
    """What leaves the child's tasks is counted (check, key) pairs, however many rows a key has."""
    child = spark.range(200_000).selectExpr("id % 7 as a")
    plan = Q.relationship_counts(child, [("r", "a", spark.range(5).toDF("k"), "k")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in text and "partial_count" in text
    assert {r["failures"] for r in plan.collect()} == {sum(x % 7 >= 5 for x in range(200_000))}
    assert "Range" in text.split("partial_count")[1]


def test_orphans_include_null_claims_only(spark):
    pmg = spark.createDataFrame([(1,), (6,), (6,), (None,)], "plan_id long")
    claims = spark.createDataFrame([(1,), (5,), (5,), (None,), (-3,)], "plan_id long")
    assert sorted(str(r[0]) for r in Q.orphan_plans_in_claims(claims, pmg).collect()) == ["-3", "5", "None"]
    assert sorted(str(r[0]) for r in Q.orphan_plans_in_dimension(pmg, claims).collect()) == ["6", "None"]


def test_unique_candidates_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, None), (2, None), (3, "z")], "a long, b string")
    key = Q.concat_key("a", "b")
    found = Q.unique_candidates([("ab", df, key), ("a", df, F.col("a")), ("c", df.distinct(), key)])
    assert {r["name"] for r in found.collect()} == {"ab", "a"}
    assert [tuple(r) for r in Q.repeated_keys(df, key, found.where("name = 'ab'")).collect()] == [("1-x", 2)]
    assert sorted(tuple(r) for r in Q.repeated_keys(df, F.col("a"), found.where("name = 'a'")).collect()) == [(1, 3), (2, 2)]


def test_whole_number_keys_are_hashed_without_their_text(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(day, 1, -2), (day, 1, -2), (day, 12, 3), (day, None, 3),
                                (day, None, 3)], "d date, a long, b long")
    found = Q.unique_candidates([("k", df, ("d", "a", "b"))])
    assert "concat" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["name"] for r in found.collect()] == ["k"]
    assert [tuple(r) for r in Q.repeated_keys(df, ("d", "a", "b"), found).collect()] == [("2024-01-01-1--2", 2)]
    text = spark.createDataFrame([("1-2", "3"), ("1", "2-3")], "a string, b string")       # one joined text, two tuples
    same = Q.unique_candidates([("t", text, ("a", "b"))])
    assert [tuple(r) for r in Q.repeated_keys(text, ("a", "b"), same).collect()] == [("1-2-3", 2)]


def test_concat_key_is_null_safe_like_sql(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a long, b string")
    vals = [r[0] for r in df.select(Q.concat_key("a", "b")).orderBy("a").collect()]
    assert vals == ["1-x", None]
