"""The table sink keeps what it replaces until the new table is complete."""

import os
import shutil

import pytest
from conftest import D

from kpiloom.plans.models import EPHEMERAL, MODEL_NAMES
from kpiloom.sources import sink
from kpiloom.sources.sink import commits, current_path, path_exists, read_table, remove_leftovers, replace_table

DAY = D("2024-01-01")
STORED = [m for m in MODEL_NAMES if m not in EPHEMERAL]


@pytest.fixture
def wh(make_wh):
    return make_wh(available=[(1, 10, DAY, 9), (2, 10, D("2024-02-03"), 4)], attested=[(1, 10, DAY, 1)], claims=[(DAY, 10, 1, 1), (None, 10, 2, 2)])


def content(spark, out):
    return {m: sorted(map(str, read_table(spark, os.path.join(out, m)).collect())) for m in STORED}


def test_materialize_twice_and_after_attach(spark, wh, make_wh, tmp_path):
    out = str(tmp_path)
    wh.materialize(out)
    first = content(spark, out)
    wh.materialize(out)
    assert content(spark, out) == first
    other = make_wh()
    assert other.attach(out) == STORED
    other.materialize(out, models=["dim_plan"])
    other.materialize(out, models=["fct_awv_action", "rpt_medical_group_performance_monthly"])
    assert content(spark, out) == first
    assert sorted(os.listdir(out)) == sorted(STORED)             # nothing is left beside the tables


def versions(path):
    return sorted(f for f in os.listdir(path) if f.startswith("data-"))


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3).toDF("id"), path)
    with pytest.raises(Exception):
        replace_table(spark.range(3).selectExpr("assert_true(id < 2) AS x"), path)
    assert read_table(spark, path).count() == 3
    assert os.listdir(tmp_path) == ["t"] and len(versions(path)) == 1


@pytest.mark.parametrize("killed", ["in the data", "before the commit", "in the commit"])
def test_a_killed_write_leaves_the_old_table(spark, tmp_path, monkeypatch, killed):
    """The process ends without any cleaning up, at each step of a write."""
    path = str(tmp_path / "t")
    replace_table(spark.range(3).toDF("id"), path, notes=lambda: {"n": 3})

    class Killed(BaseException):
        pass

    if killed == "in the data":
        def dies(df, to, *a):
            df.limit(1).write.parquet(f"{to}/_temporary/0")
            raise Killed
        monkeypatch.setattr(sink, "write_table", dies)
    elif killed == "before the commit":
        monkeypatch.setattr(sink, "_commit", lambda *a: (_ for _ in ()).throw(Killed()))
    else:
        line = sink._line
        monkeypatch.setattr(sink, "_line", lambda c: line(c)[:-20])
    if killed == "in the commit":
        replace_table(spark.range(9).toDF("id"), path)
    else:
        with pytest.raises(Killed):
            replace_table(spark.range(9).toDF("id"), path)
    monkeypatch.undo()
    assert read_table(spark, path).count() == 3 and sink.current_notes(spark, path) == {"n": 3}
    replace_table(spark.range(5).toDF("id"), path)                      # the next write goes on after it
    assert read_table(spark, path).count() == 5
    assert len(versions(path)) == 3
    assert remove_leftovers(spark, path) == []                          # too young: could be a running write
    assert len(remove_leftovers(spark, path, older_than_seconds=0)) == 1
    assert len(versions(path)) == 2 and read_table(spark, path).count() == 5


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3).toDF("id"), path)
    old = read_table(spark, path)
    replace_table(spark.range(7).toDF("id"), path)
    assert old.count() == 3 and read_table(spark, path).count() == 7
    own = read_table(spark, path)
    replace_table(own.unionByName(own), path)                           # a table may be made from itself
    assert read_table(spark, path).count() == 14
    assert len(versions(path)) == 2 and [n for n, _ in commits(spark, path)] == [3, 2]


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    """Both take the same number: the second fails and the first one's table stands."""
    path = str(tmp_path / "t")
    replace_table(spark.range(3).toDF("id"), path)
    write = sink.write_table

    def overtaken(df, to, *a):
        write(df, to, *a)
        monkeypatch.setattr(sink, "write_table", write)
        replace_table(spark.range(4).toDF("id"), path)
    monkeypatch.setattr(sink, "write_table", overtaken)
    with pytest.raises(Exception, match="exist"):
        replace_table(spark.range(5).toDF("id"), path)
    assert read_table(spark, path).count() == 4
    assert len(versions(path)) == 2


def test_nothing_is_renamed_by_the_sink():
    assert "rename" not in open(sink.__file__).read().replace("renamed", "")


def test_tests_after_a_build_read_no_table_again(spark, wh, make_wh, tmp_path):
    """Row-level tests were counted while the tables were written: by this object, and as noted for the next."""
    kinds = ["not_null", "accepted_range", "accepted_values"]
    want = sorted(map(tuple, make_wh(available=[(1, 10, DAY, 9), (2, 10, D("2024-02-03"), 4)], attested=[(1, 10, DAY, 1)],
                                     claims=[(DAY, 10, 1, 1), (None, 10, 2, 2)]).data_tests(kinds).collect()))
    wh.materialize(str(tmp_path))
    other = make_wh()
    other.attach(str(tmp_path))
    for w in (wh, other):
        df = w.data_tests(kinds)
        assert sorted(map(tuple, df.collect())) == want
        assert "Scan" not in df._jdf.queryExecution().executedPlan().toString()
    assert len(want) == 70
    assert sorted(map(tuple, wh.data_tests().collect())) == sorted(map(tuple, other.data_tests().collect()))


def test_attach_raises_on_an_unreadable_table(spark, wh, make_wh, tmp_path):
    out = str(tmp_path)
    wh.materialize(out, models=["dim_plan", "dim_patient"])
    assert make_wh().attach(out) == ["dim_patient", "dim_plan"]
    shutil.rmtree(tmp_path / "dim_plan")
    os.mkdir(tmp_path / "dim_plan")
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        make_wh().attach(out)


def test_partitioned_output(spark, wh, tmp_path):
    wh.materialize(str(tmp_path), models=["fct_awv_claim"], partition_by={"fct_awv_claim": ["date_day"]})
    assert path_exists(spark, f"{current_path(spark, f'{tmp_path}/fct_awv_claim')}/date_day=2024-01-01")


def test_raw_folder_as_a_uri(spark, wh, tmp_path):
    from kpiloom.sources.raw import RAW_TABLES, read_raw_dir, write_raw_dir
    write_raw_dir(wh.raw, str(tmp_path / "raw"))
    os.mkdir(tmp_path / "flat")
    for t in RAW_TABLES:
        part = max((f for f in os.listdir(tmp_path / "raw" / t) if f.startswith("part-")),
                   key=lambda f: os.path.getsize(tmp_path / "raw" / t / f))
        shutil.copy(tmp_path / "raw" / t / part, tmp_path / "flat" / f"{t}.csv")
    for folder in (f"file://{tmp_path}/flat", f"file:{tmp_path}/raw", str(tmp_path / "flat")):
        raw = read_raw_dir(spark, folder)
        assert all(df.count() >= 1 for df in raw.tables())


def test_checkpoint_folder_on_a_cluster_must_be_named(monkeypatch):
    from kpiloom import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_cluster_conf_sizes_the_shuffle():
    from kpiloom.session import cluster_conf
    conf = cluster_conf(1000, 4)
    assert conf["spark.sql.shuffle.partitions"] == "16000"


MONTHLY = ["int_medical_group_action_summary_monthly", "int_medical_group_plan_action_summary_monthly",
           "int_medical_group_awv_summary_monthly", "int_medical_group_plan_awv_summary_monthly"]


def hash_exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")


def test_windows_over_bucketed_tables_need_no_exchange(spark, tpch_wh, tmp_path):
    from kpiloom.plans.models import BUILDERS, KpiWarehouse
    plain, bucketed = str(tmp_path / "plain"), str(tmp_path / "it's bucketed")
    tpch_wh_plain = KpiWarehouse(tpch_wh.raw, tpch_wh.params)
    tpch_wh_plain.materialize(plain)
    wh = KpiWarehouse(tpch_wh.raw, tpch_wh.params, buckets=4)
    wh.materialize(bucketed)
    assert content(spark, bucketed) == content(spark, plain)
    daily = os.path.join(bucketed, "int_medical_group_action_decomposition_daily")
    files = [f for f in os.listdir(current_path(spark, daily)) if f.endswith(".parquet")]
    assert 1 < len(files) <= 4                                    # one file a bucket
    for name in MONTHLY:
        assert hash_exchanges(BUILDERS[name](tpch_wh_plain)) > 0
        rebuilt = BUILDERS[name](wh)
        assert hash_exchanges(rebuilt) == 0, name
        assert sorted(map(str, rebuilt.collect())) == sorted(map(str, BUILDERS[name](tpch_wh_plain).collect()))
    old = current_path(spark, daily)
    other = KpiWarehouse(tpch_wh.raw, tpch_wh.params, buckets=4)     # of another session: only the commits are known
    for t in spark.catalog.listTables():
        if t.name.startswith("kpiloom_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert path_exists(spark, old)                               # the catalog's entries own no data
    assert other.attach(bucketed) == STORED
    for name in MONTHLY:
        assert hash_exchanges(BUILDERS[name](other)) == 0, name
    assert [str(r) for r in other.data_tests().orderBy("test_name").collect()] == [str(r) for r in wh.data_tests().orderBy("test_name").collect()]


def test_bucketed_versions_are_replaced_and_removed(spark, tmp_path):
    path, cut = str(tmp_path / "t"), sink.Buckets(3, ("k",), ("id",))
    for n in (5, 50, 0, 7):
        replace_table(spark.range(n).selectExpr("id", "id % 4 AS k", "date'2024-01-01' AS `a day`"), path, buckets=cut)
        assert read_table(spark, path).count() == n
        assert hash_exchanges(read_table(spark, path).groupBy("k").count()) == 0
    assert len(versions(path)) == sink.KEEP
    with pytest.raises(Exception):
        replace_table(spark.range(3).selectExpr("assert_true(id < 2) AS x", "id AS k", "id"), path, buckets=cut)
    assert read_table(spark, path).count() == 7 and len(versions(path)) == sink.KEEP
    replace_table(spark.range(2).toDF("id"), path)               # a plain version after bucketed ones
    assert read_table(spark, path).count() == 2
    with pytest.raises(ValueError):
        replace_table(spark.range(2).toDF("id"), path, fmt="csv", buckets=cut)
