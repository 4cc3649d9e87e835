import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kpiloom.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tpch_wh(spark):
    from kpiloom import KpiWarehouse
    return KpiWarehouse.from_tpch(spark, SF_SMALL)


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@pytest.fixture
def make_wh(spark):
    """Build a warehouse over hand-made raw rows (tests only)."""
    from kpiloom import KpiWarehouse
    from kpiloom.params import KpiParams
    from kpiloom.sources.raw import RAW_SCHEMAS, RawTables

    default_pmg = [(1, 10, "  Plan A ", " Group X  "), (2, 10, "Plan B", "Group X")]

    def build(available=(), attested=(), claims=(), pmg=None, params=None):
        pmg = default_pmg if pmg is None else pmg
        raw = RawTables(
            plan_medical_group=spark.createDataFrame(list(pmg), RAW_SCHEMAS["plan_medical_group"]),
            claims=spark.createDataFrame(list(claims), RAW_SCHEMAS["claims"]),
            actions_available=spark.createDataFrame(list(available), RAW_SCHEMAS["actions_available"]),
            actions_attested=spark.createDataFrame(list(attested), RAW_SCHEMAS["actions_attested"]),
        )
        return KpiWarehouse(raw, params or KpiParams())
    return build
