"""Plans: the model graph, the table sink and the data-test suite."""

from kpiloom.plans.models import BUILDERS, EPHEMERAL, MODEL_NAMES, KpiWarehouse
from kpiloom.plans.quality_suite import DECLARED_TESTS, DataTest, run_suite

__all__ = ["BUILDERS", "EPHEMERAL", "MODEL_NAMES", "KpiWarehouse", "DECLARED_TESTS", "DataTest",
           "run_suite"]
