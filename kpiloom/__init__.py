"""kpiloom: a Spark-native star schema and KPI reporting library.

Raw reference, claims and daily action-inventory tables become staging
tables, a date spine, dimensions, two facts, daily inventory decompositions,
monthly/annual KPI summaries and (entity x period) reports, with declarative
data-quality checks over every layer.  Everything is DataFrame API.
"""

from kpiloom.params import KpiParams
from kpiloom.plans.models import MODEL_NAMES, KpiWarehouse
from kpiloom.sources.raw import RawTables, read_raw, read_raw_dir

__all__ = ["KpiParams", "KpiWarehouse", "MODEL_NAMES", "RawTables", "read_raw", "read_raw_dir"]
