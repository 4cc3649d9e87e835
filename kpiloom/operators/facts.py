"""Facts (#10-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.copies import count_copies, lay_out

ACTION_KEYS = ["date_day", "medical_group_id", "plan_id"]
JOIN_ORDER = ["medical_group_id", "plan_id", "date_day"]        # as the daily tables are written: sorted runs sort faster


def action_fact(available: DataFrame, attested: DataFrame) -> DataFrame:
    """#10: full outer join of the two daily snapshots; keys coalesced, counts 0-filled.

    The attested snapshot has no uniqueness test, so its copies are counted
    first and laid out after the join: a key with many copies reaches the full
    outer join (which AQE cannot split) as one row.  Null keys never match and
    survive as separate rows, as in the warehouse.
    """
    a = available.select(*ACTION_KEYS, "count_actions_available").withColumn("__available", F.lit(True))
    c = count_copies(attested.select(*[F.col(k).alias(f"__{k}") for k in ACTION_KEYS], "count_actions_attested_as_complete"), "__n")
    same = [a[k] == c[f"__{k}"] for k in JOIN_ORDER]
    joined = a.join(c, same[0] & same[1] & same[2], "full_outer").select(
        *[F.when(F.col("__available"), a[k]).otherwise(F.col(f"__{k}")).alias(k) for k in ACTION_KEYS],
        "count_actions_available", "count_actions_attested_as_complete", F.coalesce("__n", F.lit(1)).alias("__n"))
    rows = lay_out(joined, "__n", "__copy")
    return rows.select(
        *ACTION_KEYS,
        F.coalesce(F.col("count_actions_available"), F.lit(0)).cast("long").alias("count_actions_available"),
        F.coalesce(F.col("count_actions_attested_as_complete"), F.lit(0)).cast("long")
        .alias("count_actions_attested_as_complete"),
    )


def claim_fact(claims: DataFrame) -> DataFrame:
    """#11: one row per claim; ``had_visit`` is 1 when the visit is dated. No shuffle."""
    return claims.select(
        F.col("awv_date_of_service").alias("date_day"),
        "medical_group_id",
        "plan_id",
        "patient_id",
        F.when(F.col("awv_date_of_service").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("had_visit"),
    )
