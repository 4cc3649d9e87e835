
import datetime as dt

from pyspark.sql import functions as F

from kpiloom import functions as K
from kpiloom.params import KpiParams


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_calendar(spark):
    d = F.lit(dt.date(2024, 12, 30))            # a Monday in ISO week 1 of 2025
    r = one(spark, K.iso_day_of_week(d), K.iso_week(d), K.weekend_int(d), K.weekend_flag(d),
            K.month_start(d), K.year_start(d))
    assert tuple(r) == (1, 1, 0, False, dt.date(2024, 12, 1), dt.date(2024, 1, 1))
    sat, sun, null = F.lit(dt.date(2024, 1, 6)), F.lit(dt.date(2024, 1, 7)), F.lit(None).cast("date")
    assert tuple(one(spark, K.weekend_flag(sat), K.weekend_flag(sun), K.weekend_flag(null))) == (True, True, False)
    assert tuple(one(spark, K.iso_day_of_week(sun), K.weekend_int(sat))) == (7, 1)


def test_rates_and_guards(spark):
    r = one(spark, K.safe_rate(F.lit(1), F.lit(3)), K.safe_rate(F.lit(5), F.lit(0)),
            K.safe_rate(F.lit(1), F.lit(3), scale=6),
            K.non_negative(F.lit(-4)), K.non_negative(F.lit(None).cast("long")), K.non_negative(F.lit(7)))
    assert tuple(r) == (1 / 3, 0.0, 0.333333, 0, None, 7)


def test_target_gap_is_exact_decimal(spark):
    # ceil(190 * 0.70) = 133: computed in decimal, as the SQL literal 0.70 is a decimal
    r = one(spark, K.target_gap(F.lit(190), F.lit(100)), K.target_gap(F.lit(10), F.lit(9)),
            K.shortfall(F.lit(10), F.lit(12)))
    assert tuple(r) == (33, 0, 0)


def test_tiers(spark):
    p = KpiParams()
    r = one(spark, K.aac_status(F.lit(0.04), p), K.aac_status(F.lit(0.0399), p), K.aac_status(F.lit(0.01), p),
            K.loss_status(F.lit(0.10), p), K.loss_status(F.lit(0.2), p), K.loss_status(F.lit(0.21), p),
            K.awv_status(F.lit(10), F.lit(7), p), K.awv_status(F.lit(10), F.lit(6), p),
            K.awv_status(F.lit(0), F.lit(0), p))
    assert tuple(r) == ("Meeting Target", "Below Target", "Significantly Below Target",
                        "Low Loss", "Moderate Loss", "High Loss", "Good", "Needs Improvement", "Missing Data")
