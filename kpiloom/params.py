"""Business parameters of the KPI models.

Every threshold, label and date below is a fixed value that must equal the
reference's for right results; they are parameters (with these defaults) so a
caller can report another year or target without touching the operators.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import Decimal

# --- fixed values (must equal the reference) -------------------------------
AAC_MEETING_TARGET = Decimal("0.04")
AAC_BELOW_TARGET = Decimal("0.02")
LOSS_LOW = Decimal("0.10")
LOSS_MODERATE = Decimal("0.20")
AWV_TARGET = Decimal("0.70")
UNDATED_CLAIM_DATE = _dt.date(2024, 12, 31)
REPORT_YEAR = 2024

LABEL_MEETING_TARGET = "Meeting Target"
LABEL_BELOW_TARGET = "Below Target"
LABEL_SIGNIFICANTLY_BELOW = "Significantly Below Target"
LABEL_LOW_LOSS = "Low Loss"
LABEL_MODERATE_LOSS = "Moderate Loss"
LABEL_HIGH_LOSS = "High Loss"
LABEL_GOOD = "Good"
LABEL_NEEDS_IMPROVEMENT = "Needs Improvement"
LABEL_MISSING_DATA = "Missing Data"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class KpiParams:
    """Tunable KPI thresholds; defaults reproduce the reference exactly."""

    aac_meeting_target: Decimal = AAC_MEETING_TARGET
    aac_below_target: Decimal = AAC_BELOW_TARGET
    loss_low: Decimal = LOSS_LOW
    loss_moderate: Decimal = LOSS_MODERATE
    awv_target: Decimal = AWV_TARGET
    undated_claim_date: _dt.date = UNDATED_CLAIM_DATE
    report_year: int = REPORT_YEAR
    # None keeps rates as doubles; an int rounds them (the warehouse rounds
    # integer division to 6 places).
    rate_scale: int | None = None
