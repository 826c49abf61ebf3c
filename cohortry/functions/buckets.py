"""Value bands and labels used as group keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tenure cohorts (lowest month, highest month, label).  The last
# label also takes tenures above 48, negative ones and NULL.
TENURE_BANDS = (
    (0, 12, "0–12 months"),
    (13, 24, "13–24 months"),
    (25, 48, "25–48 months"),
)
TENURE_REST = "48+ months"

# Discount bands (upper edge, label); the last label takes the
# rest, NULL included.  The report and the dashboard label them differently.
DISCOUNT_EDGES = ("0.10", "0.20", "0.30")
DISCOUNT_REPORT_LABELS = (
    "0% — No Discount", "1–10%", "11–20%", "21–30%", "30%+ Heavy Discount",
)
DISCOUNT_DASHBOARD_LABELS = (
    "0% No Discount", "1–10%", "11–20%", "21–30%", "30%+ Heavy",
)

# Longest on-time delivery in days by ship mode, 1 for others.
ON_TIME_DAYS = {"First Class": 2, "Second Class": 5, "Standard Class": 7}
ON_TIME_DAYS_OTHER = 1

# RFM segments, first match wins.  Each rule bounds the scores
# as {score: (lowest, highest)}.
RFM_SEGMENTS = (
    ("Champions", {"r": (4, 5), "f": (4, 5), "m": (4, 5)}),
    ("Loyal Customers", {"r": (3, 5), "f": (3, 5)}),
    ("Recent Customers", {"r": (4, 5), "f": (1, 2)}),
    ("Potential Loyalists", {"r": (3, 5), "m": (3, 5)}),
    ("At Risk", {"r": (1, 2), "f": (3, 5), "m": (3, 5)}),
    ("Cannot Lose Them", {"r": (1, 2), "f": (4, 5)}),
    ("Lost", {"r": (1, 2), "f": (1, 2), "m": (1, 2)}),
    ("Big Spenders", {"f": (1, 2), "m": (4, 5)}),
)
RFM_SEGMENT_REST = "Need Attention"


def first_match(cases: Sequence[tuple[Column, str]], rest: str) -> Column:
    """Label of the first condition that holds, else ``rest``."""
    head, *tail = cases
    chain = F.when(head[0], head[1])
    for condition, label in tail:
        chain = chain.when(condition, label)
    return chain.otherwise(rest)


def tenure_cohort(tenure: Column, numbered: bool = False) -> Column:
    """Tenure cohort label; ``numbered`` puts a sortable ``NN. `` in front."""
    labels = [label for _, _, label in TENURE_BANDS] + [TENURE_REST]
    if numbered:
        labels = [f"{i:02d}. {label}" for i, label in enumerate(labels, start=1)]
    cases = [
        (tenure.between(low, high), label)
        for (low, high, _), label in zip(TENURE_BANDS, labels)
    ]
    return first_match(cases, labels[-1])


def discount_band(discount: Column, labels: Sequence[str]) -> Column:
    """Discount band by upper edge; negative discounts fall in the first paid band."""
    value = discount.cast("decimal(5,2)")
    cases = [(value == 0, labels[0])]
    cases += [
        (value <= F.lit(edge).cast("decimal(5,2)"), label)
        for edge, label in zip(DISCOUNT_EDGES, labels[1:])
    ]
    return first_match(cases, labels[-1])


def on_time_limit(ship_mode: Column) -> Column:
    limit = F.lit(ON_TIME_DAYS_OTHER)
    for mode, days in ON_TIME_DAYS.items():
        limit = F.when(ship_mode == mode, days).otherwise(limit)
    return limit


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    scores = {"r": r, "f": f, "m": m}
    cases = []
    for label, bounds in RFM_SEGMENTS:
        condition = F.lit(True)
        for score, (low, high) in bounds.items():
            condition = condition & scores[score].between(low, high)
        cases.append((condition, label))
    return first_match(cases, RFM_SEGMENT_REST)


def churn_risk(tenure: Column, charges: Column, tech_support: Column) -> Column:
    """Churn risk of an active subscriber; bounds and labels are fixed values."""
    return first_match(
        [
            ((tenure <= 12) & (charges > 65) & (tech_support == "No"), "High Risk"),
            ((tenure <= 24) & (charges > 50), "Medium Risk"),
        ],
        "Low Risk",
    )
