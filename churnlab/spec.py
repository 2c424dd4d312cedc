"""Column roles and the fixed analysis constants.

A ``FeatureSpec`` is a plain role registry: which column is the key, which is
the target and how every feature column is to be encoded.  Operators take a
spec instead of hard-coded column lists, so the same code runs on the
subscriber fixture and on any other customer table with the same roles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the analysis being reproduced (all overridable
# by arguments): imbalance threshold in percent; histogram bins for features
# and for scores; rate bands for category reports (mid above 25, high above
# 40); segment bands (mid above 20, high above 35) and the segment alert level
# 40; minimum category spread 20 points; tenure segment edges and labels; risk
# edges and labels; test share 0.2 and seed 42; importance top-k 3, 10 and 15;
# forest settings 200 trees, depth 10, leaf size 20, square-root feature
# subsets; scorecard clip range 0.05 to 0.85 and drift 0.015 per month.
# ---------------------------------------------------------------------------
IMBALANCE_THRESHOLD = 35.0
FEATURE_BINS = 30
SCORE_BINS = 40
RATE_BANDS = (25.0, 40.0)
SEGMENT_BANDS = (20.0, 35.0)
SEGMENT_ALERT = 40.0
MIN_SPREAD = 20.0
TENURE_EDGES = (0, 6, 12, 24, 36, 48, 72)
TENURE_LABELS = ("0-6", "7-12", "13-24", "25-36", "37-48", "49+")
RISK_EDGES = (0.0, 0.3, 0.5, 0.7, 1.0)
RISK_LABELS = ("low (<30%)", "medium (30-50%)", "high (50-70%)", "very high (>70%)")
TEST_SIZE = 0.2
SEED = 42
TOP_K_SHORT, TOP_K, TOP_K_LONG = 3, 10, 15
FOREST = dict(numTrees=200, maxDepth=10, minInstancesPerNode=20, featureSubsetStrategy="sqrt", seed=SEED)
SCORE_CLIP = (0.05, 0.85)
MONTH_DRIFT = 0.015

# Subscriber fixture: snapshot date, order-count cut points for commitment,
# high-balance and bulk-order thresholds, number of monthly batches.
SNAPSHOT = "2000-08-01"
COMMITMENT_CUTS = (6, 10)
HIGH_BALANCE = 5000.0
BULK_ORDER = 450000.0
N_BATCHES = 6
# Tenure edges for the fixture (reference edges put almost every row last).
SUBS_TENURE_EDGES = (0, 48, 60, 72)
SUBS_TENURE_LABELS = ("0-48", "49-60", "61-72")


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the columns of a customer table."""

    id_col: str
    target: str
    positive: str = "Yes"
    numeric: tuple[str, ...] = ()
    numeric_text: tuple[str, ...] = ()          # numbers stored as text
    fill_zero: tuple[str, ...] = ()             # structural nulls -> 0
    flags: tuple[str, ...] = ()                 # already 0/1 integers
    binary: dict = field(default_factory=dict)  # column -> value encoded as 1
    binary_negative: dict = field(default_factory=dict)  # column -> value encoded as 0, where unknown values are kept apart
    ordinal: dict = field(default_factory=dict)  # column -> levels in rank order
    nominal: tuple[str, ...] = ()               # one-hot encoded
    tristate: dict = field(default_factory=dict)  # column -> value encoded as 1
    batch_col: str | None = None
    column_order: tuple[str, ...] = ()          # raw column order

    @property
    def categorical(self) -> tuple[str, ...]:
        cols = list(self.binary) + list(self.ordinal) + list(self.nominal) + list(self.tristate)
        return tuple(c for c in self.column_order if c in cols)

    @property
    def single_features(self) -> tuple[str, ...]:
        """Features that stay one column after encoding, in raw order."""
        keep = set(self.numeric) | set(self.flags) | set(self.binary) | set(self.ordinal) | set(self.tristate)
        return tuple(c for c in self.column_order if c in keep)

    @property
    def raw_features(self) -> tuple[str, ...]:
        drop = {self.id_col, self.target, self.batch_col}
        return tuple(c for c in self.column_order if c not in drop)

    def role(self, c: str) -> str:
        if c == self.id_col:
            return "id"
        if c == self.target:
            return "target"
        if c == self.batch_col:
            return "batch"
        if c in self.numeric:
            return "numeric"
        if c in self.flags:
            return "flag"
        if c in self.binary:
            return "binary"
        if c in self.ordinal:
            return "ordinal"
        if c in self.nominal:
            return "nominal"
        if c in self.tristate:
            return "tristate"
        return "other"


SUBS_SPEC = FeatureSpec(
    id_col="c_custkey",
    target="churn",
    positive="Yes",
    numeric=("tenure", "total_spend", "monthly_spend"),
    numeric_text=("total_spend",),
    fill_zero=("total_spend",),
    flags=("high_balance",),
    binary={"in_debt": "Yes"},
    ordinal={"commitment": ("Low", "Mid", "High")},
    nominal=("segment", "region"),
    tristate={"urgent_user": "Yes", "bulk_buyer": "Yes"},
    batch_col="batch_month",
    column_order=("c_custkey", "churn", "tenure", "total_spend", "monthly_spend", "high_balance",
                  "in_debt", "commitment", "segment", "region", "urgent_user", "bulk_buyer", "batch_month"),
)

# Categorical features used by the category reports on the fixture.
SUBS_CATEGORY_FEATURES = ("commitment", "segment", "region", "urgent_user", "bulk_buyer",
                          "in_debt", "high_balance")
