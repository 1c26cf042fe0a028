"""Threshold-to-tier labelling (B10) and the fixed vocabularies of the audit.

Every rule here is a chained ``F.when`` with the strict/non-strict comparisons of
the audit it reproduces, so it compiles into codegen and has a literal SQL twin.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the audited behaviour exactly (do not edit).
# ---------------------------------------------------------------------------
# Detector check names, in check order 1..5.
CHECK_NAMES = [
    "Sin 1: Target Encoding",
    "Sin 2: Feature From Target",
    "Sin 3: Timestamp Scaling",
    "Sin 4: Group Overlap",
    "Sin 5: Duplicate Rows",
]
# Fix texts per check, in check order 1..5 (check 2 with no numeric features: "N/A").
CHECK_FIXES = [
    "Encode AFTER split or use Pipeline with TargetEncoder.",
    "Ask: was this column computed using outcome data? If yes → drop it.",
    "Always use sklearn Pipeline. Never fit scaler on full dataset.",
    "Use GroupKFold — all rows from same group stay in one split.",
    "Call df.drop_duplicates() BEFORE splitting. clean.py does this automatically.",
]
FIX_NO_NUMERIC = "N/A"
FIX_NO_GROUP = "Specify id_col when creating detector."
# Message formats per check ({} placeholders filled from the check's counts).
MSG_CHECK1 = "{n} categorical col(s) at risk of target encoding leak."
MSG_CHECK2 = "{critical} critical (>0.8), {high} high (>0.5) correlation features."
MSG_CHECK2_NONE = "No numeric features."
MSG_CHECK3 = "{n} time-related column(s) found. Temporal ordering may matter."
MSG_CHECK4 = "{multi} of {total} groups ({pct}%) have multiple rows."
MSG_CHECK4_NONE = "No group/ID column specified."
MSG_CHECK5 = "{exact} exact duplicate rows ({pct}%). {ids} duplicate IDs."
# Substrings (case-insensitive) that mark a column name as time-related.
TIME_KEYWORDS = ["date", "day", "year", "month", "time", "period"]
# Risk weights for the 0-100 score, and the score cap.
RISK_WEIGHTS = {"CRITICAL": 25, "HIGH": 15, "MEDIUM": 8, "LOW": 3, "CLEAN": 0, "UNKNOWN": 5}
SCORE_CAP = 100
# Chart severity values per risk.
RISK_SEVERITY = {"CRITICAL": 5.0, "HIGH": 4.0, "MEDIUM": 3.0, "LOW": 2.0, "CLEAN": 1.0, "UNKNOWN": 1.5}
# Advice per overall level.
LEVEL_ADVICE = {
    "CLEAN": "Dataset passed all checks.",
    "LOW": "Low risk. Address before final deployment.",
    "MEDIUM": "Medium risk. Review flagged items before training.",
    "HIGH": "High risk. Fix issues before training.",
    "CRITICAL": "STOP. Fix all critical issues before proceeding.",
}
# Expected-shortfall sentence of an experiment comparison (%s = inflation in percent, 1 decimal).
MSG_SHORTFALL = "In production, this model would UNDERPERFORM expectations by %s%%"
# Experiment names, by experiment number 1..5.
EXPERIMENT_NAMES = {1: "Target Encoding", 2: "Feature From Target", 3: "Timestamp Scaling",
                    4: "Group Overlap", 5: "Duplicate ID"}
# AUC interpretation, coarse scale (>= thresholds).
AUC_COARSE = [(0.90, "VERY HIGH — check for leakage"), (0.80, "STRONG — genuinely good"),
              (0.70, "DECENT — learning real signal"), (None, "WEAK — model struggling")]
# AUC interpretation, fine guide (>= lower bound).
AUC_FINE = [(0.95, "Almost certainly leaking"), (0.90, "Very suspicious — investigate"),
            (0.80, "Strong — genuinely good model"), (0.70, "Decent — learning real signal"),
            (0.60, "Weak — model struggling"), (None, "Barely better than random")]
# ---------------------------------------------------------------------------


def _chain(rules, default) -> Column:
    """rules: list of (condition Column, label); first match wins."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def categorical_risk(n_at_risk) -> Column:
    """Check 1: 0 CLEAN, <=2 LOW, <=5 MEDIUM, else HIGH."""
    n = col_(n_at_risk)
    return _chain([(n == 0, "CLEAN"), (n <= 2, "LOW"), (n <= 5, "MEDIUM")], "HIGH")


def correlation_risk(n_critical, n_high, n_medium) -> Column:
    """Check 2: any >0.8 CRITICAL, any (0.5,0.8] HIGH, any >0.3 MEDIUM, else CLEAN."""
    return _chain([(col_(n_critical) > 0, "CRITICAL"), (col_(n_high) > 0, "HIGH"),
                   (col_(n_medium) > 0, "MEDIUM")], "CLEAN")


def group_risk(n_multi, share) -> Column:
    """Check 4: 0 CLEAN, share <0.05 LOW, <0.20 MEDIUM, else HIGH."""
    return _chain([(col_(n_multi) == 0, "CLEAN"), (col_(share) < 0.05, "LOW"),
                   (col_(share) < 0.20, "MEDIUM")], "HIGH")


def duplicate_risk(n_exact, pct) -> Column:
    """Check 5: 0 CLEAN, pct <1 LOW, <5 MEDIUM, else HIGH (pct in percent)."""
    return _chain([(col_(n_exact) == 0, "CLEAN"), (col_(pct) < 1, "LOW"),
                   (col_(pct) < 5, "MEDIUM")], "HIGH")


def risk_weight(risk) -> Column:
    r = col_(risk)
    return _chain([(r == k, v) for k, v in RISK_WEIGHTS.items()], 0).cast("int")


def risk_severity(risk) -> Column:
    r = col_(risk)
    return _chain([(r == k, v) for k, v in RISK_SEVERITY.items()], 1.0).cast("double")


def score_level(score) -> Column:
    """0 CLEAN, <=10 LOW, <=25 MEDIUM, <=45 HIGH, else CRITICAL."""
    s = col_(score)
    return _chain([(s == 0, "CLEAN"), (s <= 10, "LOW"), (s <= 25, "MEDIUM"), (s <= 45, "HIGH")],
                  "CRITICAL")


def level_advice(level) -> Column:
    lv = col_(level)
    return _chain([(lv == k, v) for k, v in LEVEL_ADVICE.items()], "")


def missing_tier(pct_rounded) -> Column:
    """EDA missingness tiers on the 1-decimal percentage: >40 severe, >10 moderate, else mild."""
    p = col_(pct_rounded)
    return _chain([(p > 40, "severe"), (p > 10, "moderate")], "mild")


def correlation_tier(abs_corr) -> Column:
    """EDA correlation hunt: >0.5 suspicious, (0.3, 0.5] high, else normal."""
    c = col_(abs_corr)
    return _chain([(c > 0.5, "suspicious"), (c > 0.3, "high")], "normal")


def inflation_severity(inflation) -> Column:
    """Experiment comparison: >0.15 CRITICAL, >0.08 HIGH, >0.03 MODERATE, else LOW."""
    i = col_(inflation)
    return _chain([(i > 0.15, "CRITICAL"), (i > 0.08, "HIGH"), (i > 0.03, "MODERATE")], "LOW")


def gauge_severity(inflation) -> Column:
    """Chart scale: >0.05 HIGH, >0.02 MODERATE, else LOW."""
    i = col_(inflation)
    return _chain([(i > 0.05, "HIGH"), (i > 0.02, "MODERATE")], "LOW")


def auc_interpretation(auc) -> Column:
    a = col_(auc)
    return _chain([(a >= t, label) for t, label in AUC_COARSE if t is not None], AUC_COARSE[-1][1])


def auc_guide(auc) -> Column:
    a = col_(auc)
    return _chain([(a >= t, label) for t, label in AUC_FINE if t is not None], AUC_FINE[-1][1])


def time_named(columns, exclude=()) -> list[str]:
    """Columns whose lower-cased name contains a time keyword (substring match)."""
    ex = {c for c in exclude if c}
    return [c for c in columns if c not in ex and any(k in c.lower() for k in TIME_KEYWORDS)]
