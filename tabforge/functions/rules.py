"""Rule sets for request validation and result interpretation.

A rule set is data: SQL boolean expressions (Spark SQL and ANSI SQL share
the syntax used here) paired with labels.  Factor rules come in groups;
within a group the first matching rule wins (an if/elif chain).  Defaults
for absent inputs are written into the expressions with ``coalesce``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RuleSet:
    risk: tuple = ()            # groups of (expr, label)
    protective: tuple = ()      # groups of (expr, label)
    high_recs: tuple = ()       # recommendation lines for the high-risk class
    low_recs: tuple = ()
    descriptions: dict = field(default_factory=dict)   # class -> sentence


def factors(groups) -> Column:
    """array<string> of the labels of matching rules (first match per group)."""
    items = []
    for group in groups:
        expr = None
        for cond, label in group:
            expr = (F.when(F.expr(cond), F.lit(label)) if expr is None
                    else expr.when(F.expr(cond), F.lit(label)))
        items.append(expr)
    return F.array_compact(F.array(*items)) if items else F.array().cast("array<string>")


def factors_sql(groups, sep: str = "; ") -> str:
    """Oracle form: the labels joined with ``sep`` (NULLs skipped)."""
    cases = []
    for group in groups:
        whens = " ".join(f"WHEN {cond} THEN '{label}'" for cond, label in group)
        cases.append(f"CASE {whens} END")
    return f"concat_ws('{sep}', {', '.join(cases)})"


# ---------------------------------------------------------------------------
# The clinical interpretation rules, labels and texts used by
# the reference's scoring screen (absent inputs take the defaults shown).
# ---------------------------------------------------------------------------
HEART_RULES = RuleSet(
    risk=(
        (("coalesce(age, 0) > 65", "Advanced age (>65 years)"),
         ("coalesce(age, 0) > 55", "Elevated age (>55 years)")),
        (("coalesce(sex, 0) = 1", "Male gender (higher baseline risk)"),),
        (("coalesce(trestbps, 0) > 140", "High blood pressure (>140 mmHg)"),
         ("coalesce(trestbps, 0) > 130", "Elevated blood pressure (>130 mmHg)")),
        (("coalesce(chol, 0) > 240", "High cholesterol (>240 mg/dl)"),
         ("coalesce(chol, 0) > 200", "Borderline high cholesterol (>200 mg/dl)")),
        (("coalesce(cp, 0) IN (1, 2)", "Chest pain symptoms"),),
        (("coalesce(thalach, 150) < (220 - coalesce(age, 50)) * 0.7", "Reduced exercise capacity"),),
        (("coalesce(exang, 0) = 1", "Exercise-induced chest pain"),),
        (("coalesce(oldpeak, 0) > 2.0", "Significant ST depression"),),
        (("coalesce(fbs, 0) = 1", "Elevated fasting blood sugar"),),
    ),
    protective=(
        (("coalesce(thalach, 150) > (220 - coalesce(age, 50)) * 0.85", "Excellent exercise capacity"),),
        (("coalesce(trestbps, 120) <= 120", "Optimal blood pressure"),),
        (("coalesce(chol, 200) < 200", "Healthy cholesterol levels"),),
        (("coalesce(cp, 0) = 4", "No chest pain symptoms"),),
        (("coalesce(exang, 0) = 0", "No exercise-induced chest pain"),),
        (("coalesce(restecg, 0) = 0", "Normal resting ECG"),),
    ),
    high_recs=("Consult with a cardiologist or healthcare provider",
               "Consider cardiac stress testing or imaging",
               "Review and optimize medications",
               "Implement lifestyle modifications immediately"),
    low_recs=("Maintain regular exercise routine", "Follow heart-healthy diet",
              "Regular health screenings", "Monitor blood pressure and cholesterol"),
    descriptions={
        0: "Based on the provided medical parameters, you appear to have a low risk of heart disease.",
        1: "Based on the provided medical parameters, you may have an elevated risk of heart disease.",
    },
)

# Confidence bands (lower bound, level) and the low-confidence note.
CONFIDENCE_BANDS = ((0.9, "Very High"), (0.8, "High"), (0.7, "Moderate"), (0.6, "Low"))
CONFIDENCE_FLOOR = "Very Low"
RISK_CATEGORIES = {0: "Low Risk", 1: "High Risk"}
LOW_CONFIDENCE = 0.6
LOW_CONFIDENCE_NOTE = (" However, the prediction confidence is low, so additional medical evaluation"
                       " is recommended.")
# Feature-impact levels (importance share above which a level applies).
IMPACT_LEVELS = ((0.7, "High"), (0.3, "Medium"))
IMPACT_FLOOR = "Low"

# The tighter request-validation rules of the scoring form
# (numeric min/max, or closed option lists).
HEART_REQUEST_RULES = {
    "age": ("range", 20, 100), "sex": ("options", (0, 1)), "cp": ("options", (1, 2, 3, 4)),
    "trestbps": ("range", 80, 200), "chol": ("range", 100, 600), "fbs": ("options", (0, 1)),
    "restecg": ("options", (0, 1, 2)), "thalach": ("range", 60, 220), "exang": ("options", (0, 1)),
    "oldpeak": ("range", 0.0, 6.0), "slope": ("options", (1, 2, 3)), "ca": ("options", (0, 1, 2, 3)),
    "thal": ("options", (3, 6, 7)),
}
HEART_LABELS = {
    "age": "Age", "sex": "Sex", "cp": "Chest Pain Type", "trestbps": "Resting Blood Pressure",
    "chol": "Serum Cholesterol", "fbs": "Fasting Blood Sugar", "restecg": "Resting ECG",
    "thalach": "Maximum Heart Rate", "exang": "Exercise Induced Angina", "oldpeak": "ST Depression",
    "slope": "ST Slope", "ca": "Major Vessels", "thal": "Thalassemia",
}
