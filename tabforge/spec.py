"""Feature specification: the declared roles of a table's columns.

Every operator takes ``(df, spec, ...)``; no column name is hard-coded in
an operator.  A spec says which columns are numeric or categorical, which
column is the target, the closed valid range per column, and which raw
values count as "missing" (sentinel tokens such as ``?`` or ``-9``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class FeatureSpec:
    key: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    ordinal: tuple[str, ...] = ()
    target: str | None = None
    # closed interval per column: {col: (lo, hi)}
    ranges: dict = field(default_factory=dict)
    # raw tokens that mean "missing": {col: (token, ...)}; "*" applies to all
    missing_tokens: dict = field(default_factory=dict)
    # categorical columns hold numeric codes (coerced to double like numerics)
    numeric_codes: bool = False

    @property
    def features(self) -> list[str]:
        return list(self.numeric) + [c for c in self.categorical if c not in self.numeric]

    @property
    def columns(self) -> list[str]:
        cols = list(self.key) + self.features
        if self.target:
            cols.append(self.target)
        return cols

    def tokens_for(self, col: str) -> tuple:
        return tuple(self.missing_tokens.get(col, ())) + tuple(self.missing_tokens.get("*", ()))

    def with_(self, **kw) -> "FeatureSpec":
        return replace(self, **kw)


# ---------------------------------------------------------------------------
# The clinical 14-column schema used by the reference's data
# files, with its column order, roles and valid ranges (inclusive).
# ---------------------------------------------------------------------------
HEART_COLUMNS = (
    "age", "sex", "cp", "trestbps", "chol", "fbs", "restecg",
    "thalach", "exang", "oldpeak", "slope", "ca", "thal", "target",
)
HEART_RANGES = {
    "age": (0, 120), "sex": (0, 1), "cp": (1, 4), "trestbps": (80, 250),
    "chol": (100, 600), "fbs": (0, 1), "restecg": (0, 2), "thalach": (60, 220),
    "exang": (0, 1), "oldpeak": (0, 10), "slope": (1, 3), "ca": (0, 4),
    "thal": (1, 7), "target": (0, 4),
}
HEART = FeatureSpec(
    numeric=("age", "trestbps", "chol", "thalach", "oldpeak"),
    categorical=("sex", "cp", "fbs", "restecg", "exang", "slope", "ca", "thal"),
    binary=("sex", "fbs", "exang"),
    ordinal=("cp", "restecg", "slope"),
    target="target",
    ranges=HEART_RANGES,
    missing_tokens={"*": ("?",)},
    numeric_codes=True,
)
