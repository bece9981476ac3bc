"""Principal components (X1-X6) on ``pyspark.ml.feature.PCA``.

Spark's PCA builds the d x d covariance with a distributed tree
aggregate (linear in rows) and eigen-decomposes it on the driver (bounded
by d).  Inputs are standardised first (population std, as T7), because
Spark's PCA does not centre or scale.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clean import fit_scaler, scale
from .classify import assemble

# Variance thresholds of the component table.
THRESHOLDS = (0.80, 0.85, 0.90, 0.95, 0.99)


@dataclass
class PCAResult:
    features: list[str]
    n_rows: int
    ratio: np.ndarray          # explained variance ratio per component
    components: np.ndarray     # d x k loadings, canonical sign
    scaler: dict
    model: object

    @property
    def cumulative(self) -> np.ndarray:
        return np.cumsum(self.ratio)

    @property
    def variance(self) -> np.ndarray:
        # standardised features have sample variance n/(n-1) each
        total = len(self.features) * self.n_rows / (self.n_rows - 1)
        return self.ratio * total

    @property
    def singular_values(self) -> np.ndarray:
        return np.sqrt(self.variance * (self.n_rows - 1))

    def n_for(self, threshold: float) -> int | None:
        """First component count whose cumulative ratio reaches ``threshold`` (None if never)."""
        hit = np.nonzero(self.cumulative >= threshold - 1e-12)[0]
        return int(hit[0]) + 1 if len(hit) else None


def fit_pca(df: DataFrame, features: list[str], k: int | None = None) -> PCAResult:
    """Standardise, fit PCA(k = min(n, d) by default); canonical signs
    (largest-|loading| entry of each component positive)."""
    stats = fit_scaler(df, features)
    n = stats[features[0]]["count"]
    k = k or min(n, len(features))
    z = assemble(scale(df, features, stats), features, "zfeatures")
    model = PCA(k=k, inputCol="zfeatures", outputCol="pca").fit(z)
    pc = model.pc.toArray().copy()
    for j in range(pc.shape[1]):
        i = int(np.argmax(np.abs(pc[:, j])))
        if pc[i, j] < 0:
            pc[:, j] = -pc[:, j]
    return PCAResult(list(features), int(n), model.explainedVariance.toArray(), pc, stats, model)


def variance_table(spark: SparkSession, r: PCAResult) -> DataFrame:
    """(component, explained_variance, ratio, cumulative, singular_value)."""
    rows = [(i + 1, float(v), float(q), float(c), float(s))
            for i, (v, q, c, s) in enumerate(zip(r.variance, r.ratio, r.cumulative, r.singular_values))]
    return spark.createDataFrame(rows, "component int, explained_variance double, ratio double, "
                                       "cumulative double, singular_value double")


def threshold_table(spark: SparkSession, r: PCAResult, thresholds=THRESHOLDS) -> DataFrame:
    """Components needed per variance threshold."""
    return spark.createDataFrame([(float(t), r.n_for(t)) for t in thresholds], "threshold double, n_components int")


def loadings(spark: SparkSession, r: PCAResult) -> DataFrame:
    """Long loadings (component, feature, loading)."""
    rows = [(j + 1, f, float(r.components[i, j])) for j in range(r.components.shape[1])
            for i, f in enumerate(r.features)]
    return spark.createDataFrame(rows, "component int, feature string, loading double")


def top_loadings(spark: SparkSession, r: PCAResult, n: int = 5) -> DataFrame:
    """Top-n features per component by |loading|."""
    from pyspark.sql import Window
    w = Window.partitionBy("component").orderBy(F.desc(F.abs("loading")), "feature")
    return loadings(spark, r).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def transform(df: DataFrame, r: PCAResult, m: int | None = None, out: str = "pcs") -> DataFrame:
    """Project standardised rows on the first m (sign-canonical) components."""
    feats = r.features
    z = assemble(scale(df, feats, r.scaler), feats, "zfeatures")
    comps = r.components[:, : (m or r.components.shape[1])]
    arr = F.array(*[sum(F.col(f) * float(comps[i, j]) for i, f in enumerate(feats)) for j in range(comps.shape[1])])
    return z.withColumn(out, arr).drop("zfeatures")


def pca_columns(df: DataFrame, r: PCAResult, m: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """The table PC1..PCm (+ kept columns)."""
    t = transform(df, r, m)
    k = m or r.components.shape[1]
    return t.select(*(keep or []), *[F.col("pcs")[j].alias(f"PC{j + 1}") for j in range(k)])


# The report's rules (name, least value or None, text).
REPORT_RULES = (
    ("dimensionality_reduction", None, "Consider reducing dimensions from {d} to {n95} components ({saved:.1f}% reduction) "
                                       "while retaining 95% of variance."),
    ("variance_concentration", 0.6, "First two components explain {two:.1f}% of variance. "
                                    "2D visualization should be highly informative."),
    ("component_selection", 0.0, "First 5 components explain {five:.1f}% of variance. "
                                 "Consider using 5 components for most analyses."),
)


def recommendations(r: PCAResult) -> list[tuple[str, str]]:
    """The report rules that hold for the fitted components."""
    cum, d, n95 = r.cumulative, len(r.features), r.n_for(0.95)
    facts = {"d": d, "n95": n95, "saved": 100 * (1 - (n95 or d) / d), "two": 100 * cum[min(1, len(cum) - 1)],
             "five": 100 * cum[min(4, len(cum) - 1)]}
    holds = {"dimensionality_reduction": n95 is not None and n95 < d,
             "variance_concentration": len(cum) > 1 and cum[1] > REPORT_RULES[1][1],
             "component_selection": len(cum) > 5}
    return [(name, text.format(**facts)) for name, _, text in REPORT_RULES if holds[name]]
