"""Clustering features: a bounded summary of any number of rows for linkage.

A feature stands for a set of rows by their number, sum and sum of squared
norms; two features add up to that of both sets.  A task reads its rows once
and keeps at most ``limit`` features: a row joins the nearest feature if the
spread of the two together stays within a threshold and becomes a feature of
its own otherwise; when there are too many, the threshold grows and the
features themselves are inserted again.  The tasks' summaries are merged in
the same way, a few at a time, until one is left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Summaries that one merging task takes.
FAN_IN = 8


@dataclass
class Features:
    n: np.ndarray            # rows
    s: np.ndarray            # sums, features x dimensions
    q: np.ndarray            # sums of squared norms
    spread: float = 0.0      # largest mean squared distance to the centre of a feature

    @classmethod
    def of_rows(cls, x: np.ndarray) -> Features:
        return cls(np.ones(len(x)), x.astype(float), (x.astype(float) ** 2).sum(1))

    @property
    def centres(self) -> np.ndarray:
        return self.s / self.n[:, None]

    def take(self, at) -> Features:
        return Features(self.n[at], self.s[at], self.q[at], self.spread)

    def with_(self, more: Features) -> Features:
        return Features(np.concatenate([self.n, more.n]), np.concatenate([self.s, more.s]), np.concatenate([self.q, more.q]), self.spread)


def joint_spread(a: Features, i, b: Features, j) -> np.ndarray:
    """Mean squared distance to the common centre of a[i] and b[j] together."""
    n = a.n[i] + b.n[j]
    s = a.s[i] + b.s[j]
    return np.maximum((a.q[i] + b.q[j]) / n - ((s / n[:, None]) ** 2).sum(-1), 0.0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1)[None] - 2 * x @ centres.T).argmin(1)


def insert(kept: Features, new: Features, limit: int) -> Features:
    """``kept`` with ``new`` taken in; more than ``limit`` features raise the threshold."""
    left = new
    while True:
        if len(kept.n) and len(left.n):
            at = _nearest(left.centres, kept.centres)
            fits = joint_spread(left, np.arange(len(left.n)), kept, at) <= kept.spread
            for total, own in ((kept.n, left.n), (kept.s, left.s), (kept.q, left.q)):
                np.add.at(total, at[fits], own[fits])
            left = left.take(~fits)
        # the first that fits nowhere opens a feature; those that fit it join
        while len(left.n) and len(kept.n) <= limit:
            head = left.take(slice(0, 1))
            rest = left.take(slice(1, None))
            fits = joint_spread(rest, np.arange(len(rest.n)), head, np.zeros(len(rest.n), int)) <= kept.spread
            own = rest.take(fits)
            kept = kept.with_(Features(head.n + own.n.sum(), head.s + own.s.sum(0), head.q + own.q.sum()))
            left = rest.take(~fits)
        if len(kept.n) <= limit:
            return kept
        kept = coarser(kept, limit)
        if not len(left.n):
            return kept


def coarser(kept: Features, limit: int) -> Features:
    """At most ``limit // 2`` features: the threshold is that of the closest half of the neighbours, or more."""
    while len(kept.n) > max(1, limit // 2):
        c = kept.centres
        d = ((c ** 2).sum(1)[:, None] + (c ** 2).sum(1)[None] - 2 * c @ c.T)
        np.fill_diagonal(d, np.inf)
        near = d.argmin(1)
        joint = joint_spread(kept, np.arange(len(kept.n)), kept, near)
        spread = max(float(np.median(joint)), 1.5 * kept.spread, 1e-300)
        order = np.argsort(-kept.n, kind="stable")            # the heaviest stay where they are
        kept = insert(Features(np.zeros(0), np.zeros((0, c.shape[1])), np.zeros(0), spread), kept.take(order), len(kept.n) + 1)
    return kept


def merge(parts: list[Features], limit: int) -> Features:
    parts = sorted((p for p in parts if len(p.n)), key=lambda p: -p.spread)
    if not parts:
        return Features(np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    out = Features(np.zeros(0), np.zeros((0, parts[0].s.shape[1])), np.zeros(0), parts[0].spread)
    for p in parts:
        out = insert(out, p, limit)
    return out


_SCHEMA = "n array<double>, s array<double>, q array<double>, spread double"


def _row(f: Features):
    import pyarrow as pa

    floats = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([f.n.tolist()], floats), pa.array([f.s.ravel().tolist()], floats), pa.array([f.q.tolist()], floats),
                                       pa.array([float(f.spread)])], names=["n", "s", "q", "spread"])


def _features(n, s, q, spread) -> Features:
    n = np.array(n, float)
    return Features(n, np.array(s, float).reshape(len(n), -1), np.array(q, float), float(spread))


def summarise(df: DataFrame, features: str = "features", limit: int = 256, batch: int = 2048) -> Features:
    """At most ``limit`` features of all rows, from one pass over them."""
    rows = df.select(vector_to_array(features).alias("x"))

    def first(batches):
        kept = None
        for b in batches:
            for lo in range(0, b.num_rows, batch):
                part = b.slice(lo, batch)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                if kept is None:
                    kept = Features(np.zeros(0), np.zeros((0, x.shape[1])), np.zeros(0))
                kept = insert(kept, Features.of_rows(x), limit)
        if kept is not None:
            yield _row(kept)

    def again(batches):
        parts = [_features(*(b.column(c)[i].as_py() for c in range(4))) for b in batches for i in range(b.num_rows)]
        if parts:
            yield _row(merge(parts, limit))

    out = materialize(rows.mapInArrow(first, _SCHEMA), "cluster-features")       # one row a task
    width = out.count()
    while width > 1:
        width = -(-width // FAN_IN)
        out = out.repartition(width).mapInArrow(again, _SCHEMA)
    got = [_features(*r) for r in out.collect()]                  # one summary
    return merge(got, limit)


def nearest_centre(centres: np.ndarray):
    """A column function: the number of the centre nearest to a vector column."""
    @F.pandas_udf("int")
    def at(x: pd.Series) -> pd.Series:
        return pd.Series(_nearest(np.stack(x.to_numpy()), centres) if len(x) else [], dtype="int32")

    return lambda column: at(vector_to_array(column))
