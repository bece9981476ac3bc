"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are dealt into shards of bounded size.  A shard sorts its vectors once
for each dimension.  A query walks all sorted lists downwards in step (upwards
where its component is negative), scores every vector it meets for the first
time, and stops when the threshold, the score of a vector made of the current
list values, is below its k-th best score: nothing unseen can then enter.
Shards answer blocks of queries, and the k best over all shards are kept.  A
block holds as many queries as ``QUERY_BYTES`` allow (about 100,000 of 64
components), so a shard's vectors move and are sorted once for very many of them.

Edge cases: vectors that are null or hold null or non-finite components take
no part, nor do rows with a null id; repeated rows of an id count once (the
smallest vector if they differ); shorter vectors are padded with zeros; ties
go to the smaller id; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

SCALE = 256
SHARD = 2048
#: Bytes of a block of queries, and queries whose thresholds are held at once.
QUERY_BYTES, QUERY_SLICE = 48 << 20, 512
FIRST_STEP = 16


def quantized(vector: Column) -> Column:
    """floor(SCALE * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


class Lists:
    """The sorted per-dimension lists of one shard."""

    def __init__(self, ids, vectors):
        import numpy as np

        by_id = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[by_id], vectors[by_id].astype(np.float64)     # integers below 2**53: exact
        self.up = np.argsort(self.v, axis=0, kind="stable")
        up = np.take_along_axis(self.v, self.up, 0)
        self.down = self.up[::-1]
        self.values = np.concatenate([up[::-1], up], 1)                      # falling, then rising

    def thresholds(self, queries):
        """For each depth and query, the most that an unseen vector can score."""
        import numpy as np

        q = queries.astype(np.float64)
        return self.values @ np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], 1).T

    def search(self, query, own: int, k: int, threshold):
        """(ids, scores) of the k best, best first; rows with id ``own`` are left out."""
        import numpy as np

        q = query.astype(np.float64)
        n = len(self.ids)
        plus, minus = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = self.ids == own
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        depth, step = 0, FIRST_STEP
        while depth < n:
            end = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.down[depth:end, plus]] = True
            met[self.up[depth:end, minus]] = True
            if end == n or not (len(plus) or len(minus)):
                met[:] = True                            # a zero query: every vector scores 0
                end = n
            new = np.flatnonzero(met & ~seen)
            seen |= met
            scores = self.v[new] @ q
            if len(best) == k:
                hit = scores >= best[-1]
                new, scores = new[hit], scores[hit]
            ids, scores = np.concatenate([best_ids, self.ids[new]]), np.concatenate([best, scores])
            order = np.lexsort((ids, -scores))[:k]
            best_ids, best = ids[order], scores[order]
            if len(best) == k and best[-1] > threshold[end - 1] or seen.all():
                break
            depth, step = end, 2 * step
        return best_ids, best


def top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
          shard: int = SHARD, query_block: int | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows chosen by ``is_query``
    (a predicate on ``vec_id``), against all other rows."""
    v = F.col(vector_col)
    rows = vectors.where(F.col(id_col).isNotNull() & usable(v)).select(F.col(id_col).cast("long").alias("vec_id"), quantized(v).alias("v"))
    rows = materialize(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    n = rows.count()
    queries = rows.where(is_query)
    dim = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    blocks = max(1, -(-queries.count() // (query_block or max(1, QUERY_BYTES // (8 * max(1, dim))))))
    shards = max(1, -(-n // shard))
    mixed = F.xxhash64("vec_id")

    def upto(n):
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    left = rows.select("vec_id", "v", F.pmod(mixed, F.lit(shards)).alias("shard"), F.explode(upto(blocks)).alias("block"))
    right = queries.select("vec_id", "v", F.explode(upto(shards)).alias("shard"), F.pmod(mixed, F.lit(blocks)).alias("block"))

    def matrix(column):
        import numpy as np

        out = np.zeros((len(column), dim), np.int64)
        flat, sizes = column.combine_chunks().flatten().to_numpy(zero_copy_only=False), column.combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        out[np.arange(dim)[None, :] < sizes[:, None]] = flat
        return out

    def run(shard_rows, query_rows):
        import numpy as np
        import pyarrow as pa

        q_ids, ids, scores = [], [], []
        if len(shard_rows) and len(query_rows):
            lists = Lists(shard_rows["vec_id"].to_numpy(), matrix(shard_rows["v"]))
            qs = matrix(query_rows["v"])
            limits = None
            for j, own in enumerate(query_rows["vec_id"].to_pylist()):
                if j % QUERY_SLICE == 0:
                    limits = lists.thresholds(qs[j: j + QUERY_SLICE])
                i, s = lists.search(qs[j], own, k, limits[:, j % QUERY_SLICE])
                q_ids.append(np.full(len(i), own, np.int64))
                ids.append(i)
                scores.append(s.astype(np.int64))
        cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(q_ids), "vec_id": cat(ids), "score": cat(scores)})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
