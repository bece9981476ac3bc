"""Toxicity scores from a small convolutional text classifier.

A word is the sum of two hashed embeddings, of the whole word and of its
first letters.  Filters of several widths slide over the words, each keeps its
maximum over the whole text, and a logistic layer turns the maxima into a
score.  Training is plain numpy on a bounded sample of labelled documents;
scoring runs inside tasks over whole texts, in slices of bounded size.

Per language, a threshold is calibrated on labelled rows that the fit did not
see.  The language only picks the threshold: scores rest on the text alone.

Edge cases: a null or empty text has no word and scores what the bias alone
gives; without labels of both kinds every score is 0.0; a null or unseen
language uses the threshold of all languages; repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .common import materialize

BUCKETS = 1 << 16
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIX = 4
EPOCHS = 8
#: Labelled documents that training reads at most (half of either label), and
#: the longest text, in characters, that may be among them.
MAX_TRAIN_ROWS = 4000
MAX_TRAIN_CHARS = 40_000
#: Words scored at once, and distinct words whose vectors a task remembers.
SLICE_WORDS = 50_000
CACHE_WORDS = 100_000

_WORD = re.compile(r"\w+")


def word_buckets(word: str) -> tuple[int, int]:
    """Buckets of the word and of its first letters (never bucket 0)."""
    whole = zlib.crc32(word.encode())
    start = zlib.crc32(b"^" + word[:PREFIX].encode())
    return 1 + whole % (BUCKETS - 1), 1 + start % (BUCKETS - 1)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Model:
    """Arrays of the classifier; ``ready`` is False if there was nothing to fit."""

    embedding: object      # BUCKETS x DIM; row 0 is zero
    kernels: object        # DIM x (filters of all widths and places)
    bias: object           # one per filter
    out: object
    out_bias: float
    ready: bool

    def project(self, buckets):
        """Words x (all kernel columns): what a word adds at each place of each filter."""
        e = self.embedding
        return (e[buckets[:, 0]] + e[buckets[:, 1]]) @ self.kernels

    def pooled(self, projected, starts, argmax: bool = False):
        """Maxima of every filter over each text.

        ``projected`` holds the texts one after another, each followed by
        ``max(WIDTHS)`` zero rows, ``starts`` where they begin.
        """
        import numpy as np

        n = len(projected)
        pools, places, at = [], [], 0
        ends = np.append(starts[1:], n)
        for w in WIDTHS:
            conv = projected[:, at: at + FILTERS].copy()
            for j in range(1, w):
                conv[: n - j] += projected[j:, at + j * FILTERS: at + (j + 1) * FILTERS]
            at += w * FILTERS
            pool = np.maximum.reduceat(conv, starts, axis=0)
            pools.append(pool)
            if argmax:
                places.append(np.stack([s + conv[s:e].argmax(0) for s, e in zip(starts, ends)]))
        return np.concatenate(pools, 1), (np.concatenate(places, 1) if argmax else None)

    def logits(self, pool):
        import numpy as np

        return np.maximum(pool + self.bias, 0) @ self.out + self.out_bias


def flat(docs):
    """One bucket array of all texts with pads between, and their starts."""
    import numpy as np

    pad = np.zeros((max(WIDTHS), 2), np.int64)
    parts, starts, at = [], [], 0
    for d in docs:
        starts.append(at)
        parts += [d, pad]
        at += len(d) + len(pad)
    return np.concatenate(parts), np.array(starts)


def empty_model() -> Model:
    import numpy as np

    n = FILTERS * len(WIDTHS)
    return Model(np.zeros((BUCKETS, DIM), np.float32), np.zeros((DIM, FILTERS * sum(WIDTHS)), np.float32),
                 np.zeros(n, np.float32), np.zeros(n, np.float32), 0.0, False)


def fit(docs, labels, *, prior: float | None = None, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Train on bucket arrays (n_words x 2 each) and 0/1 labels with Adam.

    Buckets met in very few texts keep a zero vector, so single words are not
    learned by heart.  The first coordinate of the others starts at how far
    their count in texts of label 1 lies from its expectation, in standard
    deviations, and the filters start out reading it; few labels then suffice.
    ``prior`` is the share of label 1 among all rows; the bias is moved from
    the sample's share to it.
    """
    import numpy as np

    labels = np.asarray(labels, np.float32)
    m = empty_model()
    if not len(labels) or labels.min() == labels.max():
        return m
    rng = np.random.default_rng(seed)
    seen, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, y in zip(docs, labels):
        own = np.unique(d)
        seen[own] += 1
        toxic[own] += y
    live = seen >= max(2, 0.002 * len(docs))
    live[0] = False
    share = float(labels.mean())
    lean = (toxic - share * seen) / np.sqrt(seen * share * (1 - share) + 1)
    m.embedding[live] = rng.normal(0, 0.05, (live.sum(), DIM))
    m.embedding[live, 0] = np.clip(lean[live], -2, 8) / 4
    m.kernels[:] = rng.normal(0, 0.1, m.kernels.shape)
    m.kernels[0] = np.abs(rng.normal(0.5, 0.2, m.kernels.shape[1]))
    m.bias[:] = -1.0
    m.out[:] = np.abs(rng.normal(0.3, 0.1, m.out.shape))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in
               (("embedding", m.embedding), ("kernels", m.kernels), ("bias", m.bias), ("out", m.out))}
    rate, step = 0.02, 0

    def adam(name, grad, rows=None):
        m1, m2 = moments[name]
        at = slice(None) if rows is None else rows
        m1[at] = 0.9 * m1[at] + 0.1 * grad
        m2[at] = 0.99 * m2[at] + 0.01 * grad * grad
        return (rate * (m1[at] / (1 - 0.9 ** step)) / (np.sqrt(m2[at] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)

    batch = 32
    rounds = max(epochs, -(-300 * batch // max(1, len(docs))))     # small samples get at least 300 steps
    rounds = min(rounds, 60)
    for epoch in range(rounds):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            step += 1
            pick = order[lo: lo + batch]
            buckets, starts = flat([docs[i] for i in pick])
            pool, place = m.pooled(m.project(buckets), starts, argmax=True)
            hidden = np.maximum(pool + m.bias, 0)
            p = 1 / (1 + np.exp(-(hidden @ m.out + m.out_bias)))
            g = (p - labels[pick]) / len(pick)
            g_hidden = np.outer(g, m.out) * (pool + m.bias > 0)
            g_kernels = np.zeros_like(m.kernels)
            rows, grads, at, f0 = [], [], 0, 0
            for w in WIDTHS:                      # a maximum passes its gradient to the words it covers
                for f in range(FILTERS):
                    col = g_hidden[:, f0 + f]
                    hot = col != 0
                    if not hot.any():
                        continue
                    for j in range(w):
                        k = at + j * FILTERS + f
                        pair = buckets[np.minimum(place[hot, f0 + f] + j, len(buckets) - 1)]
                        c = col[hot][:, None]
                        g_kernels[:, k] += ((m.embedding[pair[:, 0]] + m.embedding[pair[:, 1]]) * c).sum(0)
                        ge = c * m.kernels[:, k]
                        rows += [pair[:, 0], pair[:, 1]]
                        grads += [ge, ge]
                at += w * FILTERS
                f0 += FILTERS
            m.out -= adam("out", hidden.T @ g + 1e-4 * m.out)
            m.bias -= adam("bias", g_hidden.sum(0))
            m.out_bias -= rate * float(g.sum()) * 5
            m.kernels -= adam("kernels", g_kernels)
            if rows:
                rows, grads = np.concatenate(rows), np.concatenate(grads)
                unique, back = np.unique(rows, return_inverse=True)
                total = np.zeros((len(unique), DIM), np.float32)
                np.add.at(total, back, grads)
                keep = live[unique]
                unique, total = unique[keep], total[keep]
                m.embedding[unique] -= adam("embedding", total, unique)
        rate = max(0.004, rate * 0.8)
    if prior is not None and 0 < prior < 1:
        m.out_bias += float(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    m.ready = True
    return m


def score_texts(model: Model, texts, cache: dict | None = None):
    """Scores of whole texts; ``cache`` (word -> buckets) may be reused."""
    import numpy as np

    cache = {} if cache is None else cache
    out = np.zeros(len(texts))
    if not model.ready:
        return out

    def buckets_of(text: str):
        if len(cache) > CACHE_WORDS:
            cache.clear()
        got = []
        for w in words(text):
            b = cache.get(w)
            if b is None:
                b = cache[w] = word_buckets(w)
            got.append(b)
        return np.array(got, np.int64).reshape(-1, 2)

    def pool_long(buckets):
        """Maxima of one long text, slice by slice; slices overlap by the widest filter."""
        step, over = SLICE_WORDS, max(WIDTHS) - 1
        best = None
        for lo in range(0, max(1, len(buckets)), step):
            part, starts = flat([buckets[lo: lo + step + over]])
            projected = model.project(part)
            now, _ = model.pooled(projected, starts)
            best = now if best is None else np.maximum(best, now)
        return best[0]

    group, at, n = [], [], 0

    def flush():
        nonlocal group, at, n
        if group:
            part, starts = flat(group)
            pool, _ = model.pooled(model.project(part), starts)
            out[at] = model.logits(pool)
        group, at, n = [], [], 0

    for i, text in enumerate(texts):
        b = buckets_of(text)
        if len(b) > SLICE_WORDS:
            out[i] = model.logits(pool_long(b)[None])[0]
            continue
        group.append(b)
        at.append(i)
        n += len(b)
        if n >= SLICE_WORDS:
            flush()
    flush()
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


@dataclass
class Toxicity:
    """A fitted classifier, its threshold for all languages, and the table
    (of_lang, own_threshold) of the languages with one of their own."""

    model: Model
    base: float
    by_lang: DataFrame

    def with_threshold(self, rows: DataFrame, lang: str = "lang") -> DataFrame:
        """``rows`` and the column lang_threshold.  The table has one row per
        language with enough labelled documents; Spark broadcasts it where its
        size is small."""
        own = self.by_lang
        return (rows.join(own, rows[lang] == own["of_lang"], "left")
                .withColumn("lang_threshold", F.coalesce("own_threshold", F.lit(self.base))).drop("of_lang", "own_threshold"))


def f1_threshold(scores, labels, weights=None) -> float:
    """The cut with the best F1, halfway between neighbouring scores; a row
    counts ``weights`` times."""
    import numpy as np

    scores, labels = np.asarray(scores, float), np.asarray(labels, int)
    if not len(labels) or labels.min() == labels.max():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    w = np.ones(len(labels)) if weights is None else np.asarray(weights, float)[order]
    s, y = scores[order], labels[order]
    tp = np.cumsum(w * y)
    f1 = 2 * tp / (np.cumsum(w) + tp[-1])
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    below = s[k + 1] if k + 1 < len(s) else 0.0
    return float((s[k] + below) / 2)


def score_table(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str | None = "lang") -> DataFrame:
    """doc_id, lang, score of every row, written as a narrow table.

    Texts are scored where they lie; whatever is joined or grouped later are
    these rows.
    """
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), lang.alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)   # fixed size: BUCKETS x DIM floats

    def run(batches):
        import pyarrow as pa

        cache: dict = {}
        for b in batches:
            s = score_texts(sent.value, b.column(2).to_pylist(), cache)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64())], names=["doc_id", "lang", "score"])

    return materialize(rows.mapInArrow(run, "doc_id long, lang string, score double"), "scores")


def labelled(labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(doc_id, label) of the rows with an id and a label 0 or 1."""
    ids = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    return ids.where("doc_id IS NOT NULL AND label IN (0, 1)")


def fit_sample(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
               max_rows: int = MAX_TRAIN_ROWS, max_chars: int = MAX_TRAIN_CHARS) -> tuple[Model, list]:
    """The classifier and the (doc_id, label) rows it was fitted on.

    The sample is at most ``max_rows`` labelled documents, half of either
    label, with the smallest hash of the id, so it does not depend on the
    partitioning; a fifth of it is left out of the fit.
    """
    import numpy as np

    ids = labelled(labels, id_col=id_col, label_col=label_col)
    counts = dict(ids.groupBy("label").count().collect())
    if len(counts) < 2:
        return empty_model(), []
    mixed = F.xxhash64("doc_id")
    half = max_rows // 2
    sample = (ids.where("label = 1").orderBy(mixed, "doc_id").limit(half)
              .unionByName(ids.where("label = 0").orderBy(mixed, "doc_id").limit(max_rows - min(half, counts[1]))))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = (texts.where(F.length("text") <= max_chars)
            .join(F.broadcast(sample), "doc_id"))        # at most max_rows rows of two numbers

    def run(batches):
        import pyarrow as pa

        for b in batches:
            packed = [np.array([word_buckets(w) for w in words(t.as_py())], np.int32).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(packed, pa.binary())],
                                             names=["doc_id", "label", "buckets"])

    got = rows.mapInArrow(run, "doc_id long, label int, buckets binary").collect()
    got.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.label, bytes(r.buckets)))
    got = [r for i, r in enumerate(got) if i % 5 != 4]
    xs = [np.frombuffer(r.buckets, np.int32).reshape(-1, 2) for r in got]
    ys = np.array([r.label for r in got], int)
    return fit(xs, ys, prior=counts[1] / (counts[0] + counts[1])), [(r.doc_id, r.label) for r in got]


def calibrate(scores: DataFrame, labels: DataFrame, used: list, *, id_col: str = "doc_id", label_col: str = "toxic",
              min_lang_rows: int = 20) -> tuple[float, DataFrame]:
    """The best threshold over all languages, and (of_lang, own_threshold).

    Rests on the scores of all labelled rows but the ``used`` ones, weighted to
    the class shares of all labelled rows.  A language needs ``min_lang_rows``
    of them, of both labels.  Each language's cut is found by one task from
    its counts per score (to four places): at most 20,002 rows a language.
    """
    spark = scores.sparkSession
    fitted = spark.createDataFrame(used, "doc_id long, label int")              # at most max_rows rows of two numbers
    ids = labelled(labels, id_col=id_col, label_col=label_col)
    rows = scores.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.round("score", 4).alias("score"))
    rows = rows.join(ids, "doc_id")
    gone = F.broadcast(fitted.select("doc_id").distinct())
    fresh = rows.join(gone, "doc_id", "left_anti").groupBy("lang", "label", "score").agg(F.count(F.lit(1)).alias("n"))
    seen = rows.join(gone, "doc_id", "left_semi").groupBy("lang", "label").agg(F.count(F.lit(1)).alias("seen"))
    cells = fresh.select("lang", "label", "score", "n", F.lit(0).cast("long").alias("seen")).unionByName(
        seen.select("lang", "label", F.lit(None).cast("double").alias("score"), F.lit(0).cast("long").alias("n"), "seen"))
    cells = materialize(cells, "score-counts")

    def cut(frame, least):
        got = frame[frame.n > 0]
        have = got.groupby("label").n.sum()
        if len(have) < 2 or have.sum() < least:
            return None
        share = 1 + frame.groupby("label").seen.sum().reindex(have.index, fill_value=0) / have
        return f1_threshold(got.score, got.label, got.n * got.label.map(share))

    def one(frame):
        import pandas as pd

        t = cut(frame, min_lang_rows)
        return pd.DataFrame({"of_lang": frame.lang.iloc[:1], "own_threshold": [t]})

    whole = cells.groupBy("label", "score").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")).toPandas()    # scores have four places
    base = cut(whole, 0)
    own = cells.where("lang <> ''").groupBy("lang").applyInPandas(one, "of_lang string, own_threshold double")
    own = materialize(own.where("own_threshold IS NOT NULL"), "thresholds")
    return 0.5 if base is None else base, own


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str | None = "lang", label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS,
          max_chars: int = MAX_TRAIN_CHARS, min_lang_rows: int = 20) -> tuple[Toxicity, DataFrame]:
    """Fit and calibrate on ``labels``, the rows that may be learned from.

    Returns the classifier and the table (doc_id, lang, score) of ``docs``, so
    that a caller who wants scores does not pass over the texts again.
    """
    model, used = fit_sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, max_rows=max_rows, max_chars=max_chars)
    scores = score_table(docs, model, id_col=id_col, text_col=text_col, lang_col=lang_col)
    base, by_lang = calibrate(scores, labels, used, id_col=id_col, label_col=label_col, min_lang_rows=min_lang_rows)
    return Toxicity(model, base, by_lang), scores


def judged(scores: DataFrame, fitted: Toxicity) -> DataFrame:
    """doc_id, score, lang_threshold, flagged (score >= the language's threshold)."""
    rows = fitted.with_threshold(scores)
    return rows.select("doc_id", "score", "lang_threshold", (F.col("score") >= F.col("lang_threshold")).alias("flagged"))


def score(docs: DataFrame, fitted: Toxicity, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str | None = "lang") -> DataFrame:
    """:func:`judged` for any documents."""
    return judged(score_table(docs, fitted.model, id_col=id_col, text_col=text_col, lang_col=lang_col), fitted)


def reject(docs: DataFrame, fitted: Toxicity, *, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """``docs``, all columns, without the documents whose score reaches the
    threshold of their language.

    Scores the texts again where they lie: a join with the table of scores
    would move every text.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    lang = F.col(names[docs.columns.index(lang_col)]).cast("string") if lang_col else F.lit(None).cast("string")
    rows = fitted.with_threshold(docs.toDF(*names).withColumn("lang", lang)).drop("lang")
    model = docs.sparkSession.sparkContext.broadcast(fitted.model)   # fixed size: BUCKETS x DIM floats
    schema = docs.schema

    def run(batches):
        import numpy as np
        import pyarrow as pa

        cache: dict = {}
        for b in batches:
            s = score_texts(model.value, [t or "" for t in b.column(at).to_pylist()], cache)
            limit = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            kept = b.filter(pa.array(np.asarray(s < limit, bool))).select(list(range(b.num_columns - 1)))
            yield kept.rename_columns(schema.names)

    return rows.mapInArrow(run, schema)
