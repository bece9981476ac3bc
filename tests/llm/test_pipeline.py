"""The corpus pipeline, stage by stage, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tabforge.llm import pii, toxicity
from tabforge.llm.queries import learnable

from .corpus import TEXTS, frame, prose, rows
from .test_dedup_ops import LOWER, WS, brute_components, brute_fingerprint
from .test_text_ops import brute_pii


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    texts = list(TEXTS) + [prose(30, 100 + i) + (" grotmoron" if i % 4 == 0 else "") for i in range(120)]
    near = prose(400, 999)
    texts += [near, near + " tail", near.upper()]
    frame(spark, texts).write.parquet(f"{root}/documents.parquet")
    labels = [(r[0], int("moron" in (r[1] or ""))) for r in rows(texts)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), texts


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def brute_lines(data):
    first, out = {}, {}
    key = lambda x: x.strip(WS).translate(LOWER)
    for i, t in data.items():
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                first[key(x)] = min(first.get(key(x), i), i)
    for i, t in data.items():
        kept = [x for x in (t or "").split("\n") if len(key(x)) < 10 or first[key(x)] == i]
        out[i] = t if len(kept) == len((t or "").split("\n")) else "\n".join(kept)
    return out


def test_stages(spark, corpus):
    root, _ = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    fitted, _ = toxicity.train(docs, spark.read.parquet(f"{root}/labels.parquet").where(learnable()))
    judged = {r.doc_id: r.flagged for r in toxicity.score(docs, fitted).collect()}
    assert 5 < sum(judged.values()) < 60

    one = P.drop_toxic(spark, docs, root)
    assert one.columns == docs.columns
    now = texts_of(one)
    assert now == {i: t for i, t in texts_of(docs).items() if not judged[i]}

    one = spark.createDataFrame(one.collect(), docs.schema)
    two = P.drop_lines(spark, one, root)
    assert two.columns == docs.columns
    now = brute_lines(now)
    assert texts_of(two) == now
    assert all(r.n_chars == len(r.text or "") and (r.doc, r.pos, r["rest"]) == (7, "p", "r") for r in two.collect())

    two = spark.createDataFrame(two.collect(), docs.schema)
    three = P.drop_near_duplicates(spark, two, root)
    assert three.columns == docs.columns
    comp = brute_components({i: brute_fingerprint(t) for i, t in now.items()})
    assert len(set(comp.values())) < len(comp)
    now = {i: t for i, t in now.items() if comp[i] == i}
    assert texts_of(three) == now

    three = spark.createDataFrame(three.collect(), docs.schema)
    four = P.mask_personal_data(spark, three, root)
    assert four.columns == docs.columns
    masked = texts_of(four)
    spans = {r.doc_id: r.s for r in pii.find_pii(three).select("doc_id", pii.digest(F.col("spans")).alias("s")).collect()}
    assert {i for i, t in masked.items() if t != now[i]} == {i for i, s in spans.items() if s}
    assert all(masked[i] is None for i, t in now.items() if t is None)
    left = [s for t in masked.values() for s in brute_pii(t)]
    assert not [s for s in left if s.startswith(("email", "ip"))]

    five = P.pack_sequences(spark, four, root).collect()
    assert {r.doc_id for r in five} == set(masked)
    room = {}
    for r in five:
        room.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in room.values():
        ends = np.cumsum([0] + [n for _, n in sorted(b)])
        assert [o for o, _ in sorted(b)] == ends[:-1].tolist() and ends[-1] <= 1024


def test_run_and_empty_table(spark, corpus, tmp_path):
    root, texts = corpus
    got = P.run(spark, root)
    ids = {r.doc_id for r in got.select("doc_id").distinct().collect()}
    assert 0 < len(ids) < len(texts)
    spark.read.parquet(f"{root}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{root}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_null_ids_pass_the_filters(spark, corpus):
    root, _ = corpus
    docs = frame(spark, ["one plain text of words", "another plain text here"], with_null_id=True)
    out = docs
    for _, stage in P.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, out, root).collect(), docs.schema)
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 0, 1, 4]
