"""Passage dedup against brute force."""

import random

import pytest

from tabforge.llm import passage_dedup

from .corpus import TEXTS, frame, rows


def brute(data, m):
    first = {}
    for i, t in data:
        b = (t or "").encode()
        for s in range(len(b) - m + 1):
            w = b[s:s + m]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in data:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - m + 1):
            if first[b[s:s + m]] < i:
                gone[s:s + m] = b"\1" * m
        spans = [s for s in range(len(b)) if gone[s] and (s == 0 or not gone[s - 1])]
        out[i] = (len(b), sum(gone), len(spans), bytes(c for c, g in zip(b, gone) if not g))
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [2000, 1 << 22])
def test_passages(spark, block_bytes):
    texts = [t if t is None or len(t) < 20000 else t[:3000] for t in TEXTS]
    got = result(passage_dedup.dedup_passages(frame(spark, texts, repeat=True), block_bytes=block_bytes))
    want = brute([(r[0], r[1]) for r in rows(texts)], 50)
    assert got == want
    assert sum(v[1] > 0 for v in want.values()) > 5


@pytest.mark.parametrize("min_bytes", [21, 37, 130])
def test_random_repeats(spark, min_bytes, monkeypatch):
    monkeypatch.setattr(passage_dedup, "SLICE", 97)
    r = random.Random(min_bytes)
    pool = ["".join(r.choice("ab") for _ in range(r.randint(10, 200))) for _ in range(12)]
    texts = ["".join(r.choice(pool)[r.randint(0, 9): r.randint(20, 200)] for _ in range(r.randint(0, 6))) for _ in range(60)]
    got = result(passage_dedup.dedup_passages(frame(spark, texts), min_bytes=min_bytes, block_bytes=1500))
    assert got == brute([(x[0], x[1]) for x in rows(texts)], min_bytes)


def test_null_ids_and_empty(spark):
    long = "a passage that is long enough to be found twice in two different documents"
    got = passage_dedup.dedup_passages(frame(spark, [long, long], with_null_id=True)).collect()
    assert sorted((r.doc_id or 0, len(r.kept)) for r in got) == [(0, len(long)), (0, len(long)), (1, len(long)), (4, 0)]
    assert passage_dedup.dedup_passages(frame(spark).limit(0)).count() == 0


def test_frequent_trigger_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(passage_dedup, "HEAVY", 16)
    judge = passage_dedup.first_documents

    def small(rows, least, min_bytes=50):
        assert len({bytes(r[min_bytes - 20: min_bytes]) for r in rows}) * 16 >= len(rows)
        return judge(rows, least, min_bytes)

    monkeypatch.setattr(passage_dedup, "first_documents", small)
    r = random.Random(5)
    word = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    tails = [word(60) for _ in range(5)]
    header = "#source: common crawl 2024-10#"
    texts = [word(40) + header + (r.choice(tails) if i % 4 == 0 else word(60)) for i in range(200)]
    got = result(passage_dedup.dedup_passages(frame(spark, texts), block_bytes=4000))
    want = brute([(x[0], x[1]) for x in rows(texts)], 50)
    assert got == want and sum(v[1] > 0 for v in want.values()) > 20


def test_null_ids_are_dealt_by_text(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(None, f"text {i} " * 20) for i in range(40)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")           # it would put small partitions together
    try:
        out = passage_dedup.dedup_passages(docs, block_bytes=500).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(out) == 40 and len({r.part for r in out}) > 1
