"""Chosen-path near duplicates against all pairs of full sets."""

import random

import numpy as np
import pytest

from tabforge.llm import chosen_path as P

from .corpus import TEXTS, frame
from .test_dedup_ops import LOWER


def shingles(text, k=2):
    words = (text or "").translate(LOWER).encode().split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(data, percent=80):
    """data: (id, text).  Repeated ids are one document."""
    sets = [(i, shingles(t)) for i, t in data]
    up = {i: i for i, _ in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((top(i), top(j)))
                up[q] = p
    return {(i, len(s), top(i)) for i, s in sets}


def near_texts(seed, groups=12, copies=8, words=60):
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{r.randint(0, 3000)}" for _ in range(words)]
        for _ in range(copies):
            t = list(base)
            for _ in range(r.randint(0, 8)):                     # similarities on both sides of the threshold
                t[r.randrange(words)] = f"x{r.randint(0, 9)}"
            out.append(" ".join(t))
    return out


def check(df, **options):
    got = P.near_duplicates(df, **options).collect()
    rows = df.collect()
    assert len(got) == len(rows)
    assert {(x.doc_id, x.n_shingles, x.component_id) for x in got if x.doc_id is not None} == brute([(r.doc_id, r.text) for r in rows if r.doc_id is not None])
    assert all(x.kept == (x.doc_id is None or x.doc_id == x.component_id) for x in got)
    return got


def test_near_duplicates(spark):
    texts = list(TEXTS) + near_texts(1)
    got = check(frame(spark, texts, repeat=True, with_null_id=True))
    assert 20 < sum(not x.kept for x in got) and all(x.component_id is None for x in got if x.doc_id is None)


@pytest.mark.parametrize("small,group_bytes", [(4, 16 << 20), (512, 2000), (16, 6000)])
def test_crowds_go_through_blocks(spark, small, group_bytes):
    """Large children and groups, with and without a part that holds most of them."""
    r = random.Random(7)
    base = [f"w{i}" for i in range(40)]
    crowd = [" ".join(w if r.random() > 0.03 else f"y{r.randint(0, 99)}" for w in base) for _ in range(60)]
    shared = [" ".join(base[:22] + [f"z{r.randint(0, 9999)}" for _ in range(18)]) for _ in range(40)]
    check(frame(spark, crowd + shared + near_texts(3, 4, 12)), small=small, group_bytes=group_bytes)


def test_one_id_with_several_texts(spark):
    a, b, c = near_texts(5, 3, 1)
    df = spark.createDataFrame([(5, a), (7, a), (5, b), (9, b + " more"), (11, c), (11, c), (4, "")], "doc_id long, text string")
    got = {(x.doc_id, x.component_id) for x in check(df)}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 11), (4, 4)}


def test_links_at_the_threshold(spark):
    """|A| = |B| = 90, 80 shared: 80 of 100 links, 79 of 101 does not."""
    words = [f"a{i}" for i in range(200)]
    one = " ".join(words[:91])
    df = spark.createDataFrame([(1, one), (2, " ".join(words[10:91] + [f"b{i}" for i in range(10)])),
                                (3, " ".join([f"c{i}" for i in range(300)])), (4, " ".join([f"c{i}" for i in range(31, 300)] + [f"d{i}" for i in range(31)]))],
                               "doc_id long, text string")
    got = {(x.doc_id, x.component_id) for x in check(df)}
    assert (2, 1) in got


def test_bounds():
    least, n = P.least_agreement(), P.trees()
    r = np.random.default_rng(1)
    assert 70 <= least <= 90 and 3 <= n <= 6
    assert (r.binomial(P.ROW, 0.8, 200_000) < least).sum() <= 2
    keys, odd = P.functions(P.ROW)
    agree = []
    for _ in range(200):
        pool = r.integers(0, 1 << 64, 500, np.uint64)
        a, b = P.minwise(pool[:450], keys, odd), P.minwise(pool[50:], keys, odd)      # similarity 0.8
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 0.8) < 0.01 and np.std(agree) < 0.05


def test_no_rows(spark):
    assert P.near_duplicates(frame(spark).limit(0)).count() == 0
    got = P.near_duplicates(frame(spark, [None, "", "a"])).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got) == [(1, 0, 1, True), (4, 0, 4, True), (7, 1, 7, True)]
