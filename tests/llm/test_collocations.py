"""Collocations against counting every phrase of every text."""

import random
import re
from collections import Counter

import pytest

from tabforge.llm import collocations as C

from .corpus import TEXTS, frame

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(data, min_count=10, max_words=3, top=2000, inside=50):
    """data: (lang, text)."""
    f, total = {}, Counter()
    for lang, text in data:
        counts = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            counts.update(tuple(words[i:i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1))
    out = set()
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            held = any(len(q) > len(p) and 100 * b >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                       for q, b in cand.items() if len(q) > len(p))
            if not held:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return out


def made(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["a", "b", "c", "É", "é", "日本", "x y", "New", "york", "city", "\x00", "d-e"]
    shared = "the quick New York city hall, of a New York city"
    out = []
    for i in range(n):
        words = [r.choice(vocabulary) + r.choice(["", "", "", "", ".", ",", "\n", "\t", "  "]) for _ in range(r.randint(0, 40))]
        if i % 3 == 0:
            words.insert(r.randint(0, len(words)), shared)
        out.append(" ".join(words))
    return out + [None, "", " ", "...", "word", "again and " * 500, "x" * 3000]


@pytest.mark.parametrize("modulus,longest,held,bucket,bits", [(16, 2000, 1 << 24, 4_000_000, 24), (1, 3, 300, 20, 8), (3, 4, 3000, 100, 16)])
def test_collocations(spark, monkeypatch, modulus, longest, held, bucket, bits):
    """Also with tiny chunks, blocks and buckets, and with keys that often clash."""
    for name, value in (("MODULUS", modulus), ("LONGEST", longest), ("HELD_BYTES", held), ("BLOCK_BYTES", held), ("BUCKET", bucket), ("KEY_BITS", bits)):
        monkeypatch.setattr(C, name, value)
    texts = made(1) + made(1)[:20] + made(2)
    df = frame(spark, texts, repeat=True, with_null_id=True)
    got = {tuple(r) for r in C.collocations(df).collect()}
    want = brute([(r.lang, r.text) for r in df.collect()])
    assert got == want and len(got) > 10
    assert {r[0] for r in got} == {"en", "fr", "und"}


def test_longer_phrases_and_top(spark):
    df = frame(spark, made(5, 80) + [t for t in TEXTS if t and len(t) < 20000])
    got = {tuple(r) for r in C.collocations(df, min_count=4, max_words=4, top=7, inside=80).collect()}
    assert got == brute([(r.lang, r.text) for r in df.collect()], 4, 4, 7, 80)


def test_parse_owns_every_position_once():
    import zlib
    data = " ".join(made(3, 20)[:20]).encode()
    toks = C.tokens(data)
    chunks = C.parse(data, 2, C._Hashes())
    owned = [t for c in chunks for t in c.split(b" ")[:-2]]
    assert owned == toks and len(chunks) > 5
    # the same passage gives the same chunks wherever it stands
    passage = " ".join(f"w{zlib.crc32(str(i).encode()) % 999}" for i in range(200)).encode()
    a, b = (set(C.parse(p + passage + q, 2, C._Hashes())) for p, q in ((b"one two ", b" end"), (b"quite another start, ", b"")))
    assert len(a & b) >= len(a) - 4


def test_large_products_are_exact(spark):
    big = 10**11 + 7
    counts = spark.createDataFrame([("en", "p q", big - 1), ("en", "p", big), ("en", "q", big + 5)], "lang string, phrase string, f long")
    r = C.candidates(counts).first()
    assert (r.a, r.l, r.r, r.score) == (big - 1, big, big + 5, 10**6 * (big - 1) ** 2 // (big * (big + 5)))


def test_no_rows(spark):
    assert C.collocations(frame(spark).limit(0)).count() == 0
    assert C.collocations(frame(spark, [None, "", "one"])).count() == 0
