"""Toxicity, pieces, packing, licenses, personal data and top-k."""

import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import licenses, packing, pii, queries, sentencepieces, topk, toxicity
from tabforge.llm.queries import tokenizer

from .corpus import TEXTS, frame, rows

def test_many_matches_in_one_text(spark):
    """Thousands of matches, long gaps, wide characters: starts, context and masks as in the short case."""
    import time
    unit = "é日 mail a{0}@x.org, ssn: 078-05-1120; "
    sizes = [10, 1500, 5000]
    texts = ["".join(unit.format(i) for i in range(n)) + "🙂" * 9000 + " the number 078-05-1121 is a social security number" for n in sizes]
    took = []
    for i, t in enumerate(texts):
        at = time.time()
        row = pii.find_pii(spark.createDataFrame([(i, t)], "doc_id long, text string")).first()
        took.append(time.time() - at)
        want = [(m.start(), m.end()) for m in re.finditer(r"a\d+@x\.org", t)]
        assert [(s.start, s.end) for s in row.spans if s.kind == "email"] == want
        ssn = [(m.start(), m.end()) for m in re.finditer(r"078-05-112\d", t)]
        assert [(s.start, s.end) for s in row.spans if s.kind == "ssn"] == ssn
        df = pii.find_pii(spark.createDataFrame([(i, t)], "doc_id long, text string"))
        masked = df.select(pii.masked(F.col("text"), F.col("spans")).alias("m")).first().m
        assert masked == re.sub(r"078-05-112\d", "<SSN>", re.sub(r"a\d+@x\.org", "<EMAIL>", t))
    assert took[2] < 40


SF = "/root/testdata/sf0.01"


# --- toxicity ---------------------------------------------------------------

def test_toxicity_learns_and_holds_out(spark):
    r = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(300)]
    texts, ys = [], []
    for i in range(400):
        words = list(r.choice(plain, 40))
        if i % 4 == 0:
            words[r.integers(40)] = str(r.choice(["nastyfoo", "nastybar", "nastybaz", "vile"]))
        texts.append(" ".join(words))
        ys.append(int(i % 4 == 0))
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i * 3 + 1, y) for i, y in enumerate(ys)], "doc_id long, toxic int")
    fitted, _ = toxicity.train(docs, labels.where("doc_id < 900"), min_lang_rows=8)
    got = {x.doc_id: x for x in toxicity.score(docs, fitted).collect()}
    held = [i for i in range(300, 400)]
    assert np.mean([(got[i * 3 + 1].score >= 0.5) == ys[i] for i in held]) >= 0.95
    assert {x.of_lang for x in fitted.by_lang.collect()} == {"en", "fr"}
    kept = toxicity.reject(docs, fitted)
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.collect()} == {i for i, x in got.items() if not x.flagged}


def test_toxicity_edge_cases(spark):
    docs = frame(spark, repeat=True, with_null_id=True)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    fitted, scores = toxicity.train(docs, none)
    got = toxicity.judged(scores, fitted).collect()
    assert len(got) == len(TEXTS) + 9 and {x.score for x in got} == {0.0} and not any(x.flagged for x in got)
    one = spark.createDataFrame([(i * 3 + 1, int(i % 3 == 0)) for i in range(30)] + [(None, 1), (4, None)], "doc_id long, toxic int")
    fitted, _ = toxicity.train(docs, one)
    scores = {x.doc_id: x.score for x in toxicity.score(docs, fitted).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert toxicity.score(docs.limit(0), fitted).count() == 0


def test_long_texts_score_as_whole(monkeypatch):
    r = np.random.default_rng(2)
    docs = [np.array([toxicity.word_buckets(f"w{x}") for x in r.integers(0, 50, 30)]) for _ in range(60)]
    model = toxicity.fit(docs, [int((d[:, 0] == toxicity.word_buckets("w7")[0]).any()) for d in docs])
    texts = [" ".join(f"w{x}" for x in r.integers(0, 50, n)) for n in (0, 1, 5, 1000)]
    whole = toxicity.score_texts(model, texts)
    monkeypatch.setattr(toxicity, "SLICE_WORDS", 7)
    assert np.allclose(whole, toxicity.score_texts(model, texts), atol=1e-6)


def test_score_is_a_convolution_with_max_pooling():
    r = np.random.default_rng(3)
    docs = [np.array([toxicity.word_buckets(f"w{x}") for x in r.integers(0, 30, 20)]) for _ in range(50)]
    m = toxicity.fit(docs, [i % 2 for i in range(50)])
    d = docs[3]
    e = m.embedding[d[:, 0]] + m.embedding[d[:, 1]]
    pads = np.vstack([e, np.zeros((max(toxicity.WIDTHS), e.shape[1]), e.dtype)])
    pool, at = [], 0
    for w in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            cols = [m.kernels[:, at + j * toxicity.FILTERS + f] for j in range(w)]
            pool.append(max(sum(pads[t + j] @ cols[j] for j in range(w)) for t in range(len(d))))
        at += w * toxicity.FILTERS
    part, starts = toxicity.flat([d])
    got, _ = m.pooled(m.project(part), starts)
    assert np.allclose(got[0][: len(toxicity.WIDTHS) * toxicity.FILTERS], pool[: got.shape[1]], atol=1e-4)


# --- pieces -----------------------------------------------------------------

def test_viterbi_against_brute_force():
    pieces, of_byte = sentencepieces.load_pieces(tokenizer("piece_bpe_32k.model"))
    enc = sentencepieces.Encoder(pieces, of_byte)
    score = {p: s for p, _, s in pieces}
    for text in [" the nation", " Wha tion", " été", " 日本x", "aaaaaaa", "   ", " ▁ ", "🙂a"]:
        best = [0.0] + [-np.inf] * len(text)
        for i in range(1, len(text) + 1):
            best[i] = best[i - 1] + sentencepieces.BYTE_COST * len(text[i - 1].encode())
            for j in range(i):
                if text[j:i] in score:
                    best[i] = max(best[i], best[j] + score[text[j:i]])
        ids = enc.viterbi(text)
        total = sum(score[enc.text[i]] if i in enc.text else sentencepieces.BYTE_COST for i in ids)
        assert total == best[-1], text


def test_chunks_do_not_change_the_result():
    enc = sentencepieces.Encoder(*sentencepieces.load_pieces(tokenizer("piece_bpe_32k.model")))
    for t in TEXTS:
        if t and len(t) < 3000:
            assert enc.encode(t) == enc.viterbi(" " + t)


def test_piece_round_trip(spark):
    model = tokenizer("piece_bpe_32k.model")
    docs = frame(spark, repeat=True, with_null_id=True)
    texts = {r[0]: r[1] or "" for r in rows()}
    once = {r.doc_id: r.decoded for r in sentencepieces.round_trip(docs, model).collect() if r.doc_id}
    assert once == texts
    again = sentencepieces.decode(sentencepieces.encode(docs, model), model).collect()
    assert len(again) == len(TEXTS) + 9
    assert {r.doc_id: r.text for r in again if r.doc_id} == texts
    assert sentencepieces.encode(docs.limit(0), model).count() == 0


# --- packing ----------------------------------------------------------------

def test_ids_are_those_of_tokenizers(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [x[0] for x in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(300).collect()] + [x or "" for x in TEXTS]
    enc = packing.ChunkEncoder(packing.byte_bpe_encoder(tokenizer("byte_bpe_50k.json")).encode_ordinary)
    want = t.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(enc(x), np.uint32).tolist() for x in texts] == [x.ids for x in want]


def test_pack(spark):
    pieces = packing.tokenize(frame(spark, repeat=True), tokenizer("byte_bpe_50k.json"))
    got = packing.pack(pieces, shard_pieces=20).collect()
    full = {}
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length <= 1024 and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        full.setdefault(r.doc_id, {})[r.piece] = r
    for doc in full.values():
        parts = [doc[k] for k in range(len(doc))]
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        assert all(p.length == 1024 for p in parts[1:])
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024
    assert packing.pack(packing.tokenize(frame(spark).limit(0), tokenizer("byte_bpe_50k.json"))).count() == 0
    assert full[13][0].length == 1          # a null text: the end id alone


def test_later_rounds_fill_what_shards_leave_open(spark):
    r = np.random.default_rng(3)
    lengths = np.minimum(r.lognormal(5.5, 1.0, 12_000).astype(int) + 1, 1024)
    df = spark.createDataFrame([(i, 0, int(n)) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    df = df.unionByName(spark.createDataFrame([(None, 0, 5), (None, 0, 5), (None, 1, 1024)], df.schema))
    got = packing.pack(df, shard_pieces=300).collect()
    bins = {}
    for x in got:
        bins.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert sorted((x.doc_id or -1, x.length) for x in got) == sorted((x.doc_id or -1, x.length) for x in df.collect())
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024
    bound = -(-sum(x.length for x in got) // 1024)
    one_round = packing.pack_shards(df, 40, 0, 1024).select("sequence_id").distinct().count()
    assert len(bins) <= 1.006 * bound < one_round


def test_pieces_that_fill_nothing_end(spark):
    df = spark.createDataFrame([(i, 0, 600) for i in range(500)], "doc_id long, piece int, length long")
    got = packing.pack(df, shard_pieces=20).collect()
    assert len({x.sequence_id for x in got}) == 500 and {x.offset for x in got} == {0}


def test_sum_of_squares_takes_the_best_gap():
    r = np.random.default_rng(4)
    lengths = r.integers(1, 33, 300)
    bins, offsets = packing.sum_of_squares(lengths, 32)
    left, counts = {}, np.zeros(33, int)
    for s, b, o in zip(lengths, bins, offsets):
        def total(gap):
            c = counts.copy()
            if gap < 32:
                c[gap] -= 1
            if gap - s:
                c[gap - s] += 1
            return int((c ** 2).sum())
        options = {g: total(g) for g in [*np.flatnonzero(counts[:32]), 32] if g >= s}
        gap = left.get(b, 32)
        assert o == 32 - gap and options[gap] == min(options.values())
        if gap < 32:
            counts[gap] -= 1
        left[b] = gap - s
        if gap - s:
            counts[gap - s] += 1


def test_thresholds_use_all_labelled_rows(spark):
    import random
    r = random.Random(4)
    data = [(i, " ".join(r.choice("one two three four five six".split()) for _ in range(12)) + (" vile awful" if i % 3 == 0 else "")
             + (" filler" * 300 if i % 20 == 7 else ""), "xx" if i % 20 == 7 or i % 20 == 9 else "en", int(i % 3 == 0)) for i in range(600)]
    docs = spark.createDataFrame([x[:3] for x in data], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(x[0], x[3]) for x in data], "doc_id long, toxic int")
    model, used = toxicity.fit_sample(docs, labels, max_rows=60, max_chars=1000)
    scores = toxicity.score_table(docs, model)
    base, by_lang = toxicity.calibrate(scores, labels, used)
    # the same thresholds from all unused labelled rows, each standing for its share of its class
    label, seen = {x[0]: x[3] for x in data}, {i for i, _ in used}
    rows = [(x.doc_id, x.lang, round(x.score, 4)) for x in scores.collect()]

    def slow(lang=None):
        mine = [(s, label[i], i in seen) for i, l, s in rows if lang in (None, l)]
        weight = {y: sum(m[1] == y for m in mine) / sum(m[1] == y and not m[2] for m in mine) for y in (0, 1)}
        fresh = sorted({m[0] for m in mine if not m[2]})

        def f1(cut):
            tp = sum(weight[1] for s, y, u in mine if not u and y and s >= cut)
            return 2 * tp / (sum(weight[y] for s, y, u in mine if not u and s >= cut) + sum(weight[1] for _, y, u in mine if not u and y))
        best = max(fresh, key=lambda c: (round(f1(c), 12), c))
        below = [s for s in fresh if s < best]
        return (best + (below[-1] if below else 0.0)) / 2

    assert base == pytest.approx(slow())
    got = {x.of_lang: x.own_threshold for x in by_lang.collect()}
    assert set(got) == {"en", "xx"}
    assert all(got[k] == pytest.approx(slow(k)) for k in got)
    # a weighted row counts as often as its weight says
    assert toxicity.f1_threshold([0.7, 0.5, 0.3], [1, 0, 1], [1, 9, 1]) == toxicity.f1_threshold([0.7] + [0.5] * 9 + [0.3], [1] + [0] * 9 + [1])


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_toxicity_query_on_held_out_labels(spark):
    got = queries.op3_toxicity(spark, SF).where("held_out").select("doc_id", "score")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic IS NOT NULL").select("doc_id", "toxic")
    rows = [(x.score, x.toxic) for x in got.join(labels, "doc_id").collect()]
    good, bad = ([s for s, y in rows if y == k] for k in (1, 0))
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc >= 0.85


# --- licenses ---------------------------------------------------------------

def base_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def longest_chain(auto, matches, k):
    """Most words that any chain of matches covers, by trying all of them."""
    def go(e, t_e, covered, rest):
        best = covered
        for i, (v, length, end) in enumerate(rest):
            for kk, at in auto.ends[v]:
                start, t_start = end - length + 1, at - length + 1
                if kk != k:
                    continue
                if e is None:
                    best = max(best, go(end, at, length, rest[i + 1:]))
                else:
                    fresh = min(length, end - e, at - t_e)
                    if start - e <= licenses.GAP and t_start - t_e <= licenses.GAP and fresh > 0:
                        best = max(best, go(end, at, covered + fresh, rest[i + 1:]))
        return best
    return go(None, None, 0, matches)


def test_chains_against_all_chains(monkeypatch):
    import random
    monkeypatch.setattr(licenses, "MIN_MATCH", 2)
    monkeypatch.setattr(licenses, "COVER", 0.4)
    r = random.Random(6)
    words = "a b c d e f g h".split()
    template = " ".join(words)
    auto = licenses.Automaton([("x y", "p")], [(template, "t")])
    for _ in range(200):
        t = []
        for _ in range(r.randint(1, 4)):
            lo = r.randint(0, 6)
            t += words[lo:r.randint(lo + 1, 8)] + ["z"] * r.randint(0, 2)
        _, _, matches = licenses.scan(auto, " ".join(t).encode())
        best = longest_chain(auto, matches, 0)
        got = licenses.chain(auto, matches).get(0, [])
        assert bool(got) == (best >= 0.4 * 8)
        assert all(c >= 0.4 * 8 for c, _, _ in got)
        assert all(a[2] < b[1] for a, b in zip(got, got[1:]))                        # apart, in text order
        assert not got or sum(c for c, _, _ in got) >= best


def test_a_license_that_stands_twice_is_found_twice(spark):
    mit = licenses.WHOLE[0][0]
    texts = [mit + "\n\n" + "filler words here " * 50 + mit, mit, mit.split("THE SOFTWARE IS")[0], licenses.WHOLE[4][0] + " " + licenses.WHOLE[1][0], "nothing"]
    df = frame(spark, texts, repeat=True, with_null_id=True)
    got = licenses.scan_licenses(df, templates=licenses.WHOLE).collect()
    assert len(got) == len(texts) * 2 + 3
    want = {1: ["mit", "mit"], 4: ["mit"], 7: ["mit"], 10: ["apache-2", "isc"], 13: []}
    for row in got:
        if row.doc_id is not None:
            assert sorted(s.label for s in row.spans) == want[row.doc_id]
    whole = next(r for r in got if r.doc_id == 1)
    first, second = sorted((s.start, s.end, s.cover) for s in whole.spans)
    assert first[1] <= second[0] and first[2] == second[2] == 1.0
    table = spark.createDataFrame([(mit, "own", 1), (None, "x", 2), (mit, "own", 3)], "text string, label string, n int")
    own = licenses.scan_licenses(df, templates=licenses.templates_of(table)).where("doc_id = 4").first()
    assert [s.label for s in own.spans] == ["own"]


def test_license_places(spark):
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark)).collect()}
    for i, text, *_ in rows():
        words = base_words(text)
        want = sorted((s, s + len(p.split()), label) for p, label in licenses.PHRASES for s in range(len(words))
                      if words[s:s + len(p.split())] == p.encode().split())
        assert got[i].n_words == len(words)
        assert [tuple(x) for x in got[i].places] == want
    spans = {label for r in got.values() for label in [x.label for x in r.spans]}
    assert spans >= {"mit", "bsd"}
    assert licenses.scan_licenses(frame(spark).limit(0)).count() == 0


def test_matching_statistics(monkeypatch):
    auto = licenses.Automaton([("a b c", "x")], [("a b c d e f", "t"), ("b c a b d", "u")])
    texts = ["a b c d e f", "b c d a b c a b d q a b c d", "q", "", "a b c a b c", "c a b d e f a"]
    for size in (1 << 20, 3):
        for t in texts:
            words = t.split()
            lengths = []
            for i in range(len(words)):
                lengths.append(max([n for n in range(i + 2) if n == 0 or any(
                    words[i + 1 - n:i + 1] == w[k:k + n] for w in ("a b c d e f".split(), "b c a b d".split(), "a b c".split()) for k in range(len(w)))]))
            want = [(n, i) for i, n in enumerate(lengths) if n >= 4 and (i + 1 == len(words) or lengths[i + 1] != n + 1)]
            monkeypatch.setattr(licenses.word_slices, "__defaults__", (size,))
            n, places, matches = licenses.scan(auto, t.encode())
            assert n == len(words)
            assert [(length, end) for _, length, end in matches] == want
            assert sorted(places) == [(0, i) for i in range(len(words)) if words[i:i + 3] == ["a", "b", "c"]]


# --- personal data ----------------------------------------------------------

def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def brute_pii(text):
    n = lambda s: len(re.sub("[^0-9]", "", s))
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= n(s) <= 19 and luhn(s)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= n(s) <= 15),
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in rules for m in re.finditer(p, text or "") if ok(m[0])]


def test_pii_base_spans(spark):
    got = pii.find_pii(frame(spark, repeat=True)).select("doc_id", pii.digest(pii.of_kinds(F.col("spans"), pii.BASE)).alias("d"),
                                                         pii.digest(F.col("spans")).alias("all")).collect()
    assert len(got) == len(TEXTS) + 6
    want = {r[0]: ",".join(brute_pii(r[1])) for r in rows()}
    assert {r.doc_id: r.d for r in got} == want
    assert sum(map(bool, want.values())) >= 2
    every = " ".join(r["all"] for r in got)
    assert "iban" in every and "ssn" in every
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = pii.find_pii(docs).select("text", pii.digest(pii.of_kinds(F.col("spans"), pii.BASE)).alias("d")).collect()
    assert [r.d for r in got] == [",".join(brute_pii(r.text)) for r in got]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_checksums_and_mask(spark):
    df = spark.createDataFrame([("4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"), ("4111111111111112", "DE00 3704 0044 0532 0130 00")], "a string, b string")
    assert [tuple(r) for r in df.select(pii.luhn(F.col("a")), pii.mod97(F.col("b"))).collect()] == [(True, True), (False, False)]
    df = spark.createDataFrame([(1, "ü a@b.cd ü +49 30 1234567 x"), (2, None), (3, "none")], "doc_id long, text string")
    got = pii.find_pii(df).select(pii.masked(F.col("text"), F.col("spans")).alias("m")).collect()
    assert [r.m for r in got] == ["ü <EMAIL> ü <PHONE> x", None, "none"]


def test_context_counts_on_both_sides(spark):
    far = "x " * 60
    texts = ["078-05-1120 (my SSN)", "the number 078-05-1120 is a social security number", "my ssn 078-05-1120", "no 078-05-1120 " + far + "ssn", "078-05-1120"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.m for r in pii.find_pii(df).select("doc_id", pii.masked(F.col("text"), F.col("spans")).alias("m")).collect()}
    assert got == {0: "<SSN> (my SSN)", 1: "the number <SSN> is a social security number", 2: "my ssn <SSN>", 3: texts[3], 4: texts[4]}


# --- top-k ------------------------------------------------------------------

@pytest.mark.parametrize("shard,block", [(7, 2), (1000, 1000)])
def test_top_k(spark, shard, block):
    r = np.random.default_rng(6)
    vecs = {i: np.floor(r.normal(0, 0.1, 6) * 50).astype(int) / 256.0 for i in range(200)}
    vecs[200] = np.zeros(6)
    vecs[7] = vecs[9].copy()
    data = [(i, [float(x) for x in v]) for i, v in vecs.items()]
    bad = [(300, None), (350, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (400, [float("nan")] * 6), (450, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(data + bad + data[:5], "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).repartition(4)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, shard=shard, query_block=block).collect()
    want = []
    for q in range(0, 201, 50):
        e = {i: np.floor(256 * v).astype(int) for i, v in vecs.items()}
        best = sorted(((-int(e[q] @ e[i]), i) for i in e if i != q))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(x) for x in got) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_threshold_stops_early():
    r = np.random.default_rng(7)
    v = (r.normal(0, 1, (4000, 3)) * 100).astype(np.int64)
    lists = topk.Lists(np.arange(4000), v)
    q = np.array([[50, -20, 30]])
    limits = lists.thresholds(q)[:, 0]
    ids, scores = lists.search(q[0], -1, 5, limits)
    want = sorted(range(4000), key=lambda i: (-int(v[i] @ q[0]), i))[:5]
    assert ids.tolist() == want
    assert limits[200] < scores[-1]
