"""Exact, line, passage and near dedup against brute force."""

import pytest
import xxhash

from tabforge.llm import components, exact_dedup, line_dedup, simhash

from .corpus import TEXTS, frame, rows, sha

WS = " \t\n\x0b\f\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_lines(data):
    first = {}
    keyed = {}
    for i, t in data:
        lines = (t or "").split("\n")
        keyed[i] = [(x, x.strip(WS).translate(LOWER)) for x in lines]
        for _, k in keyed[i]:
            if len(k) >= 10:
                first[k] = min(first.get(k, i), i)
    out = {}
    for i, ls in keyed.items():
        kept = [x for x, k in ls if len(k) < 10 or first[k] == i]
        out[i] = (len(ls), len(ls) - len(kept), sha("\n".join(kept)))
    return out


@pytest.mark.parametrize("batches,fanout", [(1, 3), (5, 2)])
def test_line_dedup(spark, batches, fanout):
    got = line_dedup.dedup_lines(frame(spark, repeat=True), batches=batches, fanout=fanout).collect()
    want = brute_lines([(r[0], r[1]) for r in rows()])
    assert len(got) == len(TEXTS) + 6
    assert {r.doc_id: (r.n_lines, r.n_dropped, sha(r.text or "")) for r in got} == want
    assert any(v[1] for v in want.values())
    assert all(r.rest.pos == "p" for r in got)


def test_line_dedup_null_ids_and_empty(spark):
    got = line_dedup.dedup_lines(frame(spark, ["a shared heading line"] * 2, with_null_id=True)).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 0), (0, 0), (1, 0), (4, 1)]
    assert line_dedup.dedup_lines(frame(spark).limit(0)).count() == 0


def brute_exact(data):
    groups = {}
    for i, t in data:
        groups.setdefault(t or "", []).append(i)
    return {i: (max(g), len(g), i == max(g), sha(t)) for t, g in groups.items() for i in g}


@pytest.mark.parametrize("block", [16, 4096])
def test_exact_dedup(spark, block):
    got = exact_dedup.exact_duplicates(frame(spark, repeat=True), block_bytes=block).collect()
    assert len(got) == len(TEXTS) + 6
    repeated = rows() + rows()[:6]
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute_exact([(r[0], r[1]) for r in repeated])


def test_exact_dedup_counts_repeated_rows_as_its_sql_does(spark):
    import duckdb

    from tabforge.llm.queries import ORACLE
    data = [(1, "same"), (1, "same"), (2, "same"), (3, None), (3, ""), (4, "x" * 9000), (4, "x" * 9000), (5, "other"), (5, "x" * 9000)]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(data, "doc_id long, text string"), block_bytes=4096).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", data)
    cur = con.execute(ORACLE["op7_exact_dedup"])
    names = [d[0] for d in cur.description]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(cur.fetchall())


def test_exact_dedup_hot_contents(spark):
    texts = ["hot text " * 9] * 300 + [f"text {i % 150}" for i in range(300)]
    got = exact_dedup.exact_duplicates(frame(spark, texts), block_bytes=8).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute_exact([(r[0], r[1]) for r in rows(texts)])


def test_exact_dedup_null_ids_and_empty(spark):
    got = exact_dedup.exact_duplicates(frame(spark, ["p", "q"], with_null_id=True)).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in got) == [(0, 1, 2, False), (0, 4, 2, False), (1, 1, 2, True), (4, 4, 2, True)]
    assert exact_dedup.exact_duplicates(frame(spark).limit(0)).count() == 0


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=3):
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_fingerprints_and_components(spark):
    got = simhash.near_duplicates(frame(spark, repeat=True)).collect()
    fps = {r[0]: brute_fingerprint(r[1]) for r in rows()}
    assert len(got) == len(TEXTS) + 6
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == brute_components(fps)


def test_long_text_in_slices(monkeypatch):
    want = brute_fingerprint(TEXTS[-4])
    monkeypatch.setattr(simhash, "SLICE", 100)
    assert simhash.fingerprint((TEXTS[-4]).encode()) == want


@pytest.mark.parametrize("group", [8, 512])
def test_links_of_crowded_groups(spark, group):
    import random

    r = random.Random(3)
    centre = [r.getrandbits(64) for _ in range(6)]
    values = set()
    for c in centre:
        for _ in range(60):
            v = c
            for _ in range(r.randint(0, 5)):
                v ^= 1 << r.randrange(64)
            values.add(v)
    values |= {r.getrandbits(64) for _ in range(100)}
    fps = dict(enumerate(sorted(values)))
    nodes = spark.createDataFrame([(i, simhash.signed(f)) for i, f in fps.items()], "node long, fp long")
    found = components.components(simhash.links(nodes, group=group)).collect()
    want = brute_components(fps)
    assert {i: dict(found).get(i, i) for i in fps} == want


def test_simhash_null_ids_and_empty(spark):
    got = simhash.near_duplicates(frame(spark, ["some text of words", "other"], with_null_id=True)).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 1), (0, 4), (1, 1), (4, 4)]
    assert simhash.near_duplicates(frame(spark).limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(9, 9), (3, 1), (1, 3)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 700)}, 1: 1, 3: 1}
