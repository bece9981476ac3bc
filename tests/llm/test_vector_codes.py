"""Vector codes against a plain version of the same rounds."""

import math

import numpy as np
import pytest

from tabforge.llm import vector_codes as V


def plain(rows, parts, entries, rounds, scale=4096):
    """rows: (id, vector, label).  Codes, errors and codebooks without any bounds."""
    kept = [(i, v, y) for i, v, y in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v], y) for i, v, y in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    d = len(kept[0][1]) // parts
    cut = [[v[p * d:(p + 1) * d] for p in range(parts)] for _, v, _ in kept]
    books = [[list(cut[j][p]) for j in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for c in cut:
                mine.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for j, xs in mine.items():
                books[p][j] = [sum(col) // len(xs) for col in zip(*xs)]
    out = []
    for (i, _, y), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, y, "".join(f"{j:02x}" for _, j in best), sum(e for e, _ in best)))
    return out, books


def frame(spark, rows):
    data = [(i, v, y, "x", 1) for i, v, y in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, code string, error int").repartition(3)


def same(got, want):
    def key(r):
        return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("seed,parts,entries,block", [(1, 2, 16, 50), (2, 8, 16, 4096), (3, 1, 5, 7)])
def test_codes(spark, monkeypatch, seed, parts, entries, block):
    monkeypatch.setattr(V, "BLOCK", block)
    r = np.random.default_rng(seed)
    dim = 16
    centres = r.normal(size=(9, dim))
    rows = [(i, (centres[i % 9] + r.normal(size=dim) * (0.05 if i % 2 else 0.4)).tolist(), [0, 1, None][i % 3]) for i in range(300)]
    rows += [(1000 + i, [round(float(c)) / 4 for c in r.normal(size=dim)], 5) for i in range(60)]        # ties
    rows += [(2000 + i, rows[4][1], 0) for i in range(30)]                                               # copies
    rows += [(3000, None, 1), (3001, [float("nan")] * dim, 1), (3002, [None] * dim, 1), (3003, [], 1), (3004, [1.0] * 8, 1),
             (3005, [float("inf")] * dim, 2), (None, rows[7][1], None), (5, rows[9][1], 2)]
    codes, books = V.compress(frame(spark, rows), parts=parts, entries=entries)
    want, want_books = plain(rows, parts, entries, V.ROUNDS)
    same([(x.vec_id, x.label, x.code, x.error) for x in codes.collect()], want)
    assert books.tolist() == want_books
    total = {}
    for _, y, _, e in want:
        total[y] = total.get(y, 0) + e
    got = V.with_label_error(codes).collect()
    assert len(got) == len(want) and all(x.label_error == total[x.label] for x in got)


def test_few_rows_and_none(spark):
    rows = [(3, [0.5, -0.25, 0.1, 2.0], 1), (1, [0.5, -0.25, 0.1, 2.0], 1), (2, [-1.0, 0.0, 0.0, 1.0], None)]
    codes, books = V.compress(frame(spark, rows), parts=2)
    want, want_books = plain(rows, 2, 16, V.ROUNDS)
    same([(x.vec_id, x.label, x.code, x.error) for x in codes.collect()], want)
    assert books.tolist() == want_books
    codes, books = V.compress(frame(spark, [(1, None, 2)]))
    assert codes.count() == 0 and books is None and codes.columns == ["vec_id", "label", "code", "error"]
    with pytest.raises(ValueError):
        V.compress(frame(spark, rows), parts=3)


def test_bounds_save_work_and_adapt():
    """After a small move nearly no entry is looked at, and b follows the need."""
    r = np.random.default_rng(4)
    entries = r.integers(-5000, 5000, (16, 8))
    x = entries[r.integers(16, size=2000)] + r.integers(-300, 300, (2000, 8))
    *state, _ = V.first_state(x, entries, 6)
    moved_to = entries + r.integers(-2, 3, entries.shape)
    moved = np.sqrt(((moved_to - entries) ** 2).sum(-1)) * (1 + 1e-6)
    state, own, (need, failed) = V.next_state(x, moved_to, moved, state)
    d = ((x[:, None] - moved_to[None]) ** 2).sum(-1)
    assert (own == d.min(1)).all() and (state[0][:, 0] == d.argmin(1)).all()
    assert need <= 2 and failed < 0.05
    order, low, outer = state
    assert (low <= np.sqrt(np.take_along_axis(d, order.astype(int), 1))).all()
    rest = d.copy()
    np.put_along_axis(rest, order.astype(int), np.iinfo(np.int64).max, 1)
    assert (outer <= np.sqrt(rest.min(1).astype(float))).all()
    assert V.adapted(6, need, failed, 16) == 5 and V.adapted(6, 6, 0.5, 16) == 8 and V.adapted(2, 1, 0.0, 16) == 2
    small = V.resized(state, x, moved_to, 3)
    rest = d.copy()
    np.put_along_axis(rest, small[0].astype(int), np.iinfo(np.int64).max, 1)
    assert small[0].shape[1] == 3 and (small[2] <= np.sqrt(rest.min(1).astype(float))).all()
