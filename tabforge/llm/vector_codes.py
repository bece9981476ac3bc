"""Product codes of vectors, by Lloyd rounds with Drake-Hamerly adaptive bounds.

A vector's components become integers and are cut into equal parts; every part
position has a codebook of its own.  Between rounds each part keeps the order
of its ``b`` closest entries, a lower bound of the distance to each, and one
outer bound for all entries not listed.  When entries have moved, the bounds
shrink by as much; an entry is looked at again only if its bound does not
exceed the distance to the part's own entry, and all entries only if the outer
bound does not.  What is looked at is decided by integer distances, so bounds
(rounded down) never change a result.  ``b`` adapts to how many entries a
block had to look at: it grows where outer bounds fail and shrinks where few
entries were needed.

Vectors lie in blocks of up to ``BLOCK`` rows, one table row each; a round
reads the blocks and writes them with their new bounds, and each task's last
block carries the task's sums.  Only codebooks (parts x entries x part length
integers) reach the driver; the state of the round before is deleted.

Edge cases: a vector that is null, empty, or holds a null or non-finite
component, or that has another length than the first kept one (smallest id), is
dropped; a length that the parts do not divide is an error, and so is a scaled
component so large (:func:`limit`, 2^27 by default) that a distance could leave
64 bits.  Rows with a null id come last for the initial codebook and are coded
like others; of rows with one id the smaller integer vector comes first.  Fewer
kept rows than entries give as many entries as rows.  No rows give no rows.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Vectors of a block.
BLOCK = 4096
#: Entries listed at first, and the limits of the adaptive number.
LISTED, FEWEST = 6, 2


def limit(length: int, entries: int) -> int:
    """Scaled components stay below this, so that squared distances of parts of
    this length, times the number of entries, stay below 2^63."""
    return min(math.isqrt((1 << 63) // (4 * length * entries)), 1 << 30)


def integers(rows, scale: int, largest: int):
    """floor(scale * x) of a 2-d float array."""
    import numpy as np

    out = np.floor(rows.astype(np.float64) * scale)
    if out.size and np.abs(out).max() >= largest:
        raise ValueError(f"a scaled component reaches {largest}: distances could leave 64 bits")
    return out.astype(np.int64)


def _squares(x, entries):
    """Squared distances of all parts (n, d) to all entries (k, d)."""
    return ((x[:, None, :] - entries[None]) ** 2).sum(-1)


def _low(squares):
    """Lower bounds of the roots, as 4-byte floats rounded down."""
    import numpy as np

    r = np.sqrt(squares.astype(np.float64)) * (1 - 1e-9)
    out = r.astype(np.float32)
    return np.where(out > r, np.nextafter(out, np.float32(-1)), out)


def _ranked(x, entries, b: int):
    """State of parts that look at all entries: (order, bounds, outer, squares of the first)."""
    import numpy as np

    d = _squares(x, entries)
    order = np.argsort(d, axis=1, kind="stable")             # ties to the lower index
    sorted_d = np.take_along_axis(d, order, 1)
    k = len(entries)
    outer = _low(sorted_d[:, b]) if b < k else np.full(len(x), np.inf, np.float32)
    return order[:, :b].astype(np.uint8), _low(sorted_d[:, :b]), outer, sorted_d[:, 0]


def first_state(x, entries, b: int = LISTED):
    return _ranked(x, entries, min(b, len(entries)))


def next_state(x, entries, moved, state):
    """Assign parts ``x`` (n, d) after the entries moved by ``moved`` (k upper
    bounds).  Returns (state, squares to the own entry, entries looked at)."""
    import numpy as np

    order, low, outer = state
    n, b = order.shape
    k = len(entries)
    # how far bounds can have shrunk
    low = np.nextafter(low - moved[order].astype(np.float32), np.float32(-np.inf))
    outer = np.nextafter(outer - np.float32(moved.max(initial=0.0)), np.float32(-np.inf)) if b < k else outer
    own = ((x - entries[order[:, 0]]) ** 2).sum(-1)
    at = np.sqrt(own.astype(np.float64)) * (1 + 1e-9)
    wide = outer <= at                                       # something not listed may be as close
    open_ = (low <= at[:, None]) & ~wide[:, None]
    open_[:, 0] = False
    row, pos = np.nonzero(open_)
    squares = ((x[row] - entries[order[row, pos]]) ** 2).sum(-1)
    low[row, pos] = _low(squares)
    # the closest of the own entry and those looked at; ties to the lower index
    best = own * k + order[:, 0]
    np.minimum.at(best, row, squares * k + order[row, pos])
    low[:, 0] = _low(own)
    changed = (best % k != order[:, 0]) & ~wide
    new_own = best // k
    # the listed entries stay in order of their bounds, the chosen one in front
    key = low.astype(np.float64)
    key[order == (best % k)[:, None]] = -np.inf
    again = np.flatnonzero(changed | (np.diff(key, axis=1) < 0).any(1))
    perm = np.argsort(key[again], axis=1, kind="stable")
    order, low = order.copy(), low
    order[again] = np.take_along_axis(order[again], perm, 1)
    low[again] = np.take_along_axis(low[again], perm, 1)
    if wide.any():
        o, l, t, d = _ranked(x[wide], entries, b)
        order[wide], low[wide], outer[wide], new_own[wide] = o, l, t, d
    looked = open_.sum(1) + 1
    need = int(np.quantile(looked[~wide], 0.99, method="higher")) if (~wide).any() else b
    return (order, low, outer), new_own, (need, float(wide.mean()) if n else 0.0)


def adapted(b: int, need: int, failed: float, k: int) -> int:
    """Entries to list from now on: two more where outer bounds failed for over
    a tenth of the parts, one fewer where nearly all parts needed fewer."""
    if failed > 0.1:
        return min(k, b + 2)
    if need < b - 1:
        return max(min(FEWEST, k), b - 1)
    return b


def resized(state, x, entries, b: int):
    """The state with ``b`` listed entries: the bounds cut off go into the outer one."""
    import numpy as np

    order, low, outer = state
    have = order.shape[1]
    if b < have:
        return order[:, :b], low[:, :b], np.minimum(outer, low[:, b:].min(1))
    if b > have:
        return _ranked(x, entries, b)[:3]
    return state


def packed(states) -> bytes:
    """All parts' states of a block in one value."""
    import numpy as np

    out = []
    for order, low, outer in states:
        out += [np.array(order.shape, np.int32).tobytes(), order.astype(np.uint8).tobytes(), low.astype(np.float32).tobytes(),
                outer.astype(np.float32).tobytes()]
    return b"".join(out)


def unpacked(data, parts: int):
    import numpy as np

    at, out = 0, []
    for _ in range(parts):
        n, b = np.frombuffer(data, np.int32, 2, at)
        order = np.frombuffer(data, np.uint8, n * b, at + 8).reshape(n, b)
        low = np.frombuffer(data, np.float32, n * b, at + 8 + n * b).reshape(n, b)
        outer = np.frombuffer(data, np.float32, n, at + 8 + 5 * n * b)
        at += 8 + 5 * n * b + 4 * n
        out.append((order, low, outer))
    return out


def blocks(vectors: DataFrame, dim: int, *, id_col: str, vec_col: str, label_col: str | None, scale: int, largest: int) -> DataFrame:
    """Blocks of kept vectors: ids, labels, x (dim integers of 4 bytes a row), state (null), sums (null)."""
    label = F.col(f"`{label_col}`") if label_col else F.lit(None).cast("string")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vec_col).alias("v"))
    kept = rows.where(F.col("v").isNotNull() & (F.size("v") == dim)
                      & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                b = batch.slice(lo, BLOCK)
                v = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                x = integers(v, scale, largest).astype(np.int32)
                offsets = pa.array([0, b.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(offsets, b.column(0)), pa.ListArray.from_arrays(offsets, b.column(1)),
                     pa.array([x.tobytes()], pa.binary()), pa.array([None], pa.binary()), pa.array([None], pa.list_(pa.int64()))],
                    names=["ids", "labels", "x", "state", "sums"])

    kind = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(run, f"ids array<long>, labels array<{kind}>, x binary, state binary, sums array<long>")


def assign_round(state: DataFrame, books, moved, parts: int, last: bool) -> DataFrame:
    """One pass over the blocks: new bounds and, in each task's last block, the
    task's sums; in the ``last`` pass codes and squared distances instead."""
    books, moved = books.copy(), None if moved is None else moved.copy()
    k, d = books.shape[1:]
    schema = state.schema if not last else "ids array<long>, labels " + state.schema["labels"].dataType.simpleString() + \
        ", codes array<string>, errors array<long>"

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((parts, k, d + 1), np.int64)
        waiting = None
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), np.int32).reshape(-1, parts, d).astype(np.int64)
                had = batch.column(3)[i]
                old = unpacked(had.as_buffer(), parts) if had.is_valid else [None] * parts
                new, own, codes = [], np.zeros(len(x), np.int64), np.zeros((len(x), parts), np.uint8)
                for p in range(parts):
                    part = x[:, p]
                    if old[p] is None:
                        *s, squares = first_state(part, books[p])
                    else:
                        s, squares, (need, failed) = next_state(part, books[p], moved[p], old[p])
                        b = adapted(s[0].shape[1], need, failed, k)
                        s = resized(s, part, books[p], b)
                    new.append(s)
                    at = s[0][:, 0].astype(np.int64)
                    codes[:, p] = at
                    own += squares
                    if not last:
                        np.add.at(total[p, :, :d], at, part)
                        total[p, :, d] += np.bincount(at, minlength=k)
                head = [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1)]
                if last:
                    text = codes.tobytes().hex()
                    offsets = pa.array([0, len(x)], pa.int32())
                    names = [text[2 * parts * j: 2 * parts * (j + 1)] for j in range(len(x))]
                    yield pa.RecordBatch.from_arrays(
                        [*head, pa.ListArray.from_arrays(offsets, pa.array(names, pa.string())), pa.ListArray.from_arrays(offsets, pa.array(own))],
                        names=["ids", "labels", "codes", "errors"])
                    continue
                if waiting is not None:
                    yield pa.RecordBatch.from_arrays([*waiting, pa.array([None], pa.list_(pa.int64()))], names=["ids", "labels", "x", "state", "sums"])
                waiting = [*head, batch.column(2).slice(i, 1), pa.array([packed(new)], pa.binary())]
        if waiting is not None:
            yield pa.RecordBatch.from_arrays([*waiting, pa.array([total.reshape(-1).tolist()], pa.list_(pa.int64()))],
                                             names=["ids", "labels", "x", "state", "sums"])

    return state.mapInArrow(run, schema)


def updated(state: DataFrame, books):
    """Codebooks after a round, and upper bounds of how far each entry moved."""
    import numpy as np

    parts, k, d = books.shape
    # one row of sums a task; added up in Spark, parts x entries x (length + 1) numbers come back
    rows = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()
    total = np.zeros(parts * k * (d + 1), np.int64)
    for r in rows:
        total[r.i] = r.s
    total = total.reshape(parts, k, d + 1)
    n = total[:, :, d:]
    new = np.where(n > 0, total[:, :, :d] // np.maximum(n, 1), books)       # // goes down
    moved = np.sqrt(((new - books) ** 2).sum(-1).astype(np.float64)) * (1 + 1e-6)
    return new, moved


def first_books(vectors: DataFrame, *, id_col: str, vec_col: str, parts: int, entries: int, scale: int):
    """Codebooks (parts, entries, length) from the kept rows with the smallest ids; None without rows."""
    import numpy as np

    v = F.col(vec_col)
    good = vectors.where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = good.select(F.col(id_col).cast("long").alias("i"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    first = rows.orderBy(F.col("i").asc_nulls_last(), "v").limit(1).collect()
    if not first:
        return None
    dim = len(first[0].v)
    if dim % parts:
        raise ValueError(f"{dim} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("v") == dim).orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    x = np.array([r.v for r in rows], np.int64)
    return x.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2).copy()


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE):
    """(codes, codebooks): the table (vec_id, label, code, error) and the final
    integer codebooks, an array (parts, entries, length)."""
    books = first_books(vectors, id_col=id_col, vec_col=vec_col, parts=parts, entries=entries, scale=scale)
    if books is None:
        kind = vectors.schema[label_col].dataType.simpleString() if label_col else "string"
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long"), None
    dim = books.shape[0] * books.shape[2]
    state = materialize(blocks(vectors, dim, id_col=id_col, vec_col=vec_col, label_col=label_col, scale=scale,
                               largest=limit(books.shape[2], entries)), "vector-blocks")
    moved = None
    for _ in range(rounds):
        before, state = state, materialize(assign_round(state, books, moved, parts, False), "vector-blocks")
        discard(before)
        books, moved = updated(state, books)
    out = materialize(assign_round(state, books, moved, parts, True), "vector-codes")
    discard(state)
    each = out.select(F.explode(F.arrays_zip("ids", "labels", "codes", "errors")).alias("r"))
    return each.select(F.col("r.ids").alias("vec_id"), F.col("r.labels").alias("label"), F.col("r.codes").alias("code"),
                       F.col("r.errors").alias("error")), books


def books_digest(books) -> str:
    """sha256 of the entries' decimal components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` and label_error: the error summed over equal labels, nulls together.

    Sums per label are made before any join, so a hot label is one row a task;
    the join's hot side is split by adaptive execution.
    """
    per = materialize(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label"), "label-errors")
    return codes.join(per, codes["label"].eqNullSafe(per["of_label"])).drop("of_label")
