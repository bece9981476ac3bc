"""SimHash near-duplicates found with pivot distance tables.

Fingerprints are made inside tasks from all shingles of a whole text; equal
fingerprints are one node from then on.  Two fingerprints within ``max_bits``
bits agree on at least one of ``max_bits + 1`` bands, hence have equal Hamming
distances, on that band, to every reference fingerprint: rows meet where a
band's row of the pivot table is equal.  Inside such a group the distances to
whole reference fingerprints discard every pair with a coordinate difference
above ``max_bits`` (the triangle inequality), and the survivors are verified
bit by bit.  A group gives a spanning forest, never all its pairs.

Groups above ``GROUP`` rows are dealt again by the bands of their other bits;
what is still larger is cut into blocks, and each pair of blocks is a task's
unit of work, so no task ever holds more than two blocks.

Edge cases: a null or empty text has the fingerprint zero and links like any
other; rows with a null id take part in no link and get the component of their
fingerprint (null if no other row has it); rows with one id are one document;
no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Reference fingerprints whose distances make a band's key / a group's table.
KEY_PIVOTS, TABLE_PIVOTS = 10, 16
#: Rows of a block; larger groups are split.
GROUP = 512
#: Groups up to this size are compared by offsets, larger ones by search.
SMALL = 16
#: Shingles hashed at once.
SLICE = 1 << 16


def pivots(n: int) -> list[int]:
    """``n`` pseudo-random 64-bit reference fingerprints."""
    out, x = [], 0x243F6A8885A308D3
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64))
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(data: bytes, k: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a UTF-8 text: a bit is set if over half of the shingles' hashes have it."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split()                    # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, SLICE):
        part = words[lo: lo + SLICE + k - 1]
        line = b" ".join(part)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        ends = ends.tolist()
        if len(part) > k - 1:
            ends = ends[k - 1:]
        else:
            starts, ends = starts[:1], ends[-1:]
        hashes = np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, ends)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = [signed(fingerprint(t.as_py(), k, seed)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def bands(max_bits: int, of: int = (1 << 64) - 1) -> list[int]:
    """Masks that cut the bits of ``of`` into ``max_bits + 1`` runs."""
    bits = [i for i in range(64) if of >> i & 1]
    n = max_bits + 1
    return [sum(1 << i for i in bits[len(bits) * j // n: len(bits) * (j + 1) // n]) for j in range(n)]


def pivot_row(fp: Column, mask: int) -> Column:
    """Distances, on the masked bits, to the key pivots, packed six bits each."""
    row = F.lit(0).cast("long")
    for i, p in enumerate(pivots(KEY_PIVOTS)):
        d = F.bit_count(fp.bitwiseXOR(F.lit(signed(p))).bitwiseAND(F.lit(signed(mask)))).cast("long")
        row = row + F.shiftleft(d, 6 * i)
    return row


def forest(fps, nodes, units, max_bits: int = MAX_BITS):
    """Spanning edges (as index pairs) of the links inside every unit.

    ``units`` is sorted.  The table of distances to the pivots discards pairs
    first; only survivors are compared bit by bit.
    """
    import numpy as np

    refs = np.array(pivots(TABLE_PIVOTS), np.uint64)
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    n = len(fps)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(pairs):
        for i, j in pairs:
            i, j = root(i), root(j)
            if i != j:
                if nodes[j] < nodes[i]:
                    i, j = j, i
                parent[j] = i

    edge = np.flatnonzero(np.append(True, units[1:] != units[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, n))
    small = np.repeat(size <= SMALL, size)
    for d in range(1, SMALL):
        i = np.flatnonzero(small[: n - d] & (units[: n - d] == units[d:])) if n > d else np.zeros(0, np.int64)
        if not len(i):
            break
        for c in range(table.shape[1]):
            i = i[np.abs(table[i, c] - table[i + d, c]) <= max_bits]
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= max_bits]
        join(zip(i.tolist(), (i + d).tolist()))
    for lo, m in zip(edge[size > SMALL].tolist(), size[size > SMALL].tolist()):
        left = np.arange(lo, lo + m)
        queue: list[int] = []
        while len(left):
            if not queue:
                queue.append(int(left[0]))
                left = left[1:]
            x = queue.pop()
            near = left
            for c in range(table.shape[1]):
                near = near[np.abs(table[near, c] - table[x, c]) <= max_bits]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= max_bits]
            if len(near):
                join((x, int(y)) for y in near)
                queue.extend(near.tolist())
                left = np.setdiff1d(left, near, assume_unique=True)
    tops = [root(i) for i in range(n)]
    return [(t, i) for i, t in enumerate(tops) if t != i]


def links(nodes: DataFrame, *, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """Edges (a, b) that connect all ``nodes`` (node, fp; fp distinct) whose
    fingerprints differ in at most ``max_bits`` bits."""
    fp = F.col("fp")

    def dealt(rows: DataFrame, keys) -> DataFrame:
        """Rows once for each band, with the unit they meet in and its size class."""
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(*key).alias("unit"))
                                   for i, key in enumerate(keys)])).alias("k")
        rows = rows.select("node", "fp", each).select("node", "fp", "k.band", "k.unit")
        rows = materialize(rows, "pivot-rows")
        large = materialize(rows.groupBy("unit").count().where(F.col("count") > group), "large-units")
        return rows.join(large, "unit", "left")

    def key(mask, *more):
        return [*more, F.lit(signed(mask)), pivot_row(fp, mask)]

    first_masks = bands(max_bits)
    first = dealt(nodes, [key(m) for m in first_masks])
    plain = first.where("count IS NULL").select("unit", "node", "fp")
    # crowded units: equal on one band, so dealt again by the bands of the other bits
    again = []
    for i, m in enumerate(first_masks):
        rows = first.where((F.col("count") > group) & (F.col("band") == i))
        rest = bands(max_bits, ((1 << 64) - 1) & ~m)
        each = F.explode(F.array(*[F.xxhash64(F.col("unit"), *key(r)) for r in rest])).alias("unit")
        again.append(rows.select("node", "fp", each))
    second = again[0]
    for more in again[1:]:
        second = second.unionByName(more)
    second = materialize(second, "pivot-rows")
    large = materialize(second.groupBy("unit").count().where(F.col("count") > group), "large-units")
    second = second.join(large, "unit", "left")
    plain = plain.unionByName(second.where("count IS NULL").select("unit", "node", "fp"))
    # what is still crowded: pairs of blocks
    n = F.ceil(F.col("count") / group).cast("int")
    block = F.pmod(F.xxhash64("fp"), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), n - 1)).alias("other")
    blocks = (second.where(F.col("count") > group).select("unit", "node", "fp", block.alias("block"), other)
              .select(F.xxhash64("unit", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "node", "fp"))
    rows = plain.unionByName(blocks).repartition("unit").sortWithinPartitions("unit")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held: list = []

        def flush(unit, node, fps):
            found = forest(fps.view(np.uint64), node, unit, max_bits)
            a = np.array([node[i] for i, _ in found], np.int64)
            b = np.array([node[j] for _, j in found], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            unit, node, fps = (np.concatenate(x) for x in zip(*held))
            whole = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0     # the last unit may go on
            if whole:
                yield flush(unit[:whole], node[:whole], fps[:whole])
            held = [[unit[whole:], node[whole:], fps[whole:]]]
        if held and len(held[0][0]):
            yield flush(*held[0])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over links."""
    rows = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, k=k, seed=seed), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node IS NOT NULL"), "nodes")
    comps = components(links(nodes.select("node", "fp"), max_bits=max_bits))
    named = materialize(nodes.join(comps, "node", "left")
                        .select(F.col("fp").alias("of_fp"), F.coalesce("component", "node").alias("component_id")), "named")
    return rows.join(named, rows.fp == named.of_fp, "left").select("doc_id", "fp", "component_id")
