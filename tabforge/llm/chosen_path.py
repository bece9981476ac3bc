"""Near duplicates by a chosen-path set similarity join over minwise tokens.

A document is the set of its distinct word shingles (64-bit hashes).  Equal
sets are one node from then on, so exact copies never meet one another.  From
each set a row of minwise tokens is taken, one for each hash function.

Every tree starts with all nodes and branches them by selected positions of
that row: a node goes to one child for each selected position, named by the
path and its minwise token there, so two sets of similarity s share a child
with probability s for each position.  Children with one member end; children
with up to ``SMALL`` members are compared exhaustively; larger ones branch on,
by positions that follow from their path, up to ``DEPTH`` times, and what is
still larger then is compared in blocks (below).  Independent trees repeat this
until the chance that a link at the threshold is found in none of them is below
``MISS`` (:func:`trees`; more similar sets are safer).

Inside a child, pairs whose rows agree at fewer places than nearly any link
does are no candidates (the same ``MISS`` bounds the loss); the others are
joined into candidate groups.  Each group's whole texts then meet, once for
each document, and links are confirmed on the full sets: every pair of a group
that sizes and rows leave possible is decided by the sizes of intersection and
union, unless both are connected already, which cannot change a component.

Blocks (:func:`linked`): a crowd's members are dealt into blocks and compared
inside them; then one head of each part found so far meets the other heads, as
long as that leaves fewer; then every member outside the crowd's largest part
is compared with all members.  A crowd of near copies is nearly one part after
the first two steps, so this costs its size and not the square of it; no task
holds more than two blocks, and no pair that could link goes unseen.

Edge cases: a null or empty text, or one without words, has an empty set and
is linked with nothing; a single word is a set of its own; rows with a null id
take part in no link, have a null component and are kept; rows with one id are
one document, linked by the text of any of them; no rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from .common import materialize
from .components import components

SHINGLE = 2
PERCENT = 80
#: Minwise tokens of a document.
ROW = 128
#: Positions selected at the root and below it, and levels below the root.
ROOT, BRANCH, DEPTH = 3, 2, 2
#: Chance that a link exactly at the threshold is missed.
MISS = 1e-7
#: Most members, and most bytes of sets, that are compared as a whole.
SMALL = 512
GROUP_BYTES = 16 << 20
#: Units up to this size are compared many at once.
FEW = 8
SEED = 42
#: Word hashes a task remembers; shingles whose rows are made at once.
CACHE_WORDS, SLICE = 1_000_000, 2048


def _mixed(x):
    """A 64-bit finalizer."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def functions(n: int, seed: int = SEED):
    """Keys and odd multipliers of ``n`` hash functions."""
    import numpy as np

    r = np.random.default_rng(seed)
    return r.integers(0, 1 << 64, n, np.uint64), r.integers(0, 1 << 64, n, np.uint64) | np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word):
        from xxhash import xxh64_intdigest

        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxh64_intdigest(word, SEED)
        return h


def shingle_set(data: bytes, k: int, hashes: dict):
    """Sorted distinct 64-bit hashes of the k-word shingles of a UTF-8 text."""
    import numpy as np

    words = data.lower().split()                    # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(k, len(h)), np.uint64)
    for i in range(min(k, len(h))):
        out = _mixed(out ^ h[i: i + n])
    return np.unique(out)


def minwise(tokens, keys, odd):
    """32-bit names of each function's minwise token."""
    import numpy as np

    low = np.full(len(keys), (1 << 64) - 1, np.uint64)
    for lo in range(0, len(tokens), SLICE):
        np.minimum(low, ((tokens[lo: lo + SLICE, None] ^ keys) * odd).min(0), out=low)
    return _mixed(low).astype(np.uint32)      # the functions are bijections: a value names its token


def least_agreement(percent: int = PERCENT, row: int = ROW, miss: float = MISS) -> int:
    """The most places at which rows may be asked to agree, so that a link at
    the threshold fails it with a chance of at most ``miss``."""
    s, below = percent / 100, 0.0
    for c in range(row + 1):
        below += math.comb(row, c) * s ** c * (1 - s) ** (row - c)
        if below > miss:
            return c
    return row


def trees(percent: int = PERCENT, root: int = ROOT, branch: int = BRANCH, depth: int = DEPTH, miss: float = MISS) -> int:
    """Independent trees so that a link at the threshold meets in a last child of one of them."""
    s = percent / 100
    lost = 0.0
    for _ in range(depth):
        lost = (1 - s + s * lost) ** branch
    lost = (1 - s + s * lost) ** root
    return max(1, math.ceil(math.log(miss) / math.log(lost)))


def document_sets(docs: DataFrame, *, id_col: str, text_col: str, k: int, row: int, seed: int) -> DataFrame:
    """doc_id, n, s1, s2 (a 128-bit name of the set), low (the row, 4 bytes a
    place) and marks (the last byte of each place)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        keys, odd = functions(row, seed)
        hashes = WordHashes()
        for b in batches:
            ns, names, lows, marks = [], [], [], []
            for data in b.column(1):
                s = shingle_set(data.as_py(), k, hashes)
                ns.append(len(s))
                names.append(xxh3_128_digest(s.tobytes()))
                low = minwise(s, keys, odd) if len(s) else None
                lows.append(None if low is None else low.tobytes())
                marks.append(None if low is None else low.astype(np.uint8).tobytes())
            name = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(name[:, 0].copy()), pa.array(name[:, 1].copy()),
                                              pa.array(lows, pa.binary()), pa.array(marks, pa.binary())], names=["doc_id", "n", "s1", "s2", "low", "marks"])

    return rows.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, low binary, marks binary")


def root_children(nodes: DataFrame, n_trees: int, root: int, row: int) -> DataFrame:
    """(unit, node): every tree's children of the root."""
    places = [[(t * root + j) % row for j in range(root)] for t in range(n_trees)]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        at = np.array(places).reshape(-1)
        tag = _mixed(np.arange(1, len(at) + 1, dtype=np.uint64))
        for b in batches:
            low = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, row)
            unit = _mixed(low[:, at] ^ (tag << np.uint64(32)))
            node = np.repeat(b.column(0).to_numpy(), len(at))
            yield pa.RecordBatch.from_arrays([pa.array(unit.reshape(-1).view(np.int64)), pa.array(node)], names=["unit", "node"])

    return nodes.select("node", "low").mapInArrow(run, "unit long, node long")


def children(members: DataFrame, branch: int, row: int) -> DataFrame:
    """(unit, node): one child of each selected position, from (unit, node, low).

    A unit's positions follow from its path, so all of its members use the same."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            unit = b.column(0).to_numpy().view(np.uint64)
            low = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, row)
            draw = _mixed(unit)
            first = (draw % np.uint64(row)).astype(np.int64)
            step = 1 + (draw // np.uint64(row) % np.uint64(row - 1)).astype(np.int64)
            out = []
            for j in range(branch):
                at = (first + j * step) % row
                out.append(_mixed(unit ^ _mixed(low[np.arange(len(low)), at] | at.astype(np.uint64) << np.uint64(32))))
            child = np.stack(out, 1) if len(unit) else np.zeros((0, branch), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(child.reshape(-1).view(np.int64)), pa.array(np.repeat(b.column(1).to_numpy(), branch))],
                                             names=["unit", "node"])

    return members.mapInArrow(run, "unit long, node long")


class Sets:
    """Union of indices, so that connected pairs are not looked at again."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def agreeing(sizes, rows, percent: int, least: int, confirm=None):
    """A spanning forest, as index pairs, of the pairs whose sizes allow the
    threshold, whose rows agree at ``least`` places and, if given, that
    ``confirm(i, js)`` accepts.

    From each member the ones not yet reached are looked at, so that every
    possible pair between two parts is tried and none inside a part."""
    import numpy as np

    left = np.argsort(sizes, kind="stable")
    out = []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            span = sizes[left]
            lo = np.searchsorted(span, -(-int(sizes[i]) * percent // 100))
            hi = np.searchsorted(span, int(sizes[i]) * 100 // percent, "right")
            near = left[lo:hi]
            hit = np.count_nonzero(rows[near] == rows[i], axis=1) >= least
            if confirm is not None and hit.any():
                at = np.flatnonzero(hit)
                hit[at] = confirm(i, near[at])
            if hit.any():
                found = near[hit]
                out += [(i, int(j)) for j in found]
                queue += found.tolist()
                stay = np.ones(len(left), bool)
                stay[lo:hi] = ~hit
                left = left[stay]
    return out


def across(sizes, rows, loose, part, percent: int, least: int, confirm=None):
    """Index pairs that connect each ``loose`` member with every other member it
    links to, but for those that are connected already (``part`` names what is
    known to be connected)."""
    names = {}
    sets = Sets(len(sizes))
    for i, p in enumerate(part.tolist()):
        sets.join(names.setdefault(p, i), i)
    out = []
    for i in loose.nonzero()[0].tolist():
        near = ((100 * sizes >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes) & (part != part[i])).nonzero()[0]
        near = near[(rows[near] == rows[i]).sum(1) >= least]
        if confirm is not None and len(near):
            near = near[confirm(i, near)]
        out += [(i, j) for j in near.tolist() if sets.join(i, j)]
    return out


def per_unit(rows: DataFrame, pairs_of, whole: str | None = None) -> DataFrame:
    """(a, b), the nodes of ``pairs_of({column: arrow array}) -> [(row, row)]``,
    which gets whole units of ``rows`` (unit, node, ...), dealt and sorted by unit.

    With ``whole``, a column of the rows, it gives (that column, node, part) for
    every row instead: ``part`` is the smallest node of its unit that the pairs connect it to."""
    dealt = rows.repartition("unit").sortWithinPartitions("unit")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def done(parts):
            t = pa.Table.from_batches(parts)
            pairs = pairs_of({c: t.column(c) for c in t.column_names})
            node = t.column("node").to_numpy()
            if whole is None:
                a, b = ([node[p[i]] for p in pairs] for i in (0, 1))
                return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            sets = Sets(len(node))
            for i, j in pairs:
                sets.join(i, j)
            top = np.array([sets.top(i) for i in range(len(node))], np.int64)
            low = np.full(len(node), np.iinfo(np.int64).max)
            np.minimum.at(low, top, node)
            return pa.RecordBatch.from_arrays([t.column(whole).combine_chunks(), pa.array(node), pa.array(low[top])], names=[whole, "node", "part"])

        held = []                                   # the last unit seen may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column(0).to_numpy()
            change = np.flatnonzero(unit[1:] != unit[:-1])
            whole_ = int(change[-1]) + 1 if len(change) else 0
            if whole_ or held and held[-1].column(0)[-1].as_py() != unit[0]:
                yield done([*held, batch.slice(0, whole_)])
                held = []
            held.append(batch.slice(whole_))
        if held:
            yield done(held)

    return dealt.mapInArrow(run, "a long, b long" if whole is None else f"{whole} long, node long, part long")


def _matrix(column, width: int):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _edges_of(unit):
    import numpy as np

    return np.append(np.flatnonzero(np.append(True, unit[1:] != unit[:-1])), len(unit)).tolist()


def linked(rows: DataFrame, pairs_of, across_of, *, small: int, limit: int) -> DataFrame:
    """(a, b) that connect all links inside the units of ``rows`` (unit, node,
    weight, ...), a written table.

    ``pairs_of(columns)`` gives forests of whole units, as pairs of rows, and
    ``across_of(columns)`` what connects the rows marked ``loose`` with others of
    their units that have another ``part``.  Units above ``small`` rows or
    ``limit`` of weight go the way of blocks."""
    crowds = rows.groupBy("unit").agg(F.count("*").alias("c"), F.sum("weight").alias("w")).where((F.col("c") > small) | (F.col("w") > limit))
    blocks = F.greatest(F.ceil(F.col("c") / small), F.ceil(F.col("w") / limit)).cast("int")
    crowds = materialize(crowds.select(F.col("unit").alias("crowd"), blocks.alias("blocks")), "crowds")
    if crowds.isEmpty():
        return per_unit(rows, pairs_of)
    edges = per_unit(rows.join(crowds, F.col("unit") == F.col("crowd"), "left_anti"), pairs_of)
    mine = rows.join(crowds, F.col("unit") == F.col("crowd")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    mine = materialize(mine.drop("unit"), "crowd-members")
    payload = [c for c in rows.columns if c != "unit"]

    def parts_of(df, *key):
        """(crowd, node, part) of rows that meet where ``key`` is equal."""
        return per_unit(df.select(F.xxhash64("crowd", *key).alias("unit"), "crowd", *payload), pairs_of, "crowd")

    parts = materialize(parts_of(mine, F.lit("block"), "block"), "crowd-parts")
    before = None
    while True:
        heads = parts.groupBy("crowd", "part").agg(F.count("*").alias("size"))
        sizes = heads.groupBy("crowd").agg(F.count("*").alias("h"), F.sum("size").alias("all"), F.max(F.struct("size", "part")).alias("top"))
        sizes = materialize(sizes.where("h > 1").select(F.col("crowd").alias("c"), "h", "all", "top"), "crowd-sizes")
        now = sizes.agg(F.sum("h")).first()[0]                       # one number
        if now is None or before is not None and 2 * now > before:
            break
        before = now
        # one member of every part meets the others
        chosen = heads.join(sizes.select("c", "h", "all"), F.col("crowd") == F.col("c")).select("c", F.col("part").alias("head"), "h", "all")
        met = mine.join(chosen, (F.col("crowd") == F.col("c")) & (F.col("node") == F.col("head")))
        met = met.withColumn("deal", F.pmod(F.xxhash64("node", F.lit(now)), F.ceil(F.col("h") * F.col("blocks") / F.col("all"))).cast("int"))
        joined = parts_of(met, F.lit("heads"), "deal").toDF("c", "head", "now")
        joined = materialize(joined, "crowd-heads")
        parts = parts.join(joined, (F.col("crowd") == F.col("c")) & (F.col("part") == F.col("head")), "left")
        parts = materialize(parts.select("crowd", "node", F.coalesce("now", "part").alias("part")), "crowd-parts")
    edges = edges.unionByName(parts.where("node <> part").select(F.col("part").alias("a"), F.col("node").alias("b")))
    if now is None:
        return edges
    # the largest part of a crowd is done: what lies outside meets every block
    top = sizes.select("c", F.col("top.part").alias("top"), F.col("top.size").alias("done"), "all")
    named = mine.join(parts.toDF("p_crowd", "p_node", "part"), (F.col("crowd") == F.col("p_crowd")) & (F.col("node") == F.col("p_node")))
    # as many rows to a table as to a block
    named = named.join(top, F.col("crowd") == F.col("c")).withColumn("deals", F.ceil((F.col("all") - F.col("done")) * F.col("blocks") / F.col("all")).cast("int"))
    deal = F.pmod(F.xxhash64(F.lit("loose"), "node"), F.col("deals")).cast("int")
    keep = [*payload, "part"]
    sitting = named.select("crowd", "block", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"), *keep, F.lit(False).alias("loose"))
    moving = named.where("part <> top").select("crowd", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), deal.alias("deal"), *keep, F.lit(True).alias("loose"))
    tables = sitting.unionByName(moving).select(F.xxhash64("crowd", "block", "deal").alias("unit"), *keep, "loose")
    return edges.unionByName(per_unit(tables, across_of))


def candidate_edges(nodes: DataFrame, *, percent: int, row: int, small: int, miss: float) -> DataFrame:
    """(a, b): forests of the candidate groups among ``nodes`` (node, n, low, marks)."""
    least = least_agreement(percent, row, miss)
    rows = materialize(root_children(nodes, trees(percent, miss=miss), ROOT, row), "path-children")
    found = None
    for level in range(DEPTH + 1):
        sizes = materialize(rows.groupBy("unit").count().where("count > 1").withColumnRenamed("unit", "of_unit"), "path-sizes")
        sized = rows.join(sizes, F.col("unit") == F.col("of_unit"))
        part = (sized if level == DEPTH else sized.where(F.col("count") <= small)).select("unit", "node")
        found = part if found is None else found.unionByName(part)
        if level == DEPTH or sizes.where(F.col("count") > small).isEmpty():
            break
        large = sized.where(F.col("count") > small).select("unit", "node")
        low = nodes.select(F.col("node").alias("of_node"), "low")
        rows = materialize(children(large.join(low, F.col("node") == F.col("of_node")).select("unit", "node", "low"), BRANCH, row), "path-children")
    sent = nodes.select(F.col("node").alias("of_node"), F.col("n").alias("size"), "marks")
    units = found.join(sent, F.col("node") == F.col("of_node")).select("unit", "node", F.lit(1).alias("weight"), "size", "marks")
    units = materialize(units, "path-units")

    def whole(cols):
        return candidates(cols["unit"].to_numpy(), cols["size"].to_numpy(), _matrix(cols["marks"], row), percent, least)

    def cross(cols):
        unit, size, part = (cols[c].to_numpy() for c in ("unit", "size", "part"))
        loose, marks = cols["loose"].to_numpy(), _matrix(cols["marks"], row)
        out, at = [], _edges_of(unit)
        for lo, hi in zip(at, at[1:]):
            found = across(size[lo:hi], marks[lo:hi], loose[lo:hi], part[lo:hi], percent, least)
            out += [(lo + i, lo + j) for i, j in found]
        return out

    return linked(units, whole, cross, small=small, limit=small)


def candidates(unit, size, marks, percent: int, least: int):
    """Forests of the candidate pairs of whole units, given one after the other, as row pairs."""
    import numpy as np

    out = []
    at = np.array(_edges_of(unit))
    members = np.diff(at)
    # few members: all pairs of all these units at once, by their distance in the table
    few = np.repeat(members <= FEW, members)
    sets = Sets(len(unit))
    for d in range(1, FEW):
        i = np.flatnonzero(few[:-d] & (unit[:-d] == unit[d:]))
        if not len(i):
            break
        i = i[(100 * size[i] >= percent * size[i + d]) & (100 * size[i + d] >= percent * size[i])]
        i = i[np.count_nonzero(marks[i] == marks[i + d], axis=1) >= least]
        out += [(x, x + d) for x in i.tolist() if sets.join(x, x + d)]
    for lo, m in zip(at[:-1][members > FEW].tolist(), members[members > FEW].tolist()):
        found = agreeing(size[lo:lo + m], marks[lo:lo + m], percent, least)
        out += [(lo + i, lo + j) for i, j in found]
    return out


def confirmed_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, *, id_col: str, text_col: str, k: int, percent: int, row: int,
                    small: int, group_bytes: int, miss: float) -> DataFrame:
    """(a, b) that connect all true links inside the candidate ``groups`` (node, component)."""
    least = least_agreement(percent, row, miss)
    sized = groups.withColumnRenamed("node", "of_node").join(nodes.select("node", "n", "marks"), F.col("node") == F.col("of_node"))
    sized = sized.select(F.col("component").alias("unit"), "node", (F.col("n") * 8).alias("weight"), "marks")
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("of_node"),
                                                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    # a merge join at every size: each text is dealt out once, whatever the number of candidates
    members = sized.hint("merge").join(texts, F.col("node") == F.col("of_node")).select("unit", "node", "weight", "marks", "data")
    members = materialize(members, "group-texts")

    def each(cols, pairs_of):
        import numpy as np

        hashes = WordHashes()
        marks = _matrix(cols["marks"], row)
        out, at = [], _edges_of(cols["unit"].to_numpy())
        for lo, hi in zip(at, at[1:]):
            if hi - lo == 1:
                continue
            sets = [shingle_set(d.as_py(), k, hashes) for d in cols["data"].slice(lo, hi - lo)]
            sizes = np.array([len(s) for s in sets])

            def confirm(i, js):
                s = sets[i]
                flat = np.concatenate([sets[j] for j in js])
                if not len(s) or not len(flat):
                    return np.zeros(len(js), bool)
                held = np.concatenate(([0], np.cumsum(s[np.minimum(np.searchsorted(s, flat), len(s) - 1)] == flat)))
                ends = np.cumsum(sizes[js])
                both = held[ends] - held[ends - sizes[js]]
                return 100 * both >= percent * (sizes[js] + len(s) - both)

            found = pairs_of(slice(lo, hi), sizes, marks[lo:hi], confirm)
            out += [(lo + i, lo + j) for i, j in found]
        return out

    def whole(cols):
        return each(cols, lambda at, sizes, marks, confirm: agreeing(sizes, marks, percent, least, confirm))

    def cross(cols):
        loose, part = cols["loose"].to_numpy(), cols["part"].to_numpy()
        return each(cols, lambda at, sizes, marks, confirm: across(sizes, marks, loose[at], part[at], percent, least, confirm))

    return linked(members, whole, cross, small=small, limit=group_bytes)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT,
                    row: int = ROW, small: int = SMALL, group_bytes: int = GROUP_BYTES, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over
    links), kept (whether the document is that one)."""
    rows = materialize(document_sets(docs, id_col=id_col, text_col=text_col, k=k, row=row, seed=seed), "document-sets")
    nodes = (rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2")
             .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("marks").alias("marks")))
    nodes = materialize(nodes, "set-nodes")
    groups = components(candidate_edges(nodes, percent=percent, row=row, small=small, miss=miss))
    links = confirmed_links(docs, nodes, groups, id_col=id_col, text_col=text_col, k=k, percent=percent, row=row,
                            small=small, group_bytes=group_bytes, miss=miss)
    # an id with several texts is one document: its sets are linked through it
    heads = nodes.select("s1", "s2", "node")
    own = rows.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "s1", "s2")
    several = own.groupBy("doc_id").agg(F.min("s1").alias("p"), F.max("s1").alias("q")).where("p <> q").select("doc_id")
    through = own.join(several, "doc_id").join(heads, ["s1", "s2"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(links.unionByName(through)).withColumnRenamed("node", "of_node")
    named = heads.join(found, F.col("node") == F.col("of_node"), "left").select(
        F.col("s1").alias("of_s1"), F.col("s2").alias("of_s2"), F.coalesce("component", "node").alias("component"))
    named = materialize(named, "set-components")
    # the sets of a third of all rows may be equal: adaptive execution splits that side
    out = rows.drop("low", "marks").join(named, (F.col("s1") == F.col("of_s1")) & (F.col("s2") == F.col("of_s2")) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
