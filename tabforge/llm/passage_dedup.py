"""Passage dedup: prefix-free parsing and suffix order, spread over blocks.

A byte goes if some ``min_bytes`` bytes long string that covers it also starts
in a document with a smaller id.  The steps:

1. Triggers.  A rolling hash runs over all windows of ``TRIGGER`` bytes; in
   each string of ``min_bytes`` bytes the window with the smallest hash (the
   first of equals) is its trigger.  Equal strings have equal triggers at equal
   places, wherever they stand.
2. Phrases.  The strings that share one trigger occurrence are consecutive and
   form a phrase, so the text becomes a parse into overlapping phrases.  Each
   string lies in exactly one phrase, reaches ``j`` bytes to the left of the
   trigger, and ends in what the parse has to the right of it.
3. Only triggers that two documents hold can matter.  Blocks of documents send
   their distinct trigger hashes to buckets and get the repeated ones back.
4. Dictionary.  Each block sends its distinct phrases around such triggers,
   with the smallest and largest document of each, to the triggers' buckets.
5. Corpus order.  A bucket sorts what stands left of the triggers, read
   backwards (the dictionary's suffixes up to a trigger), and the trigger with
   what follows it (the parse's suffixes), each once, with the lengths of the
   common prefixes of neighbours.  For every ``j`` the classes of both orders
   together are the runs of equal strings in corpus order, each with its
   smallest document.
6. Blocks get those documents back for their phrases and cut their texts.

No step compares by hash alone: classes in 5 come from bytes.  A passage held
by very many documents is one entry for each block, so no bucket grows with
it.  A trigger with more than ``HEAVY`` occurrences may stand in as many
different phrases: its strings go, each once for a block, to buckets by the
hash of their bytes, where they are compared in step 5.  Blocks and buckets have a fixed size; their number follows the input.

Edge cases: a null or empty text, or one shorter than ``min_bytes``, stays; a
row with a null id stays as it is and affects no other; rows that repeat an id
are one document; strings never cross documents; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MIN_BYTES = 50
TRIGGER = 20
#: Bytes of text in a block of documents (a longer document is a block's own).
BLOCK_BYTES = 4 << 20
#: Bytes parsed at once.
SLICE = 1 << 19
#: Bits of a trigger's hash that travel, besides those that pick its bucket;
#: five more say how often a block holds it.
KEY_BITS = 35
#: Occurrences from which a trigger's strings are dealt out one by one.
HEAVY = 20_000

_NEVER = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15


def trigger_hashes(data):
    """Rolling (polynomial) hash of every ``TRIGGER`` bytes, then mixed."""
    import numpy as np

    def joined(a, la, b, lb):
        n = min(len(a), len(b) - la)
        return a[:n] * np.uint64(pow(_BASE, lb, 1 << 64)) + b[la: la + n]

    parts, power, have, width = [], data.astype(np.uint64), None, 1
    while True:                                  # hashes of 1, 2, 4 ... bytes, joined where TRIGGER has the bit
        if TRIGGER & width:
            have = (power, width) if have is None else (joined(power, width, *have), width + have[1])
        if 2 * width > TRIGGER:
            break
        power, width = joined(power, width, power, width), 2 * width
    x = have[0][: len(data) - TRIGGER + 1]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def parse(data, min_bytes: int = MIN_BYTES):
    """Phrases of a text: trigger places, first and last string starts, hashes.

    The text is parsed in slices; a phrase that a slice cuts becomes two.
    """
    import numpy as np

    out = []
    low = np.uint64((1 << 20) - 1)
    span = min_bytes - TRIGGER + 1
    for at in range(0, len(data) - min_bytes + 1, SLICE):
        part = data[at: at + SLICE + min_bytes - 1]
        h = trigger_hashes(part)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)      # equal hashes: the first
        have = 1
        while have < span:
            step = min(have, span - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(place)) - 1
        out.append((place[first] + at, first + at, last + at, h[place[first]]))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _split_key(hashes, buckets: int):
    """(bucket, remaining key) of trigger hashes."""
    import numpy as np

    b = np.uint64(buckets)
    return (hashes % b).astype(np.int64), (hashes // b) & np.uint64((1 << KEY_BITS) - 1)


def _pack(values) -> bytes:
    """40-bit values."""
    import numpy as np

    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack(data: bytes):
    import numpy as np

    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel().astype(np.uint64)


def _squeeze(*arrays) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _spread(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _texts(table):
    """(id, bytes) of the documents of a block that take part."""
    import numpy as np

    for doc, data in zip(table["doc_id"].to_pylist(), table["data"]):
        if doc is not None:
            yield doc, np.frombuffer(data.as_buffer() or b"", np.uint8)


def _runs_by(values):
    """Start and end of the runs of equal neighbours."""
    import numpy as np

    if not len(values):
        return []
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])).tolist()
    return list(zip(first, first[1:] + [len(values)]))


def _triggers(block: int, table, buckets: int, min_bytes: int):
    """Step 3, sending: (bucket, block, keys) with a flag for keys of two documents."""
    import numpy as np
    import pyarrow as pa

    keys = [np.unique(parse(data, min_bytes)[3], return_counts=True) for _, data in _texts(table)]
    bucket, key = _split_key(np.concatenate([k for k, _ in keys]) if keys else np.zeros(0, np.uint64), buckets)
    times = np.concatenate([n for _, n in keys]) if keys else np.zeros(0, np.int64)
    order = np.lexsort((key, bucket))
    bucket, key, times = bucket[order], key[order], times[order]
    first = np.append(True, (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    twice = np.append(~first[1:], False) if len(key) else first
    times = np.add.reduceat(times, np.flatnonzero(first)) if len(key) else times
    power = np.minimum(np.ceil(np.log2(np.maximum(times, 1))), 15).astype(np.uint64)        # up to 2 ** power times
    bucket, value = bucket[first], (key[first] << np.uint64(5)) | (power << np.uint64(1)) | twice[first].astype(np.uint64)
    runs = _runs_by(bucket)
    return pa.table({"bucket": pa.array([int(bucket[a]) for a, _ in runs], pa.int64()),
                     "block": pa.array([block] * len(runs), pa.int64()),
                     "keys": pa.array([_pack(value[a:b]) for a, b in runs], pa.binary())})


def _repeated(bucket: int, table):
    """Step 3, answering: (block, bucket, keys) of the keys that two documents
    hold, with a flag for keys of more than ``HEAVY`` occurrences."""
    import numpy as np
    import pyarrow as pa

    blocks = table["block"].to_pylist()
    values = [_unpack(k) for k in table["keys"].to_pylist()]
    value = np.concatenate(values)
    owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
    key = value >> np.uint64(5)
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    times = np.int64(1) << ((value[order] >> np.uint64(1)) & np.uint64(15)).astype(np.int64)
    new = np.append(True, ~same)
    heavy = np.empty(len(order), bool)
    heavy[order] = (np.add.reduceat(times, np.flatnonzero(new)) > HEAVY)[np.cumsum(new) - 1]
    answer = (key << np.uint64(1)) | heavy.astype(np.uint64)
    hit = np.append(False, same) | np.append(same, False) | ((value[order] & np.uint64(1)) == 1)
    pick = np.sort(order[hit])
    runs = _runs_by(owner[pick])
    return pa.table({"block": pa.array([blocks[int(owner[pick[a]])] for a, _ in runs], pa.int64()),
                     "bucket": pa.array([bucket] * len(runs), pa.int64()),
                     "keys": pa.array([_pack(answer[pick[a:b]]) for a, b in runs], pa.binary())})


def _width(min_bytes: int) -> int:
    """Bytes of a phrase's row: what surrounds the trigger, and two for the range of ``j``."""
    return -(-(2 * min_bytes - TRIGGER + 2) // 8) * 8


class Block:
    """The phrases of a block around repeated triggers, in an order that its
    texts alone decide.

    A phrase is kept as the bytes around its trigger, aligned, with zeros where
    it does not reach, and the range of ``j`` of its strings.  Phrases of heavy
    triggers, from ``light`` on, come last.
    """

    def __init__(self, table, asked, buckets: int, min_bytes: int):
        import numpy as np

        reach, width = min_bytes - TRIGGER, _width(min_bytes)
        self.reach, self.min_bytes = reach, min_bytes
        keys = [(_unpack(k), np.uint64(b)) for b, k in asked]
        wanted = np.concatenate([(k >> np.uint64(1)) * np.uint64(buckets) + b for k, b in keys]) if keys else np.zeros(0, np.uint64)
        many = np.concatenate([(k & np.uint64(1)) == 1 for k, _ in keys]) if keys else np.zeros(0, bool)
        order = np.argsort(wanted, kind="stable")
        wanted, many = wanted[order], many[order]
        around = np.arange(-reach, min_bytes)
        rows, docs, places, buckets_of, heavy = [], [], [], [], []
        for doc, data in _texts(table):
            place, first, last, h = parse(data, min_bytes)
            bucket, key = _split_key(h, buckets)
            full = key * np.uint64(buckets) + bucket.astype(np.uint64)
            at = np.minimum(np.searchsorted(wanted, full), max(0, len(wanted) - 1))
            pick = np.flatnonzero(wanted[at] == full) if len(wanted) and len(full) else np.zeros(0, np.int64)
            if not len(pick):
                continue
            place, first, last = place[pick], first[pick], last[pick]
            index = place[:, None] + around[None, :]
            inside = (index >= first[:, None]) & (index < last[:, None] + min_bytes)
            row = np.zeros((len(pick), width), np.uint8)
            row[:, : len(around)] = np.where(inside, data[np.clip(index, 0, len(data) - 1)], 0)
            row[:, -2], row[:, -1] = place - last, place - first
            rows.append(row)
            docs.append(np.full(len(pick), doc, np.int64))
            places.append(place)
            buckets_of.append(bucket[pick])
            heavy.append(many[at[pick]])
        self.light = 0
        if not rows:
            self.rows = np.zeros((0, width), np.uint8)
            self.doc = self.place = self.phrase = self.bucket = self.least = self.most = np.zeros(0, np.int64)
            return
        rows, self.doc, self.place, bucket, heavy = (np.concatenate(x) for x in (rows, docs, places, buckets_of, heavy))
        words = rows.view("<u8")
        order = np.lexsort((*words.T, bucket, heavy))
        words, bucket = words[order], bucket[order]
        new = np.append(True, (words[1:] != words[:-1]).any(1) | (bucket[1:] != bucket[:-1]))
        self.phrase = np.empty(len(order), np.int64)              # of each occurrence
        self.phrase[order] = np.cumsum(new) - 1
        self.rows, self.bucket = rows[order[new]], bucket[new]
        at = np.flatnonzero(new)
        self.least = np.minimum.reduceat(self.doc[order], at)
        self.most = np.maximum.reduceat(self.doc[order], at)
        self.light = int((~heavy[order[new]]).sum())

    def strings(self, buckets: int):
        """The distinct strings of heavy phrases by bucket: bytes, bucket,
        smallest and largest document, and the (phrase, j, string) of each."""
        import numpy as np

        rows, parts = self.rows[self.light:], []
        for j in range(self.reach + 1):
            has = np.flatnonzero((rows[:, -2] <= j) & (j <= rows[:, -1]))
            parts.append((rows[has, self.reach - j: self.reach - j + self.min_bytes], has + self.light, np.full(len(has), j)))
        text, phrase, j = (np.concatenate(x) for x in zip(*parts))
        if not len(text):
            return text, phrase, phrase, phrase, (phrase, j, phrase)
        words = _wide(text)
        x = np.zeros(len(text), np.uint64)
        for w in words.T:
            x = (x ^ w) * np.uint64(_BASE)
            x ^= x >> np.uint64(32)
        bucket = (x % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((*words.T, bucket))
        words, phrase, j = words[order], phrase[order], j[order]
        new = np.append(True, (words[1:] != words[:-1]).any(1))
        at = np.flatnonzero(new)
        return (text[order[at]], bucket[order[at]], np.minimum.reduceat(self.least[phrase], at),
                np.maximum.reduceat(self.most[phrase], at), (phrase, j, np.cumsum(new) - 1))


def _wide(strings):
    """Equally long byte strings as rows of 64-bit words."""
    import numpy as np

    wide = np.zeros((len(strings), -(-strings.shape[1] // 8) * 8), np.uint8)
    wide[:, : strings.shape[1]] = strings
    return wide.view("<u8")


def _phrases(block: int, table, asked, buckets: int, min_bytes: int):
    """Step 4: (bucket, block, n, phrases, single); single for strings of heavy triggers."""
    import pyarrow as pa

    b = Block(table, asked, buckets, min_bytes)
    text, to, least, most, _ = b.strings(buckets)
    out = [(int(b.bucket[lo]), hi - lo, _squeeze(b.rows[lo:hi], b.least[lo:hi], b.most[lo:hi]), False)
           for lo, hi in _runs_by(b.bucket[: b.light])]
    out += [(int(to[lo]), hi - lo, _squeeze(text[lo:hi], least[lo:hi], most[lo:hi]), True) for lo, hi in _runs_by(to)]
    return pa.table({"bucket": pa.array([o[0] for o in out], pa.int64()), "block": pa.array([block] * len(out), pa.int64()),
                     "n": pa.array([o[1] for o in out], pa.int64()), "phrases": pa.array([o[2] for o in out], pa.binary()),
                     "single": pa.array([o[3] for o in out], pa.bool_())})


def suffix_order(strings):
    """Sorted order of equally long byte strings and the common prefix of each
    with the one before it (-1 for the first)."""
    import numpy as np

    n, width = strings.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = strings
    order = np.lexsort(wide.view(">u8").T[::-1])
    s = strings[order]
    lcp = np.full(n, -1, np.int64)
    if n > 1:
        differ = s[1:] != s[:-1]
        lcp[1:] = np.where(differ.any(1), differ.argmax(1), width)
    return order, lcp


def first_documents(rows, least, min_bytes: int = MIN_BYTES):
    """Step 5: for every phrase and every ``j`` the smallest document that holds
    the string (``_NEVER`` where the phrase has no such string)."""
    import numpy as np

    reach = min_bytes - TRIGGER
    n = len(rows)
    left_order, left_lcp = suffix_order(rows[:, reach - 1::-1] if reach else rows[:, :0])
    right_order, right_lcp = suffix_order(rows[:, reach: reach + min_bytes])
    low, high = rows[:, -2], rows[:, -1]
    out = np.full((n, reach + 1), _NEVER, np.int64)
    left, right = np.empty(n, np.int64), np.empty(n, np.int64)
    for j in range(reach + 1):
        has = np.flatnonzero((low <= j) & (j <= high))
        if not len(has):
            continue
        left[left_order] = np.cumsum(left_lcp < j)
        right[right_order] = np.cumsum(right_lcp < min_bytes - j)
        both = left[has] * (n + 1) + right[has]
        order = np.argsort(both, kind="stable")
        b = both[order]
        new = np.append(True, b[1:] != b[:-1])
        first = np.minimum.reduceat(least[has[order]], np.flatnonzero(new))
        out[has[order], j] = first[np.cumsum(new) - 1]
    return out


def first_of_strings(strings, least):
    """Step 5 for single strings: the smallest document of all equal ones."""
    import numpy as np

    words = _wide(strings)
    order = np.lexsort(words.T)
    words = words[order]
    new = np.append(True, (words[1:] != words[:-1]).any(1))
    out = np.empty(len(order), np.int64)
    out[order] = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    return out[:, None]


def _judged(bucket: int, table, min_bytes: int):
    """Step 5: (block, bucket, n, found, single): which phrases (or single
    strings) lose strings, and to whom."""
    import numpy as np
    import pyarrow as pa

    out = []
    for single in (False, True):
        part = [x for x in zip(table["block"].to_pylist(), table["n"].to_pylist(), table["phrases"].to_pylist(), table["single"].to_pylist())
                if x[3] == single]
        if not part:
            continue
        rows, least, most, width = [], [], [], min_bytes if single else _width(min_bytes)
        for _, n, packed, _ in part:
            data = _spread(packed)
            rows.append(np.frombuffer(data, np.uint8, n * width).reshape(n, width))
            ends = np.frombuffer(data, np.uint8)[n * width:].copy().view("<i8")
            least.append(ends[:n])
            most.append(ends[n:])
        rows, least, most = np.concatenate(rows), np.concatenate(least), np.concatenate(most)
        first = first_of_strings(rows, least) if single else first_documents(rows, least, min_bytes)
        loses, at = (first < most[:, None]).any(1), 0
        for block, n, _, _ in part:
            pick = np.flatnonzero(loses[at: at + n])
            if len(pick):
                out.append((block, len(pick), _squeeze(pick.astype("<i8"), first[at + pick].astype("<i8")), single))
            at += n
    return pa.table({"block": pa.array([o[0] for o in out], pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int64()),
                     "n": pa.array([o[1] for o in out], pa.int64()), "found": pa.array([o[2] for o in out], pa.binary()),
                     "single": pa.array([o[3] for o in out], pa.bool_())})


def merged(starts, ends):
    """Maximal runs covered by intervals: [(start, end)]."""
    import numpy as np

    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, s[1:] > e[:-1])
    at = np.flatnonzero(new)
    return list(zip(s[at].tolist(), e[np.append(at[1:], len(s)) - 1].tolist()))


def _cut(table, asked, found, buckets: int, min_bytes: int):
    """Step 6: doc_id, n_bytes, kept, spans of every row of a block."""
    import numpy as np
    import pyarrow as pa

    spans: dict = {}
    if found:
        reach = min_bytes - TRIGGER
        b = Block(table, asked, buckets, min_bytes)
        first = np.full((len(b.rows), reach + 1), _NEVER, np.int64)
        start = {int(b.bucket[lo]): lo for lo, _ in _runs_by(b.bucket[: b.light])}
        text, to, _, _, (phrase, j, string) = b.strings(buckets)
        alone = {int(to[lo]): lo for lo, _ in _runs_by(to)}
        owner = np.full(len(text), _NEVER, np.int64)
        for bucket, n, packed, single in found:
            data = np.frombuffer(_spread(packed), "<i8")
            if single:
                owner[alone[bucket] + data[:n]] = data[n:]
            else:
                first[start[bucket] + data[:n]] = data[n:].reshape(n, reach + 1)
        first[phrase, j] = owner[string]
        goes = first[b.phrase] < b.doc[:, None]
        hit = np.flatnonzero(goes.any(1))
        goes = goes[hit]
        near, far = goes.argmax(1), reach - goes[:, ::-1].argmax(1)      # strings less than min_bytes apart overlap
        doc, lo, hi = b.doc[hit], b.place[hit] - far, b.place[hit] - near + min_bytes
        order = np.argsort(doc, kind="stable")
        doc, lo, hi = doc[order], lo[order], hi[order]
        for x, y in _runs_by(doc):
            spans[int(doc[x])] = merged(lo[x:y], hi[x:y])
    kept, cuts, sizes = [], [], []
    for i, data in zip(table["doc_id"].to_pylist(), table["data"]):
        data = data.as_py()
        own = spans.get(i, []) if i is not None else []
        own = [(s, min(e, len(data))) for s, e in own if s < len(data)]
        sizes.append(len(data))
        cuts.append([{"start": s, "end": e} for s, e in own])
        at, parts = 0, []
        for s, e in own:
            parts.append(data[at:s])
            at = e
        kept.append(b"".join([*parts, data[at:]]))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.table({"doc_id": table["doc_id"].cast(pa.int64()), "n_bytes": pa.array(sizes, pa.int64()),
                     "kept": pa.array(kept, pa.binary()), "spans": pa.array(cuts, pa.list_(span))})


def dedup_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes, kept (the remaining bytes), spans (removed runs: start,
    end) of every row.

    One plan: the exchange of the texts into blocks is made once and read by
    steps 3, 4 and 6.
    """
    if not TRIGGER < min_bytes < TRIGGER + 256:
        raise ValueError(f"min_bytes must lie between {TRIGGER + 1} and {TRIGGER + 255}")
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length(data))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    doc_id = F.col(id_col).cast("long")
    texts = docs.select(doc_id.alias("doc_id"), data.alias("data"), F.pmod(F.xxhash64(doc_id, F.when(doc_id.isNull(), data)), F.lit(blocks)).alias("block"))

    def triggers(key, table):
        return _triggers(key[0].as_py(), table, blocks, min_bytes)

    def repeated(key, table):
        return _repeated(key[0].as_py(), table)

    def phrases(key, table, asked):
        return _phrases(key[0].as_py(), table, _asked(asked), blocks, min_bytes)

    def judged(key, table):
        return _judged(key[0].as_py(), table, min_bytes)

    def cut(key, table, answers):
        import pyarrow.compute as pc

        is_key = pc.is_valid(answers["keys"])
        found = answers.filter(pc.invert(is_key)).sort_by("bucket")
        found = list(zip(found["bucket"].to_pylist(), found["n"].to_pylist(), found["found"].to_pylist(), found["single"].to_pylist()))
        return _cut(table, _asked(answers.filter(is_key)), found, blocks, min_bytes)

    def _asked(table):
        return list(zip(table["bucket"].to_pylist(), table["keys"].to_pylist()))

    asked = (texts.groupBy("block").applyInArrow(triggers, "bucket long, block long, keys binary")
             .groupBy("bucket").applyInArrow(repeated, "block long, bucket long, keys binary"))
    found = (texts.groupBy("block").cogroup(asked.groupBy("block"))
             .applyInArrow(phrases, "bucket long, block long, n long, phrases binary, single boolean")
             .groupBy("bucket").applyInArrow(judged, "block long, bucket long, n long, found binary, single boolean"))
    answers = asked.unionByName(found, allowMissingColumns=True)
    return (texts.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(cut, "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>"))
