"""Phrase collocations counted on a prefix-free parse of the texts.

A text becomes a row of tokens: words, and a break wherever a piece ends.  A
window of two tokens whose hash has a given remainder is a trigger; chunks
reach from one trigger to the next and overlap into it by as many tokens as a
phrase has words after its first.  Triggers follow from content alone, so a
passage that many texts share gives the same chunks in all of them: the
distinct chunks, with the number of times they occur in the parse, are the
dictionary.  Phrases are counted inside distinct chunks only, each count
weighted by the chunk's; a phrase belongs to the chunk that owns its first
word, so what lies in an overlap is counted once.

Most phrases are rare, and only those with ``min_count`` places matter (a part
of a phrase has at least as many).  So the dictionary lies in blocks, and each
block first sends short keys of its phrases, with counts, to buckets; a bucket
adds up equal keys and tells every block which of its keys reach ``min_count``.
Different phrases may share a key: then both pass, none is lost.  Blocks then
send the phrases that passed, as text, with their counts, and equal texts are
added up exactly.

Chunks and phrases are summed up inside tasks first, so a word, line or passage
that makes up a third of the corpus is one row for each task.  All counts are
exact and per language.

Edge cases: a null or empty text has no words; a null language is ``und``, as
is the language of that name; a language without candidates has no rows;
repeated rows count as often as they occur; no rows give no rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: A longer candidate with at least this percentage of a phrase's count absorbs it.
INSIDE = 50
#: A chunk starts where a window's hash is 0 modulo this; a run without a trigger is cut at LONGEST tokens.
MODULUS, LONGEST = 32, 2000
#: Bytes of distinct chunks a task holds before it sends them, and hashes remembered.
HELD_BYTES, HELD_HASHES = 24 << 20, 500_000
#: Bytes of a block of the dictionary, and phrases of all blocks that one bucket takes.
BLOCK_BYTES, BUCKET = 10 << 20, 4_000_000
KEY_BITS = 24

_BREAK = b"."
_TO_BREAK = bytes(_BREAK[0] if c in b".,;:!?\n\x0b\f\r" else c for c in range(256))


class _Hashes(dict):
    def __missing__(self, token):
        if len(self) > HELD_HASHES:
            self.clear()
        h = self[token] = zlib.crc32(token)
        return h


def tokens(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words and breaks; no word holds a break's byte."""
    return data.lower().translate(_TO_BREAK).replace(_BREAK, b" . ").split()


def parse(data: bytes, overlap: int, hashes: dict) -> list[bytes]:
    """The chunks of a text, in order; each ends with ``overlap`` tokens that it does not own."""
    import numpy as np

    toks = tokens(data)
    n = len(toks)
    if not n:
        return []
    toks += [_BREAK] * overlap
    h = np.fromiter(map(hashes.__getitem__, toks), np.uint64, n + overlap)
    window = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)
    at = np.flatnonzero(window[:n] % np.uint64(MODULUS) == 0).tolist()
    starts = at if at and at[0] == 0 else [0, *at]
    if max(np.diff([*starts, n]).tolist()) > LONGEST:
        starts = [s for a, b in zip(starts, [*starts[1:], n]) for s in range(a, b, LONGEST)]
    return [b" ".join(toks[a:b + overlap]) for a, b in zip(starts, [*starts[1:], n])]


def dictionary(docs: DataFrame, *, text_col: str = "text", lang_col: str | None = "lang", max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, chunk, times): the distinct chunks and how often the parse has them."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")) if lang_col else F.lit("und")
    rows = docs.select(lang.alias("lang"), F.col(text_col).cast("string").cast("binary").alias("data")).where("octet_length(data) > 0")

    def run(batches):
        import pyarrow as pa

        held: dict = {}
        hashes = _Hashes()
        size = 0

        def out():
            keys = list(held)
            made = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
                                               pa.array(list(held.values()), pa.int64())], names=["lang", "chunk", "times"])
            held.clear()
            return made

        for b in batches:
            for lang_, data in zip(b.column(0).to_pylist(), b.column(1)):
                for chunk in parse(data.as_py(), max_words - 1, hashes):
                    key = lang_, chunk
                    size += len(chunk) + 100
                    held[key] = held.get(key, 0) + 1
                if size > HELD_BYTES:
                    yield out()
                    size = 0
        if held:
            yield out()

    parsed = rows.mapInArrow(run, "lang string, chunk binary, times long")
    return parsed.groupBy("lang", "chunk").agg(F.sum("times").alias("times"))


def blocks(chunks: DataFrame) -> DataFrame:
    """(block, lang, data, times): the dictionary in blocks of one language;
    ``data`` has the chunks with line ends between them, ``times`` 8-byte integers."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        held: dict = {}
        size, made = 0, TaskContext.get().partitionId() << 32

        def out():
            nonlocal made
            for lang, (parts, times) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64()), pa.array([lang], pa.string()), pa.array([b"\n".join(parts)], pa.binary()),
                                                  pa.array([np.array(times, np.int64).tobytes()], pa.binary())], names=["block", "lang", "data", "times"])
                made += 1
            held.clear()

        for b in batches:
            for lang, chunk, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                parts, times = held.setdefault(lang, ([], []))
                parts.append(chunk)
                times.append(n)
                size += len(chunk)
                if size > BLOCK_BYTES:
                    yield from out()
                    size = 0
        yield from out()

    return chunks.mapInArrow(run, "block long, lang string, data binary, times binary")


class Phrases:
    """The distinct phrases of one word, two words, ... of a block, and their counts.

    A phrase is the number of its first words among the shorter phrases and the
    number of its last word; the order is the same whenever the block is read."""

    def __init__(self, data: bytes, times: bytes, max_words: int):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        chunks = pc.split_pattern(pa.array([data], pa.binary()), b"\n").flatten()
        words = pc.split_pattern(chunks, b" ")
        lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        self.words = coded.dictionary
        seq = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        stop = pc.index(self.words, _BREAK).as_py()
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(seq))      # tokens to the chunk's end, this one included
        weight = np.repeat(np.frombuffer(times, np.int64), lengths)
        at = np.flatnonzero((left >= max_words) & (seq != stop))
        v = len(self.words)
        prefix = np.zeros(len(at), np.int64)
        self.first, self.last, self.counts = [], [], []
        for n in range(max_words):
            if n:
                on = seq[at + n] != stop
                at, prefix = at[on], prefix[on]
            distinct, prefix = np.unique(prefix * v + seq[at + n], return_inverse=True)
            self.first.append(distinct // v)
            self.last.append(distinct % v)
            self.counts.append(np.bincount(prefix, weight[at], len(distinct)).astype(np.int64))

    def hashes(self, lang: str):
        """A 64-bit hash of every phrase with its language, shorter phrases first."""
        import numpy as np
        from xxhash import xxh64_intdigest

        seed = xxh64_intdigest(lang.encode())
        h = np.array([xxh64_intdigest(w) for w in self.words.to_pylist()] or [0], np.uint64)
        out, before = [], np.array([seed], np.uint64)
        for first, last in zip(self.first, self.last):
            x = before[first] * np.uint64(0x9E3779B97F4A7C15) + h[last]
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            before = x ^ (x >> np.uint64(27))
            out.append(before)
        return np.concatenate(out)

    def texts(self, chosen):
        """(phrases, counts) of the chosen ones (a mask over all, shorter first), length by length."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        at, need = 0, []
        for first in self.first:
            need.append(chosen[at: at + len(first)].copy())
            at += len(first)
        given = [x.copy() for x in need]
        for n in range(len(need) - 1, 0, -1):            # the first words of what is needed are needed
            need[n - 1][self.first[n][need[n]]] = True
        before = None
        for n, (first, last, counts) in enumerate(zip(self.first, self.last, self.counts)):
            on = np.flatnonzero(need[n])
            words = self.words.take(pa.array(last[on]))
            now = words if n == 0 else pc.binary_join_element_wise(before.take(pa.array(place[first[on]])), words, b" ")
            place = np.zeros(len(first), np.int64)
            place[on] = np.arange(len(on))
            before = now
            mine = np.flatnonzero(given[n])
            yield now.take(pa.array(place[mine])), counts[mine]


def key_rows(block_rows: DataFrame, buckets: int, max_words: int, least: int) -> DataFrame:
    """(bucket, block, keys, counts): per bucket a block's keys, in order, as
    ``KEY_BITS / 8`` planes of bytes, and their counts (``least`` and above alike)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for i in range(b.num_rows):
                block, lang, data, times = (b.column(c)[i].as_py() for c in range(4))
                found = Phrases(data, times, max_words)
                bucket, key, order = placed(found.hashes(lang), buckets)
                counts = np.minimum(np.concatenate(found.counts), least).astype(np.uint16)[order]
                bucket, key = bucket[order], key[order]
                here, starts = np.unique(bucket, return_index=True)
                ends = [*starts[1:].tolist(), len(bucket)]
                keys = [np.concatenate([(key[lo:hi] >> np.uint64(s) & np.uint64(255)).astype(np.uint8) for s in range(KEY_BITS - 8, -1, -8)]).tobytes()
                        for lo, hi in zip(starts.tolist(), ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here.astype(np.int64)), pa.array([block] * len(here), pa.int64()), pa.array(keys, pa.binary()),
                     pa.array([counts[lo:hi].tobytes() for lo, hi in zip(starts.tolist(), ends)], pa.binary())], names=["bucket", "block", "keys", "counts"])

    return block_rows.mapInArrow(run, "bucket long, block long, keys binary, counts binary")


def placed(hashes, buckets: int):
    """Bucket and key of each hash, and the order by both."""
    import numpy as np

    bucket = (hashes >> np.uint64(KEY_BITS)) % np.uint64(buckets)
    key = hashes & np.uint64((1 << KEY_BITS) - 1)
    return bucket, key, np.argsort(bucket << np.uint64(KEY_BITS) | key, kind="stable")


def passed(keys: DataFrame, least: int) -> DataFrame:
    """(block, answers): per block, by bucket, one bit for each key it sent: whether its total reaches ``least``."""
    dealt = keys.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def done(bucket, held):
            flat, counts = [], []
            for _, k, c in held:
                planes = np.frombuffer(k, np.uint8).reshape(KEY_BITS // 8, -1).astype(np.uint32)
                key = planes[0]
                for p in planes[1:]:
                    key = key << np.uint32(8) | p
                flat.append(key)
                counts.append(np.frombuffer(c, np.uint16))
            sizes = [len(x) for x in flat]
            _, which = np.unique(np.concatenate(flat), return_inverse=True)
            often = (np.bincount(which, np.concatenate(counts)) >= least)[which]
            bits, at = [], 0
            for n in sizes:
                bits.append(np.packbits(often[at: at + n]).tobytes())
                at += n
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([bucket] * len(held), pa.int64()),
                                               pa.array(bits, pa.binary())], names=["block", "bucket", "bits"])

        held: list = []
        now = None
        for b in batches:
            for i in range(b.num_rows):
                bucket, block, k, c = (b.column(j)[i].as_py() for j in range(4))
                if held and bucket != now:
                    yield done(now, held)
                    held = []
                now = bucket
                held.append((block, k, c))
        if held:
            yield done(now, held)

    told = dealt.mapInArrow(run, "block long, bucket long, bits binary")
    return told.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias("answers"))


def phrase_counts(chunks: DataFrame, *, max_words: int = MAX_WORDS, least: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, f) of all phrases of up to ``max_words`` words with ``least``
    places; the empty phrase has the number of words of its language."""
    table = materialize(blocks(chunks), "dictionary-blocks")
    size = table.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(1, -(-size // (2 * BUCKET)))            # about one distinct phrase for every two bytes
    answers = materialize(passed(key_rows(table, buckets, max_words, least), least).withColumnRenamed("block", "of_block"), "frequent-keys")
    # a merge join at every size; a block is one row
    both = table.hint("merge").join(answers, F.col("block") == F.col("of_block")).select("lang", "data", "times", "answers")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for i in range(b.num_rows):
                lang, data, times, told = (b.column(c)[i].as_py() for c in range(4))
                found = Phrases(data, times, max_words)
                bucket, _, order = placed(found.hashes(lang), buckets)
                sizes = np.unique(bucket, return_counts=True)[1]
                bits = [np.unpackbits(np.frombuffer(t["bits"], np.uint8), count=n) for t, n in zip(told, sizes.tolist())]
                chosen = np.zeros(len(bucket), bool)
                if len(order):
                    chosen[order] = np.concatenate(bits).astype(bool)
                for phrases, counts in [*found.texts(chosen), (pa.array([b""], pa.binary()), np.array([int(found.counts[0].sum())]))]:
                    for lo in range(0, len(counts), 50_000):
                        some = phrases.slice(lo, 50_000)
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), some.cast(pa.string()),
                                                          pa.array(counts[lo:lo + 50_000], pa.int64())], names=["lang", "phrase", "f"])

    sent = both.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return sent.where((F.col("f") >= least) | (F.col("phrase") == ""))


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def candidates(counts: DataFrame, *, inside: int = INSIDE) -> DataFrame:
    """(lang, phrase, a, l, r, k, score) of the phrases of two words and more in
    ``counts`` (lang, phrase, f), without those that a longer one absorbs.

    Each phrase asks for the counts of the parts of its cuts; a part that very
    many phrases ask for is one row of the table joined, and adaptive execution
    splits the phrases' side.
    """
    words = F.split("phrase", " ")
    rows = counts.where("phrase <> ''").select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.size(words).alias("m")).where("m > 1")
    cuts = F.transform(F.sequence(F.lit(1), F.col("m") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(0).alias("side"), _joined(F.col("w"), F.lit(1), k).alias("part")),
        F.struct(k.alias("k"), F.lit(1).alias("side"), _joined(F.col("w"), k + 1, F.col("m") - k).alias("part"))))
    asked = rows.select("lang", "phrase", "a", F.explode(F.flatten(cuts)).alias("c")).select("lang", "phrase", "a", "c.k", "c.side", "c.part")
    of = counts.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of_part"), "f")
    told = asked.join(of, (F.col("lang") == F.col("of_lang")) & (F.col("part") == F.col("of_part")))
    sides = told.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
                                                         F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    exact = F.expr("CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * CAST(1000000 AS DECIMAL(7,0)) "
                   "div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")
    lowest = sides.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.*")
    # what lies inside longer candidates, with the largest count of these
    subs = F.flatten(F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("m") - n + 1), lambda s: _joined(F.col("w"), s, n))))
    holders = (rows.where("m > 2").select(F.col("lang").alias("of_lang"), F.explode(subs).alias("of_part"), "a")
               .groupBy("of_lang", "of_part").agg(F.max("a").alias("longer")))
    near = scored.join(holders, (F.col("lang") == F.col("of_lang")) & (F.col("phrase") == F.col("of_part")), "left")
    return near.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside)).drop("of_lang", "of_part", "longer")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str | None = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    chunks = dictionary(docs, text_col=text_col, lang_col=lang_col, max_words=max_words)
    kept = materialize(phrase_counts(chunks, max_words=max_words, least=min_count), "phrase-counts")
    found = candidates(kept.where(F.col("f") >= min_count), inside=inside)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = kept.where("phrase = ''").select(F.col("lang").alias("of_lang"), F.col("f").alias("n"))          # one row a language
    return ranked.join(totals, F.col("lang") == F.col("of_lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
