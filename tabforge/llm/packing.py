"""Best-fit packing of tokenized documents by the sum-of-squares rule.

``tokenize`` turns documents into pieces of at most ``capacity`` tokens;
``pack`` assigns every piece a sequence and an offset.  Lengths alone decide
the packing, so token ids never have to move: pieces are dealt at random into
shards of bounded size, every shard is packed on its own, and what lies in
sequences that are not full is dealt and packed again.

Edge cases: a null or empty text is the end-of-text id alone (one piece of
length 1); repeated rows are packed once for each row; no rows give no rows.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import DataFrame, functions as F, types as T

from .common import doc_input, materialize

CAPACITY = 1024
EOS = 2
#: Pieces that one task packs together: bounds a task's memory and time.
SHARD_PIECES = 2500
#: Tokens that a full sequence may lack, and rounds at most (each is a small part of the one before).
SLACK, MAX_ROUNDS = 8, 8
#: Distinct text chunks whose ids a task remembers.
CACHE_CHUNKS = 400_000

_ODD_SPACE = re.compile(r"\s | \s")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies -> byte value."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    table.update({chr(0x100 + i): b for i, b in enumerate(rest)})
    return table


def byte_bpe_encoder(tokenizer_json: str):
    """An encoder with the ids of a byte-level BPE ``tokenizer.json``.

    Such a vocabulary is the 256 bytes and then one entry for each merge in
    merge order, which is checked here; the rank of a merge is then its id.
    Special-token strings in a text are ordinary text.
    """
    import tiktoken

    with open(tokenizer_json, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
        raise ValueError("a byte-level BPE file without normalizer or prefix space is needed")
    vocab, alphabet = model["vocab"], byte_alphabet()
    last = -1
    for merge in model["merges"]:
        now = vocab["".join(merge.split(" ") if isinstance(merge, str) else merge)]
        if now <= last:
            raise ValueError("the ids do not follow the merge order")
        last = now
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in piece): i for piece, i in vocab.items() if piece not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


#: Fixed value: the published split pattern of byte-level BPE.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ChunkEncoder:
    """Text -> packed little-endian 32-bit ids, remembering frequent chunks.

    A chunk ends before a single space that stands between two visible
    characters.  No pre-token crosses such a place, so chunks encode
    independently of one another.
    """

    def __init__(self, encode, max_chunks: int = CACHE_CHUNKS):
        import array

        self._array, self._encode, self._max, self._seen = array.array, encode, max_chunks, {}

    def _miss(self, chunk: str) -> bytes:
        ids = self._array("I", self._encode(chunk)).tobytes()
        if len(self._seen) >= self._max:
            self._seen.clear()
        self._seen[chunk] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if _ODD_SPACE.search(text) or text[:1].isspace() or text[-1:].isspace():
            chunks = _BEFORE_SPACE.split(text)
        else:
            first, *rest = text.split(" ")
            chunks = [first, *[" " + c for c in rest]] if first else []
        get, miss = self._seen.get, self._miss
        return b"".join([get(c) or (miss(c) if c else b"") for c in chunks])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short."""
    head = n if n <= capacity else (n % capacity or capacity)
    return [(0, head), *[(s, capacity) for s in range(head, n, capacity)]]


def tokenize(docs: DataFrame, tokenizer_json: str, *, id_col: str = "doc_id", text_col: str = "text",
             capacity: int = CAPACITY, eos: int = EOS, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (, ids binary:
    little-endian unsigned 32-bit)."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                            ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids)
        encode = ChunkEncoder(byte_bpe_encoder(tokenizer_json).encode_ordinary)
        end = eos.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start: 4 * (start + length)]
                    rows.append((doc, k, start, length, zlib.crc32(part)) + (part,) * with_ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows
                                             else [pa.array([], f.type) for f in schema], schema=schema)

    return doc_input(docs, id_col, text_col).mapInArrow(run, kind)


def sum_of_squares(lengths, capacity: int):
    """(bin, offset) of each length, in the order given.

    ``open_bins[g]`` counts the open bins with ``g`` tokens left.  A piece goes
    to the gap, or into a new bin, for which the sum of the squared counts
    becomes smallest; of equal choices the tightest existing gap wins.
    """
    import numpy as np

    open_bins = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, s in enumerate(lengths):
        s = int(s)
        if s < capacity:
            here = open_bins[s:capacity]                     # gaps s .. capacity-1
            change = 2 * (open_bins[: capacity - s] - here) + 2
            change[0] = 1 - 2 * here[0]                      # fills the bin: nothing stays open
            change[here == 0] = 1 << 40
            k = int(change.argmin())
            if change[k] <= 2 * open_bins[capacity - s] + 1:
                gap = s + k
                b = stacks[gap].pop()
                open_bins[gap] -= 1
                bins[i], offsets[i] = b, capacity - gap
                if k:
                    stacks[k].append(b)
                    open_bins[k] += 1
                continue
            stacks[capacity - s].append(made)
            open_bins[capacity - s] += 1
        bins[i] = made
        made += 1
    return bins, offsets


def pack_shards(pieces: DataFrame, shards: int, round_: int, capacity: int) -> DataFrame:
    """``pieces`` dealt by a hash of (doc_id, piece) and packed shard by shard, with
    sequence_id, offset and ``full``: whether the sequence is full but for ``SLACK`` tokens."""
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
                        T.StructField("full", T.BooleanType())])

    def run(key, group):
        import numpy as np
        import pyarrow as pa

        group = group.drop_columns(["shard"])
        lengths = group["length"].to_numpy()
        order = np.lexsort((group["piece"].to_numpy(), group["doc_id"].to_numpy(), -lengths))
        b, o = sum_of_squares(lengths[order], capacity)
        bins, offsets = np.empty_like(b), np.empty_like(o)
        bins[order], offsets[order] = b, o
        full = np.bincount(bins, lengths)[bins] >= capacity - SLACK
        return (group.append_column("sequence_id", pa.array((bins * shards + key[0].as_py()) * MAX_ROUNDS + round_))
                .append_column("offset", pa.array(offsets)).append_column("full", pa.array(full)))

    shard = F.pmod(F.xxhash64("doc_id", "piece", F.lit(round_)), F.lit(shards)).alias("shard")
    return pieces.select("*", shard).groupBy("shard").applyInArrow(run, out)


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (needs doc_id, piece, length) with sequence_id and offset.

    Each round deals its pieces into as many shards as their count asks for and
    places longer pieces of a shard first.  Only full sequences stay; the pieces
    of the others, few of every shard, make up the next, much smaller round,
    until one shard is left or a round fills less than half of what it gets.
    """
    pieces = materialize(pieces, "pieces")
    n, done = pieces.count(), None
    for round_ in range(MAX_ROUNDS):
        shards = max(1, -(-n // shard_pieces))
        packed = materialize(pack_shards(pieces, shards, round_, capacity), "packed")
        open_ = packed.where("NOT full")
        left = 0 if shards == 1 else open_.count()
        last = left == 0 or 2 * left > n or round_ + 1 == MAX_ROUNDS
        kept = (packed if last else packed.where("full")).drop("full")
        done = kept if done is None else done.unionByName(kept)
        if last:
            return done
        pieces, n = open_.drop("sequence_id", "offset", "full"), left
