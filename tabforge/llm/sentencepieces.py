"""SentencePiece encoding and decoding with an Aho-Corasick Viterbi pass.

One automaton holds every piece of the vocabulary.  Reading a text once, each
character leads to a state whose output links list all pieces that end there;
each of them relaxes the best score at that position.  Walking back from the
end gives the segmentation with the highest total of piece scores; of equal
totals the one with the longer last piece wins.  Characters that no piece
covers fall back to byte pieces at ``BYTE_COST`` a byte.

The space is the word mark and one is put before a text, as in SentencePiece.
No piece but a run of spaces has a space after its first character, and none
holds a line end, so a text falls into chunks that encode independently;
frequent chunks are remembered, up to a bound.

Edge cases: a null or empty text has no piece (its prefix space is dropped);
the mark U+2581 inside a text goes to byte pieces, so decoding is exact for
every text; repeated rows give repeated results; no rows give no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from .common import doc_input

MARK = "▁"
#: Score of a byte piece, below that of any sum of ordinary pieces it could replace.
BYTE_COST = -1.0e12
CACHE_CHUNKS = 300_000
_CHUNK = re.compile(r"\n| *[^ \n]+| +")


def load_pieces(model_file: str):
    """[(piece with spaces for marks, id, score)] and the id of each byte piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, of_byte = [], [None] * 256
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            of_byte[int(sp.id_to_piece(i)[1:-1], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces.append((sp.id_to_piece(i).replace(MARK, " "), i, sp.get_score(i)))
    if None in of_byte:
        raise ValueError("the vocabulary needs a piece for every byte")
    return pieces, of_byte


class Encoder:
    """Text <-> ids for a piece vocabulary."""

    def __init__(self, pieces, of_byte, max_chunks: int = CACHE_CHUNKS):
        self.of_byte, self.max, self.seen = of_byte, max_chunks, {}
        self.text = {i: p for p, i, _ in pieces}
        self.byte = {i: b for b, i in enumerate(of_byte)}
        if any("\n" in p or (" " in p[1:] and p.strip(" ")) for p, _, _ in pieces):
            raise ValueError("a piece crosses a chunk boundary")
        # trie, then failure and output links in breadth-first order
        self.go: list[dict] = [{}]
        self.out: list = [None]                      # (length, id, score) of the piece that a state spells
        for p, i, s in pieces:
            v = 0
            for c in p:
                w = self.go[v].get(c)
                if w is None:
                    w = self.go[v][c] = len(self.go)
                    self.go.append({})
                    self.out.append(None)
                v = w
            if self.out[v] is None or s > self.out[v][2]:
                self.out[v] = (len(p), i, s)
        self.fail = [0] * len(self.go)
        self.output: list = [None] * len(self.go)    # nearest state on the failure path that spells a piece
        queue = list(self.go[0].values())
        for v in queue:
            for c, w in self.go[v].items():
                f = self.fail[v]
                while f and c not in self.go[f]:
                    f = self.fail[f]
                self.fail[w] = self.go[f].get(c, 0)
                queue.append(w)
        for v in queue:
            f = self.fail[v]
            self.output[v] = f if self.out[f] is not None else self.output[f]
        # all pieces that end in a state, by the output links, longest first
        self.ending: list[tuple] = [()] * len(self.go)
        for v in queue:
            rest = self.ending[self.output[v]] if self.output[v] else ()
            self.ending[v] = ((self.out[v],) if self.out[v] else ()) + rest

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of one chunk."""
        go, fail, ending = self.go, self.fail, self.ending
        best: list[float] = [0.0]
        back: list = [None]
        v = 0
        for at, c in enumerate(text, 1):
            while v and c not in go[v]:
                v = fail[v]
            v = go[v].get(c, 0)
            top, how = best[at - 1] + BYTE_COST * len(c.encode()), None
            for found in ending[v]:
                s = best[at - found[0]] + found[2]
                if s > top:
                    top, how = s, found
            best.append(top)
            back.append(how)
        ids: list[int] = []
        at = len(text)
        while at:
            how = back[at]
            if how is None:
                ids.extend(self.of_byte[b] for b in reversed(text[at - 1].encode()))
                at -= 1
            else:
                ids.append(how[1])
                at -= how[0]
        ids.reverse()
        return ids

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        import array

        if not text:
            return b""
        seen, out = self.seen, []
        for chunk in _CHUNK.findall(" " + text):
            ids = seen.get(chunk)
            if ids is None:
                if len(seen) >= self.max:
                    seen.clear()
                ids = seen[chunk] = array.array("I", self.viterbi(chunk)).tobytes()
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        import array

        return array.array("I", self.encode_packed(text)).tolist()


def _spelled(enc: Encoder) -> dict[int, bytes]:
    return {i: p.encode() for i, p in enc.text.items()} | {i: bytes([b]) for i, b in enc.byte.items()}


def _text(spelled, ids: bytes) -> str:
    import array

    return b"".join(map(spelled.__getitem__, array.array("I", ids))).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit)."""
    def run(batches):
        import pyarrow as pa

        enc = Encoder(*load_pieces(model_file))
        for b in batches:
            ids = [enc.encode_packed(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return doc_input(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model_file: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of packed ids; a null counts as no ids, and bytes that are
    not valid UTF-8 become U+FFFD."""
    def run(batches):
        import pyarrow as pa

        spelled = _spelled(Encoder(*load_pieces(model_file)))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_text(spelled, x.as_py()) for x in b.column(1)], pa.string())], names=["doc_id", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded: every text encoded and its ids decoded again, in one pass."""
    def run(batches):
        import pyarrow as pa

        enc = Encoder(*load_pieces(model_file))
        spelled = _spelled(enc)
        for b in batches:
            ids = [enc.encode_packed(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array([_text(spelled, x) for x in ids], pa.string())],
                                             names=["doc_id", "ids", "decoded"])

    return doc_input(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary, decoded string")
