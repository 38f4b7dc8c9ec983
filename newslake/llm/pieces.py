"""Sampled subword encoding over the piece lattice, and lossless decoding."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text sampled at once.  The lattice of words that all differ took 190 times that, so a slice is kept
#: small beside the worker itself; no result depends on it.
PIECE_BYTES = 256 << 10

# No piece holds a blank but at its start, and none a line feed, so every path of
# the lattice passes the ends of these chunks and they can be sampled one by one.
_CHUNKS = re.compile(r"\n| *[^ \n]+| +").findall


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with the blank as a space, their ids and log weights; ids of the 256 bytes."""

    pieces: dict[str, int]
    weights: dict[str, float]
    bytes_: tuple[int, ...]
    decoded: tuple[bytes, ...]
    longest: int


def read_vocabulary(path: str = MODEL, alpha: float = 1.0) -> Vocabulary:
    """Read a model file on the driver; workers get its pieces with the job.

    A model of merges holds ranks, not probabilities: Zipf's law turns rank r
    into the weight (r + 1) ** -alpha.  Larger ``alpha``: fewer, likelier pieces.
    """
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, weights, bytes_, decoded = {}, {}, {}, []
    for i in range(m.get_piece_size()):
        name = m.id_to_piece(i)
        if m.is_byte(i):
            bytes_[int(name[3:5], 16)] = i
            decoded.append(bytes([int(name[3:5], 16)]))
        elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            decoded.append(b"")
        else:
            text = name.replace("▁", " ")
            if " " not in text.lstrip(" ") and "\n" not in text:
                pieces[text], weights[text] = i, -alpha * math.log1p(max(0.0, -m.get_score(i)))
            decoded.append(text.encode())
    return Vocabulary(pieces, weights, tuple(bytes_[b] for b in range(256)), tuple(decoded), max(map(len, pieces)))


class Lattice:
    """Sampler of segmentations: all distinct chunks of many texts at once."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        chars = sorted({c for p in vocab.pieces for c in p})
        self.chars = np.array([ord(c) for c in chars], np.int64)
        place = {c: i for i, c in enumerate(chars)}
        # A trie of the pieces: (node, character) -> child.
        self.width, moves, ids = len(chars) + 1, {}, [-1]
        weights = [0.0]
        for piece, i in vocab.pieces.items():
            node = 0
            for c in piece:
                key = node * self.width + place[c]
                if key not in moves:
                    moves[key] = len(ids)
                    ids.append(-1)
                    weights.append(0.0)
                node = moves[key]
            ids[node], weights[node] = i, vocab.weights[piece]
        self._hash(np.fromiter(moves, np.int64, len(moves)), np.fromiter(moves.values(), np.int64, len(moves)))
        self.ids, self.weights = np.array(ids, np.int32), np.array(weights)
        self.byte_weight = min(weights) * 1.5
        # Place of each code point among the characters of the pieces; the last: none of them.
        self.place = np.full(0x110000, self.width - 1, np.int32)
        self.place[self.chars] = np.arange(len(chars))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _hash(self, keys: np.ndarray, children: np.ndarray) -> None:
        """Fill the table of the trie's moves: open addressing, at most an eighth full."""
        bits = max(4, int(8 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.child = np.full((1 << bits) + 64, -1, np.int64), np.full((1 << bits) + 64, -1, np.int32)
        self.probes, at = 0, self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            own = self.keys[at] == keys  # of several keys for one free slot one has got it
            self.child[at[own]] = children[own]
            keys, children, at = keys[~own], children[~own], at[~own] + 1
            self.probes += 1

    def _moves(self, keys: np.ndarray) -> np.ndarray:
        """Child of each (node, character) key, -1 if there is none."""
        at = self._slot(keys)
        held = self.keys[at]
        child = np.where(held == keys, self.child[at], -1).astype(np.int64)
        left = np.flatnonzero((held != keys) & (held >= 0))
        for step in range(1, self.probes):
            if not len(left):
                break
            held, key = self.keys[at[left] + step], keys[left]
            hit = held == key
            child[left[hit]] = self.child[at[left[hit]] + step]
            left = left[~hit & (held >= 0)]
        return child

    def _edges(self, codes: np.ndarray, begin: np.ndarray, end_of: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every piece at every place of the chunks: start, end, symbol, log weight.

        ``begin`` and ``end_of`` give the bounds of the chunk of each character.  A
        character that is no piece gets its UTF-8 bytes as one edge, with a symbol
        below zero: -1 - code point.  Places and symbols take four bytes each.
        """
        char = self.place[codes]
        start, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        single = np.zeros(len(codes), bool)
        found = []
        for depth in range(self.v.longest):
            child = self._moves(node * self.width + char[start + depth])
            ok = child >= 0
            start, node = start[ok], child[ok]
            full = self.ids[node] >= 0
            if depth == 0:
                single[start[full]] = True
            found.append((start[full].astype(np.int32), (start[full] + depth + 1).astype(np.int32), self.ids[node[full]], self.weights[node[full]]))
            more = start + depth + 1 < end_of[start]
            start, node = start[more], node[more]
            if not len(start):
                break
        lone = np.flatnonzero(~single)
        raw = 1 + (codes[lone] > 0x7F) + (codes[lone] > 0x7FF) + (codes[lone] > 0xFFFF)
        found.append((lone.astype(np.int32), (lone + 1).astype(np.int32), (-1 - codes[lone]).astype(np.int32), self.byte_weight * raw))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _filter(self, chunks: list[str], size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Forward weights of all chunks, one place of every chunk at a time.

        Returns the edges' start places and symbols, the running chance of each edge
        at its end node, and the first edge and number of edges of each end place.
        """
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        stop = np.cumsum(size)
        begin, end_of = np.repeat(stop - size, size), np.repeat(stop, size)
        start, end, sym, weight = self._edges(codes, begin, end_of)
        depth = end - begin[start]
        order = np.argsort(depth << 40 | end.astype(np.int64) << 5 | (end - start))
        start, end, sym, weight, depth = start[order], end[order], sym[order], weight[order], depth[order]
        new = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))  # first edge of each node
        head, fan = np.zeros(len(codes) + 1, np.int64), np.zeros(len(codes) + 1, np.int64)
        head[end[new]], fan[end[new]] = new, np.diff(np.append(new, len(end)))
        total = np.zeros(len(codes) + 1)  # by end place; what a start place holds is set below
        first = begin[start] == start
        chance = np.empty(len(start))
        levels = np.searchsorted(depth, np.arange(1, depth[-1] + 2)) if len(depth) else np.zeros(1, np.int64)
        heads = np.searchsorted(new, levels)
        for lo, hi, a, b in zip(levels[:-1].tolist(), levels[1:].tolist(), heads[:-1].tolist(), heads[1:].tolist(), strict=True):
            value = np.where(first[lo:hi], 0.0, total[start[lo:hi]]) + weight[lo:hi]
            cut = new[a:b] - lo
            top = np.maximum.reduceat(value, cut)
            width = np.diff(np.append(cut, hi - lo))
            odds = np.exp(value - np.repeat(top, width))
            mass = np.add.reduceat(odds, cut)
            total[end[new[a:b]]] = top + np.log(mass)
            run = np.cumsum(odds)
            base = np.repeat(run[cut] - odds[cut], width)
            part = np.minimum((run - base) / np.repeat(mass, width), 1.0)
            part[np.append(cut[1:], hi - lo) - 1] = 1.0
            chance[lo:hi] = part
        return start, sym, chance, head, fan

    def sample(self, texts: list[str | None], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and how many each text has.

        Walks every chunk backward from its end, all at once; the draw at a node is a
        hash of the row's seed and the node's place in the text.
        """
        chunks, per = [], []
        for t in texts:
            found = _CHUNKS(t) if t else []
            chunks += found
            per.append(len(found))
        if not chunks:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        distinct = list(dict.fromkeys(chunks))
        place = {c: i for i, c in enumerate(distinct)}
        lens = np.fromiter(map(len, distinct), np.int64, len(distinct))
        start, sym, chance, head, fan = self._filter(distinct, lens)
        which = np.fromiter(map(place.__getitem__, chunks), np.int64, len(chunks))
        doc = np.repeat(np.arange(len(texts)), per)
        size, base = lens[which], (np.cumsum(lens) - lens)[which]
        begin = np.cumsum(size) - size
        begin -= begin[np.searchsorted(doc, doc)]  # place of a chunk in its text
        seed = seeds.view(np.uint64)[doc]
        live, at = np.arange(len(chunks)), base + size
        steps = []
        while len(live):
            x = seed[live] + (begin[live] + at - base[live]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x ^= x >> np.uint64(shift)
                x *= np.uint64(by)
            x ^= x >> np.uint64(31)
            u = (x >> np.uint64(38)).astype(np.float64) / (1 << 26)
            edge = head[at]
            ask, last = np.flatnonzero(fan[at] > 1), edge + fan[at] - 1
            while len(ask):  # past every edge whose running chance is not above the draw
                ask = ask[chance[edge[ask]] <= u[ask]]
                edge[ask] += 1
                ask = ask[edge[ask] < last[ask]]
            steps.append((live, sym[edge]))
            at = start[edge]
            go = at > base[live]
            live, at = live[go], at[go]
        n = np.zeros(len(chunks), np.int64)
        for k, (who, _) in enumerate(steps):
            n[who] = k + 1
        ends = np.cumsum(n)
        ids = np.empty(ends[-1], np.int64)
        for k, (who, s) in enumerate(steps):
            ids[ends[who] - 1 - k] = s
        doc_of = np.repeat(doc, n)
        if (ids < 0).any():  # put the bytes of characters without a piece in place
            odd = np.flatnonzero(ids < 0)
            raw = [[self.v.bytes_[b] for b in chr(-1 - i).encode()] for i in ids[odd].tolist()]
            widths = np.ones(len(ids), np.int64)
            widths[odd] = [len(r) for r in raw]
            put = np.cumsum(widths) - widths
            out = np.repeat(ids, widths)
            out[np.concatenate([np.arange(p, p + len(r)) for p, r in zip(put[odd].tolist(), raw, strict=True)])] = np.concatenate(raw)
            ids, doc_of = out, np.repeat(doc_of, widths)
        return ids.astype(np.int32), np.bincount(doc_of, minlength=len(texts))


class Decoder:
    """Bytes of the pieces, one after another, and where each piece's begin."""

    def __init__(self, vocab: Vocabulary):
        self.raw = np.frombuffer(b"".join(vocab.decoded), np.uint8)
        self.size = np.fromiter(map(len, vocab.decoded), np.int64, len(vocab.decoded))
        self.begin = np.cumsum(self.size) - self.size

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ``ids``, ``ends`` apart; special ids carry no text."""
        size = self.size[ids]
        stop = np.concatenate(([0], np.cumsum(size)))
        raw = self.raw[np.repeat(self.begin[ids] - stop[:-1], size) + np.arange(stop[-1])].tobytes()
        at = stop[ends].tolist()
        return [raw[x:y].decode("utf-8", "replace") for x, y in zip(at[:-1], at[1:], strict=True)]


def decode_ids(ids: list[int], vocab: Vocabulary) -> str:
    """The text of a list of piece ids; special ids carry no text."""
    return b"".join([vocab.decoded[i] for i in ids]).decode("utf-8", "replace")


def encode(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
           decoded: bool = False, digest: bool = False) -> DataFrame:
    """One row per input row: ``rest`` (struct of all columns but the text), ``text``,
    ``ids`` (array of int) and, if asked for, ``decoded`` (the text of the ids) and
    ``ids_sha256`` (hex digest of the ids, 4 bytes each, little end first).

    The segmentation is drawn from all that give the text, each with a chance
    proportional to the product of its pieces' weights (forward filtering,
    backward sampling).  It depends on ``seed``, the row's key and the text alone:
    reruns and equal rows agree.  A null text has null ids, an empty one no ids.
    A character without a piece becomes its UTF-8 bytes, so any text comes back
    unchanged.
    """
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")).alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, decoder = Lattice(vocab), Decoder(vocab)
        for b in slices(batches, "text", PIECE_BYTES):
            texts = b.column("text").to_pylist()
            ids, n = lattice.sample(texts, b.column("seed").to_numpy(zero_copy_only=False).astype(np.int64))
            ends = np.concatenate(([0], np.cumsum(n)))
            mask = pa.array([t is None for t in texts], pa.bool_())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=mask)
            cols = [b.column("rest"), b.column("text"), lists]
            spans = [None if t is None else (x, y)
                     for t, x, y in zip(texts, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            if decoded:
                cols.append(pa.array([p and t for p, t in zip(spans, decoder.texts(ids, ends), strict=True)], pa.string()))
            if digest:
                raw = ids.astype("<i4").tobytes()
                cols.append(pa.array([p and hashlib.sha256(raw[4 * p[0]:4 * p[1]]).hexdigest() for p in spans], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=out.fieldNames())

    out = T.StructType([rows.schema["rest"], rows.schema["text"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
                       + [T.StructField("decoded", T.StringType())] * decoded
                       + [T.StructField("ids_sha256", T.StringType())] * digest)
    return rows.mapInArrow(run, out)


def decode(rows: DataFrame, vocab: Vocabulary, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the text of their piece ids as ``out_col``; null ids give null."""
    @F.pandas_udf("string")
    def run(ids):
        return ids.map(lambda x: None if x is None else decode_ids(list(x), vocab))

    return rows.withColumn(out_col, run(F.col(f"`{ids_col}`")))
