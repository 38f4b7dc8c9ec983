"""Removal of passages that occur more than once, by fixed-block anchors.

Any run of ``window`` words contains one whole block of ``(window + 1) // 2`` words
at a multiple of that block length, wherever the run starts.  So the blocks of
all texts that do not overlap are the index, and every rolling window of block
length is a probe: a probe that meets a block elsewhere is an anchor.  Around
each anchor the runs of ``window`` words through it are compared exactly with all
others of that kind, which extends the anchors to the maximal exact repeats.

Probes, index and runs travel as packed arrays, one row for a batch of texts and
a range of hash values, so a word costs a few bytes in the shuffle.  A passage
that a third of all texts share is a few entries in each batch, not a key whose
rows meet pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.llm.common import batch, slices, words_of

WINDOW = 35
#: Bytes of text handled at once in a task.
PIECE = 8 << 20

_PACKED = pa.schema([("bin", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()), ("lens", pa.binary()),
                     ("h", pa.binary()), ("g", pa.binary())])
_PACKED_DDL = "bin int, kind int, ids binary, lens binary, h binary, g binary"
_HITS = pa.schema([("id", pa.int64()), ("bin", pa.int32()), ("hits", pa.binary())])
_HITS_DDL = "id long, bin int, hits binary"

# Odd multipliers of the two rolling hashes and the multipliers that finish them.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ``base`` and of its inverse modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        out = []
        for x in (base, pow(base, -1, 1 << 64)):
            p = np.full(max(n, 4096), x, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _powers[base] = (out[0], out[1])
    return have


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, by a rolling polynomial."""
    n = len(words)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = _power(_BASES[which], n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    x = (total[size:] - total[:-size]) * down[:n - size + 1]
    for shift, by in zip((30, 27), _MIX, strict=True):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(by)
    return x ^ (x >> np.uint64(31))


def _bins(h: np.ndarray, bins: int) -> np.ndarray:
    """Equal ranges of the hash values; grows with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)


def _probes(words: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text's distinct rolling hashes in order, which of these occur once and
    only as an indexed block, and the hashes of its indexed blocks."""
    h = gram_hashes(words, block)
    order = np.argsort(h, kind="stable")
    s = h[order]
    starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)
    alone = np.diff(np.append(starts, len(s))) == 1
    own = alone & (order[starts] % block == 0)
    return s[starts], own, h[::block]


def _cut(bins: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by bin (stable) and where each bin starts in it."""
    order = np.argsort(bins.astype(np.uint16 if count < 1 << 16 else np.int64), kind="stable")
    return order, np.searchsorted(bins[order], np.arange(count + 1))


def _text_rows(kind: int, ids: np.ndarray, doc: np.ndarray, h: np.ndarray, g: np.ndarray | None, bins: int, low: bool) -> list[dict]:
    """Rows of one piece that name their texts: for each bin the hashes text by text."""
    if not len(h):
        return []
    order, at = _cut(_bins(h, bins), bins)
    doc, h, g = doc[order], h[order], None if g is None else g[order]
    rows = []
    for k in np.flatnonzero(np.diff(at)):
        d, part = doc[at[k]:at[k + 1]], h[at[k]:at[k + 1]]
        first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        rows.append({"bin": k, "kind": kind, "ids": ids[d[first]].tobytes(),
                     "lens": np.diff(np.append(first, len(d))).astype(np.uint32).tobytes(),
                     "h": (part.astype(np.uint32) if low else part).tobytes(),
                     "g": None if g is None else g[at[k]:at[k + 1]].tobytes()})
    return rows


def _block_rows(index: np.ndarray, bins: int) -> list[dict]:
    """Index rows of one piece: 31 bits of each block beside its bin, once; the last
    bit says that the piece has the block more than once."""
    order, at = _cut(_bins(index, bins), bins)
    rows = []
    for k in np.flatnonzero(np.diff(at)):
        v, n = np.unique(index[order[at[k]:at[k + 1]]].astype(np.uint32) & np.uint32(0xFFFFFFFE), return_counts=True)
        rows.append({"bin": k, "kind": 0, "h": (v | (n > 1)).astype(np.uint32).tobytes()})
    return rows


def _run_rows(ids: np.ndarray, doc: np.ndarray, h: np.ndarray, g: np.ndarray, bins: int) -> list[dict]:
    """Rows of one piece's runs (``doc`` -1: of a text with copies): kind 0 the runs
    known to repeat, once each; kind 1 the others with their text; kind 2 the texts
    of the known ones, to be answered as they are."""
    order = np.lexsort((doc, g, h))
    doc, h, g = doc[order], h[order], g[order]
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1]))))
    count = np.diff(np.append(first, len(h)))
    known = (count > 1) | (doc[first] < 0)
    again = np.repeat(known, count)
    rows = []
    hk, gk = h[first[known]], g[first[known]]
    at = np.searchsorted(_bins(hk, bins), np.arange(bins + 1))
    for k in np.flatnonzero(np.diff(at)):
        rows.append({"bin": k, "kind": 0, "h": hk[at[k]:at[k + 1]].tobytes(), "g": gk[at[k]:at[k + 1]].tobytes()})
    for kind, pick in ((1, ~again), (2, again & (doc >= 0))):
        by_doc = np.flatnonzero(pick)
        by_doc = by_doc[np.argsort(doc[by_doc], kind="stable")]
        rows += _text_rows(kind, ids, doc[by_doc], h[by_doc], g[by_doc] if kind == 1 else None, bins, False)
    return rows


def _emit(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 256):
        part = rows[at:at + 256]
        yield batch(_PACKED, **{f.name: [r.get(f.name) for r in part] for f in _PACKED})


def _probe_side(block: int, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            ids, lists, blocks = [], [], []
            for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if len(words) < block:
                    continue
                u, own, idx = _probes(word_hashes(words), block)
                # The last bit of a probe says that the text itself gives the index this block and no more.
                lists.append((u & np.uint64(0xFFFFFFFFFFFFFFFE)) | own.astype(np.uint64))
                ids.append(i)
                blocks.append(idx)
            if lists:
                doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
                yield from _emit(_block_rows(np.concatenate(blocks), bins) + _text_rows(
                    1, np.array(ids, np.int64), doc, np.concatenate(lists), None, bins, True))
    return run


def _by_bin(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, dict]]:
    for b in batches:
        cols = {f.name: b.column(f.name) for f in _PACKED}
        for r in range(b.num_rows):
            yield cols["bin"][r].as_py(), cols["kind"][r].as_py(), {k: cols[k][r].as_py() for k in ("ids", "lens", "h", "g")}


def _answers(k: int, row: dict, hit: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each text of a probe row with hits, the values that hit."""
    lens = np.frombuffer(row["lens"], np.uint32)
    doc = np.repeat(np.arange(len(lens)), lens)[hit]
    if not len(doc):
        return
    value = value[hit]
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    cut = np.append(first, len(doc))
    yield batch(_HITS, id=np.frombuffer(row["ids"], np.int64)[doc[first]], bin=np.full(len(first), k, np.int32),
                hits=[value[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)])


def _meet_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answer, bin by bin, the probes whose block is elsewhere too."""
    now, parts, known, many = None, [], None, None
    for k, kind, row in _by_bin(batches):
        if k != now:
            now, parts, known = k, [], None
        if kind == 0:
            parts.append(np.frombuffer(row["h"], np.uint32))
            continue
        if known is None:
            v = np.sort(np.concatenate(parts)) if parts else np.empty(0, np.uint32)
            base = v & np.uint32(0xFFFFFFFE)
            first = np.flatnonzero(np.concatenate(([True], base[1:] != base[:-1]))) if len(v) else np.empty(0, np.int64)
            known, parts = base[first], []
            many = np.add.reduceat(1 + (v & 1).astype(np.int64), first) > 1 if len(v) else np.empty(0, bool)
        if not len(known):
            continue
        p = np.frombuffer(row["h"], np.uint32)
        base = p & np.uint32(0xFFFFFFFE)
        at = np.minimum(np.searchsorted(known, base), len(known) - 1)
        hit = (known[at] == base) & (many[at] | ((p & 1) == 0))
        yield from _answers(k, row, hit, base)


def _meet_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answer, bin by bin, the runs that occur at two places or more.  A bin holds
    each piece's known runs once and the runs that a piece has at one place."""
    now, known, single = None, [], []

    def answer() -> Iterator[pa.RecordBatch]:
        if not single:
            return
        h = np.concatenate([np.frombuffer(r["h"], np.uint64) for r in [*known, *single]])
        g = np.concatenate([np.frombuffer(r["g"], np.uint32) for r in [*known, *single]])
        sure = sum(len(r["h"]) for r in known) // 8
        order = np.lexsort((g, h))
        first = np.flatnonzero(np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1]))))
        count = np.diff(np.append(first, len(h)))
        many = (count > 1) | (np.minimum.reduceat(order, first) < sure)
        hit = np.empty(len(h), bool)
        hit[order] = np.repeat(many, count)
        at = sure
        for r in single:
            n = len(r["h"]) // 8
            yield from _answers(now, r, hit[at:at + n], h[at:at + n])
            at += n

    for k, kind, row in _by_bin(batches):
        if k != now:
            yield from answer()
            now, known, single = k, [], []
        if kind == 0:
            known.append(row)
        elif kind == 1:
            single.append(row)
        else:
            h = np.frombuffer(row["h"], np.uint64)
            yield from _answers(k, row, np.ones(len(h), bool), h)
    yield from answer()


def _run_side(window: int, block: int, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            ids, docs, all_h, all_g = [], [], [], []
            for i, text, anchors, first in zip(*(b.column(c).to_pylist() for c in ("id", "text", "anchors", "first_copy")), strict=True):
                if text is None or first is False or not (anchors or first):
                    continue
                words = word_hashes(words_of(text))
                if len(words) < window:
                    continue
                if first:  # every run of a text with copies repeats; its first copy tells the others
                    near = slice(None)
                else:
                    h = gram_hashes(words, block)
                    hits = [np.frombuffer(a["hits"], np.uint32) for a in anchors]
                    places = [np.full(len(x), a["bin"], np.int64) for a, x in zip(anchors, hits, strict=True)]
                    # A bin and 31 bits beside it name a probe.
                    met = np.isin(_bins(h, bins) << 32 | (h & np.uint64(0xFFFFFFFE)).astype(np.int64),
                                  np.concatenate(places) << 32 | np.concatenate(hits))
                    seen = np.concatenate(([0], np.cumsum(met)))
                    reach = window - block + 1
                    near = np.flatnonzero(seen[reach:] > seen[:-reach])  # runs with an anchor inside
                rh = gram_hashes(words, window)[near]
                all_h.append(rh)
                all_g.append((gram_hashes(words, window, 1)[near] >> np.uint64(32)).astype(np.uint32))
                docs.append(np.full(len(rh), -1 if first else len(ids), np.int64))
                ids.append(i)
            if docs and sum(map(len, docs)):
                yield from _emit(_run_rows(np.array(ids, np.int64), np.concatenate(docs), np.concatenate(all_h),
                                           np.concatenate(all_g), bins))
    return run


def kept_words(text: str | None, window: int, repeats: np.ndarray | None, copied: bool = False) -> tuple[int, int, list[bytes]]:
    """Number of words, number removed, and the words left, given the hashes of the
    text's runs that occur elsewhere, or that the whole text does (``copied``)."""
    words = words_of(text)
    if copied and len(words) >= window:
        return len(words), len(words), []
    if repeats is None or not len(repeats):
        return len(words), 0, words
    again = np.isin(gram_hashes(word_hashes(words), window), repeats)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    cover = np.cumsum(edge[:-1]) > 0
    return len(words), int(cover.sum()), [w for w, c in zip(words, cover.tolist(), strict=True) if not c]


def _final_side(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", PIECE):
            n, gone, kept = [], [], []
            for text, runs, first in zip(*(b.column(c).to_pylist() for c in ("text", "runs", "first_copy")), strict=True):
                rep = np.concatenate([np.frombuffer(r["hits"], np.uint64) for r in runs]) if runs else None
                x, y, left = kept_words(text, window, rep, first is not None)
                n.append(x)
                gone.append(y)
                kept.append(b" ".join(left).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [b.column("rest"), b.column("text"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=["rest", "text", "n_words", "n_removed", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove every word covered by a run of ``window`` words that starts anywhere else too.

    Returns one row per input row: ``rest`` (struct of all input columns but the
    text, whatever their names), ``text`` (as given), ``n_words``, ``n_removed`` and
    ``kept_text`` (remaining words joined by one space, unchanged otherwise).
    Runs are judged on the input: all places of a repeated run go, the first as
    well, within a text as across texts; a row that repeats counts as another
    place.  Null or empty text: no words, nothing removed.  Answers return to their
    texts by a hash of id and text; null or repeated ids do no harm, and since an
    answer names the runs that repeat, one that reaches another text does none
    either.  Runs are compared by 96 bits of hash.
    """
    spark = docs.sparkSession
    block = (window + 1) // 2
    # An executor holds the index of one bin; answers are one row a text and bin.
    bins = 32 + int(spark.conf.get("spark.sql.shuffle.partitions")) // 4
    rest = [c for c in docs.columns if c != text_col]
    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(f"`{text_col}`").alias("text"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("id"))

    # Texts with exact copies repeat as a whole, which takes two narrow shuffles and no run.
    prints = docs.select(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("t1"),
                         F.xxhash64(F.lit(1), F.col(f"`{text_col}`")).alias("t2"))
    copied = prints.groupBy("t1", "t2").agg(F.count("*").alias("n"), F.min("id").alias("low")).where("n > 1")
    copies = prints.join(copied, ["t1", "t2"]).groupBy("id").agg(F.max(F.col("id") == F.col("low")).alias("first_copy"))

    def meet(packed: DataFrame, how, name: str) -> DataFrame:
        answers = packed.repartition("bin").sortWithinPartitions("bin", "kind").mapInArrow(how, _HITS_DDL)
        return answers.groupBy("id").agg(F.collect_list(F.struct("bin", "hits")).alias(name))

    probes = texts.select("id", "text").mapInArrow(_probe_side(block, bins), _PACKED_DDL)
    anchored = texts.join(meet(probes, _meet_blocks, "anchors"), "id", "left").join(copies, "id", "left")
    runs = anchored.mapInArrow(_run_side(window, block, bins), _PACKED_DDL)
    judged = texts.join(meet(runs, _meet_runs, "runs"), "id", "left").join(copies, "id", "left")
    out = T.StructType([texts.schema["rest"], texts.schema["text"], T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return judged.select("rest", "text", "runs", "first_copy").mapInArrow(_final_side(window), out)
