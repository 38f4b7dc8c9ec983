"""Document scores by masked pseudo-likelihood under a bidirectional window network.

Every token is hidden once and predicted from its neighbours on both sides; the
sum of the conditional log probabilities scores the text.  A token is the hash of
a lower-cased word in two digits: the network gives the first digit and, given it,
the second.  It is trained in numpy on all texts: every partition trains its own
copy over its texts and the copies are averaged by tokens, round by round.  A mean
of many copies moves only as far as one of them, so a round of few updates a copy
goes further along it (:func:`reach_of`).  No count, parameter or choice rests on a
part of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.llm.common import slices, words_of

DIGIT = 64
CODES = DIGIT * DIGIT
PAD = CODES
#: Neighbours on each side, hidden units, tokens an update, step size, rounds of averaging.
REACH, HIDDEN, UPDATE, STEP, ROUNDS = 2, 16, 8192, 0.05, 2
CHUNK = 1 << 13
#: Updates whose way a round's move may cover, if its copies make fewer.
COVERED = 256
#: Words whose codes a worker remembers.
REMEMBERED = 1 << 18
_OFFSETS = [o for o in range(-REACH, REACH + 1) if o]
_SHAPES = {"context": (len(_OFFSETS), CODES + 1, HIDDEN), "shift": (HIDDEN,), "first": (HIDDEN, DIGIT), "first_b": (DIGIT,),
           "second": (HIDDEN, DIGIT), "second_b": (DIGIT, DIGIT)}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


class _Codes(dict):
    """Codes of the words met so far."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = xxhash.xxh3_64_intdigest(word) % CODES
        return code


_KNOWN = _Codes()


def codes_of(text: str | None) -> np.ndarray:
    """Token codes of a text."""
    words = words_of(text and text.lower())
    if len(_KNOWN) > REMEMBERED:
        _KNOWN.clear()
    return np.fromiter(map(_KNOWN.__getitem__, words), np.int64, len(words))


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parts of a parameter vector."""
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def fresh(counts: np.ndarray) -> np.ndarray:
    """Start parameters: small seeded noise, and biases that give each token its
    frequency in the corpus."""
    flat = (np.random.default_rng(7).standard_normal(SIZE) * 0.05).astype(np.float32)
    p = views(flat)
    table = counts.reshape(DIGIT, DIGIT) + 0.5
    p["first_b"][:] = np.log(table.sum(1) / table.sum())
    p["second_b"][:] = np.log(table / table.sum(1, keepdims=True))
    p["shift"][:] = 0
    return flat


def lay_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts with padding between them, places and owners of the tokens."""
    gap = np.full(REACH, PAD)
    line = np.concatenate([gap, *[x for t in texts for x in (t, gap)]])
    lens = np.array([len(t) for t in texts])
    starts = REACH + np.cumsum(lens + REACH) - (lens + REACH)
    owner = np.repeat(np.arange(len(texts)), lens)
    place = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(starts, lens)
    return line, place, owner


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(0)
    np.exp(x, out=x)
    x /= x.sum(0)
    return x


def forward(p: dict[str, np.ndarray], line: np.ndarray, place: np.ndarray) -> tuple:
    """Digits and contexts at some places, the hidden layer with the first digit's
    indicator under it, and the chances of both digits; one column a place."""
    context = [line[place + o] for o in _OFFSETS]
    d1, d2 = np.divmod(line[place], DIGIT)
    x = np.zeros((HIDDEN + DIGIT, len(place)), np.float32)
    x[:HIDDEN] = (p["shift"] + sum(p["context"][k].take(c, 0) for k, c in enumerate(context))).T
    np.tanh(x[:HIDDEN], out=x[:HIDDEN])
    x[HIDDEN + d1, np.arange(len(place))] = 1
    a = p["first"].T @ x[:HIDDEN]
    a += p["first_b"][:, None]
    return d1, d2, context, x, _softmax(a), _softmax(np.concatenate([p["second"], p["second_b"]]).T @ x)


def log_chances(p: dict[str, np.ndarray], line: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Conditional log probability of the token at each place given its neighbours."""
    out = np.empty(len(place))
    for at in range(0, len(place), UPDATE):
        d1, d2, _, _, a, b = forward(p, line, place[at:at + UPDATE])
        i = np.arange(len(d1))
        out[at:at + UPDATE] = np.log(a[d1, i].astype(np.float64) + 1e-30) + np.log(b[d2, i].astype(np.float64) + 1e-30)
    return out


def train(flat: np.ndarray, seen: np.ndarray, line: np.ndarray, place: np.ndarray) -> None:
    """One pass of Adagrad over the tokens, in place; ``seen`` holds the squares so far."""
    p = views(flat)
    grad, step = np.empty_like(flat), np.empty_like(flat)
    g = views(grad)
    units = np.arange(HIDDEN)
    for at in range(0, len(place), UPDATE):
        part = place[at:at + UPDATE]
        d1, d2, context, x, a, b = forward(p, line, part)
        h, i = x[:HIDDEN], np.arange(len(part))
        a[d1, i] -= 1
        b[d2, i] -= 1
        a /= len(part)
        b /= len(part)
        g["first"][:], g["first_b"][:] = h @ a.T, a.sum(1)
        both = x @ b.T
        g["second"][:], g["second_b"][:] = both[:HIDDEN], both[HIDDEN:]
        dh = (p["first"] @ a + p["second"] @ b) * (1 - h * h)
        g["shift"][:] = dh.sum(1)
        weights = dh.T.astype(np.float64).ravel()
        for k, c in enumerate(context):
            cell = (c[:, None] * HIDDEN + units).ravel()
            g["context"][k] = np.bincount(cell, weights, (CODES + 1) * HIDDEN).reshape(CODES + 1, HIDDEN)
        np.multiply(grad, grad, out=step)
        seen += step
        np.sqrt(seen, out=step)
        step += 1e-6
        np.divide(grad, step, out=step)
        step *= STEP
        flat -= step


def _codes(texts: pa.Array) -> pa.Array:
    return pa.array([codes_of(t).astype("<u2").tobytes() for t in texts.to_pylist()], pa.binary())


def coded(texts: DataFrame) -> DataFrame:
    """``codes`` of every text, two bytes a token; rows and partitions as in ``texts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays([_codes(b.column("text"))], names=["codes"])

    return texts if "codes" in texts.columns else texts.select("text").mapInArrow(run, "codes binary")


def coded_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per input row: ``rest`` (struct of all columns but the text) and ``codes`` of the
    text, from which texts are learned and scored without being cut into words again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays([b.column("rest"), _codes(b.column("text"))], names=["rest", "codes"])

    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["rest"], T.StructField("codes", T.BinaryType())]))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for b in slices(batches, "codes", 1 << 20):
        yield b, [np.frombuffer(c, "<u2").astype(np.int64) for c in b.column("codes").to_pylist()]


def corpus_counts(texts: DataFrame) -> np.ndarray:
    """How often each token occurs in all texts; at most ``CODES`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES, np.int64)
        for _, codes in _coded(batches):
            total += np.bincount(np.concatenate([np.empty(0, np.int64), *codes]), minlength=CODES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CODES)), pa.array(total)], names=["code", "n"])

    out = np.zeros(CODES)
    for r in coded(texts).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r.code] = r.n
    return out


def reach_of(copies: float, updates: float) -> float:
    """How many times the mean of ``copies`` copies, of ``updates`` updates each, a round moves.

    Adagrad's way grows with the root of its updates: over those of all copies it is
    root(copies) times as long as a copy's.  That far it goes only while the updates are
    few; past ``COVERED`` of them the copies have found their way and their mean stands.
    """
    return max(1.0, min(copies, COVERED / max(updates, 1.0))) ** 0.5


def train_round(texts: DataFrame, flat: np.ndarray) -> np.ndarray:
    """Train a copy on every partition and move by the copies' mean, weighted by tokens.

    The copies meet in pieces of the parameter vector, each summed in a stream in
    order of partition, so reruns over the same partitions agree.  The driver gets
    one average, whose size does not depend on the data.
    """
    shared = texts.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, tokens, updates = shared.value.copy(), np.full(SIZE, 1e-4, np.float32), 0, 0
        for _, codes in _coded(batches):
            line, place, _ = lay_out(codes)
            train(own, seen, line, place)
            tokens += len(place)
            updates += -(-len(place) // UPDATE)
        if tokens:
            raw = [own[at:at + CHUNK].tobytes() for at in range(0, SIZE, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(raw)), pa.int32()), pa.array([tokens] * len(raw), pa.int64()),
                                              pa.array([updates] * len(raw), pa.int64()), pa.array(raw, pa.binary())],
                                             names=["chunk", "tokens", "updates", "raw"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            for c, n, u, raw in zip(*(b.column(x).to_pylist() for x in ("chunk", "tokens", "updates", "raw")), strict=True):
                have = sums.setdefault(c, [0.0, 0, 0.0, 0.0])
                have[0] = have[0] + np.frombuffer(raw, np.float32).astype(np.float64) * n
                have[1] += n
                have[2] += float(n) ** 2
                have[3] += float(n) * u
        for c, (total, n, squares, updates) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([n * n / squares], pa.float64()), pa.array([updates / n], pa.float64()),
                                              pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())],
                                             names=["chunk", "copies", "updates", "raw"])

    copies = coded(texts).mapInArrow(run, "chunk int, tokens long, updates long, raw binary").withColumn("part", F.spark_partition_id())
    rows = copies.repartition("chunk").sortWithinPartitions("chunk", "part").select("chunk", "tokens", "updates", "raw") \
        .mapInArrow(average, "chunk int, copies double, updates double, raw binary").collect()
    if not rows:
        return flat
    mean = np.concatenate([np.frombuffer(r.raw, np.float32) for r in sorted(rows, key=lambda r: r.chunk)])
    return flat + np.float32(reach_of(rows[0].copies, rows[0].updates)) * (mean - flat)


def learn(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> np.ndarray:
    """Parameters of the network after ``rounds`` passes over all texts, whose codes are
    kept on the executors' disks meanwhile."""
    texts = coded(docs.select(F.col(f"`{text_col}`").alias("text"))).persist(StorageLevel.DISK_ONLY)
    try:
        return learn_coded(texts, rounds)
    finally:
        texts.unpersist()


def learn_coded(texts: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """:func:`learn` from ``codes`` that are kept already."""
    texts = texts.select("codes")
    flat = fresh(corpus_counts(texts))
    for _ in range(rounds):
        flat = train_round(texts, flat)
    return flat


def score(docs: DataFrame, flat: np.ndarray, text_col: str = "text") -> DataFrame:
    """One row per input row: ``rest`` (struct of all columns but the text), ``n_tokens``,
    ``log_likelihood`` (sum of the conditional log probabilities) and ``score`` (its
    mean a token).  Null and empty texts: 0 tokens, sum 0, score null."""
    return score_coded(coded_rows(docs, text_col), flat)


def score_coded(rows: DataFrame, flat: np.ndarray) -> DataFrame:
    """:func:`score` of ``rest`` and ``codes`` (:func:`coded_rows`)."""
    shared = rows.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = views(shared.value)
        for b, codes in _coded(batches):
            line, place, owner = lay_out(codes)
            total = np.bincount(owner, weights=log_chances(p, line, place), minlength=len(codes)).astype(np.float64)
            n = np.array([len(c) for c in codes])
            mean = pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0)
            yield pa.RecordBatch.from_arrays([b.column("rest"), pa.array(n, pa.int64()), pa.array(total), mean],
                                             names=["rest", "n_tokens", "log_likelihood", "score"])

    out = T.StructType([rows.schema["rest"], T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()),
                        T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, out)
