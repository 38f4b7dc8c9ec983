"""Language identification by cross-parsing against suffix automata.

A text is cut greedily into the longest phrases that occur in a language's sample;
the language that needs the fewest phrases a symbol knows the text best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the labelled sample: documents a language, symbols a language, symbols together.
SAMPLE_DOCS = 64
SAMPLE_CHARS = 50_000
SAMPLE_TOTAL = 400_000
#: Symbols parsed as one string; a longer text is parsed in pieces of this length.
BLOCK = 1024
ALPHABET = 96
UND = "und"
_GAP, _ODD = 0, 1


@dataclass(frozen=True)
class Sample:
    """What is learned: the alphabet and, by language, sample texts."""

    letters: str
    texts: tuple[tuple[str, str], ...]


def _folded(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def learn(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Sample:
    """Collect the bounded sample: of each language the ``SAMPLE_DOCS`` usable
    documents with the smallest id hash, of these whole texts while they fit
    ``SAMPLE_CHARS`` (the first is cut there if it is longer alone).  All languages
    together stay within ``SAMPLE_TOTAL`` symbols, shared evenly.  Of rows that repeat
    an id, equal texts count once.  Rows with a null id, text or language teach
    nothing; without any other the sample is empty, and so is its alphabet."""
    id_, text, lang = (F.col(f"`{c}`") for c in (id_col, text_col, lang_col))
    good = docs.where(usable & lang.isNotNull() & text.isNotNull() & id_.isNotNull())
    hashed = good.select(lang.alias("lang"), id_.alias("id"), F.xxhash64(id_).alias("h"))
    best = hashed.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))).where(F.col("r") <= SAMPLE_DOCS)
    picked = {r.id for r in best.select("id").collect()}
    if not picked:
        return Sample("", ())
    @F.pandas_udf("string")
    def fold(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _folded(t)[:SAMPLE_CHARS + 1])

    # An id may have any number of rows: equal texts count once, and no language sends
    # the driver more than its share of cut texts.
    cut = good.where(id_.isin(list(picked))).select(lang.alias("lang"), F.xxhash64(id_).alias("h"), fold(text).alias("t")).distinct()
    rows = cut.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))).where(F.col("r") <= SAMPLE_DOCS).collect()
    by: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        by.setdefault(r.lang, []).append((r.h, r.t))
    room = min(SAMPLE_CHARS, SAMPLE_TOTAL // len(by))
    texts = []
    for name in sorted(by):
        taken, held = [], 0
        for _, t in sorted(by[name]):
            if t and (not taken or held + len(t) < room):
                taken.append(t[:room])
                held += len(taken[-1]) + 1
        if taken:
            texts.append((name, " ".join(taken)))
    count: dict[str, int] = {}
    for _, t in texts:
        for c in t:
            count[c] = count.get(c, 0) + 1
    letters = sorted((c for c in count if c != " "), key=lambda c: (-count[c], c))[:ALPHABET - 2]
    return Sample("".join(letters), tuple(texts))


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``text``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return moves


class CrossParser:
    """Phrase counts of many texts against all languages at once."""

    def __init__(self, sample: Sample):
        self.langs = [n for n, _ in sample.texts]
        self.size = len(sample.letters) + 2
        place = {c: i + 2 for i, c in enumerate(sample.letters)}
        self.symbol = np.array([_ODD if chr(c).isalpha() else _GAP for c in range(1 << 16)], np.uint8)
        for c, i in place.items():
            if ord(c) < 1 << 16:
                self.symbol[ord(c)] = i
        rows, starts, total = [], [], 0
        for _, text in sample.texts:
            moves = suffix_automaton([_GAP if c == " " else place.get(c, _ODD) for c in text])
            table = np.full((len(moves) + 1, self.size), -1, np.int32)
            for s, m in enumerate(moves):
                for c, t in m.items():
                    table[s, c] = (total + t) * self.size
            # A symbol the sample lacks is a phrase of its own: a last state that leads nowhere.
            table[0][table[0] < 0] = (total + len(moves)) * self.size
            rows.append(table)
            starts.append(table[0])
            total += len(table)
        if rows:
            self.moves, self.start = np.concatenate(rows).ravel(), np.stack(starts)

    def symbols(self, text: str) -> np.ndarray:
        """Letters of a text as symbols, runs of anything else as one gap."""
        cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        s = self.symbol[np.minimum(cp, (1 << 16) - 1)]
        if (far := np.flatnonzero(cp >= 1 << 16)).size:
            s[far] = [_ODD if chr(c).isalpha() else _GAP for c in cp[far].tolist()]
        s = s[np.concatenate(([True], (s[1:] != _GAP) | (s[:-1] != _GAP)))] if len(s) else s
        return s[int(len(s) > 0 and s[0] == _GAP):len(s) - int(len(s) > 1 and s[-1] == _GAP)]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrase counts, languages x texts: all pieces advance together, symbol by symbol."""
        parts = [(i, t[at:at + BLOCK]) for i, t in enumerate(texts) for at in range(0, len(t), BLOCK)]
        parts.sort(key=lambda p: -len(p[1]))
        out = np.zeros((len(self.langs), len(texts)), np.int64)
        if not parts:
            return out
        owner = np.array([i for i, _ in parts])
        lens = np.array([len(p) for _, p in parts])
        grid = np.zeros((lens[0], len(parts)), np.uint8)
        for k, (_, p) in enumerate(parts):
            grid[:len(p), k] = p
        live = len(parts) - np.searchsorted(lens[::-1], np.arange(lens[0]), side="right")
        state = self.start[:, grid[0]]
        count = np.ones(state.shape, np.int32)
        for t in range(1, lens[0]):
            n = live[t]
            sym = grid[t, :n]
            new = self.moves.take(state[:, :n] + sym)
            miss = new < 0
            count[:, :n] += miss
            state[:, :n] = np.where(miss, self.start[:, sym], new)
        for k in range(len(self.langs)):
            out[k] = np.bincount(owner, weights=count[k], minlength=len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text.  The score is how much fewer phrases the
        winner needs than the second, 0 to 1 (one language alone: how much fewer than
        symbols).  Equal counts: the first language by name, score 0."""
        syms = [self.symbols(t) if t else np.empty(0, np.uint8) for t in texts]
        known = np.array([bool((s != _GAP).any()) for s in syms], bool)
        score = np.zeros(len(texts))
        if not self.langs or not len(texts):
            return [UND] * len(texts), score
        n = self.phrases([s if k else s[:0] for s, k in zip(syms, known, strict=True)])
        best = n.argmin(0)
        low = np.sort(n, axis=0)
        second = low[1] if len(self.langs) > 1 else np.array([len(s) for s in syms])
        score[known] = np.clip(1 - low[0][known] / np.maximum(second[known], 1), 0, 1)
        return [self.langs[b] if k else UND for b, k in zip(best.tolist(), known.tolist(), strict=True)], score


_parsers: dict[Sample, CrossParser] = {}


def predict_language(docs: DataFrame, sample: Sample, text_col: str = "text", out_col: str = "language_id") -> DataFrame:
    """``docs`` with a struct ``out_col`` of ``lang`` and ``score``, from the whole text
    alone.  Null, empty and letterless texts: ``und`` with score 0; after an empty
    sample all texts.  Each worker builds the automata once from the sample.  A column
    of ``docs`` called ``out_col`` is replaced; pass another name to keep it."""
    @F.pandas_udf("lang string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if sample not in _parsers:
            _parsers.clear()
            _parsers[sample] = CrossParser(sample)
        parser = _parsers[sample]
        for texts in parts:
            names, scores, todo, held = [], [], [], 0
            for t in [*texts, None]:
                todo.append(t)
                held += len(t) if isinstance(t, str) else 0
                if held > 4 << 20:
                    a, b = parser.predict(todo)
                    names += a
                    scores.append(b)
                    todo, held = [], 0
            a, b = parser.predict(todo)
            yield pd.DataFrame({"lang": (names + a)[:len(texts)], "score": np.concatenate([*scores, b])[:len(texts)]})

    return docs.withColumn(out_col, predict.asNondeterministic()(F.col(f"`{text_col}`")))
