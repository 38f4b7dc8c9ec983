"""Secret scans: fixed patterns, and a randomness test battery for what they miss.

Patterns find spans of assigned values, access keys and long hex runs.  Besides, every
long run of letters and digits is read in the smallest encoding that holds all its
characters, and tested: chi-squared for the uniform use of the alphabet, runs above and
below its middle, and serial correlation of neighbours by quarter of the alphabet.  A
secret must pass all three as random (Bonferroni over the battery), and it must be
shown not to be text: under the text hypothesis chi-squared is noncentral, with a
noncentrality that grows with the length and the coincidence index of text.  The share
of text among what is reported is held to ``fdr`` by Benjamini and Hochberg's rule,
separately for every doubling of the length, so that many short tokens, which can prove
little, neither hide nor admit long ones.

All of it is DataFrame functions over the row of a document: nothing is shuffled but
the counts of p-values by length class and bin.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from newslake.llm.common import materialise


@dataclass(frozen=True)
class Pattern:
    """Spans of ``regex`` whose ``group`` has ``least`` or more characters."""

    kind: str
    regex: str
    group: int
    least: int


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYWORDS = f"({'|'.join(map(_either_case, ('password', 'passwd', 'secret', 'token')))}|{_either_case('api')}_?{_either_case('key')})"
#: In the order of their kinds.
PATTERNS = (Pattern("assign", KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
            Pattern("access", "AKIA[A-Z0-9]+", 0, 18),
            Pattern("hex", "[0-9a-f]{16,}", 0, 16))      # shorter runs end before 16, so the runs are the same

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()


@dataclass(frozen=True)
class Encoding:
    """An alphabet in order, and the coincidence index of text written with it (the
    chance that two of its letters are alike)."""

    alphabet: str
    only: str
    coincidence: float

    def levels(self) -> str:
        """Quarter (0 to 3) of the alphabet for every symbol."""
        k, half = len(self.alphabet), len(self.alphabet) // 2
        return "".join(str(2 * (i >= half) + ((i % half) * 2 >= half)) for i in range(k))

    def moments(self) -> tuple[float, float]:
        q = [int(c) for c in self.levels()]
        mean = sum(q) / len(q)
        return mean, sum((x - mean) ** 2 for x in q) / len(q)


#: Smaller alphabets first: a token is read in the first that holds it.
ENCODINGS = (Encoding(_DIGITS + "abcdef", "[0-9a-f]+", 0.20), Encoding(_DIGITS + "ABCDEF", "[0-9A-F]+", 0.20),
             Encoding(_UPPER + "234567", "[A-Z2-7]+", 0.065), Encoding(_DIGITS + _LOWER, "[0-9a-z]+", 0.065),
             Encoding(_DIGITS + _UPPER, "[0-9A-Z]+", 0.065), Encoding(_DIGITS + _UPPER + _LOWER, "[0-9A-Za-z]+", 0.055),
             Encoding(_UPPER + _LOWER + _DIGITS + "+/", "[0-9A-Za-z+/]+", 0.055), Encoding(_UPPER + _LOWER + _DIGITS + "-_", "[0-9A-Za-z_-]+", 0.055))
#: Runs that may be an encoded secret; they must also hold a digit and a letter.
CANDIDATE = "[A-Za-z0-9+/_-]{16,}={0,2}"
#: p-values are kept as floor(-BINS * ln p), the larger of the two ends: never too small.
BINS, LAST_BIN = 4, 4000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(steps: Column, block: int = 256) -> Column:
    """Sums of an array of longs up to each element, block by block: long arrays cost
    ``n * (block + n / block**2)`` steps, not n squared."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def blocks(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / block).cast("int")), lambda b: total(F.slice(s, b * block + 1, F.lit(block))))

    def sums(s: Column) -> Column:
        return let(blocks(s), lambda t: let(F.transform(t, lambda x, i: total(F.slice(t, F.lit(1), i))), lambda before:
                   F.transform(s, lambda x, i: F.get(before, F.floor(i / block).cast("int")) + total(F.slice(s, i - i % block + 1, i % block + 1)))))

    return let(steps, lambda s: F.when(F.size(s) == 0, F.array().cast("array<long>")).otherwise(sums(s)))


def spans(text: Column, regex: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, token), in code points, the
    end exclusive; ``token`` is the match's ``group``.  Lengths of the matches and of the
    text between them add up to the places."""
    def placed(whole: Column) -> Column:
        steps = F.zip_with(F.slice(F.split(text, regex, -1), F.lit(1), F.size(whole)), whole, lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        tokens = whole if group == 0 else F.regexp_extract_all(text, F.lit(regex), F.lit(group))
        return let(tokens, lambda t: F.transform(
            running_sums(steps), lambda end, i: F.struct((end - F.length(F.get(whole, i))).alias("start"), end.alias("end"), F.get(t, i).alias("token"))))

    none = F.array().cast("array<struct<start:bigint,end:bigint,token:string>>")
    return let(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), lambda whole: F.when(F.size(whole) == 0, none).otherwise(placed(whole)))


def _encoded(token: Column) -> Column:
    """body, alphabet and its numbers; null where no encoding holds the token."""
    body = F.rtrim(token, F.lit("="))
    out = F.lit(None)
    for e in reversed(ENCODINGS):
        mean, var = e.moments()
        found = F.struct(body.alias("body"), F.lit(e.alphabet).alias("alphabet"), F.lit(e.levels()).alias("levels"), F.lit(len(e.alphabet)).alias("k"),
                         F.lit(mean).alias("mean"), F.lit(var).alias("var"), F.lit(e.coincidence).alias("ic"))
        out = F.when(body.rlike(f"^{e.only}$"), found).otherwise(out)
    return F.when(body.rlike("[0-9]") & body.rlike("[A-Za-z]"), out)


def _lost(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _statistics(e: Column) -> Column:
    """Chi-squared, runs and serial correlation of an encoded token."""
    body, n, k = e["body"], F.length(e["body"]), e["k"]
    squares = F.aggregate(F.sequence(F.lit(1), k), F.lit(0.0), lambda s, i: let(
        (n - F.length(F.replace(body, F.substring(e["alphabet"], i, F.lit(1)), F.lit("")))).cast("double"), lambda c: s + c * c))
    q = F.call_function("translate", body, e["alphabet"], e["levels"])

    def neighbours(q: Column) -> Column:
        total = F.lit(0.0)
        for a in range(4):
            for b in range(4):
                pairs = F.length(q) - F.length(F.regexp_replace(q, f"{a}+", f"{a}")) if a == b else _lost(q, f"{a}{b}") / 2
                total = total + pairs * (F.lit(float(a)) - e["mean"]) * (F.lit(float(b)) - e["mean"])
        halves = F.regexp_replace(F.regexp_replace(q, "[01]+", "L"), "[23]+", "H")
        return F.struct(F.length(halves).alias("runs"), total.alias("serial"))

    return let(let(q, neighbours), lambda s: F.struct(n.alias("n"), k.alias("k"), e["ic"].alias("ic"), (k * squares / n - n).alias("chi2"),
                                                       s["runs"].alias("runs"), (s["serial"] / e["var"]).alias("serial")))


def _judged(s: Column) -> Column:
    """p-value of the battery under randomness, and under text."""
    n, k = s["n"].cast("double"), s["k"].cast("double")
    tail = lambda z: F.exp(-z * z / 2)                                    # noqa: E731  at least the normal's two tails
    chi = (s["chi2"] - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
    runs = (s["runs"] - (1 + (n - 1) / 2)) / (F.sqrt(n - 1) / 2)
    serial = s["serial"] / F.sqrt(n - 1)
    battery = F.least(F.lit(1.0), 3 * F.least(F.when(chi > 0, tail(chi)).otherwise(1.0), tail(runs), tail(serial)))
    shift = (n - 1) * (k * s["ic"] - 1)
    below = (s["chi2"] - (k - 1) - shift) / F.sqrt(2 * (k - 1) + 4 * shift)
    surprise = F.when(below < 0, below * below / 2 + math.log(2)).otherwise(0.0)   # -ln p, p at least the normal's tail
    return F.struct(battery.alias("p_random"), F.least(F.lit(LAST_BIN), F.floor(BINS * surprise)).cast("int").alias("bin"),
                    F.floor(F.log2(n)).cast("int").alias("length_class"))


def _found(text: Column, pattern: Pattern, place: int) -> Column:
    long_enough = F.filter(spans(text, pattern.regex, pattern.group), lambda s: F.length(s["token"]) >= pattern.least)
    return F.transform(long_enough, lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), F.lit(pattern.kind).alias("kind"), s["end"].alias("end")))


def scan(docs: DataFrame, text: str = "text", fdr: float = 0.05, alpha: float = 0.001) -> DataFrame:
    """``rest`` (all columns but the text), ``base`` and ``added``: arrays of (start,
    place, kind, end) in the order of their starts, in code points, the end exclusive.

    ``base`` are the spans of ``PATTERNS``; ``added`` those of kind ``random``, which may
    overlap them.  ``alpha`` is the battery's level, ``fdr`` the share of text allowed
    among the added spans of a length class.

    Defined cases: null and empty texts have no span; texts of any length are read whole;
    repeated rows each come back (and count as so many tests); an empty table gives no
    row; other columns, whatever their names, stay in ``rest``.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    base = [_found(t, p, place) for place, p in enumerate(PATTERNS)]
    encoded = F.filter(F.transform(spans(t, CANDIDATE), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _encoded(s["token"]).alias("e"))),
                       lambda s: s["e"].isNotNull())
    tested = F.transform(encoded, lambda s: let(let(_statistics(s["e"]), _judged), lambda j: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), j["p_random"].alias("p_random"), j["bin"].alias("bin"), j["length_class"].alias("length_class"))))
    rows = materialise(docs.select(F.struct(*others).alias("rest"), F.concat(*base).alias("base"), tested.alias("tested")), "secrets")
    limits = _limits(rows.select(F.explode("tested").alias("t")).select("t.bin", "t.length_class"), fdr)

    def least(length_class: Column) -> Column:
        out = F.lit(LAST_BIN + 1)
        for c, bin_ in limits.items():
            out = F.when(length_class == c, F.lit(bin_)).otherwise(out)
        return out

    added = F.transform(F.filter("tested", lambda s: (s["p_random"] >= alpha) & (s["bin"] >= least(s["length_class"]))), lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(PATTERNS)).alias("place"), F.lit("random").alias("kind"), s["end"].alias("end")))
    return rows.select("rest", F.array_sort("base").alias("base"), F.array_sort(added).alias("added"))


def _limits(tests: DataFrame, fdr: float) -> dict[int, int]:
    """Benjamini and Hochberg's limit, as a bin, for every length class that has one: the
    smallest bin whose p-value is within ``fdr`` times the share of tests at or beyond it.
    The driver gets one row a doubling of the length, 31 at most."""
    bins = tests.groupBy("length_class", "bin").agg(F.count("*").alias("n"))
    classes = Window.partitionBy("length_class")
    ranked = bins.select("length_class", "bin", F.sum("n").over(classes.orderBy(F.desc("bin"))).alias("beyond"), F.sum("n").over(classes).alias("all"))
    kept = ranked.where(F.exp(-F.col("bin") / BINS) <= fdr * F.col("beyond") / F.col("all"))
    return {r.length_class: r.bin for r in kept.groupBy("length_class").agg(F.min("bin").alias("bin")).collect()}


def span_list(found: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
