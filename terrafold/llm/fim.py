"""Fill-in-the-middle transformation: both cuts of a text come from a wavelet matrix over its character classes.

A block of texts is one sequence of byte classes (new line, space, digit, end of sentence, ...,
continuation byte). The matrix answers "how many of class c before position i" in three look-ups.
Sums of such ranks over the classes that end a unit count the units of every text; bisection on the
same sums finds where the k-th unit ends; the rank of continuation bytes turns bytes into code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.textops import blocks, raw, small_batches

# Character classes (3 bits).
OTHER, NEWLINE, SPACE, DIGIT, STOP, PUNCT, CONTINUED, LETTER = range(8)
BITS = 3
#: Classes after which a unit ends. A last unit without an end is a unit, too.
UNITS = {"line": (NEWLINE,), "space": (NEWLINE, SPACE), "sentence": (STOP,)}
SENTINELS = ("<P>", "<S>", "<M>")
CUTS = "n long, prefix long, middle long"


def _classes() -> np.ndarray:
    c = np.full(256, OTHER, np.uint8)
    c[33:127] = PUNCT
    c[[9, 11, 12, 13, 32]] = SPACE
    c[10] = NEWLINE
    c[48:58] = DIGIT
    c[65:91] = c[97:123] = LETTER
    c[[ord(x) for x in ".!?"]] = STOP
    c[128:192] = CONTINUED
    return c


CLASS_OF = _classes()


class Bitvector:
    """Bits with the number of ones before every 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


class WaveletMatrix:
    """A sequence of small codes, one bitvector per bit from the highest; each level deals the codes stably by their bit."""

    def __init__(self, codes: np.ndarray, bits: int = BITS):
        self.size, self.levels = len(codes), []
        for k in range(bits - 1, -1, -1):
            one = (codes >> k) & 1 == 1
            self.levels.append((k, Bitvector(one), int(len(codes) - np.count_nonzero(one))))
            codes = np.concatenate([codes[~one], codes[one]])

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``code`` before each position."""
        lo, hi = np.zeros_like(at), at
        for k, bits, zeros in self.levels:
            a, b = bits.ones(lo), bits.ones(hi)
            lo, hi = (zeros + a, zeros + b) if code >> k & 1 else (lo - a, hi - b)
        return hi - lo

    def ranks(self, codes: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """Occurrences of any of ``codes`` before each position."""
        return sum(self.rank(c, at) for c in codes)

    def after(self, codes: tuple[int, ...], start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Least position in [start, end] with ``k`` occurrences of ``codes`` since start, or end: bisection on ranks."""
        want = self.ranks(codes, start) + k
        lo, hi = start.copy(), end.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            enough = self.ranks(codes, mid) >= want
            hi = np.where(open_ & enough, mid, hi)
            lo = np.where(open_ & ~enough, mid + 1, lo)
        return lo


def cuts(text: pa.Array, h1: np.ndarray, h2: np.ndarray, unit: str = "line") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and code points of its prefix and middle: the cuts follow the smaller and the
    larger of h1 and h2 modulo (units + 1)."""
    ends = UNITS[unit]
    offs, data = raw(text)
    matrix = WaveletMatrix(CLASS_OF[data])
    start, end = offs[:-1], offs[1:]
    n = matrix.ranks(ends, end) - matrix.ranks(ends, start)
    last = np.maximum(end - 1, 0)
    n = n + ((end > start) & (matrix.ranks(ends, end) == matrix.ranks(ends, last)))
    k1, k2 = h1 % (n + 1), h2 % (n + 1)
    first = matrix.after(ends, start, end, np.minimum(k1, k2))
    second = matrix.after(ends, start, end, np.maximum(k1, k2))
    points = lambda a, b: b - a - (matrix.rank(CONTINUED, b) - matrix.rank(CONTINUED, a))
    return n, points(start, first), points(first, second)


def _cutter(unit: str):
    @F.arrow_udf(CUTS)
    def cut(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        parts = []
        for b in blocks(iter([pa.RecordBatch.from_arrays([text, h1, h2], names=["text", "h1", "h2"])])):
            got = cuts(b.column("text"), b.column("h1").to_numpy(), b.column("h2").to_numpy(), unit)
            parts.append([pa.array(x.astype(np.int64), pa.int64()) for x in got])
        cols = [pa.concat_arrays(c) for c in zip(*parts, strict=True)] if parts else [pa.array([], pa.int64())] * 3
        return pa.StructArray.from_arrays(cols, names=["n", "prefix", "middle"])

    return cut


def fill_in_middle(docs: DataFrame, unit: str = "line", seed: int = 7, percent: int = 100, spm_percent: int = 50,
                   sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> one row per row: doc_id, n, form, prefix_chars, middle_chars, output.

    n counts the units of the whole text. Four numbers h1 to h4 come from the sha256 of "seed:doc_id". The prefix
    ends after the smaller of h1 and h2 modulo (n + 1) units, the middle after the larger. The output is
    P prefix S suffix M middle (form psm), or S suffix P prefix M middle (spm, where h4 % 100 < spm_percent),
    or the text as it is (plain: empty texts, texts that hold a sentinel, and where h3 % 100 >= percent), which has no cuts (null).

    A null text counts as empty. A null doc_id is kept and hashes like an empty one. Repeated rows get the
    same result each; a text of one unit is cut at its ends; an empty table gives no rows."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    small_batches(docs.sparkSession)
    p, s, m = sentinels
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), digest.alias("h"))
    src = src.select("doc_id", "text", *[F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    held = (F.col("text") == "") | (F.col("h3") % 100 >= percent)
    for mark in sentinels:
        held = held | F.contains("text", F.lit(mark))
    got = src.select("doc_id", "text", _cutter(unit)("text", "h1", "h2").alias("c"),
                     F.when(held, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm").alias("form"))
    a, b = F.col("c.prefix").cast("int"), F.col("c.middle").cast("int")
    whole = F.length("text")
    pre, mid, suf = F.substring("text", F.lit(1), a), F.substring("text", a + 1, b), F.substring("text", a + b + 1, whole)
    cut = F.col("form") != "plain"
    out = (F.when(~cut, F.col("text")).when(F.col("form") == "psm", F.concat(F.lit(p), pre, F.lit(s), suf, F.lit(m), mid))
           .otherwise(F.concat(F.lit(s), suf, F.lit(p), pre, F.lit(m), mid)))
    return got.select("doc_id", F.col("c.n").alias("n"), "form", F.when(cut, F.col("c.prefix")).alias("prefix_chars"),
                      F.when(cut, F.col("c.middle")).alias("middle_chars"), out.alias("output"))


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text before the transformation, from output and form alone."""
    parts = F.split(F.col(output), "|".join(rf"\Q{x}\E" for x in sentinels))
    part = lambda i: F.get(parts, F.lit(i))
    return (F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", F.concat(part(1), part(3), part(2)))
            .otherwise(F.concat(part(2), part(3), part(1))))
