"""Secret scans: fixed patterns, and a battery of randomness tests on tokens.

One pass over the whole texts counts which key character follows which: what tokens of this corpus ordinarily
look like. A second pass finds the pattern spans and tests every token that could be an encoded key. Its encoding is inferred from
its characters. Three statistics - chi-squared of the alphabet's uniformity, the number of runs, and the serial correlation of the
characters' places in the alphabet - are read twice. Against "uniformly random in this encoding" their p-values, combined by
Fisher's method, tell whether randomness can be rejected. Against "ordinary here" their p-values towards randomness, combined the same
way, tell how unlikely an ordinary token of that length would look so random: they fall with the length, so a short token
needs a corpus of few others. Benjamini-Hochberg over all tokens of the corpus, on a histogram with a fixed number of
bins, sets the cut; a token under the cut whose randomness is not rejected is reported."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.textops import blocks, raw, written

# The pattern kinds, in their order, with the least length of what must match.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # runs of 16 or more: the same spans as all runs with the short ones dropped
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 12, "access": 18, "hex": 16}

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings by their character classes, from the narrowest alphabet to the widest.
ENCODINGS = {
    "digits": (DIGITS,),
    "hex": (DIGITS, "abcdef"),
    "HEX": (DIGITS, "ABCDEF"),
    "lower": (LOWER,),
    "upper": (UPPER,),
    "base32": (UPPER, "234567"),
    "base36": (LOWER, DIGITS),
    "BASE36": (UPPER, DIGITS),
    "letters": (LOWER, UPPER),
    "base62": (LOWER, UPPER, DIGITS),
    "base64": (LOWER, UPPER, DIGITS, "+/"),
    "base64url": (LOWER, UPPER, DIGITS, "_-"),
    "any": (LOWER, UPPER, DIGITS, "+/_-"),
}
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
ALPHABET = LOWER + UPPER + DIGITS + "+/_-"
BINS = 512
# Share of each letter in English text in percent, a to z; shares of the classes of ALPHABET, and of neighbours of
# different class, in ordinary tokens. They stand for so many characters beside those of the corpus.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
CLASS_SHARES, CLASS_CHANGES, PRIOR = (0.8, 0.1, 0.07, 0.03), 0.1, 10_000.0
#: Running text has few changes of case, but names joined from capitalised words are as ordinary: two changes in a word of eight letters.
JOINED_CHANGES = 0.25

_CODE = np.full(256, len(ALPHABET), np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))


def pair_counts(text: pa.Array) -> np.ndarray:
    """How often each character of ALPHABET follows each, inside the texts: a square matrix."""
    n = len(ALPHABET)
    offs, data = raw(pc.fill_null(text, ""))
    code = _CODE[data]
    inside = np.ones(max(0, len(code) - 1), bool)
    inside[[e - 1 for e in offs[1:-1].tolist() if 0 < e < len(code)]] = False
    pairs = (code[:-1] * (n + 1) + code[1:])[inside & (code[:-1] < n) & (code[1:] < n)]
    return np.bincount(pairs, minlength=(n + 1) ** 2).reshape(n + 1, n + 1)[:n, :n] if len(pairs) else np.zeros((n, n), np.int64)


def prior_pairs() -> np.ndarray:
    """PRIOR pairs of an ordinary text: mostly neighbours of one class, letters by their share."""
    groups = (LOWER, UPPER, DIGITS, "+/_-")
    letters = np.array(LETTERS) / sum(LETTERS)
    share = [letters, letters, np.full(10, 0.1), np.full(4, 0.25)]
    n, starts = len(ALPHABET), np.cumsum([0, *map(len, groups)])
    out = np.zeros((n, n))
    for i, si in enumerate(CLASS_SHARES):
        for j, sj in enumerate(CLASS_SHARES):
            of = si * (1 - CLASS_CHANGES if i == j else CLASS_CHANGES * sj / (1 - si))
            out[starts[i] : starts[i + 1], starts[j] : starts[j + 1]] = of * share[i][:, None] * share[j][None, :]
    return PRIOR * out / out.sum()


@dataclass
class Null:
    """What a kind of token is like in one encoding: the second and third moment of its characters' shares, the rate of changes between
    classes (or halves of an alphabet of one class), and the serial correlation."""

    second: float
    third: float
    changes: float
    serial: float


@dataclass
class Encoding:
    at: dict[str, int]
    of: dict[str, int]
    random: Null
    ordinary: Null

    def __init__(self, groups: tuple[str, ...], pairs: np.ndarray):
        chars = "".join(groups)
        parts = groups if len(groups) > 1 else (chars[: len(chars) // 2], chars[len(chars) // 2 :])
        self.at = {c: i for i, c in enumerate(chars)}
        self.of = {c: i for i, g in enumerate(parts) for c in g}
        own = [ALPHABET.index(c) for c in chars]
        size = len(chars)
        self.random = self._null(np.full((size, size), 1.0 / size**2), chars)
        self.random.serial = 0.0
        self.ordinary = self._null(pairs[np.ix_(own, own)], chars)
        if LOWER in groups and UPPER in groups:
            self.ordinary.changes = max(self.ordinary.changes, JOINED_CHANGES)

    def _null(self, pairs: np.ndarray, chars: str) -> Null:
        p = pairs / pairs.sum()
        share = (p.sum(axis=0) + p.sum(axis=1)) / 2
        cls = np.array([self.of[c] for c in chars])
        at = np.arange(len(chars))
        mean = share @ at
        var = share @ (at - mean) ** 2
        serial = float(((at - mean)[:, None] * p * (at - mean)[None, :]).sum() / var)
        return Null(float((share**2).sum()), float((share**3).sum()), float(p[cls[:, None] != cls[None, :]].sum()), serial)


def encodings(pairs: np.ndarray) -> dict[str, Encoding]:
    return {name: Encoding(groups, pairs + prior_pairs()) for name, groups in ENCODINGS.items()}


def infer(token: str) -> str | None:
    """The narrowest encoding that holds all characters of the token."""
    seen = set(token)
    return next((name for name, groups in ENCODINGS.items() if seen <= set("".join(groups))), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _gamma_tails(x: float, mean: float, var: float) -> tuple[float, float]:
    """Lower and upper tail of the gamma distribution with this mean and variance (Wilson-Hilferty)."""
    shape = mean * mean / var
    z = ((max(x, 0.0) / mean) ** (1 / 3) - (1 - 1 / (9 * shape))) * 3 * math.sqrt(shape)
    return 0.5 * math.erfc(-z / math.sqrt(2)), 0.5 * math.erfc(z / math.sqrt(2))


def _binomial_tail(n: int, p: float, k: int) -> float:
    """P(X >= k) for X ~ Binomial(n, p); summed from the largest term, exact for short and long n."""
    if k <= n * p:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term, total = 1.0, 0.0
    for i in range(k, n + 1):
        total += term
        term *= (n - i) / (i + 1) * p / (1 - p)
        if term < 1e-12 * total:
            break
    return math.exp(log) * total


def fisher(p: list[float]) -> float:
    """Fisher's combined p-value of three."""
    half = -sum(math.log(max(x, 1e-300)) for x in p)
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def _coincidences(n: int, null: Null) -> tuple[float, float]:
    """Mean and variance of sum c(c - 1) over the counts c of n characters drawn by the null's shares. The chi-squared statistic
    against the uniform shares is a linear function of that sum, so this gives its exact moments, however small the expected counts."""
    s2, s3 = null.second, null.third
    return n * (n - 1) * s2, 4 * n**3 * (s3 - s2**2) + 2 * n**2 * (5 * s2**2 + s2 - 6 * s3) + 2 * n * (4 * s3 - s2 - 3 * s2**2)


def battery(token: str, enc: Encoding) -> tuple[tuple[float, float, float], tuple[float, float, float]]:
    """p-values (uniformity, runs, serial) under "random in this encoding", and towards randomness under "ordinary"."""
    n = len(token)
    same = float(sum(c * (c - 1) for c in Counter(token).values()))
    # more coincidences than uniform shares give; fewer than ordinary ones give
    uniform = _gamma_tails(same, *_coincidences(n, enc.random))[1]
    uniform_o = _gamma_tails(same, *_coincidences(n, enc.ordinary))[0]
    cls = [enc.of[c] for c in token]
    changes = sum(a != b for a, b in zip(cls, cls[1:], strict=False))
    q, rare = enc.random.changes, enc.ordinary.changes
    runs = _normal_tail((changes - (n - 1) * q) / math.sqrt((n - 1) * q * (1 - q)))
    runs_o = _binomial_tail(n - 1, rare, changes) if q >= rare else _binomial_tail(n - 1, 1 - rare, n - 1 - changes)
    pos = [enc.at[c] for c in token]
    mean = sum(pos) / n
    var = sum((x - mean) ** 2 for x in pos)
    r = sum((a - mean) * (b - mean) for a, b in zip(pos, pos[1:], strict=False)) / var if var else 1.0
    serial = _normal_tail((r + 1 / n) * math.sqrt(n))
    toward = (r + 1 / n - enc.ordinary.serial) * math.sqrt(n) * (1 if enc.ordinary.serial < 0 else -1)
    serial_o = 0.5 * math.erfc(toward / math.sqrt(2))
    return (uniform, runs, serial), (uniform_o, runs_o, serial_o)


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed; code points, end exclusive."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(ALPHABET), len(ALPHABET)), np.int64)
    for b in blocks(batches):
        total += pair_counts(b.column("text"))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.int64())], names=["pair", "n"])


def corpus_pairs(docs: DataFrame) -> np.ndarray:
    """``pair_counts`` of all texts: summed task by task, then over tasks; as many rows as there are pairs of key characters reach the driver."""
    out = np.zeros(len(ALPHABET) ** 2)
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_pairs, "pair long, n long")
    for r in rows.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(len(ALPHABET), len(ALPHABET))


def _scan(least_p: float, pairs: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                        ("base", pa.string()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("bins", pa.list_(pa.int32())),
                        ("random", pa.list_(pa.bool_()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encodings(pairs)
        for b in blocks(batches):
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                text = text or ""
                base = pattern_spans(text)
                n = Counter(k for _, _, k in base)
                tokens = []
                for m in TOKEN.finditer(text):
                    random, ordinary = battery(m[0], known[infer(m[0])])
                    tokens.append((m.start(), m.end(), _bin(fisher(ordinary)), fisher(random) >= least_p))
                rows.append((doc, n["assign"], n["access"], n["hex"], joined(base), *([list(x) for x in zip(*tokens, strict=True)] if tokens else [[], [], [], []])))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return scan


def _bin(p: float) -> int:
    """Quarter powers of ten: bin i holds p <= 10^(-i / 4)."""
    return min(BINS - 1, int(-4 * math.log10(max(p, 1e-300))))


def cut_bin(counts: dict[int, int], alpha: float) -> int:
    """Benjamini-Hochberg on the histogram: the least bin whose tokens, and all rarer ones, pass; BINS if none do."""
    total, seen, best = sum(counts.values()), 0, BINS
    for i in sorted(counts, reverse=True):
        seen += counts[i]
        if 10 ** (-i / 4) <= alpha * seen / total:
            best = i
    return best


def find_secrets(docs: DataFrame, alpha: float = 0.001, least_p: float = 0.001) -> DataFrame:
    """``docs`` (doc_id, text; others ignored) -> one row per document row: doc_id, n_assign,
    n_access, n_hex, base_sha256, spans, n_random.

    spans lists kind:start:end by start, then kind as listed, of all pattern and random tokens;
    base_sha256 is the digest of the pattern spans alone, so the tests only ever add spans.
    A random token that overlaps a pattern span is listed too. ``alpha``: false-discovery rate;
    ``least_p``: a token whose uniformity, runs and serial p-values combine to less is not random.
    Null and empty texts have no span (empty string, digest of nothing). Null doc_ids and
    repeated rows are scanned like any row; an empty table gives no rows."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = written(src.mapInArrow(_scan(least_p, corpus_pairs(src)), "doc_id long, n_assign long, n_access long, n_hex long, base string, "
                                   "starts array<long>, ends array<long>, bins array<int>, random array<boolean>"), "secrets")
    hist = found.select(F.explode("bins").alias("bin")).groupBy("bin").count()
    cut = cut_bin({r["bin"]: r["count"] for r in hist.collect()}, alpha)  # at most BINS rows
    return found.mapInArrow(_report(cut), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def _report(cut: int):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digest, spans, number = [], [], []
            cols = [b.column(c).to_pylist() for c in ("base", "starts", "ends", "bins", "random")]
            for base, starts, ends, bins, random in zip(*cols, strict=True):
                digest.append(hashlib.sha256(base.encode()).hexdigest())
                old = [(int(a), int(e), k) for k, a, e in (x.split(":") for x in base.split(","))] if base else []
                new = [(a, e, "random") for a, e, i, ok in zip(starts, ends, bins, random, strict=True) if ok and i >= cut]
                spans.append(joined(sorted(old + new, key=lambda s: (s[0], KINDS.index(s[2])))))
                number.append(len(new))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex")),
                                              pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array(number, pa.int64())],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return report
