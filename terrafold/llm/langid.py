"""Language identification by cross-parsing entropy over suffix automata.

A suffix automaton of a language's sample text accepts exactly its substrings, so
walking it from the root along a text until it fails yields the longest match;
that is one phrase, and the next starts at the character that failed. Text close to
the sample parses into few long phrases. Phrases are normalised to an estimated
cross entropy, phrases * log2(sample length) / characters, and the lowest wins.

Texts are mapped to a small alphabet and cut into blocks of a fixed length (each
block ends a phrase, at most one phrase more per block); all blocks of a batch walk the
automata in lock-step, one character per numpy step, so long and short texts cost
alike per character."""

from __future__ import annotations

import hashlib
import math
import pickle
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.textops import blocks, bounded_sample

#: Bounds of the labelled sample: documents and characters per language.
SAMPLE_DOCS = 60
SAMPLE_CHARS = 40_000
BLOCK = 1024
#: Text bytes that walk together: a numpy step costs the same for few blocks as for many.
TOGETHER_BYTES = 4 << 20
#: Transitions of an automaton are a table up to so many entries, sorted keys beyond (many letters); both are the same function.
TABLE_ENTRIES = 1 << 24
SPACE, OTHER = 0, 1


def _fold(ch: str) -> str:
    return ch.lower()[:1]


def _letter(ch: str) -> bool:
    return unicodedata.category(ch)[0] == "L"


class Sparse:
    """Transitions by sorted keys state * alphabet + code; -1 where there is none. Indexed like the table."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.to = keys[order], to[order].astype(np.int32)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys[i] == at, self.to[i], np.int32(-1))


def build_automaton(codes: list[int], alphabet: int, table_entries: int | None = None) -> np.ndarray | Sparse:
    """Transitions [state * alphabet + code] of the suffix automaton of ``codes``; -1 where there is none."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(nxt)
        nxt.append({}), length.append(length[last] + 1), link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q])), length.append(length[p] + 1), link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    if len(nxt) * alphabet > (TABLE_ENTRIES if table_entries is None else table_entries):
        pairs = np.array([(s * alphabet + c, t) for s, edges in enumerate(nxt) for c, t in edges.items()], np.int64).reshape(-1, 2)
        return Sparse(pairs[:, 0], pairs[:, 1])
    out = np.full((len(nxt), alphabet), -1, np.int32)
    for s, edges in enumerate(nxt):
        for c, t in edges.items():
            out[s, c] = t
    return out.ravel()


class Model:
    """Sample text per language and the alphabet they share: every letter of the samples. The automata are built where they are used, once
    per process; only the bounded samples travel."""

    def __init__(self, samples: dict[str, str]):
        self.samples = dict(sorted(samples.items()))
        counts: dict[str, int] = {}
        for text in self.samples.values():
            for ch in text:
                if _letter(ch):
                    counts[_fold(ch)] = counts.get(_fold(ch), 0) + 1
        self.letters = sorted(sorted(counts), key=lambda c: -counts[c])
        self.key = hashlib.sha256(pickle.dumps(self.samples)).hexdigest()

    @property
    def alphabet(self) -> int:
        return len(self.letters) + 2


_READY: dict[str, tuple] = {}


@lru_cache(1)
def _letters_of_unicode() -> np.ndarray:
    return np.array([_letter(chr(c)) for c in range(0x110000)])


def _ready(model: Model) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Code of every code point, and the automaton of each language."""
    if model.key not in _READY:
        _READY.clear()
        at = {c: i + 2 for i, c in enumerate(model.letters)}
        code = np.where(_letters_of_unicode(), OTHER, SPACE).astype(np.uint8 if model.alphabet <= 256 else np.int32)
        for ch, i in at.items():
            for form in {ch, ch.upper()[:1], ch.title()[:1]}:
                if _fold(form) == ch:
                    code[ord(form)] = i
        autos = {lang: build_automaton(encode(text, code)[0].tolist(), model.alphabet) for lang, text in model.samples.items()}
        _READY[model.key] = code, autos
    return _READY[model.key]


def encode(text: str, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Alphabet codes of a text, runs of non-letters as one SPACE, and the position each code came from."""
    got = code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(got), bool)
    keep[1:] = (got[1:] != SPACE) | (got[:-1] != SPACE)
    return got[keep], np.flatnonzero(keep)


def count_phrases(grid: np.ndarray, lengths: np.ndarray, auto: np.ndarray | Sparse, alphabet: int) -> np.ndarray:
    """Phrases of each block: ``grid[t]`` holds character t of all blocks, longest block first."""
    n = len(lengths)
    state, phrases = np.zeros(n, np.int32), (lengths > 0).astype(np.int64)
    active = np.searchsorted(-lengths, -np.arange(len(grid)), side="left")  # blocks longer than t
    for t in range(len(grid)):
        m = active[t]
        c = grid[t, :m]
        to = auto[state[:m].astype(np.int64) * alphabet + c]
        bad = to < 0
        if bad.any():
            where = np.flatnonzero(bad)
            phrases[where] += state[where] > 0  # a character unknown at the root is a phrase of its own
            again = auto[c[where]]
            alone = again < 0
            to[where] = np.where(alone, 0, again)
            # after such a character the next one begins a new phrase
            phrases[where[alone]] += (t + 1 < lengths[where[alone]]).astype(np.int64)
        state[:m] = to
    return phrases


def parse(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases [language, text], characters and letters of each text, whole texts."""
    code, autos = _ready(model)
    texts = pc.fill_null(texts, "")
    n = len(texts)
    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = "".join(texts.to_pylist())
    got = code[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    rows = np.repeat(np.arange(n), size)
    keep = np.ones(len(got), bool)
    keep[1:] = (got[1:] != SPACE) | (got[:-1] != SPACE) | (rows[1:] != rows[:-1])
    got, rows = got[keep], rows[keep]
    chars = np.bincount(rows, minlength=n)
    letters = np.bincount(rows, weights=got != SPACE, minlength=n).astype(np.int64)
    begin = np.cumsum(chars) - chars
    per = -(-chars // BLOCK)
    row = np.repeat(np.arange(n), per)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    first = begin[row] + number * BLOCK
    length = np.minimum(BLOCK, begin[row] + chars[row] - first)
    order = np.argsort(-length, kind="stable")
    row, first, length = row[order], first[order], length[order]
    phrases = np.zeros((len(autos), n), np.int64)
    if len(row):
        grid = np.zeros((int(length[0]), len(row)), np.int32)
        padded = np.concatenate([got, np.zeros(BLOCK, got.dtype)])
        for lo in range(0, len(row), 4096):
            grid[:, lo : lo + 4096] = padded[first[None, lo : lo + 4096] + np.arange(len(grid))[:, None]]
        for i, auto in enumerate(autos.values()):
            phrases[i] = np.bincount(row, weights=count_phrases(grid, length, auto, model.alphabet), minlength=n)
    return phrases, chars, letters


def _predict(model_of):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        langs = list(model.samples)
        bits = np.array([math.log2(max(2, len(t))) for t in model.samples.values()])
        for b in blocks(batches, limit=TOGETHER_BYTES):
            if langs:
                phrases, chars, letters = parse(b.column("text"), model)
                entropy = phrases * bits[:, None] / np.maximum(chars, 1)
                best = entropy.argmin(axis=0)
                low = entropy.min(axis=0)
                second = np.partition(entropy, 1, axis=0)[1] if len(langs) > 1 else np.full(len(low), np.inf)
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = np.where(letters > 0, 1 - np.where(second > 0, low / second, 1.0), 0.0)
                pred = [langs[i] if k else "und" for i, k in zip(best.tolist(), letters.tolist(), strict=True)]
            else:
                pred, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return predict


def held_out(doc_id, mod: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % mod == remainder, F.lit(False))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """``docs`` (doc_id, text, lang): a sample of about ``sample_docs`` documents per language, chosen by a hash of
    the id, at most ``sample_chars`` characters per language, is all that reaches the driver. Each document gives as many
    characters as any other, or all it has.
    Null langs and null texts teach nothing; no labelled text gives a model that answers `und`."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = bounded_sample(known, "lang", sample_docs, "doc_id", columns=["lang", "doc_id", "text"]).select(
        "lang", "doc_id", F.substring("text", 1, sample_chars).alias("text")).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    return Model({lang: " ".join(t[: fair_share([len(t) + 1 for t in got], sample_chars)] for t in got) for lang, got in texts.items()})


def fair_share(sizes: list[int], total: int) -> int:
    """The largest length c such that parts of min(size, c) fit into ``total``."""
    left = total
    for i, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - i)
        if size > share:
            return share
        left -= size
    return max(sizes, default=0)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text, held_out; others ignored) -> doc_id, held_out, lang_pred, score, one row per row.

    lang_pred: the language of lowest cross entropy, ties to the smaller name; `und` with score 0 if the text is null,
    empty or holds no letter. score: 1 - lowest / second lowest entropy (0..1; 1 for a model of one language).
    Whole texts are parsed, whatever their length. Repeated rows and null ids are ordinary rows; empty tables give none."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("held_out"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most sample_chars characters per language
    return src.mapInArrow(_predict(sent), "doc_id long, held_out boolean, lang_pred string, score double")
