"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words and their characters: a word's vector is a row of a hashed word table
beside the maximum over its hashed character n-grams' rows. Both tables start from
label log-odds of the sample in their first column and are trained with the rest. The
network reads windows of ``WINDOW`` words, every ``STRIDE`` words up to the end of the text,
and pools the states of both directions by attention into one logit per window. A
document's score is a logistic of its largest window logit and its number of windows.

Training sees document labels only: in each epoch the window of a toxic document that
scores highest, and the highest and one other of a clean document, are its examples.

At scoring time a word's input product is computed once per distinct word of a
block, and all windows of a block advance together, one word per numpy step."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrafold.llm.textops import Words, blocks, bounded_sample, hash_strings, mix, raw, within, words

#: Bound of the labelled sample, in documents per label (written out in the README).
SAMPLE_DOCS = 1500
WINDOW, STRIDE = 20, 1
HIDDEN, ATTENTION = 8, 4
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 15
WORD_DIM, CHAR_DIM = 4, 4
DIM = WORD_DIM + CHAR_DIM
GRAMS = (3, 4, 5)
EPOCHS, BATCH, RATE = 12, 256, 0.01
#: Training windows that repeat one word of a clean text; the hardest quarter is shown in each epoch.
REPEATS = 4000
#: Windows that advance together: their states stay in the processor's cache.
TOGETHER = 4096
_SALT = np.random.default_rng(5).integers(1, 2**32, (max(GRAMS), 256), dtype=np.uint32)


def grams(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Character n-gram rows of each word (bytes of ``^word$``), and where each word's begin. Every word has one at least."""
    offs, data = raw(vocab)
    lens = np.diff(offs)
    n = len(lens)
    size = lens + 2
    marked = np.zeros(len(data) + 2 * n, np.uint8)
    begin = offs[:-1] + 2 * np.arange(n)
    marked[begin], marked[begin + size - 1] = 2, 3
    inner = np.ones(len(marked), bool)
    inner[begin] = inner[begin + size - 1] = False
    marked[inner] = data
    left = np.repeat(size, size) - within(size)  # bytes from here to the word's end
    running = np.zeros(len(marked), np.uint32)
    rows, there = [], []
    for k in range(max(GRAMS)):
        running[: max(0, len(marked) - k)] += _SALT[k][marked[k:]]
        if k + 1 in GRAMS:
            ok = left >= k + 1
            if k + 1 == GRAMS[0]:
                ok[begin] = True  # a word shorter than the least n-gram still has a row
            h = running * np.uint32(0x85EBCA6B)
            h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            rows.append((h ^ (h >> np.uint32(16))) & np.uint32(CHAR_ROWS - 1))
            there.append(ok)
    there = np.stack(there, axis=1)
    per = np.add.reduceat(there.sum(axis=1), begin) if n else np.zeros(0, np.int64)
    return np.stack(rows, axis=1)[there].astype(np.int32), (np.cumsum(per) - per).astype(np.int64)


def window_starts(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window, and its text: starts 0, STRIDE, ... until one reaches the text's end."""
    n = np.diff(w.starts)
    per = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1, 0)
    return np.repeat(w.starts[:-1], per) + STRIDE * within(per), np.repeat(np.arange(len(n)), per)


def window_words(w: Words, first: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Word codes of each window; beyond the text's end the padding code len(vocab)."""
    at = first[:, None] + np.arange(WINDOW)
    inside = at < w.starts[text + 1][:, None]
    return np.where(inside, w.codes[np.minimum(at, len(w.codes) - 1)], len(w.vocab))


def window_grid(w: Words, first: np.ndarray, text: np.ndarray) -> np.ndarray:
    """``window_words`` of all windows, built in parts and held in 32 bits."""
    out = np.empty((len(first), WINDOW), np.int32)
    for i in range(0, len(first), TOGETHER):
        out[i : i + TOGETHER] = window_words(w, first[i : i + TOGETHER], text[i : i + TOGETHER])
    return out


def softsign(x: np.ndarray, spare: np.ndarray) -> None:
    """x / (1 + |x|) in place: it bounds states to (-1, 1) like tanh, for a tenth of the time."""
    np.abs(x, out=spare)
    spare += np.float32(1)
    x /= spare


def slope(s: np.ndarray) -> np.ndarray:
    """Derivative of softsign, from its value."""
    return (1 - np.abs(s)) ** 2


@dataclass
class Net:
    """Weights by name. Per direction (f, b) and gate (z, r, c): W from the input, U from the state, c the offset.
    Gates are (1 + softsign) / 2, candidates and attention softsign."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(rng: np.random.Generator) -> "Net":
        h = HIDDEN
        make = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        p = {"word": make(WORD_ROWS, WORD_DIM, scale=0.05), "char": make(CHAR_ROWS, CHAR_DIM, scale=0.05)}
        for s in ("fz", "fr", "fc", "bz", "br", "bc"):
            p |= {f"W{s}": make(DIM, h, scale=0.4), f"U{s}": make(h, h, scale=0.3), f"c{s}": np.zeros(h, np.float32)}
        return Net(p | {"A": make(2 * h, ATTENTION, scale=0.3), "v": make(ATTENTION, scale=0.5), "o": make(2 * h, scale=0.4), "bias": np.zeros(1, np.float32)})

    def inputs(self, ids: np.ndarray, gram: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Vector of each word, and zeros for the padding behind them."""
        out = np.zeros((len(ids) + 1, DIM), np.float32)
        if len(ids):
            out[:-1, :WORD_DIM] = self.p["word"][ids]
            for k in range(CHAR_DIM):
                out[:-1, WORD_DIM + k] = np.maximum.reduceat(np.ascontiguousarray(self.p["char"][:, k])[gram], begin)
        return out

    def products(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Input products of every word, once per distinct word."""
        return {s: x @ self.p[f"W{s}"] + self.p[f"c{s}"] for s in ("fz", "fr", "fc", "bz", "br", "bc")}

    def _states(self, s: str, xw: dict[str, np.ndarray], grid: np.ndarray, keep: list | None) -> np.ndarray:
        """States [word, window, unit] of one direction; ``grid`` is [word, window]."""
        n = grid.shape[1]
        half = np.float32(0.5)
        uz, ur, uc = (self.p[f"U{s}{g}"] for g in "zrc")
        out = np.empty((len(grid), n, HIDDEN), np.float32)
        state = np.zeros((n, HIDDEN), np.float32)
        spare = np.empty((n, HIDDEN), np.float32)
        for t in range(len(grid)) if s == "f" else range(len(grid) - 1, -1, -1):
            z, r, c = (np.take(xw[s + g], grid[t], axis=0) for g in "zrc")
            for gate, u in ((z, uz), (r, ur)):
                gate += np.matmul(state, u, out=spare)
                softsign(gate, spare)
                gate *= half
                gate += half
            np.multiply(r, state, out=spare)
            c += spare @ uc
            softsign(c, spare)
            if keep is not None:
                keep.append((t, state, z, r, c))
            new = out[t]
            np.subtract(c, state, out=new)
            new *= z
            new += state
            state = new
        return out

    def forward(self, xw: dict[str, np.ndarray], grid: np.ndarray, pad: int, cache: dict | None = None) -> np.ndarray:
        """One logit per window; ``grid`` [word, window] holds codes of words, ``pad`` beyond a text's end.

        Attention scores are bounded by the sum of |v|, so their exponentials need no shift."""
        kept = {s: [] if cache is not None else None for s in "fb"}
        fwd, bwd = (self._states(s, xw, grid, kept[s]) for s in "fb")
        a, o, h = self.p["A"], self.p["o"], HIDDEN
        total, num = np.zeros(grid.shape[1], np.float32), np.zeros(grid.shape[1], np.float32)
        hids, weights = [], []
        for t in range(len(grid)):
            hid = fwd[t] @ a[:h]
            hid += bwd[t] @ a[h:]
            softsign(hid, np.empty_like(hid))
            e = np.exp(hid @ self.p["v"]) * (grid[t] != pad)
            total += e
            num += e * (fwd[t] @ o[:h] + bwd[t] @ o[h:])
            if cache is not None:
                hids.append(hid), weights.append(e)
        if cache is not None:
            cache |= {"states": np.concatenate([fwd, bwd], axis=2), "hid": np.stack(hids), "a": np.stack(weights) / total, "kept": kept}
        return num / total + self.p["bias"][0]

    def logits(self, x: np.ndarray, grid: np.ndarray, pad: int) -> np.ndarray:
        xw = self.products(x)
        return np.concatenate([self.forward(xw, np.ascontiguousarray(grid[i : i + TOGETHER].T), pad) for i in range(0, len(grid), TOGETHER)])

    def gradients(self, x: np.ndarray, grid: np.ndarray, pad: int, y: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weighted log loss for all weights but the tables, and for ``x``."""
        cache: dict = {}
        logit = self.forward(self.products(x), grid, pad, cache)
        d = ((1 / (1 + np.exp(-logit)) - y) * weight / weight.sum()).astype(np.float32)
        states, hid, a = cache["states"], cache["hid"], cache["a"]
        h = HIDDEN
        g = {"bias": d.sum(keepdims=True), "o": ((a[:, :, None] * states).sum(axis=0)).T @ d}
        worth = states @ self.p["o"]  # what each state would give alone
        de = a * (worth - (a * worth).sum(axis=0)) * d
        g["v"] = np.einsum("tnk,tn->k", hid, de)
        dh = de[:, :, None] * self.p["v"] * slope(hid)
        g["A"] = np.einsum("tnh,tnk->hk", states, dh)
        ds = (a * d)[:, :, None] * self.p["o"] + dh @ self.p["A"].T
        dx = np.zeros_like(x)
        for i, s in enumerate("fb"):
            w, u = ({k: self.p[f"{n}{s}{k}"] for k in "zrc"} for n in "WU")
            for k in "zrc":
                g[f"U{s}{k}"], g[f"W{s}{k}"], g[f"c{s}{k}"] = np.zeros_like(u[k]), np.zeros_like(w[k]), np.zeros(h, np.float32)
            back = np.zeros((grid.shape[1], h), np.float32)
            for t, prev, z, r, c in reversed(cache["kept"][s]):
                cur = back + ds[t, :, i * h : (i + 1) * h]
                dc = cur * z * slope(c)
                drs = dc @ u["c"].T
                dz, dr = cur * (c - prev) * slope(2 * z - 1) / 2, drs * prev * slope(2 * r - 1) / 2
                back = cur * (1 - z) + drs * r + dz @ u["z"].T + dr @ u["r"].T
                into = np.zeros((grid.shape[1], DIM), np.float32)
                for k, dk, src in (("z", dz, prev), ("r", dr, prev), ("c", dc, r * prev)):
                    g[f"U{s}{k}"] += src.T @ dk
                    g[f"W{s}{k}"] += x[grid[t]].T @ dk
                    g[f"c{s}{k}"] += dk.sum(axis=0)
                    into += dk @ w[k].T
                np.add.at(dx, grid[t], into)
        return g, dx


@dataclass
class Model:
    net: Net
    calibration: np.ndarray  # of 1, largest window logit, log(1 + windows)
    empty: float  # score of a text without words

    def score(self, text: pa.Array) -> np.ndarray:
        w = words(text)
        first, owner = window_starts(w)
        top = np.full(len(text), -np.inf)
        if len(first):
            ids, gram, begin = _rows(w.vocab)
            x = self.net.inputs(ids, gram, begin)
            # a long text has as many windows as words: their words are laid out a part at a time
            xw = self.net.products(x)
            part = lambda i: window_words(w, first[i : i + TOGETHER], owner[i : i + TOGETHER])
            logit = np.concatenate([self.net.forward(xw, np.ascontiguousarray(part(i).T), len(w.vocab)) for i in range(0, len(first), TOGETHER)]).astype(np.float64)
            begins = np.flatnonzero(np.diff(owner, prepend=-1))
            top[owner[begins]] = np.maximum.reduceat(logit, begins)
        number = np.bincount(owner, minlength=len(text))
        z = _features(np.where(number > 0, top, 0), number) @ self.calibration
        return np.where(number > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), self.empty)


def _features(top: np.ndarray, number: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(top)), top, np.log1p(number)], axis=1)


def _rows(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return ((hash_strings(vocab) % np.uint64(WORD_ROWS)).astype(np.int64), *grams(vocab))


def _log_odds(w: Words, ids: np.ndarray, gram: np.ndarray, begin: np.ndarray, per_word: np.ndarray, y: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shrunk log-odds of each hashed word row and n-gram row, from the number of toxic and clean texts that hold it."""
    count = {"word": np.zeros((2, WORD_ROWS)), "char": np.zeros((2, CHAR_ROWS))}
    for i in np.flatnonzero(used):
        own = np.unique(w.codes[w.starts[i] : w.starts[i + 1]])
        rows = gram[np.repeat(begin[own], per_word[own]) + within(per_word[own])]
        count["word"][int(y[i]), np.unique(ids[own])] += 1
        count["char"][int(y[i]), np.unique(rows)] += 1
    toxic, clean = y[used].sum(), (1 - y[used]).sum()
    out = []
    for neg, pos in count.values():
        odds = np.log((pos + 0.5) / (toxic + 1)) - np.log((neg + 0.5) / (clean + 1))
        out.append(odds * (pos + neg) / (pos + neg + 4))
    return out[0], out[1]


def fit(texts: list[str | None], labels: list[int], prior: float | None = None, seed: int = 1) -> Model:
    """Train on whole texts with labels 0/1, in memory: callers pass a bounded sample. ``prior``: share of label 1
    among all labelled rows, if the sample is balanced otherwise. With one label only, or no words, the model answers
    the prior (the labels' mean if not given; 0.0 without any)."""
    y = np.array(labels, np.float64)
    w = words(pa.array(texts, pa.string()))
    first, owner = window_starts(w)
    rng = np.random.default_rng(seed)
    net = Net.fresh(rng)
    base = prior if prior is not None else float(y.mean()) if len(y) else 0.0
    if len(set(labels)) < 2 or not len(first):
        flat = np.log((base + 1e-3) / (1 - base + 1e-3))
        return Model(net, np.array([flat, 0, 0]), base)
    ids, gram, begin = _rows(w.vocab)
    per_word = np.diff(np.append(begin, len(gram)))
    word_text = np.repeat(np.arange(len(y)), np.diff(w.starts))
    # the tables learn from every other text and the network from the rest: a text's own label
    # must not sit in the inputs that the network is shown for it
    for_table = np.arange(len(y)) % 2 == 0
    if min(len(set(y[for_table])), len(set(y[~for_table]))) < 2:
        for_table[:] = True
        mine = np.ones(len(y), bool)
    else:
        mine = ~for_table
    net.p["word"][:, 0], net.p["char"][:, 0] = _log_odds(w, ids, gram, begin, per_word, y, for_table)
    shown = mine[owner]
    first, owner = first[shown], owner[shown]
    grid = window_grid(w, first, owner)
    # repetition alone is not toxic: windows that repeat a word of a clean text are clean examples
    clean_words = w.codes[y[word_text] == 0]
    if len(clean_words):
        grid = np.concatenate([grid, np.repeat(rng.choice(clean_words, REPEATS)[:, None], WINDOW, axis=1).astype(np.int32)])
    truth = np.concatenate([y[owner], np.zeros(len(grid) - len(first))])
    x = net.inputs(ids, gram, begin)
    # before the first epoch the log-odds alone rank the windows
    odds = x[:, 0] + x[:, WORD_DIM]
    logit = np.concatenate([odds[grid[i : i + TOGETHER]].max(axis=1) for i in range(0, len(grid), TOGETHER)]).astype(np.float64)
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    has = np.flatnonzero(np.bincount(owner, minlength=len(y)))
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.85**epoch
        top = _top_window(logit[: len(first)], owner, len(y))
        repeated = len(first) + np.argsort(-logit[len(first) :], kind="stable")[: REPEATS // 4]
        clean = has[y[has] == 0]
        other = rng.integers(0, len(first), len(clean))
        other = other[y[owner[other]] == 0]
        chosen = np.concatenate([top[has], other, repeated])
        target = truth[chosen]
        weight = np.where(target == 1, (target == 0).sum() / max(1, (target == 1).sum()), 1.0)
        order = rng.permutation(len(chosen))
        for i in range(0, len(order), BATCH):
            part = chosen[order[i : i + BATCH]]
            used, local = np.unique(grid[part], return_inverse=True)
            real = used[used < len(w.vocab)]
            pad = len(real)  # the padding's code sorts last
            n_grams = per_word[real]
            own_grams = gram[np.repeat(begin[real], n_grams) + within(n_grams)]
            own_begin = np.cumsum(n_grams) - n_grams
            xs = net.inputs(ids[real], own_grams, own_begin)
            g, dx = net.gradients(xs, np.ascontiguousarray(local.reshape(len(part), WINDOW).T), pad, target[order[i : i + BATCH]], weight[order[i : i + BATCH]])
            g["word"], g["char"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["char"])
            np.add.at(g["word"], ids[real], dx[:-1, :WORD_DIM])
            hit = net.p["char"][own_grams] == np.repeat(xs[:-1, WORD_DIM:], n_grams, axis=0)
            np.add.at(g["char"], own_grams, hit * np.repeat(dx[:-1, WORD_DIM:], n_grams, axis=0))
            step += 1
            for k, v in net.p.items():
                m, s = adam[k]
                m += 0.1 * (g[k] - m)
                s += 0.001 * (g[k] ** 2 - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        x = net.inputs(ids, gram, begin)
        logit = net.logits(x, grid, len(w.vocab)).astype(np.float64)
    top = logit[_top_window(logit[: len(first)], owner, len(y))[has]]
    number = np.bincount(owner, minlength=len(y))[has]
    calibration = _logistic(_features(top, number), y[has])
    shown_share = y[has].mean()
    calibration[0] += np.log(base / (1 - base)) - np.log(shown_share / (1 - shown_share))
    return Model(net, calibration, base)


def _top_window(logit: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Index of each text's highest window (0 for texts without windows)."""
    order = np.lexsort((logit, owner))
    out = np.zeros(n, np.int64)
    out[owner[order]] = order  # the last one written per text is its largest
    return out


def _logistic(f: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    b = np.zeros(f.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(f @ b, -30, 30)))
        h = (f * (p * (1 - p))[:, None]).T @ f + ridge * np.eye(len(b))
        step = np.linalg.solve(h, f.T @ (y - p) - ridge * b)
        b += np.clip(step, -2, 2)
    return b


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1): fits a model on whole texts of about
    ``sample_docs`` documents per label, chosen by a hash of the id, in one task; only the weights reach the driver. Null
    ids and labels teach nothing; an id labelled both ways counts as toxic."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    total, toxic = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    prior = min(0.999, max(0.001, toxic / total)) if total else None
    picked = bounded_sample(known, "toxic", sample_docs, "doc_id", columns=["doc_id", "toxic"]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # some 2 * sample_docs ids: a bounded side, and a bounded sample for the one task that trains
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def fit_all(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in parts for r in b.to_pylist()), key=lambda r: (r["doc_id"], r["text"] or ""))
        model = fit([r["text"] for r in got], [int(r["toxic"]) for r in got], prior)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    trained = rows.repartition(1).mapInArrow(fit_all, "model binary").first()  # weights of a fixed size
    return pickle.loads(bytes(trained["model"])) if trained else fit([], [], prior)


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``column``, double in 0..1, from the text alone.

    Null, empty and blank texts get the sample's share of toxic documents; whole texts are scored, whatever
    their length. Repeated rows score alike; a column of the same name is replaced; empty tables stay empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # fixed-size weights, some MB
    docs = docs.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            got = sent.value.score(b.column("text").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=[*b.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns, whose score is below ``threshold``; texts without words stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            text = b.column("text").cast(pa.string())
            keep = sent.value.score(text) < threshold
            keep |= np.diff(words(text).starts) == 0
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
