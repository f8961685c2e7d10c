"""Benchmark decontamination by template canonicalisation.

Words become templates: numbers, units and names turn into typed placeholders, all
else is lower-cased. Windows of template words are hashed; a document window that
equals a benchmark window is joined by the hash, whatever its numbers and names are. Per
document, item and offset the slot values are then compared: one value of the item must
always stand for one value in the document (Ann -> Bob everywhere), which tells a
re-parameterised question from a chance meeting of placeholders. A document is
contaminated by an item if consistent windows cover enough of it."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.textops import Bloom, blocks, free, hash_strings, windows, words, written

WINDOW = 8
#: A window needs this many literal words; one made of placeholders says nothing.
LITERALS = 4
COVERAGE = 0.5
#: So many consecutive words of an item contaminate, however long it is.
RUN = 13
#: What the registered query and the pipeline ask for beside the coverage.
WHOLE = {"run": RUN, "short": True, "by_window": True}
UNITS = frozenset("""mm cm dm m km in ft yd mi mile miles inch inches foot feet yard yards meter meters metre metres kilometer kilometers
kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes ml cl l liter liters litre litres
gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years
kmh kph mph hz khz mhz ghz w kw mw kwh j kj cal kcal v a ohm pa kpa bar degree degrees percent dollar dollars euro euros cent cents usd eur gbp""".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d,.:/]*(?:st|nd|rd|th|%)?$")
_EDGE = "\"'`()[]{}<>,;:!?*#$%&|~_"
_END = re.compile(r"[.!?:]['\")\]]*$")

LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
_PLACEHOLDER = ["", "\x00number", "\x00unit", "\x00name"]


def classify(word: str) -> tuple[int, str, bool, bool]:
    """(type if the word stands inside a sentence, its template text, whether it is capitalised, whether it ends a sentence)."""
    if word.isalpha():
        low = word.lower()
        cap = word[0].isupper()
        return (UNIT if low in UNITS else NAME if cap else LITERAL), low, cap, False
    core = word.strip(_EDGE).rstrip(".")
    low = core.lower()
    end = bool(_END.search(word))
    if _NUMBER.match(core):
        return NUMBER, low, False, end
    if low in UNITS:
        return UNIT, low, False, end
    cap = core[:1].isupper()
    return (NAME if cap else LITERAL), low, cap, end


class Templates:
    """Template windows of a block of texts."""

    def __init__(self, text: pa.Array, window: int, need: int):
        w = words(text, lower=False)
        self.starts = w.starts
        vocab = w.vocab.to_pylist()
        info = [classify(x) for x in vocab]
        kind, end = np.array([i[0] for i in info], np.int8), np.array([i[3] for i in info], bool)
        self.low = [i[1] for i in info]
        blank = np.array([not i[1] for i in info], bool)
        lit = hash_strings(pa.array(self.low, pa.string())) if vocab else np.zeros(0, np.uint64)
        slot = hash_strings(pa.array(_PLACEHOLDER))
        # words of punctuation alone are not words here
        keep = ~blank[w.codes] if len(vocab) else np.zeros(0, bool)
        row = np.repeat(np.arange(len(text)), np.diff(w.starts))
        self.codes = w.codes[keep]
        row = row[keep]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(text)))]).astype(np.int64)
        # a capital at a sentence's or line's start is no name
        opens = np.ones(len(self.codes), bool)
        opens[1:] = (row[1:] != row[:-1]) | end[self.codes[:-1]]
        types = kind[self.codes] if len(vocab) else np.zeros(0, np.int8)
        types = np.where((types == NAME) & opens, LITERAL, types)
        self.types, self.row = types, row
        token = np.where(types == LITERAL, lit[self.codes], slot[types]) if len(vocab) else np.zeros(0, np.uint64)
        self.token = token
        self.of(window, need)

    def of(self, window: int, need: int) -> "Templates":
        """Hashes of windows of ``window`` words, and which of them lie in one text and have ``need`` literal words."""
        self.hash = windows(self.token, window)
        m = len(self.hash)
        literal = np.concatenate([[0], np.cumsum(self.types == LITERAL)])
        self.ok = (self.row[:m] == self.row[window - 1 : window - 1 + m]) & (literal[window : window + m] - literal[:m] >= need)
        return self

    def values(self, at: int, window: int) -> list[str]:
        """Values of the slots of the window at position ``at``, typed and in order."""
        return [f"{self.types[i]}{self.low[self.codes[i]]}" for i in range(at, at + window) if self.types[i] != LITERAL]


def _windows_of(window: int, need: int, id_column: str, bloom: Bloom | None, others: list[int] = (), short: bool = False):
    """Windows of ``window`` words with ``need`` literal ones; beside them, to meet whole templates, those of ``others`` words and, if
    ``short``, those of ``window`` words with any literal one."""
    sizes = [(n, 1) for n in others] + [(window, 1 if short else need)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            base = Templates(b.column("text"), window, need)
            for n, literals in sizes:
                t = base.of(n, literals)
                ok = t.ok
                if bloom is not None:
                    ok = ok & bloom.has((t.hash >> np.uint64(40)).astype(np.int64) % Bloom.BITS)
                at = np.flatnonzero(ok)
                rows = t.row[at]
                out = [b.column(id_column).take(pa.array(rows)), pa.array(t.hash[at].view(np.int64)), pa.array(at - t.starts[rows], pa.int64()),
                       pa.array([t.values(i, n) for i in at.tolist()], pa.list_(pa.string()))]
                names = ["id", "hash", "at", "slots"]
                yield pa.RecordBatch.from_arrays(out if bloom is None else [*out, pa.array(np.full(len(at), n), pa.int32())], names=names if bloom is None else [*names, "size"])

    return run


def _wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole template of each item as its one window, if it has a literal word."""
    for b in blocks(batches):
        base = Templates(b.column("text"), 1, 0)
        for i, n in enumerate(np.diff(base.starts).tolist()):
            at = int(base.starts[i])
            if n and (base.types[at : at + n] == LITERAL).any():
                t = base.of(n, 1)
                yield pa.RecordBatch.from_arrays([b.column("item_id").slice(i, 1), pa.array(t.hash[at : at + 1].view(np.int64)), pa.array([0], pa.int64()),
                                                  pa.array([t.values(at, n)], pa.list_(pa.string())), pa.array([n], pa.int32())], names=["id", "hash", "at", "slots", "size"])


def _positions(hash_column) -> "F.Column":
    return F.pmod(F.shiftrightunsigned(hash_column, 40), F.lit(Bloom.BITS))


def benchmark_windows(bench: DataFrame, window: int, need: int) -> DataFrame:
    src = bench.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(_windows_of(window, need, "item_id", None), "id long, hash long, at long, slots array<string>")


def matches(docs: DataFrame, bench: DataFrame, window: int = WINDOW, need: int = LITERALS, coverage: float = COVERAGE,
            run: int | None = None, short: bool = False, by_window: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) and ``bench`` (item_id, text); other columns are ignored -> one row per contaminated
    pair: doc_key, doc_id, item_id, matched (windows of the item found), windows (of the item), coverage,
    changed (slots whose value differs: a re-parameterised copy).

    doc_key is a hash of id and text, so rows repeated in full give one pair, and rows that share an id are
    told apart. A pair counts if consistent windows cover at least ``coverage`` of the item's windows, or, with ``run``, if
    consistent windows of one alignment cover that many consecutive words. A slot value of the item that has two values
    in the document discards its whole alignment; with ``by_window`` each value's most frequent
    counterpart (ties to the smaller) holds, and only the windows that conflict with it are discarded. Items without a window of ``need`` literal words
    (all under ``window`` words are) cannot match, unless ``short`` is set: then their whole template is their one
    window, if it has a literal word. Null and empty texts
    match nothing; null ids are kept as null. Empty tables on either side give no rows."""
    items = written(benchmark_windows(bench, window, need).where("id is not null").withColumn("size", F.lit(window)), "bench")
    if short:
        without = bench.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        without = without.join(items.select(F.col("id").alias("item_id")).distinct(), "item_id", "left_anti")
        items = written(items.unionByName(without.mapInArrow(_wholes, items.schema)), "bench")
    # the lengths of the items' templates: those of the few items without a window, whatever their number
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    src = docs.select(doc_key().alias("doc_key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = Bloom.of(items, _positions(F.col("hash")))
    found = src.mapInArrow(_windows_of(window, need, "doc_key", bits, [n for n in sizes if n != window] if short else [], short), "id long, hash long, at long, slots array<string>, size int")
    # two branches read the matches; the texts are read once
    met = written(found.select(F.col("id").alias("doc_key"), "hash", "size", F.col("at").alias("doc_at"), F.col("slots").alias("doc_slots")).distinct()
           .join(items.select(F.col("id").alias("item_id"), "hash", "size", F.col("at").alias("item_at"), F.col("slots").alias("item_slots")), ["hash", "size"])
           .where("size(doc_slots) = size(item_slots)"), "leaks")
    # pairs of slot values within one alignment of the item: each item value must have one document value
    aligned = met.withColumn("offset", F.col("doc_at") - F.col("item_at"))
    at = ["doc_key", "item_id", "offset"]
    pairs = aligned.select(*at, "item_at", F.explode(F.arrays_zip("item_slots", "doc_slots")).alias("s")).select(
        *at, "item_at", F.col("s.item_slots").alias("item_value"), F.col("s.doc_slots").alias("doc_value"))
    if by_window:
        often = pairs.groupBy(*at, "item_value", "doc_value").agg(F.count(F.lit(1)).alias("n")).groupBy(*at, "item_value").agg(
            F.min(F.struct((-F.col("n")).alias("n"), "doc_value")).alias("most")).select(*at, "item_value", F.col("most.doc_value").alias("held"))
        judged = pairs.join(often, [*at, "item_value"])
        torn = judged.where(F.col("doc_value") != F.col("held")).select(*at, "item_at").distinct()
        changed = often.groupBy(*at).agg(F.sum((F.col("item_value") != F.col("held")).cast("int")).alias("changed"))
        kept = aligned.join(torn, [*at, "item_at"], "left_anti").join(changed, at, "left")
    else:
        torn = (pairs.groupBy(*at, "item_value").agg(F.min("doc_value").alias("lo"), F.max("doc_value").alias("hi"))
                .groupBy(*at).agg(F.max(F.col("lo") != F.col("hi")).alias("torn"), F.sum((F.col("item_value") != F.col("lo")).cast("int")).alias("changed")))
        kept = aligned.join(torn, at, "left").where(~F.coalesce("torn", F.lit(False)))
    size = items.groupBy(F.col("id").alias("item_id")).agg(F.countDistinct("at").alias("windows"))
    got = (kept.groupBy("doc_key", "item_id").agg(F.countDistinct("item_at").alias("matched"), F.max(F.coalesce("changed", F.lit(0))).alias("changed"))
           .join(size, "item_id").withColumn("coverage", F.col("matched") / F.col("windows")))
    enough = F.col("coverage") >= coverage
    if run is not None:
        got = got.join(_long_runs(kept, run), ["doc_key", "item_id"], "left")
        enough = enough | F.coalesce("long", F.lit(False))
    return written(got.where(enough).select("doc_key", "item_id", "matched", "windows", "coverage", "changed"), "leaks")


def _long_runs(kept: DataFrame, run: int) -> DataFrame:
    """doc_key, item_id, long: pairs of which one alignment has windows that touch or overlap over ``run`` words at least."""
    order = Window.partitionBy("doc_key", "item_id", "offset").orderBy("item_at")
    starts = F.coalesce(F.col("item_at") > F.lag(F.col("item_at") + F.col("size")).over(order), F.lit(True))
    runs = kept.select("doc_key", "item_id", "offset", "item_at", "size").distinct().withColumn("starts", starts.cast("int"))
    runs = runs.withColumn("no", F.sum("starts").over(order)).groupBy("doc_key", "item_id", "offset", "no").agg((F.max(F.col("item_at") + F.col("size")) - F.min("item_at")).alias("words"))
    return runs.where(F.col("words") >= run).select("doc_key", "item_id").distinct().withColumn("long", F.lit(True))


def doc_key():
    return F.xxhash64("doc_id", "text")


def leaks(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Contaminated pairs with the document's id: doc_id, item_id, matched, windows, coverage, changed. See ``matches``."""
    got = matches(docs, bench, **options)
    ids = docs.select(doc_key().alias("doc_key"), F.col("doc_id").cast("long").alias("doc_id")).join(got.select("doc_key").distinct(), "doc_key", "left_semi").distinct()
    return got.join(ids, "doc_key").select("doc_id", "item_id", "matched", "windows", "coverage", "changed")


def without_leaks(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, all columns, that no item contaminates."""
    leak = free(docs, "leak")
    bad = written(matches(docs, bench, **options).select(F.col("doc_key").alias(leak)).distinct(), "leaks")
    return docs.join(bad, doc_key() == F.col(leak), "left_anti")
