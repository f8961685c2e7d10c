"""Line dedup by a deletion-neighbourhood join.

Two lines within one edit share a string that each reaches by deleting at most one
character. Every line emits that neighbourhood - itself and each one-character deletion - as
hashed keys; equal keys meet, the edit distance is verified, and a line goes if an
earlier one lies within the bound.

A deletion's key comes with its position. Lines that share both differ in that one
character at most, so a bucket is all
linked: each member only meets the bucket's earliest, and no pairs are formed among
them. Insertions meet through the string itself, which is one line per key.

Emitting all deletions of all lines would multiply the corpus by the line length.
An exact semi-join comes first: of two lines within one edit, the first or the last half is equal, so
only lines that share a half (at a length within one) with another line emit anything."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.textops import Bloom, blocks, free, mix, powers, within, written

#: Shorter lines (after trimming) go only if an earlier one is equal: a short line within one edit of another says little.
MIN_CHARS = 20
EDITS = 1
WHOLE = -1
_CHAR = np.uint64(0xD6E8FEB86659FD93)


def deletion_keys(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, position) of each line's one-deletion neighbourhood; position WHOLE for the line itself.

    A string's hash is the sum of mixed characters times powers, so the hash after deleting character i is
    prefix(i) + (suffix(i + 1)) / P: all deletions of all lines come from two running sums."""
    texts = lines.to_pylist()
    lens = np.array([len(t) for t in texts], np.int64)
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), lens)
    pos = within(lens)
    starts = np.cumsum(lens) - lens
    p = powers(int(lens.max(initial=0)) + 1)
    value = mix((cp + np.uint64(1)) * _CHAR)
    here = np.concatenate([[np.uint64(0)], np.cumsum(value * p[pos], dtype=np.uint64)])
    # the same sums with every character moved one place to the left
    moved = np.concatenate([[np.uint64(0)], np.cumsum(value * np.where(pos > 0, p[np.maximum(pos - 1, 0)], np.uint64(0)), dtype=np.uint64)])
    at = np.arange(len(cp))
    r = row
    end = starts + lens
    gone = here[at] - here[starts[r]] + moved[end[r]] - moved[at + 1]
    whole = here[end] - here[starts]
    size = np.concatenate([lens, lens[r] - 1]).astype(np.uint64)
    keys = mix(np.concatenate([whole, gone]) + mix(size))
    return np.concatenate([np.arange(len(texts)), r]), keys, np.concatenate([np.full(len(texts), WHOLE), pos[at]])


def _neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches, column="line", limit=1 << 20):
        row, key, pos = deletion_keys(b.column("line"))
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays([b.column("h").take(take), b.column("doc").take(take), b.column("no").take(take),
                                          pa.array(key.view(np.int64)), pa.array(pos, pa.int32())], names=["h", "doc", "no", "key", "pos"])


def _passing(bloom: Bloom):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(bloom.has(h % Bloom.BITS)))

    return run


def row_key():
    return F.xxhash64("doc_id", "text")


def _lines(docs: DataFrame) -> DataFrame:
    """doc, row, no, line: trimmed, lower-cased lines that are not empty; ids of null come last."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"), row_key().alias("row"),
                    F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("no", "line"))
    return d.withColumn("line", F.lower(F.trim("line"))).where("line <> ''")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(row, no) of every line that has an equal earlier line, by (doc_id, line number), or if both have ``min_chars`` characters one within one edit.

    ``row`` is a hash of id and text; see ``dedup_lines`` for the cases."""
    lines = _lines(docs)
    half = F.floor(F.length("line") / 2).cast("int")
    less = F.floor((F.length("line") - 1) / 2).cast("int")
    keys = F.array(F.xxhash64(F.lit("a"), F.substring("line", F.lit(1), half)), F.xxhash64(F.lit("z"), F.right("line", half)),
                   F.xxhash64(F.lit("a"), F.substring("line", F.lit(1), less)), F.xxhash64(F.lit("z"), F.right("line", less)))
    seen = written(lines.select("doc", "row", "no", F.xxhash64("line").alias("h"),
                                F.when(F.length("line") >= min_chars, F.array_distinct(keys)).alias("halves")), "lines")
    # the earliest place of each distinct line, as the least (doc, no); partial minima, so a line of a third of all rows is one row per task
    first = written(seen.groupBy("h").agg(F.min(F.struct("doc", "no")).alias("at"), F.count(F.lit(1)).alias("n"), F.first("halves").alias("halves")), "lines")
    shared = first.select("h", F.explode("halves").alias("half"))
    common = shared.groupBy("half").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("half")
    open_ = written(shared.join(common, "half").select("h").distinct().join(first, "h").select("h", F.col("at.doc").alias("doc"), F.col("at.no").alias("no")), "lines")
    # the bitmap spares all other lines the shuffle; the join is the exact test
    bloom = Bloom.of(open_, F.pmod("h", F.lit(Bloom.BITS)))
    hashed = lines.select(F.xxhash64("line").alias("h"), "doc", "no", "line")
    texts = written(hashed.mapInArrow(_passing(bloom), hashed.schema).join(open_, ["h", "doc", "no"])
                    .select("h", "doc", "no", "line").dropDuplicates(["h"]), "lines")
    # one shuffle and one sort by key serve both windows; a key's lines are one character from its string, so their number is bounded by alphabet and length
    near = texts.mapInArrow(_neighbourhoods, "h long, doc long, no int, key long, pos int")
    in_bucket = Window.partitionBy("key", "pos").orderBy("doc", "no", "h")
    in_key = Window.partitionBy("key").orderBy("pos", "doc", "no", "h")
    met = (near.repartition("key").withColumn("first", F.first("h").over(in_bucket)).withColumn("low", F.first(F.struct("pos", "h")).over(in_key))
           .where((F.col("pos") >= 0) & ((F.col("first") != F.col("h")) | (F.col("low.pos") == WHOLE))))
    met = written(met.select("h", "first", F.when(F.col("low.pos") == WHOLE, F.col("low.h")).alias("whole")), "lines")
    same = met.select("h", F.col("first").alias("other"))
    # a line that is another's deletion: either may be the earlier one
    grown = met.where("whole is not null").select("h", F.col("whole").alias("other"))
    pairs = same.unionByName(grown).unionByName(grown.select(F.col("other").alias("h"), F.col("h").alias("other"))).where("h <> other").distinct()
    a = texts.select("h", F.col("line").alias("l1"), F.col("doc").alias("d1"), F.col("no").alias("n1"))
    b = texts.select(F.col("h").alias("other"), F.col("line").alias("l2"), F.col("doc").alias("d2"), F.col("no").alias("n2"))
    edit = F.levenshtein("l1", "l2", EDITS)
    close = (pairs.join(a, "h").join(b, "other").where((edit >= 0) & (edit <= EDITS) & ((F.col("d2") < F.col("d1")) | ((F.col("d2") == F.col("d1")) & (F.col("n2") < F.col("n1")))))
             .select("h").distinct().withColumn("near", F.lit(True)))
    drop = first.where("n > 1").select("h", "at").unionByName(first.join(close, "h", "left_semi").select("h", "at")).distinct()
    drop = drop.join(close, "h", "left").withColumn("near", F.coalesce("near", F.lit(False)))
    return (seen.select("doc", "row", "no", "h").join(drop, "h")
            .where(F.col("near") | (F.col("doc") != F.col("at.doc")) | (F.col("no") != F.col("at.no"))).select("row", "no").distinct())


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` (doc_id, text and any columns) -> the same columns, the text without its dropped lines, and
    n_lines, n_dropped.

    Lines are the parts between newlines; they are compared trimmed and lower-cased, and kept as written. A
    line goes if an earlier line, by (doc_id, line number), is equal to it or, where both have at least ``min_chars`` characters, within one edit of it, itself
    dropped or not; blank lines always stay. Rows repeated in full are one document: all keep the same lines. Rows that share an id
    and differ in text tie by line number: equal lines at equal places both stay. Null ids come after
    all others; a null text stays null with 0 lines; an empty text is one empty line. Empty tables give no rows;
    columns named n_lines or n_dropped are replaced, all others come back as they are."""
    row, gone_ = free(docs, "row"), free(docs, "gone")
    gone = written(dropped_lines(docs, min_chars).groupBy("row").agg(F.collect_list("no").alias("gone")), "lines")  # at most a document's lines
    d = docs.drop("n_lines", "n_dropped").withColumn(row, row_key())
    d = d.join(gone.select(F.col("row").alias(row), F.col("gone").alias(gone_)), row, "left")
    parts = F.split(F.col("text").cast("string"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone_))
    left = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    none = F.col(gone_).isNull()
    return d.select(*[F.when(none, F.col("text")).otherwise(left).alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")],
                    F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).alias("n_lines"), F.when(none, 0).otherwise(F.size(gone_)).alias("n_dropped"))
