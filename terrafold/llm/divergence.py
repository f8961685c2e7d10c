"""Source divergence audit: how far the term frequencies of a language's sources lie apart, term by term, exactly.

A term's share depends on its group and its count alone. So each group keeps one bitset of term ids for
each count, and the divergence of two groups is a sum over joint cells: (terms with count a here and count b there) times
f(a, b). AND and popcount of two bitsets give a cell; the terms that a group lacks are the complement of its bitsets.

Ids are dealt in chunks by a hash of the term, and groups in blocks, so a task holds the bitsets of two
blocks of groups over one chunk, however large the vocabulary, and chunks add up by a plain sum."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.textops import blocks, raw, small_batches, written

#: Text bytes whose terms are counted together before any shuffle.
COUNT_BYTES = 4 << 20
#: Terms per chunk and groups per block, about (both are dealt by a hash).
CHUNK_TERMS, BLOCK_GROUPS = 2048, 32
#: A table of at most so many rows is broadcast; a larger one is joined by a shuffle.
SMALL_ROWS = 20_000
#: Words of bitsets that are ANDed at once inside a task.
AND_WORDS = 1 << 20
SCALE = 1_000_000_000

# The bytes of terms, [^\x00-\x40\x5B-\x60\x7B-\x7F] in UTF-8; A-Z are lower-cased.
IS_TERM = np.zeros(256, bool)
IS_TERM[65:91] = IS_TERM[97:123] = IS_TERM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def terms(text: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Terms of all texts in order, dictionary-encoded, and the row of each."""
    offs, data = raw(text)
    inside = IS_TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offs[:-1][np.diff(offs) > 0]
    first[starts] = inside[starts]  # a term ends with its text
    at = np.flatnonzero(first)
    kept = np.cumsum(inside)  # kept bytes up to and including each
    bounds = np.concatenate([kept[at] - 1, kept[-1:]]).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(LOWER[data[inside]])) if len(at) else pa.array([], pa.string())
    return flat.dictionary_encode(), np.searchsorted(offs[1:], at, side="right")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    for b in blocks(batches, limit=COUNT_BYTES):
        found, row = terms(b.column("text"))
        vocab = len(found.dictionary)
        if not vocab:
            continue
        code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lang, source = b.column("lang").dictionary_encode(), b.column("source").dictionary_encode()
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        in_doc, times = np.unique(row * vocab + code, return_counts=True)
        key = group[in_doc // vocab] * vocab + in_doc % vocab
        keys, slot, docs = np.unique(key, return_inverse=True, return_counts=True)
        n = np.bincount(slot, weights=times).astype(np.int64)
        g = keys // vocab
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(g // len(source.dictionary))), source.dictionary.take(pa.array(g % len(source.dictionary))),
             found.dictionary.take(pa.array(keys % vocab)), pa.array(n), pa.array(docs.astype(np.int64))], names=names)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; nulls read as ''."""
    small_batches(docs.sparkSession)
    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    part = src.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _with(df: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """Left join of ``few`` (written): broadcast where its counted rows are few, by a shuffle beyond."""
    return df.join(F.broadcast(few) if few.count() <= SMALL_ROWS else few, on, "left")


def _share(n: str, total: str) -> str:
    return f"1 + ({SCALE} * ({n} + 1)) div ({total})"


def _distance(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def count_bitmaps(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Bitsets of term ids per (group, share), as their 64-bit words that are not empty: lang, source, chunk, p, word, bits."""
    rows = _with(kept.select("lang", "source", "n", "chunk", "pos"), groups, ["lang", "source"])
    rows = rows.select("lang", "source", "chunk", F.expr(_share("n", "total + terms")).alias("p"), F.expr("pos div 64").cast("int").alias("word"),
                       F.expr("shiftleft(1L, cast(pos % 64 as int))").alias("bit"))
    return rows.groupBy("lang", "source", "chunk", "p", "word").agg(F.bit_or("bit").alias("bits"))


def divergence_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q) for every pair of shares."""
    d = p[:, None] - q[None, :]
    return d * d // q[None, :]


def joint_sums(levels: list[tuple[np.ndarray, np.ndarray]], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups ``left[i]`` and ``right[i]``: the sums of cells times f, both ways.

    levels[g] are the shares and the bitsets (one row each) of group g. Pairs come ordered by left."""
    there, back = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    for g in np.unique(left):
        at = np.flatnonzero(left == g)
        p, bits = levels[g]
        others = [levels[h] for h in right[at]]
        q, stack = np.concatenate([o[0] for o in others]), np.concatenate([o[1] for o in others])
        seg = np.concatenate([[0], np.cumsum([len(o[0]) for o in others])[:-1]])
        sums = np.zeros((2, len(q)), np.int64)
        step = max(1, AND_WORDS // max(1, stack.size))
        for i in range(0, len(p), step):
            cells = np.bitwise_count(bits[i : i + step, None, :] & stack[None, :, :]).sum(axis=2, dtype=np.int64)
            sums[0] += (cells * divergence_of(p[i : i + step], q)).sum(axis=0)
            sums[1] += (cells * divergence_of(q, p[i : i + step]).T).sum(axis=0)
        there[at], back[at] = np.add.reduceat(sums[0], seg), np.add.reduceat(sums[1], seg)
    return there, back


def _tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One chunk over two blocks of groups. Rows with word -1 announce a group: its share of absent terms, its block, and the chunk's terms."""
    lang, _, first, second = (k.as_py() for k in key)
    source = table.column("source").combine_chunks().dictionary_encode()
    code = source.indices.to_numpy()
    p, word, bits = (table.column(c).to_numpy() for c in ("p", "word", "bits"))
    head = word < 0
    size = int(bits[head][0])
    width = -(-size // 64)
    full = np.full(width, ~np.uint64(0))
    if size % 64:
        full[-1] = (np.uint64(1) << np.uint64(size % 64)) - np.uint64(1)
    block = np.zeros(len(source.dictionary), np.int64)
    block[code[head]] = table.column("block").to_numpy()[head]
    absent = np.zeros(len(source.dictionary), np.int64)
    absent[code[head]] = p[head]
    levels = []
    order = np.argsort(code[~head], kind="stable")
    code_, p_, word_, bits_ = (x[~head][order] for x in (code, p, word, bits))
    edges = np.searchsorted(code_, np.arange(len(source.dictionary) + 1))
    for g in range(len(source.dictionary)):
        a, b = edges[g], edges[g + 1]
        share, level = np.unique(p_[a:b], return_inverse=True)
        m = np.zeros((len(share) + 1, width), np.uint64)
        m[level + 1, word_[a:b]] = bits_[a:b].view(np.uint64)
        m[0] = full & ~np.bitwise_or.reduce(m[1:], axis=0) if len(share) else full
        levels.append((np.concatenate([[absent[g]], share]), m))
    one, two = np.flatnonzero(block == first), np.flatnonzero(block == second)
    left, right = np.repeat(one, len(two)), np.tile(two, len(one))
    if first == second:
        left, right = left[left < right], right[left < right]
    there, back = joint_sums(levels, left, right) if size else (np.zeros(len(left), np.int64),) * 2
    name = source.dictionary
    return pa.table({"lang": pa.array([lang] * (2 * len(left)), pa.string()),
                     "source": name.take(pa.array(np.concatenate([left, right]))), "item": name.take(pa.array(np.concatenate([right, left]))),
                     "value": pa.array(np.concatenate([there, back]))})


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``docs`` (text, lang, source; other columns are ignored) -> lang, source, part, item, value, rank.

    A language keeps the terms found in at least ``min_docs`` of its documents (rows). A group is a (lang, source) that occurs, even without
    terms. With N the group's occurrences of kept terms and V the kept terms, a term of count c has the share
    p = 1 + floor(1e9 (c + 1) / (N + V)), and f(p, q) = floor((p - q)^2 / q), all in integers.
    Part ``pair``: the sum of f over all kept terms against every other source of the language (q that source's share; 0 without kept terms).
    Part ``term``: the ``top`` kept terms with c > 0 whose share exceeds that of the whole language, by f against it.
    Ranks run by value descending, then item by its UTF-8 bytes.

    Null text, lang and source read as ''. Repeated rows count each time. A language of one source has no pairs;
    an empty table gives no rows."""
    counts = written(term_counts(docs), "audit-counts")
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    vocab = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("d")).where(F.col("d") >= min_docs).drop("d"), "audit-terms")
    size = vocab.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
    langs = written(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(size, "lang", "left").na.fill(0, ["terms", "lang_total"])
                    .withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("terms") / CHUNK_TERMS)).cast("int"))
                    .withColumn("blocks", F.ceil(F.col("sources") / BLOCK_GROUPS).cast("int")), "audit-langs")
    ids = _with(vocab, langs, ["lang"]).withColumn("chunk", F.expr("cast(pmod(xxhash64(lang, term), chunks) as int)"))
    ids = written(ids.withColumn("pos", F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1)
                  .select("lang", "term", "in_lang", "chunk", "pos"), "audit-ids")
    kept = written(counts.select("lang", "source", "term", "n").join(ids, ["lang", "term"]), "audit-kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = _with(groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]), langs, ["lang"])
    groups = written(groups.select("lang", "source", "total", "terms", "lang_total", "chunks", "blocks",
                                   F.expr("cast(pmod(xxhash64(source), blocks) as int)").alias("block")), "audit-groups")

    in_chunk = ids.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("size"))
    heads = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).join(in_chunk, ["lang", "chunk"], "left")
    heads = heads.select("lang", "source", "chunk", F.expr(f"CASE WHEN terms > 0 THEN {_share('0', 'total + terms')} ELSE 1 END").alias("p"), F.lit(-1).alias("word"),
                         F.coalesce("size", F.lit(0)).cast("long").alias("bits"), "block", "blocks")
    words = _with(count_bitmaps(kept, groups), groups.select("lang", "source", "block", "blocks"), ["lang", "source"])
    tiles = heads.unionByName(words).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("lang", "chunk", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "source", "p", "word", "bits", "block")
    sums = tiles.groupBy("lang", "chunk", "first", "second").applyInArrow(_tile, "lang string, source string, item string, value long")
    pair = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    own = _with(kept, groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    own = own.select("lang", "source", F.col("term").alias("item"), F.expr(_share("n", "total + terms")).alias("p"), F.expr(_share("in_lang", "lang_total + terms")).alias("q"))
    own = own.where("p > q").select("lang", "source", "item", F.expr(_distance("p", "q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
    return ranked(pair, "pair").unionByName(ranked(own, "term").where(F.col("rank") <= top))
