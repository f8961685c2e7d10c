"""MinHash near-duplicates: minima of many universal hashes, banding, signature
check, exact check on the full shingle sets, components by alternating stars.

1. One pass over the texts gives each document its number of distinct word
   shingles, a 64-bit id of the whole set, one key per band and one bit per
   minimum. Documents with equal sets are one class from here on, so copies,
   however many, cost one row each.
2. Classes that share a band key meet a pivot chosen per bucket (a different
   one in each band), never each other. Signature bits drop pairs that are far
   below the threshold (3.5 standard deviations), and an odd sketch - the parity of
   the set's members in each of 2048 cells - drops pairs that cannot reach it: the cells in
   which two sketches differ are a lower bound of the sets' difference. Each class checks
   its closest pivots on the full sets; links become components.
3. While a large bucket still holds several components, the members of others meet the one with the most
   links so far: copies of one text that are close to it, but not to each other, come together here.
4. Within a bucket, classes that are still in different components are joined
   on the band key, with both tests as join condition, each pair in the first bucket it shares, and the pairs
   that pass are confirmed on full sets. So no link between two components is
   lost, while members of one component are never paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.components import connected_components
from terrafold.llm.textops import Bloom, blocks, dealt, free, hash_strings, mix, powers, windows, words, written

#: Cells of the odd sketch.
CELLS = 2048
#: Pivots whose full sets a class is compared with before the bucket join handles the rest.
FIRST_CHECKS = 3
#: Times that the members of open buckets meet a hub before that, as long as a bucket has more than so many.
HUB_ROUNDS, OPEN_MEMBERS = 3, 64


def shingle_sets(text: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``n``-word shingles; fewer words: the whole sequence; none: empty."""
    w = words(text)
    h = hash_strings(w.vocab)[w.codes] if len(w.codes) else np.zeros(0, np.uint64)
    full = windows(h, n)
    for a, b in zip(w.starts[:-1].tolist(), w.starts[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(full[a : b - n + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            yield mix(np.array([(h[a:b] * powers(b - a)).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def set_id(s: np.ndarray) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64).item()


def minima(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Least value of each universal hash x -> mul * x + add (mod 2^32) over the set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        out = np.minimum(out, (mul[:, None] * x[None, i : i + 2048] + add[:, None]).min(axis=1))
    return out


def odd_sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the set's members in each cell, packed into longs."""
    return np.packbits((np.bincount((s & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS) & 1).astype(np.uint8)).view(np.int64)


def _signer(n: int, bands: int, rows: int, keep: tuple[str, ...]):
    rng = np.random.default_rng(8)
    mul = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    add = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    pad = -(bands * rows) % 64
    pow_rows = powers(rows)
    salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            sizes, ids, keys, bits, odd = [], [], [], [], []
            for s in shingle_sets(b.column("text"), n):
                sizes.append(len(s))
                if not len(s):
                    ids.append(None), keys.append(None), bits.append(None), odd.append(None)
                    continue
                low = minima(s, mul, add)
                ids.append(set_id(s))
                k = (low.reshape(bands, rows).astype(np.uint64) * pow_rows).sum(axis=1, dtype=np.uint64)
                keys.append(mix(k + salt).view(np.int64))
                one = np.concatenate([(low >> np.uint32(17)) & np.uint32(1), np.zeros(pad, np.uint32)]).astype(np.uint8)
                bits.append(np.packbits(one).view(np.int64))
                odd.append(odd_sketch(s))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())),
                 pa.array(odd, pa.list_(pa.int64())), *[b.column(c) for c in keep]],
                names=["doc_id", "n_shingles", "set_id", "bands", "bits", "odd", *keep])

    return sign


def _sets(n: int, bloom: Bloom):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            pos = b.column("pos").to_numpy(zero_copy_only=False)
            no_id = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(bloom.has(pos) | no_id))
            ids, sets = [], []
            for s in shingle_sets(b.column("text"), n):
                if len(s):
                    ids.append(set_id(s)), sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "items"])

    return build


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        (ao, a), (bo, c) = (_list(b.column(x)) for x in ("left_items", "right_items"))
        both = [len(np.intersect1d(a[ao[i] : ao[i + 1]], c[bo[i] : bo[i + 1]], assume_unique=True)) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v"), b.column("n_u"), b.column("n_v"), pa.array(both, pa.int64())],
                                         names=["u", "v", "n_u", "n_v", "n_both"])


def _list(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offs = col.offsets.to_numpy()
    return offs, col.values.to_numpy(zero_copy_only=False)


def _open(met: DataFrame, part: DataFrame, rows: int) -> DataFrame:
    """(key, node, component) of the buckets that hold more than one component; ``met`` has ``rows`` rows."""
    both = dealt(met.select("key", "node").join(part, "node", "left"), rows).withColumn("component", F.coalesce("component", "node"))
    mixed = both.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return written(dealt(both.join(mixed, "key"), rows), "minhash")


def _merged(part: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """Components after more links: each node's link to its component stands for all its links so far."""
    links = part.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links)
    return written(dealt(connected_components(links), rows), "minhash")


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, bands: int = 40, rows: int = 6,
                    keep: tuple[str, ...] = (), among: DataFrame | None = None) -> DataFrame:
    """``docs`` (doc_id long, text; other columns are ignored but for ``keep``) -> one row per document row:
    doc_id, n_shingles, component_id, kept, and the columns ``keep``. With ``among`` (doc_id) only rows with one of its ids take part.

    Links join documents whose ``n``-word shingle sets have den * |both| >= num * |either|.
    component_id is the least doc_id reachable, kept tells whether it is the row's own.
    A null, empty or blank text has an empty set, no link, and is kept. Repeated rows share a class:
    rows that repeat the least doc_id are all kept. Null doc_ids take part; a group of only
    null ids has a null component_id and is kept whole. An empty table gives no rows.
    A pair at the very threshold shares no band with probability (1 - (num/den)^rows)^bands."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    signed = src.mapInArrow(_signer(n, bands, rows, tuple(keep)), "doc_id long, n_shingles long, set_id long, bands array<long>, bits array<long>, odd array<long>" + kinds)
    if among is not None:  # the signatures meet the ids, not the texts
        signed = signed.join(among.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    signed = written(signed, "minhash")
    least = (signed.where("set_id is not null").groupBy("set_id", "n_shingles").agg(F.min("doc_id").alias("least_id")))
    # one row per class: the bands depend on the set alone, so any row of the class has them
    buckets = signed.where("set_id is not null").select(F.col("set_id").alias("node"), F.explode("bands").alias("key")).distinct()
    pivots = (buckets.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(F.col("key"))).alias("p"), F.count(F.lit(1)).alias("c"))
              .where("c > 1").select("key", F.col("p").bitwiseXOR(F.col("key")).alias("pivot")))
    met = written(dealt(buckets.join(pivots, "key"), bands * signed.count()), "minhash")
    rows_met = met.count()  # no table of classes or their buckets below has more rows

    def few(df: DataFrame) -> DataFrame:
        return dealt(df, rows_met)

    involved = few(met.select("node").distinct())
    bits = written(few(signed.select(F.col("set_id").alias("node"), "n_shingles", "bits", "odd", "bands", "doc_id").join(involved, "node")
                       .groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("bits").alias("bits"), F.first("odd").alias("odd"),
                                            F.first("bands").alias("bands"), F.min("doc_id").alias("doc_id"))), "minhash")
    total = bands * rows
    agree = total * (1 + num / den) / 2
    floor = math.floor(agree - 3.5 * math.sqrt(agree * (1 - agree / total)))
    words64 = -(-total // 64)
    differ = " + ".join(f"bit_count(a.bits[{i}] ^ b.bits[{i}])" for i in range(words64))
    apart = " + ".join(f"bit_count(a.odd[{i}] ^ b.odd[{i}])" for i in range(CELLS // 64))
    # the sizes bound the similarity, the bits estimate it, the odd sketches bound it again
    close = (f"{den} * least(a.n, b.n) >= {num} * greatest(a.n, b.n) and {differ} <= {total - floor} "
             f"and {den} * (a.n + b.n - ({apart})) >= {num} * (a.n + b.n + ({apart}))")
    bloom = Bloom.of(bits.where("doc_id is not null"), Bloom.position("doc_id"))
    sets = written(few(src.withColumn("pos", Bloom.position("doc_id")).mapInArrow(_sets(n, bloom), "node long, items array<long>")
                       .join(involved, "node", "left_semi").groupBy("node").agg(F.first("items").alias("items"))), "minhash")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v, n_u, n_v) that reach the threshold on their full sets."""
        full = few(pairs.join(sets.select(F.col("node").alias("u"), F.col("items").alias("left_items")), "u"))
        full = few(full.join(sets.select(F.col("node").alias("v"), F.col("items").alias("right_items")), "v"))
        got = full.select("u", "v", "n_u", "n_v", "left_items", "right_items").mapInArrow(_common, "u long, v long, n_u long, n_v long, n_both long")
        return got.where(f"{den} * n_both >= {num} * (n_u + n_v - n_both)").select("u", "v")

    def judged(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) that pass the tests on sizes, bits and odd sketches."""
        got = few(few(pairs).join(bits.alias("a"), F.col("u") == F.col("a.node")))
        got = few(got.join(bits.alias("b"), F.col("v") == F.col("b.node")).where(close))
        return got.select("u", "v", F.col("a.n").alias("n_u"), F.col("b.n").alias("n_v"), F.expr(differ).alias("far"))

    star = judged(met.where("node <> pivot").select(F.greatest("node", "pivot").alias("u"), F.least("node", "pivot").alias("v")).distinct())
    nearest = Window.partitionBy("u").orderBy("far", "v")
    first = written(confirmed(few(star.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= FIRST_CHECKS))), "links")
    part = written(few(connected_components(first)), "minhash")
    open_ = _open(met, part, rows_met)
    for _ in range(HUB_ROUNDS):
        largest = open_.groupBy("key").count().agg(F.max("count")).first()[0]
        if (largest or 0) <= OPEN_MEMBERS:
            break
        # members of all open buckets meet the one with the most links so far, if it is in another component
        degree = few(first.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("d")))
        ranked = few(open_.join(degree, "node", "left")).select("key", "node", "component", F.struct(F.coalesce("d", F.lit(0)).alias("d"), "node", "component").alias("h"))
        hubs = few(ranked.groupBy("key").agg(F.max("h").alias("h"))).select("key", F.col("h.node").alias("hub"), F.col("h.component").alias("hub_component"))
        meet = few(open_.join(hubs, "key").where("component <> hub_component"))
        meet = meet.select(F.greatest("node", "hub").alias("u"), F.least("node", "hub").alias("v")).distinct()
        more = written(confirmed(judged(meet)), "links")
        if more.isEmpty():
            break
        first = first.unionByName(more)
        part = _merged(part, more, rows_met)
        open_ = _open(met, part, rows_met)
    # what pivots and hubs did not settle: members of one bucket in different components, each pair in its first common bucket only
    open_ = written(few(open_.join(bits, "node")).select("key", "node", "component", "n", "bits", "odd", "bands"), "minhash")
    once = "get(filter(zip_with(a.bands, b.bands, (x, y) -> CASE WHEN x = y THEN x END), z -> z IS NOT NULL), 0) = a.key"
    rest = (open_.alias("a").join(open_.alias("b"), F.expr(f"a.key = b.key and a.node > b.node and a.component <> b.component and {close} and {once}"))
            .select(F.col("a.node").alias("u"), F.col("b.node").alias("v"), F.col("a.n").alias("n_u"), F.col("b.n").alias("n_v")))
    more = written(confirmed(rest), "links")
    comp = part if more.isEmpty() else _merged(part, more, rows_met)
    label = (least.select(F.col("set_id").alias("node"), "least_id").join(comp, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    low = label.groupBy("component").agg(F.min("least_id").alias("component_id"))
    label = label.join(low, "component").select(F.col("node").alias("set_id"), "component_id")
    out = signed.select("doc_id", "n_shingles", "set_id", *keep).join(label, "set_id", "left")
    own = F.col("set_id").isNull()
    out = out.withColumn("component_id", F.when(own, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *keep)


def without_near_copies(docs: DataFrame, originals: DataFrame | None = None, **options) -> DataFrame:
    """Rows of ``docs`` (doc_id, text and any columns), all columns, without near copies of a row with a smaller id.

    With ``originals`` (doc_id, text) the links are those of the texts that ``originals`` gives for the ids of ``docs``: stages before may have
    taken from a copy what made it one. An id that ``originals`` lacks or repeats links by its own text in ``docs``. Rows are told
    apart by id and text: of rows that share an id, only those that are copies go. Rows that repeat the least id of their group in full all
    stay; rows of null id go where their group has an id, else stay; null and empty texts stay. An empty table gives no rows."""
    id_, mark = free(docs, "id"), free(docs, "mark")
    row = F.xxhash64("text")
    one = lambda df: df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row.alias("mark"))
    if originals is None:
        links = near_duplicates(one(docs), keep=("mark",), **options)
    else:
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
        known = written(originals.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().where("doc_id is not null and count = 1")
                        .select("doc_id").join(ids, "doc_id", "left_semi"), "originals")
        own = ids.join(known, ids["doc_id"].eqNullSafe(known["doc_id"]), "left_anti")
        source = one(originals).withColumn("mark", F.lit(None).cast("long"))
        among = known
        if not own.isEmpty():
            mine = one(docs)
            mine = mine.join(known, mine["doc_id"].eqNullSafe(known["doc_id"]), "left_anti")
            theirs = source.join(known, "doc_id", "left_semi")
            source, among = theirs.unionByName(mine), None
        links = near_duplicates(source, keep=("mark",), among=among, **options)
    gone = written(links.where(~F.col("kept")).select(F.col("doc_id").alias(id_), F.col("mark").alias(mark)).distinct(), "near-copies")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (row.eqNullSafe(F.col(mark)) if originals is None else F.coalesce(row == F.col(mark), F.lit(True)))
    return docs.join(gone, same, "left_anti")
