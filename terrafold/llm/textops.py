"""Helpers shared by the operators: vectorised words and hashes over Arrow
batches, tables written to the shared folder, bounded Bloom bitmaps."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.session import scratch

#: Text bytes handled at once inside a task: bounds numpy's working memory whatever the Arrow batch holds.
BLOCK_BYTES = 1 << 20
#: Rows of an Arrow batch on its way to Python: long before its texts fill a block many times over.
BATCH_ROWS = 1000
#: Narrow rows that are worth a task of their own.
TASK_ROWS = 1 << 14

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives the loss of executors, and is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """``df`` over as many tasks as ``rows`` rows are worth, one for each core at least, however many partitions the shuffle before has:
    what each task costs besides its rows would exceed the work. No rows are moved, and more partitions are never made."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that whole texts travel in, on both sides: by default 10,000 rows, whatever their length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * BLOCK_BYTES))


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``limit`` text bytes (a longer text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers are kept for later tasks


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def raw(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string array without nulls."""
    kind = np.int64 if pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type) else np.int32
    _, offs, data = strings.buffers()
    if not len(strings):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offs = np.frombuffer(offs, kind)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return offs - offs[0], data


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each run of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def powers(n: int) -> np.ndarray:
    """1, P, P^2, ... modulo 2^64."""
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n - 1, 0), _ODD, np.uint64))])[:n]


def hash_strings(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string (polynomial over its bytes, then mixed)."""
    offs, data = raw(strings)
    lens = np.diff(offs)
    out = np.zeros(len(lens), np.uint64)
    if len(data):
        full = lens > 0
        out[full] = np.add.reduceat(_BYTE[data] * powers(int(lens.max()))[within(lens)], offs[:-1][full])
    return mix(out + lens.astype(np.uint64) * _ODD)


@dataclass
class Words:
    """Words of a block of texts: ``codes`` index ``vocab``; row i owns codes[starts[i]:starts[i + 1]]."""

    codes: np.ndarray
    vocab: pa.Array
    starts: np.ndarray


def words(text: pa.Array, lower: bool = True) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lower-cased; a null text has none."""
    text = pc.fill_null(text, "")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    flat, rows = parts.flatten(), pc.list_parent_indices(parts)
    keep = pc.greater(pc.binary_length(flat), 0)
    flat, rows = flat.filter(keep), rows.filter(keep).to_numpy(zero_copy_only=False)
    enc = flat.dictionary_encode()
    starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(text)))]).astype(np.int64)
    return Words(enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary, starts)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (of the whole block; callers mask row borders)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k, p in enumerate(powers(n)):
        out += hashes[k : k + m] * p
    return mix(out + np.uint64(n))


class Bloom:
    """A one-hash bitmap of fixed size. It only saves work: what passes is joined exactly afterwards."""

    BITS = 1 << 23

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def position(*cols) -> "F.Column":
        return F.pmod(F.xxhash64(*cols), F.lit(Bloom.BITS))

    @staticmethod
    def of(df: DataFrame, position) -> "Bloom":
        """Bitmap of a column of positions below BITS; at most BITS / 8 bytes reach the driver, however large ``df`` is."""
        pos = df.select((position + 1).alias("p"))  # Spark's bitmap positions start at 1
        parts = pos.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("b"))
        bits = np.zeros(Bloom.BITS // 8 + 4096, np.uint8)
        for r in parts.collect():
            at = (r["k"] - 1) * 4096
            bits[at : at + 4096] |= np.frombuffer(bytes(r["b"]), np.uint8)
        return Bloom(bits)

    def has(self, pos: np.ndarray) -> np.ndarray:
        return (self.bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1


def bounded_sample(df: DataFrame, by: str, per_value: int, *key: str, columns: list[str], salt: int = 0) -> DataFrame:
    """About ``per_value`` rows for each non-null value of ``by``, chosen by a hash of ``key``: the same rows on every run.

    The rate follows the counts, which are aggregated; nothing is sorted or gathered. The result holds
    some ``per_value`` rows per value however large ``df`` is, so callers may collect it."""
    counts = {r[0]: r[1] for r in df.where(F.col(by).isNotNull()).groupBy(by).count().collect()}
    if not counts:
        return df.select(*columns).limit(0)
    span = 1 << 30
    rate = F.lit(0)
    for value, n in sorted(counts.items()):
        rate = F.when(F.col(by) == F.lit(value), F.lit(min(span, -(-span * per_value // n)))).otherwise(rate)
    return df.where(F.col(by).isNotNull()).where(F.pmod(F.xxhash64(F.lit(salt), *key), F.lit(span)) < rate).select(*columns)
