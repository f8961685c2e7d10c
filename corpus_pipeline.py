"""A training-corpus pipeline over the operators of ``terrafold.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result to the shared folder and reads it as the next one's documents. All but the last keep the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm import decontaminate, linededup, mixing, neardup, toxicity
from terrafold.llm.textops import small_batches, table, written
from terrafold.session import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _prepare(spark: SparkSession) -> None:
    ship(spark)
    small_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labels of this stage's own documents, does not call toxic.

    Null, empty and blank texts stay; rows of one text go or stay together; without labels of both kinds nothing goes; an empty table stays empty."""
    _prepare(spark)
    docs = docs.select(*COLUMNS)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has; documents that lose every line with text go.
    n_chars follows the text. Null and blank texts stay; rows repeated in full lose the same lines."""
    _prepare(spark)
    had = F.length(F.trim("text")) > 0
    got = linededup.dedup_lines(docs.select(*COLUMNS).withColumn("_had", had))
    left = F.coalesce(F.length(F.trim("text")) > 0, F.lit(False))
    got = got.where(left | ~F.coalesce("_had", F.lit(False)) | (F.col("n_dropped") == 0))
    return got.select("doc_id", "text", "lang", "source", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near-duplicates among these documents: first by the texts that the
    stage is given, as the line stage may have made texts alike that were not, then, among what is left, by those that
    ``documents`` has for the same ids, as it has taken from later copies the lines that they share with earlier ones."""
    _prepare(spark)
    near = {"n": 5, "num": 80, "den": 100, "bands": 40, "rows": 6}
    left = written(neardup.without_near_copies(docs.select(*COLUMNS), **near), "near-copies-left")
    return neardup.without_near_copies(left, table(spark, sf_dir, "documents"), **near)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Null and empty texts hold none and stay; rows that share an id are judged apart."""
    _prepare(spark)
    return decontaminate.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), **decontaminate.WHOLE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: one row per document with its size, what the mix takes and when. A null text has size 0 and is
    not taken; a null source is one of its own, last in order; an empty table gives no rows."""
    _prepare(spark)
    return mixing.curriculum(docs.select(*COLUMNS))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained network, hashed minima and a benchmark match decide the rows; tests hold the stages against brute force.
ORACLE_SQL = None
