"""Mixing sources to target weights as a time-varying curriculum (DataFrame only).

Every source gets a word target (water-filling below a repeat limit). Over the
training run, time t in 0..1, source s is drawn at the rate
``target_s * (1 - b_s + 2 * b_s * t)``: b > 0 favours late training, b < 0
early, 0 is flat. Its integral, the cumulative demand
``target_s * ((1 - b_s) * t + b_s * t^2)``, is inverted at each document's place
in its source's stream, which gives the time at which the document is trained
on. Ranging all documents by that time yields the training order.

A source's stream is its documents in a hashed order, repeated; the stream is
cut at the target. Places are prefix sums taken in two levels (hashed buckets,
then within a bucket), so a source holding a third of all rows is spread over
all tasks and no source is sorted in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrafold.llm.textops import written

WORD = r"[^\x20\x09-\x0D]++"
#: Hex digits of the hash that make the buckets of the two-level prefix sum: 4096 per source.
BUCKET_DIGITS = 3


def size_of(text: Column) -> Column:
    """Number of words of a text; 0 for null. Counted without building the words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """(source, source_size) -> adds source_rank, weight and target.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all
    sizes; a target stops at ``limit`` times its source's size and the excess goes to the others
    by weight, until none is above. Ordering the sources by the level at which they fill turns
    that repetition into one running sum: level = (total - filled before) / (weight from here).
    One row per source: the number of sources, not of documents, bounds this step."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (sizes.withColumn("source_rank", F.row_number().over(order))
         .withColumn("weight", F.get(w, (F.col("source_rank") - 1) % len(weights)))
         .withColumn("most", limit * F.col("source_size")))
    fill = Window.orderBy(F.col("most") / F.col("weight"), "source_rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    s = (s.withColumn("before", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
         .withColumn("left_weight", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("level", (share * F.sum("source_size").over(whole) - F.col("before")) / F.col("left_weight")))
    # the first source, in filling order, that does not fill sets the level of all from there on
    s = s.withColumn("open_level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "source_rank", "level"))).over(whole)["level"])
    target = F.coalesce(F.least("most", F.col("open_level") * F.col("weight")), F.col("most"))
    return s.withColumn("target", target).select("source", "source_size", "source_rank", "weight", "target")


def curriculum(docs: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = (3, 1, 2),
               slopes: tuple[float, ...] = (0.5, -0.5, 0.0)) -> DataFrame:
    """``docs`` (doc_id, text, source; others ignored) -> one row per document row: doc_id, size,
    source_size, target, taken, epochs, first_position, last_position, in training order.

    taken counts the words the mix draws, repeats counted; the positions are the times (0..1)
    of a document's first and last turn, null if it is not taken. A document is drawn as a whole,
    and the turn that crosses the target counts if its middle lies before it, so each source
    ends within half a document of its target and none exceeds ceil(limit) times its size.

    Null texts have size 0, are never drawn and have no position. A null source is one source,
    ranked last; a null doc_id is an ordinary row; rows repeated in full are separate documents
    that tie, so either order gives the same table. Empty tables give no rows. Reruns agree:
    order depends on doc_id, source and size alone."""
    key = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), "source", F.col("size").cast("string")))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    size_of(F.col("text").cast("string")).alias("size"))
    d = written(d, "mixing")  # the texts are read once
    d = d.withColumn("h", key).withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    per_bucket = d.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = per_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    plan = targets(sources, share, limit, weights)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begin = per_bucket.withColumn("begin", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begin = begin.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "bucket_size")
    begin = begin.withColumnRenamed("source", "s").withColumnRenamed("bucket", "b")
    d = d.withColumn("place", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(begin, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    middle = F.col("begin") + F.col("place") + F.col("size") / 2
    slope = F.get(F.array(*[F.lit(float(x)) for x in slopes]), (F.col("source_rank") - 1) % len(slopes))
    turns = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.floor((F.col("target") - middle) / F.col("source_size")) + 1)).otherwise(F.lit(0))
    d = d.withColumn("middle", middle).withColumn("slope", slope).withColumn("epochs", turns.cast("int"))

    def position(turn: Column) -> Column:
        """The time at which the cumulative demand reaches the document's middle in that turn."""
        share_of = F.least(F.lit(1.0), (F.col("middle") + turn * F.col("source_size")) / F.col("target"))
        a, b = F.col("slope"), 1 - F.col("slope")
        # a t^2 + b t = share; this form of the root also holds for a = 0
        return F.when(F.col("epochs") > 0, 2 * share_of / (b + F.sqrt(b * b + 4 * a * share_of)))

    out = d.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"), "epochs",
                   position(F.lit(0)).alias("first_position"), position(F.col("epochs") - 1).alias("last_position"))
    return out.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
