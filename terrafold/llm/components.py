"""Connected components by alternating large-star and small-star.

Each task first replaces its edges by stars of what they connect, so that the rounds begin with
short paths: chains within a task are gone, and a round that changes nothing ends them.
Edges stay distributed; each round is two combinable minima and two joins, and
is written to the shared folder. A hub's edges are never gathered: its minimum
is aggregated map-side, and the join back is one that Spark can split."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from terrafold.llm.textops import TASK_ROWS, dealt, written


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges (u, v), some ``TASK_ROWS`` at a time, as edges from each node to the least that those connect it with."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= TASK_ROWS:
            yield _least(held)
            held = []
    if held:
        yield _least(held)


def _least(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    both = [np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("u", "v")]
    nodes, at = np.unique(np.concatenate(both), return_inverse=True)
    u, v = np.split(at, 2)
    low = np.arange(len(nodes))
    while (apart := low[u] != low[v]).any():  # the greater root goes below the least one beside it
        a, b = low[u[apart]], low[v[apart]]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
    far = low != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[low[far]])], schema=held[0].schema)


def _star(edges: DataFrame, small: bool, rows: int) -> DataFrame:
    """One star operation over undirected edges (u, v).

    large: every neighbour above u is linked to the least of u and its neighbours.
    small: every neighbour up to u, and u itself, is linked to the least of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if small:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    near = dealt(both.join(least.hint("merge"), "u"), rows)
    out = near.select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("keep") if small else (F.col("v") > F.col("u")).alias("keep"))
    out = out.where("keep").drop("keep")
    if small:
        out = out.unionByName(dealt(least.select("u", F.col("m").alias("v")), rows))
    return dealt(out.where("u <> v").distinct(), rows)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Columns (u, v) of one ordered type -> (node, component): the least node reachable.

    Self-loops, repeated edges and nulls are ignored; nodes without an edge do not appear.
    No edges gives no rows. Raises if ``max_rounds`` rounds do not converge."""
    cur = written(edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "cc")
    rows, seen = cur.count(), None
    if isinstance(cur.schema["u"].dataType, IntegralType):
        cur = written(cur.coalesce(-(-rows // TASK_ROWS) or 1).mapInArrow(_stars, cur.schema), "cc")
        seen = _state(cur)
    for _ in range(max_rounds):
        nxt = written(_star(_star(cur, False, rows), True, rows), "cc")
        state = _state(nxt)
        if state == seen:
            return nxt.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                nxt.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        cur, seen = nxt, state
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
