"""Connected components of a table of links, by repeated joins.

Each task first reduces its own links to a forest. Then large-star and small-star steps alternate: every node hands its
larger neighbours, then its smaller ones, to the smallest neighbour, until nothing changes. Each step aggregates before
the shuffle and is written to the shared folder, so lineage stays short and a hub's links can be split by AQE.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved

LINKS_PER_FOREST = 1 << 20


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the smallest one it is joined with by these links."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root[x], root[y]):
            break
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def _forests(batches):
    held, size = [], 0

    def reduced():
        a, b = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        return _forest(a, b)

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size > LINKS_PER_FOREST:
            done = reduced()
            if len(done[0]) > LINKS_PER_FOREST // 2:  # nothing left to gain here: hand on, start anew
                yield pa.RecordBatch.from_arrays([pa.array(done[0]), pa.array(done[1])], ["u", "v"])
                held, size = [], 0
            else:
                held, size = [done], len(done[0])
    if held:
        done = reduced()
        yield pa.RecordBatch.from_arrays([pa.array(done[0]), pa.array(done[1])], ["u", "v"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): each node of `links` (two long columns), and the smallest node it can reach."""
    links = links.toDF("u", "v").filter("u != v").mapInArrow(_forests, "u long, v long")
    links = saved(links.distinct(), "links")
    while True:
        stepped = _small_star(_large_star(links)).filter("u != v").mapInArrow(_forests, "u long, v long")
        stepped = saved(stepped.distinct(), "links")
        # Done when every node has a single, smaller neighbour that itself has none.
        if not _unsettled(stepped):
            return stepped.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                stepped.select("v", "v").distinct().toDF("node", "component")
            )
        links = stepped


def _unsettled(links: DataFrame) -> bool:
    """Whether a node has two smaller neighbours, or a smaller neighbour that has one."""
    down = links.groupBy("u").agg(F.count("*").alias("n"), F.lit(True).alias("below")).select(F.col("u").alias("node"), "n", "below")
    up = links.select(F.col("v").alias("node"), F.lit(0).alias("n"), F.lit(False).alias("below")).distinct()
    both = down.union(up).groupBy("node").agg(
        F.max("n").alias("n"), F.bool_or("below").alias("below"), F.bool_or(~F.col("below")).alias("above")
    )
    return bool(both.filter("n > 1 OR (below AND above)").take(1))
