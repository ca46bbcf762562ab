"""Near copies among embeddings by NN-descent.

Equal vectors are one node with a count. A neighbour graph begins with vectors that random projections sort next to
each other, and is refined by neighbours-of-neighbours joins: around every node, its neighbours and those it is a
neighbour of meet and are compared with each other, and each keeps the best. All pairs at or above the threshold that
any comparison finds are kept as links. How many projections there are follows the number of nodes. Recall is audited:
nodes are drawn and compared with all vectors until they have enough links, and while too few of these were found,
further projections and joins follow. If that no longer helps, the search fails; if the most that is drawn has too few
links to judge by, it warns.

Where lists are saturated with links, they are enlarged to the node's whole component: its members are compared in
blocks of bounded size, and what comes back is a count per member and block, not a pair. So inside components counts
are whole; a link is missed only if no chain of found links joins its ends. How much a component of n nodes needs
grows with n times n, as the counts asked for do; its blocks spread over all tasks.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors
of different length link with nothing; rows that repeat an id are counted as vectors of their own; a null id comes
before all others and is shown as null; columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.components import components
from shelfwatch.llm.tables import saved, small

NO_ID = -(2**63)
NEIGHBOURS = 8
# Projections up to PROJECTED_NODES nodes; beyond, as many as keep a lone pair's chance of meeting in one of them.
TABLES = 10
PROJECTED_NODES = 10_000
PLANES = 40
WINDOW = 64
JOINS = 2
# Nodes of the first draw of the audit, each further one twice as large; draws at most; links that are enough.
AUDITED = 1024
DRAWS = 5
AUDITED_LINKS = 500
RECALL = 0.98
# Attempts in a row that may raise recall by nothing.
ATTEMPTS = 4
BLOCK = 256
EDGES = "a long, b long, similarity double"


def _units(batch: pa.RecordBatch, column: str = "unit") -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors, per length."""
    lists = batch.column(column)
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    size = np.diff(offsets)
    out = []
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        out.append((rows, flat[offsets[rows][:, None] + np.arange(n)]))
    return out


def _edges(a, b, similarity) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(similarity, pa.float64())], ["a", "b", "similarity"])


def _projected(seed: int, tables: int):
    """(table, signature, node, unit): the signs of a vector on random planes, as a number to sort by."""

    def rows(batches):
        for batch in batches:
            node, unit = batch.column("node"), batch.column("unit")
            for rows, vectors in _units(batch):
                for t in range(tables):
                    planes = np.random.default_rng([seed, t, vectors.shape[1]]).standard_normal((vectors.shape[1], PLANES))
                    signs = vectors @ planes > 0
                    signature = signs @ (1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64))
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), t, np.int32)), pa.array(signature), node.take(take), unit.take(take)],
                        ["table", "signature", "node", "unit"],
                    )

    return rows


def _best(similarity: np.ndarray, threshold: float, few: int) -> np.ndarray:
    """Marks what reaches the threshold, and each row's best few."""
    marks = similarity >= threshold
    if similarity.shape[1] > few:
        top = np.argpartition(-similarity, few - 1, axis=1)[:, :few]
        np.put_along_axis(marks, top, True, axis=1)
    else:
        marks |= similarity > -2
    return marks & (similarity > -2)


def _window_edges(threshold: float):
    """Pairs of rows at most WINDOW apart in the order of a partition: links, and every row's best two."""

    def rows(batches):
        held_node, held_vector, held_table = np.zeros(0, np.int64), None, np.zeros(0, np.int32)
        for batch in batches:
            nodes, tables = batch.column("node").to_numpy(), batch.column("table").to_numpy()
            for at, vectors in _units(batch):
                node, table = nodes[at], tables[at]
                if held_vector is not None and held_vector.shape[1] == vectors.shape[1]:
                    node, table, vectors = np.append(held_node, node), np.append(held_table, table), np.concatenate([held_vector, vectors])
                for begin in range(0, len(node), 512):
                    end = min(begin + 512, len(node))
                    low = max(begin - WINDOW, 0)
                    similarity = vectors[begin:end] @ vectors[low:end].T
                    apart = np.arange(begin, end)[:, None] - np.arange(low, end)[None, :]
                    near = (apart > 0) & (apart <= WINDOW) & (table[begin:end, None] == table[None, low:end])
                    similarity[~near] = -9
                    i, j = np.nonzero(_best(similarity, threshold, 2))
                    yield _edges(node[begin + i], node[low + j], similarity[i, j])
                held_node, held_table, held_vector = node[-WINDOW:], table[-WINDOW:], vectors[-WINDOW:]

    return rows


def _met(threshold: float):
    """Around each center, compares all that meet there: links, and every member's best two."""

    def rows(batches):
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            center = table.column("center").to_numpy()
            last = int(np.searchsorted(center, center[-1])) if len(center) else 0
            yield from compare(table.slice(0, last).combine_chunks())
            held = table.slice(last)  # a center has a bounded number of rows
        if held is not None:
            yield from compare(held.combine_chunks())

    def compare(table: pa.Table):
        for batch in table.to_batches():
            center, node = batch.column("center").to_numpy(), batch.column("node").to_numpy()
            out = []
            for at, vectors in _units(batch):
                cut = np.append(np.flatnonzero(np.diff(center[at], prepend=center[at][0] - 1)), len(at))
                for begin, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    if end - begin > 1:
                        similarity = vectors[begin:end] @ vectors[begin:end].T
                        np.fill_diagonal(similarity, -9)
                        i, j = np.nonzero(_best(similarity, threshold, 2))
                        member = node[at[begin:end]]
                        out.append((member[i], member[j], similarity[i, j]))
            if out:
                yield _edges(*(np.concatenate([o[k] for o in out]) for k in range(3)))

    return rows


def _counts(threshold: float):
    """Of a pair of blocks of one component: how many vectors each member links with in the other block."""

    def counts(table: pa.Table) -> pa.Table:
        one, two = (table.column("block")[0].as_py()["low"], table.column("block")[0].as_py()["high"])
        out_node, out_n = [], []
        for batch in table.combine_chunks().to_batches():
            node, own, copies = (batch.column(c).to_numpy() for c in ("node", "own", "copies"))
            for at, vectors in _units(batch):
                x, y = np.flatnonzero(own[at] == one), np.flatnonzero(own[at] == two)
                linked = vectors[x] @ vectors[y].T >= threshold
                if one == two:
                    np.fill_diagonal(linked, False)
                else:
                    out_node.append(node[at[y]])
                    out_n.append(linked.T @ copies[at[x]])
                out_node.append(node[at[x]])
                out_n.append(linked @ copies[at[y]])
        return pa.table({"node": pa.array(np.concatenate(out_node), pa.int64()), "n": pa.array(np.concatenate(out_n), pa.int64())})

    return counts


def rounds_of_tables(nodes: int, threshold: float) -> int:
    """How many times TABLES projections so many nodes need: a pair at the threshold meets if it shares enough signs."""

    def miss(n: int) -> float:
        """The logarithm of the chance that one projection keeps a pair apart."""
        shared = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** max(0.0, math.log2(n / WINDOW))
        return math.log1p(-shared) if shared < 1 else -math.inf

    if nodes <= PROJECTED_NODES or miss(nodes) == -math.inf:
        return 1
    return max(1, math.ceil(miss(PROJECTED_NODES) / miss(nodes)))


class Descent:
    """The neighbour graph of some nodes, and the links found."""

    def __init__(self, nodes: DataFrame, threshold: float):
        self.nodes, self.threshold = nodes, threshold
        self.links: DataFrame | None = None
        self.graph: DataFrame | None = None
        self.audit: DataFrame | None = None

    def add(self, edges: DataFrame) -> None:
        """Takes in comparisons: the best of each node's list stay, and all links."""
        edges = saved(edges, "edges")
        links = edges.filter(F.col("similarity") >= self.threshold)
        links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")
        self.links = saved((links if self.links is None else self.links.union(links)).distinct(), "links")
        both = edges.union(edges.select("b", "a", "similarity"))
        both = (both if self.graph is None else both.union(self.graph)).filter("a != b").distinct()
        rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))
        self.graph = saved(both.withColumn("_rank", rank).filter(F.col("_rank") <= NEIGHBOURS).drop("_rank"), "graph")

    def project(self, seed: int) -> None:
        rows = self.nodes.mapInArrow(_projected(seed, TABLES), "table int, signature long, node long, unit array<double>")
        ordered = rows.repartitionByRange("table", "signature", "node").sortWithinPartitions("table", "signature", "node")
        self.add(ordered.mapInArrow(_window_edges(self.threshold), EDGES))

    def join(self) -> None:
        """One round of neighbours of neighbours."""
        forward = self.graph.select(F.col("a").alias("center"), F.col("b").alias("node"))
        # Those that have a node in their list, the nearest of them; the limit is applied before the shuffle too.
        rank = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("similarity"), "a"))
        back = self.graph.withColumn("_rank", rank).filter(F.col("_rank") <= NEIGHBOURS)
        back = back.select(F.col("b").alias("center"), F.col("a").alias("node"))
        own = self.nodes.select(F.col("node").alias("center"), "node")
        meeting = forward.union(back).union(own).distinct().join(self.nodes.select("node", "unit"), "node")
        ordered = meeting.repartition("center").sortWithinPartitions("center", "node")
        self.add(ordered.mapInArrow(_met(self.threshold), EDGES))

    def _drawn(self, first: int, n: int) -> DataFrame | None:
        """All links of n nodes from the first-th on in an order by hash, or None if there is no such node."""
        sample = self.nodes.orderBy(F.xxhash64("node"), "node").offset(first).limit(n).select("node", "unit").toArrow()
        if not sample.num_rows:
            return None
        known = [(sample.column("node").to_numpy()[rows], vectors) for rows, vectors in _units(sample.combine_chunks().to_batches()[0])]
        sent, threshold = self.nodes.sparkSession.sparkContext.broadcast(known), self.threshold

        def rows(batches):
            for batch in batches:
                node = batch.column("node").to_numpy()
                for at, vectors in _units(batch):
                    for ids, others in sent.value:
                        if others.shape[1] == vectors.shape[1]:
                            similarity = vectors @ others.T
                            i, j = np.nonzero(similarity >= threshold)
                            yield _edges(node[at[i]], ids[j], similarity[i, j])

        return saved(self.nodes.select("node", "unit").mapInArrow(rows, EDGES).filter("a != b"), "audit")

    def audited(self) -> DataFrame:
        """The links of as many nodes as have enough of them, or of all nodes."""
        parts, first, n = [], 0, 0
        for draw in range(DRAWS):
            found = self._drawn(first, AUDITED << draw)
            if found is None:
                break
            parts.append(found)
            first, n = first + (AUDITED << draw), n + found.count()
            if n >= AUDITED_LINKS:
                break
        else:
            if self.nodes.count() > first:
                warnings.warn(f"recall is judged by {n} links of {first} nodes only", stacklevel=2)
        out = self.nodes.sparkSession.createDataFrame([], EDGES)
        for part in parts:
            out = out.union(part)
        return out

    def recall(self, groups: DataFrame, seed: int) -> float:
        """Of the links of the audited nodes, the share whose ends were joined."""
        if self.audit is None:
            self.audit = self.audited()
        one, two = groups.toDF("a", "group_a"), groups.toDF("b", "group_b")
        judged = self.audit.join(one, "a", "left").join(two, "b", "left")
        n, found = judged.agg(F.count("*"), F.count_if(F.col("group_a") == F.col("group_b"))).first()
        return found / n if n else 1.0


def _enlarged(nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(node, n): how many vectors each node of a component links with, all its members compared in blocks."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    sizes = saved(sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")), "sizes")
    placed = groups.join(sizes, "component").join(nodes, "node")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = placed.withColumn("other", other).withColumn(
        "block", F.struct(F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    found = rows.select("component", "block", "node", "own", "copies", "unit").groupBy("component", "block")
    return found.applyInArrow(_counts(threshold), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def embedding_links(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector: vec_id, n_links, component_id (smallest id reachable by links, itself included), kept."""
    vectors = vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    whole = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    vectors = vectors.withColumn("norm", F.when(whole, norm))
    usable = (F.col("norm") > 0) & (F.col("norm") < float("inf"))
    unit = F.when(usable, F.transform("v", lambda x: x / F.col("norm")))
    vectors = vectors.select("vec_id", unit.alias("unit")).withColumn("digest", F.unhex(F.sha2(F.to_json(F.struct("unit")), 256)))
    # Equal vectors: one node with the smallest id, and how many there are.
    nodes = vectors.filter("unit IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.any_value("unit").alias("unit")
    )
    nodes = saved(nodes, "nodes")
    named = saved(nodes.select("digest", "node", "copies"), "names")
    members = vectors.withColumn("valid", F.col("unit").isNotNull()).drop("unit").join(named, "digest", "left")
    members = members.select("vec_id", F.when(F.col("valid"), F.col("node")).alias("node"), F.when(F.col("valid"), F.col("copies")).alias("copies"))
    members = saved(members, "members")
    # A repeated id may stand for different vectors; these are one node then, and the first of them is compared.
    nodes = saved(nodes.groupBy("node").agg(F.max_by("copies", "digest").alias("copies"), F.max_by("unit", "digest").alias("unit")), "nodes")

    descent = Descent(nodes, threshold)
    tables = rounds_of_tables(nodes.count(), threshold)
    attempt, best, futile = 0, -1.0, 0
    while True:
        for seed in range(attempt * tables, (attempt + 1) * tables):
            descent.project(seed)
        for _ in range(JOINS if attempt == 0 else 1):
            descent.join()
        groups = saved(components(descent.links), "groups")
        recall = descent.recall(groups, attempt)
        if recall >= RECALL:
            break
        best, futile = max(best, recall), 0 if recall > best else futile + 1
        if futile == ATTEMPTS:
            raise RuntimeError(f"recall stays at {best:.4f}, below {RECALL}, after {(attempt + 1) * tables * TABLES} projections")
        attempt += 1
    counts = small(saved(_enlarged(nodes, groups, threshold), "counts"))
    out = members.join(small(groups), "node", "left").join(counts, "node", "left")
    linked = F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    component = F.coalesce("component", "node", "vec_id")
    shown = [F.when(c != NO_ID, c).alias(n) for c, n in ((F.col("vec_id"), "vec_id"), (component, "component_id"))]
    return out.select(shown[0], linked.cast("long").alias("n_links"), shown[1], (F.col("vec_id") == component).alias("kept"))
