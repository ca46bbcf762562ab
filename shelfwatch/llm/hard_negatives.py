"""Hard negatives for contrastive training, by the threshold algorithm over sorted lists.

Anchors meet all rows in blocks: a task holds one block of rows and one group of anchors, both of bounded size. Within
a block every dimension has its rows in order. An anchor reads these lists side by side, from the top where its own
component is positive and from the bottom where it is negative; every row reached is scored in whole numbers. What no
list has shown yet cannot score above the threshold, the sum of the anchor's components times the values the lists have
come to, so reading ends once the threshold is strictly below the last score each window still needs (ties go to the
smaller id, hence strictly). A first pass over the rows of the anchor's own label finds its positives, a second one
over all rows the negatives in the score window of each positive. The best of each block are merged by rank, after a
limit inside every task, so a label with a third of all rows is only more blocks.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no part. Components
become floor(scale * x), held to the size at which a score still fits a long. A vector of fewer components counts as
filled up with zeros, an empty one scores zero. Rows equal in id, label and vector are one row; rows that share an id
only are rows of their own, and each can be an anchor. Anchors without positives, and positives without negatives in
their window, give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.tables import saved, small

BLOCK_ROWS = 16_384
GROUP_ANCHORS = 1_024
# Places read from every list before the threshold is first compared.
FIRST_DEPTH = 32
LONG_MAX = 2**63 - 1
EXACT_DOUBLE = 2**53


# ---- sorted lists -------------------------------------------------------------------------------------------------


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A list column as rows of equal length, short ones filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _width(q: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(q, ((0, 0), (0, dims - q.shape[1])))


class SortedLists:
    """The rows of a block, in ascending order per dimension."""

    def __init__(self, q: np.ndarray, largest: int):
        self.q = q
        self.order = np.argsort(q, axis=0, kind="stable")
        # Sums of whole numbers are exact in doubles up to 2**53, and much faster.
        bound = int(np.abs(q).max(initial=0)) * largest * max(1, q.shape[1])
        self.scored = q.astype(np.float64) if bound < EXACT_DOUBLE else q

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Rows newly reached, their scores, and the most an unseen row can score (None when all are seen)."""
        n = len(self.q)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        weights = anchor.astype(self.scored.dtype)
        unseen = np.ones(n, bool)
        nothing = np.zeros(0, np.int64)
        if n and len(up) + len(down):
            yield nothing, nothing, self._threshold(anchor, up, down, 1)
        depth = 0
        while depth < n:
            deeper = min(n, max(FIRST_DEPTH, 2 * depth)) if len(up) + len(down) else n
            hit = np.zeros(n, bool)
            hit[self.order[n - deeper : n - depth, up]] = True
            hit[self.order[depth:deeper, down]] = True
            if deeper == n:
                hit[:] = True
            rows = np.flatnonzero(hit & unseen)
            unseen[rows] = False
            depth = deeper if unseen.any() else n
            scores = (self.scored[rows] @ weights).astype(np.int64)
            yield rows, scores, None if depth == n else self._threshold(anchor, up, down, depth)

    def _threshold(self, anchor, up, down, depth: int) -> int:
        top = self.q[self.order[len(self.q) - depth, up], up]
        low = self.q[self.order[depth - 1, down], down]
        return int((anchor[up] * top).sum() + (anchor[down] * low).sum())


class Best:
    """The first `k` rows by score from above, ties by id and key, whose score lies in a window."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.rows, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def take(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        if self.low is not None:
            inside = (scores >= self.low) & (scores <= self.high)
            rows, scores = rows[inside], scores[inside]
        if len(self.rows) == self.k:
            near = scores >= self.scores[-1]
            rows, scores = rows[near], scores[near]
        if len(rows):
            rows, scores = np.concatenate([self.rows, rows]), np.concatenate([self.scores, scores])
            first = np.lexsort((keys[rows], ids[rows], -scores))[: self.k]
            self.rows, self.scores = rows[first], scores[first]

    def settled(self, threshold: int | None) -> bool:
        """Whether no unseen row can come in."""
        if threshold is None or (self.low is not None and (self.low > self.high or threshold < self.low)):
            return True
        return len(self.rows) == self.k and threshold < self.scores[-1]


# ---- tasks --------------------------------------------------------------------------------------------------------

PAIRS = "anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long"
TRIPLES = PAIRS + ", negative_id long, negative_key long, negative_score long"


def _block(rows: pa.Table, anchors: pa.Table):
    q, a = matrix(rows.column("q")), matrix(anchors.column("q"))
    dims = max(q.shape[1], a.shape[1])
    q, a = _width(q, dims), _width(a, dims)
    ids, keys = (rows.column(c).to_numpy() for c in ("id", "key"))
    return SortedLists(q, int(np.abs(a).max(initial=0))), a, ids, keys


def _out(schema: str, parts: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = zip(*parts) if parts else [[np.zeros(0, np.int64)]] * len(names)
    return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in columns], names)


def _positives(k: int):
    def best(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        parts = []
        if rows.num_rows and anchors.num_rows:
            lists, a, ids, keys = _block(rows, anchors)
            for i, (anchor_id, anchor_key) in enumerate(zip(anchors.column("id").to_pylist(), anchors.column("key").to_pylist())):
                found = Best(k)
                for at, scores, threshold in lists.walk(a[i]):
                    other = (ids[at] != anchor_id) | (keys[at] != anchor_key)
                    found.take(at[other], scores[other], ids, keys)
                    if found.settled(threshold):
                        break
                same = np.ones(len(found.rows), np.int64)
                parts.append((same * anchor_id, same * anchor_key, ids[found.rows], keys[found.rows], found.scores))
        return _out(PAIRS, parts)

    return best


def _negatives(k: int, low: int, high: int):
    def best(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        parts = []
        if rows.num_rows and anchors.num_rows:
            lists, a, ids, keys = _block(rows, anchors)
            labels = rows.column("label").to_numpy()
            for i, anchor in enumerate(anchors.drop_columns(["q"]).to_pylist()):
                positives = anchor["positives"]
                # low * positive <= 100 * negative <= high * positive, in whole numbers of any size
                windows = [Best(k, -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in positives]
                for at, scores, threshold in lists.walk(a[i]):
                    other = labels[at] != anchor["label"]
                    for w in windows:
                        w.take(at[other], scores[other], ids, keys)
                    if all(w.settled(threshold) for w in windows):
                        break
                for p, w in zip(positives, windows):
                    same = np.ones(len(w.rows), np.int64)
                    known = (anchor["id"], anchor["key"], p["positive_id"], p["positive_key"], p["positive_score"])
                    parts.append((*(same * x for x in known), ids[w.rows], keys[w.rows], w.scores))
        return _out(TRIPLES, parts)

    return best


def _meet(rows: DataFrame, anchors: DataFrame, cell: Column, function, schema: str) -> DataFrame:
    """Every block of rows with every group of anchors of the same cell, each in one task of bounded size."""
    rows, anchors = rows.withColumn("cell", cell), anchors.withColumn("cell", cell)
    blocks = rows.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    groups = anchors.groupBy("cell").agg(F.ceil(F.count("*") / GROUP_ANCHORS).alias("groups"))
    sizes = small(saved(blocks.join(groups, "cell"), "negatives-cells"))
    spread = lambda n: F.pmod(F.xxhash64("id", "key"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rows = rows.join(sizes, "cell").withColumn("block", spread("blocks")).withColumn("group", every("groups"))
    anchors = anchors.join(sizes, "cell").withColumn("group", spread("groups")).withColumn("block", every("blocks"))
    keys = ["cell", "block", "group"]
    drop = ["blocks", "groups"]
    return rows.drop(*drop).groupBy(keys).cogroup(anchors.drop(*drop).groupBy(keys)).applyInArrow(function, schema)


def _ranked(found: DataFrame, by: list[str], kind: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc(f"{kind}_score"), f"{kind}_id", f"{kind}_key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# ---- operator -----------------------------------------------------------------------------------------------------


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component."""
    most = F.floor(F.sqrt(F.lit(float(LONG_MAX)) / F.greatest(F.size(vector), F.lit(1))))
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), most), -most))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` says, over the column `id`, which rows are anchors. A negative has another label than its anchor, and a
    score of `low` to `high` per cent of the positive's.
    """
    valid = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col)))
    rows = valid.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        whole_numbers(F.col(vector_col), scale).alias("q"),
    )
    rows = rows.withColumn("key", F.xxhash64("label", "q"))
    rows = saved(rows.dropDuplicates(["id", "label", "q"]), "negatives-rows")
    anchors = saved(rows.filter(anchor), "negatives-queries")

    pairs = _ranked(_meet(rows, anchors, F.col("label"), _positives(positives), PAIRS), ["anchor_id", "anchor_key"], "positive", positives)
    known = F.struct("positive_id", "positive_key", "positive_score")
    pairs = saved(pairs.groupBy("anchor_id", "anchor_key").agg(F.collect_list(known).alias("positives")), "negatives-pairs")
    pairs = pairs.withColumnsRenamed({"anchor_id": "id", "anchor_key": "key"})
    anchors = anchors.join(pairs, ["id", "key"]).select("id", "key", "label", "q", "positives")

    found = _meet(rows, saved(anchors, "negatives-anchors"), F.lit(0), _negatives(negatives, low, high), TRIPLES)
    found = _ranked(found, ["anchor_id", "anchor_key", "positive_id", "positive_key"], "negative", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH valid AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, a.q AS anchor_q, c.vec_id AS other_id, c.label AS other_label,
    c.q AS other_q, coalesce(list_sum(list_transform(list_zip(a.q, c.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM valid a, valid c
  WHERE a.vec_id % 50 = 0 AND (a.vec_id, a.label, a.q) <> (c.vec_id, c.label, c.q)
), positives AS (
  SELECT * FROM scored WHERE anchor_label = other_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor_label, anchor_q ORDER BY score DESC, other_id, other_q) <= 5
), found AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (
      PARTITION BY p.anchor_id, p.anchor_label, p.anchor_q, p.other_id, p.other_q ORDER BY n.score DESC, n.other_id, n.other_q
    )::INTEGER AS rank
  FROM positives p JOIN scored n
    ON n.anchor_id = p.anchor_id AND n.anchor_label = p.anchor_label AND n.anchor_q = p.anchor_q AND n.other_label <> p.anchor_label
  WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
"""
