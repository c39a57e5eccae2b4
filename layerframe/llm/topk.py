"""Exact top-k by inner product over KD-trees, one per shard.

A top tree of median splits, made from a bounded sample, deals the distinct vectors out
to shards of like rows.  The best k of the same sample give each query a first kth
score; it goes only to shards whose tight box can still reach that.  Within a shard a
KD-tree of median splits with tight boxes is walked best bound first until no bound
reaches the kth score, which rises as leaves are scored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerframe.llm import text
from layerframe.llm.vectors import distinct_vectors, finite, leading, matrix
from layerframe.plans.scratch import cut_lineage

SAMPLE = 4096  # distinct vectors that place the top tree's splits and the first kth scores
SHARD_ROWS = 16_384
FEWEST_SHARDS, MOST_SHARDS = 32, 2048
QUERIES_AT_ONCE = 8192  # of one shard's task
LEAF = 128
_EXACT = float(1 << 53)


def quantized(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


# --- the tree -------------------------------------------------------------------------


def median_tree(x: np.ndarray, leaf: int, levels: int = 64) -> list[tuple[np.ndarray, int, float, int, int]]:
    """Nodes (rows, dimension, threshold, left, right); rows at most at the threshold go left.

    Splits the widest dimension at its median; a node whose rows are all equal stays a leaf.
    """
    nodes = [(np.arange(len(x)), -1, 0.0, -1, -1)]
    at = 0
    depth = [0]
    while at < len(nodes):
        rows = nodes[at][0]
        if len(rows) > leaf and depth[at] < levels:
            part = x[rows]
            low, high = part.min(0), part.max(0)
            k = int((high - low).argmax())
            if high[k] > low[k]:
                cut = float(np.median(part[:, k]))
                if cut >= high[k]:
                    cut = float(part[part[:, k] < high[k], k].max())
                left = part[:, k] <= cut
                nodes[at] = (rows, k, cut, len(nodes), len(nodes) + 1)
                nodes += [(rows[left], -1, 0.0, -1, -1), (rows[~left], -1, 0.0, -1, -1)]
                depth += [depth[at] + 1] * 2
        at += 1
    return nodes


def leaf_of(nodes: list[tuple[int, float, int, int]], x: np.ndarray) -> np.ndarray:
    """The node at which each row ends."""
    at = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        k, cut, left, right = nodes[node]
        if k < 0 or not len(rows):
            at[rows] = node
            continue
        low = x[rows, k] <= cut
        todo += [(left, rows[low]), (right, rows[~low])]
    return at


def upper_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest inner product of each query with any point of each box."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def slack(dim: int, largest: np.ndarray | float, other: np.ndarray | float) -> np.ndarray:
    """How far an inner product in doubles may be off, by the largest components of both sides.

    Nothing while every sum of such whole numbers is itself exact.
    """
    size = dim * np.multiply(largest, other, dtype=np.float64)
    return np.where(size < _EXACT, 0.0, size * (dim + 4) * 2.0**-52)


class ShardTree:
    def __init__(self, whole: np.ndarray, ids: list[list[int]]):
        self.whole, self.ids = whole, ids
        self.x = whole.astype(np.float64)
        self.first = np.array([i[0] for i in ids], np.int64)
        self.nodes = median_tree(self.x, LEAF)
        self.low = np.stack([self.x[n[0]].min(0) for n in self.nodes])
        self.high = np.stack([self.x[n[0]].max(0) for n in self.nodes])
        self.largest = np.maximum(np.abs(self.low), np.abs(self.high)).max(1)

    def best(self, whole: np.ndarray, own: int, k: int, kth: float) -> list[tuple[int, int]]:
        """(score, id) of the best k rows but ``own``, if they reach ``kth``; ties to smaller ids.

        Where components are too large for exact doubles, bounds are widened by what rounding
        may take away, and the rows of a leaf that can still reach ``kth`` are scored anew in
        whole numbers.
        """
        q = whole.astype(np.float64)
        off = slack(self.x.shape[1], self.largest, np.abs(q).max())
        bounds = (upper_bounds(q[None], self.low, self.high)[0] + off).tolist()
        best: list[tuple[int, int]] = []
        heap = [(-bounds[0], 0)]
        while heap and -heap[0][0] >= kth:
            _, n = heapq.heappop(heap)
            rows, dim, _, left, right = self.nodes[n]
            if dim >= 0:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            scores = self.x[rows] @ q
            reach = scores + off[n] >= np.nextafter(float(kth), -np.inf)
            rows, scores = rows[reach], scores[reach]
            first = self.first[rows]
            if off[n]:
                by = whole.tolist()
                scores = [sum(a * b for a, b in zip(x, by)) for x in self.whole[rows].tolist()]
                order = sorted(range(len(rows)), key=lambda i: (-scores[i], first[i]))
            else:
                order = np.lexsort((first, -scores))
            for i in leading(order, first, own, k):
                best += [(-int(scores[i]), id_) for id_ in self.ids[rows[i]] if id_ != own]
            best = sorted(set(best))[:k]
            if len(best) == k:
                kth = max(kth, -best[-1][0])
        return [(max(-(1 << 63), min((1 << 63) - 1, -s)), i) for s, i in best]


# --- the search -----------------------------------------------------------------------


def top_k(rows: DataFrame, queries: Column, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) over rows (id, vec) of whole numbers.

    ``queries`` marks the rows that are queries.  Each is searched against every row but
    those of its own id.  Rows with a null id take no part; a shorter vector is continued
    with zeros; components may be of any size, scores beyond 64 bits are held to them; of rows that repeat an id with the same vector, or with the same score, one
    counts.  An empty table has no results.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col("id").isNotNull())
    points = cut_lineage(distinct_vectors(rows, k + 1), "topk-vectors")
    n, dim = points.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = points.select("vec", F.element_at("ids", 1).alias("first"), F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(SAMPLE).drop("h").toArrow()
    seeds = matrix(sample.column("vec").combine_chunks(), dim, np.float64)
    # one vector of an id, so that the k best of them are k results
    seed_ids, one = np.unique(sample.column("first").to_numpy(), return_index=True)
    shards = int(min(MOST_SHARDS, max(FEWEST_SHARDS, n // shard_rows)))
    top = [node[1:] for node in median_tree(seeds, max(1, len(seeds) // shards), int(np.ceil(np.log2(shards))))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = leaf_of(top, matrix(batch.column("vec"), dim, np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], ["vec", "ids", "leaf"])

    placed = points.mapInArrow(place, "vec array<bigint>, ids array<bigint>, leaf int")
    # one row per leaf of the top tree
    filled = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    parts = {leaf: -(-c // (2 * max(shard_rows, n // shards))) for leaf, c in filled.items()}
    split = F.create_map(*(F.lit(v) for item in parts.items() for v in item))
    placed = placed.withColumn("shard", F.concat_ws("-", "leaf", F.pmod(F.xxhash64("vec"), F.element_at(split, F.col("leaf")))))

    boxes = _boxes(placed, dim)
    names = list(boxes)
    low, high = (np.stack([boxes[s][i] for s in names]) for i in (0, 1))
    widest = np.maximum(np.abs(low), np.abs(high)).max(1)
    seed_largest = np.abs(seeds[one]).max(1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix(batch.column("vec"), dim, np.float64)
            kth = np.full(len(q), -np.inf)
            mine = np.abs(q).max(1, keepdims=True)
            if len(one) > k:
                scores = q @ seeds[one].T - slack(dim, seed_largest, mine)
                # nothing but the query itself may stand behind a row that its id comes first in
                scores[batch.column("id").to_numpy()[:, None] == seed_ids] = -np.inf
                kth = np.partition(scores, -k, 1)[:, -k]
            reach = upper_bounds(q, low, high) + slack(dim, widest, mine) >= kth[:, None]
            at, shard = np.nonzero(reach)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [taken.column("id"), taken.column("vec"), pa.array(kth[at]), pa.array([names[s] for s in shard], pa.string())],
                ["query_id", "query", "kth", "shard"],
            )

    asked = rows.where(queries).select("id", "vec").distinct()
    chunks = max(1, -(-asked.count() // QUERIES_AT_ONCE))
    routed = asked.mapInArrow(route, "query_id bigint, query array<bigint>, kth double, shard string")
    routed = routed.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks).cast("bigint")))
    dealt = placed.select("shard", "vec", "ids", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))).alias("chunk"))

    def search(points: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if points.num_rows and asked.num_rows:
            tree = ShardTree(matrix(points.column("vec").combine_chunks(), dim, np.int64), [sorted(i) for i in points.column("ids").to_pylist()])
            q = matrix(asked.column("query").combine_chunks(), dim, np.int64)
            for i, (id_, kth) in enumerate(zip(asked.column("query_id").to_pylist(), asked.column("kth").to_pylist())):
                got = tree.best(q[i], id_, k, kth)
                found += [(id_, vec_id, score) for score, vec_id in got]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("query_id", "vec_id", "score"), columns)})

    keys = ["shard", "chunk"]
    found = dealt.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _boxes(placed: DataFrame, dim: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Tight box of every shard; at most about ``2 * MOST_SHARDS`` rows reach the driver."""

    def reduced(table: pa.Table) -> pa.Table:
        vec = matrix(table.column("vec").combine_chunks(), dim, np.float64)
        low, high = vec.min(0), vec.max(0)
        return pa.table({"shard": table.column("shard").slice(0, 1), "low": pa.array([low]), "high": pa.array([high])})

    rows = placed.groupBy("shard").applyInArrow(reduced, "shard string, low array<double>, high array<double>").toPandas()
    return {s: (np.array(low), np.array(high)) for s, low, high in zip(rows["shard"], rows["low"], rows["high"])}


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    rows = rows.select(F.col("vec_id").alias("id"), quantized(F.col("embedding")).alias("vec"))
    return top_k(rows, F.col("id") % 50 == 0)


OP4_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id AS id, list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT DISTINCT q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON c.id <> q.id WHERE q.id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
