"""Approximate nearest neighbours by cosine: a forest of random-projection trees.

The trees are fitted on a bounded sample; every vector is indexed, in one leaf of each
tree.  A query walks all trees through one shared priority queue, nearest margin first,
until it has gathered its leaves; the rows in them are then ranked by exact cosine.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerframe.llm import text
from layerframe.llm.vectors import distinct_vectors, finite, leading, matrix
from layerframe.plans.scratch import cut_lineage

SAMPLE = 16_384  # distinct vectors that the trees are fitted on
TREES = 4
LEAF_ROWS = 2048  # aimed at; at least FEWEST and at most MOST leaves a tree
FEWEST_LEAVES, MOST_LEAVES = 32, 1024
PROBED = 0.4  # share of all leaves of the forest that a query looks into, at any size
FEWEST_RANKED = 64  # vectors of each tree that a query ranks, at least
GROUP_QUERIES = 8192  # of one task's group


@dataclass
class Tree:
    """Node i sends x right where ``x @ normal[i] > cut[i]``; a leaf has a number instead of children."""

    normal: np.ndarray
    cut: np.ndarray
    children: np.ndarray
    leaf: np.ndarray


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_tree(x: np.ndarray, leaves: int, random: np.random.Generator) -> Tree:
    """Splits between two random rows' directions at the median projection, breadth first."""
    normal, cut, children, leaf = [], [], [], []
    todo = [(np.arange(len(x)), leaves)]
    at = n_leaf = 0
    while at < len(todo):
        rows, share = todo[at]
        side = None
        if share > 1 and len(rows) > 1:
            a, b = x[random.choice(rows, 2, replace=False)]
            direction = (a - b) / max(float(np.linalg.norm(a - b)), 1e-12)
            along = x[rows] @ direction
            middle = float(np.median(along))
            side = along > middle
        if side is None or not side.any():
            normal.append(np.zeros(x.shape[1]))
            cut.append(0.0)
            children.append((-1, -1))
            leaf.append(n_leaf)
            n_leaf += 1
        else:
            normal.append(direction)
            cut.append(middle)
            children.append((len(todo), len(todo) + 1))
            leaf.append(-1)
            todo += [(rows[~side], share // 2), (rows[side], share - share // 2)]
        at += 1
    return Tree(np.array(normal), np.array(cut), np.array(children), np.array(leaf))


def fit_forest(x: np.ndarray, leaves: int, trees: int = TREES, seed: int = 7) -> list[Tree]:
    random = np.random.default_rng(seed)
    return [fit_tree(x, leaves, random) for _ in range(trees)]


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(tree.leaf[at] < 0)
        if not len(inner):
            return tree.leaf[at]
        n = at[inner]
        right = np.einsum("ij,ij->i", x[inner], tree.normal[n]) > tree.cut[n]
        at[inner] = tree.children[n, right.astype(int)]


def probes(forest: list[Tree], q: np.ndarray, wanted: int, filled: dict[tuple[int, int], int], enough: int) -> list[tuple[int, int]]:
    """The (tree, leaf) that one queue over all trees gives first, nearest margin first.

    At least ``wanted`` leaves with rows, and more while they hold fewer than ``enough`` rows.

    A node's priority is the smallest margin on the way to it: how far inside it the
    query lies, or how far outside where negative.
    """
    margins = [tree.normal @ q - tree.cut for tree in forest]
    heap = [(-np.inf, t, 0) for t in range(len(forest))]
    found, ranked = [], 0
    while heap and (len(found) < wanted or ranked < enough):
        away, t, n = heapq.heappop(heap)
        tree = forest[t]
        if tree.leaf[n] >= 0:
            leaf = int(tree.leaf[n])
            held = filled.get((t, leaf), 0)
            if held:
                found.append((t, leaf))
                ranked += held
            continue
        left, right = tree.children[n]
        m = margins[t][n]
        heapq.heappush(heap, (max(away, m), t, left))
        heapq.heappush(heap, (max(away, -m), t, right))
    return found


def nearest(rows: DataFrame, queries: Column, k: int = 5, trees: int = TREES, probed: float = PROBED, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) over rows (id, vec); score is the exact cosine in doubles.

    ``queries`` marks the rows that are queries; a query's own id is no candidate.  Null
    ids and zero vectors take no part; a shorter vector is continued with zeros; an id with
    several vectors counts once, by its nearest.  An empty table has no results.
    A query looks into the same share of the filled leaves whatever the number of vectors,
    and goes on while those hold fewer than ``FEWEST_RANKED`` vectors a tree, so that small
    tables give all k results.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col("id").isNotNull() & F.exists("vec", lambda x: x != 0))
    points = cut_lineage(distinct_vectors(rows, k + 1), "forest-vectors")
    n, dim = points.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = points.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(SAMPLE).select("vec").toArrow()
    fitted = unit(matrix(sample.column("vec").combine_chunks(), dim, np.float64))
    leaves = int(min(MOST_LEAVES, max(FEWEST_LEAVES, n // leaf_rows)))
    forest = [vars(t) for t in fit_forest(fitted, leaves, trees)]
    shared = spark.sparkContext.broadcast(forest)  # at most trees * 2 * MOST_LEAVES nodes
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = [Tree(**t) for t in shared.value]
        for batch in batches:
            x = unit(matrix(batch.column("vec"), dim, np.float64))
            for t, tree in enumerate(forest):
                leaf = leaf_of(tree, x)
                number = np.full(len(x), t, np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(leaf.astype(np.int32))], ["vec", "ids", "tree", "leaf"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = [Tree(**t) for t in shared.value]
        for batch in batches:
            x = unit(matrix(batch.column("vec"), dim, np.float64))
            found = [(i, t, leaf) for i, q in enumerate(x) for t, leaf in probes(forest, q, wanted, rows_of, trees * FEWEST_RANKED)]
            at, tree, leaf = (np.array(c, np.int32) for c in zip(*found)) if found else (np.zeros(0, np.int32),) * 3
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(tree), pa.array(leaf)], ["query_id", "query", "tree", "leaf"])

    kind = rows.schema["vec"].dataType.simpleString()
    indexed = points.mapInArrow(index, f"vec {kind}, ids array<bigint>, tree int, leaf int")
    # one row per leaf; a leaf that holds far more than its share is cut by hash
    filled = indexed.groupBy("tree", "leaf").count().collect()
    rows_of = {(r["tree"], r["leaf"]): r["count"] for r in filled}
    wanted = int(np.ceil(len(rows_of) * probed))
    most = 2 * max(leaf_rows, -(-n // leaves))
    parts = {f"{r['tree']}-{r['leaf']}": -(-r["count"] // most) for r in filled}
    cut = F.element_at(F.create_map(*(F.lit(v) for item in parts.items() for v in item)), F.concat_ws("-", "tree", "leaf"))
    chunks = max(1, int(rows.where(queries).count() * wanted / (trees * leaves) / GROUP_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1))
    placed = indexed.withColumn("part", F.pmod(F.xxhash64("vec"), cut.cast("bigint"))).withColumn("chunk", every(F.lit(chunks)))
    asked = rows.where(queries).select("id", "vec").distinct()
    asked = asked.mapInArrow(ask, f"query_id bigint, query {kind}, tree int, leaf int")
    # a leaf without rows has no parts, and its probes end here
    asked = asked.withColumn("part", every(F.coalesce(cut, F.lit(1)))).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks).cast("bigint")))

    def rank(points: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if points.num_rows and asked.num_rows:
            x = matrix(points.column("vec").combine_chunks(), dim, np.float64)
            q = matrix(asked.column("query").combine_chunks(), dim, np.float64)
            ids = [sorted(i) for i in points.column("ids").to_pylist()]
            first = np.array([i[0] for i in ids], np.int64)
            by_id = np.argsort(first, kind="stable")
            x, ids, first = x[by_id], [ids[i] for i in by_id], first[by_id]
            leads, starts = np.unique(first, return_index=True)
            names = asked.column("query_id").to_pylist()
            unit_x, unit_q = unit(x), unit(q)
            for low in range(0, len(q), 256):
                near = unit_q[low : low + 256] @ unit_x.T
                for i, row in enumerate(near, low):
                    # the score itself decides, so whatever is within rounding of the kth goes on
                    top = row[leads != names[i]] if len(leads) == len(row) else np.maximum.reduceat(row, starts)[leads != names[i]]
                    kth = np.partition(top, -k)[-k] if len(top) > k else -np.inf
                    close = np.flatnonzero(row >= kth - 1e-12)
                    score = cosine(q[i], x[close])
                    best = leading(np.lexsort((first[close], -score)), first[close], names[i], k)
                    pairs = sorted((-score[b], id_) for b in best for id_ in ids[close[b]] if id_ != names[i])
                    nearest_of = {}
                    for away, id_ in pairs:
                        nearest_of.setdefault(id_, away)
                    found += [(names[i], id_, -away) for id_, away in list(nearest_of.items())[:k]]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    keys = ["tree", "leaf", "part", "chunk"]
    found = placed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(rank, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact cosines, the same for a pair however many others are computed beside it."""
    q, x = q / np.abs(q).max(), x / np.abs(x).max(1, keepdims=True)
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


def op5_random_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")))
    rows = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return nearest(rows, F.col("id") % 50 == 0)
