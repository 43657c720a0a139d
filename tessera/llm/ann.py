"""Nearest neighbours by a forest of random-projection trees.

Equal vectors are one class. The trees are built on a bounded sample and split
the classes of all rows into leaves. A query walks all trees with one priority
queue of the branches not taken, ordered by their distance to the query, until
it has visited its share of leaves. The candidates of those leaves are reranked
by exact inner product.

The forest does not save products: a shard scores all its rows against all queries of
a block, and rows outside the visited leaves are masked afterwards. It decides which
rows count, not what is paid.

Reranking is dealt by (block of queries, shard of candidates). A task holds one
block's queries and the best of each so far, and streams the shard past them, so
its memory does not depend on the size of a leaf, and each shard hands on only
``k + 1`` rows per query, however many leaves were visited.

Vectors get a further component that makes their lengths equal, so the largest
inner product is the smallest angle and the trees also fit vectors of unequal
length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, prepare, threshold_sample


@dataclass(frozen=True)
class Settings:
    trees: int = 2
    #: Vectors that a leaf should hold, and about how many leaves a tree may have (larger leaves beyond that).
    leaf: int = 512
    leaves: int = 128
    #: Share of the leaves of the whole forest that a query visits.
    probe: float = 0.5
    #: About so many vectors build the trees; the bound of what the driver holds.
    sample: int = 20_000
    #: Shards of the candidates, and how many queries a block should hold.
    shards: int = 16
    block: int = 8_192
    seed: int = 42


@dataclass(frozen=True)
class Tree:
    """Nodes: direction, threshold, children; a leaf has its number as children."""

    directions: np.ndarray
    thresholds: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int


def build_tree(x: np.ndarray, scale: float, leaf: int, rng: np.random.Generator) -> Tree:
    """Splits at the median along the difference of two means of random halves.

    ``scale``: how many vectors one of ``x`` stands for.
    """
    dims, cuts, left, right = [], [], [], []
    leaves, todo = 0, [(None, 0, x)]
    while todo:
        parent, side, part = todo.pop()
        direction = None
        if len(part) > 8 and len(part) * scale > leaf:
            direction = rng.standard_normal(x.shape[1])
            seen = part @ direction
            cut = float(np.median(seen))
            if not ((seen < cut).any() and (seen >= cut).any()):
                direction = None
        me = -leaves - 1 if direction is None else len(dims)
        if parent is not None:
            (left, right)[side][parent] = me
        if direction is None:
            leaves += 1
            continue
        dims.append(direction / np.linalg.norm(direction))
        cuts.append(cut / np.linalg.norm(direction))
        left.append(0)
        right.append(0)
        todo += [(me, 0, part[seen < cut]), (me, 1, part[seen >= cut])]
    return Tree(np.array(dims).reshape(-1, x.shape[1]), np.array(cuts), np.array(left, int), np.array(right, int), leaves)


def home(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row of ``x``."""
    at = np.full(len(x), 0 if len(tree.left) else -1)
    while (open_ := np.flatnonzero(at >= 0)).size:
        k = at[open_]
        near = np.einsum("ij,ij->i", x[open_], tree.directions[k]) < tree.thresholds[k]
        at[open_] = np.where(near, tree.left[k], tree.right[k])
    return -at - 1


def visit(forest: list[Tree], q: np.ndarray, share: float) -> list[tuple[int, int]]:
    """(tree, leaf) of the leaves nearest to ``q``, from one queue for all trees."""
    margins = [t.directions @ q - t.thresholds for t in forest]
    want = max(len(forest), int(np.ceil(share * sum(t.leaves for t in forest))))
    queue = [(0.0, t, 0 if len(forest[t].left) else -1) for t in range(len(forest))]
    heapq.heapify(queue)
    found = []
    while queue and len(found) < want:
        gap, t, node = heapq.heappop(queue)
        while node >= 0:
            m = float(margins[t][node])
            near, far = (forest[t].left, forest[t].right) if m < 0 else (forest[t].right, forest[t].left)
            heapq.heappush(queue, (gap + m * m, t, int(far[node])))
            node = int(near[node])
        found.append((t, -node - 1))
    return found


def _valid(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def _matrix(col: pa.Array) -> np.ndarray:
    values = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


class Best:
    """The ``k`` best candidates so far of each query of one block.

    Candidates must be offered by ascending id: of equal scores the earlier stay.
    """

    TILE = 1_024
    PENDING = 1 << 16

    def __init__(self, k: int, leaves: int):
        self.k, self.leaves = k, leaves
        self.asked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.x = None
        self.pending, self.waiting = [], 0

    def ask(self, ids: np.ndarray, x: np.ndarray, visited: pa.Array) -> None:
        marks = np.zeros((len(x), self.leaves), bool)
        counts = np.diff(visited.offsets.to_numpy())
        marks[np.repeat(np.arange(len(x)), counts), visited.flatten().to_numpy()] = True
        self.asked.append((ids, x, marks))

    def offer(self, ids: np.ndarray, y: np.ndarray, homes: np.ndarray) -> None:
        """``homes``: per candidate its leaf in each tree."""
        if self.x is None:
            if not self.asked:
                return
            self.ids, self.x, self.marks = (np.concatenate(c) for c in zip(*self.asked))
            self.floor = np.full(len(self.x), -np.inf)
            self.kept = (np.empty(0, int), np.empty(0), ids[:0])
        for i in range(0, len(self.x), self.TILE):
            some = slice(i, i + self.TILE)
            near = self.x[some] @ y.T
            seen = self.marks[some][:, homes].any(axis=2)
            ask, at = np.nonzero(seen & (near > self.floor[some, None]))
            self.pending.append((ask + i, near[ask, at], ids[at]))
            self.waiting += len(ask)
        if self.waiting > self.PENDING:
            self._merge()

    def _merge(self) -> None:
        ask, score, ids = (np.concatenate(c) for c in zip(self.kept, *self.pending))
        order = np.lexsort((-score, ask))  # stable: earlier candidates first
        ask = ask[order]
        stay = np.arange(len(ask)) - np.searchsorted(ask, ask) < self.k
        ask, order = ask[stay], order[stay]
        self.kept = ask, score, ids = ask, score[order], ids[order]
        full = np.flatnonzero(np.bincount(ask, minlength=len(self.x)) == self.k)
        self.floor[full] = score[np.searchsorted(ask, full, side="right") - 1]
        self.pending, self.waiting = [], 0

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, candidate, score)."""
        if self.x is None:
            return np.empty(0), np.empty(0), np.empty(0)
        self._merge()
        ask, score, ids = self.kept
        return self.ids[ask], ids, score


def nearest(
    rows: DataFrame, query: Column, k: int = 20, settings: Settings = Settings(), id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row that ``query`` selects.

    ``score`` is the inner product in double precision; ties go to the smaller id.

    * Vectors that are null, empty, zero or hold null or non-finite components,
      rows without an id, and vectors of another length than the most frequent
      one (of equally frequent ones the smaller) take no part.
    * Equal vectors: each row is a candidate; of a class, the ``k + 1`` smallest
      ids are kept, as no more can be among the nearest.
    * Fewer than ``k`` candidates: all that were found. An empty table gives no rows.
    """
    spark = rows.sparkSession
    prepare(spark)
    s = settings
    kind = rows.schema[id_col].dataType.simpleString()
    given = rows.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(query, F.lit(False)).alias("q"))
    given = given.where(F.col("id").isNotNull() & _valid(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    size = given.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    out = f"query_id {kind}, rank int, vec_id {kind}, score double"
    if size is None:
        return spark.createDataFrame([], out)
    given = given.where(F.size("v") == size["dim"])

    order = Window.partitionBy("v").orderBy("id")
    few = given.select("id", "v").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    classes = materialize(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("members")).withColumn("rep", F.col("members")[0]))
    asked = given.where("q").select("id", "v")
    wanted = asked.groupBy("v").agg(F.min("id").alias("first"))
    queries = materialize(classes.join(wanted, "v").select("rep", "v"))

    total, most = classes.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    sample = _matrix(threshold_sample(classes.select("v"), F.col("v"), s.sample, total).sort("v").toArrow().column(0))
    if not len(sample):
        sample = np.zeros((1, size["dim"]))

    def lengthened(x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))])

    rng = np.random.default_rng(s.seed)
    built = [build_tree(lengthened(sample), total / len(sample), max(s.leaf, total // s.leaves), rng) for _ in range(s.trees)]
    shared = spark.sparkContext.broadcast(built)
    starts = np.cumsum([0] + [t.leaves for t in built])

    def find(asks: bool):
        """Adds the leaf of each tree, or the leaves that a query visits, numbered over all trees."""

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forest = shared.value
            for b in batches:
                x = _matrix(b.column(1))
                if not len(x):
                    continue
                if asks:
                    far = np.column_stack([x, np.zeros(len(x))])
                    leaves = [[starts[t] + leaf for t, leaf in visit(forest, q, s.probe)] for q in far]
                else:
                    leaves = list(np.column_stack([starts[t] + home(tree, lengthened(x)) for t, tree in enumerate(forest)]))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaves, pa.list_(pa.int32()))], names=["rep", "v", "leaves"])

        return each

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(best: Best) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(best.rows(), (id_type, id_type, pa.float64()))], names=["query", "rep", "score"])

        cell, best, id_type = None, None, None
        for b in batches:
            id_type = b.schema.field("rep").type
            keys = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(int) for i in range(3)])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(keys)]):
                if start == stop:
                    continue
                part = b.slice(start, stop - start)
                if cell != tuple(keys[start, :2]):
                    if best:
                        yield result(best)
                    cell, best = tuple(keys[start, :2]), Best(k + 1, int(starts[-1]))
                ids, x, leaves = part.column(3).to_numpy(zero_copy_only=False), _matrix(part.column(4)), part.column(5)
                if keys[start, 2]:
                    best.offer(ids, x, leaves.flatten().to_numpy().reshape(len(x), -1))
                else:
                    best.ask(ids, x, leaves)
        if best:
            yield result(best)

    blocks = max(2, -(-queries.count() // s.block))
    placed = f"rep {kind}, v array<double>, leaves array<int>"
    block, shard = (F.pmod(F.xxhash64("rep", F.lit(name)), F.lit(n)).cast("int") for name, n in (("block", blocks), ("shard", s.shards)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = queries.select("rep", "v").mapInArrow(find(True), placed).select(block.alias("block"), every(s.shards).alias("shard"), F.lit(0).alias("candidate"), "*")
    offered = classes.select("rep", "v").mapInArrow(find(False), placed).select(every(blocks).alias("block"), shard.alias("shard"), F.lit(1).alias("candidate"), "*")
    dealt = asking.union(offered).repartition("block", "shard").sortWithinPartitions("block", "shard", "candidate", "rep")
    found = dealt.mapInArrow(rerank, f"query {kind}, rep {kind}, score double")
    near = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = found.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1)
    found = found.join(classes.select("rep", "members"), "rep").select("query", "score", F.explode("members").alias("id"))
    found = found.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1)
    lists = found.groupBy(F.col("query").alias("rep")).agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("near"))

    of_query = asked.join(classes.select("v", "rep"), "v").select("id", "rep")
    answers = of_query.join(lists, "rep").select("id", F.slice(F.filter("near", lambda n: n["id"] != F.col("id")), 1, k).alias("near"))
    return answers.select(F.col("id").alias("query_id"), F.posexplode("near").alias("pos", "n")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("n.id").alias("vec_id"), F.col("n.score").alias("score")
    )
