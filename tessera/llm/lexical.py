"""Ranked lexical search by an exact inner-product search in sparse ball trees.

A document is the sparse vector of its terms' integer impacts, an item the set of its terms, and a score their inner
product. Only terms of items matter, so a document keeps those of its terms that some item of a block has. Each task
cuts its documents into shards of a bounded number of postings and builds one ball tree for each: a node has the
centroid of its documents and the largest distance from it, which bound the score of every document below by
``q . centroid + |q| * radius``. Bounds are rounded up by more than doubles can be off. Nodes are opened best first,
and a node is left closed if its bound is below the item's tenth best score so far; scores at leaves are exact 64-bit
integers. The best of each task meet in two windows.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import materialize, prepare

TOP = 10
#: (Item, term) pairs of a block of items: bounds what a task gets of the items.
BLOCK_TERMS = 500_000
#: Postings of a shard, and documents of a leaf.
SHARD_POSTINGS = 1_000_000
LEAF = 64
#: Parts into which an item's candidates are ranked first.
SALTS = 64
#: By how much a bound is raised: far above the rounding of the doubles in it.
SLACK = 1e-9

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall(text.translate(_LOWER)) if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def vectors(docs: DataFrame, terms: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """(id_col, n, terms, tfs): number of terms, and those of ``terms`` with their occurrences."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for b in batches:
            sizes, found, counts = [], [], []
            for text in b.column(1).to_pylist():
                all_terms = terms_of(text)
                tf = {number[t]: k for t, k in Counter(all_terms).items() if t in number}
                sizes.append(len(all_terms))
                found.append(list(tf))
                counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=[id_col, "n", "terms", "tfs"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {kind}, n bigint, terms array<int>, tfs array<bigint>")


class BallTree:
    """Documents given by their postings: ``begin[k]:begin[k + 1]`` of ``term`` and ``impact`` are document k's.

    Nodes are kept in lists; a node has the documents ``order[low:high]``, and two children or none.
    """

    def __init__(self, begin: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.begin, self.term, self.impact = begin, term, impact
        owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        self.norm2 = np.bincount(owner, impact.astype(float) ** 2, len(begin) - 1)  # each sum by itself: no digits lost
        self.order = np.arange(len(begin) - 1)
        self.low, self.high, self.children, self.radius = [], [], [], []
        self.centroids: list[tuple[np.ndarray, np.ndarray]] = []
        self.dense = np.zeros(n_terms)
        todo = [(0, len(self.order), None)]
        while todo:
            low, high, parent = todo.pop()
            node = self._node(low, high)
            if parent is not None:
                self.children[parent].append(node)
            if high - low > LEAF:
                middle = self._split(low, high)
                todo += [(low, middle, node), (middle, high, node)]
        self.leaves = {k: self._postings(self.order[self.low[k] : self.high[k]]) for k, c in enumerate(self.children) if not c}

    def _places(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the postings of ``docs``, and how many each has."""
        sizes = self.begin[docs + 1] - self.begin[docs]
        shift = np.repeat(self.begin[docs] - np.cumsum(sizes) + sizes, sizes)
        return np.arange(sizes.sum()) + shift, sizes

    def _products(self, docs: np.ndarray) -> np.ndarray:
        """Inner products of ``docs`` with ``self.dense``."""
        at, sizes = self._places(docs)
        return np.bincount(np.repeat(np.arange(len(docs)), sizes), self.impact[at] * self.dense[self.term[at]], len(docs))

    def _node(self, low: int, high: int) -> int:
        docs = self.order[low:high]
        at, _ = self._places(docs)
        if len(at):
            terms, place = np.unique(self.term[at], return_inverse=True)
            centre = np.bincount(place, self.impact[at]) / len(docs)
        else:
            terms, centre = np.zeros(0, np.int64), np.zeros(0)
        self.dense[terms] = centre
        size2 = float(centre @ centre)
        far2 = self.norm2[docs] - 2 * self._products(docs) + size2
        self.dense[terms] = 0
        # a difference of large numbers is off by a share of these, not of itself
        safe2 = max(0.0, float(far2.max(initial=0.0))) + SLACK * (float(self.norm2[docs].max(initial=0.0)) + size2)
        self.low.append(low)
        self.high.append(high)
        self.children.append([])
        self.centroids.append((terms, centre))
        self.radius.append(math.sqrt(safe2))
        return len(self.low) - 1

    def _distances(self, doc: int, docs: np.ndarray) -> np.ndarray:
        mine = slice(self.begin[doc], self.begin[doc + 1])
        self.dense[self.term[mine]] = self.impact[mine]
        out = self.norm2[docs] - 2 * self._products(docs)
        self.dense[self.term[mine]] = 0
        return out

    def _split(self, low: int, high: int) -> int:
        """Order ``low:high`` by which of two documents far apart is nearer, and cut near the middle.

        The cut is between two documents that differ in this, so copies stay in one ball of no width.
        """
        docs = self.order[low:high]
        one = docs[np.argmax(self._distances(docs[0], docs))]
        other = docs[np.argmax(from_one := self._distances(one, docs))]
        side = from_one - self._distances(other, docs)
        by = np.argsort(side, kind="stable")
        self.order[low:high] = docs[by]
        half = (high - low) // 2
        steps = np.flatnonzero(np.diff(side[by])) + 1
        return low + int(steps[np.argmin(abs(steps - half))] if len(steps) else half)

    def _postings(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A leaf's postings by term: terms, places in the leaf, impacts."""
        at, sizes = self._places(docs)
        owner, by = np.repeat(np.arange(len(docs)), sizes), np.argsort(self.term[at], kind="stable")
        return self.term[at][by], owner[by], self.impact[at][by]

    def bounds(self, begins: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """No document below a node scores more for an item: node x item. ``wanted`` has the terms of all items."""
        root = np.sqrt(np.diff(np.append(begins, len(wanted))))
        out = np.empty((len(self.low), len(begins)))
        for k, (terms, centre) in enumerate(self.centroids):
            self.dense[terms] = centre
            inner = np.add.reduceat(self.dense[wanted], begins)
            self.dense[terms] = 0
            out[k] = (inner + root * self.radius[k]) * (1 + SLACK) + 1
        return out

    def scores(self, leaf: int, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents for one item's terms, ascending."""
        terms, owner, impact = self.leaves[leaf]
        begin, end = np.searchsorted(terms, wanted), np.searchsorted(terms, wanted, side="right")
        sizes = end - begin
        at = np.arange(sizes.sum()) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)
        out = np.zeros(self.high[leaf] - self.low[leaf], np.int64)
        np.add.at(out, owner[at], impact[at])
        return out


class Best:
    """The ``top`` best documents of each item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top, self.kept = top, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # what a score must reach

    def add(self, item: int, found: list[tuple]) -> None:
        kept = sorted([*self.kept[item], *found], key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
        self.kept[item] = kept[: self.top]
        if len(kept) >= self.top:
            self.least[item] = kept[self.top - 1][0]


def search(tree: BallTree, ids: list, items: list[np.ndarray], best: Best) -> int:
    """Open the tree's nodes best first for each item; the number of leaves scored."""
    begins = np.cumsum([0, *map(len, items)])[:-1]
    bounds = tree.bounds(begins, np.concatenate(items))
    scored = 0
    for item, wanted in enumerate(items):
        bound = bounds[:, item]
        queue = [(-bound[0], 0)]
        while queue and -queue[0][0] >= best.least[item]:
            node = heapq.heappop(queue)[1]
            for child in tree.children[node]:
                if bound[child] >= best.least[item]:
                    heapq.heappush(queue, (-bound[child], child))
            if tree.children[node]:
                continue
            scored += 1
            got = tree.scores(node, wanted)
            if len(good := np.flatnonzero(got >= best.least[item])):
                low = tree.low[node]
                best.add(item, [(int(got[k]), ids[tree.order[low + k]]) for k in good])
    return scored


def _ranked_block(docs: DataFrame, rows: list, id_col: str, text_col: str, item_col: str, top: int) -> DataFrame:
    """(place in the block, doc, score) of the best candidates of each task."""
    spark = docs.sparkSession
    sets = [sorted(set(terms_of(r[1]))) for r in rows]
    names = {t: k for k, t in enumerate(sorted({t for s in sets for t in s}))}
    made = materialize(vectors(docs, names, id_col, text_col))
    n_docs, total = made.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["term"]: r["count"] for r in made.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    weights = np.zeros(len(names) + 1, np.int64)
    for t, k in df.items():  # at most the terms of the block
        weights[t] = weight(n_docs, k)
    made_id = to_arrow_type(docs.schema[id_col].dataType)
    shared = spark.sparkContext.broadcast((weights, [(k, np.array([names[t] for t in s], np.int64)) for k, s in enumerate(sets) if s]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, numbered = shared.value
        items = [s for _, s in numbered]
        best = Best(len(items), top)

        def close(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            terms = t.column(2).combine_chunks()
            n = t.column(1).to_numpy()
            m = np.array([10 + 90 * x * n_docs // total for x in n.tolist()], np.int64)  # whole numbers of any size
            sizes = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            term = terms.flatten().to_numpy().astype(np.int64)
            tf = t.column(3).combine_chunks().flatten().to_numpy()
            impact = weights[term] * ((10**9 * tf) // (1000 * tf + 8 * np.repeat(m, sizes)))
            search(BallTree(np.concatenate([[0], np.cumsum(sizes)]), term, impact, len(weights)), t.column(0).to_pylist(), items, best)

        held, postings = [], 0
        for b in batches:
            b = b.filter(pc.greater(pc.list_value_length(b.column(2)), 0))
            for k in range(0, b.num_rows, 4096):
                held.append(some := b.slice(k, 4096))
                postings += len(some.column(2).flatten())
                if postings >= SHARD_POSTINGS:
                    close(held)
                    held, postings = [], 0
        if postings:
            close(held)
        found = [(numbered[k][0], i, s) for k, kept in enumerate(best.kept) for s, i in kept]
        if found:
            item, doc, score = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, made_id), pa.array(score, pa.int64())], names=["__item", id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return made.mapInArrow(each, f"__item int, `{id_col}` {kind}, score bigint") if any(sets) else spark.createDataFrame([], f"__item int, `{id_col}` {kind}, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """(item_col, rank, id_col, score): the ``top`` documents of each item with a score above 0.

    Items are taken in blocks of about ``BLOCK_TERMS`` terms, each against all documents; statistics are those of
    all documents.

    * Null or empty text, or one without a term: such an item has no rows, such a document is found by none.
    * Equal scores: smaller id first, null ids last; rows of one id and score are ranked in any order.
    * Repeated rows and ids, of documents and items: each row counts on its own.
    * Very long texts are read whole. An empty table on either side gives no rows.
    * Other columns are not read; ``id_col`` must not be ``__item``, ``__salt``, ``__rank``, ``score`` or ``rank``.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    items = items.select(item_col, text_col)
    size = F.size(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(_TERM.pattern), F.lit(0))))
    blocks = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // BLOCK_TERMS))
    out = spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {kind}, score bigint")
    best_first = [F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64(item_col, text_col), F.lit(blocks)) == k).collect()  # one block
        found = _ranked_block(docs, rows, id_col, text_col, item_col, top).withColumn("__salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
        for part in (["__item", "__salt"], ["__item"]):
            found = found.withColumn("__rank", F.row_number().over(Window.partitionBy(*part).orderBy(*best_first))).where(F.col("__rank") <= top)
        named = spark.createDataFrame([(j, r[0]) for j, r in enumerate(rows)], f"__item int, `{item_col}` {item_kind}")
        out = out.unionByName(found.join(named, "__item").select(item_col, F.col("__rank").alias("rank"), id_col, "score"))
    return out


_ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
wanted AS (
  SELECT DISTINCT item_id, place, unnest(words) AS term FROM (
    SELECT item_id, row_number() OVER () AS place, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM benchmark)),
totals AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS docs, sum(len(words)) AS terms FROM lowered),
postings AS (
  SELECT place, doc_id, n, term, count(*) AS tf FROM (
    SELECT place, doc_id, len(words) AS n, unnest(words) AS term FROM lowered)
  GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
scored AS (
  SELECT wanted.place AS item, item_id, postings.place, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (CAST(90 AS HUGEINT) * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term), totals
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> str:
    return _ORACLE
