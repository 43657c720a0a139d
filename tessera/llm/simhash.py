"""SimHash near-dedup with vantage-point trees.

Fingerprints are made in one pass over the texts and equal ones are one class.
Classes within ``max_bits`` differing bits are found exactly:

* Two fingerprints that differ in at most ``max_bits`` bits differ in at most
  ``max_bits // 2`` bits in one of their 32-bit halves. So there are two
  vantage-point trees, one over each half, each searched with that small radius.
* The upper part of a tree is built on a bounded sample of fingerprints: a node
  is a vantage point and a Hamming radius that halves its part of the sample. It
  splits the fingerprints of all documents into shards.
* A fingerprint lives in one shard. By the triangle bound it is sent as a query
  to every other shard that its search ball overlaps. Of two neighbours on both
  sides of a boundary only the outer one is sent, as that finds the pair.
* A shard is searched by the same rule, recursively, down to small leaves.
  It reports a spanning forest of the links it finds, not all pairs, so a shard
  full of near copies has at most as many links as fingerprints.

Components of the links come from ``components.connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, prepare, threshold_sample
from tessera.llm.components import connected_components

#: Fingerprints that the upper trees are built on; the bound of what the driver holds.
SAMPLE = 32_768
#: Fingerprints that a shard should hold, and a leaf that is compared directly.
SHARD = 4_096
LEAF = 512
#: Rows of hashes, or of a comparison, that are held at once.
BLOCK = 32_768
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles of ``text``; 0 if it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([digest(line[i:j], SEED) for i, j in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp long) of every row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {kind}, fp bigint")


def _distance(x: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(x ^ x.dtype.type(point))


def _half(fp: np.ndarray, half: int) -> np.ndarray:
    return (fp.view(np.uint64) >> np.uint64(32 * half)).astype(np.uint32)


def _quarter(fp: np.ndarray, quarter: int) -> np.ndarray:
    return (fp.view(np.uint64) >> np.uint64(16 * quarter)).astype(np.uint16)


def _vantage(x: np.ndarray) -> tuple[int, int] | None:
    """A vantage point and the radius that best halves ``x``; None if none splits it."""
    best = None
    for point in x[np.linspace(0, len(x) - 1, 6).astype(int)].tolist():
        inside = np.cumsum(np.bincount(_distance(x, point), minlength=33))
        radius = int(np.abs(2 * inside - len(x)).argmin())
        off = abs(2 * int(inside[radius]) - len(x))
        if off < len(x) and (best is None or off < best[0]):
            best = off, point, radius
    return None if best is None else best[1:]


def build_tree(sample: np.ndarray, scale: float, shard: int = SHARD) -> list[tuple]:
    """Nodes (point, radius, inside, outside); a shard is (None, its number, 0, 0).

    ``scale``: how many fingerprints one of the sample stands for.
    """
    nodes: list[tuple] = [()]
    todo, shards = [(0, sample)], 0
    while todo:
        k, x = todo.pop()
        cut = _vantage(x) if len(x) > 8 and len(x) * scale > shard else None
        if cut is None:
            nodes[k] = (None, shards, 0, 0)
            shards += 1
            continue
        near = _distance(x, cut[0]) <= cut[1]
        nodes[k] = (*cut, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), x[near]), (len(nodes) + 1, x[~near])]
        nodes += [(), ()]
    return nodes


def _sides(d: np.ndarray, radius: int, home: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """Who goes inside and outside, and who of them lives there.

    A resident goes to its side, and as a query also inward if its ball reaches
    there; a query goes wherever its ball reaches.
    """
    near = d <= radius
    inside = np.where(home, near | (d <= radius + reach), d <= radius + reach)
    outside = np.where(home, ~near, d + reach > radius)
    return inside, outside, home & near, home & ~near


def route(nodes: list[tuple], x: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, places in ``x`` that go there, whether they live there)."""
    todo = [(0, np.arange(len(x)), np.ones(len(x), bool))]
    while todo:
        k, at, home = todo.pop()
        point, radius, a, b = nodes[k]
        if point is None:
            if len(at):
                yield radius, at, home
            continue
        inside, outside, home_in, home_out = _sides(_distance(x[at], point), radius, home, reach)
        todo += [(a, at[inside], home_in[inside]), (b, at[outside], home_out[outside])]


class _Forest:
    """Spanning forest of the links found so far in a shard."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self, js: np.ndarray) -> np.ndarray:
        """The root of each of ``js``, whose paths become one step long."""
        up = self.parent[js]
        while not np.array_equal(up, above := self.parent[up]):
            up = above
        self.parent[js] = up
        return up

    def connected(self, js: np.ndarray) -> bool:
        """Whether ``js`` are in one component already, so that no link among them is missing."""
        return self.parent[js[0]] == self.parent[js[-1]] and len(np.unique(self.roots(js))) == 1

    def add(self, i: int, js: np.ndarray) -> None:
        roots, first = np.unique(self.roots(js), return_index=True)
        own = int(self.roots(np.array([i]))[0])
        for r, j in zip(roots.tolist(), js[first].tolist()):
            if r != own:
                self.links.append((i, j))
                self.parent[r] = own


def search(fp: np.ndarray, home: np.ndarray, half: int, max_bits: int) -> list[tuple[int, int]]:
    """Links (places in ``fp``) of a shard's residents with each other and with queries.

    Residents with equal halves are one point to a tree over that half. Of two
    fingerprints with the same half all differing bits lie in the other one, at
    most ``max_bits // 2`` of them in one of its quarters, so these residents are
    split by a tree over each of the two quarters instead.
    """
    bits = fp.view(np.uint64)
    parts = {16: lambda k: _quarter(fp, k), 32: lambda k: _half(fp, k)}
    made: dict[tuple[int, int], np.ndarray] = {}
    found = _Forest(len(fp))
    todo = [(np.arange(len(fp)), home, (32, half))]
    while todo:
        at, lives, part = todo.pop()
        mine = at[lives]
        if not len(mine) or found.connected(at):
            continue
        if part not in made:
            made[part] = parts[part[0]](part[1])
        x, reach = made[part], max_bits // 2
        cut = _vantage(x[mine]) if len(mine) > LEAF else None
        if cut:
            inside, outside, home_in, home_out = _sides(_distance(x[at], cut[0]), cut[1], lives, reach)
            todo += [(at[inside], home_in[inside], part), (at[outside], home_out[outside], part)]
            continue
        if len(mine) > LEAF and part[0] == 32:
            # queries lie up to ``reach`` bits away in this half and have fewer left for the other
            other = 1 - part[1]
            todo += [(at, lives, (16, 2 * other + k)) for k in (0, 1)]
            continue
        rows = max(1, (1 << 18) // len(mine))
        for k in range(0, len(at), rows):
            some = at[k : k + rows]
            # rows already linked to all that they are near to add nothing
            apart = found.roots(some)[:, None] != found.roots(mine)[None, :]
            if not apart.any():
                continue
            near = np.bitwise_count(bits[some][:, None] ^ bits[mine][None, :]) <= max_bits
            near &= apart
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                found.add(int(some[i]), mine[near[i]])
    return found.links


def links(classes: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): a spanning set of the links among the distinct ``fp`` of ``classes``.

    Every two fingerprints within ``max_bits`` bits are connected by the links.
    """
    spark = classes.sparkSession
    total = classes.count()
    sample = threshold_sample(classes.select("fp"), F.col("fp"), SAMPLE, total).toArrow()
    sample = np.sort(sample.column(0).to_numpy().astype(np.int64))
    scale = total / max(1, len(sample))
    trees = spark.sparkContext.broadcast([build_tree(_half(sample, half), scale) for half in (0, 1)])
    reach = max_bits // 2

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for half, nodes in enumerate(trees.value):
                parts = list(route(nodes, _half(fp, half), reach))
                if parts:
                    at = np.concatenate([p[1] for p in parts])
                    shard = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), half, np.int32)), pa.array(shard.astype(np.int32)), pa.array(fp[at]), pa.array(np.concatenate([p[2] for p in parts]))],
                        names=["half", "shard", "fp", "home"],
                    )

    def match(key: tuple, part: pa.Table) -> pa.Table:
        fp = part.column("fp").to_numpy().astype(np.int64)
        order = np.argsort(fp, kind="stable")
        fp, home = fp[order], part.column("home").to_numpy(zero_copy_only=False)[order]
        found = np.array(search(fp, home, key[0].as_py(), max_bits), np.int64).reshape(-1, 2)
        return pa.table({"a": fp[found[:, 0]], "b": fp[found[:, 1]]})

    dealt = classes.select("fp").mapInArrow(deal, "half int, shard int, fp bigint, home boolean")
    return dealt.groupBy("half", "shard").applyInArrow(match, "a bigint, b bigint")


def components(made: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """(class_fp, label, component_id) of every distinct ``fp`` of ``made``."""
    classes = materialize(made.groupBy("fp").agg(F.min(id_col).alias("first")))
    root = connected_components(links(classes, max_bits), "a", "b")
    labelled = classes.join(root, classes["fp"] == root["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("label")
    )
    # written first, so that the join has shuffles of its own and a large component can be split
    least = materialize(labelled.groupBy("label").agg(F.min("first").alias("component_id")))
    return labelled.join(least, "label").select(F.col("fp").alias("class_fp"), "label", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, fingerprint hex, component_id) of every row of ``docs``.

    ``component_id`` is the smallest id that is reachable over links of at most
    ``max_bits`` bits (the method needs ``max_bits`` below 64).

    * Null or empty text, or one without words: fingerprint zero, linked like any other.
    * Repeated rows: one result row each, in the same component.
    * Null ids: their rows link like any other; ``component_id`` is null only
      if the whole component has no id.
    * Fewer words than a shingle: the whole sequence is the shingle.
    * An empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    made = materialize(fingerprints(docs, shingle, id_col, text_col))
    named = components(made, id_col, max_bits)
    return made.join(named, made["fp"] == named["class_fp"]).select(
        F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: that of its smallest id.

    Of repeated rows of that id, and of a component without any id, any one row stays. Rows
    that share an id but no component are told apart by their fingerprints.

    * Null or empty texts are one component, that of fingerprint zero.
    * Other columns pass through; names that begin with two underscores are taken.
    * An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    made = materialize(fingerprints(docs, shingle, id_col, text_col))
    named = materialize(components(made, id_col, max_bits))
    shared = made.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
    shared = materialize(shared.where("low != high").select("__id"))
    heads = named.where(F.col("component_id").isNotNull()).select(F.col("component_id").alias("__id"), "class_fp", F.col("label").alias("__label"))
    ids = heads.select("__id").distinct().join(shared, "__id", "left_anti")
    with_id = docs.join(ids, docs[id_col] == ids["__id"], "left_semi").dropDuplicates([id_col])

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    if not shared.isEmpty():
        several = docs.join(shared, docs[id_col] == shared["__id"], "left_semi").withColumn("__fp", fp(F.col(text_col)))
        several = several.join(heads, (several[id_col] == heads["__id"]) & (several["__fp"] == heads["class_fp"])).dropDuplicates(["__label"])
        with_id = with_id.unionByName(several.select(*(several[c] for c in docs.columns)))

    lone = named.where(F.col("component_id").isNull()).select("class_fp", F.col("label").alias("__label"))
    without = docs.where(F.col(id_col).isNull()).withColumn("__fp", fp(F.col(text_col)))
    without = without.join(lone, F.col("__fp") == F.col("class_fp")).dropDuplicates(["__label"])
    return with_id.unionByName(without.select(*docs.columns))
