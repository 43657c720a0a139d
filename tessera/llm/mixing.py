"""Mixing sources to target weights by hierarchical budgeting.

The leaves of a tree (by default domain, language, source) hold documents. A
budget of tokens is propagated from the root by weights. A child that cannot use
its share (all its documents in all allowed epochs are fewer tokens) leaves the
shortage to its siblings; what they cannot take either goes up to the siblings
of their parent. A leaf reads its documents in a seeded order, epoch after epoch
with a new order each, and keeps those that begin before its budget ends.

Only token sums of leaves reach the driver. Orders are ranges of a hash, so a
leaf with a third of all documents is sorted and summed up in many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, prepare

#: Rows of one leaf that a window partition sorts.
BUCKET_ROWS = 256
_STEPS = 1 << 30
#: Stands for null in a level of the tree.
NONE = "(none)"


@dataclass(frozen=True)
class Mix:
    #: Weight of a node, named by its path such as ``("domain-0", "en")``.
    weights: dict[tuple[str, ...], float] = field(default_factory=dict)
    #: Weight of other leaves: their tokens to this power (1: as they come, 0: all alike).
    #: Other inner nodes weigh what their children do together, so that leaves of
    #: equal size have equal targets wherever they stand in the tree.
    flatten: float = 0.7
    #: Tokens to select over tokens given.
    budget: float = 1.0
    max_epochs: int = 4
    seed: int = 42


def domain(source: Column, domains: int = 4) -> Column:
    """The domain of a source where the table names none: by the source's hash."""
    return F.concat(F.lit("domain-"), F.pmod(F.crc32(F.coalesce(source, F.lit(NONE)).cast("binary")), F.lit(domains)).cast("string"))


def share_out(budget: float, limits: list[float], weights: list[float]) -> list[float]:
    """``budget`` by weight, none above its limit; shortages go to the others by weight."""
    got = [0.0] * len(limits)
    open_ = [k for k, (m, w) in enumerate(zip(limits, weights)) if m > 0 and w > 0]
    left = min(budget, sum(limits[k] for k in open_))
    while open_ and left > 0:
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if limits[k] <= left * weights[k] / total]
        if not full:
            for k in open_:
                got[k] = left * weights[k] / total
            return got
        for k in full:
            got[k] = limits[k]
            open_.remove(k)
        left -= sum(limits[k] for k in full)
    return got


def budgets(tokens: dict[tuple[str, ...], int], mix: Mix, total: float) -> dict[tuple[str, ...], float]:
    """The budget of each leaf; ``tokens`` has the leaves' paths, all equally deep."""

    def weight(path: tuple[str, ...], leaves: dict[tuple[str, ...], int]) -> float:
        if path in mix.weights:
            return mix.weights[path]
        if path in leaves:
            return float(leaves[path]) ** mix.flatten if leaves[path] else 0.0
        below: dict[tuple[str, ...], dict] = {}
        for leaf, n in leaves.items():
            below.setdefault(leaf[: len(path) + 1], {})[leaf] = n
        return sum(weight(p, part) for p, part in below.items())

    def down(prefix: tuple[str, ...], leaves: dict[tuple[str, ...], int], budget: float) -> dict:
        if list(leaves) == [prefix]:
            return {prefix: budget}
        children: dict[tuple[str, ...], dict] = {}
        for path, n in leaves.items():
            children.setdefault(path[: len(prefix) + 1], {})[path] = n
        paths = sorted(children)
        # a subtree's limit counts only leaves that a positive weight reaches
        limits = [float(mix.max_epochs * reach(p, children[p])) for p in paths]
        given = share_out(budget, limits, [weight(p, children[p]) for p in paths])
        return {k: v for p, b in zip(paths, given) for k, v in down(p, children[p], b).items()}

    def reach(prefix: tuple[str, ...], leaves: dict[tuple[str, ...], int]) -> int:
        return sum(n for path, n in leaves.items() if all(mix.weights.get(path[:k], 1.0) > 0 for k in range(len(prefix), len(path) + 1)))

    return down((), dict(sorted(tokens.items())), total) if tokens else {}


def words(text: Column) -> Column:
    """Tokens of a text as budgets count them: its words and one for the end.

    Each word becomes one character and blanks go, so that a very long text
    never becomes an array of its words.
    """
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long") + 1


def select_rows(rows: DataFrame, levels: list[str], mix: Mix = Mix()) -> DataFrame:
    """Rows of ``rows`` (key, tokens, ``levels``) that the budgets select, with ``epoch``.

    ``key`` orders rows by its hash; rows of equal keys are told apart by
    nothing, so keys should differ. A row comes once for each epoch that selects
    it. Columns: those of ``rows`` and ``epoch`` (from 0).

    * A null level counts as a leaf of its own, ``(none)``.
    * Rows with null or no positive ``tokens`` are never selected.
    * An empty table, or a budget of zero, selects nothing.
    """
    spark = rows.sparkSession
    prepare(spark)
    path = F.array(*(F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in levels))
    given = rows.where("tokens > 0").withColumn("__leaf", path)
    sums = given.groupBy("__leaf").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).collect()  # one row per leaf
    tokens = {tuple(r["__leaf"]): r["t"] for r in sums}
    plan = []
    for leaf, budget in budgets(tokens, mix, mix.budget * sum(tokens.values())).items():
        whole = min(mix.max_epochs, int(budget // tokens[leaf] + 1e-9))
        rest = math.floor(budget - whole * tokens[leaf] + 1e-6) if whole < mix.max_epochs else 0
        plan.append((list(leaf), whole, max(0, rest)))
    buckets = max(1, -(-max((r["n"] for r in sums), default=1) // BUCKET_ROWS))
    table = spark.createDataFrame(plan, "__leaf array<string>, __whole int, __rest bigint")
    # one row per leaf; the size is known, so the join is broadcast only when small
    table = F.broadcast(table) if len(plan) <= 100_000 else table
    drawn = F.pmod(F.xxhash64(F.lit(mix.seed), F.col("__whole"), F.col("key")), F.lit(_STEPS))
    dealt = given.join(table, "__leaf").where("__whole > 0 or __rest > 0").withColumn("__draw", drawn)
    dealt = dealt.withColumn("__bucket", F.floor(F.col("__draw") * buckets / _STEPS))
    sizes = dealt.groupBy("__leaf", "__bucket").agg(F.sum("tokens").alias("t"))
    before = Window.partitionBy("__leaf").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("__leaf", "__bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("__begin"))
    inside = Window.partitionBy("__leaf", "__bucket").orderBy("__draw", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("__in", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(begins, ["__leaf", "__bucket"])
    times = F.col("__whole") + (F.col("__begin") + F.col("__in") < F.col("__rest")).cast("int")
    epochs = F.when(times > 0, F.sequence(F.lit(0), times - 1))
    return placed.select(*rows.columns, F.explode(epochs).alias("epoch"))


def tree(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, tokens, domain, lang, source) of every row of ``docs``."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"),
        words(F.col(text_col)).alias("tokens"),
        domain(F.col("source")).alias("domain"),
        "lang",
        "source",
    )


def mix_sources(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, domain, lang, source, tokens, epoch): the documents that a mix selects.

    Repeated rows are selected one by one. See ``select_rows`` for nulls and
    empty tables; null or empty texts have one token, their end.
    """
    prepare(docs.sparkSession)
    rows = materialize(tree(docs, id_col, text_col))
    same = Window.partitionBy("id", "text_hash").orderBy("tokens")
    keyed = rows.withColumn("copy", F.row_number().over(same)).withColumn("key", F.struct("id", "text_hash", "copy"))
    chosen = select_rows(keyed, ["domain", "lang", "source"], mix)
    return chosen.select(F.col("id").alias(id_col), "domain", "lang", "source", "tokens", "epoch")


def mixed_docs(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` as often as the mix selects them; the columns stay.

    Ids and hashes are shuffled to choose, then whole rows once to multiply.

    * Null or empty texts have one token, their end; a null source or language is a leaf of its own.
    * Repeated rows are selected one by one, each at most ``max_epochs`` times.
    * Other columns pass through; names that begin with two underscores are taken.
    * An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    rows = materialize(tree(docs, id_col, text_col))
    same = Window.partitionBy("id", "text_hash").orderBy("tokens")
    keyed = rows.withColumn("copy", F.row_number().over(same)).withColumn("key", F.struct("id", "text_hash", "copy"))
    chosen = select_rows(keyed, ["domain", "lang", "source"], mix)
    # copies of one id, text and leaf are alike: how many of them stay is all that counts
    picked = chosen.groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(F.count("*").alias("__times"))
    marked = docs.withColumn("__h", F.xxhash64(F.coalesce(text_col, F.lit(""))))
    first = Window.partitionBy(id_col, "__h", "lang", "source").orderBy(F.lit(0))
    on = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")) & F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source"))
    joined = marked.withColumn("__copy", F.row_number().over(first)).join(picked, on)
    return joined.where("__copy = 1").withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))).select(*docs.columns)
