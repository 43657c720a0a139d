"""Scalable exact ranking, seeded shuffles, samples and fixed-size batches.

``row_number()`` over a low-cardinality (or empty) partition key runs in one
task. ``bucketed_rank`` splits every group into up to 16^digits buckets by a
prefix of an md5 order key, counts rows per (group, bucket), turns the counts
into cumulative offsets on that small table, and ranks inside each
(group, bucket) only. The rank equals the plain window rank, but the widest
task holds one bucket of one group instead of the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_hex
from tessera.operators.skew import key_hash, large_groups
from tessera.session import materialize

_B = "__bucket"
_N = "__n"
_SIZE = "__group_n"
_ROW = "__is_row"


def with_starts(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """``rows`` and, as rows of their own (``__is_row`` false), the totals with
    which each bucket starts. A running sum inside a bucket that takes its start
    row first needs no join, and NULL keys group as they are."""
    return rows.withColumn(_ROW, F.lit(True)).unionByName(starts.withColumn(_ROW, F.lit(False)), allowMissingColumns=True)


def bucketed_rank(
    df: DataFrame,
    *,
    order: list,
    bucket: Column,
    group_cols: list[str] | None = None,
    rank_col: str = "rank",
    size_col: str | None = None,
    whole: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` (1-based, bigint): position of each row inside its
    group when ordered by ``order``.

    ``bucket`` must be non-decreasing along ``order`` (a prefix of an md5
    order key, a time bucket of an event-time order, ...); a NULL bucket sorts
    first. NULL group values form a group of their own. ``size_col``
    optionally adds the group row count. The counts of the buckets before come
    in as one row per (group, bucket), so the rows are shuffled once.

    With ``whole`` only groups of more rows than that are cut into buckets (one
    pass over the group columns finds them). Without any such group the rows
    are dealt by ``group_cols`` alone and nothing is counted, and what follows
    in a group finds its rows together.
    """
    groups = list(group_cols or [])
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    cut = F.lit(True)
    if whole is not None and groups:
        large = large_groups(df, groups, whole)
        if not large:
            group = Window.partitionBy(*groups)
            made = {rank_col: F.row_number().over(group.orderBy(*order_cols)).cast("bigint")}
            if size_col:
                made[size_col] = F.count(F.lit(1)).over(group)
            return df.select(*[c for c in df.columns if c not in made], *[c.alias(k) for k, c in made.items()])
        cut = key_hash(groups).isin(large)
        bucket = F.when(cut, bucket)  # any other group is one bucket, which starts at none
    rows = df.withColumn(_B, bucket).withColumn(_N, F.lit(1).cast("bigint"))
    counted = rows if whole is None or size_col else rows.where(cut)
    counts = counted.groupBy(*groups, _B).agg(F.count(F.lit(1)).alias(_N))
    before = Window.partitionBy(*groups).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__before", F.coalesce(F.sum(_N).over(before), F.lit(0)).cast("bigint"))
    if size_col:
        starts = starts.withColumn(_SIZE, F.sum(_N).over(Window.partitionBy(*groups)))
    starts = starts.drop(_N).withColumnRenamed("__before", _N)
    upto = Window.partitionBy(*groups, _B).orderBy(_ROW, *order_cols).rowsBetween(Window.unboundedPreceding, 0)
    both = with_starts(rows, starts)
    made = {rank_col: F.sum(_N).over(upto).cast("bigint")}
    if size_col:
        made[size_col] = F.first(_SIZE, ignorenulls=True).over(upto).cast("bigint")
    out = both.select("*", *[c.alias(f"__made_{k}") for k, c in made.items()]).where(_ROW)
    return out.select(*[c for c in df.columns if c not in made], *[F.col(f"__made_{k}").alias(k) for k in made])


def hash_rank(
    df: DataFrame,
    key: str | list[str],
    seed,
    *,
    group_cols: list[str] | None = None,
    digits: int = 3,
    rank_col: str = "rank",
    size_col: str | None = None,
) -> DataFrame:
    """Rank rows in the seeded-shuffle order ``md5(key ':' seed), key``."""
    keys = key if isinstance(key, list) else [key]
    h = hash_hex(keys, seed)
    tmp = df.withColumn("__order", h)
    out = bucketed_rank(
        tmp,
        order=[F.col("__order")] + [F.col(k) for k in keys],
        bucket=F.substring(F.col("__order"), 1, digits),
        group_cols=group_cols,
        rank_col=rank_col,
        size_col=size_col,
    )
    return out.drop("__order")


def with_order_key(df: DataFrame, key: str | list[str], seed: int, name: str = "__order") -> DataFrame:
    return df.withColumn(name, hash_hex(key if isinstance(key, list) else [key], seed))


def seeded_shuffle(df: DataFrame, key: str, seed: int = 1234) -> DataFrame:
    """SK1: a reproducible permutation, range-partitioned (no single task)."""
    h = hash_hex([key], seed)
    return df.orderBy(h, F.col(key))


#: Rows up to which a lookup table is broadcast.
LOOKUP_ROWS = 100_000


def checked_broadcast(lookup: DataFrame, at_most: int = LOOKUP_ROWS) -> DataFrame:
    """``lookup`` with a broadcast hint if it has at most ``at_most`` rows, else
    as it is, so that the join shuffles. The table is written once and counted
    there; without the check a label column that is nearly a key would be sent
    whole to every executor."""
    held = materialize(lookup)
    return F.broadcast(held) if held.limit(at_most + 1).count() <= at_most else held


#: Rows of a bucket in which batches are numbered.
BUCKET_ROWS = 20_000
#: Rows of the last step of a selection that the driver sorts.
FEW_ROWS = 1_000


def smallest(df: DataFrame, digest: Column, n: int) -> tuple[DataFrame, str | None, int]:
    """The rows of ``df`` whose hex ``digest`` is among the ``n`` smallest, found without a sort.

    Rows are counted by the next four digits (at most 65,536 counts), and the
    bucket in which the n-th row lies is counted again, until a bucket ends
    there or is small. Returns the rows below the cut, and, where rows of one
    digest are cut in two, that digest and how many of its rows are still wanted.
    """
    held = df.withColumn("__d", digest)
    prefix, before = "", 0
    while True:
        inside = held.where(F.col("__d").startswith(prefix)) if prefix else held
        at = len(prefix) + 1
        counts = sorted(map(tuple, inside.groupBy(F.substring("__d", at, 4).alias("p")).count().collect()))
        for digits, k in counts:
            if before + k >= n:
                break
            before += k
        else:
            return df, None, 0  # there are no more than n rows
        prefix += digits
        if before + k == n:
            return held.where(F.substring("__d", 1, len(prefix)) <= prefix).drop("__d"), None, 0
        whole = len(digits) < 4 or len(prefix) >= 32  # all digits are used up
        if k <= FEW_ROWS and not whole:
            few = sorted(r[0] for r in held.where(F.col("__d").startswith(prefix)).select("__d").collect())
            cut = few[n - before - 1]
            below, upto = before + few.index(cut), before + len(few) - few[::-1].index(cut)
            if upto == n:
                return held.where(F.col("__d") <= cut).drop("__d"), None, 0
            return held.where(F.col("__d") < cut).drop("__d"), cut, n - below
        if whole:
            return held.where(F.col("__d") < prefix).drop("__d"), prefix, n - before


def take_sample(df: DataFrame, key: str, n: int | None, seed: int = 1234) -> DataFrame:
    """SK2: the first ``n`` rows of the seeded shuffle (0 / None = all rows), in no order.

    A distributed selection: counts find the cut, a filter takes the rows, so
    half of a table comes out of as many tasks as it went in. Rows of one key
    that the cut divides are taken by a digest of all their columns. A NULL key
    comes first.
    """
    if not n:
        return df
    h = F.coalesce(hash_hex([key], seed), F.lit(""))
    below, cut, left = smallest(df, h, int(n))
    if cut is None:
        return below
    tied = df.where(h == cut)
    row = F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    some, same, more = smallest(tied, row, left)
    out = below.unionByName(some)
    # rows that are equal in every column: any of them
    return out if same is None else out.unionByName(tied.where(row == same).limit(more))


def range_splitters(df: DataFrame, cols: list[str], buckets: int = 64, *, sample_rows: int = 20_000, seed: int = 11) -> list[Row]:
    """Values of ``cols`` that cut ``df`` into about equal ranges, from a sample of about ``sample_rows`` rows.

    The order is Spark's own, of any sortable types, NULL first. At most
    ``buckets - 1`` different rows.
    """
    keys = df.select(*cols)
    total = keys.count()
    some = keys.sample(fraction=sample_rows / total, seed=seed) if total > sample_rows else keys
    ordered = some.orderBy(*cols).collect()
    found = [ordered[len(ordered) * i // buckets] for i in range(1, buckets)] if ordered else []
    return list(dict.fromkeys(found))


def range_bucket(df: DataFrame, cols: list[str], splitters: list[Row]) -> Column:
    """How many splitters are not above a row's ``cols``: non-decreasing along them, so a bucket for
    :func:`bucketed_rank`. A binary search in nested comparisons."""
    kinds = [df.schema[c].dataType for c in cols]
    key = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("bigint")
        middle = (low + high) // 2
        cut = F.struct(*[F.lit(v).cast(k).alias(f"c{i}") for i, (v, k) in enumerate(zip(splitters[middle], kinds))])
        return F.when(key < cut, search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(splitters))


def fixed_batches(
    df: DataFrame,
    key: str,
    batch_size: int,
    *,
    seed: int | None = None,
    digits: int | None = None,
    batch_col: str = "batch",
    rank_col: str = "rank",
) -> DataFrame:
    """AG20: consecutive groups of ``batch_size`` rows in a stable order
    (seeded shuffle order when ``seed`` is given, else key order via the md5
    of the key with seed 0); the last batch may be short. The rows are ranked in
    ``16 ** digits`` buckets, by default as many as keep one at about
    ``BUCKET_ROWS`` rows."""
    if digits is None:
        digits = 1
        rows = df.count()
        while rows > BUCKET_ROWS * 16**digits and digits < 8:
            digits += 1
    ranked = hash_rank(df, key, 0 if seed is None else seed, digits=digits, rank_col=rank_col)
    return ranked.withColumn(
        batch_col, F.floor((F.col(rank_col) - 1) / F.lit(int(batch_size))).cast("bigint")
    )


def interval_hit(step: Column, interval) -> Column:
    """FP5: ``interval > 0 and step % interval == 0``; 0 / NULL disables."""
    iv = interval if isinstance(interval, Column) else F.lit(interval)
    return F.coalesce((iv > 0) & (F.try_mod(step, iv) == 0), F.lit(False))
