"""Joins whose large side has keys that hold a large share of its rows (JN4, UD9).

``heavy_hitters`` finds such keys in one pass with a frequency sketch that is
merged over tasks, ``spread_join`` joins in two levels: rows of a heavy key are
dealt to salts, and only the rows of the small side that have a heavy key are
copied to the salts of that key. All other rows keep salt 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HASH, _SALTS, _SALT = "__key_hash", "__salts", "__salt"
#: Counters of the sketch for each key that can be heavy: an estimate is off by
#: at most about 1 / (0.75 * SLOTS) of the threshold.
SLOTS = 16
#: Salts are sized so that one holds at most this part of a mean partition.
PART = 0.25


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _slots(share: float) -> tuple[int, int]:
    """How many keys can be that heavy, and the counters of the sketch."""
    most = min(50_000, int(1 / share) + 1)
    return most, min(1_000_000, SLOTS * most)


def _candidates(df: DataFrame, keys: list[str], share: float) -> tuple[int, dict[int, int]]:
    """The rows of ``df`` and, by key hash, the estimated rows of every key
    that may hold ``share`` of them (and of some below)."""
    most, slots = _slots(share)
    hashed = df.select(key_hash(keys).alias(_HASH))
    top = F.expr(f"approx_top_k({_HASH}, {2 * most}, {slots})")
    total, found = hashed.agg(F.count("*"), top).first()
    error = total / (0.75 * slots)
    return total, {r[0]: r[1] for r in found or [] if r[1] + error >= share * total}


def heavy_hitters(df: DataFrame, keys: list[str] | str, share: float) -> DataFrame:
    """``(keys..., n)``: keys with at least ``share`` of all rows, and their
    exact counts.

    One pass fills the sketches; the few candidates are then counted exactly.
    At most ``1 / share`` keys come out. NULL is a key like any other. An empty
    table gives no rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    total, found = _candidates(df, keys, share)
    counted = df.where(key_hash(keys).isin(list(found))).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= F.lit(share * total))


def salts_of(df: DataFrame, keys: list[str] | str, share: float | None = None) -> DataFrame | None:
    """``(__key_hash, __salts)`` of the heavy keys of ``df``, or None without any.

    A key is heavy from ``share`` of the rows, by default half of a mean
    shuffle partition. The table has at most about ``2 / share`` rows, so it may
    be broadcast whatever the size of ``df``. Two keys of one hash are both
    salted, which changes no result.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = _partitions(df)
    share = share or 0.5 / parts
    total, found = _candidates(df, keys, share)
    rows = [(h, salts) for h, n in found.items() if (salts := -(-n * parts // max(1, int(total * PART)))) > 1]
    return df.sparkSession.createDataFrame(rows, f"{_HASH} long, {_SALTS} int") if rows else None


def large_groups(df: DataFrame, keys: list[str], most: int) -> list[int]:
    """The :func:`key_hash` of every group of ``df`` with more than ``most``
    rows (or, of a table so large that these would not fit a list, with more
    than a 50,000th of it), and of some just below."""
    total = df.count()
    if total <= most:
        return []
    return list(_candidates(df, keys, max(most / total, 1 / 50_000))[1])


def spread_join(large: DataFrame, small: DataFrame, on: list[str] | str, salts: DataFrame | None, how: str = "inner") -> DataFrame:
    """``large.join(small, on, how)`` for inner and left joins, with the heavy
    keys of ``large`` given by :func:`salts_of` dealt over their salts.

    A row's salt is a hash of all its columns, so a task that is run again
    deals alike. Rows that are equal in every column share a salt; where these
    alone fill a partition, Spark's own splitting of skewed joins remains.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if salts is None:
        return large.join(small, on=keys, how=how)
    few = F.broadcast(salts)  # at most about 2 / share rows
    dealt = large.withColumn(_HASH, key_hash(keys)).join(few, on=_HASH, how="left")
    dealt = dealt.withColumn(_SALT, F.coalesce(F.pmod(F.xxhash64(*large.columns), F.col(_SALTS)), F.lit(0)).cast("int"))
    copies = small.withColumn(_HASH, key_hash(keys)).join(few, on=_HASH, how="left")
    copies = copies.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)))
    return dealt.drop(_HASH, _SALTS).join(copies.drop(_HASH, _SALTS), on=[*keys, _SALT], how=how).drop(_SALT)
