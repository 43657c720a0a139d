"""Deterministic, partition-independent randomness.

``rand(seed)`` depends on the partition layout, so every random decision here
is a pure function of a key: ``md5(key ':' seed)``. The same hex string comes
out of DuckDB's ``md5``, which makes splits, samples and noise oracle-checkable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2**52)


def _as_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def hash_hex(keys, seed) -> Column:
    """``md5(k1 ':' k2 ':' ... ':' seed)`` as a 32-digit hex string (NULL-propagating)."""
    parts: list[Column] = []
    for k in _as_cols(keys if isinstance(keys, (list, tuple)) else [keys]):
        parts += [k.cast("string"), F.lit(":")]
    parts.append(F.lit(str(seed)))
    return F.md5(F.concat(*parts))


def hex_uniform(hex_col: Column, start: int = 1, offset: float = 0.0) -> Column:
    """Uniform in [0, 1) from 13 hex digits (52 bits) of ``hex_col`` at 1-based ``start``."""
    bits = F.conv(F.substring(hex_col, start, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + F.lit(offset)) / F.lit(TWO_POW_52)


def hash_uniform(keys, seed) -> Column:
    return hex_uniform(hash_hex(keys, seed))


def hash_gaussian(keys, seed) -> Column:
    """Standard normal draw by Box-Muller over two independent 52-bit uniforms."""
    h = hash_hex(keys, seed)
    u1 = hex_uniform(h, 1, 0.5)  # in (0, 1): log is finite
    u2 = hex_uniform(h, 14)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def sql_hash_hex(keys: list[str], seed) -> str:
    """DuckDB spelling of :func:`hash_hex` (used by oracle SQL)."""
    parts = " || ':' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5({parts} || ':' || '{seed}')"


def sql_hex_uniform(hex_expr: str, start: int = 1, offset: float = 0.0) -> str:
    return (
        f"((('0x' || substr({hex_expr}, {start}, 13))::BIGINT)::DOUBLE + {offset}::DOUBLE)"
        f" / 4503599627370496::DOUBLE"
    )


def sql_hash_gaussian(keys: list[str], seed) -> str:
    h = sql_hash_hex(keys, seed)
    return (
        f"(sqrt(-2.0::DOUBLE * ln({sql_hex_uniform(h, 1, 0.5)}))"
        f" * cos({2.0 * math.pi!r}::DOUBLE * {sql_hex_uniform(h, 14)}))"
    )
