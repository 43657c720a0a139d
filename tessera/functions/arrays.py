"""Array column expressions (higher-order functions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_double_array(arr) -> Column:
    """float32 elements -> double before any arithmetic."""
    return F.transform(_c(arr), lambda x: x.cast("double"))


def argmax(arr) -> Column:
    """AR1: 0-based index of the first maximum (NaN counts as the maximum)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("bigint")


def thresholded_argmax(arr, threshold: float, fallback: int) -> Column:
    """AR2: argmax when ``max > threshold`` (strict), else ``fallback``."""
    a = _c(arr)
    return F.when(F.array_max(a) > F.lit(threshold), argmax(a)).otherwise(F.lit(fallback).cast("bigint"))


def one_hot(index, k: int) -> Column:
    """AR3: length-``k`` 0/1 double vector with a 1 at ``index``."""
    i = _c(index)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: (j == i).cast("double"))


def one_hot_decode(arr, start: int, length: int) -> Column:
    """AR4: argmax of ``slice(arr, start, length)`` (1-based start)."""
    return argmax(F.slice(_c(arr), start, length))


def pad_to(arr, length, pad_value=0, dtype: str = "bigint") -> Column:
    """AR5: right-pad with ``pad_value`` to ``length``."""
    a = _c(arr)
    n = F.greatest(_c(length) - F.size(a), F.lit(0))
    return F.concat(a.cast(f"array<{dtype}>"), F.array_repeat(F.lit(pad_value).cast(dtype), n))


def pad_mask(arr, length) -> Column:
    """AR6: 1 for a real element, 0 for padding, ``length`` long."""
    a = _c(arr)
    n = F.greatest(_c(length) - F.size(a), F.lit(0))
    return F.concat(F.array_repeat(F.lit(1), F.size(a)), F.array_repeat(F.lit(0), n))


def vsub(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x - y)


def vadd(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def vscale(a, s) -> Column:
    s = s if isinstance(s, Column) else F.lit(s)
    return F.transform(_c(a), lambda x: x * s)


def sq_norm(a) -> Column:
    """Sum of squares of the elements."""
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x)


def sq_error(a, b) -> Column:
    """SM9: sum over dims of ``(a - b)^2``."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)


def vsum(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x)


def normalize(a, mean, std) -> Column:
    """SM1: ``(v - mean) / std`` per component (arrays of equal length)."""
    return F.zip_with(F.zip_with(_c(a), _c(mean), lambda x, m: x - m), _c(std), lambda d, s: d / s)


def unnormalize(a, mean, std) -> Column:
    """SM2: ``v * std + mean`` per component."""
    return F.zip_with(F.zip_with(_c(a), _c(std), lambda x, s: x * s), _c(mean), lambda d, m: d + m)
