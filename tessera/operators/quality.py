"""Data-quality expectations as one DataFrame of check results (DQ1-DQ7).

Each expectation yields ``(expectation, column, success, unexpected_count)``.
A suite (:func:`compile_suite`) reads its table twice, however many checks it
has: all set and null checks are columns of one aggregate, and all uniqueness
checks share one shuffle of (check, digest of the columns). Schema checks read
only the schema. The single checks remain for use on their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed names of the expectations.
COLUMNS_MATCH = "expect_table_columns_to_match_ordered_list"
IN_SET = "expect_column_values_to_be_in_set"
NOT_NULL = "expect_column_values_to_not_be_null"
COMPOUND_UNIQUE = "expect_compound_columns_to_be_unique"
UNIQUE = "expect_column_values_to_be_unique"
OF_TYPE = "expect_column_values_to_be_of_type"

RESULT_SCHEMA = "expectation string, column string, success boolean, unexpected_count bigint"

_TYPE_NAMES = {"str": T.StringType, "int": (T.IntegerType, T.LongType), "float": (T.FloatType, T.DoubleType)}


def _row(spark: SparkSession, name: str, column: str, success: bool, unexpected: int = 0) -> DataFrame:
    return spark.createDataFrame([(name, column, success, unexpected)], RESULT_SCHEMA)


def _from_count(count_df: DataFrame, name: str, column: str) -> DataFrame:
    c = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return count_df.select(
        F.lit(name).alias("expectation"), F.lit(column).alias("column"), (c == 0).alias("success"),
        c.alias("unexpected_count"),
    )


def columns_match_ordered_list(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ1."""
    return _row(df.sparkSession, "expect_table_columns_to_match_ordered_list", ",".join(columns), df.columns == columns)


def values_in_set(df: DataFrame, column: str, value_set: list) -> DataFrame:
    """DQ2: non-null values outside the set (nulls are ignored)."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*value_set)
    return _from_count(df.agg(F.count_if(bad).alias("n")), "expect_column_values_to_be_in_set", column)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """DQ4."""
    return _from_count(df.agg(F.count_if(F.col(column).isNull()).alias("n")), "expect_column_values_to_not_be_null", column)


def _dup_rows(df: DataFrame, cols: list[str], skip_all_null: bool) -> DataFrame:
    g = df.select(*cols)
    if skip_all_null:
        g = g.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols]))
    counts = g.groupBy(*cols).agg(F.count(F.lit(1)).alias("k"))
    return counts.agg(F.sum(F.when(F.col("k") > 1, F.col("k")).otherwise(F.lit(0))).alias("n"))


def compound_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ3: rows whose column combination occurs more than once (rows with
    every column NULL are skipped)."""
    return _from_count(_dup_rows(df, columns, True), "expect_compound_columns_to_be_unique", ",".join(columns))


def unique(df: DataFrame, column: str) -> DataFrame:
    """DQ5: every row of a duplicated value counts as unexpected (NULLs skipped)."""
    return _from_count(_dup_rows(df, [column], True), "expect_column_values_to_be_unique", column)


def of_type(df: DataFrame, column: str, type_: str) -> DataFrame:
    """DQ6: column type check against a Python-style type name."""
    want = _TYPE_NAMES[type_]
    ok = isinstance(df.schema[column].dataType, want)
    return _row(df.sparkSession, "expect_column_values_to_be_of_type", column, ok)


def run_suite(df: DataFrame, checks: list[DataFrame]) -> DataFrame:
    """DQ7: union of all check rows."""
    return reduce(DataFrame.unionByName, checks)


def suite_result(results: DataFrame, only_failures: bool = False) -> DataFrame:
    """DQ7: overall success and the failure count (or just the failing rows)."""
    if only_failures:
        return results.where(~F.col("success"))
    return results.agg(
        F.bool_and("success").alias("success"),
        F.count_if(~F.col("success")).cast("bigint").alias("n_failed"),
        F.count(F.lit(1)).cast("bigint").alias("n_checks"),
    )


def _digest(df: DataFrame, cols: list[str]) -> Column:
    """A digest that tells any two combinations apart: each value with its length, NULL as a value of its own.

    Equal numbers have equal digests: -0.0 is 0.0, NaN is NaN. Nested columns go in as JSON.
    """
    parts = []
    for c in cols:
        kind, value = df.schema[c].dataType, F.col(c)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            value = F.when(value == 0, F.lit(0.0)).otherwise(value)
        text = F.to_json(F.struct(value)) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def compile_suite(df: DataFrame, suite: list[tuple]) -> DataFrame:
    """DQ7: the results of ``suite``, a list of
    ``(COLUMNS_MATCH, [column...])``, ``(IN_SET, column, [value...])``,
    ``(NOT_NULL, column)``, ``(UNIQUE, column)``, ``(COMPOUND_UNIQUE, [column...])``
    and ``(OF_TYPE, column, type name)``.

    Semantics are those of the single checks. An empty table passes all checks
    of values. A check of a column that is not there fails to compile.
    """
    fixed: list[tuple] = []
    counts: list[tuple[str, str, Column]] = []
    keys: list[tuple[str, str, list[str]]] = []
    for name, what, *more in suite:
        if name == COLUMNS_MATCH:
            fixed.append((name, ",".join(what), df.columns == what, 0))
        elif name == OF_TYPE:
            fixed.append((name, what, isinstance(df.schema[what].dataType, _TYPE_NAMES[more[0]]), 0))
        elif name == IN_SET:
            counts.append((name, what, F.col(what).isNotNull() & ~F.col(what).isin(*more[0])))
        elif name == NOT_NULL:
            counts.append((name, what, F.col(what).isNull()))
        elif name in (UNIQUE, COMPOUND_UNIQUE):
            cols = [what] if isinstance(what, str) else list(what)
            keys.append((name, ",".join(cols), cols))
        else:
            raise ValueError(f"no such expectation: {name}")

    def results(one: DataFrame, checks: list) -> DataFrame:
        n = [F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("bigint") for i in range(len(checks))]
        rows = [
            F.struct(F.lit(c[0]).alias("expectation"), F.lit(c[1]).alias("column"), (k == 0).alias("success"), k.alias("unexpected_count"))
            for c, k in zip(checks, n)
        ]
        return one.select(F.inline(F.array(*rows)))

    parts = [df.sparkSession.createDataFrame(fixed, RESULT_SCHEMA)] if fixed else []
    if counts:
        parts.append(results(df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(counts)]), counts))
    if keys:
        each = [
            F.struct(F.lit(i).alias("check"), F.when(reduce(Column.__or__, [F.col(c).isNotNull() for c in cols]), _digest(df, cols)).alias("digest"))
            for i, (_, _, cols) in enumerate(keys)
        ]
        found = df.select(F.inline(F.array(*each))).where(F.col("digest").isNotNull())
        more = found.groupBy("check", "digest").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        one = more.agg(*[F.sum(F.when(F.col("check") == i, F.col("k"))).alias(f"n{i}") for i in range(len(keys))])
        parts.append(results(one, keys))
    return reduce(DataFrame.unionByName, parts)


def default_text_suite(df: DataFrame, tags: list[str]) -> DataFrame:
    """The labelled-text suite: schema, label set, leakage, nulls, ids, types."""
    return compile_suite(
        df,
        [
            (COLUMNS_MATCH, ["id", "created_on", "title", "description", "tag", "text"]),
            (IN_SET, "tag", tags),
            (COMPOUND_UNIQUE, ["title", "description"]),
            (NOT_NULL, "tag"),
            (UNIQUE, "id"),
            (OF_TYPE, "title", "str"),
        ],
    )
