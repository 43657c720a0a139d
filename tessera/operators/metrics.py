"""Classification metrics: overall (support-weighted), per class and per slice.

All metrics start from one aggregate, ``groupBy(y_true, y_pred).count()``:
map-side combine shrinks any input to at most k*k rows before the shuffle,
so the rest runs on a table the size of the label set squared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _safe_div(num: Column, den: Column) -> Column:
    """Zero denominator -> 0 (the reference's zero_division behaviour)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_counts(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """AG4: ``(label, tp, n_pred, support)`` over labels in truth ∪ prediction."""
    pairs = scored.groupBy(F.col(y_true).alias("t"), F.col(y_pred).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("t").alias("label"),
                    F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("tp"),
                    F.lit(0).cast("bigint").alias("n_pred"),
                    F.col("n").alias("support"),
                ),
                F.struct(
                    F.col("p").alias("label"),
                    F.lit(0).cast("bigint").alias("tp"),
                    F.col("n").alias("n_pred"),
                    F.lit(0).cast("bigint").alias("support"),
                ),
            )
        )
    )
    return sides.groupBy("label").agg(
        F.sum("tp").cast("bigint").alias("tp"),
        F.sum("n_pred").cast("bigint").alias("n_pred"),
        F.sum("support").cast("bigint").alias("support"),
    )


def per_label_prf(counts: DataFrame) -> DataFrame:
    p = _safe_div(F.col("tp"), F.col("n_pred"))
    r = _safe_div(F.col("tp"), F.col("support"))
    return (
        counts.withColumn("precision", p)
        .withColumn("recall", r)
        .withColumn(
            "f1",
            _safe_div(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
    )


def overall_metrics(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """AG5: support-weighted precision / recall / F1 (F1 is the weighted mean
    of class F1s), ``num_samples`` as double."""
    prf = per_label_prf(confusion_counts(scored, y_true, y_pred))
    s = F.col("support").cast("double")
    tot = F.sum(s)
    return prf.agg(
        _safe_div(F.sum(s * F.col("precision")), tot).alias("precision"),
        _safe_div(F.sum(s * F.col("recall")), tot).alias("recall"),
        _safe_div(F.sum(s * F.col("f1")), tot).alias("f1"),
        tot.alias("num_samples"),
    )


def per_class_metrics(
    scored: DataFrame,
    classes: DataFrame,
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    label_col: str = "tag",
    index_col: str = "class_index",
) -> DataFrame:
    """AG6 + SK4: one row per class of the fitted class table (absent classes
    get zeros, quirk Q4), ``rank`` = order by F1 descending, class index."""
    prf = per_label_prf(confusion_counts(scored, y_true, y_pred))
    joined = classes.select(F.col(label_col).alias("label"), F.col(index_col).alias("class_index")).join(
        prf, on="label", how="left"
    )
    out = joined.select(
        F.col("label").alias("class"),
        F.col("class_index").cast("bigint").alias("class_index"),
        F.coalesce("precision", F.lit(0.0)).alias("precision"),
        F.coalesce("recall", F.lit(0.0)).alias("recall"),
        F.coalesce("f1", F.lit(0.0)).alias("f1"),
        F.coalesce(F.col("support"), F.lit(0)).cast("double").alias("num_samples"),
    )
    # The class table is bounded by the label set: a global window is fine here.
    w = Window.orderBy(F.col("f1").desc(), F.col("class_index"))
    return out.withColumn("rank", F.row_number().over(w).cast("bigint"))


def slice_flags(df: DataFrame, slices: dict[str, Column], key: str) -> DataFrame:
    """FP13: long form ``(key, slice)`` of every row that is in a slice."""
    names = F.array(*[F.when(c, F.lit(name)) for name, c in slices.items()])
    return df.select(F.col(key), F.explode(F.filter(names, lambda x: x.isNotNull())).alias("slice"))


def slice_metrics(
    scored: DataFrame,
    slices: dict[str, Column],
    y_true: str = "y_true",
    y_pred: str = "y_pred",
) -> DataFrame:
    """AG7: micro P/R/F1 per non-empty slice. For single-label predictions the
    micro averages all equal accuracy; ``num_samples`` is an integer."""
    names = F.array(*[F.when(c, F.lit(name)) for name, c in slices.items()])
    long = scored.select(
        F.explode(F.filter(names, lambda x: x.isNotNull())).alias("slice"),
        (F.col(y_true) == F.col(y_pred)).cast("int").alias("hit"),
    )
    acc = F.avg("hit").cast("double")
    return long.groupBy("slice").agg(
        acc.alias("precision"),
        acc.alias("recall"),
        acc.alias("f1"),
        F.count(F.lit(1)).cast("bigint").alias("num_samples"),
    )


def metric_rows(
    scored: DataFrame,
    classes: DataFrame,
    slices: dict[str, Column],
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    label_col: str = "tag",
    index_col: str = "class_index",
) -> DataFrame:
    """AG8 (flat form): ``(scope, key, precision, recall, f1, num_samples)``."""
    cols = ["precision", "recall", "f1"]
    o = overall_metrics(scored, y_true, y_pred).select(
        F.lit("overall").alias("scope"), F.lit("overall").alias("key"), *cols, "num_samples"
    )
    c = per_class_metrics(scored, classes, y_true, y_pred, label_col, index_col).select(
        F.lit("per_class").alias("scope"), F.col("class").alias("key"), *cols, "num_samples"
    )
    s = slice_metrics(scored, slices, y_true, y_pred).select(
        F.lit("slices").alias("scope"),
        F.col("slice").alias("key"),
        *cols,
        F.col("num_samples").cast("double").alias("num_samples"),
    )
    return o.unionByName(c).unionByName(s)


def metric_cube(
    scored: DataFrame,
    classes: DataFrame,
    slices: dict[str, Column],
    y_true: str = "y_true",
    y_pred: str = "y_pred",
    label_col: str = "tag",
    index_col: str = "class_index",
) -> DataFrame:
    """AG5-AG8 from one scan: the rows of :func:`metric_rows` and their ``place`` (class index or slice number).

    The scan is counted per (truth, prediction, slices), at most k * k * 2^s
    rows. From there on one plan without branches: grouping sets over label and
    slice give the counts of both, a second pair of grouping sets the weighted
    means over all labels.
    """
    member = F.filter(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(slices.values())]), lambda x: x.isNotNull())
    counted = scored.select(F.col(y_true).alias("t"), F.col(y_pred).alias("p"), (member if slices else F.array().cast("array<int>")).alias("member"))
    counted = counted.groupBy("t", "p", "member").agg(F.count(F.lit(1)).alias("n"))
    none, hit = F.lit(0).cast("bigint"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    sides = counted.select(
        F.explode(F.concat(F.array(F.lit(-1)), "member")).alias("slice"), "t", "p", "n"  # -1: all rows
    ).select(
        "slice",
        F.inline(
            F.array(
                F.struct(F.col("t").alias("label"), hit.alias("tp"), none.alias("n_pred"), F.col("n").alias("support")),
                F.struct(F.col("p").alias("label"), none.alias("tp"), F.col("n").alias("n_pred"), none.alias("support")),
            )
        ),
    )
    whole = F.col("slice") == -1
    cube = sides.withColumn("in_all", whole).groupingSets([["label"], ["slice"]], "label", "slice").agg(
        F.grouping("label").alias("of_slice"),
        *[F.sum(F.when(F.col("in_all"), F.col(c))).alias(f"{c}_all") for c in ("tp", "n_pred", "support")],
        *[F.sum(c).alias(c) for c in ("tp", "support")],
    )
    names = F.create_map(*[x for i, n in enumerate(slices) for x in (F.lit(i), F.lit(n))]) if slices else F.create_map(F.lit(0), F.lit(""))
    of_slice = F.col("of_slice") == 1
    rows = cube.where(~of_slice | (F.col("slice") >= 0)).select(
        F.when(of_slice, "slices").otherwise("per_class").alias("scope"),
        F.when(of_slice, names[F.col("slice")]).otherwise(F.col("label")).alias("key"),
        F.col("slice").alias("slice_no"),
        *[F.when(of_slice, F.col("tp" if c == "tp" else "support")).otherwise(F.col(f"{c}_all")).alias(c) for c in ("tp", "n_pred", "support")],
    )
    fitted = classes.select(F.lit("per_class").alias("scope"), F.col(label_col).cast("string").alias("key"), F.col(index_col).cast("bigint").alias("class_no"))
    both = rows.join(fitted, ["scope", "key"], "full_outer")
    counts = ["tp", "n_pred", "support"]
    prf = per_label_prf(both.select("scope", "key", F.coalesce("class_no", F.col("slice_no").cast("bigint")).alias("place"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]))
    s = F.col("support").cast("double")
    sums = prf.groupingSets([["scope", "key", "place"], ["scope"]], "scope", "key", "place").agg(
        F.grouping("place").alias("total"),
        *[_safe_div(F.sum(s * F.col(c)), F.sum(s)).alias(c) for c in ("precision", "recall", "f1")],
        F.sum(s).alias("num_samples"),
    )
    total = F.col("total") == 1
    kept = sums.where((total & (F.col("scope") == "per_class") & (F.col("num_samples") > 0)) | (~total & F.col("place").isNotNull()))
    return kept.select(
        F.when(total, "overall").otherwise(F.col("scope")).alias("scope"),
        F.when(total, "overall").otherwise(F.col("key")).alias("key"),
        "precision", "recall", "f1", "num_samples", "place",
    )


def evaluation_document(rows: DataFrame, *, timestamp: Column, run_id: Column, eval_run_id: Column) -> DataFrame:
    """AG8 + SC14: one row ``timestamp, run_id, eval_run_id, metrics`` of the rows of :func:`metric_cube`.

    ``metrics`` is ``overall`` and the maps ``per_class``, best F1 first and
    then in class order, and ``slices`` in their order. Bounded by the label set.
    """
    m = F.struct("precision", "recall", "f1", "num_samples")
    first = F.when(F.col("scope") == "per_class", -F.col("f1")).otherwise(F.lit(0.0))

    def nested(scope: str) -> Column:
        mine = F.filter("all", lambda e: e.scope == scope)
        return F.map_from_entries(F.transform(mine, lambda e: F.struct(e.key, e.m)))

    every = F.array_sort(F.collect_list(F.struct("scope", first.alias("first"), "place", "key", m.alias("m")))).alias("all")
    metrics = F.struct(nested("overall")["overall"].alias("overall"), nested("per_class").alias("per_class"), nested("slices").alias("slices"))
    return rows.agg(every).select(
        timestamp.alias("timestamp"), run_id.alias("run_id"), eval_run_id.alias("eval_run_id"), metrics.alias("metrics")
    )


def document_rows(documents: DataFrame) -> DataFrame:
    """Documents as rows again: the run fields, ``scope``, ``position``, ``key`` and the metrics, in the document's order."""
    run = ["timestamp", "run_id", "eval_run_id"]
    scopes = [F.create_map(F.lit("overall"), F.col("metrics.overall")), F.col("metrics.per_class"), F.col("metrics.slices")]
    parts = [
        documents.select(*run, F.lit(n).alias("scope"), F.posexplode(s).alias("position", "key", "m"))
        for n, s in zip(("overall", "per_class", "slices"), scopes)
    ]
    return reduce(DataFrame.unionByName, parts).select(*run, "scope", "position", "key", "m.*")


def join_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """JN7 strict check: keys matched, only-left and only-right counts (one
    full outer join of the distinct keys, one aggregate row)."""
    lk = left.select(key).distinct().withColumn("__l", F.lit(True))
    rk = right.select(key).distinct().withColumn("__r", F.lit(True))
    j = lk.join(rk, key, "full_outer")
    return j.agg(
        F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).cast("bigint").alias("n_matched"),
        F.count_if(F.col("__r").isNull()).cast("bigint").alias("n_only_left"),
        F.count_if(F.col("__l").isNull()).cast("bigint").alias("n_only_right"),
    )
