"""Particle-trajectory operators in long form.

A trajectory table has one row per ``(traj_id, particle, frame)`` with
``pos array<double>``. Internally positions are exploded to one row per
dimension; differences use frame buckets with halo rows and running sums are
bucketed prefix sums, so no operator ever sorts a whole trajectory in one
task, however long one particle's history is. Windows are built by exploding each
frame into the windows that contain it and grouping by window key (at most
``window_length`` rows per group).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_gaussian
from tessera.operators.core import with_starts

KEYS = ["traj_id", "particle"]
FRAME_BUCKET = 1024


def to_long(traj: DataFrame, pos: str = "pos") -> DataFrame:
    """``(traj_id, particle, frame, d, x)`` with ``d`` 0-based."""
    return traj.select(*KEYS, "frame", F.posexplode(pos).alias("d", "x")).withColumn("d", F.col("d").cast("int"))


def to_wide(long: DataFrame, value: str, out: str, keys: list[str] | None = None) -> DataFrame:
    """Re-assemble per-dimension rows into ``array<double>`` ordered by d
    (each group holds ``dim`` rows)."""
    keys = keys or KEYS + ["frame"]
    return long.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("d", F.col(value).alias("v")))), lambda s: s["v"]).alias(out)
    )


def neighbours(long: DataFrame, *, back: int = 1, forward: int = 1, value: str = "x",
               bucket_width: int = FRAME_BUCKET) -> DataFrame:
    """Add ``prev_k`` (value at ``frame - k``, k <= back) and ``next_k``
    (``frame + k``, k <= forward) to each long row, NULL when that frame does
    not exist.

    One shuffle, no hot partition: rows are bucketed by frame; a row near the
    end of its bucket is also copied into the next bucket (and one near the
    start into the previous bucket) as a halo row, then ``lag`` / ``lead`` run
    inside (track, dimension, bucket) and halo rows are dropped. A frame's
    neighbour is accepted only when its frame number is exactly ``frame ± k``."""
    B = bucket_width
    if back >= B or forward >= B:
        raise ValueError("neighbour distance must be smaller than the bucket width")
    b = F.floor(F.col("frame") / F.lit(B)).cast("bigint")
    pos = F.col("frame") - b * F.lit(B)
    targets = F.array(
        F.struct(b.alias("bucket"), F.lit(False).alias("halo")),
        F.when(pos >= F.lit(B - back), F.struct((b + 1).alias("bucket"), F.lit(True).alias("halo"))),
        F.when(pos < F.lit(forward), F.struct((b - 1).alias("bucket"), F.lit(True).alias("halo"))),
    )
    rows = long.select("*", F.explode(F.filter(targets, lambda t: t.isNotNull())).alias("__t")).select(
        *long.columns, F.col("__t.bucket").alias("__b"), F.col("__t.halo").alias("__halo")
    )
    w = Window.partitionBy(*KEYS, "d", "__b").orderBy("frame")
    for k in range(1, back + 1):
        ok = F.lag("frame", k).over(w) == F.col("frame") - k
        rows = rows.withColumn(f"prev_{k}", F.when(ok, F.lag(value, k).over(w)))
    for k in range(1, forward + 1):
        ok = F.lead("frame", k).over(w) == F.col("frame") + k
        rows = rows.withColumn(f"next_{k}", F.when(ok, F.lead(value, k).over(w)))
    return rows.where(~F.col("__halo")).drop("__b", "__halo")


def velocity(long: DataFrame) -> DataFrame:
    """WN3: ``v[t] = x[t] - x[t-1]`` for t >= 1."""
    n = neighbours(long, back=1, forward=0)
    return n.where(F.col("prev_1").isNotNull()).select(*KEYS, "frame", "d", (F.col("x") - F.col("prev_1")).alias("v"))


def acceleration(long: DataFrame) -> DataFrame:
    """WN6 (noise-free): ``a[t] = x[t+1] - 2 x[t] + x[t-1]`` at interior frames."""
    n = neighbours(long, back=1, forward=1)
    return n.where(F.col("prev_1").isNotNull() & F.col("next_1").isNotNull()).select(
        *KEYS, "frame", "d", (F.col("next_1") - 2.0 * F.col("x") + F.col("prev_1")).alias("a")
    )


def acc_stats(acc: DataFrame, value: str = "a") -> DataFrame:
    """Domain metadata ``acc_mean`` / ``acc_std`` per dimension (population
    std). One row per dimension: bounded, safe to broadcast (JN8)."""
    return acc.groupBy("d").agg(
        F.avg(value).alias("acc_mean"),
        F.sqrt(F.greatest(F.avg(F.col(value) * F.col(value)) - F.avg(value) ** 2, F.lit(0.0))).alias("acc_std"),
    )


def normalize_acc(acc: DataFrame, stats: DataFrame, noise_std: float, value: str = "a", out: str = "a_norm") -> DataFrame:
    """SM4: ``(a - mean) / sqrt(std^2 + noise^2)``."""
    scale = F.sqrt(F.col("acc_std") ** 2 + F.lit(noise_std) ** 2)
    return acc.join(F.broadcast(stats), on="d").withColumn(out, (F.col(value) - F.col("acc_mean")) / scale).drop(
        "acc_mean", "acc_std"
    )


def denormalize_acc(acc: DataFrame, stats: DataFrame, noise_std: float, value: str = "a_norm", out: str = "a") -> DataFrame:
    """SM4 inverse: ``a_norm * sqrt(std^2 + noise^2) + mean``."""
    scale = F.sqrt(F.col("acc_std") ** 2 + F.lit(noise_std) ** 2)
    return acc.join(F.broadcast(stats), on="d").withColumn(out, F.col(value) * scale + F.col("acc_mean")).drop(
        "acc_mean", "acc_std"
    )


def lengths(traj: DataFrame) -> DataFrame:
    """Frames per (traj, particle) (frames are 0..T-1)."""
    return traj.groupBy(*KEYS).agg((F.max("frame") + 1).cast("bigint").alias("T"))


def window_counts(traj: DataFrame, window_length: int) -> DataFrame:
    """WN1: ``max(T - L + 1, 0)`` windows per particle track."""
    return lengths(traj).withColumn("n_windows", F.greatest(F.col("T") - window_length + 1, F.lit(0)).cast("bigint"))


def materialize_windows(traj: DataFrame, window_length: int, pos: str = "pos",
                        bucket_width: int = FRAME_BUCKET) -> DataFrame:
    """WN2 + AR9 + AR10: one row per window ``(traj_id, particle, start)`` with
    ``hist`` (L-1 positions, oldest first) and ``target`` (the L-th).

    One shuffle of about the input size: frames are bucketed per track, the
    first L-1 frames of each bucket are also copied into the previous bucket
    (halo), and ``collect_list`` over the next L rows inside (track, bucket)
    yields each window; windows that run past the end of a track (or over a
    missing frame) are dropped."""
    L = window_length
    B = bucket_width
    if L > B:
        raise ValueError("window longer than the frame bucket")
    b = F.floor(F.col("frame") / F.lit(B)).cast("bigint")
    p = F.col("frame") - b * F.lit(B)
    targets = F.array(
        F.struct(b.alias("bucket"), F.lit(False).alias("halo")),
        F.when(p < F.lit(L - 1), F.struct((b - 1).alias("bucket"), F.lit(True).alias("halo"))),
    )
    rows = traj.select(*KEYS, "frame", pos, F.explode(F.filter(targets, lambda t: t.isNotNull())).alias("__t"))
    w = Window.partitionBy(*KEYS, "__t.bucket").orderBy("frame").rowsBetween(0, L - 1)
    win = rows.select(
        *KEYS, "frame", F.col("__t.halo").alias("__halo"),
        F.collect_list(F.struct(F.col("frame").alias("f"), F.col(pos).alias("p"))).over(w).alias("w"),
    )
    full = win.where(
        ~F.col("__halo") & (F.size("w") == L) & (F.col("w")[L - 1]["f"] == F.col("frame") + F.lit(L - 1))
    )
    return full.select(
        *KEYS,
        F.col("frame").cast("bigint").alias("start"),
        F.transform(F.slice("w", 1, L - 1), lambda s: s["p"]).alias("hist"),
        F.col("w")[L - 1]["p"].alias("target"),
    )


def window_velocities(hist: Column) -> Column:
    """Per window: ``hist[j+1] - hist[j]`` for j = 0..L-3 (arrays of vectors)."""
    n = F.size(hist)
    return F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda j: F.zip_with(F.element_at(hist, j + 1), F.element_at(hist, j), lambda a, b: a - b),
    )


def flatten_time_major(seq: Column) -> Column:
    """AR8: ``[T, dim]`` -> flat ``T*dim`` vector, time-major."""
    return F.flatten(seq)


def random_walk_noise(windows: DataFrame, window_length: int, dim: int, noise_std: float, seed: int = 0) -> DataFrame:
    """WN4 + SM8: per window, ``L-1`` position-noise vectors. Velocity noise
    at each of the ``L-2`` steps is iid N(0, (noise_std / sqrt(L-2))^2), keyed
    by ``(traj_id, particle, start, step, d, seed)``; it is summed twice
    along the steps and the first frame gets zero noise.
    Returns long rows ``(traj_id, particle, start, j, d, noise)``, j = 0..L-2."""
    steps = window_length - 2
    sd = noise_std / math.sqrt(steps)
    base = windows.select(*KEYS, "start")
    grid = base.select(
        *KEYS, "start",
        F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("j"),
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(dim - 1))).alias("d"))
    g = grid.withColumn("vn", hash_gaussian(["traj_id", "particle", "start", "j", "d"], seed) * F.lit(sd))
    w = Window.partitionBy(*KEYS, "start", "d").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("vc", F.sum("vn").over(w)).withColumn("noise", F.sum("vc").over(w))
    zeros = base.select(*KEYS, "start", F.lit(0).alias("j"), F.explode(F.sequence(F.lit(0), F.lit(dim - 1))).alias("d"),
                        F.lit(0.0).alias("noise"))
    return g.select(*KEYS, "start", "j", "d", "noise").unionByName(zeros)


def bucketed_cumsum(df: DataFrame, group_cols: list[str], order_col: str, value, out,
                    bucket_width: int = FRAME_BUCKET) -> DataFrame:
    """Running sum(s) of ``value`` (a column name or a list) along the integer
    ``order_col`` within each group, as per-bucket partial sums -> prefix
    offsets on the small bucket table -> local running sums inside each
    (group, bucket). Equal to the plain window sum, but no task ever holds
    more than one bucket of one group. NULL values add nothing (a sum of
    none is 0); NULL group values form a group; rows with a NULL order come
    first."""
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    rows = df.withColumn("__b", F.floor(F.col(order_col) / F.lit(bucket_width)).cast("bigint"))
    rows = rows.withColumns({f"__v{i}": F.col(v) for i, v in enumerate(values)})
    part = rows.groupBy(*group_cols, "__b").agg(*[F.sum(f"__v{i}").alias(f"__s{i}") for i in range(len(values))])
    before = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    kinds = [rows.schema[f"__v{i}"].dataType for i in range(len(values))]
    starts = part.select(
        *group_cols, "__b",
        *[F.coalesce(F.sum(f"__s{i}").over(before), F.lit(0)).cast(kinds[i]).alias(f"__v{i}") for i in range(len(values))],
    )
    upto = Window.partitionBy(*group_cols, "__b").orderBy("__is_row", order_col).rowsBetween(Window.unboundedPreceding, 0)
    made = {o: F.sum(f"__v{i}").over(upto) for i, o in enumerate(outs)}
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a number of its own, as small partitions would be joined to one task for each core, which then sorts that much
    dealt = with_starts(rows, starts).repartition(spread, *group_cols, "__b")
    both = dealt.select("*", *[c.alias(f"__made_{o}") for o, c in made.items()]).where("__is_row")
    return both.select(*[c for c in df.columns if c not in made], *[F.col(f"__made_{o}").alias(o) for o in made])


def integrate(long: DataFrame, acc_pred: DataFrame, seed_frames: int, value: str = "a") -> DataFrame:
    """WN8 + SM6 + SO2: rollout positions from the first ``seed_frames`` true
    frames and predicted (de-normalized) accelerations at later frames:
    ``v[t] = v[t-1] + a[t]``, ``x[t] = x[t-1] + v[t]``, i.e. two running sums.
    Returns ``(traj_id, particle, frame, d, x)`` with seed frames unchanged."""
    W = seed_frames
    seeds = long.where(F.col("frame") < W)
    anchor = (
        long.where(F.col("frame").isin(W - 2, W - 1))
        .groupBy(*KEYS, "d")
        .agg(
            F.max(F.when(F.col("frame") == W - 1, F.col("x"))).alias("x_last"),
            F.max(F.when(F.col("frame") == W - 2, F.col("x"))).alias("x_prev"),
        )
        .where(F.col("x_last").isNotNull() & F.col("x_prev").isNotNull())
    )
    a = acc_pred.where(F.col("frame") >= W).select(*KEYS, "frame", "d", F.col(value).alias("__a"))
    a = bucketed_cumsum(a, KEYS + ["d"], "frame", "__a", "__sum_a")
    a = a.join(anchor, on=KEYS + ["d"]).withColumn("__v", F.col("x_last") - F.col("x_prev") + F.col("__sum_a"))
    a = bucketed_cumsum(a, KEYS + ["d"], "frame", "__v", "__sum_v")
    pred = a.select(*KEYS, "frame", "d", (F.col("x_last") + F.col("__sum_v")).alias("x"))
    return seeds.select(*KEYS, "frame", "d", "x").unionByName(pred)


def rollout_mse(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """AG14: per trajectory, mean over (frame, particle) of the squared error
    summed over dims (seed frames included)."""
    err = pred.withColumnRenamed("x", "xp").join(truth, on=KEYS + ["frame", "d"]).withColumn(
        "se", (F.col("xp") - F.col("x")) ** 2
    )
    per_row = err.groupBy(*KEYS, "frame").agg(F.sum("se").alias("se"))
    return per_row.groupBy("traj_id").agg(F.avg("se").alias("mse"))


def mean_rollout_mse(per_traj: DataFrame) -> DataFrame:
    """AG14: the unweighted mean over trajectories, one row (NULL without any)."""
    return per_traj.agg(F.avg("mse").alias("rollout_mse"), F.count(F.lit(1)).alias("num_trajectories"))


def frame_skip(traj: DataFrame, skip: int) -> DataFrame:
    """FP14: frames ``num * skip`` for ``num < T // skip`` of each track."""
    t = lengths(traj)
    return traj.join(t, on=KEYS).where(
        (F.col("frame") % skip == 0) & (F.floor(F.col("frame") / skip) < F.floor(F.col("T") / skip))
    ).drop("T")


def stats_arrays(stats: DataFrame, dim: int) -> tuple[Column, Column]:
    """Domain metadata (``acc_mean``, ``acc_std`` per dimension) as literal
    array columns: the table has ``dim`` rows, so it is collected once and
    inlined rather than joined to every row."""
    rows = stats.orderBy("d").collect()
    if len(rows) != dim:
        raise ValueError(f"expected {dim} statistics rows, got {len(rows)}")
    return (
        F.array(*[F.lit(float(r["acc_mean"])) for r in rows]),
        F.array(*[F.lit(float(r["acc_std"])) for r in rows]),
    )


def graph_sample_nodes(windows: DataFrame, stats: DataFrame, *, window_length: int, dim: int, noise_std: float,
                       seed: int, radius: float, bounds: list[list[float]]) -> DataFrame:
    """UD10 (node side) + WN5 + WN6 + SM3 + SM4 + AR7 + AR8: per window
    ``(traj_id, particle, start)``:

    * the history positions plus random-walk noise (WN4/WN5),
    * ``recent`` = last noised position,
    * ``vflat`` = noised velocities flattened time-major (AR8),
    * ``boundary`` = clipped distance of ``recent`` to the bounds (SM3),
    * ``y`` = normalized acceleration target
      ``((target + noise_last - recent) - (recent - prev) - mean) / sqrt(std^2 + noise^2)``.

    A window is one row of ``(L-1) * dim`` values; its noise, that of
    :func:`random_walk_noise`, is drawn in the row, so nothing is shuffled."""
    from tessera.operators.graph import boundary_distance

    L = window_length
    keyed = windows
    for c in [*KEYS, "start"]:  # the noise of a window is keyed by these
        keyed = keyed.where(F.col(c).isNotNull())
    sd = noise_std / math.sqrt(L - 2)
    grid = [(j, d) for j in range(1, L - 1) for d in range(dim)]
    draw = {f"__v{j}_{d}": hash_gaussian([*KEYS, "start", F.lit(j), F.lit(d)], seed) * F.lit(sd) for j, d in grid}
    noised = keyed.select(*KEYS, "start", "hist", "target", *[c.alias(k) for k, c in draw.items()])
    for j, d in grid:  # the velocity noise, then its running sum: the order of the steps, as in a window sum
        if j > 1:
            noised = noised.withColumn(f"__v{j}_{d}", F.col(f"__v{j - 1}_{d}") + F.col(f"__v{j}_{d}"))
    for j, d in grid:
        if j > 1:
            noised = noised.withColumn(f"__v{j}_{d}", F.col(f"__v{j - 1}_{d}") + F.col(f"__v{j}_{d}"))
    walked = F.array(F.array(*[F.lit(0.0)] * dim), *[F.array(*[F.col(f"__v{j}_{d}") for d in range(dim)]) for j in range(1, L - 1)])
    noised = noised.select(*KEYS, "start", "hist", "target", walked.alias("noise"))
    add = lambda x, n: F.zip_with(x, n, lambda a, b: a + b)
    per = noised.select(*KEYS, "start", "target", "noise", F.zip_with("hist", "noise", add).alias("xn"))
    recent = F.col("xn")[L - 2]
    prev = F.col("xn")[L - 3]
    pn_last = F.col("noise")[L - 2]
    vflat = flatten_time_major(window_velocities(F.col("xn")))
    acc_mean, acc_std = stats_arrays(stats, dim)
    out = per.select(
        *KEYS, "start", recent.alias("recent"), prev.alias("prev"), pn_last.alias("pn_last"), "target",
        vflat.alias("vflat"), acc_mean.alias("acc_mean"), acc_std.alias("acc_std"),
    )
    next_v = F.zip_with(F.zip_with("target", "pn_last", lambda t, n: t + n), "recent", lambda a, r: a - r)
    last_v = F.zip_with("recent", "prev", lambda r, p: r - p)
    acc = F.zip_with(next_v, last_v, lambda a, b: a - b)
    scale = F.transform("acc_std", lambda s: F.sqrt(s * s + F.lit(noise_std) ** 2))
    y = F.zip_with(F.zip_with(acc, "acc_mean", lambda a, m: a - m), scale, lambda a, s: a / s)
    return out.select(
        *KEYS, "start", "recent", "vflat", boundary_distance(F.col("recent"), bounds, radius).alias("boundary"),
        y.alias("y"),
    )


def graph_sample_edges(nodes: DataFrame, *, radius: float, dim: int) -> DataFrame:
    """UD10 (edge side) + JN3 + JN4 + SM5: radius graph on the noised recent
    positions within each sample ``(traj_id, start)``, with displacement / r
    and distance per edge."""
    from tessera.operators.graph import displacements, radius_graph

    # filters of the join do not move through a generator; they would draw the noise of a window anew
    pts = nodes.select("traj_id", "start", F.col("particle").alias("node"), F.explode(F.array("recent")).alias("pos"))
    return displacements(radius_graph(pts, radius, dim=dim, sample=["traj_id", "start"], positions=True), radius, dim=dim)
