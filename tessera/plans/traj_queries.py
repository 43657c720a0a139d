"""Checked queries over the trajectory view (V_traj)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_gaussian, sql_hash_gaussian
from tessera.operators import trajectory as T
from tessera.plans.catalog import register
from tessera.plans.views import TRAJ_WINDOW, v_traj, with_views
from tessera.session import materialize

L = TRAJ_WINDOW
NOISE_STD = 0.3  # fixture noise level (keeps noise values well above rounding)
NOISE_SEED = 11
PRED_SEED = 7
PRED_STD = 0.05
SEED_FRAMES = L - 1
DIM = 2

_LONG = """long AS (
  SELECT traj_id, particle, frame, d, pos[d + 1] AS x
  FROM (SELECT *, unnest(range(len(pos))) AS d FROM v_traj))"""


def _long(spark, sf):
    """Long per-dimension rows, computed once per query (checkpointed)."""
    return materialize(T.to_long(v_traj(spark, sf)))


def _r(c, n=9):
    return F.round(F.col(c), n).alias(c)


@register(
    "traj_window_counts",
    with_views(
        f"""SELECT traj_id, particle, CAST(max(frame) + 1 AS BIGINT) AS T,
  CAST(greatest(max(frame) + 1 - {L} + 1, 0) AS BIGINT) AS n_windows FROM v_traj GROUP BY traj_id, particle""",
        "v_traj",
    ),
)
def q_traj_window_counts(spark, sf):
    """WN1: windows per particle track (none when shorter than L)."""
    return T.window_counts(v_traj(spark, sf), L)


@register(
    "traj_windows_materialized",
    with_views(
        f"""SELECT traj_id, particle, start, hist, target FROM (
  SELECT traj_id, particle, CAST(frame AS BIGINT) AS start,
    list(pos) OVER (PARTITION BY traj_id, particle ORDER BY frame ROWS BETWEEN CURRENT ROW AND {L - 2} FOLLOWING) AS hist,
    lead(pos, {L - 1}) OVER (PARTITION BY traj_id, particle ORDER BY frame) AS target
  FROM v_traj) WHERE target IS NOT NULL""",
        "v_traj",
    ),
)
def q_traj_windows_materialized(spark, sf):
    """WN2 + AR9 + AR10: L-1 history positions and the target per window."""
    return T.materialize_windows(v_traj(spark, sf), L)


@register(
    "traj_velocity",
    with_views(
        f"""WITH {_LONG}
SELECT * FROM (SELECT traj_id, particle, frame, CAST(d AS INTEGER) AS d,
  round(x - lag(x) OVER (PARTITION BY traj_id, particle, d ORDER BY frame), 9) AS v FROM long) WHERE v IS NOT NULL""",
        "v_traj",
    ),
)
def q_traj_velocity(spark, sf):
    """WN3: first differences per dimension."""
    return T.velocity(T.to_long(v_traj(spark, sf))).select(*T.KEYS, "frame", "d", _r("v"))


_ACC_SQL = f"""acc AS (
  SELECT * FROM (
    SELECT traj_id, particle, frame, d,
      lead(x) OVER w - 2 * x + lag(x) OVER w AS a
    FROM long WINDOW w AS (PARTITION BY traj_id, particle, d ORDER BY frame)) WHERE a IS NOT NULL),
stats AS (SELECT d, avg(a) AS acc_mean, sqrt(greatest(avg(a * a) - avg(a) * avg(a), 0.0)) AS acc_std FROM acc GROUP BY d)"""


@register(
    "traj_acceleration_normalized",
    with_views(
        f"""WITH {_LONG}, {_ACC_SQL}
SELECT a.traj_id, a.particle, a.frame, CAST(a.d AS INTEGER) AS d, round(a.a, 9) AS a,
  round((a.a - s.acc_mean) / sqrt(s.acc_std * s.acc_std + {NOISE_STD}::DOUBLE * {NOISE_STD}::DOUBLE), 9) AS a_norm
FROM acc a JOIN stats s ON a.d = s.d""",
        "v_traj",
    ),
)
def q_traj_acceleration_normalized(spark, sf):
    """WN6 + SM4 + JN8: second differences normalized with metadata
    (acc mean/std per dimension computed from the data, broadcast)."""
    acc = materialize(T.acceleration(_long(spark, sf)))
    stats = T.acc_stats(acc)
    return T.normalize_acc(acc, stats, NOISE_STD).select(*T.KEYS, "frame", "d", _r("a"), _r("a_norm"))


@register(
    "traj_acc_stats",
    with_views(
        f"""WITH {_LONG}, {_ACC_SQL}
SELECT CAST(d AS INTEGER) AS d, round(acc_mean, 9) AS acc_mean, round(acc_std, 9) AS acc_std FROM stats""",
        "v_traj",
    ),
)
def q_traj_acc_stats(spark, sf):
    """Domain metadata: acceleration mean and population std per dimension."""
    stats = T.acc_stats(T.acceleration(T.to_long(v_traj(spark, sf))))
    return stats.select("d", _r("acc_mean"), _r("acc_std"))


_WIN_SQL = f"""wins AS (
  SELECT v.traj_id, v.particle, CAST(v.frame AS BIGINT) AS start FROM v_traj v
  JOIN (SELECT particle, max(frame) AS mf FROM v_traj GROUP BY particle) m ON v.particle = m.particle
  WHERE v.frame + {L - 1} <= m.mf)"""


@register(
    "traj_noise",
    with_views(
        f"""WITH {_WIN_SQL},
g AS (
  SELECT w.traj_id, w.particle, w.start, j, d,
    {sql_hash_gaussian(['w.traj_id', 'w.particle', 'w.start', 'j', 'd'], NOISE_SEED)} * ({NOISE_STD}::DOUBLE / sqrt({L - 2}::DOUBLE)) AS vn
  FROM wins w, (SELECT unnest(range(1, {L - 1})) AS j) js, (SELECT unnest(range({DIM})) AS d) ds),
c1 AS (SELECT *, sum(vn) OVER (PARTITION BY traj_id, particle, start, d ORDER BY j) AS vc FROM g),
c2 AS (SELECT *, sum(vc) OVER (PARTITION BY traj_id, particle, start, d ORDER BY j) AS noise FROM c1)
SELECT traj_id, particle, start, CAST(j AS INTEGER) AS j, CAST(d AS INTEGER) AS d, round(noise, 9) AS noise FROM c2
UNION ALL
SELECT traj_id, particle, start, 0, CAST(d AS INTEGER), 0.0 FROM wins, (SELECT unnest(range({DIM})) AS d) ds""",
        "v_traj",
    ),
)
def q_traj_noise(spark, sf):
    """WN4 + SM8: hash-seeded random-walk position noise per window."""
    wins = T.materialize_windows(v_traj(spark, sf), L)
    n = T.random_walk_noise(wins, L, DIM, NOISE_STD, NOISE_SEED)
    return n.select(*T.KEYS, "start", F.col("j").cast("int").alias("j"), "d", _r("noise"))


@register(
    "traj_context_join",
    with_views(
        f"""WITH {_WIN_SQL}
SELECT w.traj_id, w.particle, w.start, v.context FROM wins w
JOIN v_traj v ON v.particle = w.particle AND v.traj_id = w.traj_id AND v.frame = w.start + {L - 2}""",
        "v_traj",
    ),
)
def q_traj_context_join(spark, sf):
    """JN6 + SC6: each window's global context taken at its last input frame."""
    vt = v_traj(spark, sf)
    wins = T.materialize_windows(vt, L).select(*T.KEYS, "start")
    ctx = vt.select(*T.KEYS, (F.col("frame") - (L - 2)).cast("bigint").alias("start"), "context")
    return wins.join(ctx, on=T.KEYS + ["start"], how="inner")


@register(
    "traj_frame_skip",
    with_views(
        """SELECT v.traj_id, v.particle, v.frame FROM v_traj v
JOIN (SELECT particle, max(frame) + 1 AS T FROM v_traj GROUP BY particle) m ON v.particle = m.particle
WHERE v.frame % 3 = 0 AND floor(v.frame / 3) < floor(m.T / 3)""",
        "v_traj",
    ),
)
def q_traj_frame_skip(spark, sf):
    """FP14: every third frame, T // 3 frames per track."""
    return T.frame_skip(v_traj(spark, sf), 3).select(*T.KEYS, "frame")


@register(
    "traj_flatten_velocity",
    with_views(
        f"""WITH vel AS (
  SELECT traj_id, particle, frame,
    [pos[1] - (lag(pos) OVER w)[1], pos[2] - (lag(pos) OVER w)[2]] AS v,
    lead(frame, {L - 1}) OVER w AS last_frame
  FROM v_traj WINDOW w AS (PARTITION BY traj_id, particle ORDER BY frame)),
seqs AS (
  SELECT traj_id, particle, CAST(frame AS BIGINT) AS start, last_frame,
    list(v) OVER (PARTITION BY traj_id, particle ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND {L - 2} FOLLOWING) AS vs
  FROM vel)
SELECT traj_id, particle, start, list_transform(flatten(vs), lambda x: round(x, 9)) AS vflat FROM seqs WHERE last_frame IS NOT NULL""",
        "v_traj",
    ),
)
def q_traj_flatten_velocity(spark, sf):
    """WN3 + AR8: each window's history velocities flattened time-major."""
    wins = T.materialize_windows(v_traj(spark, sf), L)
    flat = T.flatten_time_major(T.window_velocities(F.col("hist")))
    return wins.select(*T.KEYS, "start", F.transform(flat, lambda x: F.round(x, 9)).alias("vflat"))


def _pred_acc(long):
    """Predicted accelerations standing in for model scores: the true
    acceleration that produced frame t plus seeded Gaussian error."""
    acc = T.acceleration(long).withColumn("frame", F.col("frame") + 1)
    return acc.withColumn("a", F.col("a") + hash_gaussian(["particle", "frame", "d"], PRED_SEED) * F.lit(PRED_STD))


_ROLLOUT_SQL = f"""acc AS (
  SELECT traj_id, particle, frame, d,
    x - 2 * lag(x) OVER w + lag(x, 2) OVER w
      + {sql_hash_gaussian(['particle', 'frame', 'd'], PRED_SEED)} * {PRED_STD}::DOUBLE AS a
  FROM long WINDOW w AS (PARTITION BY traj_id, particle, d ORDER BY frame)),
anchor AS (
  SELECT traj_id, particle, d, max(x) FILTER (WHERE frame = {SEED_FRAMES - 1}) AS x_last,
         max(x) FILTER (WHERE frame = {SEED_FRAMES - 2}) AS x_prev
  FROM long WHERE frame IN ({SEED_FRAMES - 2}, {SEED_FRAMES - 1}) GROUP BY traj_id, particle, d
  HAVING x_last IS NOT NULL AND x_prev IS NOT NULL),
v AS (
  SELECT a.traj_id, a.particle, a.frame, a.d, n.x_last,
    n.x_last - n.x_prev + sum(a.a) OVER (PARTITION BY a.traj_id, a.particle, a.d ORDER BY a.frame) AS vel
  FROM acc a JOIN anchor n USING (traj_id, particle, d) WHERE a.frame >= {SEED_FRAMES}),
pred AS (
  SELECT traj_id, particle, frame, d, x FROM long WHERE frame < {SEED_FRAMES}
  UNION ALL
  SELECT traj_id, particle, frame, d,
    x_last + sum(vel) OVER (PARTITION BY traj_id, particle, d ORDER BY frame) AS x FROM v)"""


@register(
    "traj_rollout",
    with_views(
        f"""WITH {_LONG}, {_ROLLOUT_SQL}
SELECT traj_id, particle, frame, CAST(d AS INTEGER) AS d, round(x, 9) AS x FROM pred""",
        "v_traj",
    ),
)
def q_traj_rollout(spark, sf):
    """WN8 + SM6 + SO2: integrate predicted accelerations from the seed frames."""
    long = _long(spark, sf)
    return T.integrate(long, _pred_acc(long), SEED_FRAMES).select(*T.KEYS, "frame", "d", _r("x"))


@register(
    "traj_rollout_mse",
    with_views(
        f"""WITH {_LONG}, {_ROLLOUT_SQL},
se AS (SELECT p.traj_id, p.particle, p.frame, sum((p.x - l.x) * (p.x - l.x)) AS se
       FROM pred p JOIN long l USING (traj_id, particle, frame, d) GROUP BY p.traj_id, p.particle, p.frame)
SELECT traj_id, round(avg(se), 6) AS mse FROM se GROUP BY traj_id""",
        "v_traj",
    ),
)
def q_traj_rollout_mse(spark, sf):
    """AG14: rollout error per trajectory (mean over frames x particles of the
    squared error summed over dims)."""
    long = _long(spark, sf)
    pred = T.integrate(long, _pred_acc(long), SEED_FRAMES)
    return T.rollout_mse(pred, long).select("traj_id", F.round("mse", 6).alias("mse"))


@register(
    "traj_rollout_error",
    with_views(
        f"""WITH {_LONG}, {_ROLLOUT_SQL},
se AS (SELECT p.traj_id, p.particle, p.frame, sum((p.x - l.x) * (p.x - l.x)) AS se
       FROM pred p JOIN long l USING (traj_id, particle, frame, d) GROUP BY p.traj_id, p.particle, p.frame),
per AS (SELECT traj_id, avg(se) AS mse FROM se GROUP BY traj_id)
SELECT round(avg(mse), 6) AS rollout_mse, CAST(count(*) AS BIGINT) AS num_trajectories FROM per""",
        "v_traj",
    ),
)
def q_traj_rollout_error(spark, sf):
    """AG14: the rollout error averaged over trajectories."""
    long = _long(spark, sf)
    per = T.rollout_mse(T.integrate(long, _pred_acc(long), SEED_FRAMES), long)
    return T.mean_rollout_mse(per).select(F.round("rollout_mse", 6).alias("rollout_mse"), "num_trajectories")


@register(
    "traj_rollout_denormalized",
    with_views(
        f"""WITH {_LONG}, {_ROLLOUT_SQL}
SELECT traj_id, particle, frame, CAST(d AS INTEGER) AS d, round(x, 5) AS x FROM pred""",
        "v_traj",
    ),
)
def q_traj_rollout_denormalized(spark, sf):
    """SM4 + WN8: accelerations as a model gives them, normalized, put back into units before they are integrated."""
    long = _long(spark, sf)
    stats = materialize(T.acc_stats(T.acceleration(long)))
    normalized = T.normalize_acc(_pred_acc(long), stats, NOISE_STD).drop("a")
    back = T.denormalize_acc(normalized, stats, NOISE_STD)
    return T.integrate(long, back, SEED_FRAMES).select(*T.KEYS, "frame", "d", F.round("x", 5).alias("x"))


@register(
    "traj_particle_types",
    with_views(
        """SELECT v.traj_id, v.particle, v.frame, p.particle_type FROM v_traj v
JOIN (SELECT DISTINCT user_id AS particle, user_id % 9 AS particle_type FROM events) p ON v.particle = p.particle""",
        "v_traj",
    ),
)
def q_traj_particle_types(spark, sf):
    """JN5: static per-particle type joined onto every frame (the type table
    is one row per particle and is joined by key, not broadcast blindly)."""
    from tessera.sources.tables import table

    types = table(spark, sf, "events").select(F.col("user_id").alias("particle")).distinct().withColumn(
        "particle_type", F.col("particle") % 9
    )
    return v_traj(spark, sf).join(types, on="particle").select("traj_id", "particle", "frame", "particle_type")


# ---------------------------------------------------------------------------
# Composite graph sample (UD10): noised windows -> node targets / features
# and radius-graph edges among the particles of a sample (traj_id, start).

G_RADIUS = 10.0
G_BOUNDS = [[0.0, 500.0], [0.0, 100.0]]

_WINS_SQL = f"""wins AS (
  SELECT traj_id, particle, start, hist, target FROM (
    SELECT traj_id, particle, CAST(frame AS BIGINT) AS start,
      list(pos) OVER (PARTITION BY traj_id, particle ORDER BY frame ROWS BETWEEN CURRENT ROW AND {L - 2} FOLLOWING) AS hist,
      lead(pos, {L - 1}) OVER (PARTITION BY traj_id, particle ORDER BY frame) AS target
    FROM v_traj) WHERE target IS NOT NULL),
g AS (
  SELECT w.traj_id, w.particle, w.start, j, d,
    {sql_hash_gaussian(['w.traj_id', 'w.particle', 'w.start', 'j', 'd'], NOISE_SEED)} * ({NOISE_STD}::DOUBLE / sqrt({L - 2}::DOUBLE)) AS vn
  FROM wins w, (SELECT unnest(range(1, {L - 1})) AS j) js, (SELECT unnest(range({DIM})) AS d) ds),
c1 AS (SELECT *, sum(vn) OVER (PARTITION BY traj_id, particle, start, d ORDER BY j) AS vc FROM g),
c2 AS (SELECT *, sum(vc) OVER (PARTITION BY traj_id, particle, start, d ORDER BY j) AS noise FROM c1),
nz AS (SELECT traj_id, particle, start, j, d, noise FROM c2
       UNION ALL SELECT traj_id, particle, start, 0, d, 0.0 FROM wins, (SELECT unnest(range({DIM})) AS d) ds),
np AS (SELECT w.traj_id, w.particle, w.start, n.j, n.d, w.hist[n.j + 1][n.d + 1] + n.noise AS xn, n.noise
       FROM wins w JOIN nz n ON w.traj_id = n.traj_id AND w.particle = n.particle AND w.start = n.start),
vel AS (SELECT a.traj_id, a.particle, a.start, list(a.xn - b.xn ORDER BY a.j, a.d) AS vflat
        FROM np a JOIN np b ON a.traj_id = b.traj_id AND a.particle = b.particle AND a.start = b.start
          AND b.j = a.j - 1 AND b.d = a.d GROUP BY a.traj_id, a.particle, a.start),
per AS (
  SELECT np.traj_id, np.particle, np.start,
    max(xn) FILTER (WHERE j = {L - 2} AND d = 0) AS r0, max(xn) FILTER (WHERE j = {L - 2} AND d = 1) AS r1,
    max(xn) FILTER (WHERE j = {L - 3} AND d = 0) AS p0, max(xn) FILTER (WHERE j = {L - 3} AND d = 1) AS p1,
    max(noise) FILTER (WHERE j = {L - 2} AND d = 0) AS n0, max(noise) FILTER (WHERE j = {L - 2} AND d = 1) AS n1
  FROM np GROUP BY np.traj_id, np.particle, np.start),
sv AS (SELECT max(acc_mean) FILTER (WHERE d = 0) AS m0, max(acc_mean) FILTER (WHERE d = 1) AS m1,
              max(acc_std) FILTER (WHERE d = 0) AS s0, max(acc_std) FILTER (WHERE d = 1) AS s1 FROM stats),
nodes AS (
  SELECT p.*, w.target, v.vflat, sv.* FROM per p JOIN wins w USING (traj_id, particle, start)
  JOIN vel v USING (traj_id, particle, start), sv)"""


def _graph_nodes(spark, sf):
    stats = T.acc_stats(T.acceleration(T.to_long(v_traj(spark, sf))))
    wins = T.materialize_windows(v_traj(spark, sf), L)
    return T.graph_sample_nodes(
        wins, stats, window_length=L, dim=DIM, noise_std=NOISE_STD, seed=NOISE_SEED, radius=G_RADIUS, bounds=G_BOUNDS
    )


@register(
    "traj_graph_nodes",
    with_views(
        f"""WITH {_LONG}, {_ACC_SQL}, {_WINS_SQL}
SELECT traj_id, particle, start,
  round((((target[1] + n0) - r0) - (r0 - p0) - m0) / sqrt(s0 * s0 + {NOISE_STD}::DOUBLE * {NOISE_STD}::DOUBLE), 9) AS y0,
  round((((target[2] + n1) - r1) - (r1 - p1) - m1) / sqrt(s1 * s1 + {NOISE_STD}::DOUBLE * {NOISE_STD}::DOUBLE), 9) AS y1,
  round(greatest(-1.0, least(1.0, (r0 - {G_BOUNDS[0][0]}::DOUBLE) / {G_RADIUS}::DOUBLE)), 9) AS b0,
  round(greatest(-1.0, least(1.0, (r1 - {G_BOUNDS[1][0]}::DOUBLE) / {G_RADIUS}::DOUBLE)), 9) AS b1,
  round(greatest(-1.0, least(1.0, ({G_BOUNDS[0][1]}::DOUBLE - r0) / {G_RADIUS}::DOUBLE)), 9) AS b2,
  round(greatest(-1.0, least(1.0, ({G_BOUNDS[1][1]}::DOUBLE - r1) / {G_RADIUS}::DOUBLE)), 9) AS b3,
  list_transform(vflat, lambda x: round(x, 9)) AS vflat
FROM nodes""",
        "v_traj",
    ),
)
def q_traj_graph_nodes(spark, sf):
    """UD10 + WN4 + WN5 + WN6 + SM3 + SM4 + AR7 + AR8: per window the noised
    acceleration target, boundary features and flattened noised velocities."""
    n = materialize(_graph_nodes(spark, sf))
    return n.select(
        *T.KEYS, "start",
        *[F.round(F.col("y")[d], 9).alias(f"y{d}") for d in range(DIM)],
        *[F.round(F.col("boundary")[i], 9).alias(f"b{i}") for i in range(2 * DIM)],
        F.transform("vflat", lambda x: F.round(x, 9)).alias("vflat"),
    )


@register(
    "traj_graph_edges",
    with_views(
        f"""WITH {_LONG}, {_ACC_SQL}, {_WINS_SQL},
pairs AS (
  SELECT a.traj_id, a.start, a.particle AS src, b.particle AS dst,
    (a.r0 - b.r0) * (1.0::DOUBLE / {G_RADIUS}::DOUBLE) AS dx, (a.r1 - b.r1) * (1.0::DOUBLE / {G_RADIUS}::DOUBLE) AS dy
  FROM per a JOIN per b ON a.traj_id = b.traj_id AND a.start = b.start
  WHERE (a.r0 - b.r0) * (a.r0 - b.r0) + (a.r1 - b.r1) * (a.r1 - b.r1) <= {G_RADIUS * G_RADIUS!r}::DOUBLE)
SELECT traj_id, start, src, dst, round(dx, 9) AS dx, round(dy, 9) AS dy, round(sqrt(dx * dx + dy * dy), 9) AS dist FROM pairs""",
        "v_traj",
    ),
)
def q_traj_graph_edges(spark, sf):
    """UD10 + JN3 + JN4 + SM5: radius graph (self-loops kept) over the noised
    recent positions of each sample, with edge displacement and distance."""
    e = T.graph_sample_edges(_graph_nodes(spark, sf), radius=G_RADIUS, dim=DIM)
    return e.select(
        "traj_id", "start", "src", "dst",
        F.round(F.col("disp")[0], 9).alias("dx"), F.round(F.col("disp")[1], 9).alias("dy"), F.round("dist", 9).alias("dist"),
    )
