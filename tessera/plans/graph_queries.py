"""Checked queries over point clouds (V_points), the bipartite part/supplier
graph (V_graph) and mesh nodes (V_mesh)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators import mesh as M
from tessera.operators.skew import heavy_hitters
from tessera.operators.space import tree_radius_graph
from tessera.plans.catalog import register
from tessera.plans.views import (
    DENSE_RADIUS,
    POINT_BOUNDS,
    POINT_RADIUS,
    v_dense_points,
    v_graph_edges,
    v_graph_nodes,
    v_hub_edges,
    v_hub_nodes,
    v_mesh,
    v_points,
    with_views,
)

R = POINT_RADIUS
R2 = repr(R * R)
DT = 0.01
ONE_STEP_SCALE = [1.5, 0.5]  # fixed metadata: sqrt(acc_std^2 + noise^2) per dim
MESH_TEST = 3

_PAIRS_SQL = f"""pairs AS (
  SELECT a.sample, a.node AS src, b.node AS dst, a.pos AS ps, b.pos AS pd FROM v_points a JOIN v_points b
    ON a.sample = b.sample
  WHERE (a.pos[1] - b.pos[1]) * (a.pos[1] - b.pos[1]) + (a.pos[2] - b.pos[2]) * (a.pos[2] - b.pos[2]) <= {R2}::DOUBLE)"""


def _rv(c, n=9):
    return F.round(F.col(c), n).alias(c)


@register("points_radius_graph", with_views(f"WITH {_PAIRS_SQL} SELECT sample, src, dst FROM pairs", "v_points"))
def q_points_radius_graph(spark, sf):
    """JN3: radius graph with self-loops, via the grid-bucketed equi-join."""
    return G.radius_graph(v_points(spark, sf), R, dim=2)


@register(
    "points_dense_graph",
    with_views(
        f"""SELECT a.sample, a.node AS src, b.node AS dst FROM v_dense_points a JOIN v_dense_points b ON a.sample = b.sample
WHERE (a.pos[1] - b.pos[1]) * (a.pos[1] - b.pos[1]) + (a.pos[2] - b.pos[2]) * (a.pos[2] - b.pos[2])
  <= {DENSE_RADIUS * DENSE_RADIUS!r}::DOUBLE""",
        "v_dense_points",
    ),
)
def q_points_dense_graph(spark, sf):
    """JN3 where most points share a grid cell: boxes of a sampled k-d tree with halo rows."""
    return tree_radius_graph(v_dense_points(spark, sf), DENSE_RADIUS, dim=2)


@register(
    "points_edge_features",
    with_views(
        f"""WITH {_PAIRS_SQL}
SELECT sample, src, dst, round((ps[1] - pd[1]) / {R}::DOUBLE, 9) AS dx, round((ps[2] - pd[2]) / {R}::DOUBLE, 9) AS dy,
  round(sqrt(((ps[1] - pd[1]) / {R}::DOUBLE) * ((ps[1] - pd[1]) / {R}::DOUBLE)
           + ((ps[2] - pd[2]) / {R}::DOUBLE) * ((ps[2] - pd[2]) / {R}::DOUBLE)), 9) AS dist FROM pairs""",
        "v_points",
    ),
)
def q_points_edge_features(spark, sf):
    """JN4 + SM5 + AR7: displacement / r and distance per radius-graph edge."""
    e = G.displacements(G.radius_graph(v_points(spark, sf), R, dim=2, positions=True), R)
    return e.select(
        "sample", "src", "dst",
        F.round(F.col("disp")[0], 9).alias("dx"), F.round(F.col("disp")[1], 9).alias("dy"), _rv("dist"),
    )


@register(
    "points_boundary_distance",
    with_views(
        f"""SELECT sample, node,
  round(greatest(-1.0, least(1.0, (pos[1] - ({POINT_BOUNDS[0][0]})::DOUBLE) / {R}::DOUBLE)), 9) AS b0,
  round(greatest(-1.0, least(1.0, (pos[2] - ({POINT_BOUNDS[1][0]})::DOUBLE) / {R}::DOUBLE)), 9) AS b1,
  round(greatest(-1.0, least(1.0, (({POINT_BOUNDS[0][1]})::DOUBLE - pos[1]) / {R}::DOUBLE)), 9) AS b2,
  round(greatest(-1.0, least(1.0, (({POINT_BOUNDS[1][1]})::DOUBLE - pos[2]) / {R}::DOUBLE)), 9) AS b3
FROM v_points""",
        "v_points",
    ),
)
def q_points_boundary_distance(spark, sf):
    """SM3: clipped distance to the lower then upper bounds, per node."""
    b = G.boundary_distance(F.col("pos"), POINT_BOUNDS, R)
    pts = v_points(spark, sf).withColumn("b", b)
    return pts.select("sample", "node", *[F.round(F.col("b")[i], 9).alias(f"b{i}") for i in range(4)])


@register(
    "points_particle_type_counts",
    with_views(
        """SELECT sample, particle_type, CAST(count(*) AS BIGINT) AS n FROM v_points
WHERE particle_type IN (0, 3, 5) GROUP BY sample, particle_type""",
        "v_points",
    ),
)
def q_points_particle_type_counts(spark, sf):
    """FP8: particles of selected types per sample."""
    pts = v_points(spark, sf).where(F.col("particle_type").isin(0, 3, 5))
    return pts.groupBy("sample", "particle_type").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


_SCATTER_SQL = """SELECT n.node, round(coalesce(sum(e.attr[1]), 0.0), 4) AS agg_0, round(coalesce(sum(e.attr[2]), 0.0), 4) AS agg_1,
  CAST(count(e.{key}) AS BIGINT) AS degree
FROM {nodes} n LEFT JOIN v_edges e ON e.{key} = n.node GROUP BY n.node"""


@register(
    "graph_scatter_dst",
    with_views(_SCATTER_SQL.format(key="dst", nodes="v_dst_nodes"), "v_dst_nodes", "v_edges"),
)
def q_graph_scatter_dst(spark, sf):
    """AG11: sum of edge attributes into each target (supplier) node."""
    _, sup = v_graph_nodes(spark, sf)
    out = G.scatter_sum(v_graph_edges(spark, sf), sup, value="attr", width=2, to="dst")
    return out.select("node", *[F.round(F.col("aggr")[i], 4).alias(f"agg_{i}") for i in range(2)], "degree")


@register(
    "graph_scatter_src",
    with_views(_SCATTER_SQL.format(key="src", nodes="v_src_nodes"), "v_src_nodes", "v_edges"),
)
def q_graph_scatter_src(spark, sf):
    """AG12: sum keyed on the edge source; nodes without edges get zeros (Q8)."""
    part, _ = v_graph_nodes(spark, sf)
    out = G.scatter_sum(v_graph_edges(spark, sf), part, value="attr", width=2, to="src")
    return out.select("node", *[F.round(F.col("aggr")[i], 4).alias(f"agg_{i}") for i in range(2)], "degree")


@register(
    "graph_message_pass",
    with_views(
        """WITH m AS (
  SELECT e.dst, s.x[1] AS m0, s.x[2] AS m1, d.x[1] AS m2, e.attr[1] AS m3, e.attr[2] AS m4
  FROM v_edges e JOIN v_src_nodes s ON e.src = s.node JOIN v_dst_nodes d ON e.dst = d.node)
SELECT n.node, round(coalesce(sum(m0), 0.0), 4) AS m0, round(coalesce(sum(m1), 0.0), 4) AS m1,
  round(coalesce(sum(m2), 0.0), 4) AS m2, round(coalesce(sum(m3), 0.0), 4) AS m3, round(coalesce(sum(m4), 0.0), 4) AS m4,
  CAST(count(m.dst) AS BIGINT) AS degree
FROM v_dst_nodes n LEFT JOIN m ON m.dst = n.node GROUP BY n.node""",
        "v_src_nodes",
        "v_dst_nodes",
        "v_edges",
    ),
)
def q_graph_message_pass(spark, sf):
    """UD9: message = concat(x_src, x_dst, edge attr), summed into each target."""
    part, sup = v_graph_nodes(spark, sf)
    out = G.message_pass(
        part, sup, v_graph_edges(spark, sf), lambda xs, xd, e: F.concat(xs, xd, e), width=5, to="dst"
    )
    return out.select("node", *[F.round(F.col("aggr")[i], 4).alias(f"m{i}") for i in range(5)], "degree")


@register(
    "graph_hub_messages",
    with_views(
        """WITH m AS (
  SELECT e.dst, s.x[1] AS m0, s.x[2] AS m1, d.x[1] AS m2, e.attr[1] AS m3, e.attr[2] AS m4
  FROM v_hub_edges e JOIN v_src_nodes s ON e.src = s.node JOIN v_hub_nodes d ON e.dst = d.node)
SELECT n.node, round(coalesce(sum(m0), 0.0), 3) AS m0, round(coalesce(sum(m1), 0.0), 3) AS m1,
  round(coalesce(sum(m2), 0.0), 3) AS m2, round(coalesce(sum(m3), 0.0), 3) AS m3, round(coalesce(sum(m4), 0.0), 3) AS m4,
  CAST(count(m.dst) AS BIGINT) AS degree
FROM v_hub_nodes n LEFT JOIN m ON m.dst = n.node GROUP BY n.node""",
        "v_src_nodes",
        "v_hub_nodes",
        "v_hub_edges",
    ),
)
def q_graph_hub_messages(spark, sf):
    """JN4 + UD9 + AG11 where every target is a hub: the gather is salted."""
    part, _ = v_graph_nodes(spark, sf)
    edges, nations = v_hub_edges(spark, sf), v_hub_nodes(spark, sf)
    out = G.message_pass(part, nations, edges, lambda xs, xd, e: F.concat(xs, xd, e), width=5, hubs=G.find_hubs(edges))
    return out.select("node", *[F.round(F.col("aggr")[i], 3).alias(f"m{i}") for i in range(5)], "degree")


HUB_SHARE = 0.04


@register(
    "graph_heavy_nodes",
    with_views(
        f"""SELECT dst, CAST(count(*) AS BIGINT) AS n FROM v_hub_edges GROUP BY dst
HAVING count(*) >= {HUB_SHARE}::DOUBLE * (SELECT count(*) FROM v_hub_edges)""",
        "v_hub_edges",
    ),
)
def q_graph_heavy_nodes(spark, sf):
    """Target nodes with at least 4 % of all edges: candidates of the sketch, counted exactly."""
    return heavy_hitters(v_hub_edges(spark, sf), "dst", HUB_SHARE)


# Mesh -----------------------------------------------------------------------

_STATS_SQL = """SELECT feature, CAST(i AS INTEGER) AS i, round(avg(v), 9) AS mean,
  round(greatest(sqrt(avg(v * v) - avg(v) * avg(v)), 1e-8), 9) AS std FROM (
  SELECT 'x' AS feature, i - 1 AS i, (velocity || onehot)[i] AS v FROM {src}, unnest(range(1, 12)) AS t(i)
  UNION ALL
  SELECT 'y', i - 1, y[i] FROM {src}, unnest(range(1, 3)) AS t(i)) GROUP BY feature, i"""


def _mesh_stats(nodes):
    x = M.feature_stats(nodes.select(F.concat("velocity", "onehot").alias("x")), "x").withColumn("feature", F.lit("x"))
    y = M.feature_stats(nodes, "y").withColumn("feature", F.lit("y"))
    return x.unionByName(y).select("feature", "i", _rv("mean"), _rv("std"))


@register("mesh_feature_stats", with_views(_STATS_SQL.format(src="v_mesh"), "v_mesh"))
def q_mesh_feature_stats(spark, sf):
    """AG9: per-component mean and floored population std of x and y."""
    return _mesh_stats(v_mesh(spark, sf))


@register(
    "mesh_edge_stats",
    with_views(
        f"""WITH {_PAIRS_SQL},
attr AS (
  SELECT (ps[1] - pd[1]) * (1.0::DOUBLE / {R}::DOUBLE) AS dx, (ps[2] - pd[2]) * (1.0::DOUBLE / {R}::DOUBLE) AS dy FROM pairs),
vals AS (SELECT unnest([0, 1, 2]) AS i, unnest([dx, dy, sqrt(dx * dx + dy * dy)]) AS v FROM attr)
SELECT 'edge_attr' AS feature, CAST(i AS INTEGER) AS i, round(avg(v), 9) AS mean,
  round(greatest(sqrt(avg(v * v) - avg(v) * avg(v)), 1e-8), 9) AS std FROM vals GROUP BY i""",
        "v_points",
    ),
)
def q_mesh_edge_stats(spark, sf):
    """AG9: mean and std of the edge attributes of the radius graph."""
    edges = G.displacements(G.radius_graph(v_points(spark, sf), R, dim=2, positions=True), R)
    return M.feature_stats(edges, "edge_attr").select(F.lit("edge_attr").alias("feature"), "i", _rv("mean"), _rv("std"))


_Y_STATS_SQL = """ys AS (
  SELECT i, avg(v) AS mean, greatest(sqrt(avg(v * v) - avg(v) * avg(v)), 1e-8) AS std
  FROM (SELECT i, y[i] AS v FROM v_mesh, unnest(range(1, 3)) AS t(i)) GROUP BY i),
yv AS (SELECT max(mean) FILTER (WHERE i = 1) AS m1, max(mean) FILTER (WHERE i = 2) AS m2,
              max(std) FILTER (WHERE i = 1) AS s1, max(std) FILTER (WHERE i = 2) AS s2 FROM ys)"""

_MASK = "node_type IN (0, 5)"
_ERR = "((y[1] - m1) / s1 - pred[1]) * ((y[1] - m1) / s1 - pred[1]) + ((y[2] - m2) / s2 - pred[2]) * ((y[2] - m2) / s2 - pred[2])"
_VERR = (
    f"((velocity[1] + pred[1] * {DT}::DOUBLE) - (velocity[1] + y[1] * {DT}::DOUBLE)) * ((velocity[1] + pred[1] * {DT}::DOUBLE) - (velocity[1] + y[1] * {DT}::DOUBLE))"
    f" + ((velocity[2] + pred[2] * {DT}::DOUBLE) - (velocity[2] + y[2] * {DT}::DOUBLE)) * ((velocity[2] + pred[2] * {DT}::DOUBLE) - (velocity[2] + y[2] * {DT}::DOUBLE))"
)


def _y_stats(nodes):
    return M.feature_stats(nodes, "y")


@register(
    "mesh_masked_rmse",
    with_views(
        f"""WITH {_Y_STATS_SQL}
SELECT batch, round(sqrt(avg(CASE WHEN {_MASK} THEN {_ERR} END)), 9) AS loss FROM v_mesh, yv GROUP BY batch""",
        "v_mesh",
    ),
)
def q_mesh_masked_rmse(spark, sf):
    """AG15 + FP9 + SM1: normalized masked RMSE per batch."""
    nodes = v_mesh(spark, sf)
    return M.masked_rmse_per_batch(nodes, _y_stats(nodes)).select("batch", _rv("loss"))


@register(
    "mesh_velocity_rmse",
    with_views(
        f"""WITH {_Y_STATS_SQL},
pb AS (SELECT batch, sqrt(avg(CASE WHEN {_MASK} THEN {_ERR} END)) AS loss,
              sqrt(avg(CASE WHEN {_MASK} THEN {_VERR} END)) AS velo_rmse FROM v_mesh, yv GROUP BY batch)
SELECT round(avg(loss), 9) AS loss, round(avg(velo_rmse), 9) AS velo_rmse, CAST(count(*) AS BIGINT) AS num_batches FROM pb""",
        "v_mesh",
    ),
)
def q_mesh_velocity_rmse(spark, sf):
    """AG16 + SM7: (mean batch loss, mean batch velocity RMSE)."""
    nodes = v_mesh(spark, sf)
    loss = M.masked_rmse_per_batch(nodes, _y_stats(nodes))
    vel = M.velocity_rmse_per_batch(nodes, dt=DT)
    out = M.mean_over_batches(loss.join(vel, on="batch"), ["loss", "velo_rmse"])
    return out.select(_rv("loss"), _rv("velo_rmse"), "num_batches")


@register(
    "mesh_one_step_mse",
    with_views(
        f"""WITH pb AS (
  SELECT batch,
    avg((pred[1] - y[1]) * (pred[1] - y[1]) + (pred[2] - y[2]) * (pred[2] - y[2])) / 2.0 AS loss,
    avg(((pred[1] - y[1]) * {ONE_STEP_SCALE[0]}::DOUBLE) * ((pred[1] - y[1]) * {ONE_STEP_SCALE[0]}::DOUBLE)
      + ((pred[2] - y[2]) * {ONE_STEP_SCALE[1]}::DOUBLE) * ((pred[2] - y[2]) * {ONE_STEP_SCALE[1]}::DOUBLE)) AS mse
  FROM v_mesh GROUP BY batch)
SELECT round(avg(loss), 9) AS loss, round(avg(mse), 9) AS mse, CAST(count(*) AS BIGINT) AS num_batches FROM pb""",
        "v_mesh",
    ),
)
def q_mesh_one_step_mse(spark, sf):
    """AG13: one-step loss and scaled MSE per batch, averaged over batches."""
    pb = M.one_step_mse_per_batch(v_mesh(spark, sf), ONE_STEP_SCALE)
    return M.mean_over_batches(pb, ["loss", "mse"]).select(_rv("loss"), _rv("mse"), "num_batches")


@register(
    "mesh_mse",
    with_views(
        "SELECT round(sum((pred[1] - y[1]) * (pred[1] - y[1]) + (pred[2] - y[2]) * (pred[2] - y[2])) / sum(len(y)), 9) AS mse FROM v_mesh",
        "v_mesh",
    ),
)
def q_mesh_mse(spark, sf):
    """AG17: mean squared error over all elements."""
    return M.mse(v_mesh(spark, sf)).select(_rv("mse"))


@register(
    "mesh_node_mask",
    with_views(f"SELECT sample, node, node_type, {_MASK} AS is_loss_node FROM v_mesh", "v_mesh"),
)
def q_mesh_node_mask(spark, sf):
    """FP9 + AR4: one-hot decode of the node type and the loss mask."""
    n = v_mesh(spark, sf)
    return n.select("sample", "node", "node_type", M.loss_mask(F.col("node_type")).alias("is_loss_node"))


@register(
    "mesh_residuals",
    with_views(
        f"""SELECT node, CAST(d - 1 AS INTEGER) AS d,
  round(velocity[d] + pred[d] * {DT}::DOUBLE, 9) AS eval_velo,
  round(velocity[d] + y[d] * {DT}::DOUBLE, 9) AS gs_velo,
  round((velocity[d] + pred[d] * {DT}::DOUBLE) - (velocity[d] + y[d] * {DT}::DOUBLE), 9) AS err_velo
FROM v_mesh, unnest(range(1, 3)) AS t(d)""",
        "v_mesh",
    ),
)
def q_mesh_residuals(spark, sf):
    """FP15 + SM7: predicted and true next velocity and their difference."""
    r = M.residual_fields(v_mesh(spark, sf), dt=DT)
    long = r.select(
        "node",
        F.posexplode(F.arrays_zip("eval_velo", "gs_velo", "err_velo")).alias("d", "s"),
    )
    return long.select(
        "node", F.col("d").cast("int").alias("d"),
        F.round("s.eval_velo", 9).alias("eval_velo"), F.round("s.gs_velo", 9).alias("gs_velo"),
        F.round("s.err_velo", 9).alias("err_velo"),
    )


@register(
    "mesh_value_bounds",
    with_views(
        f"""WITH first AS (SELECT * FROM v_mesh WHERE sample = (SELECT min(sample) FROM v_mesh)),
vals AS (
  SELECT 'eval_velo' AS field, velocity[d] + pred[d] * {DT}::DOUBLE AS x FROM first, unnest(range(1, 3)) AS t(d)
  UNION ALL SELECT 'gs_velo', velocity[d] + y[d] * {DT}::DOUBLE FROM first, unnest(range(1, 3)) AS t(d)
  UNION ALL SELECT 'err_velo', (velocity[d] + pred[d] * {DT}::DOUBLE) - (velocity[d] + y[d] * {DT}::DOUBLE)
    FROM first, unnest(range(1, 3)) AS t(d))
SELECT field, round(min(x), 9) AS vmin, round(max(x), 9) AS vmax FROM vals GROUP BY field""",
        "v_mesh",
    ),
)
def q_mesh_value_bounds(spark, sf):
    """AG21: bounds of predicted / true velocity and error in the first sample."""
    n = v_mesh(spark, sf)
    first = n.join(n.agg(F.min("sample").alias("sample")), on="sample", how="left_semi")
    b = M.value_bounds(M.residual_fields(first, dt=DT), ["eval_velo", "gs_velo", "err_velo"])
    return b.select("field", _rv("vmin"), _rv("vmax"))


@register(
    "mesh_train_test",
    with_views(
        f"""WITH s AS (SELECT DISTINCT sample FROM v_mesh),
r AS (SELECT sample, row_number() OVER (ORDER BY md5(CAST(sample AS VARCHAR) || ':' || '0'), sample) AS r FROM s)
SELECT sample, CASE WHEN r <= {MESH_TEST} THEN 'test' ELSE 'train' END AS split FROM r""",
        "v_mesh",
    ),
)
def q_mesh_train_test(spark, sf):
    """FP10: all samples shuffled, an absolute number for test, the rest train."""
    return M.train_test_samples(v_mesh(spark, sf), test_size=MESH_TEST)


_X_STATS_SQL = """xs AS (
  SELECT i - 1 AS i, avg(v) AS mean, greatest(sqrt(avg(v * v) - avg(v) * avg(v)), 1e-8) AS std
  FROM (SELECT i, (velocity || onehot)[i] AS v FROM v_mesh, unnest(range(1, 12)) AS t(i)) GROUP BY i)"""


@register(
    "mesh_normalize_roundtrip",
    with_views(
        f"""WITH {_X_STATS_SQL}
SELECT m.node, CAST(x.i AS INTEGER) AS i,
  round(((m.velocity || m.onehot)[x.i + 1] - x.mean) / x.std, 9) AS xn,
  round((((m.velocity || m.onehot)[x.i + 1] - x.mean) / x.std) * x.std + x.mean, 9) AS x_back
FROM v_mesh m, xs x""",
        "v_mesh",
    ),
)
def q_mesh_normalize_roundtrip(spark, sf):
    """SM1 + SM2 + AG9: all components of x normalized with its statistics and
    mapped back (``unnormalize(normalize(x)) = x``)."""
    from tessera.functions.arrays import normalize, unnormalize

    nodes = v_mesh(spark, sf).select("node", F.concat("velocity", "onehot").alias("x"))
    mean, std = M.stats_literals(M.feature_stats(nodes, "x"))
    n = nodes.withColumn("xn", normalize("x", mean, std))
    n = n.withColumn("x_back", unnormalize("xn", mean, std))
    long = n.select("node", F.posexplode(F.arrays_zip("xn", "x_back")).alias("i", "s"))
    return long.select(
        "node", F.col("i").cast("int").alias("i"), F.round("s.xn", 9).alias("xn"), F.round("s.x_back", 9).alias("x_back")
    )


ROUNDS = 3


def _round_sql(prev: str, cur: str) -> str:
    return f"""{cur} AS (
  SELECT n.sample, n.node,
    n.x0 + coalesce(sum((s.x0 - n.x0) * 0.5::DOUBLE) FILTER (WHERE s.node IS NOT NULL), 0.0) AS x0,
    n.x1 + coalesce(sum((s.x1 - n.x1) * 0.5::DOUBLE) FILTER (WHERE s.node IS NOT NULL), 0.0) AS x1
  FROM {prev} n LEFT JOIN edges e ON e.sample = n.sample AND e.dst = n.node
  LEFT JOIN {prev} s ON s.sample = e.sample AND s.node = e.src
  GROUP BY n.sample, n.node, n.x0, n.x1)"""


@register(
    "graph_message_rounds",
    with_views(
        f"""WITH {_PAIRS_SQL},
edges AS (SELECT sample, src, dst FROM pairs),
r0 AS (SELECT sample, node, pos[1] AS x0, pos[2] AS x1 FROM v_points),
{_round_sql('r0', 'r1')},
{_round_sql('r1', 'r2')},
{_round_sql('r2', 'r3')}
SELECT sample, node, round(x0, 9) AS x0, round(x1, 9) AS x1 FROM r3""",
        "v_points",
    ),
)
def q_graph_message_rounds(spark, sf):
    """UD9 iterated: three rounds of ``x <- x + sum over in-edges of
    0.5 (x_src - x_dst)`` on the radius graph, lineage cut by a checkpoint."""
    pts = v_points(spark, sf)
    edges = G.radius_graph(pts, R, dim=2).withColumn("attr", F.array(F.lit(1.0)))
    nodes = pts.select("sample", "node", F.col("pos").alias("x"))
    msg = lambda xs, xd, e: F.zip_with(xs, xd, lambda a, b: (a - b) * F.lit(0.5))
    out = G.message_pass_rounds(nodes, edges, msg, rounds=ROUNDS, width=2, sample="sample", checkpoint_every=2)
    return out.select("sample", "node", F.round(F.col("x")[0], 9).alias("x0"), F.round(F.col("x")[1], 9).alias("x1"))
