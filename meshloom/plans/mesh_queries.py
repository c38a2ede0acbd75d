"""Registered queries on the box corpus, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import GeometryConfig, geometry_reasons
from ..operators import neighbours, pose, rays, topology
from ..operators.meet import meet
from ..operators.packed import pack
from ..operators.rollups import retention
from ..sources.boxes import SQL, box_faces, box_vertices, dealt

PLACES = 6


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _boxes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = dealt(_read(spark, sf_dir, "part"))
    return box_vertices(part), box_faces(part)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, PLACES) for n in names})


def mesh_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.edges(_boxes(spark, sf_dir)[1])


def mesh_manifold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.manifoldness(_boxes(spark, sf_dir)[1])


def mesh_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = topology.summarize(*_boxes(spark, sf_dir))
    out = out.select("*", *[F.col("bbox_extent")[k].alias(f"extent_{d}") for k, d in enumerate("xyz")]).drop("bbox_extent")
    return _rounded(out, "volume", "area", "extent_x", "extent_y", "extent_z")


def mesh_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.components(pack(*_boxes(spark, sf_dir))).select("mesh_id", "num_components", "largest_faces")


def largest_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faces of each mesh's largest component."""
    return topology.largest_faces(_boxes(spark, sf_dir)[1])


def fit_unit_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(topology.fit_unit_cube(_boxes(spark, sf_dir)[0]), *"xyz", "cx", "cy", "cz", "scale")


def primitive_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(topology.primitive_score(*_boxes(spark, sf_dir)), "axis_aligned_area_fraction")


def vertex_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(topology.vertex_normals(*_boxes(spark, sf_dir)), "nx", "ny", "nz")


def merged_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each triangle with corners of its own, merged back by place."""
    v, f = _boxes(spark, sf_dir)
    at = topology.corners(v, f)
    soup = at.select("mesh_id", F.explode(F.array(*[F.struct((F.col("fid") * 3 + k).alias("vid"), *[F.col(f"{c}{d}").alias(d) for d in "xyz"]) for k, c in enumerate("abc")])).alias("p")).select("mesh_id", "p.*")
    own = f.select("mesh_id", "fid", *[(F.col("fid") * 3 + k).alias(c) for k, c in enumerate("abc")])
    mv, mf = topology.merge_vertices(soup, own)
    return meet(mv.groupBy("mesh_id").agg(F.count("*").alias("num_vertices")), mf.groupBy("mesh_id").agg(F.count("*").alias("num_faces")), "mesh_id")


def _stage4(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, f = _boxes(spark, sf_dir)
    out = meet(meet(topology.summarize(v, f), topology.primitive_score(v, f).drop("num_faces"), "mesh_id"), topology.components(pack(v, f)).select("mesh_id", "num_components"), "mesh_id")
    out = out.withColumn("volume_area_ratio", F.when(F.col("is_watertight"), F.abs("volume") / (F.col("area") + 1e-12)))
    config = GeometryConfig(max_components=2, volume_area_ratio_min=1.0, primitive_vertices=500)
    names = {"num_components": "num_components", "volume_area_ratio": "volume_area_ratio", "num_vertices": "num_vertices", "axis_share": "axis_aligned_area_fraction"}
    return out.withColumn("reasons", geometry_reasons({k: F.col(c) for k, c in names.items()}, config))


def stage4_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage4(spark, sf_dir).select("mesh_id", F.round("volume_area_ratio", PLACES).alias("volume_area_ratio"), F.array_join("reasons", "|").alias("reasons"), (F.size("reasons") == 0).alias("is_valid"))


def corpus_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention of the box corpus by brand under topology rules."""
    v, f = _boxes(spark, sf_dir)
    part = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("mesh_id"), F.col("p_brand").alias("dataset"))
    verdict = meet(meet(topology.manifoldness(f), topology.surface(v, f), "mesh_id"), part, "mesh_id")
    return retention(verdict.withColumn("accepted", F.col("is_watertight") & F.col("is_winding_consistent") & (F.abs("signed_volume") / F.col("area") > 1.0)))


def up_axis_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, f = _boxes(spark, sf_dir)
    return meet(_rounded(pose.up_scores(v, f), "score_x", "score_y", "score_z", "up_score"), pose.up_sign(v, pose.up_scores(v, f)).select("mesh_id", "sign"), "mesh_id")


def scatter_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pose.scatter(_boxes(spark, sf_dir)[0])
    names = [c for c in out.columns if c != "mesh_id"]
    return out.withColumns({n: F.round(n, 4) + F.lit(0.0) for n in names})


def third_moment(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("mesh_id"), F.col("l_quantity").alias("x"))
    return pose.third_moment(points, "x").withColumn("third_moment", F.round("third_moment", 3))


def rotation_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter turn about z: up +X becomes +Y."""
    return _rounded(pose.rotate(_boxes(spark, sf_dir)[0], [[0.0, -1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]]), *"xyz")


def _test_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = lambda p, q, m: (F.pmod(F.col("p_partkey") * p + F.col("i") * q, F.lit(m)) / float(m)) * 1.1 - 0.55
    rows = dealt(_read(spark, sf_dir, "part")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(19))))
    return rows.select(
        F.col("p_partkey").alias("mesh_id"), F.col("i").cast("long").alias("pid"), (u(7919, 104729, 997) * F.col("p_size")).alias("x"), (u(6007, 7001, 991) * F.col("p_retailprice") / 100).alias("y"),
        (u(3001, 9001, 983) * (F.col("p_partkey") % 9 + 1)).alias("z"),
    )


def ray_parity_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rays.parity_inside(_test_points(spark, sf_dir), topology.corners(*_boxes(spark, sf_dir)))


def sign_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity against the first box's bounds."""
    part = _read(spark, sf_dir, "part")
    points = _test_points(spark, sf_dir)
    bound = meet(points, part.select(F.col("p_partkey").alias("mesh_id"), "p_size", "p_retailprice"), "mesh_id")
    box = bound.select("mesh_id", "pid", ((F.abs("x") < F.col("p_size") / 2) & (F.abs("y") < F.col("p_retailprice") / 200) & (F.abs("z") < (F.col("mesh_id") % 9 + 1) / 2)).alias("inside"))
    out = rays.sign_agreement(rays.parity_inside(points, topology.corners(*_boxes(spark, sf_dir))), box)
    return _rounded(out, "ray_sign_agreement", "fraction_inside_gt", "fraction_inside_other")


def ray_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity along x against winding along z; holes and turned triangles set them apart."""
    points, at = _test_points(spark, sf_dir), topology.corners(*_boxes(spark, sf_dir))
    return _rounded(rays.sign_agreement(rays.parity_inside(points, at), rays.winding_inside(points, at)), "ray_sign_agreement", "fraction_inside_gt", "fraction_inside_other")


def surface_sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of 100 even steps through a mesh's area fall on it, and how many leave its bounds."""
    v, f = _boxes(spark, sf_dir)
    points = neighbours.sample_surface(topology.with_normals(topology.corners(v, f)), 100)
    box = v.groupBy("mesh_id").agg(*[g(d).alias(f"{d}{n}") for d in "xyz" for g, n in ((F.min, 0), (F.max, 1))])
    out = meet(points, box, "mesh_id").withColumn("out", ~(F.col("x").between(F.col("x0") - 1e-9, F.col("x1") + 1e-9) & F.col("y").between(F.col("y0") - 1e-9, F.col("y1") + 1e-9) & F.col("z").between(F.col("z0") - 1e-9, F.col("z1") + 1e-9)))
    return out.groupBy("mesh_id").agg(F.count("*").alias("n"), F.count_if("out").alias("n_outside"))


QUERIES = {f.__name__: f for f in (corpus_qc, mesh_edges, mesh_manifold, mesh_summary, mesh_components, largest_component, fit_unit_cube, primitive_score, vertex_normals, merged_mesh, stage4_filter, up_axis_score, scatter_matrix, third_moment, rotation_apply, ray_parity_inside, sign_agreement, ray_agreement, surface_sample_counts)}

_EDGES = """,
half AS (SELECT mesh_id, a AS p, b AS q FROM faces UNION ALL SELECT mesh_id, b, c FROM faces UNION ALL SELECT mesh_id, c, a FROM faces),
edges AS (SELECT mesh_id, least(p, q) AS lo, greatest(p, q) AS hi, count(*) AS n, count(*) FILTER (WHERE p < q) AS n_forward FROM half GROUP BY ALL),
manifold AS (SELECT mesh_id, count(*) AS num_edges, bool_and(n = 2) AS is_watertight, bool_and(n <> 2 OR n_forward = 1) AS is_winding_consistent FROM edges GROUP BY mesh_id)"""
_CORNERS = """,
corners AS (SELECT f.mesh_id, f.fid, f.a, f.b, f.c, va.x AS ax, va.y AS ay, va.z AS az, vb.x AS bx, vb.y AS by_, vb.z AS bz, vc.x AS cx, vc.y AS cy, vc.z AS cz
  FROM faces f JOIN vertices va ON va.mesh_id = f.mesh_id AND va.vid = f.a JOIN vertices vb ON vb.mesh_id = f.mesh_id AND vb.vid = f.b JOIN vertices vc ON vc.mesh_id = f.mesh_id AND vc.vid = f.c),
raw AS (SELECT *, (by_ - ay) * (cz - az) - (bz - az) * (cy - ay) AS nx, (bz - az) * (cx - ax) - (bx - ax) * (cz - az) AS ny, (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax) AS nz FROM corners),
normals AS (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) / 2 AS area FROM raw),
surface AS (SELECT mesh_id, sum(area) AS area, sum(ax * (by_ * cz - bz * cy) + ay * (bz * cx - bx * cz) + az * (bx * cy - by_ * cx)) / 6 AS signed_volume, count(*) AS num_faces FROM normals GROUP BY mesh_id)"""
_BOX = """,
box AS (SELECT mesh_id, count(*) AS num_vertices, max(x) - min(x) AS ex, max(y) - min(y) AS ey, max(z) - min(z) AS ez, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz FROM vertices GROUP BY mesh_id)"""
_AXIS = """,
axis AS (SELECT mesh_id, count(*) AS num_faces, coalesce(sum(area) FILTER (WHERE greatest(abs(nx), abs(ny), abs(nz)) > cos(radians(10)) * 2 * area), 0) / (sum(area) + 1e-12) AS axis_aligned_area_fraction FROM normals GROUP BY mesh_id)"""
_PARTS = """,
ties AS (SELECT mesh_id, min(fid) AS f, max(fid) AS g FROM (SELECT mesh_id, fid, least(p, q) AS lo, greatest(p, q) AS hi FROM (SELECT mesh_id, fid, a AS p, b AS q FROM faces UNION ALL SELECT mesh_id, fid, b, c FROM faces UNION ALL SELECT mesh_id, fid, c, a FROM faces)) GROUP BY mesh_id, lo, hi HAVING count(*) = 2),
reach(mesh_id, f, g) AS (SELECT mesh_id, fid, fid FROM faces UNION SELECT r.mesh_id, r.f, CASE WHEN t.f = r.g THEN t.g ELSE t.f END FROM reach r JOIN ties t ON t.mesh_id = r.mesh_id AND (t.f = r.g OR t.g = r.g)),
labels AS (SELECT mesh_id, f, min(g) AS label FROM reach GROUP BY mesh_id, f),
parts AS (SELECT mesh_id, count(*) AS num_components, max(n) AS largest_faces FROM (SELECT mesh_id, label, count(*) AS n FROM labels GROUP BY ALL) GROUP BY mesh_id)"""
_POINTS = """,
points AS (SELECT p_partkey AS mesh_id, i::BIGINT AS pid, (((p_partkey * 7919 + i * 104729) % 997) / 997.0::DOUBLE * 1.1::DOUBLE - 0.55::DOUBLE) * p_size AS x,
  (((p_partkey * 6007 + i * 7001) % 991) / 991.0::DOUBLE * 1.1::DOUBLE - 0.55::DOUBLE) * p_retailprice / 100 AS y, (((p_partkey * 3001 + i * 9001) % 983) / 983.0::DOUBLE * 1.1::DOUBLE - 0.55::DOUBLE) * (p_partkey % 9 + 1) AS z FROM part, range(20) r(i)),
sides AS (SELECT p.mesh_id, p.pid,
  (((ay > y) <> (by_ > y)) AND az + (y - ay) / nullif(by_ - ay, 0) * (bz - az) > z)::INT + (((by_ > y) <> (cy > y)) AND bz + (y - by_) / nullif(cy - by_, 0) * (cz - bz) > z)::INT + (((cy > y) <> (ay > y)) AND cz + (y - cy) / nullif(ay - cy, 0) * (az - cz) > z)::INT AS s,
  ax - (ny * (y - ay) + nz * (z - az)) / nullif(nx, 0) > x AS ahead FROM points p JOIN normals n ON n.mesh_id = p.mesh_id),
parity AS (SELECT p.mesh_id, p.pid, coalesce(n, 0) AS crossings, coalesce(n, 0) % 2 = 1 AS inside FROM points p LEFT JOIN (SELECT mesh_id, pid, count(*) AS n FROM sides WHERE s % 2 = 1 AND ahead GROUP BY ALL) h ON h.mesh_id = p.mesh_id AND h.pid = p.pid)"""

_UPWARD = """,
above AS (SELECT p.mesh_id, p.pid, nz,
  (((ax > x) <> (bx > x)) AND ay + (x - ax) / nullif(bx - ax, 0) * (by_ - ay) > y)::INT + (((bx > x) <> (cx > x)) AND by_ + (x - bx) / nullif(cx - bx, 0) * (cy - by_) > y)::INT + (((cx > x) <> (ax > x)) AND cy + (x - cx) / nullif(ax - cx, 0) * (ay - cy) > y)::INT AS s,
  az - (nx * (x - ax) + ny * (y - ay)) / nullif(nz, 0) > z AS ahead FROM points p JOIN normals n ON n.mesh_id = p.mesh_id)"""

ORACLE_SQL = {
    "mesh_edges": f"{SQL}{_EDGES} SELECT * FROM edges",
    "mesh_manifold": f"{SQL}{_EDGES} SELECT * FROM manifold",
    "mesh_summary": f"{SQL}{_EDGES}{_CORNERS}{_BOX} SELECT mesh_id, num_vertices, num_faces, is_watertight, is_winding_consistent, CASE WHEN is_watertight THEN num_vertices - num_edges + num_faces END AS euler_number, CASE WHEN is_watertight THEN round(signed_volume, 6) END AS volume, round(area, 6) AS area, round(ex, 6) AS extent_x, round(ey, 6) AS extent_y, round(ez, 6) AS extent_z FROM box JOIN surface USING (mesh_id) JOIN manifold USING (mesh_id)",
    "mesh_components": f"{SQL}{_PARTS} SELECT * FROM parts",
    "largest_component": f"{SQL}{_PARTS}, best AS (SELECT mesh_id, label FROM (SELECT mesh_id, label, row_number() OVER (PARTITION BY mesh_id ORDER BY count(*) DESC, label) AS k FROM labels GROUP BY mesh_id, label) WHERE k = 1) SELECT f.mesh_id, f.fid, f.a, f.b, f.c FROM faces f JOIN labels l ON l.mesh_id = f.mesh_id AND l.f = f.fid JOIN best ON best.mesh_id = l.mesh_id AND best.label = l.label",
    "fit_unit_cube": f"{SQL}{_BOX}, fit AS (SELECT mesh_id, cx, cy, cz, greatest(ex, ey, ez) * (1 + 2 * 0.03::DOUBLE) AS scale FROM box) SELECT v.mesh_id, vid, round((x - cx) / scale + 0.5, 6) AS x, round((y - cy) / scale + 0.5, 6) AS y, round((z - cz) / scale + 0.5, 6) AS z, round(cx, 6) AS cx, round(cy, 6) AS cy, round(cz, 6) AS cz, round(scale, 6) AS scale FROM vertices v JOIN fit USING (mesh_id)",
    "primitive_score": f"{SQL}{_CORNERS}{_AXIS} SELECT mesh_id, num_faces, round(axis_aligned_area_fraction, 6) AS axis_aligned_area_fraction FROM axis",
    "vertex_normals": f"{SQL}{_CORNERS}, s AS (SELECT mesh_id, vid, sum(nx) AS nx, sum(ny) AS ny, sum(nz) AS nz FROM (SELECT mesh_id, a AS vid, nx, ny, nz FROM normals UNION ALL SELECT mesh_id, b, nx, ny, nz FROM normals UNION ALL SELECT mesh_id, c, nx, ny, nz FROM normals) GROUP BY ALL) SELECT mesh_id, vid, round(nx / greatest(sqrt(nx * nx + ny * ny + nz * nz), 1e-12), 6) AS nx, round(ny / greatest(sqrt(nx * nx + ny * ny + nz * nz), 1e-12), 6) AS ny, round(nz / greatest(sqrt(nx * nx + ny * ny + nz * nz), 1e-12), 6) AS nz FROM s",
    "merged_mesh": f"{SQL}, used AS (SELECT mesh_id, a AS vid FROM faces UNION SELECT mesh_id, b FROM faces UNION SELECT mesh_id, c FROM faces) SELECT mesh_id, num_vertices, num_faces FROM (SELECT mesh_id, count(*) AS num_vertices FROM used GROUP BY mesh_id) JOIN (SELECT mesh_id, count(*) AS num_faces FROM faces GROUP BY mesh_id) USING (mesh_id)",
    "stage4_filter": f"{SQL}{_EDGES}{_CORNERS}{_BOX}{_AXIS}{_PARTS}, m AS (SELECT mesh_id, CASE WHEN is_watertight THEN abs(signed_volume) / (area + 1e-12) END AS ratio, num_components, num_vertices, axis_aligned_area_fraction AS share FROM surface JOIN manifold USING (mesh_id) JOIN box USING (mesh_id) JOIN axis USING (mesh_id) JOIN parts USING (mesh_id)), r AS (SELECT mesh_id, ratio, concat_ws('|', CASE WHEN num_components > 2 THEN 'too_many_components=' || num_components END, CASE WHEN ratio < 1.0 THEN 'thin_shell_vol_area=' || format('{{:.4f}}', ratio) END, CASE WHEN num_vertices < 500 AND share > 0.85 THEN 'primitive_like' END) AS reasons FROM m) SELECT mesh_id, round(ratio, 6) AS volume_area_ratio, reasons, reasons = '' AS is_valid FROM r",
    "corpus_qc": f"{SQL}{_EDGES}{_CORNERS}, q AS (SELECT p_brand AS dataset, is_watertight AND is_winding_consistent AND abs(signed_volume) / area > 1.0 AS accepted FROM manifold JOIN surface USING (mesh_id) JOIN part ON p_partkey = mesh_id) SELECT dataset, count(*) AS total, count(*) FILTER (WHERE accepted) AS n_accept, round(count(*) FILTER (WHERE accepted) / count(*), 4) AS retention FROM q GROUP BY dataset",
    "up_axis_score": f"{SQL}{_CORNERS}, s AS (SELECT mesh_id, " + ", ".join(f"round(coalesce(sum(area) FILTER (WHERE abs(n{d}) > cos(radians(20)) * 2 * area), 0) / (sum(area) + 1e-12), 9) AS score_{d}" for d in "xyz") + " FROM normals GROUP BY mesh_id), u AS (SELECT *, CASE WHEN score_y >= round(greatest(score_x, score_y, score_z) - 0.05, 9) THEN 'y' WHEN score_x = greatest(score_x, score_y, score_z) THEN 'x' ELSE 'z' END AS up FROM s), e AS (SELECT mesh_id, min(p) AS lo, max(p) AS hi FROM (SELECT v.mesh_id, CASE up WHEN 'x' THEN x WHEN 'y' THEN y ELSE z END AS p FROM vertices v JOIN u USING (mesh_id)) GROUP BY mesh_id) SELECT mesh_id, round(score_x, 6) AS score_x, round(score_y, 6) AS score_y, round(score_z, 6) AS score_z, up, round(CASE up WHEN 'x' THEN score_x WHEN 'y' THEN score_y ELSE score_z END, 6) AS up_score, CASE WHEN abs(lo) < abs(hi) OR hi - lo < 1e-9 THEN 1 ELSE -1 END AS sign FROM u JOIN e USING (mesh_id)",
    "scatter_matrix": f"{SQL}, p AS (SELECT mesh_id, x, 0.0::DOUBLE AS y, z FROM vertices) SELECT mesh_id, " + ", ".join(f"round(sum({a} * {b}) - sum({a}) * sum({b}) / count(*), 4) + 0.0 AS s{a}{b}" for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")) + " FROM p GROUP BY mesh_id",
    "third_moment": "SELECT l_returnflag AS mesh_id, round(sum(x * x * x) / count(*) - 3 * (sum(x) / count(*)) * sum(x * x) / count(*) + 2 * (sum(x) / count(*)) * (sum(x) / count(*)) * (sum(x) / count(*)), 3) AS third_moment FROM (SELECT l_returnflag, l_quantity AS x FROM lineitem) GROUP BY l_returnflag",
    "rotation_apply": f"{SQL}, t AS (SELECT mesh_id, vid, -y AS x, x AS y, z FROM vertices), b AS (SELECT mesh_id, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz FROM t GROUP BY mesh_id) SELECT mesh_id, vid, round(x - cx, 6) AS x, round(y - cy, 6) AS y, round(z - cz, 6) AS z FROM t JOIN b USING (mesh_id)",
    "ray_parity_inside": f"{SQL}{_CORNERS}{_POINTS} SELECT * FROM parity",
    "sign_agreement": f"{SQL}{_CORNERS}{_POINTS}, b AS (SELECT p.mesh_id, p.pid, abs(x) < p_size / 2 AND abs(y) < p_retailprice / 200 AND abs(z) < (p.mesh_id % 9 + 1) / 2 AS other FROM points p JOIN part ON p_partkey = p.mesh_id) SELECT mesh_id, count(*) AS ray_samples, round(avg((inside = other)::INT), 6) AS ray_sign_agreement, round(avg(inside::INT), 6) AS fraction_inside_gt, round(avg(other::INT), 6) AS fraction_inside_other FROM parity JOIN b USING (mesh_id, pid) GROUP BY mesh_id",
    "ray_agreement": f"{SQL}{_CORNERS}{_POINTS}{_UPWARD}, o AS (SELECT p.mesh_id, p.pid, coalesce(w, 0) > 0 AS other FROM points p LEFT JOIN (SELECT mesh_id, pid, sum(sign(nz)) AS w FROM above WHERE s % 2 = 1 AND ahead GROUP BY ALL) h ON h.mesh_id = p.mesh_id AND h.pid = p.pid) SELECT mesh_id, count(*) AS ray_samples, round(avg((inside = other)::INT), 6) AS ray_sign_agreement, round(avg(inside::INT), 6) AS fraction_inside_gt, round(avg(other::INT), 6) AS fraction_inside_other FROM parity JOIN o USING (mesh_id, pid) GROUP BY mesh_id",
    "surface_sample_counts": "SELECT p_partkey AS mesh_id, 100::BIGINT AS n, 0::BIGINT AS n_outside FROM part",
}
