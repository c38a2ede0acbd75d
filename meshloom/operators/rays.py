"""Inside tests by ray crossings, relational: points meet triangles of their mesh in cells of the plane across the rays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .meet import meet
from .packed import meshes

#: Grids of 1, 2, 4 ... cells a side, up to the square root of a mesh's number of triangles, so a cell of the finest holds a few; exponents of two within these bounds.
LEAST_LEVEL, MOST_LEVEL = 3, 11


def _across(axis: str) -> str:
    return {"x": "yz", "y": "zx", "z": "xy"}[axis]


def _boxes(corners: DataFrame, flat: str) -> DataFrame:
    """(mesh_id, _top, and per direction the least and greatest coordinate of a mesh): the box across the rays and the finest grid."""
    box = corners.groupBy("mesh_id").agg(F.count("*").alias("_n"), *[f(f"{c}{d}").alias(f"{c}{d}{n}") for c in "abc" for d in flat for f, n in ((F.min, "lo"), (F.max, "hi"))])
    top = F.greatest(F.lit(LEAST_LEVEL), F.least(F.lit(MOST_LEVEL), F.ceil(F.log2("_n") / 2))).cast("int")
    return box.select("mesh_id", top.alias("_top"), *[F.least(*[f"{c}{d}lo" for c in "abc"]).alias(f"{d}0") for d in flat], *[F.greatest(*[f"{c}{d}hi" for c in "abc"]).alias(f"{d}1") for d in flat])


def _place(v, d: str):
    """Where a coordinate lies in its mesh's box, from 0 to 1."""
    return (v - F.col(f"{d}0")) / F.greatest(F.col(f"{d}1") - F.col(f"{d}0"), F.lit(1e-300))


def _cell(v, d: str):
    side = F.expr("shiftleft(1, _level)")
    return F.greatest(F.lit(0), F.least(side - 1, F.floor(_place(v, d) * side))).cast("int")


def triangle_cells(corners: DataFrame, axis: str = "x") -> DataFrame:
    """corners with _level, g and h: each triangle in the cells that it touches of the grid whose cells are at least as wide as it, so in at most four."""
    flat = _across(axis)
    low, high = ({d: f(*[F.col(f"{c}{d}") for c in "abc"]) for d in flat} for f in (F.least, F.greatest))
    wide = F.greatest(F.lit(1e-9), *[_place(high[d], d) - _place(low[d], d) for d in flat])
    t = meet(corners, _boxes(corners, flat), "mesh_id").withColumn("_level", F.least(F.col("_top"), F.greatest(F.lit(0), F.floor(-F.log2(wide)).cast("int"))))
    for d, name in zip(flat, "gh", strict=True):
        t = t.withColumn(name, F.explode(F.sequence(_cell(low[d], d), _cell(high[d], d))))
    return t.drop("_top", *[f"{d}{n}" for d in flat for n in "01"])


def point_cells(points: DataFrame, corners: DataFrame, axis: str = "x") -> DataFrame:
    """points with _level, g and h: the cell of each point in every grid of its mesh."""
    flat = _across(axis)
    p = meet(points, _boxes(corners, flat), "mesh_id").withColumn("_level", F.explode(F.sequence(F.lit(0), F.col("_top"))))
    return p.withColumns({name: _cell(F.col(d), d) for d, name in zip(flat, "gh", strict=True)}).drop("_top", *[f"{d}{n}" for d in flat for n in "01"])


def ray_crossings(points: DataFrame, corners: DataFrame, axis: str = "x") -> DataFrame:
    """(mesh_id, pid, crossings, winding) of a ray along an axis, upwards, from each point: how often it crosses the mesh, and outward less inward.

    corners is topology.corners. Grids over each mesh's box across the axis bucket both sides, a triangle in
    the grid of its size and a point in all of them, so it is an equi-join with a residual test whose sides
    don't grow with the area of triangles. Edges of triangles count half-open (a vertex at the ray's height
    counts as above), so a ray through a shared edge crosses it once.
    """
    along, (first, second) = axis, _across(axis)
    met = meet(point_cells(points, corners, axis), triangle_cells(corners, axis), ["mesh_id", "_level", "g", "h"])

    def spans(u: str, v: str):
        """The edge u-v passes the point's height in the first direction, beyond the point in the second."""
        passes = (F.col(f"{u}{first}") > F.col(first)) != (F.col(f"{v}{first}") > F.col(first))
        at = F.col(f"{u}{second}") + (F.col(first) - F.col(f"{u}{first}")) / F.nullif(F.col(f"{v}{first}") - F.col(f"{u}{first}"), F.lit(0.0)) * (F.col(f"{v}{second}") - F.col(f"{u}{second}"))
        return passes & (at > F.col(second))

    inside_projection = F.pmod(sum(F.coalesce(spans(u, v), F.lit(False)).cast("int") for u, v in (("a", "b"), ("b", "c"), ("c", "a"))), F.lit(2)) == 1
    order = along + first + second
    e1, e2 = ([F.col(f"{k}{d}") - F.col(f"a{d}") for d in order] for k in "bc")
    n0, n1, n2 = e1[1] * e2[2] - e1[2] * e2[1], e1[2] * e2[0] - e1[0] * e2[2], e1[0] * e2[1] - e1[1] * e2[0]
    at = F.col(f"a{along}") - (n1 * (F.col(first) - F.col(f"a{first}")) + n2 * (F.col(second) - F.col(f"a{second}"))) / F.nullif(n0, F.lit(0.0))
    hits = met.where(inside_projection & (at > F.col(along))).groupBy("mesh_id", "pid").agg(F.count("*").alias("n"), F.sum(F.signum(n0)).cast("long").alias("w"))
    out = meet(points.select("mesh_id", "pid"), hits, ["mesh_id", "pid"], "left")
    return out.select("mesh_id", "pid", F.coalesce("n", F.lit(0)).alias("crossings"), F.coalesce("w", F.lit(0)).alias("winding"))


def parity_inside(points: DataFrame, corners: DataFrame, axis: str = "x") -> DataFrame:
    """(mesh_id, pid, crossings, inside): whether a ray along an axis crosses the mesh an odd number of times; without a crossing it is outside."""
    return ray_crossings(points, corners, axis).select("mesh_id", "pid", "crossings", (F.col("crossings") % 2 == 1).alias("inside"))


def winding_inside(points: DataFrame, corners: DataFrame, axis: str = "z") -> DataFrame:
    """(mesh_id, pid, winding, inside): whether a ray along an axis leaves the mesh more often than it enters.

    It agrees with parity along another axis on closed meshes whose faces look outwards; holes, turned
    faces and overlapping parts set the two apart.
    """
    return ray_crossings(points, corners, axis).select("mesh_id", "pid", "winding", (F.col("winding") > 0).alias("inside"))


def sign_agreement(truth: DataFrame, other: DataFrame) -> DataFrame:
    """(mesh_id, ray_samples, ray_sign_agreement, fraction_inside_gt, fraction_inside_other) of two inside tests (mesh_id, pid, inside)."""
    both = meet(truth.select("mesh_id", "pid", F.col("inside").alias("a")), other.select("mesh_id", "pid", F.col("inside").alias("b")), ["mesh_id", "pid"])
    share = lambda c: F.avg(c.cast("double"))
    return both.groupBy("mesh_id").agg(
        F.count("*").alias("ray_samples"), share(F.col("a") == F.col("b")).alias("ray_sign_agreement"), share(F.col("a")).alias("fraction_inside_gt"), share(F.col("b")).alias("fraction_inside_other")
    )


#: Steps of an additive sequence that fills the unit cube evenly: the first three powers of 1 / 1.2207440846057596, the root of x^4 = x + 1.
STEPS = (0.8191725133961645, 0.6710436067037893, 0.5497004779019703)


def unit_points(spark: SparkSession, n: int) -> DataFrame:
    """(pid, ux, uy, uz): n evenly spread points of the unit cube, the same in every run; one table for all meshes, of a size set by n."""
    return spark.range(n).select(F.col("id").alias("pid"), *[F.pmod(F.lit(0.5) + (F.col("id") + 1) * F.lit(step), F.lit(1.0)).alias(f"u{d}") for d, step in zip("xyz", STEPS, strict=True)])


def box_points(vertices: DataFrame, unit: DataFrame, margin: float = 0.05) -> DataFrame:
    """(mesh_id, pid, x, y, z): the unit points in each mesh's box, widened by `margin` of its extent on every side."""
    box = vertices.groupBy("mesh_id").agg(*[f(d).alias(f"{d}{n}") for d in "xyz" for f, n in ((F.min, 0), (F.max, 1))])
    wide = box.join(F.broadcast(unit), how="cross")  # n points by contract, not data
    return wide.select("mesh_id", "pid", *[((F.col(f"{d}0") - (F.col(f"{d}1") - F.col(f"{d}0")) * margin) + F.col(f"u{d}") * (F.col(f"{d}1") - F.col(f"{d}0")) * (1 + 2 * margin)).alias(d) for d in "xyz"])


#: Triangles of a mesh whose rays are shot in its task, and samples that a task tests at once.
FEW_TRIANGLES, AT_ONCE = 64, 1 << 15


def has_few(most: int = FEW_TRIANGLES) -> Column:
    """Of a packed mesh: whether it has at most `most` triangles and finite vertices alone."""
    return (F.size("faces") <= most) & F.coalesce(F.forall("vertices", lambda p: (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")) & (F.abs(p["z"]) < float("inf"))), F.lit(False))


def _crossed(points: list[np.ndarray], tri: np.ndarray, axis: str) -> tuple[np.ndarray, np.ndarray]:
    """Which points' rays along the axis cross one triangle of each mesh, and the normal's part along it: points by coordinate (meshes, n), tri (meshes, 3, 3). The arithmetic is that of ray_crossings."""
    i, j, k = ("xyz".index(d) for d in axis + _across(axis))
    q, r, s = (points[d] for d in (i, j, k))
    a, b, c = ([tri[:, m, d, None] for d in (i, j, k)] for m in range(3))
    above = [u[1] > r for u in (a, b, c)]
    inside = np.zeros(r.shape, bool)
    for m, (u, v) in enumerate(((a, b), (b, c), (c, a))):
        inside ^= (above[m] != above[(m + 1) % 3]) & (u[2] + (r - u[1]) / (v[1] - u[1]) * (v[2] - u[2]) > s)
    e1, e2 = ([x - y for x, y in zip(v, a, strict=True)] for v in (b, c))
    n0, n1, n2 = e1[1] * e2[2] - e1[2] * e2[1], e1[2] * e2[0] - e1[0] * e2[2], e1[0] * e2[1] - e1[1] * e2[0]
    return inside & (n0 != 0) & (a[0] - (n1 * (r - a[1]) + n2 * (s - a[2])) / n0 > q), np.sign(n0)


def box_agreement(packed: DataFrame, n: int, margin: float = 0.05) -> DataFrame:
    """sign_agreement of parity_inside and winding_inside at the n points of box_points, for packed meshes of few triangles each: a mesh's points and triangles meet in its task, and no point becomes a row."""
    step = max(1, AT_ONCE // max(n, 1))
    unit = np.mod(0.5 + (np.arange(n)[:, None] + 1) * np.array(STEPS), 1.0)

    def shares(some: list) -> np.ndarray:
        """Agreement and the two shares inside, a row a mesh; all meshes' t-th triangles are met at once."""
        low, high = (np.array([f(m.vertices, axis=0) for m in some]) for f in (np.min, np.max))
        points = [(low[:, d, None] - (high - low)[:, d, None] * margin) + unit[:, d] * (high - low)[:, d, None] * (1 + 2 * margin) for d in range(3)]
        crossings, winding = (np.zeros((len(some), n), np.int64) for _ in range(2))
        faces = [m.faces[((m.faces >= 0) & (m.faces < len(m.vertices))).all(1)] for m in some]
        size = np.array([len(f) for f in faces])
        for t in range(size.max(initial=0)):
            own = np.flatnonzero(size > t)
            tri, at = np.array([some[k].vertices[faces[k][t]] for k in own]), [p[own] for p in points]
            crossings[own] += _crossed(at, tri, "x")[0]
            hit, side = _crossed(at, tri, "z")
            winding[own] += (hit * side).astype(np.int64)
        a, b = crossings % 2 == 1, winding > 0
        return np.stack([(x.sum(1) / n) for x in (a == b, a, b)], 1)

    def run(batches):
        for batch in batches:
            at, found = np.flatnonzero(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)), list(meshes(batch))
            for k in range(0, len(at), step):
                with np.errstate(divide="ignore", invalid="ignore"):  # edges along the ray's height, which the first test leaves out
                    share = shares([found[i] for i in at[k : k + step]])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[k : k + step])), pa.array(np.full(len(share), n)), *[pa.array(c) for c in share.T]], ["mesh_id", "ray_samples", "ray_sign_agreement", "fraction_inside_gt", "fraction_inside_other"])

    key = packed.schema["mesh_id"].dataType.simpleString()
    return packed.select("mesh_id", "vertices", "faces").mapInArrow(run, f"mesh_id {key}, ray_samples long, ray_sign_agreement double, fraction_inside_gt double, fraction_inside_other double")
