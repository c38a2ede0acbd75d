"""Pose: up axis from the areas of faces, forward axis from the spread of vertices, rotation to +Y up and +Z front."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.verdicts import AXES, parse_pose
from .cut import cut
from .meet import meet
from .packed import Mesh, map_meshes
from .topology import corners, dot, with_normals

#: Shares of area are rounded to so many places before they are compared, so equal ones are ties whatever the order of their sums.
PLACES = 9
CONE_DEG, Y_MARGIN, OBB_BELOW, REVIEW_BELOW, AGREE = 20.0, 0.05, 0.3, 0.05, 0.8


# Relational measures ----------------------------------------------------------------------------


def up_scores(vertices: DataFrame, faces: DataFrame, cone_deg: float = CONE_DEG) -> DataFrame:
    """(mesh_id, score_x, score_y, score_z, up, up_score): the share of area whose normal lies within the cone of each axis; the best axis, Y if it is close."""
    at = with_normals(corners(vertices, faces))
    least = F.cos(F.radians(F.lit(cone_deg))) * 2 * F.col("area")
    share = lambda d: F.round(F.coalesce(F.sum(F.when(F.abs(f"n{d}") > least, F.col("area"))), F.lit(0.0)) / (F.sum("area") + 1e-12), PLACES).alias(f"score_{d}")
    out = at.groupBy("mesh_id").agg(*[share(d) for d in "xyz"])
    best = F.greatest("score_x", "score_y", "score_z")
    up = F.when(F.col("score_y") >= F.round(best - Y_MARGIN, PLACES), "y").when(F.col("score_x") == best, "x").otherwise("z")
    out = out.withColumn("up", up)
    return out.withColumn("up_score", F.when(F.col("up") == "x", F.col("score_x")).when(F.col("up") == "y", F.col("score_y")).otherwise(F.col("score_z")))


def up_sign(vertices: DataFrame, up: DataFrame, tie: str = "flip") -> DataFrame:
    """(mesh_id, up, sign): the end of the vertices' range nearer the origin is the floor; ties flip, or stay with tie='keep'."""
    along = meet(vertices, up.select("mesh_id", "up"), "mesh_id").withColumn("p", F.when(F.col("up") == "x", F.col("x")).when(F.col("up") == "y", F.col("y")).otherwise(F.col("z")))
    ends = along.groupBy("mesh_id", "up").agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
    keep = (F.abs("lo") < F.abs("hi")) | (F.col("hi") - F.col("lo") < 1e-9) | (F.lit(tie == "keep") & (F.abs("lo") == F.abs("hi")))
    return ends.select("mesh_id", "up", F.when(keep, 1).otherwise(-1).alias("sign"))


def scatter(vertices: DataFrame, up: tuple[float, float, float] = (0.0, 1.0, 0.0)) -> DataFrame:
    """(mesh_id, sxx, sxy, sxz, syy, syz, szz): the unnormalised scatter of the vertices projected off `up`."""
    u = [F.lit(float(c)) for c in up]
    p = [F.col(d) for d in "xyz"]
    q = [a - dot(p, u) * b for a, b in zip(p, u, strict=True)]
    flat = vertices.select("mesh_id", *[c.alias(d) for c, d in zip(q, "xyz", strict=True)])
    pairs = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    return flat.groupBy("mesh_id").agg(*[(F.sum(F.col(a) * F.col(b)) - F.sum(a) * F.sum(b) / F.count("*")).alias(f"s{a}{b}") for a, b in pairs])


def third_moment(vertices: DataFrame, axis: str) -> DataFrame:
    """(mesh_id, third_moment): mean of the cubed distances from the mean along a coordinate axis, from power sums."""
    x, n = F.col(axis), F.count("*")
    m = F.sum(x) / n
    return vertices.groupBy("mesh_id").agg((F.sum(x * x * x) / n - 3 * m * F.sum(x * x) / n + 2 * m * m * m).alias("third_moment"))


def rotate(vertices: DataFrame, rotation: list[list[Column | float]]) -> DataFrame:
    """R v for every vertex, then the middle of each mesh's box at the origin. rotation holds numbers or columns."""
    p = [F.col(d) for d in "xyz"]
    rows = [dot([F.lit(c) if isinstance(c, (int, float)) else c for c in r], p) for r in rotation]
    turned = vertices.select("mesh_id", "vid", *[r.alias(d) for r, d in zip(rows, "xyz", strict=True)])
    box = turned.groupBy("mesh_id").agg(*[((F.min(d) + F.max(d)) / 2).alias(f"c{d}") for d in "xyz"])
    return meet(turned, box, "mesh_id").select("mesh_id", "vid", *[(F.col(d) - F.col(f"c{d}")).alias(d) for d in "xyz"])


# Whole poses, one mesh at a time ----------------------------------------------------------------


def rotation_to(up: np.ndarray, forward: np.ndarray) -> np.ndarray:
    """Rows right, up, forward: takes up to +Y and forward to +Z; a proper rotation."""
    up = up / max(np.linalg.norm(up), 1e-10)
    forward = forward - up * (forward @ up)
    forward = forward / max(np.linalg.norm(forward), 1e-10)
    return np.stack([np.cross(up, forward), up, forward])


def up_axis(mesh: Mesh, tie: str = "flip") -> tuple[np.ndarray, float]:
    tri = mesh.vertices[mesh.faces]
    n = np.cross(tri[:, 1] - tri[:, 0], tri[:, 2] - tri[:, 0])
    size = np.linalg.norm(n, axis=1)
    n, area = n / np.maximum(size, 1e-12)[:, None], size / 2
    share = lambda a: float(area[np.abs(n @ a) > np.cos(np.radians(CONE_DEG))].sum() / (area.sum() + 1e-12))
    world = np.eye(3)
    scores = [round(share(a), PLACES) for a in world]
    k = 1 if scores[1] >= round(max(scores) - Y_MARGIN, PLACES) else int(np.argmax(scores))
    axis, score = world[k], scores[k]
    if score < OBB_BELOW:  # principal axes stand in for those of the least box
        _, own = np.linalg.eigh(np.cov((mesh.vertices - mesh.vertices.mean(0)).T))
        for a in own.T:
            if (s := share(a)) > score:
                axis, score = a, s
    p = mesh.vertices @ axis
    lo, hi = abs(p.min()), abs(p.max())
    flip = np.ptp(p) >= 1e-9 and (lo > hi or lo == hi and tie == "flip")
    return (-axis if flip else axis), score


def forward_axis(vertices: np.ndarray, up: np.ndarray) -> np.ndarray:
    """The widest direction off `up`, towards its longer tail; without a tail its first component that isn't 0 is positive."""
    flat = vertices - np.outer(vertices @ up, up)
    flat = flat - flat.mean(0)
    _, own = np.linalg.eigh(flat.T @ flat)
    a = own[:, -1] - up * (own[:, -1] @ up)
    a = a / max(np.linalg.norm(a), 1e-10)
    p = flat @ a
    m, scale = float((p**3).mean()), float(np.abs(p).max()) ** 3
    if abs(m) <= 1e-9 * scale:
        return a * np.sign(a[np.abs(a) > 1e-9][0])
    return -a if m < 0 else a


def centred(vertices: np.ndarray) -> np.ndarray:
    return vertices - (vertices.min(0) + vertices.max(0)) / 2


_POSE = "method string, up_axis_world array<double>, forward_axis_world array<double>, rotation_matrix array<array<double>>, needs_manual_review boolean, geom_inlier_fraction double"


def geometric_pose(mesh: Mesh, tie: str = "flip") -> dict:
    up, score = up_axis(mesh, tie)
    forward = forward_axis(mesh.vertices, up)
    return {"method": "geom", "up_axis_world": up.tolist(), "forward_axis_world": forward.tolist(), "rotation_matrix": rotation_to(up, forward).tolist(), "needs_manual_review": score < REVIEW_BELOW, "geom_inlier_fraction": score}


def identity_pose(_: Mesh) -> dict:
    return {"method": "identity", "up_axis_world": [0.0, 1.0, 0.0], "forward_axis_world": [0.0, 0.0, 1.0], "rotation_matrix": np.eye(3).tolist(), "needs_manual_review": False, "geom_inlier_fraction": None}


def canonicalise(packed: DataFrame, method: str = "geom", tie: str = "flip") -> DataFrame:
    """The pose report of every packed mesh by 'geom' or 'identity', and error."""
    return map_meshes(packed, (lambda m: geometric_pose(m, tie)) if method == "geom" else identity_pose, _POSE, clock=True)


def downgrade(method: str, skip_model: bool) -> str:
    """A pose method that needs the model falls back to geometry without it."""
    return "geom" if skip_model and method in ("vlm", "hybrid") else method


def label_axis(label: Column) -> Column:
    """The unit vector of an axis label, null if unknown."""
    out = F.lit(None).cast("array<double>")
    for name, v in AXES.items():
        out = F.when(label == name, F.array(*[F.lit(float(c)) for c in v])).otherwise(out)
    return out


def hybrid_pose(geometry: DataFrame, labels: DataFrame, agree: float = AGREE) -> DataFrame:
    """Model poses where they agree with geometry, else geometry for review.

    geometry is a pose report; labels has (mesh_id, up, front, ok) from verdicts.parse_pose. A mesh
    without a usable reply keeps its geometric pose and is for review.
    """
    out = geometry.join(labels, "mesh_id", "left")
    up, front = label_axis(F.when(F.col("ok"), F.col("up"))), label_axis(F.when(F.col("ok"), F.col("front")))
    g = F.col("up_axis_world")
    agrees = F.abs(sum(g[k] * up[k] for k in range(3))) >= agree
    use = F.coalesce(agrees, F.lit(False))
    right = F.array(*[up[(k + 1) % 3] * front[(k + 2) % 3] - up[(k + 2) % 3] * front[(k + 1) % 3] for k in range(3)])
    return out.select(
        "mesh_id", F.lit("hybrid").alias("method"), F.when(use, up).otherwise(g).alias("up_axis_world"), F.when(use, front).otherwise(F.col("forward_axis_world")).alias("forward_axis_world"),
        F.when(use, F.array(right, up, front)).otherwise(F.col("rotation_matrix")).alias("rotation_matrix"), F.col("up").alias("vlm_up_label"), F.col("front").alias("vlm_front_label"),
        F.when(F.coalesce("ok", F.lit(False)), use).alias("vlm_agrees_with_geom"), (~use).alias("needs_manual_review"), "geom_inlier_fraction",
    )


def model_pose(geometry: DataFrame, labels: DataFrame) -> DataFrame:
    """The pose that the model names for each mesh of a pose report; without a usable reply the identity, for review."""
    out = geometry.select("mesh_id").join(labels, "mesh_id", "left")
    ok = F.coalesce("ok", F.lit(False))
    up, front = label_axis(F.when(ok, F.col("up"))), label_axis(F.when(ok, F.col("front")))
    numbers = lambda rows: F.array(*[F.array(*[F.lit(float(c)) for c in r]) for r in rows])
    right = F.array(*[up[(k + 1) % 3] * front[(k + 2) % 3] - up[(k + 2) % 3] * front[(k + 1) % 3] for k in range(3)])
    return out.select(
        "mesh_id", F.lit("vlm").alias("method"), F.coalesce(up, numbers([(0, 1, 0)])[0]).alias("up_axis_world"), F.coalesce(front, numbers([(0, 0, 1)])[0]).alias("forward_axis_world"),
        F.when(ok, F.array(right, up, front)).otherwise(numbers(np.eye(3))).alias("rotation_matrix"), F.col("up").alias("vlm_up_label"), F.col("front").alias("vlm_front_label"),
        F.lit(None).cast("boolean").alias("vlm_agrees_with_geom"), (~ok).alias("needs_manual_review"), F.lit(None).cast("double").alias("geom_inlier_fraction"),
    )


def find_poses(packed: DataFrame, method: str = "geom", factory: Callable | None = None, res: int = 384, batch_size: int = 4) -> DataFrame:
    """The pose report of every packed mesh by 'geom', 'identity', 'vlm' or 'hybrid'; the last two show six views to the model that factory makes."""
    from .render import render_grids
    from .scorers import POSE_PROMPT, infer

    base = canonicalise(packed, "identity" if method == "identity" else "geom")
    if method not in ("vlm", "hybrid"):
        null = F.lit(None)
        return base.withColumns({"vlm_up_label": null.cast("string"), "vlm_front_label": null.cast("string"), "vlm_agrees_with_geom": null.cast("boolean")})
    if factory is None:
        raise ValueError(f"pose method {method!r} needs an image scorer")
    base = cut(base)
    replies = infer(render_grids(packed, res, six=True), factory, batch_size=batch_size, prompt=POSE_PROMPT)
    labels = cut(replies.select("mesh_id", parse_pose(F.col("raw_response")).alias("p"), F.col("error").alias("vlm_error")).select("mesh_id", "p.*", "vlm_error"))
    out = (hybrid_pose if method == "hybrid" else model_pose)(base.drop("seconds"), labels.drop("vlm_error"))
    return out.join(base.select("mesh_id", "seconds", "error"), "mesh_id").join(labels.select("mesh_id", "vlm_error"), "mesh_id", "left").withColumn("error", F.coalesce("error", "vlm_error")).drop("vlm_error")


def apply_pose(packed: DataFrame, poses: DataFrame) -> DataFrame:
    """(mesh_id, vertices, faces) with R v and the middle of the box at the origin."""
    both = meet(packed, poses.select("mesh_id", "rotation_matrix"), "mesh_id")
    m = F.col("rotation_matrix")
    turned = F.transform("vertices", lambda p: F.struct(*[(m[r][0] * p["x"] + m[r][1] * p["y"] + m[r][2] * p["z"]).alias(d) for r, d in enumerate("xyz")]))
    axis = lambda t, d: F.transform(t, lambda p: p[d])
    middle = lambda t, d: (F.array_min(axis(t, d)) + F.array_max(axis(t, d))) / 2
    # one-element arrays bind the turned vertices and their middle, so neither is worked out twice
    centred_ = F.transform(F.array(turned), lambda t: F.struct(t.alias("t"), *[middle(t, d).alias(f"c{d}") for d in "xyz"]))
    moved = F.transform(centred_, lambda b: F.transform(b["t"], lambda p: F.struct(*[(p[d] - b[f"c{d}"]).alias(d) for d in "xyz"])))
    return both.select("mesh_id", F.get(moved, F.lit(0)).alias("vertices"), "faces")
