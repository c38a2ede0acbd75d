"""Edges, manifoldness, components and summary measures of meshes held as vertex and face tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut
from .meet import meet
from .packed import JOINED, Mesh, joined, larger, map_meshes


def edges(faces: DataFrame) -> DataFrame:
    """(mesh_id, lo, hi, n, n_forward): each undirected edge, the faces that use it and how many run from lo to hi."""
    pairs = F.explode(F.array(*[F.struct(F.least(p, q).alias("lo"), F.greatest(p, q).alias("hi"), (F.col(p) < F.col(q)).alias("fwd")) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))]))
    return faces.select("mesh_id", pairs.alias("e")).groupBy("mesh_id", "e.lo", "e.hi").agg(F.count("*").alias("n"), F.count_if("e.fwd").alias("n_forward")).select("mesh_id", "lo", "hi", "n", "n_forward")


def manifoldness(faces: DataFrame) -> DataFrame:
    """(mesh_id, num_edges, is_watertight, is_winding_consistent): every edge has two faces; those with two run opposite ways."""
    return edges(faces).groupBy("mesh_id").agg(
        F.count("*").alias("num_edges"), F.every(F.col("n") == 2).alias("is_watertight"), F.every((F.col("n") != 2) | (F.col("n_forward") == 1)).alias("is_winding_consistent")
    )


def corners(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces with the coordinates of their corners: ax ... cz. Vertex ids run from 0 without gaps.

    A mesh's vertices become one array that its faces index, so either table is shuffled once, by mesh,
    instead of three times by mesh and vertex.
    """
    v = vertices.groupBy("mesh_id").agg(F.sort_array(F.collect_list(F.struct("vid", "x", "y", "z"))).alias("v"))
    out = meet(faces, v, "mesh_id")
    return out.select("mesh_id", "fid", "a", "b", "c", *[F.get("v", F.col(c))[d].alias(f"{c}{d}") for c in "abc" for d in "xyz"])


def cross(u: list[Column], v: list[Column]) -> list[Column]:
    return [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]


def dot(u, v) -> Column:
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def with_normals(at: DataFrame) -> DataFrame:
    """corners() with the raw normal nx, ny, nz (twice the area long) and area."""
    p = {c: [F.col(f"{c}{d}") for d in "xyz"] for c in "abc"}
    n = cross([x - y for x, y in zip(p["b"], p["a"], strict=True)], [x - y for x, y in zip(p["c"], p["a"], strict=True)])
    return at.withColumns({"nx": n[0], "ny": n[1], "nz": n[2]}).withColumn("area", F.sqrt(dot(*[[F.col("nx"), F.col("ny"), F.col("nz")]] * 2)) / 2)


def surface(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """(mesh_id, area, signed_volume, num_faces)."""
    at = with_normals(corners(vertices, faces))
    a, b, c = ([F.col(f"{k}{d}") for d in "xyz"] for k in "abc")
    return at.groupBy("mesh_id").agg(F.sum("area").alias("area"), (F.sum(dot(a, cross(b, c))) / 6).alias("signed_volume"), F.count("*").alias("num_faces"))


def summarize(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """The summary record of each mesh; euler_number and volume are null unless it is watertight."""
    box = vertices.groupBy("mesh_id").agg(F.count("*").alias("num_vertices"), F.array(*[F.max(d) - F.min(d) for d in "xyz"]).alias("bbox_extent"))
    out = meet(meet(box, surface(vertices, faces), "mesh_id"), manifoldness(faces), "mesh_id")
    closed = lambda x: F.when(F.col("is_watertight"), x)
    return out.select(
        "mesh_id", "num_vertices", "num_faces", "is_watertight", "is_winding_consistent", closed(F.col("num_vertices") - F.col("num_edges") + F.col("num_faces")).alias("euler_number"),
        closed(F.col("signed_volume")).alias("volume"), "area", "bbox_extent",
    )


def half_edges(faces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, head): the 3 * n half-edges, those of the faces' first corners before those of the second ones, in an order in which those of an edge stand together, and where each edge begins in it."""
    u, v = faces.T.ravel(), np.roll(faces, -1, axis=1).T.ravel()
    p, q = np.minimum(u, v), np.maximum(u, v)
    span = int(q.max(initial=0)) + 1
    if p.min(initial=0) < 0 or span > 3_000_000_000:  # numbers of which no pair fits a word
        p, q = np.unique(np.stack([p, q]), return_inverse=True)[1].reshape(2, -1)
        span = int(q.max()) + 1
    code = p * span + q
    order = np.argsort(code)
    code = code[order]
    return order, np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])


def face_labels(faces: np.ndarray, half: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The component of each face, named by its least face: faces are tied by edges that exactly two faces use. half: half_edges, if known."""
    n = len(faces)
    if not n:
        return np.zeros(0, np.int64)
    order, head = half or half_edges(faces)
    pair = head[np.diff(np.append(head, len(order))) == 2]
    a, b = order[pair] % n, order[pair + 1] % n
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[label])
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


def _share(mesh: Mesh) -> float:
    return (len(mesh.faces) + 1) / JOINED


def components(packed: DataFrame) -> DataFrame:
    """(mesh_id, num_components, largest, largest_faces, seconds, error): how many components, the least face of the one with most faces (first of equals) and its size. Union of labels inside one mesh, in a kernel over packed rows."""

    def found(names: np.ndarray, sizes: np.ndarray) -> dict:
        best = int(np.argmax(sizes)) if len(names) else None
        return {"num_components": len(names), "largest": None if best is None else int(names[best]), "largest_faces": None if best is None else int(sizes[best])}

    def kernel(mesh: Mesh) -> dict:
        return found(*np.unique(face_labels(mesh.faces), return_counts=True))

    def together(some: list[Mesh]) -> list[dict]:
        whole, first = joined(some)
        names, sizes = np.unique(face_labels(whole.faces), return_counts=True)
        at = np.searchsorted(names, first)  # a component's name is a face of its mesh
        return [found(names[a:b] - f, sizes[a:b]) for f, a, b in zip(first, at, at[1:], strict=False)]

    return map_meshes(packed, kernel, "num_components long, largest long, largest_faces long", clock=True, together=together, share=_share)


def component_labels(faces: DataFrame) -> DataFrame:
    """(mesh_id, fid, component) of faces of meshes of any size: faces are tied by edges that exactly two faces use, a component is named by its least face.

    Contraction in rounds: every label takes the one of least hash among its neighbours and itself, and ties are
    drawn between the new labels. Hashes change from round to round, so labels become fewer by a constant factor each time
    and no chain of faces is walked. Each round is written; nothing is held for a whole mesh.
    """
    sides = F.explode(F.array(*[F.struct(F.least(p, q).alias("lo"), F.greatest(p, q).alias("hi")) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))]))
    tied = faces.select("mesh_id", "fid", sides.alias("e")).groupBy("mesh_id", "e.lo", "e.hi").agg(F.count("*").alias("n"), F.min("fid").alias("p"), F.max("fid").alias("q"))
    ties = cut(tied.where("n = 2 AND p <> q").select("mesh_id", "p", "q").distinct())
    labels, turn = faces.select("mesh_id", "fid", F.col("fid").alias("label")), 0
    while ties.take(1):
        both = ties.select("mesh_id", F.col("p").alias("at"), F.col("q").alias("to")).unionAll(ties.select("mesh_id", F.col("q").alias("at"), F.col("p").alias("to")))
        rank = lambda c, turn=turn: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("l"))
        moved = both.groupBy("mesh_id", "at").agg(F.min(rank("to")).alias("r")).select("mesh_id", "at", F.least("r", rank("at"))["l"].alias("new"))
        moved = cut(moved)
        end = lambda c: moved.select("mesh_id", F.col("at").alias(c), F.col("new").alias(f"_{c}"))  # noqa: E731, B023
        new = meet(meet(ties, end("p"), ["mesh_id", "p"]), end("q"), ["mesh_id", "q"])
        ties = cut(new.where("_p <> _q").select("mesh_id", F.least("_p", "_q").alias("p"), F.greatest("_p", "_q").alias("q")).distinct())
        labels = cut(meet(labels, end("label"), ["mesh_id", "label"], "left").select("mesh_id", "fid", F.coalesce("_label", "label").alias("label")))
        turn += 1
    least = labels.groupBy("mesh_id", "label").agg(F.min("fid").alias("component"))
    return meet(labels, least, ["mesh_id", "label"]).select("mesh_id", "fid", "component")


def largest_faces(faces: DataFrame, together: int = JOINED) -> DataFrame:
    """(mesh_id, fid, a, b, c): the faces of each mesh's component of most faces, the one of the least face among equals.

    A mesh of at most `together` faces is labelled in its task, with all others of its Arrow batch at once. Only larger
    ones are labelled by contraction in rounds, whose many steps would otherwise be paid for by a corpus of small meshes.
    """
    large = larger(together, faces)
    small = faces if large is None else meet(faces, large, "mesh_id", "left_anti")
    lists = small.groupBy("mesh_id").agg(F.sort_array(F.collect_list(F.struct("fid", "a", "b", "c"))).alias("f"))

    def run(batches):
        for batch in batches:
            rows, of = batch.column(1).flatten(), batch.column(1).value_parent_indices()
            if not len(rows):
                continue
            mesh = of.to_numpy()
            names, number = np.unique(np.stack([rows.field(k).to_numpy() for k in (1, 2, 3)], 1), return_inverse=True)
            kept = largest_of(mesh, face_labels(mesh[:, None] * len(names) + number.reshape(-1, 3)))  # no two meshes share a vertex
            take = pa.array(np.flatnonzero(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of.take(take)), *[rows.field(k).take(take) for k in range(4)]], ["mesh_id", "fid", "a", "b", "c"])

    out = lists.mapInArrow(run, ", ".join(f"{c} {faces.schema[c].dataType.simpleString()}" for c in ("mesh_id", "fid", "a", "b", "c")))
    if large is None:
        return out
    rest = meet(faces, large, "mesh_id", "left_semi")
    return out.unionByName(keep_largest_component(rest, component_labels(rest)).select("mesh_id", "fid", "a", "b", "c"))


def largest_of(mesh: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Which faces lie in the largest component of their mesh, the first of equals; faces of a mesh stand together, labels are rows."""
    name, size = np.unique(label, return_counts=True)
    order = np.lexsort((name, -size, mesh[name]))
    best = name[order[np.append(True, np.diff(mesh[name[order]]) != 0)]]
    return np.isin(label, best)


def primitive_score(vertices: DataFrame, faces: DataFrame, cone_deg: float = 10.0) -> DataFrame:
    """(mesh_id, num_faces, axis_aligned_area_fraction): the share of area whose normal lies within cone_deg of an axis."""
    at = with_normals(corners(vertices, faces))
    aligned = F.greatest(F.abs("nx"), F.abs("ny"), F.abs("nz")) > F.cos(F.radians(F.lit(cone_deg))) * 2 * F.col("area")
    return at.groupBy("mesh_id").agg(F.count("*").alias("num_faces"), (F.coalesce(F.sum(F.when(aligned, F.col("area"))), F.lit(0.0)) / (F.sum("area") + 1e-12)).alias("axis_aligned_area_fraction"))


def vertex_normals(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """(mesh_id, vid, nx, ny, nz): raw face normals summed at each vertex, then of unit length (0 where they cancel)."""
    at = with_normals(corners(vertices, faces)).select("mesh_id", "nx", "ny", "nz", F.explode(F.array("a", "b", "c")).alias("vid"))
    sums = at.groupBy("mesh_id", "vid").agg(*[F.sum(d).alias(d) for d in ("nx", "ny", "nz")])
    size = F.greatest(F.sqrt(dot(*[[F.col("nx"), F.col("ny"), F.col("nz")]] * 2)), F.lit(1e-12))
    return sums.select("mesh_id", "vid", *[(F.col(d) / size).alias(d) for d in ("nx", "ny", "nz")])


def fit_unit_cube(vertices: DataFrame, pad: float = 0.03) -> DataFrame:
    """(mesh_id, vid, x, y, z, cx, cy, cz, scale): the vertices in [0,1]^3 with a margin, and what undoes it: (v - 0.5) * scale + c. A zero extent gives null coordinates."""
    box = vertices.groupBy("mesh_id").agg(*[((F.min(d) + F.max(d)) / 2).alias(f"c{d}") for d in "xyz"], F.greatest(*[F.max(d) - F.min(d) for d in "xyz"]).alias("extent"))
    box = box.withColumn("scale", F.when(F.col("extent") > 0, F.col("extent") * (1 + 2 * pad))).drop("extent")
    out = meet(vertices, box, "mesh_id")
    return out.select("mesh_id", "vid", *[((F.col(d) - F.col(f"c{d}")) / F.col("scale") + 0.5).alias(d) for d in "xyz"], "cx", "cy", "cz", "scale")


def merge_vertices(vertices: DataFrame, faces: DataFrame, digits: int = 8) -> tuple[DataFrame, DataFrame]:
    """Vertices that agree to `digits` places become the one of least vid; faces that repeat a vertex or another face's vertices go (the least fid stays)."""
    same = Window.partitionBy("mesh_id", *[F.round(d, digits) for d in "xyz"])
    named = vertices.withColumn("to", F.min("vid").over(same))
    # vertices and corners of faces meet in one pass by vid; corners of no vertex keep their own
    none = F.lit(None).cast("long")
    corner = faces.select("mesh_id", "fid", F.posexplode(F.array("a", "b", "c")).alias("k", "vid")).select("mesh_id", "vid", "fid", "k", none.alias("to"))
    every = named.select("mesh_id", "vid", none.alias("fid"), F.lit(None).cast("int").alias("k"), "to").unionAll(corner)
    met = every.withColumn("to", F.coalesce(F.max("to").over(Window.partitionBy("mesh_id", "vid")), "vid")).where("k IS NOT NULL")
    out = met.groupBy("mesh_id", "fid").agg(*[F.max(F.when(F.col("k") == k, F.col("to"))).alias(c) for k, c in enumerate("abc")]).where("a <> b AND b <> c AND c <> a")
    first = Window.partitionBy("mesh_id", F.array_sort(F.array("a", "b", "c"))).orderBy("fid")
    out = out.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return named.where("vid = to").drop("to"), out


def keep_largest_component(faces: DataFrame, labels: DataFrame) -> DataFrame:
    """Faces (mesh_id, fid, ...) of the component with most faces; labels has (mesh_id, fid, component). Ties go to the least component."""
    sizes = labels.groupBy("mesh_id", "component").agg(F.count("*").alias("n"))
    best = sizes.groupBy("mesh_id").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("component"))
    return meet(faces, meet(labels, best, ["mesh_id", "component"]).select("mesh_id", "fid"), ["mesh_id", "fid"])


def oriented_faces(vertices: np.ndarray, faces: np.ndarray) -> np.ndarray:
    """The faces turned so that neighbours over shared edges run opposite ways; components of negative volume are turned as a whole.

    Turns spread from each component's least face over edges that exactly two faces use, one ring of
    faces at a time. What can't be oriented keeps the turns it gets first.
    """
    n = len(faces)
    if not n:
        return faces
    half = np.concatenate([faces[:, [0, 1]], faces[:, [1, 2]], faces[:, [2, 0]]])
    e, forward, owner = np.sort(half, axis=1), half[:, 0] < half[:, 1], np.tile(np.arange(n), 3)
    order = np.lexsort((owner, e[:, 1], e[:, 0]))
    e, forward, owner = e[order], forward[order], owner[order]
    head = np.flatnonzero(np.append(True, (e[1:] != e[:-1]).any(axis=1)))
    pair = head[np.diff(np.append(head, len(e))) == 2]
    a, b, turn = owner[pair], owner[pair + 1], forward[pair] == forward[pair + 1]
    src, dst, turn = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([turn, turn])
    by = np.argsort(src, kind="stable")
    src, dst, turn = src[by], dst[by], turn[by]
    start = np.searchsorted(src, np.arange(n + 1))
    label = face_labels(faces)
    ring = np.unique(label)
    seen, flip = np.zeros(n, bool), np.zeros(n, bool)
    seen[ring] = True
    while len(ring):
        count = start[ring + 1] - start[ring]
        at = np.repeat(start[ring], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = at[~seen[dst[at]]]
        new, first = np.unique(dst[at], return_index=True)
        flip[new] = flip[src[at[first]]] ^ turn[at[first]]
        seen[new] = True
        ring = new
    out = np.where(flip[:, None], faces[:, [0, 2, 1]], faces)
    p = vertices[out]
    volume = np.bincount(label, (p[:, 0] * np.cross(p[:, 1], p[:, 2])).sum(1), n)
    return np.where((volume[label] < 0)[:, None], out[:, [0, 2, 1]], out)


def orient(packed: DataFrame) -> DataFrame:
    """(mesh_id, faces, error): every packed mesh's faces, consistently wound and facing outwards."""
    rows = lambda faces: [dict(zip("abc", f, strict=True)) for f in faces.tolist()]

    def together(some: list[Mesh]) -> list[dict]:
        whole, first = joined(some)
        turned = oriented_faces(whole.vertices, whole.faces)
        own = np.cumsum([0, *[len(m.vertices) for m in some]])
        return [{"faces": rows(turned[a:b] - v)} for a, b, v in zip(first, first[1:], own, strict=False)]

    return map_meshes(packed, lambda m: {"faces": rows(oriented_faces(m.vertices, m.faces))}, "faces array<struct<a:bigint,b:bigint,c:bigint>>", together=together, share=_share)
