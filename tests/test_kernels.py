"""Dense kernels against brute force: exact distances, rays through a tree of boxes, surfaces brick by brick."""

import time

import numpy as np
import pytest

from meshloom.operators import boxtree, voxels


def ring(n):
    """A closed ring of 2 n^2 triangles inside the unit cube."""
    a, b = (x.ravel() for x in np.meshgrid(*[np.arange(n)] * 2, indexing="ij"))
    u, w = a * 2 * np.pi / n, b * 2 * np.pi / n
    v = np.stack([(1 + 0.4 * np.cos(w)) * np.cos(u), 0.4 * np.sin(w), (1 + 0.4 * np.cos(w)) * np.sin(u)], 1) / 3 + 0.5
    at = lambda i, j: (i % n) * n + j % n
    return v, np.concatenate([np.stack([at(a, b), at(a, b + 1), at(a + 1, b)], 1), np.stack([at(a + 1, b), at(a, b + 1), at(a + 1, b + 1)], 1)])


@pytest.mark.parametrize("shape", [(9, 9, 9), (1, 7, 12), (13, 1, 1), (16, 5, 3)])
@pytest.mark.parametrize("share", [0.0, 0.004, 0.1, 0.7, 1.0])
def test_distances_are_exact(shape, share):
    mask = np.random.default_rng(7).random(shape) < share
    found, cells = voxels.squared_distances(mask, block=5), np.argwhere(mask)
    for c in np.ndindex(shape):
        assert found[c] == (((cells - c) ** 2).sum(1).min() if len(cells) else np.inf)


def test_distances_take_time_linear_in_the_cells():
    seconds = []
    for n in (32, 64, 128):
        mask = np.zeros((n, n, n), bool)
        mask[tuple((np.random.default_rng(1).random((n * n, 3)) * n).astype(int).T)] = True
        start = time.perf_counter()
        voxels.squared_distances(mask)
        seconds.append(time.perf_counter() - start)
    assert seconds[2] < 30 * max(seconds[1], 0.02)


def brute_hits(v, f, o, d):
    ray, tri = (x.ravel() for x in np.meshgrid(np.arange(len(o)), np.arange(len(f)), indexing="ij"))
    t = boxtree.hit_distances(v, f[tri], o[ray], d[ray]).reshape(len(o), len(f))
    k = t.argmin(1)
    best = t[np.arange(len(o)), k]
    return np.where(np.isfinite(best), k, -1), best


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_rays_through_the_tree_equal_all_triangles(leaf):
    rng = np.random.default_rng(3)
    v, f = ring(12)
    flat = np.array([[0.1, 0.1, 0.5], [0.9, 0.1, 0.5], [0.1, 0.9, 0.5], [0.9, 0.9, 0.5]])
    soup = rng.random((90, 3)), rng.permutation(90).reshape(-1, 3)
    for v, f in ((v, f), (flat, np.array([[0, 1, 2], [1, 3, 2], [0, 1, 2]])), soup, (flat, np.array([[0, 0, 0]])), (v, f[:1])):
        o = np.concatenate([rng.random((200, 3)), flat, flat + [0, 0, 0.1]])
        d = np.concatenate([rng.normal(size=(150, 3)), np.eye(3)[rng.integers(0, 3, 50)] * rng.choice([-1, 1], (50, 1)), [[1, 0, 0]] * 4, [[0, 0, -1]] * 4]).astype(float)
        face, dist = boxtree.BoxTree(v, f, leaf).first_hits(o, d, chunk=37)
        want, far = brute_hits(v, f, o, d)
        assert (face == want).all() and (dist == far).all()
    assert voxels.first_hits(v, np.zeros((0, 3), int), o, d)[0].tolist() == [-1] * len(o)


def test_rays_on_a_million_triangles():
    v, f = ring(708)
    rng = np.random.default_rng(5)
    o, d = rng.random((256, 3)), rng.normal(size=(256, 3))
    start = time.perf_counter()
    tree = boxtree.BoxTree(v, f)
    built = time.perf_counter() - start
    face, _ = tree.first_hits(o, d)
    took = time.perf_counter() - start - built
    print(f"{len(f)} triangles: built in {built:.2f} s, 256 rays in {took:.2f} s")
    some = np.flatnonzero(face >= 0)[:5]
    assert took < 3 and len(some) == 5
    for k in [*some, *np.flatnonzero(face < 0)[:5]]:
        want = np.full(1, np.inf)
        t = boxtree.hit_distances(v, f, np.broadcast_to(o[k], (len(f), 3)), np.broadcast_to(d[k], (len(f), 3)))
        want = int(t.argmin()) if np.isfinite(t.min()) else -1
        assert face[k] == want


def test_the_surface_counts_only_cells_next_to_the_other_side():
    rng = np.random.default_rng(2)
    occupied = rng.random((7, 8, 9)) < 0.3
    near = np.where(rng.random(occupied.shape) < 0.5, rng.random(occupied.shape) * 0.01, np.inf).astype(np.float32)
    found, full = voxels.side_values(near, occupied, 8), voxels.distance_transform(occupied) / 8
    close = np.abs(full) * 8 <= np.sqrt(3) + 1e-6
    want = np.where(np.isfinite(near), np.where(occupied, -near, near), full)
    assert np.allclose(found[close], want[close], rtol=1e-6) and ((found < 0) == occupied).all()


# Bricks ------------------------------------------------------------------------------------------


def test_cell_labels_equal_a_flood_from_each_cell():
    from meshloom.operators.bricks import cell_labels

    rng = np.random.default_rng(6)
    for share in (0.0, 0.05, 0.2, 0.5, 1.0):
        free = rng.random((7, 6, 9)) < share
        labels, n = cell_labels(free)
        assert ((labels > 0) == free).all() and set(np.unique(labels[free])) == set(range(1, n + 1))
        for k in range(1, n + 1):
            out = np.zeros_like(free)
            out[tuple(np.argwhere(labels == k)[0])] = True
            while ((new := voxels.dilate_grid(out) & free) != out).any():
                out = new
            assert (out == (labels == k)).all()


def table(spark, meshes):
    v = [(i, k, *p) for i, (vs, _) in meshes.items() for k, p in enumerate(vs.tolist())]
    f = [(i, k, *t) for i, (_, fs) in meshes.items() for k, t in enumerate(fs.tolist())]
    return spark.createDataFrame(v, "mesh_id long, vid long, x double, y double, z double"), spark.createDataFrame(f, "mesh_id long, fid long, a long, b long, c long")


@pytest.mark.parametrize(("res", "side"), [(48, 16), (40, 12)])
def test_bricks_equal_the_dense_kernel(spark, res, side):
    """A ring, two boxes one in the other, an open sheet, a box with a hole and one without extent: the same counts, verdicts and triangles as from one grid."""
    from meshloom.operators import bricks
    from meshloom.operators.packed import Mesh
    from meshloom.sources.boxes import TRIANGLES

    box = np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)], float)
    two = np.concatenate([box * 5, box + 2]), np.concatenate([TRIANGLES, np.array(TRIANGLES) + 8])
    apart = np.concatenate([box * 2, box + [7, 0.3, 0.1]]), np.concatenate([TRIANGLES, np.array(TRIANGLES) + 8])
    sheet = np.array([[0, 0, 0], [1, 0, 0.2], [0, 1, 0.1], [1, 1, 0.3]]), np.array([[0, 1, 2], [1, 3, 2]])
    holed = box * [3, 2, 1], np.array(TRIANGLES)[1:]
    made = {1: ring(24), 2: two, 3: sheet, 4: holed, 5: (box * 0, np.array(TRIANGLES)), 6: apart}
    pieces, report = bricks.watertighten_bricks(*table(spark, made), bricks.BrickConfig(res=res, side=side))
    report = {r.mesh_id: r for r in report.collect()}
    v, f = bricks.assemble(pieces)
    places = {(r.mesh_id, r.name): (r.x, r.y, r.z) for r in v.collect()}
    found = {}
    for r in f.collect():
        corners = [tuple(round(c, 6) for c in places[r.mesh_id, n]) for n in (r.a, r.b, r.c)]
        k = corners.index(min(corners))
        found.setdefault(r.mesh_id, []).append(tuple(corners[k:] + corners[:k]))
    assert set(report) == set(made) - {5}
    for i in report:
        want, told = voxels.watertighten_mesh(Mesh(*made[i]), voxels.WatertightConfig(res=res, chamfer_samples=10))
        for name in ("shell_voxels", "thickened_voxels", "open_shell_detected", "num_faces_out", "is_watertight", "is_winding_consistent"):
            assert report[i][name] == told[name], (i, name)
        assert report[i].interior_frac_closed == pytest.approx(told["interior_frac_closed"])
        triangles = []
        for t in want.vertices[want.faces].tolist():
            corners = [tuple(round(c, 6) for c in p) for p in t]
            k = corners.index(min(corners))
            triangles.append(tuple(corners[k:] + corners[:k]))
        lists = np.array(sorted(triangles)), np.array(sorted(found[i]))
        assert lists[0].shape == lists[1].shape and np.abs(np.sort(lists[0].reshape(-1, 9), 0) - np.sort(lists[1].reshape(-1, 9), 0)).max() < 1e-5, i


# Ray cells ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("axis", ["x", "y", "z"])
def test_ray_cells_are_few_whatever_the_size_of_triangles(spark, axis):
    """A large floor and a wall beside a fine ring: no triangle lies in more than four cells, and crossings equal those of all triangles."""
    from meshloom.operators import rays, topology

    v, f = ring(20)
    floor = np.array([[-9, -9, 0.1], [9, -9, 0.1], [-9, 9, 0.1], [9, 9, 0.1], [-9, 0.3, -9], [-9, 0.3, 9], [9, 0.3, -9], [9, 0.3, 9], [0.2, -9, -9], [0.2, -9, 9], [0.2, 9, -9], [0.2, 9, 9]])
    planes = np.array([[0, 1, 2], [1, 3, 2], [4, 5, 6], [5, 7, 6], [8, 9, 10], [9, 11, 10]])
    v, f = np.concatenate([v, floor]), np.concatenate([f, planes + len(v)])
    at = topology.corners(*table(spark, {1: (v, f), 2: (floor[:3], np.array([[0, 1, 2]]))}))
    cells = rays.triangle_cells(at, axis).groupBy("mesh_id", "fid").count()
    assert cells.count() == len(f) + 1 and cells.agg({"count": "max"}).first()[0] <= 4
    rng = np.random.default_rng(9)
    p = np.concatenate([rng.random((150, 3)), rng.random((50, 3)) * 20 - 10])
    points = spark.createDataFrame([(i, k, *x) for i in (1, 2) for k, x in enumerate(p.tolist())], "mesh_id long, pid long, x double, y double, z double")
    got = {(r.mesh_id, r.pid): r.crossings for r in rays.ray_crossings(points, at, axis).collect()}
    d = np.broadcast_to(np.eye(3)["xyz".index(axis)], p.shape)
    for i, (vs, fs) in {1: (v, f), 2: (floor[:3], np.array([[0, 1, 2]]))}.items():
        want = [int(np.isfinite(boxtree.hit_distances(vs, fs, np.broadcast_to(p[k], (len(fs), 3)), np.broadcast_to(d[k], (len(fs), 3)))).sum()) for k in range(len(p))]
        assert [got[i, k] for k in range(len(p))] == want


# Shape models ------------------------------------------------------------------------------------


def ball(rings=24):
    """A closed sphere of radius 3 around (5, 1, -2)."""
    a, b = np.meshgrid(np.arange(1, rings) * np.pi / rings, np.arange(2 * rings) * np.pi / rings, indexing="ij")
    v = np.stack([np.cos(a), np.sin(a) * np.cos(b), np.sin(a) * np.sin(b)], -1).reshape(-1, 3)
    n, w = rings - 1, 2 * rings
    f = []
    for i in range(n - 1):
        for j in range(w):
            p, q, r, s = i * w + j, i * w + (j + 1) % w, (i + 1) * w + j, (i + 1) * w + (j + 1) % w
            f += [(p, r, q), (q, r, s)]
    v = np.concatenate([v, [[1, 0, 0], [-1, 0, 0]]])
    f += [(len(v) - 2, j, (j + 1) % w) for j in range(w)] + [(len(v) - 1, (n - 1) * w + (j + 1) % w, (n - 1) * w + j) for j in range(w)]
    return v * 3 + [5, 1, -2], np.array(f)


def test_samples_lie_on_the_surface_with_its_normals():
    from meshloom.operators import fields
    from meshloom.operators.packed import Mesh

    small = fields.normalised(Mesh(*ball()), 0.98)
    s = fields.oriented_samples(small, 5000)
    assert s.shape == (5000, 7) and (s[:, 6] == 0).all() and np.abs(s[:, :3]).max() <= 0.9801
    size = np.linalg.norm(s[:, :3], axis=1)
    assert size.min() > 0.96 and (np.abs(np.linalg.norm(s[:, 3:6], axis=1) - 1) < 1e-5).all()
    assert (np.abs((s[:, 3:6] * s[:, :3]).sum(1)) / size).min() > 0.98 and np.abs(s[:, :3].mean(0)).max() < 0.05


@pytest.mark.parametrize("chunk", [1, 500, 1 << 18])
def test_fields_are_drawn_slab_by_slab_as_from_one_grid(chunk):
    from meshloom.operators import fields

    model, field = fields.BallModel(), np.array([0.1, -0.05, 0.02, 0.7])
    v, f, _ = fields.field_surface(lambda p: model.query(field, p), 18, chunk)
    whole = fields.field_surface(lambda p: model.query(field, p), 18, 18**3)
    assert np.allclose(v, whole[0]) and len(f) == len(whole[1]) and all(voxels.manifold_flags(f).values())
    assert {tuple(sorted(t)) for t in f.tolist()} == {tuple(sorted(t)) for t in whole[1].tolist()}
    assert np.abs(np.linalg.norm(v - field[:3], axis=1) - 0.7).max() < 0.01
    out = (np.cross(v[f[:, 1]] - v[f[:, 0]], v[f[:, 2]] - v[f[:, 0]]) * (v[f].mean(1) - field[:3])).sum(1)
    assert (out > 0).all()


def test_round_trips_of_balls_and_boxes(spark):
    """A model that is right for the shape gives a chamfer of the samples' spacing, at most 0.02 with 20,000; one that is wrong gives more; a field without surface is infinite, a failing model an error."""
    from meshloom.operators import fields
    from meshloom.operators.packed import Mesh, pack
    from meshloom.sources.boxes import TRIANGLES

    box = np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)], float) * [4, 2, 3], np.array(TRIANGLES)
    config = fields.FieldConfig(samples=20_000, cells=64)
    right = [fields.round_trip(Mesh(*ball()), fields.BallModel(), config), fields.round_trip(Mesh(*box), fields.BoxModel(), config)]
    wrong = [fields.round_trip(Mesh(*ball()), fields.BoxModel(), config), fields.round_trip(Mesh(*box), fields.BallModel(), config)]
    assert all(r["chamfer"] < 0.02 and r["recon_faces"] > 10_000 and r["time_query"] > 0 for r in right) and all(r["chamfer"] > 0.08 for r in wrong)
    thin = box[0] * [1, 1, 0.001], box[1]
    packed = pack(*table(spark, {1: box, 2: thin, 3: (box[0] * 0, box[1])}))
    rows = {r.mesh_id: r for r in fields.shape_scores(packed, fields.BoxModel, fields.FieldConfig(500, 16, 100, 300)).collect()}
    assert rows[1].chamfer < 0.3 and rows[1].vae_why is None and rows[1].error is None
    assert rows[2].chamfer == float("inf") and rows[2].vae_why == "field has no surface" and rows[2].recon_faces is None
    assert rows[3].chamfer is None and rows[3].error == "ValueError:mesh has zero extent"


# Components without a kernel ---------------------------------------------------------------------


def test_component_labels_equal_the_kernel_on_long_strips_and_odd_edges(spark):
    from meshloom.operators import topology

    strip = np.stack([np.arange(300), np.arange(1, 301), np.arange(2, 302)], 1)
    rng = np.random.default_rng(4)
    fan = np.stack([np.zeros(20, int), np.ones(20, int), np.arange(2, 22)], 1)  # an edge of twenty faces ties none of them
    made = {1: strip[rng.permutation(300)], 2: rng.integers(0, 60, (80, 3)), 3: np.concatenate([strip[:9], strip[:5] + 400, fan + 900]), 4: np.array([[0, 0, 0], [1, 1, 2], [2, 1, 1]])}
    _, f = table(spark, {i: (np.zeros((0, 3)), t) for i, t in made.items()} | {0: (np.zeros((1, 3)), np.array([[0, 1, 2]]))})
    got = {(r.mesh_id, r.fid): r.component for r in topology.component_labels(f.repartition(3)).collect()}
    for i in (1, 3):
        assert [got[i, k] for k in range(len(made[i]))] == topology.face_labels(made[i]).tolist()
    assert len(got) == sum(map(len, made.values())) + 1 and len({got[1, k] for k in range(300)}) == 1
    plain = made[2][(np.diff(np.sort(made[2], 1), axis=1) > 0).all(1)]
    _, f = table(spark, {2: (np.zeros((1, 3)), plain)})
    assert [c for _, c in sorted((r.fid, r.component) for r in topology.component_labels(f).collect())] == topology.face_labels(plain).tolist()


def test_shell_is_decided_in_double_precision():
    at = np.nextafter(1 / 16, 0)  # below a cell, but not once it is rounded to single precision
    assert np.float32(at) == np.float32(1 / 16)
    d = voxels.single(np.array([at, 1 / 16, 0.01, 3 / 16, np.nextafter(3 / 16, 0)]), 1 / 16, 3 / 16)
    assert (d < np.float32(1 / 16)).tolist() == [True, False, True, False, False] and (d < np.float32(3 / 16)).tolist() == [True, True, True, False, True]
    assert (voxels.single(np.array([np.nextafter(0.1, 0), 0.1]), 0.1) < np.float32(0.1)).tolist() == [True, False]


def test_every_step_through_a_mesh_falls_on_one_face(spark):
    """A step on the edge of two faces, up to rounding, was given to both."""
    from pyspark.sql import functions as F

    from meshloom.operators import neighbours, topology
    from meshloom.sources import boxes

    parts = spark.createDataFrame([(k, 27, 945.0) for k in (14450, 54450, 234450, 54451, 54452)], "p_partkey long, p_size int, p_retailprice double")
    at = topology.with_normals(topology.corners(boxes.box_vertices(parts), boxes.box_faces(parts)))
    pids = {r.mesh_id: sorted(r.p) for r in neighbours.sample_surface(at, 100).groupBy("mesh_id").agg(F.collect_list("pid").alias("p")).collect()}
    assert len(pids) == 5 and all(p == list(range(100)) for p in pids.values())


def test_triangles_drawn_by_themselves_equal_rays_and_box_views_are_whole(spark, tmp_path, monkeypatch):
    """Views of 16 pixels a side left a four-thousandth of the samples of 512 with supersampling."""
    from meshloom.operators import render
    from meshloom.operators.packed import Mesh, meshes, pack
    from meshloom.plans import kernel_queries
    from meshloom.sources import boxes

    monkeypatch.setattr(render, "ALONE", 200)
    rng = np.random.default_rng(4)
    v, f = ring(24)
    soup = Mesh(rng.normal(size=(60, 3)), rng.integers(0, 60, (80, 3)))
    cube = np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)], float)
    some = [soup, Mesh(np.concatenate([v, cube * [0.2, 2, 1]]), np.concatenate([f, np.array(boxes.TRIANGLES)[1:] + len(v)])), Mesh(cube * [3, 1, 2], np.array(boxes.TRIANGLES))]
    for few in (0, 256):
        monkeypatch.setattr(render, "FEW", few)
        for mesh in some:
            for camera in [*render.cameras(mesh).values(), render.Camera(mesh.vertices.mean(0) + 0.01, np.array([1.0, 0.2, 0]), np.array([0.0, 1, 0]))]:
                canvas = render.Canvas(mesh, camera, 90)
                assert canvas.large.any()
                off = np.abs(render.render_view(mesh, camera, 45, 2).astype(int) - render.render_images([mesh], [[camera]], 45, 2)[0, 0]).max(2)
                assert (off > 0).mean() < 0.002, (few, len(mesh.faces))  # samples on an edge or where faces cross
    monkeypatch.undo()
    part = spark.createDataFrame([(k, 3 + k, 905.0) for k in (1, 5, 7, 22)], "p_partkey long, p_size int, p_retailprice double")
    part.write.parquet(f"{tmp_path}/part.parquet")
    got = {r.mesh_id: (r.width, r.height, r.sha256, r.error) for r in kernel_queries.box_views(spark, str(tmp_path)).collect()}
    packed = pack(boxes.box_vertices(part), boxes.box_faces(part)).coalesce(1).toArrow().combine_chunks()
    import hashlib

    for key, mesh in zip(packed["mesh_id"].to_pylist(), meshes(packed.to_batches()[0]), strict=True):
        at = render.cameras(mesh)
        views = render.render_images([mesh], [[at[n] for n in render.FOUR]], 512, 2)[0]
        assert got[key] == (1024, 1024, hashlib.sha256(render.png(render.four_view_grid(dict(zip(render.FOUR, views, strict=True))))).hexdigest(), None)
