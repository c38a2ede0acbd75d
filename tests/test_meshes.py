import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meshloom.config import PipelineConfig, env
from meshloom.functions.rules import GeometryConfig
from meshloom.operators import neighbours, pose, rays, render, rollups, scorers, topology, voxels
from meshloom.operators.packed import Mesh, map_meshes, pack
from meshloom.plans import pipeline
from meshloom.sources import files, meshfile, sinks
from meshloom.sources.boxes import TRIANGLES


def box(ex=1.0, ey=1.0, ez=1.0, at=(0, 0, 0)):
    corners = np.array([((v >> 2) - 0.5, (v >> 1 & 1) - 0.5, (v & 1) - 0.5) for v in range(8)]) * (ex, ey, ez) + at
    return Mesh(corners, np.array(TRIANGLES))


def icosphere(r, steps):
    t = (1 + 5**0.5) / 2
    v = np.array([(-1, t, 0), (1, t, 0), (-1, -t, 0), (1, -t, 0), (0, -1, t), (0, 1, t), (0, -1, -t), (0, 1, -t), (t, 0, -1), (t, 0, 1), (-t, 0, -1), (-t, 0, 1)], float)
    f = np.array([(0, 11, 5), (0, 5, 1), (0, 1, 7), (0, 7, 10), (0, 10, 11), (1, 5, 9), (5, 11, 4), (11, 10, 2), (10, 7, 6), (7, 1, 8), (3, 9, 4), (3, 4, 2), (3, 2, 6), (3, 6, 8), (3, 8, 9), (4, 9, 5), (2, 4, 11), (6, 2, 10), (8, 6, 7), (9, 8, 1)])
    for _ in range(steps):
        e = np.sort(np.concatenate([f[:, [0, 1]], f[:, [1, 2]], f[:, [2, 0]]]), 1)
        u, i = np.unique(e, axis=0, return_inverse=True)
        ab, bc, ca = (len(v) + i.ravel()[k * len(f) : (k + 1) * len(f)] for k in range(3))
        v = np.concatenate([v, v[u].mean(1)])
        f = np.concatenate([np.stack(x, 1) for x in ((f[:, 0], ab, ca), (f[:, 1], bc, ab), (f[:, 2], ca, bc), (ab, bc, ca))])
    return Mesh(v / np.linalg.norm(v, axis=1, keepdims=True) * r, f)


def table(spark, meshes):
    rows = [(k, [dict(zip("xyz", r)) for r in m.vertices.tolist()], [dict(zip("abc", r)) for r in m.faces.tolist()]) for k, m in meshes.items()]
    return spark.createDataFrame(rows, "mesh_id string, vertices array<struct<x:double,y:double,z:double>>, faces array<struct<a:bigint,b:bigint,c:bigint>>")


def two_spheres():
    a, b = icosphere(0.1, 2), icosphere(0.1, 2)
    return Mesh(np.concatenate([a.vertices, b.vertices + (1.5, 0, 0)]), np.concatenate([a.faces, b.faces + len(a.vertices)]))


def test_icosphere_counts():
    m = icosphere(0.5, 3)
    assert (len(m.vertices), len(m.faces)) == (642, 1280) and voxels.manifold_flags(m.faces) == {"is_watertight": True, "is_winding_consistent": True}


def test_holed_sphere_becomes_watertight():
    m = icosphere(0.5, 3)
    holed = Mesh(m.vertices, m.faces[1:])
    assert not voxels.manifold_flags(holed.faces)["is_watertight"]
    out, report = voxels.watertighten_mesh(holed, voxels.WatertightConfig(res=48, close_iters=1))
    assert report["is_watertight"] and report["is_winding_consistent"] and len(out.faces) > 100
    assert report["chamfer_to_input"] < 0.05 and abs(np.linalg.norm(out.vertices, axis=1).mean() - 0.5) < 0.04


def test_summary_of_closed_forms(spark):
    v, f = meshfile.unpack(table(spark, {"box": box(1, 2, 3), "two": two_spheres(), "open": Mesh(box().vertices, box().faces[1:])}))
    by = {r.mesh_id: r for r in topology.summarize(v, f).collect()}
    assert by["box"].volume == pytest.approx(6) and by["box"].area == pytest.approx(22) and by["box"].euler_number == 2 and by["box"].bbox_extent == [1, 2, 3]
    assert by["two"].euler_number == 4 and by["open"].volume is None and not by["open"].is_watertight and by["open"].is_winding_consistent
    parts = {r.mesh_id: r for r in topology.components(table(spark, {"two": two_spheres(), "box": box()})).collect()}
    assert parts["two"].num_components == 2 and parts["two"].largest == 0 and parts["box"].num_components == 1


def test_cube_is_primitive_and_solid(spark):
    packed = table(spark, {"cube": box(), "ball": icosphere(0.5, 3)})
    out = {r.mesh_id: r for r in pipeline.geometry_metrics(packed, PipelineConfig(ray_samples=500)).collect()}
    hook = pipeline.geometry_metrics(packed, PipelineConfig(ray_samples=500), truth=lambda points, _: points.select("mesh_id", "pid", F.lit(True).alias("inside")))
    assert {r.metrics.fraction_inside_gt for r in hook.collect()} == {1.0}
    assert out["cube"].reasons == ["primitive_like"] and out["ball"].reasons == [] and out["ball"].is_valid
    assert out["cube"].metrics.fraction_inside_gt == pytest.approx(1 / 1.1**3, abs=0.06) and out["cube"].metrics.ray_sign_agreement == 1


def test_ray_agreement_of_turned_and_holed_meshes(spark):
    ball = icosphere(0.5, 3)
    inverted = Mesh(ball.vertices, ball.faces[:, ::-1])
    low = ball.vertices[ball.faces].mean(1)[:, 2] < 0.25
    shifted = Mesh(np.concatenate([ball.vertices, ball.vertices + (0.3, 0, 0)]), np.concatenate([ball.faces, ball.faces + len(ball.vertices)]))
    packed = table(spark, {"ball": ball, "inverted": inverted, "holed": Mesh(ball.vertices, ball.faces[low]), "overlapping": shifted})
    config = PipelineConfig(ray_samples=800, geometry=GeometryConfig(ray_agreement_min=0.9))
    by = {r.mesh_id: r for r in pipeline.geometry_metrics(packed, config).collect()}
    assert by["ball"].metrics.ray_sign_agreement == 1 and by["ball"].is_valid
    inside = by["inverted"].metrics.fraction_inside_gt
    assert inside == by["ball"].metrics.fraction_inside_gt and by["inverted"].metrics.ray_sign_agreement == pytest.approx(1 - inside) and by["inverted"].metrics.fraction_inside_cubvh == 0
    assert by["inverted"].reasons == [f"ray_sign_disagreement={1 - inside:.3f}"]
    assert 0.3 < by["holed"].metrics.ray_sign_agreement < 0.95 and by["overlapping"].metrics.ray_sign_agreement < 0.9


@pytest.mark.parametrize("axis", ["x", "y", "z"])
def test_rays_along_any_axis_equal_brute_force(spark, axis):
    ball, cube = icosphere(0.5, 2), box(1, 2, 3)
    v, f = meshfile.unpack(table(spark, {"ball": ball, "cube": cube}))
    rng = np.random.default_rng(2)
    at = {k: rng.uniform(-1.2, 1.2, (200, 3)) for k in ("ball", "cube")}
    points = spark.createDataFrame([(k, i, *map(float, p)) for k, ps in at.items() for i, p in enumerate(ps)], "mesh_id string, pid long, x double, y double, z double")
    d = np.eye(3)["xyz".index(axis)]
    got = {(r.mesh_id, r.pid): r.crossings for r in rays.ray_crossings(points, topology.corners(v, f), axis).collect()}
    for k, m in (("ball", ball), ("cube", cube)):
        tri = m.vertices[m.faces]
        for i, p in enumerate(at[k]):
            h = np.cross(d, tri[:, 2] - tri[:, 0])
            det = (h * (tri[:, 1] - tri[:, 0])).sum(1)
            with np.errstate(all="ignore"):
                s = p - tri[:, 0]
                u, q = (s * h).sum(1) / det, np.cross(s, tri[:, 1] - tri[:, 0])
                w, t = q @ d / det, (q * (tri[:, 2] - tri[:, 0])).sum(1) / det
                good = (det != 0) & (u >= 0) & (w >= 0) & (u + w <= 1) & (t > 0)
            assert got[k, i] == int(good.sum())


def test_model_poses_from_views_to_rotation(spark):
    class PoseModel:
        """A model that names the axes of every grid of six views."""

        name = "poses"

        def generate(self, images, prompt):
            return ['{"up_axis": "+Z", "front_axis": "+X"}' if "up_axis" in prompt else '{"aesthetic_quality": 4}' for _ in images]

    packed = table(spark, {"flat": box(3, 2, 0.5, at=(0, 0, 0.25)), "tall": box(1, 3, 1, at=(0, 1.5, 0))})
    vlm = {r.mesh_id: r for r in pose.find_poses(packed, "vlm", PoseModel, 16).collect()}
    assert all(r.method == "vlm" and r.up_axis_world == [0, 0, 1] and r.forward_axis_world == [1, 0, 0] and not r.needs_manual_review and np.linalg.det(np.array(r.rotation_matrix)) == pytest.approx(1) for r in vlm.values())
    hybrid = {r.mesh_id: r for r in pose.find_poses(packed, "hybrid", PoseModel, 16).collect()}
    geometry = {r.mesh_id: r for r in pose.canonicalise(packed).collect()}
    assert hybrid["flat"].vlm_agrees_with_geom and hybrid["flat"].up_axis_world == [0, 0, 1]
    agrees = abs(geometry["tall"].up_axis_world[2]) >= 0.8
    assert hybrid["tall"].vlm_agrees_with_geom == agrees and hybrid["tall"].needs_manual_review == (not agrees)
    with pytest.raises(ValueError):
        pose.find_poses(packed, "vlm")
    config = PipelineConfig(skip_watertight=True, ray_samples=50, pose_method="vlm", render_res=16, pose_render_res=16)
    out = {r.mesh_id: r for r in pipeline.clean_meshes(packed, config, PoseModel).collect()}
    assert out["flat"].pose.vlm_up_label == "+Z" and out["flat"].verdict.aesthetic_quality == 4 and max(p.y for p in out["flat"].vertices) == pytest.approx(0.25)


def test_stage_two_needs_a_model_and_uses_the_cache(spark):
    packed = table(spark, {"a": icosphere(0.5, 1), "none": Mesh(box().vertices, box().faces[:0])})
    with pytest.raises(ValueError):
        pipeline.clean_meshes(packed)
    config = PipelineConfig(render_res=16, prompt_lang="zh")
    first = pipeline.model_verdicts(packed, config, scorers.StubImageScorer).collect()
    by = {r.mesh_id: r for r in first}
    assert by["a"].raw_response and by["none"].render_error.startswith("ValueError") and by["none"].verdict is None
    cache = spark.createDataFrame([(by["a"].cache_key, '{"aesthetic_quality": 1}')], "cache_key string, raw_response string")
    again = {r.mesh_id: r for r in pipeline.model_verdicts(packed, config, scorers.StubImageScorer, cache).collect()}
    assert again["a"].rejection_reasons == ["aesthetic_quality=1 < 2"] and set(again) == {"a", "none"}


def test_slow_kernels_time_out(spark):
    def slow(mesh):
        import time

        for _ in range(200 if len(mesh.faces) > 12 else 1):
            time.sleep(0.05)
        return {"n": len(mesh.faces)}

    out = {r.mesh_id: r for r in map_meshes(table(spark, {"a": box(), "b": icosphere(0.5, 1)}), slow, "n long", timeout_s=0.5).collect()}
    assert (out["a"].n, out["a"].error) == (12, None) and out["b"].error == "TimeoutError:after 0.5 s"


def test_dataset_folders_and_rounds(spark, tmp_path):
    reports = spark.createDataFrame([("d1", "a", True), ("d1", "b", False), ("d2", "c", True)], "dataset string, sha256 string, accepted boolean")
    full = reports.selectExpr("dataset", "sha256", "accepted", "array('x') AS rejection_reasons", "1.5D AS seconds_total", "named_struct('aesthetic_quality', 1, 'object_class', 'c', 'is_primitive', true, 'is_ground_plane', true, 'is_noisy_scan', true, 'is_fragmented', true) AS stage2_vlm",
        "named_struct('metrics', named_struct('fraction_inside_gt', 1D, 'vae', named_struct('chamfer', 1D), 'num_components', 1, 'is_watertight', true)) AS stage4_filter", "'p' AS input_path")
    sinks.write_dataset_summary(full, str(tmp_path / "out"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "out/summary"))
    assert len(rows.columns) == 16 and {(r.dataset, r.sha256) for r in rows.collect()} == {("d1", "a"), ("d1", "b"), ("d2", "c")}
    assert "retention_rate: 0.5000 (50.00%)" in {r.value for r in spark.read.text(str(tmp_path / "out/retention/dataset=d1")).collect()}
    assert [r.dataset for r in rollups.distinct_datasets(full).collect()] == ["d1", "d2"]
    assert [rollups.with_status(full, s).count() for s in ("all", "accepted", "rejected")] == [3, 2, 1]
    with pytest.raises(ValueError):
        rollups.with_status(full, "odd")
    codes = lambda *c: rollups.exit_status(spark.createDataFrame([(x,) for x in c], "code int")).first().status
    assert [codes(), codes(0, 0), codes(0, 3), codes(0, None)] == [0, 0, 1, 1]
    dealt = rollups.with_device(full, ["sha256"], 2, ["x", "y", "z"]).collect()
    assert {(r.sha256, r.slice, r.device) for r in dealt} == {("a", 0, "x"), ("b", 1, "y"), ("c", 0, "x")}
    seen = []
    rollups.in_rounds(full, "sha256", 3, lambda part: seen.extend(r.sha256 for r in part.collect()))
    assert sorted(seen) == ["a", "b", "c"]
    for name in ("d1", "d2"):
        (tmp_path / f"{name}.csv").write_text("sha256,local_path\n" + "".join(f"{name}{k},{k}.glb\n" for k in range(5)))
    listed = files.collect_manifests(spark, {n: str(tmp_path / f"{n}.csv") for n in ("d1", "d2")}, limit=2)
    assert {r.sha256 for r in listed.collect()} == {"d10", "d11", "d20", "d21"}


def test_command_line(tmp_path, spark, monkeypatch):
    from meshloom import cli

    monkeypatch.setattr(cli, "local_session", lambda: spark)
    (tmp_path / "in").mkdir()
    assert cli.main(["batch", str(tmp_path / "in"), str(tmp_path / "out")]) == 1
    (tmp_path / "in" / "a.obj").write_bytes(meshfile.encode_obj(icosphere(0.5, 2)))
    assert cli.main(["clean", str(tmp_path / "in"), str(tmp_path / "out")]) == 1
    assert cli.main(["batch", str(tmp_path / "in"), str(tmp_path / "out"), "--skip-vlm", "--resolution", "16"]) == 0
    rows = spark.read.option("header", True).csv(str(tmp_path / "out/summary")).collect()
    assert len(rows) == 1 and len(rows[0]) == 11 and rows[0].accepted == "1" and rows[0].s1_watertight == "true"


def test_parity_of_a_ray_through_edges(spark):
    v, f = meshfile.unpack(table(spark, {"cube": box()}))
    points = spark.createDataFrame([("cube", 0, 0.0, 0.0, 0.0), ("cube", 1, -2.0, 0.0, 0.0), ("cube", 2, 0.0, 0.5, 0.5), ("cube", 3, 2.0, 0.1, 0.2), ("cube", 4, 0.0, -0.5, 0.25)], "mesh_id string, pid long, x double, y double, z double")
    got = {r.pid: (r.crossings, r.inside) for r in rays.parity_inside(points, topology.corners(v, f)).collect()}
    assert got[0] == (1, True) and got[1] == (2, False) and got[3] == (0, False) and got[2][0] in (0, 1) and got[4] == (1, True)


@pytest.mark.parametrize("size", [(2, 0.5, 1), (1, 3, 1), (0.2, 0.2, 5)])
def test_poses_are_rotations(spark, size):
    r = pose.canonicalise(table(spark, {"m": box(*size, at=(0, size[1] / 2, 0))})).first()
    m = np.array(r.rotation_matrix)
    assert np.abs(m @ m.T - np.eye(3)).max() < 1e-9 and np.linalg.det(m) == pytest.approx(1) and r.method == "geom" and r.error is None
    assert r.up_axis_world == ([-1, 0, 0] if size[1] == 3 else [0, 1, 0])
    turned = pose.apply_pose(table(spark, {"m": box(*size, at=(3, 1, 0))}), pose.canonicalise(table(spark, {"m": box(*size, at=(3, 1, 0))}))).first()
    v = np.array([list(p) for p in turned.vertices])
    assert np.abs(v.min(0) + v.max(0)).max() < 1e-9


def test_up_tie_and_hybrid(spark):
    flipped, kept = (pose.up_axis(box(), tie)[0].tolist() for tie in ("flip", "keep"))
    assert flipped == [0, -1, 0] and kept == [0, 1, 0]
    g = pose.canonicalise(table(spark, {"a": box(at=(0, 0.5, 0)), "b": box(at=(0, 0.5, 0)), "c": box(at=(0, 0.5, 0))}))
    labels = spark.createDataFrame([("a", "+Y", "+X", True), ("b", "+Z", "+X", True)], "mesh_id string, up string, front string, ok boolean")
    out = {r.mesh_id: r for r in pose.hybrid_pose(g, labels).collect()}
    assert out["a"].vlm_agrees_with_geom and not out["a"].needs_manual_review and out["a"].forward_axis_world == [1, 0, 0]
    assert np.linalg.det(np.array(out["a"].rotation_matrix)) == pytest.approx(1)
    assert out["b"].vlm_agrees_with_geom is False and out["b"].needs_manual_review and out["c"].vlm_agrees_with_geom is None and out["c"].needs_manual_review
    assert pose.downgrade("hybrid", True) == "geom" and pose.downgrade("identity", True) == "identity"


def test_views_and_grids(spark):
    m = icosphere(0.4, 2)
    views = render.render_views(m, render.FOUR, 32)
    assert list(views) == list(render.FOUR) and all(v.shape == (32, 32, 3) and v.dtype == np.uint8 for v in views.values())
    assert (views["front"][0, 0] == 255).all() and (views["front"][16, 16] < 255).any()
    assert render.four_view_grid(views).shape == (64, 64, 3) and render.six_view_grid(m, 16, 1).shape == (32, 48, 3)
    with pytest.raises(ValueError):
        render.four_view_grid({"front": views["front"]})
    r = render.render_grids(table(spark, {"m": m, "none": Mesh(m.vertices, m.faces[:0])}), 16, 1).collect()
    by = {x.mesh_id: x for x in r}
    assert by["m"].width == 32 and bytes(by["m"].png[:4]) == b"\x89PNG" and by["none"].error.startswith("ValueError:")


def test_projected_triangles_equal_all_rays():
    rng = np.random.default_rng(3)
    soup = Mesh(rng.normal(size=(60, 3)), rng.integers(0, 60, (80, 3)))
    for mesh in (icosphere(0.4, 2), box(1, 2, 3), soup):
        for camera in [*render.cameras(mesh).values(), render.Camera(np.zeros(3), np.array([1.0, 0, 0]), np.array([0.0, 1, 0]))]:
            dirs = camera.rays(33)
            face, dist = render.camera_hits(mesh, camera, 33, chunk=500)
            want, far = voxels.first_hits(mesh.vertices, mesh.faces, np.broadcast_to(camera.eye, dirs.shape), dirs)
            assert ((face < 0) == (want < 0)).all() and np.allclose(dist, far, atol=1e-9) and (face == want).mean() > 0.97


def test_distances_of_point_sets_cells_and_floods_equal_brute_force():
    rng = np.random.default_rng(4)
    for na, nb, scale in ((1, 1, 1), (50, 3, 5), (400, 500, 0.01), (300, 200, 1)):
        a, b = rng.normal(size=(na, 3)), rng.normal(size=(nb, 3)) * scale + 2
        assert np.allclose(voxels.nearest_distances(a, b), np.sqrt(((a[:, None] - b[None]) ** 2).sum(2).min(1)))
    for share in (0.5, 0.03):
        mask = rng.random((8, 8, 8)) < share
        mask[0, 0, 0], mask[7, 7, 7] = True, False
        full = voxels.distance_transform(mask)
        for c in np.ndindex(mask.shape):
            other = np.argwhere(mask != mask[c])
            assert abs(full[c]) == pytest.approx(np.sqrt(((other - c) ** 2).sum(1).min()), rel=1e-6) and (full[c] < 0) == mask[c]
    for _ in range(40):
        shell = rng.random((9, 9, 9)) < rng.uniform(0.3, 0.97)
        out = np.zeros_like(shell)
        for axis in range(3):
            np.moveaxis(out, axis, 0)[[0, -1]] = np.moveaxis(~shell, axis, 0)[[0, -1]]
        while ((new := voxels.dilate_grid(out) & ~shell | out) != out).any():
            out = new
        assert (voxels.flood_outside(shell) == out).all()


def test_distances_to_triangles_flat_ones_too():
    rng = np.random.default_rng(5)
    p, a, b, c = rng.normal(size=(4, 40, 3))
    b[:5], c[5:10] = a[:5], a[5:10] + (b[5:10] - a[5:10]) * 2
    uv = np.array([(i / 60, j / 60) for i in range(61) for j in range(61 - i)])
    at = a[:, None] + (b - a)[:, None] * uv[None, :, :1] + (c - a)[:, None] * uv[None, :, 1:]
    brute = np.sqrt(((p[:, None] - at) ** 2).sum(2).min(1))
    got = np.sqrt(voxels.point_triangle_squared(p, a, b, c))
    assert (got <= brute + 1e-9).all() and (brute - got < 0.08).all()


def test_files_round_trip(spark, tmp_path):
    m = box(1, 2, 3)
    for name, data in (("a.ply", meshfile.encode_ply(m)), ("b.obj", meshfile.encode_obj(m)), ("sub/c.glb", meshfile.encode_glb(m)), ("d.obj", b"v 0 0 0\n"), ("e.ply", b"junk"), ("f.txt", b"x")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    ascii_ply = b"ply\nformat ascii 1.0\nelement vertex 4\nproperty float x\nproperty float y\nproperty float z\nelement face 1\nproperty list uchar int vertex_indices\nend_header\n0 0 0\n1 0 0\n1 1 0\n0 1 0\n4 0 1 2 3\n"
    (tmp_path / "g.ply").write_bytes(ascii_ply)
    found = files.with_hash(files.list_meshes(spark, str(tmp_path), content=True))
    assert found.count() == 6 and all(len(r.sha256) == 64 for r in found.select("sha256").collect())
    by = {r.mesh_id.rsplit("/", 1)[1]: r for r in meshfile.decode_files(found).collect()}
    for name in ("a.ply", "b.obj", "c.glb"):
        assert np.allclose([list(p) for p in by[name].vertices], m.vertices) and [list(t) for t in by[name].faces] == m.faces.tolist()
    assert len(by["g.ply"].faces) == 2 and by["d.obj"].error == "ValueError:mesh has no faces" and by["e.ply"].error
    out = pipeline.clean_directory(spark, str(tmp_path), PipelineConfig(watertight=voxels.WatertightConfig(res=20), skip_model=True, ray_samples=50)).collect()
    assert sum(r.error is not None and not r.accepted for r in out) == 2 and len({r.sha256 for r in out}) == len(out)


def test_scene_flattening():
    turn = np.diag([-1.0, 1, 1, 1])
    turn[:3, 3] = (5, 0, 0)
    out = meshfile.flatten_scene([(box(), np.eye(4)), (box(), turn)])
    assert len(out.faces) == 24 and voxels.manifold_flags(out.faces)["is_watertight"]
    tri = out.vertices[out.faces]
    assert (np.einsum("ij,ij->i", tri[:, 0], np.cross(tri[:, 1], tri[:, 2])).sum() / 6) == pytest.approx(2)
    with pytest.raises(ValueError):
        meshfile.flatten_scene([])


def test_manifest_and_paths(spark, tmp_path):
    (tmp_path / "m.csv").write_text("sha256,local_path,x\nabc,a.glb,1\n,b.glb,2\ndef,,3\nghi,c.glb,4\n")
    rows = files.read_manifest(spark, str(tmp_path / "m.csv"), "ds")
    assert [r.sha256 for r in rows.orderBy("pos").collect()] == ["abc", "def", "ghi"]
    listing = spark.createDataFrame([("/r/raw/a.glb",), ("/r/def.glb",)], "path string")
    out = files.resolve_paths(rows, files.candidate_paths(F.lit("/r"), F.col("sha256"), F.col("local_path")), listing, ["dataset", "sha256"])
    assert {r.sha256: r.path for r in out.collect()} == {"abc": "/r/raw/a.glb", "def": "/r/def.glb"}


def test_reports_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"sha256":"a","input_path":"p1","accepted":true,"rejection_reasons":[],"seconds_total":1.5,"stage_reports":{"stage1_watertighten":{"is_watertight":true,"chamfer_to_input":null}}}')
    (tmp_path / "in" / "b.json").write_text('{"sha256":"b","input_path":"p2","accepted":false,"rejection_reasons":["x","y"],"seconds_total":2.5}')
    (tmp_path / "in" / "c.json").write_text("{broken")
    reports = files.read_reports(spark, str(tmp_path / "in"))
    assert sorted(r.sha256 for r in reports.collect()) == ["a", "b"]
    text = sinks.markdown_report(reports, "in")
    assert "| seconds, all stages | 2 | 1.500 | 2.000 | 2.000 | 2.500 |" in text and "| kept for training | 1 | 2 | 50.0 % |" in text
    assert re.search(r"\| 2 \| p2 \| no \| [0-9.]+ \| - \| x, y \|", text) and "| x | 1 |" in text and "| y | 1 |" in text
    assert "The first 1 by path" in sinks.markdown_report(reports, "in", page=1)
    assert sinks.write_batch_summary(reports, str(tmp_path / "csv")) and not sinks.write_batch_summary(reports.limit(0), str(tmp_path / "none"))
    assert files.read_summary(spark, str(tmp_path / "csv"), 1).first().reasons in (None, "")


def test_dataset_run_resumes(spark):
    packed = table(spark, {"a": box(), "b": icosphere(0.5, 2), "c": Mesh(box().vertices, box().faces[:0])}).withColumn("dataset", F.lit("d"))
    config = PipelineConfig(failure_policy="closed", ray_samples=100, render_res=32)
    done = spark.createDataFrame([("b",)], "mesh_id string")
    out = {r.mesh_id: r for r in pipeline.filter_datasets(packed, config, done, scorers.StubImageScorer).collect()}
    assert set(out) == {"a", "c"} and "stage4:primitive_like" in out["a"].rejection_reasons and out["c"].rejection_reasons[0].startswith("error:render:")


def test_cleaning_short_circuits(spark):
    config = PipelineConfig(skip_watertight=True, ray_samples=100, short_circuit=True, render_res=32)
    out = {r.mesh_id: r for r in pipeline.clean_meshes(table(spark, {"cube": box(), "ball": icosphere(0.5, 2)}), config, scorers.StubImageScorer).collect()}
    assert out["cube"].verdict is None and out["ball"].verdict is not None and out["cube"].rejection_reasons == ["stage4:primitive_like"] and len(out["cube"].vertices) == 8


def test_sample_and_chamfer(spark):
    a, b = box(), box(at=(0.1, 0, 0))
    assert voxels.chamfer_meshes(a, a, 2000) < 0.05 and voxels.chamfer_meshes(a, b, 2000) > voxels.chamfer_meshes(a, a, 2000)
    rng = np.random.default_rng(1)
    q, t = rng.random((60, 3)), np.concatenate([rng.random((80, 3)), [[9.0, 9, 9]]])
    frame = lambda x, key: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], f"{key} long, x double, y double, z double")
    got = {r.qid: (r.tid, r.d) for r in neighbours.nearest(frame(q, "qid"), frame(t, "tid"), ["x", "y", "z"], cell=0.2).collect()}
    d = np.linalg.norm(q[:, None] - t[None], axis=2)
    assert {k: v[0] for k, v in got.items()} == {i: int(j) for i, j in enumerate(d.argmin(1))} and all(math.isclose(got[i][1], d[i].min(), rel_tol=1e-9) for i in got)


@pytest.mark.parametrize("n, spread", [(1, 1.0), (7, 1.0), (300, 0.05), (300, 3.0)])
def test_nearest_vectors_equal_brute_force(spark, n, spread):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(9, 16)) * 4
    t = centres[rng.integers(0, 9, n)] + rng.normal(size=(n, 16)) * spread
    q = np.concatenate([centres[rng.integers(0, 9, 90)] + rng.normal(size=(90, 16)) * spread, t[:3]])
    t = np.concatenate([t, t[:5]])  # ties go to the least id
    frame = lambda x, key: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], f"{key} long, v array<double>")
    got = {r.qid: (r.tid, r.d) for r in neighbours.nearest_vectors(frame(q, "qid"), frame(t, "tid"), rows=10, most=20).collect()}
    d = np.linalg.norm(q[:, None] - t[None], axis=2)
    assert {k: v[0] for k, v in got.items()} == {i: int(j) for i, j in enumerate(d.argmin(1))} and all(math.isclose(got[i][1], d[i].min(), abs_tol=1e-9) for i in got)
    assert neighbours.nearest_vectors(frame(q, "qid"), frame(t, "tid").limit(0)).count() == 0


def test_failing_scorer_is_a_row(spark):
    class Bad:
        name = "bad"

        def generate(self, images, prompt):
            raise RuntimeError("no model")

    images = spark.createDataFrame([("a", b"x"), ("b", b"y")], "mesh_id string, png binary")
    assert {r.error for r in scorers.infer(images, Bad).collect()} == {"RuntimeError:no model"}
    ok = scorers.decide(scorers.infer(images)).collect()
    assert all(r.verdict.aesthetic_quality in range(1, 6) and r.accepted == (r.verdict.aesthetic_quality >= 2) for r in ok)


def test_sampling_is_repeatable(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    a, b = ([r.k for r in rollups.shuffled_sample(rows.repartition(n), "k", 3, 10).collect()] for n in (2, 7))
    assert a == b and len(set(a)) == 10
    assert [r.n for r in rollups.numbered(rows.repartition(5), ["k"]).orderBy("k").collect()] == list(range(1, 101))


def test_blank_environment_is_unset(monkeypatch):
    monkeypatch.setenv("MESHLOOM_DATA", "  ")
    assert env("DATA", "x") == "x"


@settings(max_examples=25, deadline=None)
@given(st.sets(st.tuples(*[st.integers(0, 7)] * 3), max_size=60))
def test_voxel_properties(cells):
    grid = voxels.grid_of(np.array(sorted(cells), int).reshape(-1, 3), 8)
    slow = np.zeros_like(grid)
    for x, y, z in cells:
        slow[max(0, x - 1) : x + 2, max(0, y - 1) : y + 2, max(0, z - 1) : z + 2] = True
    assert (voxels.dilate_grid(grid) == slow).all()
    closed, outside = voxels.close_grid(grid, 1), voxels.flood_outside(grid)
    assert (closed | ~grid).all() and not (outside & grid).any()


@settings(max_examples=10, deadline=None)
@given(st.integers(0, 2**31))
def test_surfaces_are_closed(seed):
    rng = np.random.default_rng(seed)
    values = np.pad(rng.normal(size=(5, 5, 5)), 1, constant_values=1.0)
    v, f = voxels.extract_surface(values)
    if len(f):
        e = np.concatenate([f[:, [0, 1]], f[:, [1, 2]], f[:, [2, 0]]])
        _, n = np.unique(e, axis=0, return_counts=True)
        back = {tuple(x) for x in e[:, ::-1].tolist()}
        assert (n == 1).all() and all(tuple(x) in back for x in e.tolist())


def test_kernel_errors_are_rows(spark):
    def boom(_):
        raise KeyError("x" * 500)

    r = map_meshes(table(spark, {"m": box()}), boom, "n long").first()
    assert r.n is None and r.error.startswith("KeyError:") and len(r.error) <= 209


def test_streaming_ingest(spark, tmp_path):
    from meshloom.streaming import ingest

    (tmp_path / "in").mkdir()
    for name in ("a.obj", "b.obj"):
        (tmp_path / "in" / name).write_bytes(meshfile.encode_obj(box()))
    reports, check = str(tmp_path / "reports"), str(tmp_path / "check")

    def process(rows):
        return rows.select("sha256", "path")

    def once():
        ingest.ingest(ingest.stream_meshes(spark, str(tmp_path / "in")), process, reports, check).awaitTermination(120)

    once()
    assert spark.read.parquet(reports).count() == 1
    (tmp_path / "in" / "c.obj").write_bytes(meshfile.encode_obj(box(2)))
    once()
    assert spark.read.parquet(reports).count() == 2


def test_decoder_in_sql(spark):
    from meshloom.functions import tables

    tables.register(spark)
    spark.createDataFrame([("a.obj", meshfile.encode_obj(box())), ("b.ply", b"x")], "path string, content binary").createOrReplaceTempView("mesh_files")
    rows = {r.mesh_id: r for r in spark.sql("SELECT d.* FROM mesh_files, LATERAL decode_mesh(path, content) d").collect()}
    assert len(rows["a.obj"].faces) == 12 and len(rows["a.obj"].vertices) == 8 and rows["b.ply"].error


def test_orientation_of_shuffled_faces(spark):
    rng = np.random.default_rng(4)
    m = two_spheres()
    turned = rng.random(len(m.faces)) < 0.5
    f = np.where(turned[:, None], m.faces[:, [0, 2, 1]], m.faces)
    out = topology.oriented_faces(m.vertices, f)
    p = m.vertices[out]
    assert voxels.manifold_flags(out)["is_winding_consistent"] and (p[:, 0] * np.cross(p[:, 1], p[:, 2])).sum() > 0
    assert len(topology.oriented_faces(m.vertices, f[:0])) == 0


def test_caches_answer_their_own_requests_in_order(spark):
    requests = spark.createDataFrame([(3, "m", "a", "k"), (1, "m", "b", "k"), (2, "m", "a", "k"), (0, "o", "a", "l"), (4, "o", None, "l")], "n long, mesh_id string, cache string, cache_key string")
    caches = spark.createDataFrame([("a", "k", "old"), ("a", "k", "old"), ("b", "k", None), ("b", "l", "other")], "cache string, cache_key string, raw_response string")
    score = lambda rows: rows.selectExpr("mesh_id", "concat('new ', mesh_id) AS raw_response", "CAST(NULL AS STRING) AS error")
    found = scorers.with_caches(requests, caches, score).collect()
    assert [(r.n, r.mesh_id, r.cache, r.raw_response, r.cached) for r in found] == [(0, "o", "a", "new 0", False), (1, "m", "b", "new 1", False), (2, "m", "a", "old", True), (3, "m", "a", "old", True), (4, "o", None, "new 4", False)]


def test_stage_seconds_reach_the_reports(spark, tmp_path):
    packed = table(spark, {"a": box(), "b": icosphere(0.5, 2)})
    config = PipelineConfig(watertight=voxels.WatertightConfig(res=16, chamfer_samples=100), ray_samples=100, render_res=16)
    clean = pipeline.clean_meshes(packed, config, scorers.StubImageScorer)
    clean.write.parquet(str(tmp_path / "clean"))
    done = pipeline.as_results(spark.read.parquet(str(tmp_path / "clean")))
    for r in done.collect():
        assert all(r.stage_timings[n] > 0 for n in pipeline.STAGES.values()) and r.seconds_total == pytest.approx(sum(r.stage_timings))
    assert sinks.write_batch_summary(done, str(tmp_path / "csv")) and all(r.total_s is not None for r in files.read_summary(spark, str(tmp_path / "csv")).collect())
    text = sinks.markdown_report(done, "corpus")
    assert text.count("| seconds, ") == 5 and "closing the surface" in text
    stages = voxels.watertighten(packed, config.watertight).select("stage_timings", "seconds").collect()
    assert all(set(r.stage_timings) == {"decimate", "voxelize_shell", "close_shell", "flood_fill", "open_shell_check", "thicken", "sdf", "marching_cubes"} and sum(r.stage_timings.values()) <= r.seconds for r in stages)
    skipped = pipeline.as_results(pipeline.clean_meshes(packed, PipelineConfig(skip_model=True, skip_watertight=True, ray_samples=50))).first()
    assert skipped.stage_timings.stage1_watertighten is None and skipped.stage_timings.stage2_vlm_filter is None and skipped.seconds_total > 0


def test_command_line_options_of_models_and_skipped_stages(spark, tmp_path, monkeypatch):
    from meshloom import cli
    from meshloom.operators import fields

    monkeypatch.setattr(cli, "local_session", lambda: spark)
    shown = tmp_path / "shown"
    source = tmp_path / "in"
    source.mkdir()
    mesh = box()
    for k in (1, 2):
        lines = [f"v {x * k} {y} {z}" for x, y, z in mesh.vertices.tolist()] + [f"f {a + 1} {b + 1} {c + 1}" for a, b, c in mesh.faces.tolist()]
        (source / f"m{k}.obj").write_text("\n".join(lines))
    path = str(shown)

    def factory():
        from meshloom.operators.scorers import StubImageScorer

        class Counting:
            name, own = "counting", StubImageScorer()

            def generate(self, images, prompt):
                with open(path, "a") as f:  # a line for each image that it is shown
                    f.write("x\n" * len(images))
                return self.own.generate(images, prompt)

        return Counting()

    monkeypatch.setattr(cli, "_factory", lambda name: {"shape": fields.BoxModel, None: None}.get(name, factory))
    run = lambda out, *more: cli.main(["batch", str(source), str(tmp_path / out), "--resolution", "16", "--scorer", "s", *more])
    assert run("a", "--vlm-cache-dir", str(tmp_path / "cache"), "--skip-vae", "--skip-canonicalize") == 0
    assert shown.read_text() == "x\n" * 2
    rows = spark.read.parquet(str(tmp_path / "a" / "results")).collect()
    assert len(rows) == 2 and all(r.pose.method == "identity" and r.metrics.vae is None for r in rows)
    assert run("b", "--vlm-cache-dir", str(tmp_path / "cache"), "--vlm-min-quality", "99", "--skip-stage4", "--skip-canonicalize") == 0
    assert shown.read_text() == "x\n" * 2 and spark.read.parquet(str(tmp_path / "cache")).count() == 2
    rows = spark.read.parquet(str(tmp_path / "b" / "results")).collect()
    assert all(r.metrics is None and any("< 99" in x for x in r.rejection_reasons) and r.stage_timings.stage4_filter_geometry is None for r in rows)
