"""Plans whose memory doesn't grow with the corpus: no table of exploded rows is broadcast, and tasks grow in number with the rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobs import job1_curate_meshes as job1
from meshloom.config import PipelineConfig
from meshloom.operators import bricks, neighbours, packed, rays, render, topology, voxels
from meshloom.plans import kernel_queries, pipeline
from meshloom.plans.catalog import QUERIES
from meshloom.sources import boxes

SF = "/root/testdata/sf0.001"
BY_MESH = "corpus_qc fit_unit_cube largest_component merged_mesh mesh_summary oriented_boxes posed_extents primitive_score ray_agreement ray_parity_inside rotation_apply shell_voxels sign_agreement stage4_filter surface_sample_counts up_axis_score vertex_normals watertight_boxes".split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def cuts(monkeypatch):
    """The plans of tables that the operators write on their way."""
    found = []
    for module in (topology, bricks):
        real = module.cut
        monkeypatch.setattr(module, "cut", lambda df, real=real: found.append(plan(df)) or real(df))
    return found


@pytest.mark.parametrize("name", BY_MESH)
def test_meshes_are_never_broadcast(spark, cuts, name):
    assert not [p for p in (*cuts, plan(QUERIES[name](spark, SF)), *cuts) if "Broadcast" in p]


def test_bricks_are_never_broadcast(spark, cuts):
    part = boxes.dealt(spark.read.parquet(f"{SF}/part.parquet").limit(5))
    found = bricks.watertighten_bricks(boxes.box_vertices(part), boxes.box_faces(part), bricks.BrickConfig(res=16, side=8, close_iters=1))
    assert len(cuts) > 5 and not [p for p in (*cuts, *map(plan, found)) if "Broadcast" in p]


def test_geometry_stage_broadcasts_its_unit_points_alone(spark):
    assert "BroadcastHashJoin" not in plan(QUERIES["geometry_stage"](spark, SF))


def test_job1_never_broadcasts_meshes(spark):
    part = spark.read.parquet(f"{SF}/part.parquet")
    v, f = boxes.box_vertices(part), boxes.box_faces(part)
    judged = job1.reports(v, f, part.selectExpr("p_partkey AS mesh_id", "p_brand AS dataset"), job1.Config())
    assert "Broadcast" not in plan(judged) and "Broadcast" not in plan(job1.export(v, f, judged.select("mesh_id", "split", "accepted", "dataset"), 0.03))


def test_parts_are_dealt_by_their_number(spark):
    part = spark.range(50_001).select(F.col("id").alias("p_partkey"), F.lit(3).alias("p_size"), F.lit(950.0).alias("p_retailprice"))
    dealt = boxes.dealt(part)
    assert dealt.rdd.getNumPartitions() == 26 and boxes.dealt(part.limit(0)).count() == 0
    both = plan(topology.manifoldness(boxes.box_faces(dealt)))
    assert both.count("Exchange hashpartitioning") == 1  # edges are grouped where their mesh lies


def test_a_kernel_gives_its_rows_in_pieces(spark):
    drawn = []  # rows that were made before the first piece left
    rows = ({"x": [0] * 1000, "n": drawn.append(k)} for k in range(100))
    assert len(next(packed.in_pieces(rows, 5000))) == 5 == len(drawn) and sum(map(len, packed.in_pieces(rows, 5000))) == 95
    assert list(packed.in_pieces(iter([]))) == [] and [len(p) for p in packed.in_pieces(iter([{"n": 1}] * 7), 3)] == [3, 3, 1]
    meshes = packed.pack(*(g(spark.range(40).selectExpr("id AS p_partkey", "3 AS p_size", "950.0D AS p_retailprice")) for g in (boxes.box_vertices, boxes.box_faces)))
    out = packed.map_meshes(meshes.coalesce(1), lambda m: {"x": [len(m.vertices)] * (packed.HELD // 4)}, "x array<long>").selectExpr("mesh_id", "x[0] AS n", "error")
    assert sorted(map(tuple, out.collect())) == [(k, 24 if k % 5 == 0 else 8, None) for k in range(40)]


def test_every_kind_of_field_is_drawn_once(spark, monkeypatch, tmp_path):
    spark.range(5000).selectExpr("id AS p_partkey", "CAST(id % 50 + 1 AS INT) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    seen, real = [], kernel_queries.map_meshes
    monkeypatch.setattr(kernel_queries, "map_meshes", lambda packed_, *rest: seen.append(packed_.count()) or real(packed_, *rest))
    assert QUERIES["box_surfaces"](spark, str(tmp_path)).count() == 5000 and seen == [60]


def test_nearest_vectors_hold_few_entries_at_once(spark):
    """Every cell has to be looked at, and neither rows times cells nor a block's distances are held whole."""
    assert list(neighbours._steps(10, 8, 32)) == [(0, 4), (4, 8), (8, 10)] and list(neighbours._steps(2, 99, 32)) == [(0, 1), (1, 2)] and not list(neighbours._steps(0, 8, 32))
    rng = np.random.default_rng(5)
    q, t = rng.normal(size=(60, 24)), rng.normal(size=(200, 24))
    frame = lambda x, key: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], f"{key} long, v array<double>")
    got = neighbours.nearest_vectors(frame(q, "qid"), frame(t, "tid"), rows=10, held=50).collect()
    assert {r.qid: r.tid for r in got} == dict(enumerate(np.linalg.norm(q[:, None] - t[None], axis=2).argmin(1).tolist()))


def test_small_images_of_many_meshes_are_rendered_at_once(spark, monkeypatch):
    sizes, real = [], render.render_images
    some = [packed.Mesh(np.array([[0, 0, 0], [k + 1.0, 0, 0], [0, 2, 0], [0, 0, 3]]), np.array([[0, 2, 1], [0, 1, 3], [0, 3, 2], [1, 2, 3]][: 1 + k % 4])) for k in range(9)]
    at = [[render.cameras(m)[n] for n in render.SIX.values()] for m in some]
    for images, m, own in zip(render.render_images(some, at, 20, 2), some, at, strict=True):
        assert all((image == render.render_view(m, camera, 20, 2)).all() for image, camera in zip(images, own, strict=True))
    monkeypatch.setattr(render, "render_images", lambda meshes, *rest: sizes.append(len(meshes)) or real(meshes, *rest))
    seen = {}
    monkeypatch.setattr(render, "map_meshes", lambda _, kernel, schema, **how: seen.update(how, kernel=kernel))
    render.render_grids(None, 16, 1)
    rows = seen["together"](some)
    assert sizes == [9] and rows == [seen["kernel"](m) for m in some] and seen["share"](some[0]) < 0.1 and seen["share"](packed.Mesh(some[0].vertices, some[0].faces[:0])) == 1.0


def test_a_bad_mesh_among_many_fails_alone(spark):
    rows = spark.range(30).selectExpr("id AS mesh_id", "array(named_struct('x', id + 1D, 'y', 0D, 'z', 0D), named_struct('x', 0D, 'y', 1D, 'z', 0D), named_struct('x', 0D, 'y', 0D, 'z', 1D)) AS vertices",
                                      "CASE WHEN id % 7 = 3 THEN array(named_struct('a', 0L, 'b', 1L, 'c', 9L)) WHEN id = 5 THEN array_repeat(named_struct('a', 0L, 'b', 1L, 'c', 2L), 0) ELSE array(named_struct('a', 0L, 'b', 1L, 'c', 2L)) END AS faces")
    got = {r.mesh_id: r for r in render.render_grids(rows.coalesce(1), 16, 1).collect()}
    assert len(got) == 30 and all((r.png is None) == (k % 7 == 3 or k == 5) == (r.error is not None) for k, r in got.items()) and got[5].error == "ValueError:mesh has no faces" and got[3].error.startswith("IndexError:")
    failing = packed.map_meshes(rows, lambda m: {"n": len(m.faces)}, "n int", together=lambda some: 1 / 0, share=lambda m: 0.1).collect()
    assert len(failing) == 30 and not any(r.error for r in failing)


def test_merging_shuffles_by_mesh_alone_and_keeps_corners_of_no_vertex(spark, monkeypatch):
    monkeypatch.setattr(boxes, "DEALT_ROWS", 20)
    deals = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\w+)", plan(QUERIES["merged_mesh"](spark, SF)))
    assert deals and {(key, more.isdigit()) for key, more in deals} == {("p_partkey", True)}  # meshes stay where they were dealt
    v = spark.createDataFrame([(1, k, *p) for k, p in ((2, (0.0, 0.0, 0.0)), (5, (1.0, 0.0, 0.0)), (7, (0.0, 1.0, 0.0)), (40, (0.0, 0.0, 1e-12)), (41, (1.0, 0.0, 0.0)))], "mesh_id long, vid long, x double, y double, z double")
    f = spark.createDataFrame([(1, 0, 2, 5, 7), (1, 3, 40, 7, 41), (1, 4, 2, 40, 5), (1, 6, 41, 99, 7)], "mesh_id long, fid long, a long, b long, c long")
    mv, mf = topology.merge_vertices(v.repartition(2), f.repartition(3))
    assert sorted(r.vid for r in mv.collect()) == [2, 5, 7] and sorted(map(tuple, mf.collect())) == [(1, 0, 2, 5, 7), (1, 6, 5, 99, 7)]


@pytest.mark.parametrize("step", [topology.components, topology.orient])
def test_small_meshes_are_labelled_and_oriented_at_once(monkeypatch, step):
    seen, rng = {}, np.random.default_rng(3)
    monkeypatch.setattr(topology, "map_meshes", lambda _, kernel, schema, **how: seen.update(how, kernel=kernel))
    step(None)
    some = []
    for k in range(40):
        t = np.concatenate([np.array(boxes.TRIANGLES) + 8 * c for c in range(1 + k % 3)])[k % 2 :]
        t = np.where((rng.random(len(t)) < 0.3)[:, None], t[:, [0, 2, 1]], t) if k % 10 else t[:0]
        some.append(packed.Mesh(np.concatenate([np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)]) + [3.0 * c, 0, 0] for c in range(1 + k % 3)]), t))
    assert seen["together"](some) == [seen["kernel"](m) for m in some] and seen["share"](some[1]) < 0.01
    with pytest.raises(IndexError):  # a face may not reach into the next mesh
        seen["together"]([packed.Mesh(some[1].vertices[:4], some[1].faces), some[2]])


def test_meshes_are_oriented_once(spark):
    assert "MapInArrow" not in plan(QUERIES["oriented_boxes"](spark, SF))  # several measures read what the kernel has written


def test_small_grids_keep_their_bricks_in_one_task(spark, cuts):
    """The driver's memory follows the steps of a plan: brick_volumes wrote and read tables some ten times over, and each was shuffled."""
    assert "MapInArrow" in plan(QUERIES["brick_volumes"](spark, SF)) and not cuts
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey IN (1, 5, 7, 35, 77)")
    v, f = boxes.box_vertices(part), boxes.box_faces(part)
    odd = "(900, 0, 0D, 0D, 0D), (900, 1, 1D, 2D, 3D), (901, 0, 1D, 1D, 1D), (902, 0, 0D, 0D, 0D), (902, 1, 1D, 0D, 0D), (902, 2, 0D, 1D, 0D)"  # no faces, no extent, a triangle
    v = v.unionAll(spark.sql(f"SELECT CAST(c[0] AS LONG), CAST(c[1] AS LONG), c[2], c[3], c[4] FROM (SELECT explode(array({odd.replace('(', 'array(')})) AS c)"))
    f = f.unionAll(spark.sql("SELECT m, f, 0L, 1L, c FROM VALUES (901L, 0L, 0L), (902L, 0L, 2L) AS t(m, f, c)"))
    got = {}
    for together in (0, 30, 1 << 14):  # dealt, mixed (three boxes are more than 30 faces), in one task
        pieces, report = bricks.watertighten_bricks(v, f, bricks.BrickConfig(res=16, side=8, close_iters=1, together=together))
        got[together] = sorted(map(tuple, report.collect())), sorted(map(repr, pieces.collect()))
        if together == 30:
            assert bricks.larger(30, v, f).count() == 2
    assert got[0] == got[30] == got[1 << 14] and [r[0] for r in got[0][0]] == [1, 5, 7, 35, 77, 900, 902] and len(got[0][1]) > 20


def test_the_largest_component_of_small_meshes_takes_one_step(spark, cuts):
    assert "MapInArrow" in plan(QUERIES["largest_component"](spark, SF)) and not cuts  # contraction wrote two tables before it began and three a round
    rng = np.random.default_rng(8)
    some = {k: rng.integers(0, 6 + k, (k % 23, 3)) + (k % 3) * 10**12 for k in range(60)} | {98: np.arange(25)[:, None] // 13 + np.arange(25)[:, None] + [0, 1, 2], 99: np.array([[0, 1, 2], [7, 8, 9], [5, 4, 3]])}
    f = spark.createDataFrame([(m, 5 * (len(t) - i), *map(int, c)) for m, t in some.items() for i, c in enumerate(t) if len(set(c)) == 3], "mesh_id long, fid long, a long, b long, c long").repartition(3)
    want = sorted(map(tuple, topology.keep_largest_component(f, topology.component_labels(f)).select("mesh_id", "fid", "a", "b", "c").collect()))
    assert len(want) > 99 and [r[1:] for r in want if r[0] == 99] == [(5, 5, 4, 3)] and sum(r[0] == 98 for r in want) == 13  # strips of 13 and 12 faces
    for together in (1 << 14, 9):  # all at once, and with the larger ones in rounds
        assert sorted(map(tuple, topology.largest_faces(f, together).collect())) == want


def test_rays_of_small_meshes_need_no_rows_of_points(spark, monkeypatch):
    """Each point stood in a row for every grid of its mesh, and these were shuffled for either axis."""
    text = plan(QUERIES["geometry_stage"](spark, SF))
    assert "_level" not in text and "unit" not in text and not re.findall(r"Exchange hashpartitioning\([^)]*pid", text)
    rng = np.random.default_rng(6)
    some = {k: (rng.normal(size=(8, 3)) * (k % 3 > 0), rng.integers(-1, 9, (k % 11, 3))) for k in range(30)}
    some |= {30: (np.zeros((0, 3)), np.zeros((0, 3))), 31: (np.array([[0, 0, 0], [np.inf, 0, 0], [0, 1, 0], [1, 1, 1]]), np.array([[0, 1, 2], [0, 2, 3]])), 32: (rng.normal(size=(40, 3)), rng.integers(0, 40, (90, 3)))}
    cube = np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)], float)
    some |= {40 + k: (cube * [1, 2, k], np.array(boxes.TRIANGLES)[k:]) for k in range(4)}
    rows = [(k, [tuple(map(float, p)) for p in v], [tuple(map(int, t)) for t in f]) for k, (v, f) in some.items()]
    meshes = spark.createDataFrame(rows, f"mesh_id long, vertices {packed.VERTEX}, faces {packed.FACE}").repartition(3)
    config = PipelineConfig(ray_samples=37)
    want = pipeline._agreement(meshes, config, lambda points, at: rays.parity_inside(points, at))
    got = {r.mesh_id: r for r in pipeline._agreement(meshes, config, rays.parity_inside).collect()}
    few = {r.mesh_id for r in meshes.where(rays.has_few()).collect()}
    assert few == set(some) - {31, 32} and set(got) == set(some) - {30}
    monkeypatch.setattr(rays, "AT_ONCE", 100)
    again = {r.mesh_id: r for r in rays.box_agreement(meshes.where(rays.has_few()), 37).collect()}
    for r in want.collect():
        assert got[r.mesh_id] == r and again.get(r.mesh_id, r) == r, r


def test_small_grids_are_made_watertight_at_once(spark, monkeypatch):
    """Each mesh went alone through hundreds of short calls, and its surface left as an object for each vertex and face."""
    seen, real = {}, voxels.map_meshes
    monkeypatch.setattr(voxels, "map_meshes", lambda _, kernel, schema, **how: seen.update(how, kernel=kernel))
    voxels.watertighten(None, voxels.WatertightConfig(res=12, close_iters=1, chamfer_samples=40))
    monkeypatch.setattr(voxels, "map_meshes", real)
    rng = np.random.default_rng(2)
    cube = np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)], float)
    some = [packed.Mesh(np.concatenate([cube * [1 + k, 2, 3] + [9.0 * c, 0, 0] for c in range(1 + k % 3)]), np.concatenate([np.array(boxes.TRIANGLES)[k % 4 :] + 8 * c for c in range(1 + k % 3)])) for k in range(8)]
    some += [packed.Mesh(rng.normal(size=(20, 3)), rng.integers(0, 20, (k, 3))) for k in range(1, 6)]
    plain = lambda r: {k: x.tolist() if isinstance(x, np.ndarray) else x for k, x in r.items() if k != "stage_timings"}
    assert list(map(plain, seen["together"](some))) == [plain(seen["kernel"](m)) for m in some]
    assert seen["share"](some[0]) < 0.1 and {seen["share"](packed.Mesh(v, f)) for v, f in ((cube, np.array([[0, 1, 8]])), (cube * 0, np.array([[0, 1, 2]])), (cube, np.zeros((0, 3), int)))} == {1.0}
    rows = [(k, [tuple(map(float, p)) for p in m.vertices], [tuple(map(int, t)) for t in m.faces]) for k, m in enumerate([*some, packed.Mesh(cube, np.zeros((0, 3), int)), packed.Mesh(cube * 0, some[0].faces), packed.Mesh(cube, np.array([[0, 1, 9]]))])]
    got = {r.mesh_id: r for r in voxels.watertighten(spark.createDataFrame(rows, f"mesh_id long, vertices {packed.VERTEX}, faces {packed.FACE}").coalesce(1), voxels.WatertightConfig(res=12, close_iters=1, chamfer_samples=40)).collect()}
    assert [got[k].error.split(":")[0] for k in (13, 14, 15)] == ["ValueError", "ValueError", "IndexError"] and got[13].vertices is None
    for k, m in enumerate(some):
        mesh, report = voxels.watertighten_mesh(m, voxels.WatertightConfig(res=12, close_iters=1, chamfer_samples=40))
        assert [tuple(p) for p in got[k].vertices] == [tuple(p) for p in mesh.vertices.tolist()] and [tuple(t) for t in got[k].faces] == [tuple(t) for t in mesh.faces.tolist()] and got[k].shell_voxels == report["shell_voxels"]


def test_stacked_floods_equal_single_ones():
    rng = np.random.default_rng(9)
    stack = rng.random((20, 9, 9, 9)) < np.linspace(0, 1, 20)[:, None, None, None]
    maze = np.ones((2, 13, 13, 13), bool)
    for k in range(1, 12, 2):  # one way from the border through all of a layer
        maze[0, 1:12, k, 6] = False
        maze[0, 11 if k % 4 == 1 else 1, k : k + 2, 6] = False
    maze[0, 0, 1, 6] = False
    for s in (stack, maze, maze[:1], stack[:0]):
        assert (voxels.flood_stack(s) == np.array([voxels.flood_outside(x) for x in s]).reshape(s.shape)).all()


def test_edges_of_grids_and_labels_of_large_numbers(monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(3, 7, 6, 5))
    marked = voxels.cut_edges(values)
    monkeypatch.setattr(voxels, "DENSE", 0)
    assert all((a == b).all() for a, b in zip(marked, voxels.cut_edges(values), strict=True))
    faces = rng.integers(0, 30, (80, 3))
    assert (topology.face_labels(faces) == topology.face_labels(faces * 10**14)).all() and (topology.face_labels(faces) == topology.face_labels(faces - 50)).all()
    p, q = rng.normal(size=(70, 3)), rng.normal(size=(90, 3))
    both = (voxels.nearest_distances(p, q).mean() + voxels.nearest_distances(q, p).mean()) / 2
    assert voxels.mean_distance(p, q) == both and voxels.mean_distance(p, q, 100) == both


def test_bricks_of_small_grids_are_flooded_at_once_and_tell_pieces_only_if_asked(monkeypatch):
    """A task labelled every brick, tied the labels in arrays of all rims, and made pieces that the report has no use for."""
    rng = np.random.default_rng(11)
    config = bricks.BrickConfig(res=14, side=5, close_iters=1, together=1000)  # bricks of two sizes
    cube = np.array([[x, y, z] for x in (0, 1) for y in (0, 1) for z in (0, 1)], float) * 0.7 + 0.15
    some = [packed.Mesh(cube * [1, 1, 0.2 + 0.1 * k], np.array(boxes.TRIANGLES)[k:]) for k in range(5)]
    some += [packed.Mesh(rng.random((12, 3)) * 0.9 + 0.05, rng.integers(0, 12, (4 + 3 * k, 3))) for k in range(10)]
    wholes = voxels.narrow_bands(some, 14, bricks.BAND)
    for thick in (0, 1):
        for whole, (_, solid, outside) in zip(wholes, bricks._flooded(wholes, config, thick), strict=True):
            assert (voxels.flood_outside(solid) == outside).all()
            every = [bricks.Brick(at, None, config, thick, whole) for at in np.ndindex(3, 3, 3)]
            bricks.Brick.finish(every, config, thick)
            first = np.cumsum([0, *[b.count for b in every]])
            ties, border = [], np.zeros(first[-1] + 1, bool)
            names = [np.where(b.labels > 0, b.labels + n, 0) for b, n in zip(every, first, strict=False)]
            for b, own in zip(every, names, strict=True):
                border[[n + first[every.index(b)] for n in b.border_labels(b.labels, 14)]] = True
                for c, other in zip(every, names, strict=True):
                    low, high = np.maximum(b.first, c.first), np.minimum(b.end, c.end)
                    if (low < high).all():
                        x, y = (n[tuple(map(slice, low - k.first, high - k.first))].ravel() for k, n in ((b, own), (c, other)))
                        assert ((x > 0) == (y > 0)).all()  # the rims make neighbours agree
                        ties.append(np.stack([x[x > 0], y[x > 0]]))
            known = bricks._reached(bricks.join_labels(len(border), *np.concatenate(ties, axis=1)), border)
            for b, own in zip(every, names, strict=True):
                assert (known[own] & (own > 0) == outside[tuple(map(slice, b.first, b.end))]).all()
    full = bricks.watertighten_whole(some, config)
    monkeypatch.setattr(bricks, "cell_labels", None)
    plain = bricks.watertighten_whole(some, config, told=False)
    assert [r for _, r in plain] == [r for _, r in full] and not any(p for p, _ in plain) and sum(len(p) for p, _ in full) > 100
