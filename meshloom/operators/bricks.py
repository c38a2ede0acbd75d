"""Stage 1 on grids too large for one task: a mesh's volume in bricks, each a row of its own.

A brick is a cube of `side` cells. Its kernel sees the triangles within reach of it and works on the brick and a rim
around it, wide enough that closing needs nothing from its neighbours. The flood has two levels: empty cells
get component labels inside each brick and its rim; where a rim lies in a neighbour, the labels of either
side in the same cells are tied, and a mesh's ties and labels, not its cells, tell which labels the border
reaches. The surface is cut brick by brick; a vertex is named by the cells of its edge in the whole
grid, so equal vertices of two bricks have one name, and the largest component is found in two levels too.

Spark deals the bricks of all meshes over tasks, so one mesh of 1,024 cells a side uses the whole cluster, and a
task holds one brick. Only a mesh's label ties meet in one task: a few for each brick of its surface. Small grids
whose bricks share a task need no labels: the bricks' closed cells are put together and flooded at once.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import topology, voxels
from .cut import cut
from .meet import meet
from .packed import Mesh, larger, meshes, pack

#: Cells of the rim that labels cover beside the brick, and of the band in which distances to triangles are known.
RIM, BAND = 2, 3
_OFFSETS = tuple(o for o in product((-1, 0, 1), repeat=3) if any(o))


@dataclass(frozen=True)
class BrickConfig:
    res: int = 512
    side: int = 64
    close_iters: int = 2
    thicken_voxels: int = 0
    auto_thicken: bool = True
    open_share: float = 0.005
    escape_samples: int = 256
    escape_share: float = 0.4
    pad: float = 0.03
    #: The bricks of a mesh of at most so many vertices and faces share a task; 0 deals the bricks of every mesh.
    together: int = 0

    @property
    def across(self) -> int:
        """Bricks along a side of the grid."""
        return -(-self.res // self.side)

    def reach(self, thick: int) -> int:
        """Cells around a brick whose shell its labels depend on."""
        return RIM + 2 * self.close_iters + thick


# One brick --------------------------------------------------------------------------------------


def cell_labels(free: np.ndarray) -> tuple[np.ndarray, int]:
    """26-connected components of the set cells, numbered from 1 (0: not set), and how many there are."""
    run = np.zeros(free.shape, np.int32)
    start = free.copy()
    start[..., 1:] &= ~free[..., :-1]
    run.ravel()[:] = np.cumsum(start.ravel(), dtype=np.int32)
    run[~free] = 0
    n = int(start.sum())
    ties = []
    for o in ((0, 1, -1), (0, 1, 0), (0, 1, 1), *((1, a, b) for a in (-1, 0, 1) for b in (-1, 0, 1))):
        here = tuple(slice(max(-k, 0), s - max(k, 0)) for k, s in zip(o, free.shape, strict=True))
        there = tuple(slice(max(k, 0), s - max(-k, 0)) for k, s in zip(o, free.shape, strict=True))
        a, b = run[here].ravel(), run[there].ravel()
        both = (a > 0) & (b > 0)
        both[1:] &= (a[1:] != a[:-1]) | (b[1:] != b[:-1])  # once a pair of runs
        ties.append(np.stack([a[both], b[both]]))
    label = join_labels(n + 1, *np.concatenate(ties, axis=1)) if n else np.zeros(1, np.int64)
    names, number = np.unique(label[1:], return_inverse=True)
    return np.concatenate([[0], number + 1]).astype(np.int32)[run], len(names)


def join_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number of each component of 0 .. n-1 under the ties a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        label = new
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    return label


def _pack(x: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(x, np.int32).tobytes(), 1)


def _unpack(data: bytes | None, shape) -> np.ndarray:
    """A packed array; without data all cells have label 1."""
    return np.ones(shape, np.int32) if data is None else np.frombuffer(zlib.decompress(data), np.int32).reshape(shape)


class Brick:
    """Closed shell, labels and distances of a brick and its rim, clipped to the grid."""

    def __init__(self, at: tuple[int, int, int], tri: np.ndarray | None, config: BrickConfig, thick: int, whole: np.ndarray | None = None) -> None:
        """tri: the triangles within reach. whole: the distances of all of the grid instead; then finish() is still to come."""
        side, res, reach = config.side, config.res, config.reach(thick)
        self.low, self.high = np.array(at) * side, np.minimum((np.array(at) + 1) * side, res)  # the brick itself
        first, end = np.maximum(self.low - reach, 0), np.minimum(self.high + reach, res)
        self.near = voxels.box_distances(tri, res, first, end, BAND) if whole is None else whole[tuple(map(slice, first, end))]
        self.first, self.end = np.maximum(self.low - RIM, 0), np.minimum(self.high + RIM, res)
        self.rim = tuple(slice(a, b) for a, b in zip(self.first - first, self.end - first, strict=True))
        self.own = tuple(slice(a, b) for a, b in zip(self.low - self.first, self.high - self.first, strict=True))
        if whole is None:
            Brick.finish([self], config, thick)

    @staticmethod
    def finish(some: list[Brick], config: BrickConfig, thick: int, labelled: bool = True) -> None:
        """Shell, closing and, if they are asked for, labels of bricks of one shape at once."""
        by = defaultdict(list)
        for b in some:
            by[b.near.shape, tuple(b.end - b.first)].append(b)
        for (_, (x, y, z)), alike in by.items():
            near = np.stack([b.near for b in alike])
            shell = near < np.float32(1 / config.res)
            closed = voxels.close_grid(shell, config.close_iters)
            solid = voxels.dilate_grid(closed, thick) if thick else closed
            for k, b in enumerate(alike):
                b.near, b.shell, b.solid = near[k][b.rim], shell[k][b.rim], solid[k][b.rim]
            if not labelled:
                continue
            tower = np.zeros((len(alike), x + 1, y, z), bool)  # a full layer keeps bricks apart
            for k, b in enumerate(alike):
                tower[k, :x] = ~b.solid
            labels = cell_labels(tower.reshape(-1, y, z))[0].reshape(tower.shape)[:, :x]
            top = np.maximum.accumulate(labels.reshape(len(alike), -1).max(1))
            for b, own, start, end in zip(alike, labels, np.append(0, top[:-1]), top, strict=True):  # they are numbered brick by brick
                b.labels, b.count = np.where(own > 0, own - start, 0).astype(np.int32), int(end - start)

    def border_labels(self, labels: np.ndarray, res: int) -> np.ndarray:
        """Labels that reach the border of the grid."""
        found = [np.zeros(0, np.int32)]
        for axis in range(3):
            rows = np.moveaxis(labels, axis, 0)
            found += [np.unique(rows[k]) for k, ends in ((0, self.first[axis] == 0), (-1, self.end[axis] == res)) if ends]
        out = np.unique(np.concatenate(found))
        return out[out > 0]


def _triangles(rows: pa.Array) -> np.ndarray:
    """(F, 3, 3) of a list of structs of nine coordinates."""
    return np.stack([rows.field(k).to_numpy(zero_copy_only=False) for k in range(9)], axis=1).reshape(-1, 3, 3) if len(rows) else np.zeros((0, 3, 3))


def _each(batch: pa.RecordBatch):
    """(row, brick, triangles) of a batch with columns mesh_id, gx, gy, gz, tri."""
    lists = batch.column(4)
    for k in range(batch.num_rows):
        tri = lists[k].values if lists[k].is_valid else None
        yield k, tuple(batch.column(c)[k].as_py() for c in (1, 2, 3)), np.zeros((0, 3, 3)) if tri is None else _triangles(tri)


def _rows(schema: pa.Schema, rows: list[tuple], take: list[int], batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows whose first column is mesh_id, taken from the batch."""
    columns = list(zip(*rows, strict=True)) or [()] * (len(schema) - 1)
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int64())), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)


def _dealt(bricks: DataFrame) -> DataFrame:
    """A brick's cost lies in its cells and not in its bytes, so bricks go over more partitions than their size asks for."""
    spark = bricks.sparkSession
    return bricks.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "mesh_id", "gx", "gy", "gz")


def _arrow(df: DataFrame, schema: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    full = f"mesh_id {df.schema['mesh_id'].dataType.simpleString()}, {schema}"
    return full, to_arrow_schema(df.sparkSession.createDataFrame([], full).schema)


# The plan ---------------------------------------------------------------------------------------


def brick_table(vertices: DataFrame, faces: DataFrame, config: BrickConfig) -> DataFrame:
    """(mesh_id, gx, gy, gz, tri): every brick of each mesh's grid with the triangles within reach; tri is null without any. Vertices are in the unit cube."""
    at = topology.corners(vertices, faces)
    reach = config.reach(max(config.thicken_voxels, 1)) + BAND + 1
    last = config.across - 1
    names = [f"{c}{d}" for c in "abc" for d in "xyz"]
    near = at.where(" AND ".join(f"least(a{d}, b{d}, c{d}) * {config.res} < {config.res} + {reach} AND greatest(a{d}, b{d}, c{d}) * {config.res} > -{reach}" for d in "xyz"))
    near = near.select("mesh_id", F.explode(F.sequence(*_ends(config, "x", reach))).alias("gx"), *names).select("*", F.explode(F.sequence(*_ends(config, "y", reach))).alias("gy")).select("*", F.explode(F.sequence(*_ends(config, "z", reach))).alias("gz"))
    lists = near.groupBy("mesh_id", "gx", "gy", "gz").agg(F.collect_list(F.struct(*names)).alias("tri"))
    every = vertices.select("mesh_id").distinct()
    for b in ("gx", "gy", "gz"):
        every = every.select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias(b))
    return meet(every, lists, ["mesh_id", "gx", "gy", "gz"], "left")


def _ends(config: BrickConfig, d: str, reach: int) -> tuple[Column, Column]:
    place = lambda f, away: F.floor((f(*[F.col(f"{c}{d}") for c in "abc"]) * config.res + away) / config.side).cast("int")
    return F.greatest(place(F.least, -reach), F.lit(0)), F.least(place(F.greatest, reach), F.lit(config.across - 1))


_LABELS = "gx int, gy int, gz int, count int, own binary, rims array<struct<gx:int,gy:int,gz:int,labels:binary>>, border array<int>, cells array<long>, shell long, solid long"


def _label(bricks: DataFrame, config: BrickConfig, thick: int) -> DataFrame:
    """The labels of each brick: how many, its own cells' and those of its rim by the neighbour they lie in (null: all are 1), the ones at the grid's border, cells of each in the brick, and counts of shell and solid cells."""
    schema, target = _arrow(bricks, _LABELS)

    def run(batches):
        for batch in batches:
            rows, take = [], []
            for k, at, tri in _each(batch):
                take.append(k)
                side, last = config.side, config.across - 1
                inside = [o for o in _OFFSETS if all(0 <= a + b <= last for a, b in zip(at, o, strict=True))]
                if not len(tri):  # all empty: ties to later neighbours are enough, an earlier one makes its own
                    size = int(np.prod([min((a + 1) * side, config.res) - a * side for a in at]))
                    border = [1] if any(a in (0, last) for a in at) else []
                    rims = [{"gx": at[0] + o[0], "gy": at[1] + o[1], "gz": at[2] + o[2], "labels": None} for o in inside if o > (0, 0, 0)]
                    rows.append((*at, 1, None, rims, border, [size], 0, 0))
                    continue
                b = Brick(at, tri, config, thick)
                rims = []
                for o in inside:
                    low = np.maximum((np.array(at) + o) * side, b.first) - b.first
                    high = np.minimum((np.array(at) + o + 1) * side, b.end) - b.first
                    rims.append({"gx": at[0] + o[0], "gy": at[1] + o[1], "gz": at[2] + o[2], "labels": _pack(b.labels[tuple(slice(x, y) for x, y in zip(low, high, strict=True))])})
                cells = np.bincount(b.labels[b.own].ravel(), minlength=b.count + 1)[1:]
                rows.append((*at, b.count, _pack(b.labels[b.own]), rims, b.border_labels(b.labels, config.res).tolist(), cells.tolist(), int(b.shell[b.own].sum()), int(b.solid[b.own].sum())))
            yield _rows(target, rows, take, batch)

    return _dealt(bricks).mapInArrow(run, schema)


def _key(config: BrickConfig, *at: Column) -> Column:
    x, y, z = (a.cast("long") for a in at)
    return (x * config.across + y) * config.across + z


def _ties(labels: DataFrame, config: BrickConfig) -> DataFrame:
    """(mesh_id, a, b): labels of two bricks, as (number of the brick << 32) + label, that share a cell."""
    rims = labels.select("mesh_id", F.struct("gx", "gy", "gz").alias("of"), F.explode("rims").alias("r")).select("mesh_id", "of", "r.gx", "r.gy", "r.gz", F.col("r.labels").alias("theirs"))
    pairs = meet(rims, labels.select("mesh_id", "gx", "gy", "gz", "own"), ["mesh_id", "gx", "gy", "gz"]).select("mesh_id", "of", F.struct("gx", "gy", "gz").alias("to"), "theirs", "own")
    schema, target = _arrow(labels, "a long, b long")
    n = config.across

    def run(batches):
        for batch in batches:
            rows, take = [], []
            for k in range(batch.num_rows):
                of, to = (np.array(list(batch.column(c)[k].as_py().values())) for c in (1, 2))
                low, high = to * config.side, np.minimum((to + 1) * config.side, config.res)
                first, end = np.maximum(of * config.side - RIM, 0), np.minimum(np.minimum((of + 1) * config.side, config.res) + RIM, config.res)
                a, e = np.maximum(low, first), np.minimum(high, end)
                theirs = _unpack(batch.column(3)[k].as_py(), e - a).ravel()
                own = _unpack(batch.column(4)[k].as_py(), high - low)[tuple(slice(x, y) for x, y in zip(a - low, e - low, strict=True))].ravel()
                both = (theirs > 0) & (own > 0)
                x, y = ((int(b[0]) * n + int(b[1])) * n + int(b[2]) << 32 for b in (of, to))
                found = np.unique(theirs[both].astype(np.int64) << 32 | own[both])
                rows += [(x + int(f >> 32), y + int(f & 0xFFFFFFFF)) for f in found]
                take += [k] * len(found)
            yield _rows(target, rows, take, batch)

    return pairs.mapInArrow(run, schema)


def _by_mesh(ties: DataFrame, nodes: DataFrame, config: BrickConfig, choose) -> DataFrame:
    """(mesh_id, brick, labels): the labels of each brick that choose(names, component of each, weights) keeps. nodes: (mesh_id, a, w), all labels with a weight. One row of ties and labels a mesh."""
    pairs = ties.groupBy("mesh_id").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    names = nodes.groupBy("mesh_id").agg(F.sort_array(F.collect_list(F.struct("a", "w"))).alias("n"))
    rows = meet(names, pairs, "mesh_id", "left").select("mesh_id", F.col("n.a").alias("name"), F.col("n.w").alias("w"), "a", "b")
    schema, target = _arrow(ties, "brick long, labels array<int>")

    def run(batches):
        for batch in batches:
            out, take = [], []
            for k in range(batch.num_rows):
                name, w = (np.array(batch.column(c)[k].as_py(), np.int64) for c in (1, 2))
                a, b = (np.searchsorted(name, np.array(batch.column(c)[k].as_py() or [], np.int64)) for c in (3, 4))
                kept = name[choose(join_labels(len(name), a, b), w)]
                brick, first = np.unique(kept >> 32, return_index=True)
                for x, labels in zip(brick.tolist(), np.split(kept & 0xFFFFFFFF, first[1:]) if len(kept) else [], strict=True):
                    out.append((x, labels.tolist()))
                    take.append(k)
            yield _rows(target, out, take, batch)

    return rows.mapInArrow(run, schema)


def _reached(component: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Labels in a component with one at the border."""
    return np.isin(component, component[border > 0])


def _largest(component: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Labels of the component of most faces, the first of equals."""
    sums = np.bincount(component, size, len(component))
    return component == int(np.argmax(sums))


def flood(bricks: DataFrame, config: BrickConfig, thick: int = 0) -> tuple[DataFrame, DataFrame]:
    """(labels, outside): the table of _label, written, and (mesh_id, brick, labels) of the labels that 26-connected empty cells join to the grid's border."""
    labels = cut(_label(bricks, config, thick))
    at = _key(config, F.col("gx"), F.col("gy"), F.col("gz"))
    number = F.sequence(F.lit(1), F.col("count"))
    nodes = labels.where("count > 0").select("mesh_id", F.explode(F.transform(number, lambda i: F.struct((F.shiftleft(at, 32) + i).alias("a"), F.array_contains("border", i).cast("long").alias("w")))).alias("x")).select("mesh_id", "x.*")
    return labels, cut(_by_mesh(_ties(labels, config), nodes, config, _reached))


def interior(labels: DataFrame, outside: DataFrame, config: BrickConfig) -> DataFrame:
    """(mesh_id, shell_voxels, solid_voxels, n_inside, interior_frac)."""
    rows = meet(labels.withColumn("brick", _key(config, F.col("gx"), F.col("gy"), F.col("gz"))), outside, ["mesh_id", "brick"], "left")
    every = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + c)
    gone = F.aggregate(F.coalesce("labels", F.array().cast("array<int>")), F.lit(0).cast("long"), lambda s, i: s + F.get("cells", i - 1))
    sums = rows.groupBy("mesh_id").agg(F.sum("shell").alias("shell_voxels"), F.sum("solid").alias("solid_voxels"), F.sum(every - gone).alias("n_inside"))
    return sums.withColumn("interior_frac", F.col("n_inside") / float(config.res) ** 3)


_SURFACE = "gx int, gy int, gz int, names array<long>, x array<double>, y array<double>, z array<double>, faces array<int>, part array<int>, border array<struct<name:long,part:int>>, sizes array<long>, open_edges array<struct<p:long,q:long,n:int,forward:int,part:int>>"


def _surface(bricks: DataFrame, outside: DataFrame, config: BrickConfig, thick: int) -> DataFrame:
    """The surface of each brick that has any: names of vertices, their places in the unit cube, faces as places in the names, the component of each face (from 1), vertices shared with other bricks, faces of each component, and edges that this brick alone doesn't use twice, once either way."""
    rows = meet(bricks.where("tri IS NOT NULL").withColumn("brick", _key(config, F.col("gx"), F.col("gy"), F.col("gz"))), outside, ["mesh_id", "brick"], "left").select("mesh_id", "gx", "gy", "gz", "tri", "labels")
    schema, target = _arrow(bricks, _SURFACE)

    def run(batches):
        for batch in batches:
            for k, at, tri in _each(batch):
                b = Brick(at, tri, config, thick)
                known = np.zeros(b.count + 1, bool)
                known[np.array(batch.column(5)[k].as_py() or [], np.int64)] = True
                found = _brick_surfaces([b], [~known[b.labels]], config)[0]
                if found:
                    *plain, border, sizes, opened = found
                    told = lambda columns, *keys: [dict(zip(keys, x, strict=True)) for x in zip(*(c.tolist() for c in columns), strict=True)]
                    yield _rows(target, [(*at, *plain, told(border, "name", "part"), sizes.tolist(), told(opened, "p", "q", "n", "forward", "part"))], [k], batch)

    return _dealt(rows).mapInArrow(run, schema)


def _brick_surfaces(some: list[Brick], occupied: list[np.ndarray], config: BrickConfig) -> list[tuple | None]:
    """Of each brick names, x, y, z, faces, part, border (names, parts), sizes and open edges (p, q, n, forward, part) as arrays, or None without a surface."""
    res = config.res
    low, high = np.array([np.where(b.low == 0, -1, b.low) for b in some]), np.array([b.high + 1 for b in some])  # a layer of empty cells lies around the grid
    sizes, by = high - low, defaultdict(list)
    stack = np.full((len(some), *sizes.max(0)), np.float32(1 / res))
    for k, b in enumerate(some):
        by[b.near.shape].append(k)
    for alike in by.values():
        for k, x in zip(alike, voxels.side_values(np.stack([some[k].near for k in alike]), np.stack([occupied[k] for k in alike]), res), strict=True):
            first, end = np.maximum(low[k], 0), np.minimum(high[k], res)
            stack[k][tuple(map(slice, first - low[k], end - low[k]))] = x[tuple(map(slice, first - some[k].first, end - some[k].first))]
    p, q, places, faces = voxels.cut_edges(stack, sizes)
    if not len(faces):
        return [None] * len(some)
    at, (_, long, wide, deep) = p // stack[0].size, stack.shape  # the brick of each vertex
    faces = faces[np.argsort(at[faces[:, 0]], kind="stable")]
    of_face = at[faces[:, 0]]
    cells = [np.stack([x // (wide * deep) % long, x // deep % wide, x % deep], 1) for x in (p, q)]
    step = ((cells[1] - cells[0] + 1) * [9, 3, 1]).sum(1)
    c = cells[0] + low[at] + 1  # in a grid that starts at the layer around
    names = ((c[:, 0] * (res + 2) + c[:, 1]) * (res + 2) + c[:, 2]) * 27 + step  # within a brick they rise with the vertices' numbers
    xyz = (places + low[at] + 0.5) / res
    half = order, head = topology.half_edges(faces)
    labels = voxels.face_labels(faces, half)
    kinds = np.flatnonzero(labels == np.arange(len(faces)))  # a component is named by its least face
    part = np.searchsorted(kinds, labels)
    at_rim = np.zeros(len(names), bool)
    for axis in range(3):
        for plane in (0, sizes[at, axis] - 1):
            at_rim |= (cells[0][:, axis] == plane) & (cells[1][:, axis] == plane)
    of, used = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    of[faces.ravel()] = np.repeat(part, 3)
    used[faces] = True
    border = np.flatnonzero(used & at_rim)
    n = np.diff(np.append(head, len(order)))
    ahead = np.add.reduceat((faces < np.roll(faces, -1, axis=1)).T.ravel()[order].astype(np.int64), head)
    odd = np.flatnonzero((n != 2) | (ahead != 1))
    one = np.minimum.reduceat(order, head)[odd]  # the first of the edge's half-edges
    u, w = faces.T.ravel()[one], np.roll(faces, -1, axis=1).T.ravel()[one]
    ends, owner, n, ahead = np.sort(np.stack([names[u], names[w]], 1), axis=1), part[one % len(faces)], n[odd], ahead[odd]
    of_odd, every = of_face[one % len(faces)], np.arange(len(some) + 1)
    v, f, e, o = (np.searchsorted(x, every) for x in (at, of_face, at[border], of_odd))
    first = np.searchsorted(kinds, f)
    found = np.bincount(part, minlength=len(kinds))
    out = []
    for k in range(len(some)):
        vs, fs, rim, opened, start = slice(v[k], v[k + 1]), slice(f[k], f[k + 1]), border[e[k] : e[k + 1]], slice(o[k], o[k + 1]), first[k]
        edges = [ends[opened, 0], ends[opened, 1], n[opened], ahead[opened], owner[opened] - start + 1]
        out.append((names[vs], *[xyz[vs, d] for d in range(3)], (faces[fs] - v[k]).ravel().astype(np.int32), (part[fs] - start + 1).astype(np.int32), (names[rim], of[rim] - start + 1), found[start : first[k + 1]], edges) if f[k] < f[k + 1] else None)
    return out


def surfaces(bricks: DataFrame, outside: DataFrame, config: BrickConfig, thick: int = 0) -> tuple[DataFrame, DataFrame]:
    """(pieces, flags): the part of each brick's surface that belongs to its mesh's largest component (mesh_id, gx, gy, gz, names, x, y, z, faces as triples of places), and (mesh_id, num_faces_out, is_watertight, is_winding_consistent)."""
    made = cut(_surface(bricks, outside, config, thick).withColumn("brick", _key(config, F.col("gx"), F.col("gy"), F.col("gz"))))
    label = lambda part: F.shiftleft("brick", 32) + part
    nodes = made.select("mesh_id", F.explode(F.transform("sizes", lambda n, i: F.struct((label(i) + 1).alias("a"), n.alias("w")))).alias("x")).select("mesh_id", "x.*")
    at = made.select("mesh_id", "brick", F.explode("border").alias("v")).select("mesh_id", F.col("v.name").alias("name"), label(F.col("v.part")).alias("a"))
    met = at.groupBy("mesh_id", "name").agg(F.min("a").alias("a"), F.collect_set("a").alias("all")).where("size(all) > 1")  # at most the eight bricks around a point
    ties = met.select("mesh_id", "a", F.explode("all").alias("b")).where("a <> b").distinct()
    kept = cut(_by_mesh(ties, nodes, config, _largest)).withColumnRenamed("labels", "parts")
    pieces = _kept_parts(meet(made, kept, ["mesh_id", "brick"]))
    edges = meet(made, kept, ["mesh_id", "brick"]).select("mesh_id", F.explode(F.filter("open_edges", lambda e: F.array_contains("parts", e["part"]))).alias("e"))
    edges = edges.groupBy("mesh_id", "e.p", "e.q").agg(F.sum("e.n").alias("n"), F.sum("e.forward").alias("forward"))
    bad = edges.groupBy("mesh_id").agg(F.every(F.col("n") == 2).alias("tight"), F.every((F.col("n") != 2) | (F.col("forward") == 1)).alias("wound"))
    flags = meet(pieces.groupBy("mesh_id").agg(F.sum(F.size("faces") / 3).cast("long").alias("num_faces_out")), bad, "mesh_id", "left")
    flags = flags.select("mesh_id", "num_faces_out", F.coalesce("tight", F.lit(True)).alias("is_watertight"), F.coalesce("wound", F.lit(True)).alias("is_winding_consistent"))
    return pieces, flags


def _kept_parts(rows: DataFrame) -> DataFrame:
    """The faces of the kept parts, and the vertices that they use."""
    schema, target = _arrow(rows, "gx int, gy int, gz int, names array<long>, x array<double>, y array<double>, z array<double>, faces array<int>")
    plain = rows.select("mesh_id", "gx", "gy", "gz", "names", "x", "y", "z", "faces", "part", "parts")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                names, x, y, z, faces, part, parts = (batch.column(c)[k].values.to_numpy() for c in range(4, 11))
                used, faces = np.unique(faces.reshape(-1, 3)[np.isin(part, parts)], return_inverse=True)
                found = (*(batch.column(c)[k].as_py() for c in (1, 2, 3)), names[used], x[used], y[used], z[used], faces.ravel().astype(np.int32))
                yield _rows(target, [found], [k], batch)

    return plain.mapInArrow(run, schema)


def _drawn(code: np.ndarray) -> np.ndarray:
    """A hash of cells, whose least ones send rays."""
    return (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)).astype(np.int64)


def _escaping(mesh: Mesh, cells: np.ndarray, res: int, most: int) -> float:
    """The share of rays from the cells that meet nothing; 1 without cells."""
    o = (np.stack([cells // (res * res), cells // res % res, cells % res], 1) + 0.5) / res
    d = np.random.default_rng(0).normal(size=(most, 3))[: len(o)]
    return float((voxels.first_hits(mesh.vertices, mesh.faces, o, d / np.linalg.norm(d, axis=1, keepdims=True))[0] < 0).mean()) if len(o) else 1.0


def _escape(bricks: DataFrame, labels: DataFrame, outside: DataFrame, packed: DataFrame, config: BrickConfig) -> DataFrame:
    """(mesh_id, ray_escape_frac): the share of rays from interior cells (shell cells without any) that meet nothing; the cells and directions are the least by a hash, so they don't depend on how bricks are dealt."""
    at = meet(labels.select("mesh_id", "gx", "gy", "gz", "cells", _key(config, F.col("gx"), F.col("gy"), F.col("gz")).alias("brick")), outside, ["mesh_id", "brick"], "left")
    rows = meet(bricks, at, ["mesh_id", "gx", "gy", "gz"]).select("mesh_id", "gx", "gy", "gz", "tri", "labels")
    schema, target = _arrow(bricks, "kind int, h long, cell long")
    res, most = config.res, config.escape_samples

    def run(batches):
        for batch in batches:
            out, take = [], []
            for k, where, tri in _each(batch):
                b = Brick(where, tri, config, 0)
                known = np.zeros(b.count + 1, bool)
                known[np.array(batch.column(5)[k].as_py() or [], np.int64)] = True
                inside = ((b.labels > 0) & ~known[b.labels])[b.own]
                for kind, cells in ((0, inside), (1, b.shell[b.own])):
                    c = np.argwhere(cells) + b.low
                    code = (c[:, 0] * res + c[:, 1]) * res + c[:, 2]
                    h = _drawn(code)
                    for i in np.argsort(h, kind="stable")[:most]:
                        out.append((kind, int(h[i]), int(code[i])))
                        take.append(k)
            yield _rows(target, out, take, batch)

    least = _dealt(rows).mapInArrow(run, schema).groupBy("mesh_id").agg(*[F.slice(F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("h", "cell")))), 1, most)["cell"].alias(n) for k, n in ((0, "inside"), (1, "shell"))])
    asked = meet(packed, least.select("mesh_id", F.when(F.size("inside") > 0, F.col("inside")).otherwise(F.col("shell")).alias("cells")), "mesh_id").select("mesh_id", "vertices", "faces", "cells")
    schema2, target2 = _arrow(packed, "ray_escape_frac double")

    def shoot(batches):
        for batch in batches:
            out = []
            for k, mesh in enumerate(meshes(batch)):
                out.append((_escaping(mesh, np.array(batch.column(3)[k].as_py() or [], np.int64), res, most),))
            yield _rows(target2, out, list(range(batch.num_rows)), batch)

    return asked.mapInArrow(shoot, schema2)


# All bricks of a mesh in one task -----------------------------------------------------------------

#: Cells of a grid whose bricks may share a task.
WHOLE = 1 << 18


def _flooded(wholes: list[np.ndarray], config: BrickConfig, thick: int) -> list[tuple[list[Brick], np.ndarray, np.ndarray]]:
    """Of each grid its bricks, the solid cells that they put together, and the empty ones joined to the grid's border. Labels of bricks, tied where they share a cell, would give the same: neighbours of a cell lie in its brick or the rim."""
    made = [[Brick(at, None, config, thick, whole) for at in product(range(config.across), repeat=3)] for whole in wholes]
    Brick.finish([b for every in made for b in every], config, thick, labelled=False)
    solid = np.zeros((len(wholes), *[config.res] * 3), bool)
    for own, every in zip(solid, made, strict=True):
        for b in every:
            own[tuple(map(slice, b.low, b.high))] = b.solid[b.own]
    return list(zip(made, solid, voxels.flood_stack(solid), strict=True))


def _joined_surface(made: list[tuple | None], config: BrickConfig, told: bool) -> tuple[list[tuple], tuple[int, bool, bool]]:
    """What surfaces() gives of one mesh, from the surfaces of its bricks: its pieces, if they are told, and flags."""
    made = [(at, found) for at, found in zip(product(range(config.across), repeat=3), made, strict=True) if found]
    if not made:
        return [], (0, False, False)
    first = np.cumsum([0, *[len(found[7]) for _, found in made]])
    name, part = (np.concatenate(x) for x in zip(*[(found[6][0], found[6][1] + (n - 1)) for (_, found), n in zip(made, first, strict=False)], strict=True))
    order = np.lexsort((part, name))
    name, part = name[order], part[order]
    same = name[1:] == name[:-1]
    kept = _largest(join_labels(first[-1], part[:-1][same], part[1:][same]), np.concatenate([found[7] for _, found in made]))
    pieces, faces, edges = [], 0, []
    for (at, (names, x, y, z, triples, own, _, _, opened)), n in zip(made, first, strict=False):
        own = kept[n + own - 1]
        if told and own.any():
            used, triples = np.unique(triples.reshape(-1, 3)[own], return_inverse=True)
            pieces.append((*at, names[used], x[used], y[used], z[used], triples.ravel().astype(np.int32)))
        faces += int(own.sum())
        edges.append(np.stack(opened[:4])[:, kept[n + opened[4] - 1]])
    p, q, n, ahead = np.concatenate(edges, axis=1)
    order = np.lexsort((q, p))
    p, q, n, ahead = p[order], q[order], n[order], ahead[order]
    head = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (q[1:] != q[:-1]))[: len(p)])
    n, ahead = (np.add.reduceat(x, head) if len(head) else x for x in (n, ahead))
    return pieces, (faces, bool((n == 2).all()), bool(((n != 2) | (ahead == 1)).all()))


def watertighten_whole(some: list[Mesh], config: BrickConfig, told: bool = True) -> list[tuple[list[tuple], tuple]]:
    """Stage 1 of meshes of the unit cube, brick by brick: the pieces, if they are told, and the report that watertighten_bricks gives of each, in the columns of _PIECES and _WHOLE."""
    res, most = config.res, config.escape_samples
    some = [Mesh(m.vertices, m.faces[((m.faces >= 0) & (m.faces < len(m.vertices))).all(1)]) for m in some]  # a face of no vertex is nowhere
    wholes = voxels.narrow_bands(some, res, BAND)
    flooded, reports = _flooded(wholes, config, 0), []
    for mesh, whole, (_, solid, outside) in zip(some, wholes, flooded, strict=True):
        inside, shell, escape = ~(solid | outside), whole < np.float32(1 / res), None
        share = float(inside.sum()) / float(res) ** 3
        if share < config.open_share:
            code = np.flatnonzero(inside if inside.any() else shell)
            escape = _escaping(mesh, code[np.lexsort((code, _drawn(code)))[:most]], res, most) if len(code) else None
        reports.append([int(shell.sum()), int(solid.sum()), share, escape is not None and escape > config.escape_share, escape])
    again = [k for k, r in enumerate(reports) if r[3] and config.auto_thicken]
    for k, thicker in zip(again, _flooded([wholes[k] for k in again], config, 1), strict=True):
        flooded[k], reports[k][1] = thicker, int(thicker[1].sum())
    made = iter(_brick_surfaces(*zip(*[(b, ~outside[tuple(map(slice, b.first, b.end))]) for every, _, outside in flooded for b in every], strict=True), config))
    joined = [_joined_surface([next(made) for _ in every], config, told) for every, *_ in flooded]
    return [(pieces, (*r, *flags)) for (pieces, flags), r in zip(joined, reports, strict=True)]


_WHOLE = "shell_voxels long, thickened_voxels long, interior_frac_closed double, open_shell_detected boolean, ray_escape_frac double, num_faces_out long, is_watertight boolean, is_winding_consistent boolean"
_PIECES = "gx int, gy int, gz int, names array<long>, x array<double>, y array<double>, z array<double>, faces array<int>"


def _together(packed: DataFrame, config: BrickConfig, pieces: bool) -> DataFrame:
    """The pieces or the reports of watertighten_whole for every packed mesh."""
    schema, target = _arrow(packed, _PIECES if pieces else _WHOLE)
    step = max(1, WHOLE // (config.across * (config.side + 2 * config.reach(1))) ** 3)  # meshes at once, by the cells of their bricks

    def run(batches):
        for batch in batches:
            rows = meshes(batch)
            for start in range(0, batch.num_rows, step):
                found = watertighten_whole(list(islice(rows, step)), config, pieces)
                given = [(x, start + k) for k, (own, report) in enumerate(found) for x in (own if pieces else [report])]
                yield _rows(target, [x for x, _ in given], [k for _, k in given], batch)

    spread = max(4 * packed.sparkSession.sparkContext.defaultParallelism, int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # the cost lies in the cells
    return packed.repartition(spread, F.xxhash64("mesh_id")).mapInArrow(run, schema)  # by mesh_id itself, the joins before it would do instead, in few tasks


def watertighten_bricks(vertices: DataFrame, faces: DataFrame, config: BrickConfig = BrickConfig()) -> tuple[DataFrame, DataFrame]:
    """(pieces, report) of stage 1 for meshes (mesh_id, vid, x, y, z) and (mesh_id, fid, a, b, c).

    pieces: as surfaces() gives them, back in the meshes' own units; a vertex on the border of bricks stands in each
    of them under one name. report: resolution, shell_voxels, thickened_voxels, interior_frac_closed, open_shell_detected,
    ray_escape_frac, num_faces_out, is_watertight, is_winding_consistent. Meshes are taken as they are: decimation comes
    before. A mesh without extent has neither; one whose occupancy is empty has a report only, with no faces.

    With config.together, grids of at most WHOLE cells of meshes that aren't larger aren't dealt: their bricks meet in
    one task, which floods the grid that they make. Pieces and report then are worked out when they are asked for, each by itself.
    """
    fit = topology.fit_unit_cube(vertices, config.pad).where("scale IS NOT NULL")
    undo = fit.groupBy("mesh_id").agg(*[F.min(c).alias(c) for c in ("cx", "cy", "cz", "scale")])
    placed = fit.select("mesh_id", "vid", "x", "y", "z")
    back = lambda pieces: meet(pieces, undo, "mesh_id").withColumns({d: F.expr(f"transform({d}, v -> (v - 0.5D) * scale + c{d})") for d in "xyz"}).select("mesh_id", "gx", "gy", "gz", "names", "x", "y", "z", "faces")
    if not config.together or config.thicken_voxels or config.res**3 > WHOLE:
        pieces, report = _dealt_bricks(placed, faces, config)
        return back(pieces), report
    large = larger(config.together, vertices, faces)
    small = lambda t: t if large is None else meet(t, large, "mesh_id", "left_anti")
    packed_ = pack(small(placed), small(faces))
    pieces, report = _together(packed_, config, True), _together(packed_, config, False).select("mesh_id", F.lit(config.res).cast("long").alias("resolution"), *[x.split()[0] for x in _WHOLE.split(", ")])
    if large is not None:
        more, reports = _dealt_bricks(*[meet(t, large, "mesh_id", "left_semi") for t in (placed, faces)], config)
        pieces, report = pieces.unionByName(more), report.unionByName(reports)
    return back(pieces), report


def _dealt_bricks(placed: DataFrame, faces: DataFrame, config: BrickConfig) -> tuple[DataFrame, DataFrame]:
    """Pieces, in the unit cube, and report, with every brick a row of its own."""
    bricks = cut(brick_table(placed, faces, config))
    labels, outside = flood(bricks, config, config.thicken_voxels)
    found = cut(interior(labels, outside, config))
    thin = found.where(F.col("interior_frac") < config.open_share).select("mesh_id")
    only = lambda t, side, how: meet(t, side, "mesh_id", how)
    packed_ = pack(only(placed, thin, "left_semi"), only(faces, thin, "left_semi"))
    escape = cut(_escape(only(bricks, thin, "left_semi"), labels, outside, packed_, config))
    is_open = F.coalesce(F.col("ray_escape_frac") > config.escape_share, F.lit(False))
    again = escape.where(is_open).select("mesh_id") if config.auto_thicken and not config.thicken_voxels else escape.limit(0).select("mesh_id")
    pieces, flags = surfaces(only(bricks, again, "left_anti"), outside, config, config.thicken_voxels)
    counts = only(found, again, "left_anti").select("mesh_id", "shell_voxels", "solid_voxels", "interior_frac")
    if again.take(1):
        labels2, outside2 = flood(only(bricks, again, "left_semi"), config, 1)
        more, more_flags = surfaces(only(bricks, again, "left_semi"), outside2, config, 1)
        pieces, flags = pieces.unionAll(more), flags.unionAll(more_flags)
        thick = interior(labels2, outside2, config).select("mesh_id", "solid_voxels")
        counts = counts.unionAll(only(found.drop("solid_voxels"), thick, "inner").select("mesh_id", "shell_voxels", "solid_voxels", "interior_frac"))
    report = meet(meet(counts, escape, "mesh_id", "left"), flags, "mesh_id", "left").select(
        "mesh_id", F.lit(config.res).cast("long").alias("resolution"), "shell_voxels", F.col("solid_voxels").alias("thickened_voxels"), F.col("interior_frac").alias("interior_frac_closed"),
        is_open.alias("open_shell_detected"), "ray_escape_frac", F.coalesce("num_faces_out", F.lit(0)).alias("num_faces_out"), F.coalesce("is_watertight", F.lit(False)).alias("is_watertight"),
        F.coalesce("is_winding_consistent", F.lit(False)).alias("is_winding_consistent"),
    )
    return pieces.select("mesh_id", "gx", "gy", "gz", "names", "x", "y", "z", "faces"), report


def assemble(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """vertices (mesh_id, name, x, y, z), each once, and faces (mesh_id, a, b, c) by name."""
    vertices = pieces.select("mesh_id", F.explode(F.arrays_zip("names", "x", "y", "z")).alias("p")).select("mesh_id", F.col("p.names").alias("name"), "p.x", "p.y", "p.z").dropDuplicates(["mesh_id", "name"])
    triple = "transform(sequence(0, size(faces) DIV 3 - 1), i -> named_struct('a', names[faces[3 * i]], 'b', names[faces[3 * i + 1]], 'c', names[faces[3 * i + 2]]))"
    faces = pieces.where("size(faces) > 0").select("mesh_id", F.explode(F.expr(triple)).alias("t")).select("mesh_id", "t.*")
    return vertices, faces
