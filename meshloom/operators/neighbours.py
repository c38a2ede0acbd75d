"""Nearest neighbours and the symmetric chamfer distance of point sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut


def squared_distance(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda s, d: s + d, [(x - y) * (x - y) for x, y in zip(a, b, strict=True)])


def nearest(queries: DataFrame, targets: DataFrame, dims: list[str], by: list[str] | None = None, cell: float | None = None) -> DataFrame:
    """(by..., qid, tid, d): the nearest target (least tid on ties) of every query point of the same group.

    Points (by..., qid | tid, dims...) are hashed to cells of width `cell`; a query looks at the cells
    around its own and is settled if its best distance is at most a cell, since nothing nearer can lie
    further out. The rest search with doubled cells. So no query meets all targets unless all are near.
    """
    by = by or []
    left, out = queries, None
    width = cell or _cell_width(targets, dims, by)
    for step in range(64):
        w = width * 2**step
        box = [F.floor(F.col(d) / w).cast("long") for d in dims]
        t = targets.select(*by, "tid", *[F.col(d).alias(f"t_{d}") for d in dims], *[b.alias(f"c_{d}") for b, d in zip(box, dims, strict=True)])
        q = left.select(*by, "qid", *dims, *[b.alias(f"c_{d}") for b, d in zip(box, dims, strict=True)])
        for d in dims:
            q = q.withColumn(f"c_{d}", F.explode(F.array(*[F.col(f"c_{d}") + k for k in (-1, 0, 1)])))
        met = q.join(t, [*by, *[f"c_{d}" for d in dims]]).withColumn("d2", squared_distance([F.col(d) for d in dims], [F.col(f"t_{d}") for d in dims]))
        best = met.groupBy(*by, "qid").agg(F.min(F.struct("d2", "tid")).alias("b")).where(F.col("b.d2") <= w * w).select(*by, "qid", F.col("b.tid").alias("tid"), F.sqrt("b.d2").alias("d"))
        best = cut(best)
        out = best if out is None else out.unionAll(best)
        left = left.join(best.select(*by, "qid"), [*by, "qid"], "left_anti")
        rest = left.join(targets.select(*by).distinct(), by, "left_semi") if by else left
        if rest.isEmpty() or targets.isEmpty():
            break
    return out


def _cell_width(targets: DataFrame, dims: list[str], by: list[str]) -> float:
    """Cells that hold about two points of an even spread."""
    row = targets.groupBy(*by).agg(F.count("*").alias("n"), *[(F.max(d) - F.min(d)).alias(f"e_{d}") for d in dims]).orderBy(F.desc("n")).first()
    if row is None:
        return 1.0
    extents = [row[f"e_{d}"] for d in dims if row[f"e_{d}"]]
    return float(np.prod(extents) * 2 / max(row.n, 1)) ** (1 / len(extents)) if extents else 1.0


#: Targets of a cell of nearest_vectors on average, and cells at most; a pivot of each is broadcast.
CELL_ROWS, MOST_CELLS = 512, 4096
#: Entries of an array that a task holds at once, whatever the rows of a batch and the number of cells.
HELD = 1 << 18


def _steps(n: int, width: int, held: int) -> Iterator[tuple[int, int]]:
    """0 .. n in ranges of rows of `width` entries that hold about `held`."""
    step = max(1, held // max(width, 1))
    return ((at, min(at + step, n)) for at in range(0, n, step))


def nearest_vectors(queries: DataFrame, targets: DataFrame, rows: int = CELL_ROWS, most: int = MOST_CELLS, held: int = HELD) -> DataFrame:
    """(qid, tid, d): the nearest target vector (least tid on ties) of every query vector; columns qid | tid and v.

    Some targets, chosen by hash, are pivots; each target lies in the cell of the pivot nearest to it. A
    query first meets its own pivot's cell, and then those cells that may hold something as near: by the
    triangle inequality, a cell's targets are no nearer than its pivot less the cell's radius. Cells meet
    queries by an equi-join, in blocks; no target is passed over that could be nearest. Spread evenly in many
    dimensions most cells may hold one, and the work is the product of the two sides.
    """
    spark = queries.sparkSession
    n = targets.count()
    pivots = targets.orderBy(F.xxhash64("tid"), "tid").limit(max(1, min(most, n // rows))).collect()  # `most` at most
    if not pivots:
        return spark.createDataFrame([], "qid long, tid long, d double")
    heads = np.array([r.v for r in pivots], np.float64)

    def distances(v: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((v * v).sum(1)[:, None] + (heads * heads).sum(1) - 2 * v @ heads.T, 0))

    def vectors(batch: pa.RecordBatch, at: int) -> np.ndarray:
        return batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)

    def parts(batches):
        """The batches in slices whose distances to all pivots are few."""
        for batch in batches:
            for at, end in _steps(batch.num_rows, len(heads), held):
                yield batch.slice(at, end - at)

    def assign(batches):
        for batch in parts(batches):
            d = distances(vectors(batch, 1))
            k = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(k), pa.array(d[np.arange(len(k)), k])], ["id", "v", "c", "r"])

    def placed(df: DataFrame, key: str) -> DataFrame:
        return df.select(F.col(key).cast("long").alias("id"), F.col("v").cast("array<double>").alias("v")).mapInArrow(assign, "id long, v array<double>, c long, r double")

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("g", F.pmod(F.xxhash64("id"), F.ceil(F.count("*").over(Window.partitionBy("c")) / rows))).groupBy("c", "g").agg(F.collect_list(F.struct("id", "v")).alias(name)).drop("g")

    def block(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids, from the least on, and vectors of a row's list."""
        rows = column[k].values
        ids = rows.field(0).to_numpy()
        order = np.argsort(ids, kind="stable")
        return ids[order], rows.field(1).flatten().to_numpy().reshape(len(ids), -1)[order]

    def compare(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                (q, x), (t, y) = (block(batch.column(c), n) for c in (0, 1))
                k, d2 = np.empty(len(x), np.int64), np.empty(len(x))
                for at, end in _steps(len(x), y.size, held):
                    some = ((x[at:end, None, :] - y[None]) ** 2).sum(axis=2)
                    k[at:end], d2[at:end] = some.argmin(axis=1), some.min(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(t[k]), pa.array(np.sqrt(d2))], ["qid", "tid", "d"])

    home = cut(placed(targets, "tid"))
    radius = {r.c: r.r for r in home.groupBy("c").agg(F.max("r").alias("r")).collect()}  # a row a cell
    reach = np.array([radius.get(k, -np.inf) for k in range(len(heads))])
    asked, lists = cut(placed(queries, "qid")), cut(blocks(home, "t"))
    met = lambda q: blocks(q, "q").join(lists, "c").select("q", "t").mapInArrow(compare, "qid long, tid long, d double")
    first = cut(met(asked))

    def others(batches):
        for batch in parts(batches):
            v = vectors(batch, 1)
            near = distances(v) - reach <= (batch.column(3).to_numpy(zero_copy_only=False) * (1 + 1e-9) + 1e-6)[:, None]
            near[np.arange(batch.num_rows), batch.column(2).to_numpy(zero_copy_only=False)] = False
            i, k = np.nonzero(near)
            for at, end in _steps(len(i), v.shape[1], held):  # a query's vector goes to every such cell
                row = pa.array(i[at:end])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(k[at:end])], ["id", "v", "c"])

    least = first.groupBy("qid").agg(F.min("d").alias("d"))
    again = asked.join(least, asked.id == least.qid).select("id", "v", "c", "d").mapInArrow(others, "id long, v array<double>, c long")
    both = first.unionAll(met(cut(again)))
    return both.groupBy("qid").agg(F.min(F.struct("d", "tid")).alias("b")).select("qid", F.col("b.tid").alias("tid"), F.col("b.d").alias("d"))


def chamfer(a_to_b: DataFrame, b_to_a: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., chamfer): half the sum of the mean distances in the two directions, each with column d."""
    mean = lambda x, n: x.groupBy(*(by or [])).agg(F.avg("d").alias(n))
    both = mean(a_to_b, "_a").join(mean(b_to_a, "_b"), by) if by else mean(a_to_b, "_a").join(mean(b_to_a, "_b"), how="cross")
    return both.select(*(by or []), ((F.col("_a") + F.col("_b")) / 2).alias("chamfer"))


def sample_surface(corners_with_area: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """(mesh_id, pid, x, y, z): n points per mesh, spread evenly over the area, the same in every run.

    corners_with_area is the output of topology.with_normals. Face i holds the points whose even steps
    through the cumulative area fall into it; their place in the face comes from a hash of seed and point.
    """
    order = Window.partitionBy("mesh_id").orderBy("fid")
    total = F.sum("area").over(Window.partitionBy("mesh_id"))
    upto = F.sum("area").over(order)
    # a face begins where the one before ends, to the bit: a place worked out twice may round to either side of a step
    faces = corners_with_area.withColumn("_hi", upto / total * n).withColumn("_lo", F.coalesce(F.lag("_hi").over(order), F.lit(0.0)))
    first, last = F.ceil(F.col("_lo") - 0.5), F.ceil(F.col("_hi") - 0.5) - 1
    points = faces.where("area > 0").withColumn("pid", F.explode(F.when(last >= first, F.sequence(first.cast("long"), last.cast("long"))).otherwise(F.array().cast("array<bigint>"))))
    draw = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "mesh_id", "pid"), F.lit(1 << 53)) / float(1 << 53)
    r = F.sqrt(draw(0))
    u, v = 1 - r, r * draw(1)
    return points.select("mesh_id", "pid", *[(F.col(f"a{d}") + (F.col(f"b{d}") - F.col(f"a{d}")) * (1 - u - v) + (F.col(f"c{d}") - F.col(f"a{d}")) * v).alias(d) for d in "xyz"])
