"""A corpus of box meshes derived from the part table: eight corners and twelve triangles each, with known defects.

Every fifth mesh has two more disjoint copies of its box, every seventh lacks its first triangle
(a hole) and every eleventh has one triangle turned round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIANGLES = ((0, 1, 3), (0, 3, 2), (4, 6, 7), (4, 7, 5), (0, 4, 5), (0, 5, 1), (2, 3, 7), (2, 7, 6), (0, 2, 6), (0, 6, 4), (1, 5, 7), (1, 7, 3))


#: Rows of the table to a task: each becomes up to three boxes of eight vertices and twelve faces.
DEALT_ROWS = 2000


def dealt(part: DataFrame, key: str = "p_partkey") -> DataFrame:
    """part in as many partitions by key as its rows ask for; a file of a few megabytes would be one task, whatever its rows turn into.

    The tables made of it, and all that is grouped or joined by mesh afterwards, stay where they are.
    """
    return part.repartition(max(1, -(-part.count() // DEALT_ROWS)), key)


def _extents(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        key.alias("mesh_id"), F.col("p_size").cast("double").alias("sx"), (F.col("p_retailprice") / 100).alias("sy"), (key % 9 + 1).cast("double").alias("sz"),
        F.explode(F.when(key % 5 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def box_vertices(part: DataFrame) -> DataFrame:
    """vertices(mesh_id, vid, x, y, z)."""
    corner = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("v")
    rows = _extents(part).select("*", corner)
    return rows.select(
        "mesh_id", (F.col("copy") * 8 + F.col("v")).cast("long").alias("vid"),
        F.expr("(v DIV 4 - 0.5D) * sx + copy * 3 * sx").alias("x"), F.expr("(v DIV 2 % 2 - 0.5D) * sy").alias("y"), F.expr("(v % 2 - 0.5D) * sz").alias("z"),
    )


def box_faces(part: DataFrame) -> DataFrame:
    """faces(mesh_id, fid, a, b, c)."""
    rows = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip("fabc", (f, *t), strict=True)]) for f, t in enumerate(TRIANGLES)])
    out = _extents(part).select("mesh_id", "copy", F.explode(rows).alias("t")).where("NOT (mesh_id % 7 = 0 AND t.f = 0)")
    turned = F.expr("mesh_id % 11 = 0 AND t.f = 3")
    shifted = lambda c: (F.col("copy") * 8 + c).cast("long")
    return out.select(
        "mesh_id", (F.col("copy") * 12 + F.col("t.f")).cast("long").alias("fid"), shifted(F.when(turned, F.col("t.b")).otherwise(F.col("t.a"))).alias("a"),
        shifted(F.when(turned, F.col("t.a")).otherwise(F.col("t.b"))).alias("b"), shifted(F.col("t.c")).alias("c"),
    )


#: The same tables as DuckDB common table expressions.
SQL = f"""WITH RECURSIVE ext AS (SELECT p_partkey AS mesh_id, p_size::DOUBLE AS sx, p_retailprice / 100 AS sy, (p_partkey % 9 + 1)::DOUBLE AS sz FROM part),
copies AS (SELECT ext.*, k FROM ext, range(3) r(k) WHERE k = 0 OR mesh_id % 5 = 0),
vertices AS (SELECT mesh_id, (k * 8 + v)::BIGINT AS vid, (v // 4 - 0.5::DOUBLE) * sx + k * 3 * sx AS x, (v // 2 % 2 - 0.5::DOUBLE) * sy AS y, (v % 2 - 0.5::DOUBLE) * sz AS z FROM copies, range(8) r(v)),
tri(f, a, b, c) AS (VALUES {', '.join(str((f, *t)) for f, t in enumerate(TRIANGLES))}),
faces AS (SELECT mesh_id, (k * 12 + f)::BIGINT AS fid, (k * 8 + CASE WHEN mesh_id % 11 = 0 AND f = 3 THEN b ELSE a END)::BIGINT AS a,
  (k * 8 + CASE WHEN mesh_id % 11 = 0 AND f = 3 THEN a ELSE b END)::BIGINT AS b, (k * 8 + c)::BIGINT AS c FROM copies, tri WHERE NOT (mesh_id % 7 = 0 AND f = 0))"""
