"""Curation of a mesh corpus into a training set: every mesh is measured and judged, the accepted ones are exported.

    reports/dataset=<d>      measures, reasons in order, verdict and split of each mesh
    meshes/dataset=<d>       the meshes in the unit cube, packed, with what undoes the fit; rejected ones too
    retention/dataset=<d>    meshes and accepted ones of the dataset

A run covers all datasets or those listed in `datasets` and replaces exactly their partitions (a run over all
replaces the tables), so it can be run again at any time with the same result. Splits go by a hash of the mesh's
id, so a mesh stays in its split whatever else is added. A listed dataset that has no meshes any more keeps its old
partitions until a run over all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import main, settings, twice, written
from meshloom.functions.rules import GeometryConfig, error_reason, geometry_reasons, merge_pipeline
from meshloom.operators import topology
from meshloom.operators.meet import meet
from meshloom.operators.packed import FACE, VERTEX, pack
from meshloom.operators.rollups import in_datasets
from meshloom.plans import mesh_queries as sql
from meshloom.sources.boxes import SQL, box_faces, box_vertices, dealt

NAME = "job1_curate_meshes"
REPORTS = "mesh_id long, num_vertices long, num_faces long, is_watertight boolean, is_winding_consistent boolean, volume double, area double, num_components long, axis_share double, reasons string, accepted boolean, split string, dataset string"
MESHES = f"mesh_id long, vertices {VERTEX}, faces {FACE}, cx double, cy double, cz double, scale double, split string, accepted boolean, dataset string"
RETENTION = "total long, n_accept long, retention double, dataset string"


@dataclass(frozen=True)
class Config:
    """The table that meshes come from, the rules of the geometry stage, and the shares of the splits in hundredths (their sum is 100)."""

    table: str = "part.parquet"
    key: str = "p_partkey"
    dataset: str = "p_brand"
    datasets: str = ""
    max_components: int = 8
    volume_area_ratio_min: float | None = None
    primitive_vertices: int = 500
    pad: float = 0.03
    splits: dict[str, int] = field(default_factory=lambda: {"train": 100})

    def __post_init__(self) -> None:
        if sum(self.splits.values()) != 100:
            raise ValueError(f"splits must add up to 100: {self.splits}")


def split_of(key: Column, shares: dict[str, int]) -> Column:
    """The split of a key: the first 32 bits of its MD5, modulo 100, in the order of the shares."""
    place, bound, out = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 100, 0, None
    for name, share in shares.items():
        bound += share
        out = F.when(place < bound, F.lit(name)) if out is None else out.when(place < bound, F.lit(name))
    return out


def reports(vertices: DataFrame, faces: DataFrame, datasets: DataFrame, config: Config) -> DataFrame:
    """REPORTS; datasets: (mesh_id, dataset)."""
    parts = topology.components(pack(vertices, faces)).select("mesh_id", "num_components", "error")
    axis = topology.primitive_score(vertices, faces).select("mesh_id", F.round("axis_aligned_area_fraction", 9).alias("axis_share"))
    out = meet(meet(meet(datasets, topology.summarize(vertices, faces), "mesh_id"), axis, "mesh_id"), parts, "mesh_id")
    out = out.withColumn("ratio", F.round(F.when(F.col("is_watertight"), F.abs("volume") / (F.col("area") + 1e-12)), 9))
    rules = GeometryConfig(max_components=config.max_components, volume_area_ratio_min=config.volume_area_ratio_min, primitive_vertices=config.primitive_vertices)
    found = geometry_reasons({"num_components": F.col("num_components"), "volume_area_ratio": F.col("ratio"), "num_vertices": F.col("num_vertices"), "axis_share": F.col("axis_share")}, rules)
    none = F.array().cast("array<string>")
    failed = F.when(F.col("error").isNotNull(), F.array(error_reason(F.lit("stage4_fail"), F.col("error").cast("string")))).otherwise(none)
    out = out.withColumn("r", F.concat(merge_pipeline(F.col("is_watertight"), F.lit(False), found, none), failed))
    return out.select(
        "mesh_id", "num_vertices", "num_faces", "is_watertight", "is_winding_consistent", F.round("volume", 6).alias("volume"), F.round("area", 6).alias("area"), F.col("num_components").cast("long").alias("num_components"),
        "axis_share", F.array_join("r", "|").alias("reasons"), (F.size("r") == 0).alias("accepted"), split_of(F.col("mesh_id"), config.splits).alias("split"), "dataset",
    )


def export(vertices: DataFrame, faces: DataFrame, judged: DataFrame, pad: float) -> DataFrame:
    """MESHES of the judged (mesh_id, split, accepted, dataset). A mesh without extent has null coordinates."""
    fit = topology.fit_unit_cube(vertices, pad)
    undo = fit.groupBy("mesh_id").agg(*[F.min(c).alias(c) for c in ("cx", "cy", "cz", "scale")])
    packed = pack(fit.select("mesh_id", "vid", "x", "y", "z"), faces)
    return meet(meet(packed, undo, "mesh_id"), judged, "mesh_id").select("mesh_id", "vertices", "faces", "cx", "cy", "cz", "scale", "split", "accepted", "dataset")


def curate(spark: SparkSession, source: str, out: str, config: Config) -> None:
    """Measure, judge and export the meshes of the table below source into `out`."""
    mode = "dynamic" if config.datasets.strip() else "static"

    def write(table: DataFrame, name: str) -> None:
        table.hint("rebalance", "dataset").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("dataset").parquet(f"{out}/{name}")

    rows = spark.read.parquet(f"{source}/{config.table}").withColumn("dataset", F.coalesce(F.nullif(F.trim(config.dataset), F.lit("")), F.lit("unknown")))
    rows = dealt(in_datasets(rows, config.datasets), config.key)
    written(spark, rows, f"{source}/{config.table}, read")
    vertices, faces = box_vertices(rows), box_faces(rows)
    write(reports(vertices, faces, rows.select(F.col(config.key).alias("mesh_id"), "dataset"), config), "reports")
    done = in_datasets(spark.read.schema(REPORTS).parquet(f"{out}/reports"), config.datasets)
    write(done.groupBy("dataset").agg(F.count("*").alias("total"), F.count_if("accepted").alias("n_accept")).withColumn("retention", F.round(F.col("n_accept") / F.col("total"), 4)), "retention")
    write(export(vertices, faces, done.select("mesh_id", "split", "accepted", "dataset"), config.pad), "meshes")
    for name, table in tables(spark, out).items():
        written(spark, table, f"{out}/{name}")


def tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """What the runs so far have written."""
    return {name: spark.read.schema(schema).parquet(f"{out}/{name}") for name, schema in (("reports", REPORTS), ("meshes", MESHES), ("retention", RETENTION))}


def read_back(spark: SparkSession, out: str) -> DataFrame:
    """The whole output as one table: every report with figures of its mesh and its dataset's sums."""
    found = tables(spark, out)
    place = lambda f, d: f(F.transform("vertices", lambda p: F.round(p[d], 6)))
    meshes = found["meshes"].select("mesh_id", F.size("vertices").alias("packed_vertices"), F.size("faces").alias("packed_faces"), F.round("scale", 6).alias("scale"), *[place(f, d).alias(f"{n}_{d}") for d in "xyz" for f, n in ((F.array_min, "low"), (F.array_max, "high"))])
    return meet(found["reports"], meshes, "mesh_id").join(found["retention"].withColumnsRenamed({"total": "dataset_total", "n_accept": "dataset_accepted"}), "dataset")


def job1_curate_meshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = settings(Config, NAME)
    return read_back(spark, twice(spark, NAME, lambda out: curate(spark, sf_dir, out, config)))


ORACLE = f"""{SQL}{sql._EDGES}{sql._CORNERS}{sql._BOX}{sql._AXIS}{sql._PARTS},
fit AS (SELECT *, greatest(ex, ey, ez) * (1 + 2 * 0.03::DOUBLE) AS scale FROM box),
placed AS (SELECT v.mesh_id, (x - cx) / scale + 0.5 AS x, (y - cy) / scale + 0.5 AS y, (z - cz) / scale + 0.5 AS z FROM vertices v JOIN fit USING (mesh_id)),
ends AS (SELECT mesh_id, {", ".join(f"round({f}({d}), 6) AS {n}_{d}" for d in "xyz" for f, n in (("min", "low"), ("max", "high")))} FROM placed GROUP BY mesh_id),
m AS (SELECT s.mesh_id, b.num_vertices, s.num_faces, is_watertight, is_winding_consistent, CASE WHEN is_watertight THEN signed_volume END AS v, s.area AS a, num_components::BIGINT AS num_components,
  round(axis_aligned_area_fraction, 9) AS axis_share, fit.scale FROM surface s JOIN manifold USING (mesh_id) JOIN box b USING (mesh_id) JOIN axis USING (mesh_id) JOIN parts USING (mesh_id) JOIN fit USING (mesh_id)),
r AS (SELECT *, round(abs(v) / (a + 1e-12), 9) AS ratio FROM m),
w AS (SELECT *, concat_ws('|', CASE WHEN NOT is_watertight THEN 'stage1_not_watertight' END, CASE WHEN num_components > 2 THEN 'stage4:too_many_components=' || num_components END,
  CASE WHEN ratio < 1.0 THEN 'stage4:thin_shell_vol_area=' || printf('%.4f', round(ratio, 4)) END) AS reasons FROM r),
o AS (SELECT w.*, p_brand AS dataset, ('0x' || substr(md5(w.mesh_id::VARCHAR), 1, 8))::BIGINT % 100 AS place FROM w JOIN part ON p_partkey = w.mesh_id),
t AS (SELECT dataset, count(*) AS dataset_total, count(*) FILTER (WHERE reasons = '') AS dataset_accepted FROM o GROUP BY dataset)
SELECT mesh_id, num_vertices, num_faces, is_watertight, is_winding_consistent, round(v, 6) AS volume, round(a, 6) AS area, num_components, axis_share, reasons, reasons = '' AS accepted,
  CASE WHEN place < 90 THEN 'train' WHEN place < 95 THEN 'validation' ELSE 'test' END AS split, dataset, num_vertices::INTEGER AS packed_vertices, num_faces::INTEGER AS packed_faces, round(scale, 6) AS scale,
  low_x, high_x, low_y, high_y, low_z, high_z, dataset_total, dataset_accepted, round(dataset_accepted / dataset_total, 4) AS retention
FROM o JOIN ends USING (mesh_id) JOIN t USING (dataset)"""

QUERIES, ORACLE_SQL = {NAME: job1_curate_meshes}, {NAME: ORACLE}

if __name__ == "__main__":
    main(NAME, Config, curate, "Measure, judge and export a mesh corpus by dataset.")
