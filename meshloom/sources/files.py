"""Listing and hashing of mesh files, manifests, path resolution, and readers of reports and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.rules import strip_extension
from ..operators.rollups import in_datasets, limit_each

PATTERNS = ("*.glb", "*.obj", "*.ply")


def list_meshes(spark: SparkSession, root: str, patterns=PATTERNS, content: bool = False) -> DataFrame:
    """(path, length, modificationTime[, content]) of the files below root that match any pattern, each once; in order of path, unless the content is read, which isn't shuffled."""
    glob = "{" + ",".join(patterns) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
    return files if content else files.drop("content").orderBy("path")


def with_hash(files: DataFrame, content: str = "content") -> DataFrame:
    """sha256 of the content as 64 hexadecimal digits."""
    return files.withColumn("sha256", F.sha2(content, 256))


def read_manifest(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """(dataset, pos, sha256, local_path): a CSV with a header; rows without sha256 are dropped. pos orders the rows of the file."""
    raw = spark.read.option("header", True).csv(path)
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in raw.columns else F.lit(None).cast("string")
    rows = raw.select(F.lit(dataset).alias("dataset"), F.monotonically_increasing_id().alias("pos"), blank("sha256").alias("sha256"), blank("local_path").alias("local_path"))
    return rows.where("sha256 is not null")


def collect_manifests(spark: SparkSession, paths: dict[str, str], wanted: str | None = None, limit: int | None = None) -> DataFrame:
    """The rows of the manifests of all datasets (name -> path of its CSV), or of those in a comma-separated list, the first `limit` of each."""
    rows = reduce(DataFrame.unionAll, [read_manifest(spark, path, name) for name, path in sorted(paths.items())])
    rows = in_datasets(rows, wanted)
    return limit_each(rows, "dataset", "pos", limit) if limit else rows


def candidate_paths(root: Column, sha256: Column, local_path: Column) -> Column:
    """Where a manifest row's file may lie, best first: its own path, then by name and by hash below the root."""
    name = F.element_at(F.split(local_path, "/"), -1)
    join = lambda *p: F.concat_ws("/", *p)
    return F.array(F.when(local_path.startswith("/"), local_path), F.when(local_path.isNotNull(), join(root, local_path)), F.when(local_path.isNotNull(), join(root, F.lit("raw"), name)), join(root, F.concat(sha256, F.lit(".glb"))))


def resolve_paths(rows: DataFrame, candidates: Column, listing: DataFrame, key: list[str]) -> DataFrame:
    """The rows of which a candidate exists in the listing (path), with `path`, the first such; key names a row."""
    tried = rows.select(*key, F.posexplode(candidates).alias("priority", "path")).where("path is not null")
    found = tried.join(listing.select("path").distinct(), "path", "left_semi").groupBy(*key).agg(F.min_by("path", "priority").alias("path"))
    return rows.join(found, key)


def output_path(root: Column, sha256: Column, suffix: str) -> Column:
    return F.concat_ws("/", root, F.concat(strip_extension(sha256), F.lit(suffix)))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet files below path, or no rows if nothing has been written there yet; any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_reports(spark: SparkSession, path: str, schema: str = schemas.RESULT, whole_files: bool = True) -> DataFrame:
    """JSON reports, one to a file or to a line; those that don't parse are dropped, missing fields are null."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    return reader.option("multiLine", whole_files).json(path)


def read_summary(spark: SparkSession, path: str, n: int | None = None, order: str = "input") -> DataFrame:
    rows = spark.read.option("header", True).csv(path).orderBy(order)
    return rows.limit(n) if n else rows


def join_report_tables(summary: DataFrame, renders: DataFrame, verdicts: DataFrame, reports: DataFrame, key: str = "sha256") -> DataFrame:
    """Summary rows with render, verdict and report where they exist, each as one struct (null if absent)."""
    for name, side in (("render", renders), ("verdict", verdicts), ("report", reports)):
        summary = summary.join(side.select(key, F.struct(*[c for c in side.columns if c != key]).alias(name)), key, "left")
    return summary
