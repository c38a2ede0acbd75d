"""Command line: clean, batch, watertighten, canonicalize, filter and render, as thin mains for spark-submit.

--scorer names a factory of image scorers as module:name; clean and batch need one unless --skip-vlm is given.
Exit codes: 0 done, 1 no input or no scorer, 2 rejected (clean with --strict; filter always).
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import functions as F

from .config import PipelineConfig
from .functions.verdicts import AcceptConfig
from .operators import pose, render, voxels
from .operators.packed import FACE, VERTEX
from .operators.rollups import shuffled_sample
from .plans.pipeline import as_results, clean_meshes, geometry_metrics
from .session import local_session
from .sources import files, meshfile, sinks


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="meshloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("clean", "batch", "watertighten", "canonicalize", "filter", "render"):
        p = sub.add_parser(name)
        p.add_argument("input", help="a folder of .glb, .obj and .ply files")
        p.add_argument("output")
        p.add_argument("--pattern", action="append")
        p.add_argument("--resolution", type=int, default=64)
        p.add_argument("--canonicalize", choices=("geom", "identity", "vlm", "hybrid"), default="geom")
        p.add_argument("--skip-vlm", action="store_true")
        p.add_argument("--scorer", help="module:name of an image scorer's factory")
        p.add_argument("--prompt-lang", default="en")
        p.add_argument("--vlm-min-quality", type=int, default=2)
        p.add_argument("--vlm-cache-dir", help="folder of replies of earlier runs; new ones are added to it")
        p.add_argument("--shape-model", help="module:name of a shape model's factory, for the round trip of stage 4")
        p.add_argument("--skip-vae", action="store_true")
        p.add_argument("--skip-canonicalize", action="store_true")
        p.add_argument("--skip-stage4", action="store_true")
        p.add_argument("--strict", action="store_true")
        p.add_argument("--limit", type=int)
        p.add_argument("--shuffle", action="store_true")
        p.add_argument("--seed", type=int, default=0)
        p.add_argument("--master")
    return top


def _factory(name: str | None):
    module, _, attribute = (name or "").partition(":")
    return getattr(importlib.import_module(module), attribute) if name else None


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    scorer, shape = _factory(args.scorer), None if args.skip_vae else _factory(args.shape_model)
    method = "identity" if args.skip_canonicalize else pose.downgrade(args.canonicalize, args.skip_vlm)
    if scorer is None and (args.command in ("clean", "batch") and not args.skip_vlm or args.command == "canonicalize" and method in ("vlm", "hybrid")):
        print("--scorer or --skip-vlm is needed", file=sys.stderr)
        return 1
    spark = local_session()
    listed = files.list_meshes(spark, args.input, tuple(args.pattern or files.PATTERNS))
    if args.shuffle:
        listed = shuffled_sample(listed, "path", args.seed)
    if args.limit:
        listed = listed.limit(args.limit)
    if not listed.take(1):
        print("no input files", file=sys.stderr)
        return 1
    content = files.list_meshes(spark, args.input, tuple(args.pattern or files.PATTERNS), content=True).join(listed.select("path"), "path", "left_semi")
    decoded = meshfile.decode_files(content)
    good = decoded.where("error is null").select("mesh_id", "vertices", "faces")
    size = voxels.WatertightConfig(res=args.resolution)
    if args.command == "watertighten":
        out = voxels.watertighten(good, size)
        out.drop("vertices", "faces").write.mode("overwrite").json(f"{args.output}/reports")
        meshfile.encode_meshes(out.where("error is null").select("mesh_id", F.col("vertices").cast(VERTEX).alias("vertices"), F.col("faces").cast(FACE).alias("faces"))).write.mode("overwrite").parquet(f"{args.output}/meshes")
        return 0
    if args.command == "canonicalize":
        poses = pose.find_poses(good, method, scorer)
        poses.write.mode("overwrite").json(f"{args.output}/reports")
        meshfile.encode_meshes(pose.apply_pose(good, poses)).write.mode("overwrite").parquet(f"{args.output}/meshes")
        return 0
    if args.command == "render":
        sinks.with_base64(render.render_grids(good, args.resolution)).write.mode("overwrite").parquet(f"{args.output}/renders")
        return 0
    if args.command == "filter":
        report = geometry_metrics(good, PipelineConfig(skip_autoencoder=shape is None), shape)
        report.write.mode("overwrite").json(f"{args.output}/reports")
        return 0 if report.where("NOT is_valid").isEmpty() else 2
    config = PipelineConfig(
        watertight=size, pose_method=method, skip_model=args.skip_vlm, prompt_lang=args.prompt_lang, accept=AcceptConfig(min_quality=args.vlm_min_quality), skip_autoencoder=shape is None, skip_geometry=args.skip_stage4,
    )
    cache = files.read_or_empty(spark, args.vlm_cache_dir, "cache_key string, raw_response string") if args.vlm_cache_dir else None
    clean = clean_meshes(good, config, scorer, shape, cache)
    clean.write.mode("overwrite").parquet(f"{args.output}/results")
    if cache is not None and not args.skip_vlm:
        asked = spark.read.parquet(f"{args.output}/results").where("raw_response IS NOT NULL").select("cache_key", "raw_response").dropDuplicates(["cache_key"])
        asked.join(cache.select("cache_key"), "cache_key", "left_anti").write.mode("append").parquet(args.vlm_cache_dir)
    done = spark.read.parquet(f"{args.output}/results")
    done.drop("vertices", "faces").write.mode("overwrite").json(f"{args.output}/reports")
    meshfile.encode_meshes(done.where("vertices is not null").select("mesh_id", "vertices", "faces")).write.mode("overwrite").parquet(f"{args.output}/meshes")
    if args.command == "batch":
        sinks.write_batch_summary(as_results(done), f"{args.output}/summary")
    rejected = not done.where("NOT accepted").isEmpty() or not decoded.where("error is not null").isEmpty()
    return 2 if args.strict and rejected else 0


if __name__ == "__main__":
    sys.exit(main())
