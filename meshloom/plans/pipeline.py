"""The three entry points: packed meshes through all stages, a directory of files, and many datasets with resume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import PipelineConfig
from ..functions.rules import error_reason, geometry_reasons, merge_batch, merge_pipeline
from ..operators import fields, pose, rays, render, scorers, topology, voxels
from ..operators.cut import cut
from ..operators.meet import meet
from ..operators.packed import FACE, VERTEX
from ..operators.rollups import pending
from ..sources import files as listing
from ..sources.meshfile import decode_files, unpack


#: Stages by number, as reports name them.
STAGES = {1: "stage1_watertighten", 2: "stage2_vlm_filter", 3: "stage3_canonicalize", 4: "stage4_filter_geometry"}


def _agreement(packed: DataFrame, config: PipelineConfig, truth: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """rays.sign_agreement of each mesh at its ray samples. The default test of meshes of few triangles runs in their task; only larger ones become rows of points and triangles."""

    def joined(some: DataFrame) -> DataFrame:
        vertices, faces = unpack(some)
        at, points = topology.corners(vertices, faces), rays.box_points(vertices, rays.unit_points(some.sparkSession, config.ray_samples))
        return rays.sign_agreement(truth(points, at), rays.winding_inside(points, at))

    if truth is not rays.parity_inside or config.ray_samples < 1:
        return joined(packed)
    few, many = rays.box_agreement(packed.where(rays.has_few()), config.ray_samples), packed.where(~rays.has_few())
    return few.unionByName(joined(many)) if many.count() else few


def geometry_metrics(packed: DataFrame, config: PipelineConfig = PipelineConfig(), scorer: Callable | None = None, truth: Callable[[DataFrame, DataFrame], DataFrame] = rays.parity_inside) -> DataFrame:
    """Stage 4 of packed meshes: (mesh_id, metrics, reasons, is_valid, seconds in kernels, error). Parity and measures are relational; components and the autoencoder run in kernels.

    truth is the inside test held to be right: from points (mesh_id, pid, x, y, z) and corners to
    (mesh_id, pid, inside). The test it is compared with is the winding of rays along another axis.
    """
    vertices, faces = unpack(packed)
    summary = topology.summarize(vertices, faces)
    axis = topology.primitive_score(vertices, faces).drop("num_faces")
    parts = topology.components(packed)
    agree = _agreement(packed, config, truth)
    out = packed.select("mesh_id")
    for found in (summary, axis, parts.withColumnsRenamed({"error": "parts_error", "seconds": "parts_seconds"}), agree):
        out = meet(out, found, "mesh_id", "left")
    if scorer and not config.skip_autoencoder:
        trips = fields.shape_scores(packed, scorer, config.shape, config.timeout_s)
        trips = trips.select("mesh_id", "chamfer", F.struct("chamfer", *[c for c in schemas.VAE_FIELDS if c not in ("chamfer", "error")], F.col("vae_why").alias("error")).alias("vae"), F.col("seconds").alias("vae_seconds"), F.col("error").alias("vae_error"))
        out = meet(out, trips, "mesh_id", "left")
    else:
        out = out.withColumns({"chamfer": F.lit(None).cast("double"), "vae": F.lit(None).cast(schemas.VAE), "vae_seconds": F.lit(None).cast("double"), "vae_error": F.lit(None).cast("string")})
    out = out.withColumn("volume_area_ratio", F.when(F.col("is_watertight"), F.abs("volume") / (F.col("area") + 1e-12)))
    names = {"num_components": "num_components", "volume_area_ratio": "volume_area_ratio", "interior_ratio": "fraction_inside_gt", "ray_agreement": "ray_sign_agreement", "chamfer": "chamfer", "num_vertices": "num_vertices", "axis_share": "axis_aligned_area_fraction"}
    out = out.withColumn("reasons", geometry_reasons({k: F.col(c) for k, c in names.items()}, config.geometry))
    metrics = F.struct(
        "num_components", "is_watertight", "is_winding_consistent", "volume_area_ratio", "ray_sign_agreement", "ray_samples", "fraction_inside_gt", F.col("fraction_inside_other").alias("fraction_inside_cubvh"),
        "vae", "num_vertices", "num_faces", "axis_aligned_area_fraction", "vae_error",
    )
    return out.select("mesh_id", metrics.alias("metrics"), "reasons", (F.size("reasons") == 0).alias("is_valid"), (F.coalesce("parts_seconds", F.lit(0.0)) + F.coalesce("vae_seconds", F.lit(0.0))).alias("seconds"), F.coalesce("parts_error", "vae_error").alias("error"))


def _scorer(factory: Callable | None, config: PipelineConfig) -> None:
    if factory is None and not config.skip_model:
        raise ValueError("stage 2 needs an image scorer, or skip_model")


def model_verdicts(packed: DataFrame, config: PipelineConfig, factory: Callable, cache: DataFrame | None = None) -> DataFrame:
    """Stage 2: render, infer, parse, decide -> (mesh_id, verdict, rejection_reasons, accepted, error, render_error, cache_key, raw_response).

    cache (cache_key, raw_response) holds replies of earlier runs; only images that it lacks are shown to
    the model. Keys are made of image, model, language and size; write the last two columns back to it.
    """
    images = cut(render.render_grids(packed, config.render_res, timeout_s=config.timeout_s))
    key = scorers.cache_key(F.sha2("png", 256), getattr(factory, "name", factory.__qualname__), config.prompt_lang, str(config.render_res))
    asked = images.where("png is not null").withColumn("cache_key", key)
    score = lambda rows: scorers.infer(rows, factory, config.prompt_lang, config.batch_size)
    if cache is not None:
        replies = scorers.with_cache(asked.select("mesh_id", "png", "cache_key"), cache, score).drop("cached")
    else:
        replies = score(asked).join(asked.select("mesh_id", "cache_key"), "mesh_id")
    judged = scorers.decide(replies, config.accept)
    shown = images.select("mesh_id", F.col("error").alias("render_error"), F.col("seconds").alias("render_seconds"))
    return shown.join(judged, "mesh_id", "left").select("mesh_id", "verdict", "rejection_reasons", "accepted", "error", "render_error", "render_seconds", "cache_key", "raw_response")


def _late_errors() -> Column:
    """Errors of rendering (er), the model (e2) and geometry (e4) as reasons; a time-out has a place of its own."""
    timed = lambda e, where: F.when(F.col(e).startswith("TimeoutError:"), f"{where}_timeout")
    at = {"er": timed("er", "render").otherwise("render"), "e2": F.lit("vlm_batch_fail"), "e4": timed("e4", "stage4").otherwise("stage4_fail")}
    return F.array_compact(F.array(*[F.when(F.col(e).isNotNull(), error_reason(where, F.col(e))) for e, where in at.items()]))


def _no_verdicts(packed: DataFrame) -> DataFrame:
    null = F.lit(None)
    return packed.select("mesh_id", null.cast("string").alias("verdict"), null.cast("array<string>").alias("rejection_reasons"), null.cast("boolean").alias("accepted"), *[null.cast("string").alias(c) for c in ("error", "render_error")], null.cast("double").alias("render_seconds"), *[null.cast("string").alias(c) for c in ("cache_key", "raw_response")]).limit(0)


def _no_metrics(packed: DataFrame) -> DataFrame:
    null = F.lit(None)
    return packed.select("mesh_id", null.cast(schemas.METRICS).alias("metrics"), F.array().cast("array<string>").alias("reasons"), F.lit(True).alias("is_valid"), null.cast("double").alias("seconds"), null.cast("string").alias("error"))


def clean_meshes(packed: DataFrame, config: PipelineConfig = PipelineConfig(), image_scorer: Callable | None = None, shape_scorer: Callable | None = None, cache: DataFrame | None = None) -> DataFrame:
    """Stage 1, 3, 4, 2 of every packed mesh -> (mesh_id, vertices, faces, accepted, rejection_reasons, stage1, pose, metrics, verdict, model_accepted, cache_key, raw_response, stage_timings, error); outputs are given for rejected meshes too. stage_timings are the seconds that a mesh took in kernels (for stage 2 in rendering), null where a stage was skipped.

    Stage 2 and the pose methods 'vlm' and 'hybrid' need an image scorer (a factory); without skip_model
    its absence is an error. cache is that of model_verdicts.
    """
    _scorer(image_scorer, config)
    whole = packed
    if config.skip_watertight:
        first = packed.select("mesh_id", F.lit(True).alias("is_watertight"), F.lit(None).cast("boolean").alias("is_winding_consistent"), F.lit(None).cast("double").alias("chamfer_to_input"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("string").alias("error"))
    else:
        closed = cut(voxels.watertighten(packed, config.watertight, config.timeout_s))
        whole, first = closed.where("error is null").select("mesh_id", F.col("vertices").cast(VERTEX).alias("vertices"), F.col("faces").cast(FACE).alias("faces")), closed.drop("vertices", "faces")
    method = pose.downgrade(config.pose_method, config.skip_model)
    poses = cut(pose.find_poses(whole, method, image_scorer, config.pose_render_res, config.batch_size))
    turned = cut(pose.apply_pose(whole, poses))
    metrics = _no_metrics(turned) if config.skip_geometry else cut(geometry_metrics(turned, config, shape_scorer))
    judged = turned.join(metrics.where("is_valid").select("mesh_id"), "mesh_id", "left_semi") if config.short_circuit else turned
    verdicts = model_verdicts(judged, config, image_scorer, cache) if not config.skip_model else _no_verdicts(packed)
    out = first.select("mesh_id", F.struct("is_watertight", "is_winding_consistent", "chamfer_to_input").alias("stage1"), F.col("seconds").alias("t1"), F.col("error").alias("e1"))
    out = out.join(poses.select("mesh_id", F.struct("method", "up_axis_world", "forward_axis_world", "rotation_matrix", "vlm_up_label", "vlm_front_label", "vlm_agrees_with_geom", "needs_manual_review", "geom_inlier_fraction").alias("pose"), F.col("seconds").alias("t3"), F.col("error").alias("e3")), "mesh_id", "left")
    out = out.join(metrics.select("mesh_id", "metrics", "reasons", F.col("seconds").alias("t4"), F.col("error").alias("e4")), "mesh_id", "left")
    out = out.join(verdicts.select("mesh_id", "verdict", F.col("rejection_reasons").alias("r2"), F.col("accepted").alias("model_accepted"), F.col("render_seconds").alias("t2"), "cache_key", "raw_response", F.col("error").alias("e2"), F.col("render_error").alias("er")), "mesh_id", "left").join(turned, "mesh_id", "left")
    reasons = merge_pipeline(F.coalesce("stage1.is_watertight", F.lit(True)), F.coalesce("pose.needs_manual_review", F.lit(False)), F.col("reasons"), F.col("r2"))
    failed = F.array_compact(F.array(F.when(F.col("e1").isNotNull(), error_reason(F.lit("load"), F.col("e1")))))  # a failed pose is a case for review, which merge_pipeline says
    if config.failure_policy == "closed":
        failed = F.concat(failed, _late_errors())
    out = out.withColumn("rejection_reasons", F.concat(failed, reasons))
    return out.select("mesh_id", "vertices", "faces", (F.size("rejection_reasons") == 0).alias("accepted"), "rejection_reasons", "stage1", "pose", "metrics", "verdict", "model_accepted", "cache_key", "raw_response", F.struct(*[F.col(f"t{k}").alias(n) for k, n in STAGES.items()]).alias("stage_timings"), F.coalesce("e1", "e3", "e4", "er", "e2").alias("error"))


def as_results(clean: DataFrame) -> DataFrame:
    """Rows of clean_meshes as nested results, for summaries and reports; seconds_total adds up the stages' kernels."""
    null = F.lit(None)
    verdict = F.when(F.col("verdict").isNotNull(), F.struct(F.col("verdict.aesthetic_quality"), F.col("verdict.object_class"), F.col("model_accepted").alias("accepted"))) if "struct" in clean.schema["verdict"].dataType.simpleString() else null.cast("struct<aesthetic_quality:bigint,object_class:string,accepted:boolean>")
    stages = F.struct(F.col("stage1").alias("stage1_watertighten"), verdict.alias("stage2_vlm_filter"), F.col("pose").alias("stage3_canonicalize"), F.struct("metrics").alias("stage4_filter_geometry"))
    path, seconds = F.col("mesh_id").cast("string"), sum(F.coalesce(f"stage_timings.{n}", F.lit(0.0)) for n in STAGES.values())
    return clean.select(path.alias("input_path"), path.alias("output_path"), "accepted", "rejection_reasons", seconds.alias("seconds_total"), "stage_timings", stages.alias("stage_reports"))


def clean_directory(spark: SparkSession, root: str, config: PipelineConfig = PipelineConfig(), **scorers_: Callable) -> DataFrame:
    """All mesh files below a folder, keyed by content, so equal names don't overwrite each other; files that can't be read are rejected rows."""
    found = listing.with_hash(listing.list_meshes(spark, root, content=True))
    decoded = cut(decode_files(found))
    keyed = decoded.join(found.select(F.col("path").alias("mesh_id"), "sha256"), "mesh_id")
    good = keyed.where("error is null").dropDuplicates(["sha256"]).select(F.col("sha256").alias("mesh_id"), "vertices", "faces")
    clean = clean_meshes(good, config, **scorers_)
    bad = keyed.where("error is not null").select("sha256", F.col("mesh_id").alias("input_path"), F.lit(False).alias("accepted"), F.array(error_reason(F.lit("load"), F.col("error"))).alias("rejection_reasons"), "error")
    paths = keyed.groupBy("sha256").agg(F.min("mesh_id").alias("input_path"))
    done = clean.join(paths, clean.mesh_id == paths.sha256).select("sha256", "input_path", "accepted", "rejection_reasons", "error")
    return done.unionByName(bad)


def filter_datasets(packed: DataFrame, config: PipelineConfig = PipelineConfig(failure_policy="closed"), done: DataFrame | None = None, image_scorer: Callable | None = None, shape_scorer: Callable | None = None, cache: DataFrame | None = None) -> DataFrame:
    """Stages 2 and 4 on raw meshes (dataset, mesh_id, vertices, faces) that have no report yet -> (dataset, mesh_id, accepted, rejection_reasons, verdict, metrics, error); failures reject."""
    _scorer(image_scorer, config)
    todo = pending(packed, done, "mesh_id") if done is not None else packed
    metrics = cut(geometry_metrics(todo, config, shape_scorer))
    verdicts = model_verdicts(todo, config, image_scorer, cache) if not config.skip_model else _no_verdicts(packed)
    out = todo.select("dataset", "mesh_id").join(metrics.select("mesh_id", "metrics", "reasons", F.col("error").alias("e4")), "mesh_id", "left").join(verdicts.select("mesh_id", "verdict", F.col("rejection_reasons").alias("r2"), F.col("error").alias("e2"), F.col("render_error").alias("er")), "mesh_id", "left")
    out = out.withColumn("rejection_reasons", F.concat(_late_errors() if config.failure_policy == "closed" else F.array().cast("array<string>"), merge_batch(F.col("r2"), F.col("reasons"))))
    return out.select("dataset", "mesh_id", (F.size("rejection_reasons") == 0).alias("accepted"), "rejection_reasons", "verdict", "metrics", F.coalesce("er", "e2", "e4").alias("error"))
