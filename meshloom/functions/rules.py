"""Accept and reject rules with ordered reasons, merges of stage reports, labels and display."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GeometryConfig:
    max_components: int = 8
    volume_area_ratio_min: float | None = None
    interior_ratio_min: float = 0.03
    ray_agreement_min: float = 0.0
    chamfer_max: float | None = 0.15
    primitive_vertices: int = 500
    primitive_axis_share: float = 0.85


def geometry_reasons(metrics: dict[str, Column], config: GeometryConfig = GeometryConfig()) -> Column:
    """Reasons of the geometry stage in their fixed order. metrics: num_components, volume_area_ratio, interior_ratio, ray_agreement, chamfer, num_vertices, axis_share; missing or null ones give no reason."""
    null = F.lit(None).cast("double")
    m = lambda k: metrics.get(k, null)
    reasons = [F.when(m("num_components") > config.max_components, F.concat(F.lit("too_many_components="), m("num_components").cast("long").cast("string")))]
    if config.volume_area_ratio_min is not None:
        reasons.append(F.when(m("volume_area_ratio") < config.volume_area_ratio_min, F.format_string("thin_shell_vol_area=%.4f", m("volume_area_ratio"))))
    reasons.append(F.when(m("interior_ratio") < config.interior_ratio_min, F.format_string(f"thin_shell interior_ratio=%.4f < {config.interior_ratio_min}", m("interior_ratio"))))
    if config.ray_agreement_min > 0:
        reasons.append(F.when(m("ray_agreement") < config.ray_agreement_min, F.format_string("ray_sign_disagreement=%.3f", m("ray_agreement"))))
    if config.chamfer_max is not None:
        reasons.append(F.when(m("chamfer") > config.chamfer_max, F.format_string(f"vae_chamfer=%.4f > {config.chamfer_max}", m("chamfer"))))
    reasons.append(F.when((m("num_vertices") < config.primitive_vertices) & (m("axis_share") > config.primitive_axis_share), F.lit("primitive_like")))
    return F.array_compact(F.array(*reasons))


def _prefixed(reasons: Column, stage: str) -> Column:
    return F.coalesce(F.transform(reasons, lambda r: F.concat(F.lit(f"{stage}:"), r)), F.array().cast("array<string>"))


def merge_pipeline(watertight: Column, needs_review: Column, geometry: Column, model: Column) -> Column:
    """Reasons of the single-mesh pipeline: stage 1, stage 3, stage 4, stage 2."""
    own = F.array_compact(F.array(F.when(~watertight, F.lit("stage1_not_watertight")), F.when(needs_review, F.lit("stage3_canonicalize_uncertain"))))
    return F.concat(own, _prefixed(geometry, "stage4"), _prefixed(model, "stage2"))


def merge_batch(model: Column, geometry: Column) -> Column:
    """Reasons of the batch run: stage 2 before stage 4."""
    return F.concat(_prefixed(model, "stage2"), _prefixed(geometry, "stage4"))


#: Where a batch run may fail; failures are rejections there.
ERROR_PLACES = ("vlm_batch_fail", "merge_fail", "load", "render_timeout", "render", "stage4_timeout", "stage4_fail")


def error_reason(where: Column, message: Column) -> Column:
    return F.concat(F.lit("error:"), where, F.lit(":"), F.substring(F.coalesce(message, F.lit("")), 1, 200))


def exception_reason(kind: Column, message: Column) -> Column:
    return F.concat(F.lit("exception:"), kind, F.lit(":"), F.substring(F.coalesce(message, F.lit("")), 1, 200))


def split_reasons(joined: Column) -> Column:
    return F.filter(F.split(F.coalesce(joined, F.lit("")), r"\|"), lambda r: r != "")


def flip_label(old_noisy: Column, new_noisy: Column) -> Column:
    old, new = (F.coalesce(x, F.lit(False)) for x in (old_noisy, new_noisy))
    return F.when(old & ~new, "noisy->clean").when(~old & new, "clean->noisy").otherwise("")


def mesh_line(vertices: Column, faces: Column, watertight: Column, volume: Column) -> Column:
    """A display line with thousands separators; missing parts are left out."""
    number = lambda x, f: F.when(x.isNotNull(), F.concat(F.lit(f), F.format_number(x, 0)))
    return F.concat_ws(" | ", number(vertices, "V "), number(faces, "F "), F.when(watertight, "watertight").when(~watertight, "open"), F.when(volume.isNotNull(), F.concat(F.lit("vol "), F.format_number(volume, 3))))


def strip_extension(name: Column) -> Column:
    """Without one known mesh extension, whatever its case."""
    return F.regexp_replace(name, r"(?i)\.(glb|obj|ply|gltf|fbx)$", "")
