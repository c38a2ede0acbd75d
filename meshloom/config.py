"""Settings: named defaults, and a frozen snapshot of environment variables in which blank means unset."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from .functions.rules import GeometryConfig
from .functions.verdicts import AcceptConfig
from .operators.fields import FieldConfig
from .operators.voxels import WatertightConfig

PREFIX = "MESHLOOM_"


def env(name: str, default: str | None = None) -> str | None:
    value = (os.environ.get(PREFIX + name) or "").strip()
    return value or default


@dataclass(frozen=True)
class Paths:
    data: str | None = field(default_factory=lambda: env("DATA"))
    output: str | None = field(default_factory=lambda: env("OUTPUT"))
    cache: str | None = field(default_factory=lambda: env("CACHE"))
    model: str | None = field(default_factory=lambda: env("MODEL"))


@dataclass(frozen=True)
class PipelineConfig:
    """failure_policy: 'open' keeps a mesh whose model or geometry stage failed, 'closed' rejects it."""

    watertight: WatertightConfig = WatertightConfig()
    geometry: GeometryConfig = GeometryConfig()
    accept: AcceptConfig = AcceptConfig()
    #: Samples, grid and chunks of the shape model's round trip.
    shape: FieldConfig = FieldConfig()
    pose_method: str = "geom"
    skip_model: bool = False
    skip_autoencoder: bool = True
    skip_watertight: bool = False
    skip_geometry: bool = False
    ray_samples: int = 20_000
    failure_policy: str = "open"
    #: Run the model only on meshes that geometry accepts.
    short_circuit: bool = False
    timeout_s: int = field(default_factory=lambda: int(env("MESH_TIMEOUT", "120")))
    batch_size: int = 4
    prompt_lang: str = "en"
    #: Pixels a side of the four views for the model and of the six for its pose.
    render_res: int = 512
    pose_render_res: int = 384
