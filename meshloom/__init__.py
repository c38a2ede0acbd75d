"""Spark-native engine for the quality control of 3D mesh corpora."""

from __future__ import annotations

_LAZY = {"clean_meshes": ".plans.pipeline", "clean_directory": ".plans.pipeline", "filter_datasets": ".plans.pipeline", "PipelineConfig": ".config", "watertighten": ".operators.voxels", "canonicalise": ".operators.pose", "geometry_metrics": ".plans.pipeline", "local_session": ".session"}

__all__ = sorted(_LAZY)


def __getattr__(name: str):
    if name in _LAZY:
        from importlib import import_module

        return getattr(import_module(_LAZY[name], __name__), name)
    raise AttributeError(name)
