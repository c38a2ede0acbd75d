"""Table functions for SQL: decode_mesh(path, content)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..operators.packed import FACE, VERTEX


@udtf(returnType=f"mesh_id string, vertices {VERTEX}, faces {FACE}, error string")
class DecodeMesh:
    """One row per file: packed mesh, or the error that reading it gave."""

    def eval(self, path: str, content: bytes):
        from ..sources.meshfile import decode_mesh

        try:
            m = decode_mesh(path, bytes(content))
            yield path, [dict(zip("xyz", r, strict=True)) for r in m.vertices.tolist()], [dict(zip("abc", r, strict=True)) for r in m.faces.tolist()], None
        except Exception as problem:  # noqa: BLE001
            yield path, None, None, f"{type(problem).__name__}:{str(problem)[:200]}"


def register(spark: SparkSession) -> None:
    spark.udtf.register("decode_mesh", DecodeMesh)
