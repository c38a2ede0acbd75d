"""Meshes packed one to a row, and kernels that work on whole Arrow batches of them."""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import cut
from .meet import meet

VERTEX = "array<struct<x:double,y:double,z:double>>"
FACE = "array<struct<a:long,b:long,c:long>>"


@dataclass(frozen=True)
class Mesh:
    """Vertices float64 (V, 3) and faces int64 (F, 3), whose entries are row numbers of vertices."""

    vertices: np.ndarray
    faces: np.ndarray


def pack(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """(mesh_id, vertices, faces): arrays in the order of vid and fid; vertex ids must run from 0 without gaps. Meshes without faces have an empty array."""
    v = vertices.groupBy("mesh_id").agg(F.sort_array(F.collect_list(F.struct("vid", "x", "y", "z"))).alias("v"))
    f = faces.groupBy("mesh_id").agg(F.sort_array(F.collect_list(F.struct("fid", "a", "b", "c"))).alias("f"))
    return meet(v, f, "mesh_id", "left").select(
        "mesh_id", F.transform("v", lambda p: F.struct(p["x"], p["y"], p["z"])).cast(VERTEX).alias("vertices"),
        F.coalesce(F.transform("f", lambda p: F.struct(p["a"], p["b"], p["c"])), F.array()).cast(FACE).alias("faces"),
    )


def larger(most: int, *tables: DataFrame) -> DataFrame | None:
    """(mesh_id) of the meshes with more than `most` rows in one of the tables, written; None without any."""
    found = [t.groupBy("mesh_id").agg(F.count("*").alias("n")).where(F.col("n") > most).select("mesh_id") for t in tables]
    return cut(reduce(DataFrame.unionAll, found).distinct()) if any(f.count() for f in found) else None


def _columns(array: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and rows of a list of structs."""
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    flat = array.flatten()
    rows = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(flat.type.num_fields)], axis=1).astype(dtype) if len(flat) else np.zeros((0, 3), dtype)
    return np.concatenate([[0], np.cumsum(array.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64), rows


def meshes(batch: pa.RecordBatch) -> Iterator[Mesh]:
    """The meshes of a batch with columns vertices and faces."""
    vo, v = _columns(batch.column(batch.schema.get_field_index("vertices")), np.float64)
    fo, f = _columns(batch.column(batch.schema.get_field_index("faces")), np.int64)
    for k in range(batch.num_rows):
        yield Mesh(v[vo[k] : vo[k + 1]], f[fo[k] : fo[k + 1]])


def joined(some: list[Mesh]) -> tuple[Mesh, np.ndarray]:
    """The meshes as one of several parts, and where the faces of each begin (and the last ones end). A face that leaves its mesh's vertices is an error."""
    for m in some:
        if len(m.faces) and (m.faces.min() < 0 or m.faces.max() >= len(m.vertices)):
            raise IndexError("a face leaves its mesh's vertices")
    first = np.cumsum([0, *[len(m.vertices) for m in some]])
    faces = np.concatenate([m.faces + f for m, f in zip(some, first, strict=False)])
    return Mesh(np.concatenate([m.vertices for m in some]), faces), np.cumsum([0, *[len(m.faces) for m in some]])


#: Faces of small meshes that a kernel takes at once.
JOINED = 1 << 14


#: Entries of lists, arrays and bytes in a kernel's rows that leave a task at once; each entry of a list is a Python object until then.
HELD = 1 << 15


def in_pieces(rows: Iterator[dict], held: int = HELD) -> Iterator[list[dict]]:
    """The rows in lists that end as soon as they hold so many entries."""
    out, n = [], 0
    for row in rows:
        out.append(row)
        n += 1 + sum(len(x) for x in row.values() if isinstance(x, (list, bytes, np.ndarray)))
        if n >= held:
            yield out
            out, n = [], 0
    if out:
        yield out


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """The values as a column; arrays (rows, fields) become lists of structs without an object for each entry."""
    if not any(isinstance(x, np.ndarray) for x in values):
        return pa.array(values, kind)
    own = [x for x in values if x is not None]
    rows, fields = np.concatenate(own), list(kind.value_type)
    ends = np.cumsum([0, *(0 if x is None else len(x) for x in values)])
    struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, k]), f.type) for k, f in enumerate(fields)], fields=fields)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct, type=kind, mask=pa.array([x is None for x in values]))


@contextmanager
def _limit(seconds: float | None):
    """TimeoutError once the time is up, where the worker's main thread can be interrupted."""
    if not seconds or threading.current_thread() is not threading.main_thread():
        yield
        return

    def stop(*_):
        raise TimeoutError(f"after {seconds:g} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def map_meshes(packed: DataFrame, kernel: Callable[[Mesh], dict], schema: str, heavy: bool = False, timeout_s: float | None = None, clock: bool = False, together: Callable[[list[Mesh]], list[dict]] | None = None, share: Callable[[Mesh], float] = lambda mesh: 1.0) -> DataFrame:
    """One row of `schema` (without mesh_id) for each mesh; an exception becomes the row's error column 'Type:message' and the other fields null. With clock, `seconds` is what the mesh took.

    A heavy kernel's cost lies in its work, not in its bytes, so its meshes are dealt over more
    partitions than their size asks for. A mesh that takes longer than timeout_s gives the error
    'TimeoutError:...'; long calls into compiled code end first.

    With `together`, meshes whose shares add up to at most 1 go to it at once, unless they have a time-out, and
    `seconds` is divided evenly; should it fail, each goes to the kernel alone.
    """
    if heavy:
        context = packed.sparkSession.sparkContext
        packed = packed.repartition(max(4 * context.defaultParallelism, int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "mesh_id")
    schema += ", seconds double" * clock
    names = [x.split()[0] for x in _split(schema)]
    spark = packed.sparkSession
    key = packed.schema["mesh_id"].dataType.simpleString()
    out_schema = f"mesh_id {key}, {schema}, error string"
    arrow = spark.createDataFrame([], out_schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(arrow)

    def measured(mesh: Mesh) -> dict:
        start = time.perf_counter()
        try:
            with _limit(timeout_s):
                row = kernel(mesh) | {"error": None}
        except Exception as problem:  # noqa: BLE001  one bad mesh must not fail the corpus
            row = {"error": f"{type(problem).__name__}:{str(problem)[:200]}"}
        return row | {"seconds": time.perf_counter() - start}

    def all_of(some: list[Mesh]) -> list[dict]:
        start = time.perf_counter()
        try:
            rows = together(some) if len(some) > 1 else []
        except Exception:  # noqa: BLE001  which of them it was, the kernel tells
            rows = []
        spent = (time.perf_counter() - start) / len(some)
        return [r | {"error": None, "seconds": spent} for r in rows] or [measured(mesh) for mesh in some]

    def results(found: Iterator[Mesh]) -> Iterator[dict]:
        if not together or timeout_s:
            yield from map(measured, found)
            return
        some, full = [], 0.0
        for mesh in found:
            own = share(mesh)
            if some and full + own > 1:
                yield from all_of(some)
                some, full = [], 0.0
            some.append(mesh)
            full += own
        if some:
            yield from all_of(some)

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("mesh_id"))
            at = 0
            for rows in in_pieces(results(meshes(batch))):
                columns = [_column([r.get(n) for r in rows], target.field(n).type) for n in (*names, "error")]
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(rows)), *columns], schema=target)
                at += len(rows)

    return packed.select("mesh_id", "vertices", "faces").mapInArrow(run, out_schema)


def _split(schema: str) -> list[str]:
    """The fields of a schema string, commas inside <> not counting."""
    out, depth, start = [], 0, 0
    for k, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:k].strip())
            start = k + 1
    return [*out, schema[start:].strip()]
