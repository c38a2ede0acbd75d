"""Decoders and encoders of mesh files (PLY, OBJ, GLB) in NumPy, and their Arrow-batched use on file contents."""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..operators.packed import FACE, VERTEX, Mesh

#: Fixed values of the formats: component types of glTF and scalar types of PLY.
GLTF_TYPES = {5120: "i1", 5121: "u1", 5122: "<i2", 5123: "<u2", 5125: "<u4", 5126: "<f4"}
GLTF_WIDTHS = {"SCALAR": 1, "VEC2": 2, "VEC3": 3, "VEC4": 4, "MAT4": 16}
PLY_TYPES = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2", "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8"}


def _fans(polygons: list[list[int]]) -> np.ndarray:
    return np.array([(p[0], p[k], p[k + 1]) for p in polygons for k in range(1, len(p) - 1)], np.int64).reshape(-1, 3)


def decode_obj(data: bytes) -> Mesh:
    vertices, polygons = [], []
    for line in data.decode("utf-8", "replace").replace("\\\n", " ").splitlines():
        word = line.split()
        if not word:
            continue
        if word[0] == "v":
            vertices.append([float(x) for x in word[1:4]])
        elif word[0] == "f":
            at = [int(w.split("/")[0]) for w in word[1:]]
            polygons.append([a - 1 if a > 0 else len(vertices) + a for a in at])
    return Mesh(np.array(vertices, float).reshape(-1, 3), _fans(polygons))


def decode_ply(data: bytes) -> Mesh:
    end = data.index(b"end_header")
    body = data.index(b"\n", end) + 1
    head = [line.split() for line in data[:end].decode("ascii", "replace").splitlines()]
    form = next(w[1] for w in head if w[:1] == ["format"])
    elements: list[tuple[str, int, list]] = []
    for w in head:
        if w[:1] == ["element"]:
            elements.append((w[1], int(w[2]), []))
        elif w[:1] == ["property"]:
            elements[-1][2].append(w[1:])
    vertices, polygons, at = np.zeros((0, 3)), [], body
    words = data[body:].split() if form == "ascii" else []
    order = ">" if "big" in form else "<"
    k = 0
    for name, n, props in elements:
        lists = any(p[0] == "list" for p in props)
        if not lists and form != "ascii":
            kind = np.dtype([(p[-1], order + PLY_TYPES[p[0]]) for p in props])
            rows = np.frombuffer(data, kind, n, at)
            at += n * kind.itemsize
            if name == "vertex":
                vertices = np.stack([rows[d].astype(float) for d in "xyz"], 1)
            continue
        if not lists:
            rows = np.array(words[k : k + n * len(props)], float).reshape(n, len(props))
            k += n * len(props)
            if name == "vertex":
                vertices = rows[:, [[p[-1] for p in props].index(d) for d in "xyz"]]
            continue
        for _ in range(n):
            for p in props:
                size, kind = (p[1], p[2]) if p[0] == "list" else (None, p[0])
                if form == "ascii":
                    m = int(words[k]) if size else 1
                    values = words[k + bool(size) : k + bool(size) + m]
                    k += bool(size) + m
                else:
                    m = 1
                    if size:
                        m = int(np.frombuffer(data, order + PLY_TYPES[size], 1, at)[0])
                        at += np.dtype(PLY_TYPES[size]).itemsize
                    values = np.frombuffer(data, order + PLY_TYPES[kind], m, at).tolist()
                    at += m * np.dtype(PLY_TYPES[kind]).itemsize
                if name == "face" and size and p[-1] in ("vertex_indices", "vertex_index"):
                    polygons.append([int(v) for v in values])
    return Mesh(vertices, _fans(polygons))


def _matrix(node: dict) -> np.ndarray:
    if "matrix" in node:
        return np.array(node["matrix"], float).reshape(4, 4).T
    x, y, z, w = node.get("rotation", (0, 0, 0, 1))
    out = np.eye(4)
    out[:3, :3] = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]) * np.array(node.get("scale", (1, 1, 1)), float)
    out[:3, 3] = node.get("translation", (0, 0, 0))
    return out


def flatten_scene(parts: list[tuple[Mesh, np.ndarray]]) -> Mesh:
    """One mesh of all parts, each moved by its 4 x 4 matrix; faces of mirrored parts are turned round. An empty scene raises."""
    if not parts:
        raise ValueError("scene has no triangle geometry")
    vertices, faces, base = [], [], 0
    for mesh, m in parts:
        vertices.append(mesh.vertices @ m[:3, :3].T + m[:3, 3])
        faces.append((mesh.faces[:, ::-1] if np.linalg.det(m[:3, :3]) < 0 else mesh.faces) + base)
        base += len(mesh.vertices)
    return Mesh(np.concatenate(vertices), np.concatenate(faces))


def decode_glb(data: bytes) -> Mesh:
    if data[:4] != b"glTF":
        raise ValueError("not a GLB file")
    at, doc, blob = 12, None, b""
    while at + 8 <= len(data):
        size, kind = struct.unpack_from("<II", data, at)
        body = data[at + 8 : at + 8 + size]
        doc, blob = (json.loads(body), blob) if kind == 0x4E4F534A else (doc, body if kind == 0x004E4942 else blob)
        at += 8 + size

    def read(index: int) -> np.ndarray:
        a = doc["accessors"][index]
        kind, width = np.dtype(GLTF_TYPES[a["componentType"]]), GLTF_WIDTHS[a["type"]]
        if "bufferView" not in a:
            return np.zeros((a["count"], width), kind)
        view = doc["bufferViews"][a["bufferView"]]
        start, stride = view.get("byteOffset", 0) + a.get("byteOffset", 0), view.get("byteStride") or kind.itemsize * width
        return np.ndarray((a["count"], width), kind, blob, start, (stride, kind.itemsize))

    parts: list[tuple[Mesh, np.ndarray]] = []

    def visit(index: int, above: np.ndarray) -> None:
        node = doc["nodes"][index]
        m = above @ _matrix(node)
        for p in doc["meshes"][node["mesh"]]["primitives"] if "mesh" in node else ():
            if p.get("mode", 4) == 4:
                v = read(p["attributes"]["POSITION"]).astype(float)
                f = read(p["indices"]).astype(np.int64).reshape(-1, 3) if "indices" in p else np.arange(len(v) // 3 * 3).reshape(-1, 3)
                parts.append((Mesh(v, f), m))
        for child in node.get("children", ()):
            visit(child, m)

    children = {c for n in doc.get("nodes", ()) for c in n.get("children", ())}
    roots = doc["scenes"][doc.get("scene", 0)].get("nodes", ()) if doc.get("scenes") else [k for k in range(len(doc.get("nodes", ()))) if k not in children]
    for root in roots:
        visit(root, np.eye(4))
    return flatten_scene(parts)


def decode_mesh(path: str, data: bytes) -> Mesh:
    """By extension; colours and texture coordinates are left out, vertices aren't merged. No faces is an error."""
    kind = path.rsplit(".", 1)[-1].lower()
    mesh = {"obj": decode_obj, "ply": decode_ply, "glb": decode_glb}[kind](data)
    if not len(mesh.faces):
        raise ValueError("mesh has no faces")
    if mesh.faces.min() < 0 or mesh.faces.max() >= len(mesh.vertices):
        raise ValueError("face index out of range")
    return mesh


def encode_ply(mesh: Mesh) -> bytes:
    """Binary little-endian PLY with float vertices."""
    head = f"ply\nformat binary_little_endian 1.0\nelement vertex {len(mesh.vertices)}\nproperty float x\nproperty float y\nproperty float z\nelement face {len(mesh.faces)}\nproperty list uchar int vertex_indices\nend_header\n"
    faces = np.empty(len(mesh.faces), [("n", "u1"), ("v", "<i4", 3)])
    faces["n"], faces["v"] = 3, mesh.faces
    return head.encode() + mesh.vertices.astype("<f4").tobytes() + faces.tobytes()


def encode_obj(mesh: Mesh) -> bytes:
    return "".join([*(f"v {x!r} {y!r} {z!r}\n" for x, y, z in mesh.vertices.tolist()), *(f"f {a + 1} {b + 1} {c + 1}\n" for a, b, c in mesh.faces.tolist())]).encode()


def encode_glb(mesh: Mesh) -> bytes:
    v, f = mesh.vertices.astype("<f4"), mesh.faces.astype("<u4")
    blob = v.tobytes() + f.tobytes()
    doc = {
        "asset": {"version": "2.0"}, "scene": 0, "scenes": [{"nodes": [0]}], "nodes": [{"mesh": 0}], "meshes": [{"primitives": [{"attributes": {"POSITION": 0}, "indices": 1}]}],
        "accessors": [{"bufferView": 0, "componentType": 5126, "count": len(v), "type": "VEC3", "min": v.min(0).tolist(), "max": v.max(0).tolist()}, {"bufferView": 1, "componentType": 5125, "count": f.size, "type": "SCALAR"}],
        "bufferViews": [{"buffer": 0, "byteOffset": 0, "byteLength": v.nbytes}, {"buffer": 0, "byteOffset": v.nbytes, "byteLength": f.nbytes}], "buffers": [{"byteLength": len(blob)}],
    }
    text = json.dumps(doc).encode()
    text += b" " * (-len(text) % 4)
    return struct.pack("<III", 0x46546C67, 2, 28 + len(text) + len(blob)) + struct.pack("<II", len(text), 0x4E4F534A) + text + struct.pack("<II", len(blob), 0x004E4942) + blob


def decode_files(files: DataFrame) -> DataFrame:
    """(path, content) -> (mesh_id = path, vertices, faces, error): packed meshes; a file that can't be read gives its error as 'Type:message'."""

    def run(batches):
        for batch in batches:
            rows = []
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    m = decode_mesh(path, data)
                    rows.append(([dict(zip("xyz", r, strict=True)) for r in m.vertices.tolist()], [dict(zip("abc", r, strict=True)) for r in m.faces.tolist()], None))
                except Exception as problem:  # noqa: BLE001
                    rows.append((None, None, f"{type(problem).__name__}:{str(problem)[:200]}"))
            v = pa.array([r[0] for r in rows], pa.list_(pa.struct([(d, pa.float64()) for d in "xyz"])))
            f = pa.array([r[1] for r in rows], pa.list_(pa.struct([(d, pa.int64()) for d in "abc"])))
            yield pa.RecordBatch.from_arrays([batch.column(0), v, f, pa.array([r[2] for r in rows], pa.string())], ["mesh_id", "vertices", "faces", "error"])

    return files.select("path", "content").mapInArrow(run, f"mesh_id string, vertices {VERTEX}, faces {FACE}, error string")


def unpack(packed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertex and face tables of packed meshes."""
    v = packed.selectExpr("mesh_id", "posexplode(vertices) AS (vid, p)").selectExpr("mesh_id", "CAST(vid AS BIGINT) AS vid", "p.*")
    f = packed.selectExpr("mesh_id", "posexplode(faces) AS (fid, p)").selectExpr("mesh_id", "CAST(fid AS BIGINT) AS fid", "p.*")
    return v, f


def encode_meshes(packed: DataFrame) -> DataFrame:
    """(mesh_id, content): every packed mesh as PLY bytes; rejected meshes are written too, so filter beforehand if they shouldn't be."""
    from ..operators.packed import map_meshes

    return map_meshes(packed, lambda m: {"content": encode_ply(m)}, "content binary").select("mesh_id", "content")
