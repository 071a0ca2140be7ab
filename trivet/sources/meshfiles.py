"""Mesh files as tables: OBJ, PLY and STL in, the same out."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.errors import MeshFormatError, MeshLoadError, MeshProcessingError

SUFFIXES = (".obj", ".ply", ".stl")
PLY_TYPES = {"char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8"}
PLY_TYPES |= {"int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8"}


def fan(corners: list[int]) -> list[tuple[int, int, int]]:
    return [(corners[0], corners[i], corners[i + 1]) for i in range(1, len(corners) - 1)]


def parse_obj(raw: bytes) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Vertices and triangles; negative indices count from the end, objects and groups are one mesh."""
    points, faces = [], []
    for line in raw.decode("utf-8", "replace").splitlines():
        word = line.split()
        if word[:1] == ["v"]:
            points.append([float(x) for x in word[1:4]])
        elif word[:1] == ["f"]:
            at = [int(w.split("/")[0]) for w in word[1:]]
            faces += fan([i - 1 if i > 0 else len(points) + i for i in at])
    return np.array(points, float).reshape(-1, 3), faces


def parse_ply(raw: bytes) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """ASCII and binary PLY of either byte order; other elements and properties are skipped."""
    head, mark, body = raw.partition(b"end_header\n")
    if not mark:
        head, mark, body = raw.partition(b"end_header\r\n")
    lines = [x.split() for x in head.decode("ascii", "replace").splitlines()]
    kind = next(x[1] for x in lines if x[:1] == ["format"])
    elements: list[tuple[str, int, list[list[str]]]] = []
    for x in lines:
        if x[:1] == ["element"]:
            elements.append((x[1], int(x[2]), []))
        elif x[:1] == ["property"]:
            elements[-1][2].append(x[1:])
    points, faces = np.zeros((0, 3)), []
    words, at, pos = (iter(body.split()), 0, 0) if kind == "ascii" else (iter(()), 0, 0)
    order = ">" if kind == "binary_big_endian" else "<"

    def take(t: str, n: int) -> list[float]:
        nonlocal pos
        if kind == "ascii":
            return [float(next(words)) for _ in range(n)]
        d = np.dtype(order + PLY_TYPES[t])
        out = np.frombuffer(body, d, n, pos).tolist()
        pos += n * d.itemsize
        return out

    for name, n, props in elements:
        rows = []
        for _ in range(n):
            row = {}
            for p in props:
                row[p[-1]] = take(p[2], int(take(p[1], 1)[0])) if p[0] == "list" else take(p[0], 1)[0]
            rows.append(row)
        if name == "vertex":
            points = np.array([[r["x"], r["y"], r["z"]] for r in rows], float).reshape(-1, 3)
        elif name == "face":
            for r in rows:
                faces += fan([int(i) for i in r.get("vertex_indices", r.get("vertex_index", []))])
    return points, faces


def parse_stl(raw: bytes) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Binary or ASCII STL; every triangle has its own three vertices, as the format stores them."""
    n = struct.unpack_from("<I", raw, 80)[0] if len(raw) >= 84 else -1
    if n >= 0 and len(raw) == 84 + 50 * n:
        rows = np.frombuffer(raw, np.dtype([("n", "<f4", 3), ("v", "<f4", (3, 3)), ("a", "<u2")]), n, 84)
        points = rows["v"].reshape(-1, 3).astype(float)
    else:
        found = re.findall(rb"vertex\s+(\S+)\s+(\S+)\s+(\S+)", raw)
        points = np.array(found, dtype="S").astype(float).reshape(-1, 3)
    return points, [(i, i + 1, i + 2) for i in range(0, len(points), 3)]


PARSERS = {".obj": parse_obj, ".ply": parse_ply, ".stl": parse_stl}


def list_meshes(spark: SparkSession, path: str) -> DataFrame:
    """(mesh_id, path, suffix, content) of the mesh files under a path; content is only read where it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.withColumn("suffix", F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))).where(F.col("suffix").isin(*SUFFIXES))
    return files.select(F.xxhash64("path").alias("mesh_id"), "path", "suffix", "content")


def _parsed(r) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    try:
        return PARSERS[r.suffix](bytes(r.content))
    except Exception as e:
        raise MeshLoadError(f"cannot read {r.path}: {e}") from e


def read_meshes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Faces and vertices of all mesh files under a path, mesh_id a hash of the file's path, and `path`.

    Files are read and parsed once a table by the executors, one file in memory at a time; files of
    another suffix are not opened. Vertices are not merged. A file that cannot be parsed is an error.
    """
    files = list_meshes(spark, path)

    def faces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                f = np.array(_parsed(r)[1], np.int64).reshape(-1, 3)
                yield pd.DataFrame({"mesh_id": r.mesh_id, "path": r.path, "fid": np.arange(len(f)), "v0": f[:, 0], "v1": f[:, 1], "v2": f[:, 2]})

    def vertices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                v = _parsed(r)[0]
                yield pd.DataFrame({"mesh_id": r.mesh_id, "path": r.path, "vid": np.arange(len(v)), "x": v[:, 0], "y": v[:, 1], "z": v[:, 2]})

    return (
        files.mapInPandas(faces, "mesh_id long, path string, fid long, v0 long, v1 long, v2 long"),
        files.mapInPandas(vertices, "mesh_id long, path string, vid long, x double, y double, z double"),
    )


def format_mesh(kind: str, points: np.ndarray, faces: np.ndarray, binary: bool = True) -> bytes:
    """The bytes of a mesh file of kind obj, ply or stl."""
    if kind == "obj":
        return "".join([*(f"v {x!r} {y!r} {z!r}\n" for x, y, z in points.tolist()), *(f"f {a + 1} {b + 1} {c + 1}\n" for a, b, c in faces.tolist())]).encode()
    if kind == "ply":
        head = f"ply\nformat ascii 1.0\nelement vertex {len(points)}\nproperty double x\nproperty double y\nproperty double z\nelement face {len(faces)}\nproperty list uchar int vertex_indices\nend_header\n"
        return (head + "".join([*(f"{x!r} {y!r} {z!r}\n" for x, y, z in points.tolist()), *(f"3 {a} {b} {c}\n" for a, b, c in faces.tolist())])).encode()
    if kind != "stl":
        raise MeshFormatError(f"unknown mesh format {kind}")
    t = points[faces]
    n = np.cross(t[:, 1] - t[:, 0], t[:, 2] - t[:, 0])
    size = np.linalg.norm(n, axis=1, keepdims=True)
    n = np.divide(n, size, out=np.zeros_like(n), where=size > 0)
    if binary:
        rows = np.zeros(len(t), np.dtype([("n", "<f4", 3), ("v", "<f4", (3, 3)), ("a", "<u2")]))
        rows["n"], rows["v"] = n, t
        return b"\0" * 80 + struct.pack("<I", len(t)) + rows.tobytes()
    out = ["solid mesh"]
    for m, tri in zip(n.tolist(), t.tolist(), strict=True):
        out += ["facet normal {} {} {}".format(*m), "outer loop", *("vertex {} {} {}".format(*p) for p in tri), "endloop", "endfacet"]
    return "\n".join([*out, "endsolid mesh\n"]).encode()


def write_meshes(faces: DataFrame, vertices: DataFrame, folder: str, kind: str = "obj", binary: bool = True, name: str | None = None) -> DataFrame:
    """Writes one file a mesh and returns (mesh_id, path, sha256, n_faces); vertex ids become dense.

    A file's name is its mesh's id, or the value of the faces' column `name`. Meshes without a face are not written.

    A file gets its name when whole. STL files are read back from the store before that: they must not be empty, and their box
    must equal the mesh's within 1e-5 (relative) and 1e-7.
    """
    import hashlib

    import pyarrow.fs as pafs


    if kind not in ("obj", "ply", "stl"):
        raise MeshFormatError(f"unknown mesh format {kind}")

    def one(key, f: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if f.empty:
            return pd.DataFrame({"mesh_id": [], "path": [], "sha256": [], "n_faces": []})
        v = v.sort_values("vid")
        f = f.sort_values("fid")
        points = v[["x", "y", "z"]].to_numpy(float)
        tri = np.searchsorted(v["vid"].to_numpy(), f[["v0", "v1", "v2"]].to_numpy())
        raw = format_mesh(kind, points, tri, binary)
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        file = f"{base}/{f[name].iloc[0] if name else key[0]}.{kind}"
        with fs.open_output_stream(f"{file}.draft") as out:
            out.write(raw)
        if kind == "stl":
            with fs.open_input_stream(f"{file}.draft") as written:
                again = parse_stl(written.read())[0]
            used = points[tri].reshape(-1, 3)
            if not len(again) or not np.allclose([again.min(0), again.max(0)], [used.min(0), used.max(0)], rtol=1e-5, atol=1e-7):
                raise MeshProcessingError(f"the STL file of mesh {key[0]} does not hold its mesh")
        fs.move(f"{file}.draft", file)
        return pd.DataFrame({"mesh_id": [key[0]], "path": [file], "sha256": [hashlib.sha256(raw).hexdigest()], "n_faces": [len(f)]})

    return faces.groupBy("mesh_id").cogroup(vertices.groupBy("mesh_id")).applyInPandas(one, "mesh_id long, path string, sha256 string, n_faces long")
