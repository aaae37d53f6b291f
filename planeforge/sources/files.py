"""Mesh, volume and point files: one file is one row of a binary scan.

``spark.read.format("binaryFile")`` lists and splits the files over the
cluster; the parsers below turn the bytes of one file into arrays, which
Spark then opens into vertex, face, slice or point rows.
"""

from __future__ import annotations

import gzip
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

MESH_SUFFIXES = (".obj", ".stl", ".ply")
VOLUME_SUFFIXES = (".nii", ".nii.gz", ".nrrd")


def scan(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path and bytes of every file below a folder."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(path).select("path", "content")
    )


# --- meshes ---------------------------------------------------------------------
def _fan(face: list[int]) -> list[tuple[int, int, int]]:
    return [(face[0], face[i], face[i + 1]) for i in range(1, len(face) - 1)]


def _parse_obj(text: str):
    verts, faces = [], []
    for line in text.splitlines():
        w = line.split()
        if not w:
            continue
        if w[0] == "v":
            verts.append([float(v) for v in w[1:4]])
        elif w[0] == "f":
            at = [int(t.split("/")[0]) for t in w[1:]]
            faces += _fan([i - 1 if i > 0 else len(verts) + i for i in at])
    return verts, faces


def _parse_stl(data: bytes):
    if len(data) >= 84:
        n = struct.unpack_from("<I", data, 80)[0]
        if len(data) == 84 + 50 * n:
            rec = np.frombuffer(data, dtype=np.dtype([("n", "<f4", 3), ("v", "<f4", (3, 3)), ("a", "<u2")]), offset=84)
            verts = rec["v"].reshape(-1, 3).astype(float)
            return verts.tolist(), np.arange(len(verts)).reshape(-1, 3).tolist()
    verts = [[float(v) for v in w[1:4]] for w in (ln.split() for ln in data.decode().splitlines()) if w[:1] == ["vertex"]]
    return verts, np.arange(len(verts)).reshape(-1, 3).tolist()


def _ply_head(lines: list[str]):
    """Elements as (name, count, property names) and the first body line."""
    if lines[0].strip() != "ply" or lines[1].strip() != "format ascii 1.0":
        raise ValueError("not an ASCII PLY 1.0 file")
    elements, at = [], None
    for i, line in enumerate(lines[2:], 2):
        w = line.split()
        if w[:1] == ["end_header"]:
            at = i + 1
            break
        if w[:1] == ["element"]:
            elements.append((w[1], int(w[2]), []))
        elif w[:1] == ["property"] and elements:
            elements[-1][2].append(w[-1])
    if at is None:
        raise ValueError("end_header is missing")
    return elements, at


def _parse_ply(text: str):
    lines = text.splitlines()
    elements, at = _ply_head(lines)
    verts, faces = [], []
    for name, count, props in elements:
        body = lines[at : at + count]
        if len(body) < count:
            raise ValueError("fewer lines than declared")
        at += count
        if name == "vertex":
            cols = [props.index(p) for p in "xyz"]
            verts = [[float(w[c]) for c in cols] for w in (b.split() for b in body)]
        elif name == "face":
            for w in (b.split() for b in body):
                faces += _fan([int(v) for v in w[1 : 1 + int(w[0])]])
    return verts, faces


def _mesh(path: str, data: bytes):
    low = path.lower()
    if low.endswith(".obj"):
        v, f = _parse_obj(data.decode())
    elif low.endswith(".stl"):
        v, f = _parse_stl(data)
    elif low.endswith(".ply"):
        v, f = _parse_ply(data.decode())
    else:
        raise ValueError("unsupported mesh suffix")
    if not f:
        raise ValueError("no faces")
    return v, f


def parse_meshes(files: DataFrame) -> DataFrame:
    """(path, vertices, faces, error); a bad file is a row with its reason."""

    def run(batches):
        for pdf in batches:
            rows = []
            for path, data in zip(pdf["path"], pdf["content"]):
                try:
                    v, f = _mesh(path, bytes(data))
                    rows.append((path, v, f, None))
                except (ValueError, IndexError, UnicodeDecodeError) as e:
                    rows.append((path, [], [], str(e)))
            yield pd.DataFrame(rows, columns=["path", "vertices", "faces", "error"])

    return files.select("path", "content").mapInPandas(
        run, "path string, vertices array<array<double>>, faces array<array<int>>, error string")


def mesh_vertex_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select("path", F.posexplode("vertices").alias("vertex_id", "p")).select(
        "path", "vertex_id", *[F.col("p")[i].alias(a) for i, a in enumerate("xyz")])


def mesh_face_rows(parsed: DataFrame) -> DataFrame:
    return parsed.select("path", F.posexplode("faces").alias("face_id", "f")).select(
        "path", "face_id", *[F.col("f")[i].alias(f"v{i}") for i in range(3)])


# --- volumes ------------------------------------------------------------------------
# NRRD type names and NIfTI type codes with their NumPy types.
NRRD_TYPES = {
    "float": "f4", "double": "f8", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2", "int": "i4", "int32": "i4",
    "uint": "u4", "uint32": "u4", "uchar": "u1", "uint8": "u1", "unsigned char": "u1", "signed char": "i1", "int8": "i1",
}
NIFTI_TYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4"}


# Names of the patient spaces that are read; no name means the format's usual LPS.
NRRD_SPACES = {"": "LPS", "left-posterior-superior": "LPS", "lps": "LPS", "right-anterior-superior": "RAS", "ras": "RAS"}


def _vector(text: str) -> list[float]:
    return [float(v) for v in text.strip().strip("()").split(",")]


def _parse_nrrd(data: bytes):
    head, body = data.split(b"\n\n", 1)
    fields = {}
    for line in head.decode().splitlines()[1:]:
        if line.startswith("#") or ":" not in line:
            continue
        k, v = line.split(":", 1)
        fields[k.strip().lower()] = v.lstrip("=").strip()
    if int(fields["dimension"]) != 3:
        raise ValueError("not three-dimensional")
    sizes = [int(v) for v in fields["sizes"].split()]
    kind = np.dtype(("<" if fields.get("endian", "little") == "little" else ">") + NRRD_TYPES[fields["type"]])
    enc = fields.get("encoding", "raw").lower()
    if enc not in ("raw", "gzip", "gz"):
        raise ValueError(f"unsupported encoding {enc}")
    if "data file" in fields or "datafile" in fields:
        raise ValueError("detached data file")
    raw = gzip.decompress(body) if enc in ("gzip", "gz") else body
    dirs = [_vector(v) for v in fields["space directions"].split(") (")] if "space directions" in fields else np.eye(3).tolist()
    origin = _vector(fields["space origin"]) if "space origin" in fields else [0.0] * 3
    arr = np.frombuffer(raw, dtype=kind, count=int(np.prod(sizes))).reshape(sizes[::-1])
    d = np.array(dirs, dtype=float).T
    spacing = np.linalg.norm(d, axis=0)
    system = NRRD_SPACES.get(fields.get("space", "").lower())
    if system is None:
        raise ValueError(f"unsupported space {fields.get('space', '')!r}")
    return arr, spacing, np.array(origin), d / spacing, system


def _quaternion(b: float, c: float, d: float) -> np.ndarray:
    """Rotation of the unit quaternion whose last three parts are given."""
    v = np.array([b, c, d])
    a = np.sqrt(max(0.0, 1.0 - v @ v))
    wedge = np.array([[0, -d, c], [d, 0, -b], [-c, b, 0]])
    return (a * a - v @ v) * np.eye(3) + 2 * np.outer(v, v) + 2 * a * wedge


def _parse_nifti(data: bytes):
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    end = "<" if struct.unpack_from("<i", data, 0)[0] == 348 else ">"
    dim = struct.unpack_from(end + "8h", data, 40)
    if dim[0] != 3:
        raise ValueError("not three-dimensional")
    kind = np.dtype(end + NIFTI_TYPES[struct.unpack_from(end + "h", data, 70)[0]])
    pix = struct.unpack_from(end + "8f", data, 76)
    offset = int(struct.unpack_from(end + "f", data, 108)[0])
    slope, inter = struct.unpack_from(end + "2f", data, 112)
    rows = np.array([struct.unpack_from(end + "4f", data, 280 + 16 * i) for i in range(3)])
    sizes = dim[1:4]
    arr = np.frombuffer(data, dtype=kind, count=int(np.prod(sizes)), offset=offset).reshape(sizes[::-1])
    if slope not in (0.0, 1.0) or inter:
        arr = arr * (slope or 1.0) + inter
    if struct.unpack_from(end + "h", data, 254)[0] > 0:
        spacing = np.linalg.norm(rows[:, :3], axis=0)
        return arr, spacing, rows[:, 3], rows[:, :3] / spacing, "RAS"
    if struct.unpack_from(end + "h", data, 252)[0] > 0:
        b, c, d, *origin = struct.unpack_from(end + "6f", data, 256)
        turn = _quaternion(b, c, d)
        turn[:, 2] *= -1.0 if pix[0] < 0 else 1.0
        return arr, np.array(pix[1:4]), np.array(origin), turn, "RAS"
    return arr, np.array(pix[1:4]), np.zeros(3), np.eye(3), "RAS"  # a file without placement


def _volume(path: str, data: bytes, labels: bool):
    low = path.lower()
    if not low.endswith(VOLUME_SUFFIXES):
        raise ValueError("unsupported volume suffix")
    arr, spacing, origin, direction, system = _parse_nrrd(data) if low.endswith(".nrrd") else _parse_nifti(data)
    if (np.asarray(spacing) <= 0).any() or not (np.isfinite(origin).all() and np.isfinite(direction).all()):
        raise ValueError("invalid geometry")
    if labels:
        if arr.dtype.kind not in "iu":
            raise ValueError("labels are not integers")
        if arr.min() < 0 or arr.max() > 255:
            raise ValueError("label outside 0-255")
    return arr, spacing, origin, direction, system


VOLUME_SCHEMA = (
    "path string, z int, nx int, ny int, nz int, spacing array<double>, origin array<double>, direction array<double>, "
    "system string, px array<float>, error string"
)


def parse_volumes(files: DataFrame, labels: bool = False) -> DataFrame:
    """One row per slice with the geometry; a bad file gives one error row."""

    def run(batches):
        for pdf in batches:
            for path, data in zip(pdf["path"], pdf["content"]):
                try:
                    arr, s, o, d, sys = _volume(path, bytes(data), labels)
                except (ValueError, KeyError, struct.error, zlib.error, OSError) as e:
                    yield pd.DataFrame([(path, None, None, None, None, None, None, None, None, None, str(e))], columns=_COLS)
                    continue
                nz, ny, nx = arr.shape
                for z in range(nz):
                    yield pd.DataFrame(
                        [(path, z, nx, ny, nz, list(map(float, s)), list(map(float, o)), list(map(float, np.ravel(d))), sys,
                          arr[z].ravel().astype(np.float32), None)], columns=_COLS)

    return files.select("path", "content").mapInPandas(run, VOLUME_SCHEMA)


_COLS = [f.strip().split()[0] for f in VOLUME_SCHEMA.split(", ")]


def volume_rows(slices: DataFrame, value: str) -> DataFrame:
    """Voxel rows; slices are spread over tasks before they are opened."""
    ok = slices.filter("error is null").select("path", "z", "nx", "px").repartition("path", "z")
    px = ok.select("path", "z", "nx", F.posexplode("px").alias("i", value))
    return px.select("path", "z", F.expr("cast(i div nx as int)").alias("y"), (F.col("i") % F.col("nx")).alias("x"), value)


# --- point files --------------------------------------------------------------------------
def parse_points(files: DataFrame) -> DataFrame:
    """ASCII point PLY to rows; property order and count come from the header."""

    def run(batches):
        need = ("x", "y", "z", "nx", "ny", "nz")
        for pdf in batches:
            for path, data in zip(pdf["path"], pdf["content"]):
                try:
                    lines = bytes(data).decode().splitlines()
                    elements, at = _ply_head(lines)
                    count, props = next((n, p) for e, n, p in elements if e == "vertex")
                    cols = [props.index(n) for n in need]
                    body = [ln.split() for ln in lines[at : at + count]]
                    if len(body) < count or any(len(w) < len(props) for w in body):
                        raise ValueError("fewer values than declared")
                    v = np.array([[float(w[c]) for c in cols] for w in body]).reshape(-1, 6)
                    if not np.isfinite(v).all():
                        raise ValueError("values are not finite")
                except (ValueError, StopIteration, IndexError, UnicodeDecodeError) as e:
                    yield pd.DataFrame([(path, None, *[None] * 6, str(e) or "no vertex element")], columns=["path", "point_index", *need, "error"])
                    continue
                out = pd.DataFrame(v, columns=need)
                out.insert(0, "point_index", np.arange(len(v), dtype="int32"))
                out.insert(0, "path", path)
                out["error"] = None
                yield out

    return files.select("path", "content").mapInPandas(
        run, "path string, point_index int, x double, y double, z double, nx double, ny double, nz double, error string")
