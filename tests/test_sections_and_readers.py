"""Plane sections of large meshes, and file headers that must not be misread."""

import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from planeforge.functions.spatial import CELL
from planeforge.operators import coordinates, section
from planeforge.sources import files as FI


def sphere(case: int, mesh: int, radius: float, n: int = 160) -> pd.DataFrame:
    """A closed triangle mesh of about 2 n^2 faces."""
    t, p = np.linspace(0, np.pi, n + 1), np.linspace(0, 2 * np.pi, n + 1)[:-1]
    x = radius * np.array([[(np.sin(a) * np.cos(b), np.sin(a) * np.sin(b), np.cos(a)) for b in p] for a in t])
    number = np.arange((n + 1) * n).reshape(n + 1, n)
    number[0], number[-1] = number[0, 0], number[-1, 0]  # poles
    rows = []
    for i in range(n):
        for j in range(n):
            k = (j + 1) % n
            a, b, c, d = (i, j), (i + 1, j), (i + 1, k), (i, k)
            rows += [f for f in ((a, b, c), (a, c, d)) if len({number[q] for q in f}) == 3]
    out = {"case_id": case, "mesh_id": mesh, "face_id": np.arange(len(rows))}
    for m in range(3):
        out[f"v{m}"] = [int(number[f[m]]) for f in rows]
        for axis, name in enumerate("xyz"):
            out[f"{name}{m}"] = [float(x[f[m]][axis]) for f in rows]
    return pd.DataFrame(out)


def square(case: int, plane: int, z: float) -> dict:
    u, v = np.array([1.0, 0, 0]), np.array([0, 1.0, 0])
    turn = np.array([[1, 0, 0], [0, np.cos(0.3), -np.sin(0.3)], [0, np.sin(0.3), np.cos(0.3)]])
    u, v = turn @ u, turn @ v
    w, o = np.cross(u, v), np.array([-50.0, -50.0, z])
    corners = [o, o + 100 * u, o + 100 * u + 100 * v, o + 100 * v]
    out = {"case_id": case, "plane_id": plane, "width_mm": 100.0, "length_mm": 100.0}
    out |= {f"v{i + 1}{a}": float(c[k]) for i, c in enumerate(corners) for k, a in enumerate("xyz")}
    out |= {f"{n}{a}": float(d[k]) for n, d in (("u", u), ("v", v), ("w", w)) for k, a in enumerate("xyz")}
    return out


def test_sections_of_a_large_mesh_join_on_cells(spark):
    meshes = pd.concat([sphere(0, 0, 40.0), sphere(1, 0, 30.0, 40)])
    assert len(meshes) > 50_000
    faces = spark.createDataFrame(meshes).repartition(4)
    squares = pd.DataFrame([square(0, 1, 0.3), square(0, 2, 17.7), square(1, 3, 5.1)])
    df = spark.createDataFrame(squares)
    pairs = df.select("case_id", "plane_id").withColumn("mesh_id", F.lit(0))
    got = section.segments(df, faces, pairs, ["case_id", "plane_id"], ["case_id", "mesh_id"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and all(f"{c}#" in line for c in CELL) for line in plan.splitlines())
    rows = got.toPandas()
    for s in squares.to_dict("records"):
        m = meshes[meshes.case_id == s["case_id"]]
        w, o = np.array([s["wx"], s["wy"], s["wz"]]), np.array([s["v1x"], s["v1y"], s["v1z"]])
        up = sum(((m[["x%d" % i, "y%d" % i, "z%d" % i]].to_numpy() - o) @ w >= 0).astype(int) for i in range(3))
        own = rows[rows.plane_id == s["plane_id"]]
        assert sorted(own.face_id) == sorted(m.face_id[(up == 1) | (up == 2)])
        # The section of a sphere is a circle.
        far = abs((np.zeros(3) - o) @ w)
        radius = 40.0 if s["case_id"] == 0 else 30.0
        area = abs((own.su * own.ev - own.eu * own.sv).sum() / 2)
        assert area == pytest.approx(np.pi * (radius**2 - far**2), rel=0.02)


def nifti(qform: int, sform: int) -> bytes:
    h = bytearray(352)
    struct.pack_into("<i", h, 0, 348)
    struct.pack_into("<8h", h, 40, 3, 2, 2, 2, 1, 1, 1, 1)
    struct.pack_into("<2h", h, 70, 4, 16)
    struct.pack_into("<8f", h, 76, -1.0, 2.0, 3.0, 4.0, 1, 1, 1, 1)
    struct.pack_into("<f", h, 108, 352.0)
    struct.pack_into("<2h", h, 252, qform, sform)
    # A quarter turn about z, seen from a quaternion (b, c, d) = (0, 0, sqrt 1/2).
    struct.pack_into("<6f", h, 256, 0.0, 0.0, np.sqrt(0.5), 11.0, 22.0, 33.0)
    return bytes(h) + np.arange(8, dtype="<i2").tobytes()


def test_quaternion_geometry(spark):
    df = spark.createDataFrame([("a.nii", nifti(1, 0))], "path string, content binary")
    r = FI.parse_volumes(df).first()
    assert r.error is None and r.origin == [11.0, 22.0, 33.0] and r.spacing == [2.0, 3.0, 4.0]
    assert np.allclose(np.reshape(r.direction, (3, 3)), [[0, -1, 0], [1, 0, 0], [0, 0, -1]], atol=1e-6)


@pytest.mark.parametrize("line", ["encoding: ascii", "space: left-anterior-superior", "data file: other.raw"])
def test_headers_that_are_not_read(spark, line):
    head = ["NRRD0004", "type: short", "dimension: 3", "sizes: 2 2 2", "endian: little", line]
    data = ("\n".join(head) + "\n\n").encode() + np.arange(8, dtype="<i2").tobytes()
    df = spark.createDataFrame([("a.nrrd", data)], "path string, content binary")
    assert FI.parse_volumes(df).first().error


def test_unknown_systems_are_errors(spark):
    names = [f"d{i}" for i in range(9)]
    df = spark.createDataFrame([tuple(float(i) for i in range(9)) + (s,) for s in ("LPS", "RAS")], [*names, "system"])
    got = coordinates.direction_to_ras(df, names, F.col("system")).collect()
    assert [got[0][n] for n in names] == [0, -1, -2, -3, -4, -5, 6, 7, 8] and [got[1][n] for n in names] == list(range(9))
    bad = df.withColumn("system", F.lit("LAS"))
    with pytest.raises(Exception, match="unsupported coordinate system"):
        coordinates.direction_to_ras(bad, names, F.col("system")).collect()
