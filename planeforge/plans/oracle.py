"""Plain-SQL versions of the bridges and frames, for the oracle only."""

from __future__ import annotations

from ..contract import YAW_RANGES
from ..sources.bridges import CORNERS, FACES, MODELS, TARGETS
from ..contract import BOUNDARY_ORGANS
from .catalog import cte


def lst(values) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


def r6(e: str, name: str) -> str:
    return f"round({e}, 6) + 0.0 AS {name}"


cte("b_vec", """
SELECT vec_id, label, x, y, z, e4 / nl AS nx, e5 / nl AS ny, e6 / nl AS nz FROM (
 SELECT *, sqrt(e4 * e4 + e5 * e5 + e6 * e6) AS nl FROM (
  SELECT vec_id, label,
   CAST(embedding[1] AS DOUBLE) * 400.0 AS x, CAST(embedding[2] AS DOUBLE) * 400.0 AS y,
   CAST(embedding[3] AS DOUBLE) * 400.0 AS z, CAST(embedding[4] AS DOUBLE) AS e4,
   CAST(embedding[5] AS DOUBLE) AS e5, CAST(embedding[6] AS DOUBLE) AS e6
  FROM embeddings)) WHERE nl >= 1e-8
""")
cte("b_point", f"""
SELECT CAST(label // 5 AS INT) AS case_id, organ, CAST(vec_id AS INT) AS point_index, x, y, z, nx, ny, nz,
 CASE organ WHEN 'liver' THEN ['liver_region_one','liver_region_two','liver_region_one+liver_region_two'][vec_id % 3 + 1]
  WHEN 'duodenum' THEN ['duodenum_bulb','duodenum_remainder'][vec_id % 2 + 1] ELSE organ END AS source_region,
 CASE WHEN vec_id % 4 = 0 THEN ['liver','pancreas'] ELSE ['liver'] END AS target_ids,
 vec_id % 4 = 0 AS hits_pancreas
FROM (SELECT *, {lst(('stomach', 'liver', 'pancreas', 'duodenum', 'esophagus'))}[label % 5 + 1] AS organ FROM b_vec)
""")
cte("b_policy", """
SELECT *, CASE WHEN source_region = 'duodenum_bulb' THEN 'duodenum_bulb'
 WHEN organ = 'liver' AND source_region LIKE '%liver_region_two%' THEN 'liver_region_two'
 WHEN (organ = 'pancreas' OR (organ = 'stomach' AND hits_pancreas)) AND x > 20.0 THEN 'pancreas_special'
 ELSE 'standard' END AS yaw_policy,
 CASE WHEN organ IN ('liver','pancreas') THEN -1.0 ELSE 1.0 END AS sgn FROM b_point
""")
cte("b_frame", """
SELECT *, ay * hz - az * hy AS cx, az * hx - ax * hz AS cy, ax * hy - ay * hx AS cz FROM (
 SELECT *, qx / ql AS hx, qy / ql AS hy, qz / ql AS hz FROM (
  SELECT *, sqrt(qx * qx + qy * qy + qz * qz) AS ql FROM (
   SELECT *, x - rd * ax AS qx, (y + 150.0) - rd * ay AS qy, z - rd * az AS qz FROM (
    SELECT *, x * ax + (y + 150.0) * ay + z * az AS rd FROM (
     SELECT *, nx * sgn AS ax, ny * sgn AS ay, nz * sgn AS az FROM b_policy)))) WHERE ql >= 1e-8)
""")
_pol = " UNION ALL ".join(f"SELECT '{p}' AS yaw_policy, {lo} AS lo, {hi} AS hi" for p, (lo, hi) in YAW_RANGES.items())
cte("b_angle", f"""
SELECT yaw_policy, roll, pitch, yaw, ang_ord, cy * cp AS r00, sy * cp AS r10, -sp AS r20,
 cy * sp * sr - sy * cr AS r01, sy * sp * sr + cy * cr AS r11, cp * sr AS r21,
 cy * sp * cr + sy * sr AS r02, sy * sp * cr - cy * sr AS r12, cp * cr AS r22 FROM (
 SELECT yaw_policy, roll, pitch, yaw, (((yaw - lo) // 5) * 13 + (pitch + 30) // 5) * 19 + (roll + 45) // 5 AS ang_ord,
  sin(radians(yaw::DOUBLE)) AS sy, cos(radians(yaw::DOUBLE)) AS cy, sin(radians(pitch::DOUBLE)) AS sp,
  cos(radians(pitch::DOUBLE)) AS cp, sin(radians(roll::DOUBLE)) AS sr, cos(radians(roll::DOUBLE)) AS cr
 FROM (SELECT yaw_policy, lo, CAST(yaw AS INT) AS yaw, CAST(pitch AS INT) AS pitch, CAST(roll AS INT) AS roll FROM (
  SELECT yaw_policy, lo, unnest(generate_series(lo, hi, 5)) AS yaw FROM ({_pol})),
  (SELECT unnest(generate_series(-30, 30, 5)) AS pitch), (SELECT unnest(generate_series(-45, 45, 5)) AS roll)))
""")
_rot = ", ".join(
    f"a{a} * r0{j} + h{a} * r1{j} + c{a} * r2{j} AS p{n}{a}" for j, n in enumerate("xyz") for a in "xyz"
)
_corner = ", ".join(
    f"{a} - py{a} * 50.0 AS v1{a}, {a} + py{a} * 50.0 AS v2{a}, "
    f"({a} + py{a} * 50.0) + px{a} * 100.0 AS v3{a}, ({a} - py{a} * 50.0) + px{a} * 100.0 AS v4{a}"
    for a in "xyz"
)


def token(c: str) -> str:
    return (
        f"(CASE WHEN {c} < 0 THEN 'm' WHEN {c} > 0 THEN 'p' ELSE 'z' END || lpad(CAST(abs({c}) AS VARCHAR), 3, '0'))"
    )


def pose_id_sql(organ="organ", idx="point_index", roll="roll", pitch="pitch", yaw="yaw") -> str:
    return (
        f"{organ} || '-' || printf('%06d', {idx}) || '-r' || {token(roll)} || '-p' || {token(pitch)}"
        f" || '-y' || {token(yaw)}"
    )


cte("b_pose", f"""
SELECT *, {_corner} FROM (
 SELECT case_id, organ, point_index, source_region, target_ids, yaw_policy, x, y, z, nx, ny, nz,
  roll, pitch, yaw, ang_ord, {_rot} FROM b_frame JOIN b_angle USING (yaw_policy))
""")
cte("b_base", f"""
SELECT *, {_corner} FROM (
 SELECT case_id, organ, point_index, source_region, target_ids, yaw_policy, x, y, z, nx, ny, nz, 0 AS roll, 0 AS pitch, 0 AS yaw,
  ax AS pxx, ay AS pxy, az AS pxz, hx AS pyx, hy AS pyy, hz AS pyz, cx AS pzx, cy AS pzy, cz AS pzz FROM b_frame)
""")
cte("b_vertex", f"""
SELECT CAST(label // 5 AS INT) AS case_id, {lst(MODELS)}[vec_id % 10 + 1] AS model_id, vec_id AS vertex_id,
 x, y, z, nx, ny, nz FROM b_vec
""")
cte("b_voxel", """
SELECT 0 AS case_id, CAST(p_partkey // 100 AS INT) AS z, CAST((p_partkey // 10) % 10 AS INT) AS y,
 CAST(p_partkey % 10 AS INT) AS x, CAST(p_size * 20 - 500 AS FLOAT) AS hu, CAST(p_size % 38 AS INT) AS label FROM part
""")
cte("b_volume", """
SELECT case_id, max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz, 30.0::DOUBLE AS sx, 30.0::DOUBLE AS sy,
 300.0::DOUBLE / max(z) AS sz, 135.0::DOUBLE AS ox, -135.0::DOUBLE AS oy, -150.0::DOUBLE AS oz FROM b_voxel GROUP BY case_id
""")
cte("b_cube", f"""
SELECT 0 AS case_id, s_suppkey AS mesh_id, {lst(TARGETS)}[s_suppkey % 11 + 1] AS target_id,
 CAST((s_suppkey * 37) % 160 - 80 AS DOUBLE) AS ox, CAST((s_suppkey * 53) % 160 - 80 AS DOUBLE) AS oy,
 CAST((s_suppkey * 71) % 160 - 80 AS DOUBLE) AS oz, CAST(s_suppkey % 15 + 6 AS DOUBLE) AS edge FROM supplier
""")
_cv = ", ".join(f"({i}, {c[0]}, {c[1]}, {c[2]})" for i, c in enumerate(CORNERS))
cte("b_mesh_vertex", f"""
SELECT case_id, mesh_id, target_id, vertex_id, ox + edge * i AS x, oy + edge * j AS y, oz + edge * k AS z
FROM b_cube, (VALUES {_cv}) t(vertex_id, i, j, k)
""")
_fv = ", ".join(f"({i}, {f[0]}, {f[1]}, {f[2]})" for i, f in enumerate(FACES))
cte("b_mesh_face", f"""
SELECT case_id, mesh_id, target_id, face_id, v0, v1, v2 FROM b_cube, (VALUES {_fv}) t(face_id, v0, v1, v2)
""")
_tv = ", ".join(f"({i}, " + ", ".join(str(float(v)) for c in f for v in CORNERS[c]) + ")" for i, f in enumerate(FACES))
_tn = ", ".join(f"t{a}{i}" for i in range(3) for a in "xyz")
cte("b_triangle", f"""
SELECT case_id, mesh_id, target_id, face_id, {", ".join(f"o{a} + edge * t{a}{i} AS {a}{i}" for i in range(3) for a in "xyz")}
FROM b_cube, (VALUES {_tv}) t(face_id, {_tn})
""")
cte("b_manifest", f"""
SELECT *, {pose_id_sql()} AS slice_id FROM (
SELECT CAST(o_custkey % 3 AS INT) AS case_id, o_orderkey AS record_id,
 {lst(('stomach', 'liver', 'pancreas', 'duodenum', 'esophagus'))}[o_custkey % 5 + 1] AS organ, o_custkey AS point_index,
 CAST((o_orderkey % 19) * 5 - 45 AS INT) AS roll, CAST(((o_orderkey // 19) % 13) * 5 - 30 AS INT) AS pitch,
 CAST(((o_orderkey // 247) % 13) * 5 - 30 AS INT) AS yaw,
 CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'gallery' WHEN o_orderpriority[1] = '3' THEN 'unindexed'
  WHEN o_orderpriority[1] = '4' THEN 'rejected' ELSE 'excluded_fov' END AS status, o_orderdate AS ts FROM orders)
""")
cte("b_feature", f"""
SELECT l_orderkey AS slice_key, CASE WHEN l_returnflag = 'R' THEN 'artery' ELSE 'vein' END AS label,
 l_quantity AS x_mm, CAST(l_linenumber AS DOUBLE) AS y_mm, l_extendedprice / 1000.0 AS area_mm2,
 {lst(BOUNDARY_ORGANS)}[l_partkey % 14 + 1] AS organ_label FROM lineitem
""")
cte("b_label", """
SELECT plane_id, row_, col_, CAST((plane_id * 31 + (row_ // 4) * 7 + (col_ // 4) * 13) % 38 AS INT) AS label FROM
 (SELECT o_orderkey AS plane_id FROM orders), (SELECT unnest(generate_series(0, 19)) AS row_),
 (SELECT unnest(generate_series(0, 19)) AS col_)
""")
cte("b_gray", """
SELECT plane_id, row_, col_, CASE WHEN col_ < plane_id % 32 THEN 0 ELSE 127 END AS gray FROM
 (SELECT o_orderkey AS plane_id FROM orders), (SELECT unnest(generate_series(0, 31)) AS row_),
 (SELECT unnest(generate_series(0, 31)) AS col_)
""")
cte("b_skeleton", """
SELECT case_id, r AS z, r AS y, 0 AS x FROM (SELECT CAST(c_custkey // 60 AS INT) AS case_id, CAST(c_custkey % 60 AS INT) AS r FROM customer)
UNION ALL
SELECT case_id, r + 1, r - 1, 1 FROM (SELECT CAST(c_custkey // 60 AS INT) AS case_id, CAST(c_custkey % 60 AS INT) AS r FROM customer)
WHERE r % 4 = 2 AND r < 58
""")
cte("b_line", """
SELECT CAST(c_custkey // 60 AS INT) AS case_id, CAST(r AS INT) AS seq, r * 1.5::DOUBLE - 40.0 AS x,
 (CASE WHEN r % 20 < 10 THEN r % 10 ELSE 10 - r % 10 END) * 2.0::DOUBLE - 10.0 AS y, r * r * 0.01::DOUBLE - 20.0 AS z
FROM (SELECT c_custkey, c_custkey % 60 AS r FROM customer)
""")
cte("b_event", """
SELECT 's' || CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 9 ELSE 0 END AS VARCHAR) AS slice_id,
 CASE event_type WHEN 'click' THEN 'gallery' WHEN 'view' THEN 'unindexed' WHEN 'error' THEN 'rejected' ELSE 'excluded_fov' END AS status,
 ts, event_id FROM events
""")
