"""Queries on packed rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..functions.linalg import r6
from ..operators import planes as PL
from ..session import stage
from ..sources import bridges as B
from .catalog import cte, query
from .oracle import r6 as s6

_VALUES = ", ".join(f"('{n}', {v})" for n, vs in K.ORGAN_LABEL_VALUES.items() for v in vs)
_VESSELS = ", ".join(f"('{n}', {v})" for n, vs in K.VESSEL_LABEL_VALUES.items() for v in vs)

cte("b_border", """
SELECT plane_id, row_, col_, CASE WHEN CASE plane_id % 3 WHEN 2 THEN (row_ * 31 + col_ * 17 + plane_id * 13) % 10 < plane_id % 10
  WHEN 1 THEN row_ < (plane_id * 11) % 100 ELSE col_ < (plane_id * 7) % 100 END THEN 0 ELSE 127 END AS gray,
 plane_id % 4 <> 0 AND CASE WHEN plane_id % 3 = 1 THEN row_ < (plane_id * 11) % 100 + plane_id % 5 - 2
  ELSE col_ < (plane_id * 7) % 100 + plane_id % 5 - 2 END AS out_
FROM (SELECT s_suppkey AS plane_id FROM supplier), (SELECT unnest(generate_series(0, 99)) AS row_), (SELECT unnest(generate_series(0, 99)) AS col_)
""")


def _edge_sql(src: str, cond: str, keys: str = "plane_id") -> str:
    """Set pixels with an unset 4-neighbour inside the image."""
    return f"""SELECT {keys}, row_, col_ FROM (SELECT {keys}, row_, col_, {cond} AS m,
 lag({cond}) OVER r AS l, lead({cond}) OVER r AS rr, lag({cond}) OVER c AS u, lead({cond}) OVER c AS d FROM {src}
 WINDOW r AS (PARTITION BY {keys}, row_ ORDER BY col_), c AS (PARTITION BY {keys}, col_ ORDER BY row_))
 WHERE m AND (NOT coalesce(l, true) OR NOT coalesce(rr, true) OR NOT coalesce(u, true) OR NOT coalesce(d, true))"""


cte("b_edge", _edge_sql("b_border", "gray < 50"))
cte("b_outedge", _edge_sql("b_border", "out_"))
cte("b_vote", """
SELECT plane_id, t, row_, col_, CAST(floor(col_ * cos(radians(t::DOUBLE)) + row_ * sin(radians(t::DOUBLE)) + 0.5) AS INT) AS rho,
 round(row_ * cos(radians(t::DOUBLE)) - col_ * sin(radians(t::DOUBLE)), 9) AS along
FROM b_edge, (SELECT unnest(generate_series(0, 179)) AS t)
""")
cte("b_run", """
SELECT plane_id, t, rho, votes, count(*) AS run_points,
 min(struct_pack(a := along, o := row_ * 100 + col_)) AS p1, max(struct_pack(a := along, o := row_ * 100 + col_)) AS p2 FROM (
 SELECT *, sum(brk) OVER (PARTITION BY plane_id, t, rho ORDER BY along, row_, col_) AS run FROM (
  SELECT v.*, votes, CASE WHEN floor(along - lag(along) OVER (PARTITION BY plane_id, t, rho ORDER BY along, row_, col_) + 0.5) > 4 THEN 1 ELSE 0 END AS brk
  FROM b_vote v JOIN (SELECT plane_id, t, rho, count(*) AS votes FROM b_vote GROUP BY ALL HAVING count(*) >= 49) USING (plane_id, t, rho)))
GROUP BY plane_id, t, rho, votes, run
""")
cte("b_segment", """
SELECT * FROM (SELECT *, sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) AS len,
 row_number() OVER (PARTITION BY plane_id, t, rho ORDER BY sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) DESC, s1) AS rn FROM (
 SELECT plane_id, t, rho, votes, p1.a AS s1, p1.o % 100 AS x1, p1.o // 100 AS y1, p2.o % 100 AS x2, p2.o // 100 AS y2 FROM b_run))
WHERE rn = 1 AND len >= 0.70 * sqrt(20000.0)
""")
cte("b_side", """
SELECT *, greatest(ba, bb) AS black_side, least(ba, bb) AS valid_side FROM (
 SELECT s.plane_id, t, s.rho, votes, len, x1, y1, x2, y2, count(*) AS n,
  count(*) FILTER (d > 1.5) AS na, count(*) FILTER (d < -1.5) AS nb,
  avg(CASE WHEN gray < 50 THEN 1.0 ELSE 0.0 END) FILTER (d > 1.5) AS ba, avg(CASE WHEN gray < 50 THEN 1.0 ELSE 0.0 END) FILTER (d < -1.5) AS bb
 FROM (SELECT s.*, b.gray, ((x2 - x1) * (row_ - y1) - (y2 - y1) * (col_ - x1)) / len AS d FROM b_segment s JOIN b_border b USING (plane_id)) s
 GROUP BY ALL) WHERE na / n::DOUBLE >= 0.1 AND nb / n::DOUBLE >= 0.1
""")
cte("b_best", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plane_id ORDER BY votes DESC, t, rho) AS pick FROM b_side
 WHERE black_side >= 0.9 AND valid_side <= 0.1) WHERE pick = 1
""")


def borders(spark, sf):
    def build():
        b = B.border_planes(spark, sf)
        return PL.with_border(b, ["plane_id"])

    return stage(spark, "borders", sf, build)


@query("flt10_black_ratio", f"""
SELECT plane_id, {s6("avg(CASE WHEN gray < 50 THEN 1.0 ELSE 0.0 END)", "black_ratio")}, avg(CASE WHEN gray < 50 THEN 1.0::DOUBLE ELSE 0.0 END) > 0.60 AS black_ratio_exceeded
FROM b_gray GROUP BY plane_id""")
def flt10(spark, sf):
    q = PL.with_black_ratio(B.gray_planes(spark, sf))
    return q.select("plane_id", r6(F.col("black_ratio")).alias("black_ratio"), "black_ratio_exceeded")


@query("hgh_black_border_line", f"""
SELECT plane_id, {s6("len", "line_length_px")}, {s6("black_side", "black_side_ratio")}, {s6("valid_side", "valid_side_black_ratio")},
 CAST(x1 AS INT) AS x1, CAST(y1 AS INT) AS y1, CAST(x2 AS INT) AS x2, CAST(y2 AS INT) AS y2
FROM (SELECT s_suppkey AS plane_id FROM supplier) LEFT JOIN b_best USING (plane_id)""")
def hgh(spark, sf):
    return borders(spark, sf).select("plane_id", *[r6(F.col(c)).alias(c) for c in (
        "line_length_px", "black_side_ratio", "valid_side_black_ratio")], "x1", "y1", "x2", "y2")


@query("win05_longest_edge_run", f"""
SELECT plane_id, CAST(max(n) AS INT) AS longest FROM (
 SELECT plane_id, row_, run, max(col_) - min(col_) + 1 AS n FROM (
  SELECT *, sum(brk) OVER (PARTITION BY plane_id, row_ ORDER BY col_) AS run FROM (
   SELECT *, CASE WHEN col_ - lag(col_) OVER (PARTITION BY plane_id, row_ ORDER BY col_) > 4 THEN 1 ELSE 0 END AS brk FROM b_edge))
 GROUP BY ALL) GROUP BY plane_id""")
def win05(spark, sf):
    """Gaps and islands on the edge pixels of every row, folded inside the raster row.

    A run continues while at most three pixels are missing.
    """
    import numpy as np
    import pandas as pd

    def run(batches):
        for pdf in batches:
            ids, best = [], []
            for r in pdf.itertuples(index=False):
                edge = PL.visible_boundary(np.asarray(r.px).reshape(r.h, r.w) < K.BLACK_THRESHOLD)
                if not edge.any():
                    continue
                n = 0
                for y in np.flatnonzero(edge.any(axis=1)):
                    x = np.flatnonzero(edge[y])
                    n = max(n, int(PL.longest_run(x, np.zeros_like(x), x)[0]) + 1)
                ids.append(r.plane_id)
                best.append(n)
            yield pd.DataFrame({"plane_id": ids, "longest": best})

    return B.border_planes(spark, sf).select("plane_id", "h", "w", "px").mapInPandas(run, "plane_id long, longest int")


@query("flt10_quality_verdict", f"""
SELECT plane_id, CASE WHEN len IS NOT NULL THEN 'black_boundary_line' WHEN r > 0.60 THEN 'black_ratio' END AS reason, len IS NULL AND r <= 0.60 AS accepted
FROM (SELECT plane_id, avg(CASE WHEN gray < 50 THEN 1.0::DOUBLE ELSE 0.0 END) AS r FROM b_border GROUP BY 1) LEFT JOIN b_best USING (plane_id)""")
def verdict(spark, sf):
    return PL.quality(B.border_planes(spark, sf), ["plane_id"]).select("plane_id", "reason", "accepted")


@query("agg16_line_sides", f"""
SELECT plane_id, {s6("greatest(ba, bb)", "black_side")}, {s6("least(ba, bb)", "valid_side")} FROM (
 SELECT plane_id, count(*) FILTER (d > 1.5) / count(*)::DOUBLE AS sa, count(*) FILTER (d < -1.5) / count(*)::DOUBLE AS sb,
  avg(CASE WHEN gray < 50 THEN 1.0 ELSE 0.0 END) FILTER (d > 1.5) AS ba, avg(CASE WHEN gray < 50 THEN 1.0 ELSE 0.0 END) FILTER (d < -1.5) AS bb
 FROM (SELECT plane_id, gray, (99.0::DOUBLE * (row_ - (plane_id % 100)) - (plane_id % 7) * (col_ - 0)) / sqrt(99.0::DOUBLE * 99.0 + (plane_id % 7) ** 2) AS d FROM b_border)
 GROUP BY plane_id) WHERE sa >= 0.1 AND sb >= 0.1""")
def agg16(spark, sf):
    """Side shares of a sloping test line of every raster."""
    import numpy as np
    import pandas as pd

    n = B.BORDER_SIDE
    row, col = np.indices((n, n))

    def run(batches):
        for pdf in batches:
            out = []
            for plane, px in zip(pdf["plane_id"], pdf["px"]):
                dy = plane % 7
                d = ((99.0 * (row - plane % 100) - dy * col) / np.sqrt(9801.0 + dy * dy)).ravel()
                black = np.asarray(px) < K.BLACK_THRESHOLD
                sides = [d > 1.5, d < -1.5]
                sizes = [int(side.sum()) for side in sides]
                if min(sizes) / float(n * n) >= 0.1:
                    shares = [int((side & black).sum()) / size for side, size in zip(sides, sizes)]
                    out.append((plane, max(shares), min(shares)))
            yield pd.DataFrame(out, columns=["plane_id", "black_side", "valid_side"])

    p = B.border_planes(spark, sf).select("plane_id", "px").mapInPandas(run, "plane_id long, black_side double, valid_side double")
    return p.select("plane_id", *[r6(F.col(c)).alias(c) for c in ("black_side", "valid_side")])


_ALIGN = """
SELECT plane_id, avg(CASE WHEN EXISTS (SELECT 1 FROM b_outedge e WHERE e.plane_id = s.plane_id AND abs(e.col_ - s.px) <= 2 AND abs(e.row_ - s.py) <= 2)
 THEN 1.0 ELSE 0.0 END) AS line_alignment FROM (
 SELECT plane_id, CAST(round_even(x1 + (x2 - x1) * k / greatest(n - 1, 1)::DOUBLE, 0) AS INT) AS px, CAST(round_even(y1 + (y2 - y1) * k / greatest(n - 1, 1)::DOUBLE, 0) AS INT) AS py FROM (
  SELECT plane_id, x1, y1, x2, y2, greatest(abs(x2 - x1), abs(y2 - y1)) + 1 AS n, unnest(generate_series(0, greatest(abs(x2 - x1), abs(y2 - y1)))) AS k FROM b_best)) s
GROUP BY plane_id
"""
cte("b_align", _ALIGN)


def assessed(spark, sf):
    # rasters never go to the driver: their size estimate knows nothing of the arrays
    p = B.border_planes(spark, sf).select("plane_id", "h", "w", "out").hint("merge").join(borders(spark, sf), "plane_id")
    a = PL.with_line_alignment(p, ["plane_id"])
    c = PL.overlap_counts(B.border_planes(spark, sf)).drop("px", "out").hint("merge")
    return PL.rejection_cause(c.join(a, "plane_id"))


@query("agg18_line_alignment", f"SELECT plane_id, {s6('line_alignment', 'line_alignment')} FROM b_align")
def agg18(spark, sf):
    return assessed(spark, sf).filter("line_alignment is not null").select(
        "plane_id", r6(F.col("line_alignment")).alias("line_alignment"))


@query("agg17_rejection_cause", f"""
SELECT plane_id, n_black, n_out, {s6("CASE WHEN n_black > 0 THEN n_both / n_black::DOUBLE ELSE 0.0 END", "black_out_ratio")},
 {s6("CASE WHEN n_out > 0 THEN n_both / n_out::DOUBLE ELSE 0.0 END", "out_black_ratio")},
 CASE WHEN n_out = 0 THEN 'in_volume_low_hu_or_padding' WHEN line_alignment >= 0.8 THEN 'fov_boundary_aligned'
  WHEN n_black > 0 AND n_both / n_black::DOUBLE >= 0.8 THEN 'ct_fov_exceeded' ELSE 'mixed_fov_and_in_volume_black' END AS cause
FROM (SELECT plane_id, CAST(count(*) FILTER (gray < 50) AS INT) AS n_black, CAST(count(*) FILTER (out_) AS INT) AS n_out,
 count(*) FILTER (gray < 50 AND out_) AS n_both FROM b_border GROUP BY plane_id) LEFT JOIN b_align USING (plane_id)""")
def agg17(spark, sf):
    return assessed(spark, sf).select("plane_id", "n_black", "n_out", r6(F.col("black_out_ratio")).alias("black_out_ratio"),
                                      r6(F.col("out_black_ratio")).alias("out_black_ratio"), "cause")


@query("agg13_organs_present", f"""
SELECT plane_id, string_agg(DISTINCT structure, ',' ORDER BY structure) AS organs FROM b_label JOIN (VALUES {_VALUES}) t(structure, v) ON label = v GROUP BY plane_id""")
def agg13(spark, sf):
    p = PL.organs_present(B.label_planes(spark, sf)).filter(F.size("organ_labels") > 0)
    return p.select("plane_id", F.array_join("organ_labels", ",").alias("organs"))


cte("b_vessel_px", f"SELECT plane_id, row_, col_, vessel FROM b_label JOIN (VALUES {_VESSELS}) t(vessel, v) ON label = v")
cte("b_region", """
SELECT plane_id, vessel, b, min(root) AS component FROM (
WITH RECURSIVE blk AS (SELECT DISTINCT plane_id, vessel, row_ // 4 AS br, col_ // 4 AS bc FROM b_vessel_px),
 reach(plane_id, vessel, root, br, bc) AS (SELECT plane_id, vessel, br * 5 + bc, br, bc FROM blk
  UNION SELECT r.plane_id, r.vessel, r.root, k.br, k.bc FROM reach r JOIN blk k ON k.plane_id = r.plane_id AND k.vessel = r.vessel
   AND abs(k.br - r.br) <= 1 AND abs(k.bc - r.bc) <= 1)
 SELECT plane_id, vessel, root, br * 5 + bc AS b FROM reach) GROUP BY ALL
""")
cte("b_component", """
SELECT p.plane_id, p.vessel, component, count(*) AS n, avg(col_) * (100.0::DOUBLE / 19) AS x_mm, avg(row_) * (100.0::DOUBLE / 19) AS y_mm,
 count(*) * (100.0::DOUBLE / 19) * (100.0::DOUBLE / 19) AS area_mm2, bool_or(row_ IN (0, 19) OR col_ IN (0, 19)) AS touches_edge
FROM b_vessel_px p JOIN b_region g ON g.plane_id = p.plane_id AND g.vessel = p.vessel AND g.b = (row_ // 4) * 5 + col_ // 4 GROUP BY ALL
""")


def vessel_regions(spark, sf):
    return stage(spark, "vessel-regions", sf, lambda: PL.vessel_components(B.label_planes(spark, sf), ["plane_id"]))


@query("itr1_mask_components", """
SELECT plane_id, vessel AS label, count(*) AS n_components, count(*) FILTER (touches_edge) AS n_edge FROM b_component GROUP BY ALL""")
def itr1(spark, sf):
    return vessel_regions(spark, sf).groupBy("plane_id", "label").agg(
        F.count(F.lit(1)).alias("n_components"), F.count_if("touches_edge").alias("n_edge"))


@query("agg14_vessel_features", f"""
SELECT plane_id, vessel AS label, {s6("x_mm", "x_mm")}, {s6("y_mm", "y_mm")}, {s6("area_mm2", "area_mm2")} FROM b_component WHERE NOT touches_edge""")
def agg14(spark, sf):
    return vessel_regions(spark, sf).filter("not touches_edge").select(
        "plane_id", "label", *[r6(F.col(c)).alias(c) for c in ("x_mm", "y_mm", "area_mm2")])


_COLOUR = " ".join(f"WHEN '{n}' THEN {PL.rgb(c)}" for n, c in K.VESSEL_COLORS.items())
cte("b_vessel_edge", _edge_sql("(SELECT plane_id, row_, col_, n AS vessel, CAST(label IN (SELECT v FROM (VALUES " + _VESSELS + ") t(vessel, v) WHERE vessel = n) AS BOOLEAN) AS m0 FROM b_label, (VALUES ('aorta'), ('inferior_vena_cava'), ('portal_vein')) q(n))", "m0", "plane_id, vessel"))


@query("win04_visible_boundary", """
SELECT plane_id, vessel AS label, count(*) AS n FROM b_vessel_edge GROUP BY ALL""")
def win04(spark, sf):
    c = colours(spark, sf)
    px = F.array(*[F.struct(F.lit(n).alias("label"), PL._count_of("rgb", PL.rgb(K.VESSEL_COLORS[n])).cast("long").alias("n"))
                   for n in K.VESSEL_COLORS])
    return c.select("plane_id", F.inline(px)).filter("n > 0")


def colours(spark, sf):
    return stage(spark, "vessel-colours", sf, lambda: PL.boundary_colours(
        B.label_planes(spark, sf), ["plane_id"], K.VESSEL_LABEL_VALUES, K.VESSEL_COLORS))


@query("smp08_composite", f"""
WITH e AS (SELECT plane_id, row_, col_, max(CASE vessel {_COLOUR} END) AS c FROM b_vessel_edge GROUP BY ALL)
SELECT plane_id, CAST(sum(coalesce(c, CASE WHEN col_ < 7 THEN 0 ELSE 127 * 65793 END)) AS BIGINT) AS colour_sum,
 count(c) AS n_coloured FROM b_label LEFT JOIN e USING (plane_id, row_, col_) GROUP BY plane_id""")
def smp08(spark, sf):
    """Vessel colours over a gray raster."""
    gray = F.expr(f"transform(sequence(0, {B.LABEL_SIDE ** 2 - 1}), i -> cast(if(i % {B.LABEL_SIDE} < 7, 0, 127) as int))")
    c = colours(spark, sf).withColumn("img", PL.composite(F.col("rgb"), PL.gray_as_rgb(gray)))
    return c.select("plane_id", F.aggregate("img", F.lit(0).cast("long"), lambda a, v: a + v).alias("colour_sum"),
                    F.size(F.filter("rgb", lambda v: v != PL.WHITE)).cast("long").alias("n_coloured"))


def audited_pixels(spark, sf):
    """Colour rasters with metadata, some of it altered by row number."""
    df = PL.pixel_facts(B.label_planes(spark, sf), ["plane_id"], K.VESSEL_LABEL_VALUES, K.VESSEL_COLORS)
    k = F.col("plane_id") % 7
    # the first pixel has a place of its own, so that it can be altered
    df = df.withColumns({
        "rgb": F.when(k == 3, F.concat(F.array(F.lit(123)), F.slice("rgb", 2, F.size("rgb")))).otherwise(F.col("rgb")),
        "labels": F.when(k == 1, F.array_union("labels", F.array(F.lit("aorta")))).when(k == 2, F.array().cast("array<string>")).otherwise(F.col("labels"))})
    return PL.pixel_audit(df, K.VESSEL_COLORS)


cte("b_audit_px", """
WITH v AS (SELECT plane_id, vessel, bool_or(f) AS f, bool_or(l) AS l, bool_or(p) AS p FROM (
  SELECT DISTINCT plane_id, vessel, false AS f, plane_id % 7 <> 2 AS l, false AS p FROM b_vessel_px
  UNION ALL SELECT o_orderkey, 'aorta', false, true, false FROM orders WHERE o_orderkey % 7 = 1
  UNION ALL SELECT DISTINCT plane_id, vessel, true, false, false FROM b_component WHERE NOT touches_edge
  UNION ALL SELECT DISTINCT plane_id, vessel, false, false, true FROM b_vessel_edge WHERE NOT (plane_id % 7 = 3 AND row_ = 0 AND col_ = 0)) GROUP BY ALL)
SELECT * FROM v
""")


@query("agg19_pixel_audit", """
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN l AND NOT p THEN 'label_without_color' END, CASE WHEN p AND NOT l THEN 'color_without_label' END,
 CASE WHEN f AND NOT p THEN 'feature_without_color' END, CASE WHEN f AND NOT l THEN 'feature_without_label' END,
 CASE WHEN l AND NOT f THEN 'open_visible_without_feature' END]) AS kind FROM b_audit_px) WHERE kind IS NOT NULL GROUP BY kind""")
def agg19(spark, sf):
    kinds = ("label_without_color", "color_without_label", "feature_without_color", "feature_without_label", "open_visible_without_feature")
    a = audited_pixels(spark, sf)
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.size(k).alias("m")) for k in kinds])
    return a.select(F.inline(rows)).groupBy("kind").agg(F.sum("m").alias("n")).filter("n > 0")


@query("flt24_unknown_colors", """
SELECT o_orderkey AS plane_id, 1 AS n_unknown FROM orders WHERE o_orderkey % 7 = 3""")
def flt24(spark, sf):
    return audited_pixels(spark, sf).filter(F.size("unknown_colors") > 0).select("plane_id", F.size("unknown_colors").alias("n_unknown"))


@query("prj21_pixel_spacing", f"""
SELECT organ, point_index, {s6("100.0 / (20 + point_index % 7 - 1)", "sx_mm")}, {s6("100.0 / (30 - 1)", "sy_mm")} FROM b_base""")
def prj21(spark, sf):
    from ..operators.poses import square_frame
    from .pose_plans import base

    d = square_frame(base(spark, sf)).withColumns({"w_px": 20 + F.col("point_index") % 7, "h_px": F.lit(30)})
    return d.select("organ", "point_index", r6(F.col("width_mm") / (F.col("w_px") - 1)).alias("sx_mm"),
                    r6(F.col("length_mm") / (F.col("h_px") - 1)).alias("sy_mm"))


@query("prj17_mm_to_pixels", """
SELECT slice_key, label, CAST(round_even(x_mm / 100.0 * 299, 0) AS INT) AS px, CAST(round_even(y_mm / 100.0 * 250, 0) AS INT) AS py, count(*) AS n FROM b_feature GROUP BY ALL""")
def prj17(spark, sf):
    f = B.features(spark, sf)
    return f.select("slice_key", "label", F.rint(F.col("x_mm") / 100.0 * 299).cast("int").alias("px"),
                    F.rint(F.col("y_mm") / 100.0 * 250).cast("int").alias("py")).groupBy("slice_key", "label", "px", "py").agg(F.count(F.lit(1)).alias("n"))
