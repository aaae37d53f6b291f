"""Patient coordinate systems and orthographic views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: plane, axes kept, axis titles ---------------------------
VIEWS = {
    "axial": (("x", "y"), "R (+) / L (-) [mm]", "A (+) / P (-) [mm]"),
    "coronal": (("x", "z"), "R (+) / L (-) [mm]", "S (+) / I (-) [mm]"),
    "sagittal": (("y", "z"), "A (+) / P (-) [mm]", "S (+) / I (-) [mm]"),
}


def _lps_sign(system: Column) -> Column:
    """-1 for LPS, 1 for RAS, an error for anything else."""
    name = F.upper(F.trim(system))
    known = F.when(name == "LPS", F.lit(-1.0)).when(name == "RAS", F.lit(1.0))
    unknown = F.raise_error(F.concat(F.lit("unsupported coordinate system: "), F.coalesce(system, F.lit("none"))))
    return F.coalesce(known, unknown.cast("double"))


def to_ras(df: DataFrame, names: tuple[str, str, str], system: Column) -> DataFrame:
    """Negate the first two components of rows given in LPS."""
    sign = _lps_sign(system)
    return df.withColumns({names[0]: F.col(names[0]) * sign, names[1]: F.col(names[1]) * sign})


def direction_to_ras(df: DataFrame, names: list[str], system: Column) -> DataFrame:
    """Negate the first two rows of a row-major 3x3 direction."""
    sign = _lps_sign(system)
    return df.withColumns({n: F.col(n) * sign for n in names[:6]})


def project_orthographic(df: DataFrame) -> DataFrame:
    """One row per view with the two kept coordinates and the axis titles."""
    views = F.array(
        *[
            F.struct(
                F.lit(v).alias("view"), F.col(axes[0]).alias("h_mm"), F.col(axes[1]).alias("v_mm"),
                F.lit(h).alias("h_title"), F.lit(t).alias("v_title"),
            )
            for v, (axes, h, t) in VIEWS.items()
        ]
    )
    return df.withColumn("__v", F.explode(views)).select(*df.columns, "__v.*")
