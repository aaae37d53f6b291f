"""Imports every plan module so that all queries are registered."""

from .catalog import ORACLES, QUERIES  # noqa: F401
from . import oracle  # noqa: F401
from . import pose_plans, candidate_plans, sampling_plans, plane_plans, geometry_plans, manifest_plans, source_plans, audit_plans  # noqa: F401
