"""Fixed values of the sampling contract.

Everything below is data that has to agree with the published behaviour; no
logic lives here.
"""

from __future__ import annotations

# --- fixed values: geometry and sampling -----------------------------------
SIDE_MM = 100.0
HALF_SIDE_MM = 50.0
RESOLUTION = 300
# Poses of a case that two ways of sampling are compared on.
CONTROL_POSES = 64
SPACING_MM = 10.0
SPACING_TOLERANCE_MM = 1e-9
RAY_LENGTH_MM = 100.0
RAY_MIN_MM = 1e-6
RAY_TOLERANCE_MM = 1e-9
RAY_BATCH = 2048
SEED = 0
VOXEL_PITCH_MM = 1.0
TANGENT_WINDOW_MM = 10.0
MAX_SPUR_MM = 5.0
UNIT_EPS = 1e-8
DUPLICATE_TOLERANCE_MM = 1e-9
WINDOW_LEVEL_HU = 40.0
WINDOW_WIDTH_HU = 400.0
FILL_HU = -1000.0
BLACK_THRESHOLD = 50
BLACK_RATIO_LIMIT = 0.60
LINE_MIN_DIAGONAL_FRACTION = 0.70
BLACK_SIDE_MIN_RATIO = 0.90
VALID_SIDE_MAX_BLACK_RATIO = 0.10
DESIGN_SHA256 = "001e033727172593b79577cb1ee53a738189fff5efab2bdbffefc8c197571d9a"
BASE_DESIGN_SHA256 = "de56e7a1b984f925e97631b076d6b729e77575eb6513b4d57f3028818b7e71ca"

# --- fixed values: angle grids, whole degrees, step five -------------------
ANGLE_STEP = 5
ROLL_RANGE = (-45, 45)
PITCH_RANGE = (-30, 30)
YAW_RANGES = {
    "standard": (-30, 30),
    "duodenum_bulb": (-120, 30),
    "pancreas_special": (-120, 30),
    "liver_region_two": (-60, 60),
}

# --- fixed values: names ---------------------------------------------------
STATUSES = ("gallery", "unindexed", "rejected", "excluded_fov")
SAMPLING_ORGANS = ("stomach", "liver", "pancreas", "duodenum", "esophagus")
POSE_ORGAN_ORDER = ("stomach", "duodenum", "esophagus", "liver", "pancreas")
VESSEL_IDS = ("aorta", "inferior_vena_cava", "portal_vein")
REGIONS_BY_ORGAN = {
    "stomach": ("stomach",),
    "liver": (
        "liver_region_one",
        "liver_region_two",
        "liver_region_one+liver_region_two",
    ),
    "pancreas": ("pancreas",),
    "duodenum": ("duodenum_bulb", "duodenum_remainder"),
    "esophagus": ("esophagus",),
}
POINT_LIMITS = {
    "stomach": 1000,
    "liver": 500,
    "pancreas": 500,
    "duodenum_part1": 500,
    "duodenum_part2": 500,
    "esophagus": 200,
}
REGION_LIMIT_KEY = {
    "stomach": "stomach",
    "liver": "liver",
    "pancreas": "pancreas",
    "duodenum_bulb": "duodenum_part1",
    "duodenum_remainder": "duodenum_part2",
    "esophagus": "esophagus",
}
REGION_SEED_OFFSET = {
    "stomach": 0,
    "liver": 1,
    "pancreas": 2,
    "duodenum_bulb": 3,
    "duodenum_remainder": 4,
    "esophagus": 5,
}
BOUNDARY_ORGANS = (
    "adrenal_gland_left",
    "adrenal_gland_right",
    "aorta",
    "duodenum",
    "esophagus",
    "gallbladder",
    "inferior_vena_cava",
    "kidney_left",
    "kidney_right",
    "liver",
    "pancreas",
    "portal_vein",
    "spleen",
    "stomach",
)
REQUIRED_MODELS = tuple(
    "portal_vein_and_splenic_vein" if name == "portal_vein" else name for name in BOUNDARY_ORGANS
)
ORGAN_LABEL_VALUES = {
    "adrenal_gland_left": (13,),
    "adrenal_gland_right": (12,),
    "aorta": (8,),
    "duodenum": (14,),
    "esophagus": (5,),
    "gallbladder": (4,),
    "inferior_vena_cava": (9,),
    "kidney_left": (3,),
    "kidney_right": (2,),
    "liver": (6,),
    "pancreas": (11,),
    "portal_vein": (23, 26, 33, 34, 35, 36, 37),
    "spleen": (1,),
    "stomach": (7,),
}
VESSEL_LABEL_VALUES = {
    "aorta": (8,),
    "inferior_vena_cava": (9,),
    "portal_vein": (26, 33, 34, 35, 36, 37),
}
VESSEL_COLORS = {
    "aorta": (255, 0, 0),
    "inferior_vena_cava": (0, 0, 255),
    "portal_vein": (170, 85, 255),
}
ORGAN_COLORS = {
    "adrenal_gland_left": (31, 119, 180),
    "adrenal_gland_right": (174, 199, 232),
    "aorta": (255, 82, 0),
    "duodenum": (44, 160, 44),
    "esophagus": (152, 223, 138),
    "gallbladder": (188, 189, 34),
    "inferior_vena_cava": (0, 188, 212),
    "kidney_left": (214, 39, 40),
    "kidney_right": (255, 152, 150),
    "liver": (140, 86, 75),
    "pancreas": (148, 103, 189),
    "portal_vein": (0, 188, 212),
    "spleen": (227, 119, 194),
    "stomach": (127, 127, 127),
}
EXPORT_COLORS = {
    "stomach": (228, 87, 86),
    "liver": (76, 120, 168),
    "pancreas": (242, 207, 91),
    "duodenum": (84, 162, 75),
    "esophagus": (178, 121, 162),
}
BANNED_CATALOG_LABELS = ("bile_duct", "common_bile_duct")
DUAL_ROLES = {
    "aorta": ("organ_and_vessel", "artery"),
    "inferior_vena_cava": ("organ_and_vessel", "vein"),
    "portal_vein": ("organ_and_vessel", "vein"),
}
# Organ names and label ids of the candidate catalogue.
CATALOG_IDS = {
    "adrenal_gland_left": (22,),
    "adrenal_gland_right": (23,),
    "aorta": (3, 33),
    "duodenum": (10, 21, 41),
    "inferior_vena_cava": (30,),
    "kidney_left": (24,),
    "kidney_right": (25,),
    "liver": (1, 2, 8, 14),
    "pancreas": (4, 5, 7, 9, 11, 19, 20),
    "portal_vein": (26, 27),
    "spleen": (6, 18),
}
ORGAN_METADATA_VERSION = "eus-organ-metadata/v1"
VESSEL_METADATA_VERSION = "eus-vessel-metadata/v1"
CATALOG_VERSION = "eus-possible-organs/v1"
PROTOCOL_FIELDS = (
    "coordinate_system",
    "input_coordinate_system",
    "core_design_filename",
    "core_design_sha256",
    "base_core_design_filename",
    "base_core_design_sha256",
    "build_git_commit",
    "input_provenance",
    "sampling_configuration",
    "duodenum_centerline_selection",
    "minimum_point_spacing_mm",
    "surface_sampling_audit",
    "pose_plan",
    "sampling_point_plan",
    "pose_angles_degrees",
    "pose_convention",
    "square_sampling",
    "quality_filtering",
    "fov_policy",
    "eus_possible_organs",
    "manual_segmentation",
)
IMAGE_FIELDS = (
    "ct_png",
    "boundary_only_png",
    "ct_overlay_png",
    "organ_vessel_boundary_png",
    "eus_vessel_boundary_png",
    "ct_eus_vessel_overlay_png",
)
# Listed settings and the value each must have.
LOCKED_SETTINGS = {
    "sampling.ray_length_mm": RAY_LENGTH_MM,
    "sampling.ray_batch_size": float(RAY_BATCH),
    "sampling.minimum_spacing_mm": SPACING_MM,
    "sampling.centerline_voxel_pitch_mm": VOXEL_PITCH_MM,
    "sampling.centerline_tangent_window_mm": TANGENT_WINDOW_MM,
    "sampling.centerline_max_terminal_spur_mm": MAX_SPUR_MM,
    "square.side_length_mm": SIDE_MM,
    "ct.output_resolution": float(RESOLUTION),
    "ct.window_level": WINDOW_LEVEL_HU,
    "ct.window_width": WINDOW_WIDTH_HU,
    "ct.fill_hu_value": FILL_HU,
    "filtering.black_threshold": float(BLACK_THRESHOLD),
    "filtering.black_ratio_limit": BLACK_RATIO_LIMIT,
    "filtering.line_min_diagonal_fraction": LINE_MIN_DIAGONAL_FRACTION,
    "filtering.black_side_min_ratio": BLACK_SIDE_MIN_RATIO,
    "filtering.valid_side_max_black_ratio": VALID_SIDE_MAX_BLACK_RATIO,
    "runtime.seed": float(SEED),
}
