"""Business rules of the part quality model.

FIXED VALUES. Everything in this module must equal the values of the model the
engine reproduces, or results differ. They are stated once, plainly, in the
order the model uses them.
"""

# --- FIXED VALUES: verdict strings -------------------------------------------
PASS = "PASS"
FAIL = "FAIL"

# --- FIXED VALUES: string aggregate separator ---------------------------------
LIST_SEPARATOR = ", "

# --- FIXED VALUES: rounding of the per-part maxima -----------------------------
UTILIZATION_DIGITS = 3
TORQUE_ERROR_DIGITS = 4

# --- FIXED VALUES: material failure reasons, in priority order -----------------
MISSING_CERT = "missing_cert"
HARDNESS_LOW = "hardness_low"
HARDNESS_HIGH = "hardness_high"
TENSILE_LOW = "tensile_low"
TENSILE_HIGH = "tensile_high"
IN_SPEC = "in_spec"
UNKNOWN_REASON = "unknown"

# --- FIXED VALUES: root causes, in priority order ------------------------------
ROOT_CAUSES = ("dimension", "torque", "material", "unknown", "none")
CAUSE_DIMENSION, CAUSE_TORQUE, CAUSE_MATERIAL, CAUSE_UNKNOWN, CAUSE_NONE = ROOT_CAUSES

# --- FIXED VALUES: process risk thresholds (strictly greater than) -------------
COOLANT_RISK_ABOVE = 34.0
FEED_RISK_ABOVE = 710.0

# --- FIXED VALUES: composite quality score -------------------------------------
SCORE_START = 100
PENALTY_PER_FAILED_DIMENSION = 10
PENALTY_PER_FAILED_JOINT = 15
PENALTY_MATERIAL_DEVIATION = 25
PENALTY_COOLANT_RISK = 4
PENALTY_FEED_RISK = 3
SCORE_MIN = 0
SCORE_MAX = 100

# --- FIXED VALUES: verdict rules of the source systems -------------------------
# Torque limits are 0.95 and 1.05 times the target; angle limits are the
# target angle plus or minus 8.0 degrees.
TORQUE_LOWER_FACTOR = 0.95
TORQUE_UPPER_FACTOR = 1.05
ANGLE_HALF_WIDTH = 8.0

# --- FIXED VALUES: correlation report columns, in report order -----------------
CORRELATION_COLUMNS = (
    "spindle_speed",
    "feed_rate",
    "coolant_temp",
    "cycle_time",
    "hardness",
    "tensile_strength",
    "failed_dimension_count",
    "failed_joint_count",
    "composite_quality_score",
    "defect_flag",
)
CORRELATION_DIGITS = 3
