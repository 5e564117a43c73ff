"""Names, schemas and default parameters shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Array slots of a bronze row, in slot order.
# --------------------------------------------------------------------------
SCENARIO_SLOTS = ["Altitude", "Mach_Number", "TRA", "T2"]
PHYSICAL_SLOTS = [
    "T24", "T30", "T48", "T50", "P15", "P2", "P21",
    "P24", "Ps30", "P40", "P50", "Nf", "Nc", "Wf",
]
VIRTUAL_SLOTS = [
    "T40", "P30", "P45", "W21", "W22", "W25", "W31",
    "W32", "W48", "W50", "SmFan", "SmLPC", "SmHPC", "phi",
]
DEGRADATION_SLOTS = ["T1", "T2_deg", "T3_deg"]
ARRAY_SLOTS = {
    "W": SCENARIO_SLOTS,
    "X_s": PHYSICAL_SLOTS,
    "X_v": VIRTUAL_SLOTS,
    "T": DEGRADATION_SLOTS,
}
ID_COLUMNS = ["dataset", "unit_orig", "time", "Fc", "hs"]

# The two layouts of the auxiliary array ``A``. A layout without
# a dataset slot belongs to a single-archive load, whose dataset number is 1.
AUX_LAYOUTS = {
    "with_dataset": ["dataset", "unit_orig", "time", "Fc", "hs"],
    "without_dataset": ["unit_orig", "time", "Fc", "hs"],
}
DEFAULT_DATASET = 1

LABEL = "Remaining_Useful_Life"
CLIPPED_LABEL = "RUL_Clipped"
SILVER_COLUMNS = [
    *ID_COLUMNS,
    *SCENARIO_SLOTS,
    *PHYSICAL_SLOTS,
    *VIRTUAL_SLOTS,
    *DEGRADATION_SLOTS,
    LABEL,
    "snapshot_date",
]

# --------------------------------------------------------------------------
# Silver column -> descriptive name.
# --------------------------------------------------------------------------
DISPLAY_NAMES = {
    "Mach_Number": "Mach Number",
    "TRA": "Throttle Resolver Angle",
    "T2": "Total Temperature at Fan Inlet",
    "T24": "LPC Outlet Temperature",
    "T30": "HPC Inlet Temperature",
    "T40": "Total Temperature at Burner Outlet",
    "T48": "HPT Outlet Temperature",
    "T50": "LPT Outlet Temperature",
    "P2": "Fan Inlet Pressure",
    "P15": "Pressure in Bypass Duct",
    "P21": "Engine Pressure Ratio",
    "P24": "Corrected Fan Speed Ratio",
    "P30": "HPC Outlet Pressure",
    "P40": "Bypass Ratio",
    "P45": "Total Pressure at HPT Outlet",
    "P50": "Total Pressure at LPT Outlet",
    "Ps30": "HPC Outlet Static Pressure",
    "Nf": "Fan Speed",
    "Nc": "Core Speed",
    "Wf": "Fuel Flow",
    "phi": "Fuel Flow Ratio",
    "W21": "Fan Flow",
    "W22": "LPC Flow",
    "W25": "HPC Flow",
    "W31": "HPT Coolant Bleed",
    "W32": "LPT Coolant Bleed",
    "W48": "Bleed Enthalpy",
    "W50": "Demanded Fan Speed",
    "SmFan": "Fan Stall Margin",
    "SmLPC": "LPC Stall Margin",
    "SmHPC": "HPC Stall Margin",
    "Fc": "Flight Class",
    "hs": "Health Status",
}

# The twelve model features.
BASE_FEATURES = [
    "HPC Outlet Pressure",
    "LPT Coolant Bleed",
    "Fan Inlet Pressure",
    "Demanded Fan Speed",
    "Fan Speed",
    "Core Speed",
    "Pressure in Bypass Duct",
    "Fuel Flow Ratio",
    "LPT Outlet Temperature",
    "Altitude",
    "Mach Number",
    "Throttle Resolver Angle",
]

# The eighteen sensors of the trend and correlation reports.
TREND_SENSORS = [
    "Total Temperature at Fan Inlet",
    "LPC Outlet Temperature",
    "HPC Inlet Temperature",
    "LPT Outlet Temperature",
    "Fan Inlet Pressure",
    "Pressure in Bypass Duct",
    "HPC Outlet Pressure",
    "Fan Speed",
    "Core Speed",
    "Engine Pressure Ratio",
    "HPC Outlet Static Pressure",
    "Fuel Flow Ratio",
    "Bypass Ratio",
    "Bleed Enthalpy",
    "Demanded Fan Speed",
    "Corrected Fan Speed Ratio",
    "HPT Coolant Bleed",
    "LPT Coolant Bleed",
]

# --------------------------------------------------------------------------
# Default parameters.
# --------------------------------------------------------------------------
TABULAR_CLIP = 90.0
SEQUENCE_CLIP = 125.0
ROLLING_WINDOWS = {"short": 5, "medium": 15, "long": 30}
EMA_SPAN = 10
LABEL_LAGS = (1, 5, 10, 20)
MIN_CORR_POINTS = 6
SEQUENCE_LENGTH = 30
TEST_SHARE = 0.15
VALIDATION_SHARE = 0.15
SEED = 42
LOW_LIFE, HIGH_LIFE = 20.0, 50.0
LABEL_THRESHOLDS = (94, 100, 125, 150, 200)
LOW_VARIANCE_RATIO = 0.001
MAX_ROWS_PER_FILE = 500_000
TABULAR_CUTOFF = "2024-12-31"
SEQUENCE_CUTOFF = "2025-01-01"

TABULAR_METADATA = ["unit", "time", CLIPPED_LABEL, "dataset"]
NON_FEATURE_COLUMNS = ["unit", "time", "Remaining Useful Life", LABEL, CLIPPED_LABEL, "dataset"]

# Monitoring baselines.
SEQUENCE_BASELINE = {
    "baseline": {"rmse": 0.1244, "mae": 0.0366, "mean_pred": 45.0, "std_pred": 30.0},
    "thresholds": {
        "rmse_pct_change": 20.0,
        "mae_pct_change": 20.0,
        "distribution_pct_change": 20.0,
    },
}
SEQUENCE_FALLBACK = {
    "baseline": {"rmse": 0.15, "mae": 0.05, "mean_pred": 45.0},
    "thresholds": {
        "rmse_pct_change": 20.0,
        "mae_pct_change": 20.0,
        "distribution_pct_change": 20.0,
    },
}
TABULAR_BASELINE = {
    "baseline": {"rmse": 18.2091, "mae": 14.6529},
    "thresholds": {
        "rmse_warning_multiplier": 1.15,
        "rmse_critical_multiplier": 1.30,
        "mae_warning_multiplier": 1.20,
        "mae_critical_multiplier": 1.40,
    },
}


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


BRONZE_SCHEMA = T.StructType(
    [
        *[
            T.StructField(n, T.ArrayType(T.DoubleType()))
            for n in ("W", "X_s", "X_v", "T", "Y", "A")
        ],
        T.StructField("split", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)

SEQUENCE_BASELINE_SCHEMA = T.StructType(
    [
        T.StructField("baseline", _doubles("rmse", "mae", "mean_pred", "std_pred")),
        T.StructField(
            "thresholds",
            _doubles("rmse_pct_change", "mae_pct_change", "distribution_pct_change"),
        ),
    ]
)
TABULAR_BASELINE_SCHEMA = T.StructType(
    [
        T.StructField("baseline", _doubles("rmse", "mae")),
        T.StructField(
            "thresholds",
            _doubles(
                "rmse_warning_multiplier",
                "rmse_critical_multiplier",
                "mae_warning_multiplier",
                "mae_critical_multiplier",
            ),
        ),
    ]
)


def derived_names(feature: str, windows=ROLLING_WINDOWS) -> list[str]:
    """Rolling columns made from one feature, in output order."""
    names = []
    for scale in windows:
        names += [f"{feature}_mean_{scale}", f"{feature}_std_{scale}"]
    return [*names, f"{feature}_acceleration"]


# Reasons of a drift status.
DRIFT_OK = "Within baseline thresholds."
DRIFT_OVER = "{metric} %.2f exceeds {level} threshold (%.2f)."
