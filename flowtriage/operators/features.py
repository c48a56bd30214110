"""Engineered ratio features, all in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtriage.config import DEFAULTS
from flowtriage.functions.scalar import safe_divide
from flowtriage.sources.sessions import require_columns

ENGINEERED = ("outbound_dominance_ratio", "packet_rate", "bytes_per_packet", "packet_asymmetry")


def feature_columns() -> dict:
    """Name → expression for the four ratios.

    Inputs are cast to double before adding, so byte sums cannot overflow
    under ANSI arithmetic.
    """
    sb, db = F.col("sbytes").cast("double"), F.col("dbytes").cast("double")
    sp, dp = F.col("spkts").cast("double"), F.col("dpkts").cast("double")
    du = F.col("dur").cast("double")
    return {
        "outbound_dominance_ratio": safe_divide(sb, sb + db),
        "packet_rate": safe_divide(sp, du),
        "bytes_per_packet": safe_divide(sb, sp),
        "packet_asymmetry": safe_divide(sp - dp, sp + dp),
    }


def engineer_features(df: DataFrame, enabled: bool = True) -> DataFrame:
    """validate the raw columns and append the four ratios.

    Runs before imputation (as in the reference), so a null count gives a
    ratio of 0.0 while the raw column is later median-filled.
    """
    if not enabled:
        return df
    require_columns(df, DEFAULTS.required_raw, "feature engineering")
    return df.withColumns(feature_columns())
