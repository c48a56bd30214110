"""flowtriage — Spark-native behavioural segmentation and anomaly triage.

Every operator takes and returns lazy Spark DataFrames keyed by
``session_id``.  Fitted parameters (medians, means, quantile edges,
centroids, forests) are small driver-side values whose size is bounded by
the number of features / clusters / trees, never by the number of rows.
"""

from flowtriage.config import Defaults

__all__ = ["Defaults"]
__version__ = "0.1.0"
