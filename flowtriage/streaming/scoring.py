"""Score newly arriving sessions with models fitted in batch.

Every fitted operator here is a per-row projection (T6 scaling, C2 nearest
centre, I2 forest path lengths via ``mapInPandas``, I3 fixed threshold), so
the same DataFrame code runs unchanged on a Structured Streaming source.
No state is kept between micro-batches.  The caller names a checkpoint location
that is the query's own and stays the same across restarts; with it the file
sink's output is exactly-once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowtriage.operators import features, iforest, segment
from flowtriage.operators.prep import PrepModel


@dataclass
class FittedTriage:
    prep: PrepModel
    centers: np.ndarray | None = None
    forest: iforest.Forest | None = None
    offset: float | None = None


def score_sessions(sessions: DataFrame, m: FittedTriage, key: str = "session_id") -> DataFrame:
    """(key, cluster, anomaly_score, anomaly_flag) for batch or streaming input."""
    x = m.prep.transform(features.engineer_features(sessions))
    names = m.prep.feature_names
    if m.centers is not None:
        x = x.withColumn("cluster", segment.assign_expr(m.centers, names))
    keep = ["cluster"] if m.centers is not None else []
    if m.forest is None:
        return x.select(key, *keep)
    raw = iforest.score(x, m.forest, key, keep=keep)
    out = raw.withColumn("anomaly_score", F.col("anomaly_score") - F.lit(m.offset or 0.0))
    return out.withColumn("anomaly_flag", (F.col("anomaly_score") < 0).cast("int"))


def start_scoring(
    stream: DataFrame,
    m: FittedTriage,
    sink_path: str,
    checkpoint_location: str,
    key: str = "session_id",
    trigger_seconds: int | None = None,
) -> StreamingQuery:
    """Continuously append scored sessions to a Parquet sink."""
    w = score_sessions(stream, m, key).writeStream.format("parquet").option("checkpointLocation", checkpoint_location).outputMode("append")
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start(sink_path)
