"""Streaming scoring equals batch scoring on the same sessions."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from flowtriage.operators import features, iforest, prep, segment, triage
from flowtriage.sources.sessions import derive_sessions
from flowtriage.streaming.scoring import FittedTriage, score_sessions


def test_stream_matches_batch(spark):
    sessions = derive_sessions(spark, "/root/testdata/sf0.001")
    feat = features.engineer_features(sessions)
    m = prep.fit_preprocessor(feat)
    x = m.transform(feat).cache()
    models = segment.fit_kmeans_many(x, m.feature_names, [3], n_init=2)
    forest = iforest.fit_isolation_forest(x, m.feature_names, n_trees=20)
    _, offset = triage.contamination_flags(iforest.score(x, forest), 0.04)
    fitted = FittedTriage(m, models[3].centers, forest, offset)

    src = tempfile.mkdtemp(prefix="ft-stream-src-")
    sessions.repartition(3).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(sessions.schema).parquet(src)
    q = score_sessions(stream, fitted).writeStream.format("memory").queryName("scored_sessions").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["session_id"]: (r["cluster"], round(r["anomaly_score"], 12), r["anomaly_flag"]) for r in spark.table("scored_sessions").collect()}
    want = {
        r["session_id"]: (r["cluster"], round(r["anomaly_score"], 12), r["anomaly_flag"])
        for r in score_sessions(sessions, fitted).collect()
    }
    assert got == want
    assert sum(v[2] for v in want.values()) == spark.table("scored_sessions").agg(F.sum("anomaly_flag")).first()[0]
