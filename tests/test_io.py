"""S1 (CSV with declared schema) and the whole run's sinks."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtriage.plans import triage_run
from flowtriage.config import Defaults
from flowtriage.sources.sessions import SESSION_CSV_SCHEMA, derive_sessions, load_sessions


def test_load_sessions_csv_with_schema(spark):
    s = derive_sessions(spark, "/root/testdata/sf0.001")
    out = tempfile.mkdtemp(prefix="ft-csv-")
    s.withColumnRenamed("session_id", "id").write.mode("overwrite").option("header", True).csv(out)
    schema = T.StructType([T.StructField("id", T.LongType())] + [f for f in s.schema.fields if f.name != "session_id"])
    back = load_sessions(spark, out, fmt="csv", schema=schema)
    assert back.columns[0] == "session_id"
    assert back.count() == s.count()
    assert back.agg(F.sum("sbytes")).first()[0] == s.agg(F.sum("sbytes")).first()[0]


def test_whole_run_writes_reports(spark):
    out = tempfile.mkdtemp(prefix="ft-run-")
    r = triage_run.run_triage(spark, derive_sessions(spark, "/root/testdata/sf0.001"), out_dir=out)
    for name in ("association_rules", "label_crosstab", "dominant_category_per_cluster", "if_soc_queue",
                 "if_cluster_summary", "cluster_summary", "summary", "scores", "labels"):
        assert os.path.isdir(os.path.join(out, name)), name
    text = "\n".join(x["value"] for x in spark.read.text(os.path.join(out, "summary")).collect())
    assert "best_k = " in text and "n_noise = " in text and "[cluster_size]" in text
    n = r["scores"].count()
    assert r["anomaly_totals"].first()["n_anomalies"] == int(0.04 * (n - 1)) + 1
    assert r["queue"].count() == 20
    assert r["cluster_distribution"].agg(F.sum("n")).first()[0] == n


def test_csv_is_read_by_name(spark, tmp_path):
    names = [f.name for f in SESSION_CSV_SCHEMA.fields][::-1]
    values = {c: str(i) for i, c in enumerate(names)} | {"proto": "tcp", "service": "", "state": "FIN", "attack_cat": "Normal"}
    (tmp_path / "a.csv").write_text(",".join([*names, "extra"]) + "\n" + ",".join([*[values[c] for c in names], "x"]) + "\n")
    r = load_sessions(spark, f"file://{tmp_path}").first()
    assert r["session_id"] == int(values["id"]) and r["sload"] == float(values["sload"]) and r["sloss"] == int(values["sloss"]) and r["service"] is None


def test_csv_missing_column_and_malformed_rows(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    (tmp_path / "a.csv").write_text("v,id\n1.5,1\nabc,2\n2.5,3,9\n,4\n")
    path = f"file://{tmp_path}"
    with pytest.raises(KeyError):
        load_sessions(spark, path, schema=T.StructType([*schema.fields, T.StructField("w", T.LongType())]))
    with pytest.raises(Exception, match="malformed"):
        load_sessions(spark, path, schema=schema).collect()
    kept = {r["session_id"]: r["v"] for r in load_sessions(spark, path, schema=schema, malformed="null").collect()}
    assert kept == {1: 1.5, 2: None, 3: 2.5, 4: None}
    assert {r["session_id"] for r in load_sessions(spark, path, schema=schema, malformed="drop").collect()} == {1, 4}


def test_whole_run_reads_sources_once(spark):
    """Each source table is scanned by few stages; the features can be switched off."""
    s = derive_sessions(spark, "/root/testdata/sf0.001")
    r = triage_run.run_triage(spark, s, engineered=False, p=Defaults(k_max=3, kmeans_n_init=1, n_trees=10))
    assert "packet_rate" not in r["prep"].feature_names and r["queue"].count() == 20
