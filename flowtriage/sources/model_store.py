"""Versioned store for fitted models: T6 parameters and dictionary, centres, forest and offset.

A version is a folder ``v<number>`` of Parquet tables below the store's path,
which may be any file system that Spark reaches.  Its manifest (settings, and the
rows of every table) is written last, so a version without one, left behind by
a lost application, is never loaded; its number is not used again.  Doubles
come back bit by bit.  The category dictionary, of any size, is written
and read as a table; all else is bounded by columns, clusters or trees.

A loaded model reads its dictionary from the store, so it outlives the
application that fitted it, ``runtime.release``, and streams that run on it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtriage.operators.iforest import Forest
from flowtriage.operators.prep import PrepModel
from flowtriage.streaming.scoring import FittedTriage

FORMAT = 1
_COLUMNS = "role string, position int, name string, median double, mode string, n_categories long"
_FEATURES = "position int, name string, mean double, std double"
_CENTERS = "cluster int, position int, value double"
_NODES = "tree long, node long, feature int, threshold double, left int, right int, size long"
_MANIFEST = "format int, key string, unseen string, psi int, height_limit int, offset double, tables map<string,long>"


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, path: str, whole: bool) -> list[int]:
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    found = [n for n in names if n[:1] == "v" and n[1:].isdigit()]
    if whole:
        found = [n for n in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/manifest/_SUCCESS"))]
    return sorted(int(n[1:]) for n in found)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that can be loaded, in ascending order."""
    return _numbers(spark, path, True)


def _columns_table(spark: SparkSession, m: PrepModel) -> DataFrame:
    rows = [("label", i, c, None, None, None) for i, c in enumerate(m.label_cols)]
    rows += [("numeric", i, c, m.medians.get(c), None, None) for i, c in enumerate(m.numeric_cols)]
    rows += [("text", i, c, None, m.modes.get(c), m.n_categories.get(c)) for i, c in enumerate(m.text_cols)]
    return spark.createDataFrame(rows, _COLUMNS)


def save(spark: SparkSession, m: FittedTriage, path: str) -> int:
    """Write ``m`` as the next version below ``path`` and return its number."""
    version = max(_numbers(spark, path, False), default=0) + 1
    base = f"{path.rstrip('/')}/v{version:06d}"
    p = m.prep
    tables = {
        "columns": _columns_table(spark, p),
        "features": spark.createDataFrame([(i, c, float(p.means[c]), float(p.stds[c])) for i, c in enumerate(p.feature_names)], _FEATURES),
    }
    if p.dictionary is not None:
        tables["dictionary"] = p.dictionary.select("column", "value", F.col("n").cast("long"), F.col("code").cast("long"))
    if m.centers is not None:
        cells = [(k, i, float(v)) for k, row in enumerate(np.asarray(m.centers)) for i, v in enumerate(row)]
        tables["centers"] = spark.createDataFrame(cells, _CENTERS)
    if m.forest is not None:
        names = [f.split()[0] for f in _NODES.split(", ")]
        tables["nodes"] = spark.createDataFrame([tuple(r) for r in m.forest.nodes[names].astype(object).itertuples(index=False)], _NODES)
        tables["forest_features"] = spark.createDataFrame(list(enumerate(m.forest.feature_cols)), "position int, name string")
    rows = {}
    for name, table in tables.items():
        table.write.parquet(f"{base}/{name}")
        rows[name] = spark.read.parquet(f"{base}/{name}").count()
    forest = m.forest
    settings = (FORMAT, p.key, p.unseen, forest.psi if forest else None, forest.limit if forest else None, None if m.offset is None else float(m.offset), rows)
    spark.createDataFrame([settings], _MANIFEST).coalesce(1).write.parquet(f"{base}/manifest")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> FittedTriage:
    """The model of a version, the newest whole one by default; raises where tables don't hold what the manifest says."""
    known = versions(spark, path)
    if version is None and known:
        version = known[-1]
    if version not in known:
        raise ValueError(f"no version {version} in {path}; there are {known}")
    base = f"{path.rstrip('/')}/v{version:06d}"
    manifest = spark.read.schema(_MANIFEST).parquet(f"{base}/manifest").first()
    if manifest["format"] != FORMAT:
        raise ValueError(f"{base} has format {manifest['format']}, this code reads {FORMAT}")
    tables = {name: spark.read.parquet(f"{base}/{name}") for name in manifest["tables"]}
    for name, n in manifest["tables"].items():
        if tables[name].count() != n:
            raise ValueError(f"{base}/{name} has {tables[name].count()} rows instead of {n}")
    columns = tables["columns"].orderBy("role", "position").collect()
    role = lambda x: [r for r in columns if r["role"] == x]
    features = tables["features"].orderBy("position").collect()
    prep = PrepModel(
        manifest["key"], [r["name"] for r in role("label")], [r["name"] for r in role("numeric")], [r["name"] for r in role("text")],
        [r["name"] for r in features],
        medians={r["name"]: r["median"] for r in role("numeric") if r["median"] is not None},
        modes={r["name"]: r["mode"] for r in role("text") if r["mode"] is not None},
        n_categories={r["name"]: r["n_categories"] for r in role("text") if r["n_categories"] is not None},
        dictionary=tables.get("dictionary"),
        means={r["name"]: r["mean"] for r in features}, stds={r["name"]: r["std"] for r in features}, unseen=manifest["unseen"],
    )
    centers = forest = None
    if "centers" in tables:
        cells = tables["centers"].orderBy("cluster", "position").collect()
        centers = np.array([c["value"] for c in cells]).reshape(-1, len(features))
    if "nodes" in tables:
        nodes = tables["nodes"].toPandas()  # bounded by trees and their sample size
        names = [r["name"] for r in tables["forest_features"].orderBy("position").collect()]
        forest = Forest(names, manifest["psi"], manifest["height_limit"], nodes)
    return FittedTriage(prep, centers, forest, manifest["offset"])
