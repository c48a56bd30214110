"""Session and shared-folder helpers used by all operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "flowtriage", shared: str | None = None) -> SparkSession:
    """SparkSession for tests / bench on one machine (UI off, AQE on, UTC); ``shared`` becomes spark.checkpoint.dir."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which driver and executors share.

    Without that setting a local session uses its warehouse folder; on a cluster,
    whose machines need not share it, that is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{conf.rstrip('/')}/flowtriage-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage, survives lost executors, keeps column pruning and filter
    push-down for later reads, and gives Catalyst the table's true size, so a
    broadcast is chosen only when the table is really small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``materialise``, and aggregates over all rows taken while they are written.

    The observing node is the last before the writer, in the tasks whose output is committed, so a task that is run
    again counts once.  What an optimised-away plan doesn't report is read from the written table.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    table = materialise(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), name)
    got = seen.get
    if set(metrics) - set(got):
        got = table.agg(*[c.alias(n) for n, c in metrics.items()]).first().asDict()
    return table, got


def spread(df: DataFrame, key: str, name: str) -> DataFrame:
    """``materialise`` in ``spark.sql.shuffle.partitions`` parts, the session's measure of its tables, for passes that are
    bound by computing rather than by reading."""
    return materialise(df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key), name)


def release(spark: SparkSession) -> None:
    """Delete everything that ``materialise`` wrote for this application."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dense_rank(df: DataFrame, group: list, value: str, out: str, name: str = "ranks") -> DataFrame:
    """``df`` (non-null, distinct group + value) with ``out``, the 0-based rank of ``value`` in its group.

    No global window: rows are range-partitioned and written once; each partition
    ranks its own and adds the counts of the partitions before it.
    """
    keys = group or ["__all"]
    d = df if group else df.withColumn("__all", F.lit(0))
    d = materialise(d.repartitionByRange(*[F.col(k) for k in keys], F.col(value)).withColumn("__p", F.spark_partition_id()), name)
    counts = d.groupBy(*keys, "__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    own = F.row_number().over(Window.partitionBy(*keys, "__p").orderBy(value)) - 1
    d = d.withColumn("__own", own).join(counts, [*keys, "__p"])
    return d.withColumn(out, (F.col("__off") + F.col("__own")).cast("long")).drop("__p", "__off", "__own", "__all")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
