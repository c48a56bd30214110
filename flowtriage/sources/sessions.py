"""S1 and the session views the operators run on.

``load_sessions`` reads a headered CSV (or Parquet) session table with a
declared schema.  ``derive_sessions`` builds the session table from the
TPC-H-style test tables: one session per order (``o_orderkey`` is unique;
lineitem has no unique key), with integer byte/packet sums so every engine
computes identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtriage.runtime import materialise, table_path

KEY = "session_id"

# The columns of the session files, by type.
_TEXT = ["proto", "service", "state", "attack_cat"]
_DOUBLE = ["dur", "rate", "sload", "dload", "sinpkt", "dinpkt", "sjit", "djit", "tcprtt", "synack", "ackdat"]
_BIGINT = [
    "spkts", "dpkts", "sbytes", "dbytes", "sttl", "dttl", "sloss", "dloss", "swin", "stcpb",
    "dtcpb", "dwin", "smean", "dmean", "trans_depth", "response_body_len", "ct_srv_src",
    "ct_state_ttl", "ct_dst_ltm", "ct_src_dport_ltm", "ct_dst_sport_ltm", "ct_dst_src_ltm",
    "is_ftp_login", "ct_ftp_cmd", "ct_flw_http_mthd", "ct_src_ltm", "ct_srv_dst", "is_sm_ips_ports",
]
SESSION_CSV_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in _TEXT]
    + [T.StructField(c, T.DoubleType()) for c in _DOUBLE]
    + [T.StructField(c, T.LongType()) for c in _BIGINT]
    + [T.StructField("label", T.IntegerType())]
)


def require_columns(df: DataFrame, cols, what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what} requires columns missing from the table: {missing}")


def load_sessions(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    key: str = "id",
    malformed: str = "error",
) -> DataFrame:
    """Read a session table by column name; the key column is exposed as ``session_id``.

    Columns may stand in any order and extra ones are ignored; a missing one is
    an error.  A CSV value that is not of its column's type, or a row with
    more fields than the header, is ``malformed``: ``"error"`` raises when the
    row is read, ``"null"`` keeps the row with null, ``"drop"`` drops the row.
    """
    if malformed not in ("error", "null", "drop"):
        raise ValueError(f"malformed must be error, null or drop, not {malformed!r}")
    wanted = schema or SESSION_CSV_SCHEMA
    if fmt != "csv":
        df = spark.read.format(fmt).load(path)
        require_columns(df, [f.name for f in wanted.fields] if schema is not None else [key], "load_sessions")
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        return df.withColumnRenamed(key, KEY) if key != KEY else df
    header = spark.read.option("header", True).csv(path)  # names only; every field as text
    require_columns(header, [f.name for f in wanted.fields], "load_sessions")
    rest = "__surplus"
    text = T.StructType([T.StructField(c, T.StringType()) for c in header.columns] + [T.StructField(rest, T.StringType())])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", rest).csv(path)
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in wanted.fields}
    bad = F.col(rest).isNotNull()
    for f in wanted.fields:
        bad = bad | (F.col(f.name).isNotNull() & casts[f.name].isNull())
    if malformed == "drop":
        raw = raw.where(~bad)
    out = raw.select(*[c.alias(n) for n, c in casts.items()], bad.alias("__bad"))
    if malformed == "error":
        first = out.columns[0]
        checked = F.when(F.col("__bad"), F.raise_error(F.lit("malformed session row")).cast(wanted.fields[0].dataType)).otherwise(F.col(first))
        out = out.withColumn(first, checked)
    out = out.drop("__bad")
    return out.withColumnRenamed(key, KEY) if key != KEY else out


def quarantine_sessions(spark: SparkSession, path: str, schema: T.StructType | None = None, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """S1 with a reject table: (good rows as ``load_sessions`` gives them, rejected (file, line, column, reason, value)).

    The files are read and parsed once, into a written table that both results
    read.  A line is good or rejected, never both and never lost; a rejected one
    has a row for every value that is not of its column's type, and one with null column where
    its fields are not as many as the header's.  Blank lines and the header of each file
    are no rows.  Columns are found by name as in ``load_sessions``.
    """
    wanted = schema or SESSION_CSV_SCHEMA
    header = spark.read.option("header", True).csv(path)
    require_columns(header, [f.name for f in wanted.fields], "quarantine_sessions")
    names = header.columns
    first = spark.read.text(path).first()[0]
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    lines = lines.where((F.btrim("line") != "") & (F.col("line") != first))
    fields = ", ".join(f"`{c}` string" for c in names)
    # an extra column marks lines with other than the header's number of fields
    read = F.from_csv("line", f"{fields}, `__whole` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__whole"})
    parsed = lines.withColumn("row", read)
    faults = [F.when(F.col("row.__whole").isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), F.lit("number of fields").alias("reason"), F.lit(None).cast("string").alias("value")))]
    typed = []
    for f in wanted.fields:
        text = F.col("row")[f.name]
        value = text.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        fault = F.struct(F.lit(f.name).alias("column"), F.lit(f"not {f.dataType.simpleString()}").alias("reason"), text.alias("value"))
        faults.append(F.when(F.col("row.__whole").isNull() & text.isNotNull() & value.isNull(), fault))
    found = F.filter(F.array(*faults), lambda x: x.isNotNull())
    table = materialise(parsed.select(*typed, "file", "line", found.alias("faults")), "quarantine")
    good = table.where(F.size("faults") == 0).select(*[f.name for f in wanted.fields])
    rejected = table.where(F.size("faults") > 0).select("file", "line", F.explode("faults").alias("f")).select("file", "line", "f.*")
    return good.withColumnRenamed(key, KEY) if key != KEY else good, rejected


def reject_counts(rejected: DataFrame) -> DataFrame:
    """(column, reason, n) of a reject table."""
    return rejected.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"))


def derive_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session table from orders ⟕ lineitem ⟕ customer, one row per order.

    lineitem is pre-aggregated by order (partial aggregation map-side), so the
    join with orders is 1:1 on the shuffle key and reuses its partitioning.
    """
    li = (
        spark.read.parquet(table_path(sf_dir, "lineitem"))
        .groupBy("l_orderkey")
        .agg(
            F.datediff(F.max("l_shipdate"), F.min("l_shipdate")).cast("double").alias("dur"),
            # l_returnflag is a one-character flag: max over its code point equals
            # max(string) and keeps the aggregate hash-based (no sort of lineitem).
            F.max(F.ascii("l_returnflag")).alias("__rf"),
            F.sum(F.when(F.col("l_linestatus") == "O", F.floor("l_quantity").cast("bigint"))).alias("spkts"),
            F.sum(F.when(F.col("l_linestatus") == "F", F.floor("l_quantity").cast("bigint"))).alias("dpkts"),
            F.sum(F.when(F.col("l_linestatus") == "O", F.floor("l_extendedprice").cast("bigint"))).alias("sbytes"),
            F.sum(F.when(F.col("l_linestatus") == "F", F.floor("l_extendedprice").cast("bigint"))).alias("dbytes"),
        )
    )
    orders = spark.read.parquet(table_path(sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    cust = spark.read.parquet(table_path(sf_dir, "customer")).select("c_custkey", "c_mktsegment")
    return (
        orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
        .join(cust, orders.o_custkey == cust.c_custkey, "left")
        .select(
            F.col("o_orderkey").alias(KEY),
            "dur",
            F.col("o_orderpriority").alias("proto"),
            F.when(F.col("__rf").isNotNull(), F.chr(F.col("__rf"))).alias("service"),
            F.col("o_orderstatus").alias("state"),
            "spkts",
            "dpkts",
            "sbytes",
            "dbytes",
            F.when(F.col("o_totalprice") > 400000, 1).otherwise(0).cast("int").alias("label"),
            F.col("c_mktsegment").alias("attack_cat"),
        )
    )


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-dimensional point set for density / silhouette checks.

    (customer_id, x, y, z, segment): account balance, order count and average
    order value, each rescaled and rounded to 6 places so every engine
    measures identical distances.
    """
    o = (
        spark.read.parquet(table_path(sf_dir, "orders"))
        .groupBy("o_custkey")
        .agg(F.count("o_orderkey").alias("n_orders"), F.avg("o_totalprice").alias("avg_price"))
    )
    c = spark.read.parquet(table_path(sf_dir, "customer")).select("c_custkey", "c_acctbal", "c_mktsegment")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.round(F.col("c_acctbal") / 1000.0, 6).alias("x"),
        F.round(F.coalesce(F.col("n_orders"), F.lit(0)) / 2.0, 6).alias("y"),
        F.round(F.coalesce(F.col("avg_price"), F.lit(0.0)) / 50000.0, 6).alias("z"),
        F.col("c_mktsegment").alias("segment"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "embeddings"))


# --- oracle SQL text for the same views (DuckDB) ---------------------------

SESSIONS_SQL = """
select o_orderkey as session_id,
       cast(date_diff('day', min(l_shipdate), max(l_shipdate)) as double) as dur,
       o_orderpriority as proto, max(l_returnflag) as service, o_orderstatus as state,
       cast(sum(case when l_linestatus='O' then cast(floor(l_quantity) as bigint) end) as bigint) as spkts,
       cast(sum(case when l_linestatus='F' then cast(floor(l_quantity) as bigint) end) as bigint) as dpkts,
       cast(sum(case when l_linestatus='O' then cast(floor(l_extendedprice) as bigint) end) as bigint) as sbytes,
       cast(sum(case when l_linestatus='F' then cast(floor(l_extendedprice) as bigint) end) as bigint) as dbytes,
       cast(case when o_totalprice > 400000 then 1 else 0 end as integer) as label,
       c_mktsegment as attack_cat
from orders left join lineitem on l_orderkey = o_orderkey
            left join customer on c_custkey = o_custkey
group by o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, c_mktsegment
"""

PROFILE_SQL = """
select c_custkey as customer_id,
       round(c_acctbal / cast(1000 as double), 6) as x,
       round(cast(coalesce(n_orders, 0) as double) / cast(2 as double), 6) as y,
       round(coalesce(avg_price, cast(0 as double)) / cast(50000 as double), 6) as z,
       c_mktsegment as segment
from customer left join (
    select o_custkey, count(o_orderkey) as n_orders, avg(o_totalprice) as avg_price
    from orders group by o_custkey) o on c_custkey = o_custkey
"""
