"""Registered queries: one Spark job per operator id, each with a DuckDB oracle.

Every query reads the given tables (or views Spark derives from them) in
full.  Keys follow SURVEY §5.2.  Computed columns carry the same alias on
both sides; floating results that depend on aggregation order are rounded
to 6 places on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtriage.config import DEFAULTS
from flowtriage.operators import features as feats
from flowtriage.operators import mining, prep
from flowtriage.plans import sql as S
from flowtriage.runtime import materialise, shared_dir, spread, table_path
from flowtriage.sources import sessions as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# --- shared Spark views ---------------------------------------------------------


def sessions(spark, sf):
    return src.derive_sessions(spark, sf)


def featured(spark, sf):
    """Engineered sessions, written once to the shared folder: every fit below
    (quantile rounds, modes, moments) re-reads the columns it needs."""
    return materialise(feats.engineer_features(sessions(spark, sf)), "sessions")


def fitted(spark, sf):
    df = featured(spark, sf)
    return df, prep.fit_preprocessor(df)


# --- S1, F1–F6 ---------------------------------------------------------------------


@register("load_sessions", S.with_base("select * from sessions"))
def q_load_sessions(spark, sf):
    return sessions(spark, sf)


@register(
    "engineered_features",
    S.with_base("select session_id, " + ", ".join(S.RATIOS) + " from feat"),
)
def q_engineered_features(spark, sf):
    return feats.engineer_features(sessions(spark, sf)).select("session_id", *S.RATIOS)


@register(
    "safe_divide_edges",
    S.with_base(
        """
select case when dur is null then 'null_divisor' when dur = 0 then 'zero_divisor'
            when spkts is null then 'null_numerator' else 'regular' end as case_name,
       count(*) as n_sessions,
       round(sum(packet_rate), 6) as sum_packet_rate,
       cast(count(*) filter (where packet_rate = 0) as bigint) as n_filled
from feat group by 1"""
    ),
)
def q_safe_divide_edges(spark, sf):
    df = feats.engineer_features(sessions(spark, sf))
    case = (
        F.when(F.col("dur").isNull(), "null_divisor")
        .when(F.col("dur") == 0, "zero_divisor")
        .when(F.col("spkts").isNull(), "null_numerator")
        .otherwise("regular")
    )
    return df.groupBy(case.alias("case_name")).agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.round(F.sum("packet_rate"), 6).alias("sum_packet_rate"),
        F.count_if(F.col("packet_rate") == 0).cast("bigint").alias("n_filled"),
    )


# --- T1–T6, F7 -------------------------------------------------------------------------


@register(
    "impute_median_mode",
    S.with_base("select session_id, " + ", ".join(S.FEATURE_ORDER) + " from imp"),
)
def q_impute(spark, sf):
    df, m = fitted(spark, sf)
    return m.impute(df).select("session_id", *S.FEATURE_ORDER)


@register(
    "label_encode",
    S.with_base("select session_id, " + ", ".join(S.TEXT_FEATURES) + " from enc"),
)
def q_label_encode(spark, sf):
    df, m = fitted(spark, sf)
    return m.encode(df).select("session_id", *S.TEXT_FEATURES)


@register(
    "standard_scale",
    S.with_base("select session_id, " + S.round6(S.FEATURE_ORDER) + " from scaled"),
)
def q_standard_scale(spark, sf):
    df, m = fitted(spark, sf)
    return m.transform(df).select("session_id", *[r6(c) for c in S.FEATURE_ORDER])


@register(
    "inverse_scale",
    S.with_base(
        "select x.session_id, "
        + ", ".join(
            f"round(abs((x.{c} * s_{c} + m_{c}) - cast(e.{c} as double)), 6) as {c}_roundtrip_err" for c in S.FEATURE_ORDER
        )
        + " from scaled x cross join stats join enc e on e.session_id = x.session_id"
    ),
)
def q_inverse_scale(spark, sf):
    """T5: x·std + mean of the scaled table recovers the imputed/encoded value."""
    df, m = fitted(spark, sf)
    names = m.feature_names
    both = m.with_codes(df).select("session_id", *[m.feature_expr(c).alias(f"o_{c}") for c in names], *[m.scaled_expr(c).alias(c) for c in names])
    return m.inverse(both).select(
        "session_id",
        *[F.round(F.abs(F.col(c) - F.col(f"o_{c}")), 6).alias(f"{c}_roundtrip_err") for c in S.FEATURE_ORDER],
    )


@register(
    "preprocess_matrix",
    S.with_base("select session_id, " + S.round6(S.FEATURE_ORDER) + ", label, attack_cat from scaled"),
)
def q_preprocess_matrix(spark, sf):
    df, m = fitted(spark, sf)
    x = m.transform(df, keep=["label", "attack_cat"])
    return x.select("session_id", *[r6(c) for c in S.FEATURE_ORDER], "label", "attack_cat")


@register(
    "prep_params",
    S.with_base(
        "select feature, round(mean, 6) as mean, round(std, 6) as std from ("
        + " union all ".join(f"select '{c}' as feature, m_{c} as mean, s_{c} as std from stats" for c in S.FEATURE_ORDER)
        + ")"
    ),
)
def q_prep_params(spark, sf):
    _, m = fitted(spark, sf)
    return m.params(spark).select("feature", r6("mean"), r6("std"))


# --- M1–M8, F10, F11, A13, W5 ------------------------------------------------------------


def _txn(spark, sf):
    return mining.build_transactions(featured(spark, sf))


@register(
    "transactions",
    S.with_base("," + S.tercile_ctes() + "select * from txn"),
)
def q_transactions(spark, sf):
    txn, _, _ = _txn(spark, sf)
    return txn


@register(
    "tercile_bins",
    S.with_base(
        ","
        + S.tercile_ctes()
        + " union all ".join(
            f"select '{c}' as feature, round(lo_{c}, 9) as q_low, round(hi_{c}, 9) as q_high from edges" for c in S.RATIOS
        )
    ),
)
def q_tercile_bins(spark, sf):
    df = featured(spark, sf)
    edges = mining.tercile_edges(df, S.RATIOS)
    rows = [(c, float(edges[c][0]), float(edges[c][1])) for c in S.RATIOS]
    t = spark.createDataFrame(rows, "feature string, q_low double, q_high double")
    return t.select("feature", F.round("q_low", 9).alias("q_low"), F.round("q_high", 9).alias("q_high"))


def _itemsets(spark, sf):
    txn, cols, _ = _txn(spark, sf)
    return materialise(mining.frequent_itemsets(txn, cols, DEFAULTS.min_support), "itemsets")


_ITS_SQL = S.with_base("," + S.tercile_ctes() + "," + S.itemset_ctes(DEFAULTS.min_support))
_RULES_SQL = _ITS_SQL + "," + S.rules_ctes(DEFAULTS.min_confidence)


@register(
    "frequent_itemsets",
    _ITS_SQL
    + "select array_to_string(items, ' AND ') as items, cast(len(items) as integer) as size, n, round(support, 6) as support from its",
)
def q_frequent_itemsets(spark, sf):
    its = _itemsets(spark, sf)
    return its.select(F.array_join("items", " AND ").alias("items"), "size", "n", r6("support"))


@register(
    "itemset_size_dist",
    _ITS_SQL + "select cast(len(items) as integer) as size, count(*) as n_itemsets from its group by 1",
)
def q_itemset_size_dist(spark, sf):
    return mining.itemset_size_distribution(_itemsets(spark, sf))


@register(
    "avg_items_per_txn",
    S.with_base(
        ","
        + S.tercile_ctes()
        + "select avg("
        + " + ".join(f"cast(({c} is not null) as integer)" for c in S.ITEM_COLS)
        + ") as avg_items, count(*) as n_transactions from txn"
    ),
)
def q_avg_items(spark, sf):
    txn, cols, _ = _txn(spark, sf)
    return mining.mean_items_per_transaction(txn, cols)


def _rules(spark, sf):
    return mining.association_rules(_itemsets(spark, sf), DEFAULTS.min_confidence)


def _rule_out(r: DataFrame) -> DataFrame:
    r = mining.rule_strings(r)
    return r.select(
        F.col("antecedent_str").alias("antecedent"),
        F.col("consequent_str").alias("consequent"),
        r6("support"),
        r6("confidence"),
        r6("lift"),
    )


@register(
    "association_rules",
    _RULES_SQL + "select antecedent, consequent, " + S.round6(["support", "confidence", "lift"]) + " from rules",
)
def q_association_rules(spark, sf):
    return _rule_out(_rules(spark, sf))


@register(
    "top_rules_by_lift",
    _RULES_SQL
    + "select cast(row_number() over (order by lift desc, antecedent, consequent) as integer) as rank, antecedent, consequent, "
    + S.round6(["support", "confidence", "lift"])
    + f" from rules order by lift desc, antecedent, consequent limit {DEFAULTS.rules_top_n}",
)
def q_top_rules(spark, sf):
    top = mining.top_rules_by_lift(_rules(spark, sf), DEFAULTS.rules_top_n)
    return top.select(
        F.col("rank"),
        F.col("antecedent_str").alias("antecedent"),
        F.col("consequent_str").alias("consequent"),
        r6("support"),
        r6("confidence"),
        r6("lift"),
    )


@register(
    "rule_quality_checks",
    _RULES_SQL
    + """
select check_name, violations, violations = 0 as passed from (
  select 'support_in_unit_interval' as check_name, cast(count(*) filter (where isnan(support) or support < 0 or support > 1) as bigint) as violations from rules
  union all select 'confidence_in_unit_interval', cast(count(*) filter (where isnan(confidence) or confidence < 0 or confidence > 1) as bigint) from rules
  union all select 'no_label_tokens', cast(count(*) filter (where antecedent like '%label\\_%' escape '\\' or consequent like '%label\\_%' escape '\\' or antecedent like '%attack\\_cat\\_%' escape '\\' or consequent like '%attack\\_cat\\_%' escape '\\') as bigint) from rules
  union all select 'lift_above_one', cast(count(*) filter (where isnan(lift) or lift <= 1) as bigint) from rules)
""",
)
def q_rule_quality(spark, sf):
    return mining.rule_quality_checks(_rules(spark, sf))
FLAGSHIP = "triage_queue"


# --- stand-ins for model outputs: deterministic segment and score -------
# segment = proto code * 3 + service code (15 segments, some below 1 %);
# score = -Σ|round(z, 6)| over the scaled features; "noise" = sessions without lines.

from flowtriage.operators import triage, validate  # noqa: E402


def standin(spark, sf):
    """One projection of the written sessions carries everything the
    triage queries need (scaled features, segment, score, noise flag, labels),
    so the views below are column selections of one table — no key joins."""
    df, m = fitted(spark, sf)
    seg = F.col("__code_proto") * 3 + F.col("__code_service")
    w = m.with_codes(df).select(
        "session_id",
        *[m.scaled_expr(c).alias(c) for c in S.FEATURE_ORDER],
        seg.alias("cluster"),
        F.when(F.col("dur").isNull(), -1).otherwise(0).alias("noise_cluster"),
        "label",
        "attack_cat",
    )
    total = None
    for c in S.FEATURE_ORDER:
        t = F.abs(F.round(F.col(c), 6))
        total = t if total is None else total + t
    w = w.withColumn("anomaly_score", -total)
    return {
        "df": df,
        "model": m,
        "wide": w,
        "x": w.select("session_id", *S.FEATURE_ORDER),
        "clusters": w.select("session_id", "cluster"),
        "raw": w.select("session_id", "anomaly_score"),
        "noise": w.select("session_id", F.col("noise_cluster").alias("cluster")),
        "labels": w.select("session_id", "label", "attack_cat"),
        "labelled": w.select(
            "session_id", "cluster", F.coalesce(F.col("attack_cat"), F.lit("Normal")).alias("category")
        ),
    }


def triaged(spark, sf):
    """I3 on the stand-in score; segment, noise flag and features ride along."""
    st = standin(spark, sf)
    w = st["wide"].select(
        "session_id",
        "anomaly_score",
        F.col("cluster").alias("km_cluster"),
        (F.col("noise_cluster") == -1).cast("int").alias("dbscan_noise"),
        *S.FEATURE_ORDER,
    )
    scored, _ = triage.contamination_flags(materialise(w, "triaged"), DEFAULTS.contamination)
    return st, scored


_STANDIN_SQL = (
    ",\nclusters as (select session_id, proto * 3 + service as cluster from enc),\n"
    "raw as (select session_id, -("
    + " + ".join(f"abs(round({c}, 6))" for c in S.FEATURE_ORDER)
    + ") as anomaly_score from scaled),\n"
    "noise as (select session_id, case when dur is null then -1 else 0 end as cluster from feat),\n"
    f"offs as (select quantile_cont(anomaly_score, {DEFAULTS.contamination!r}) as off from raw),\n"
    "tri as (select r.session_id, r.anomaly_score - o.off as anomaly_score,"
    " cast(r.anomaly_score < o.off as integer) as anomaly_flag, c.cluster as km_cluster,"
    " cast(n.cluster = -1 as integer) as dbscan_noise"
    " from raw r cross join offs o join clusters c on c.session_id = r.session_id"
    " join noise n on n.session_id = r.session_id),\n"
    "dist as (select cluster, count(*) as n, count(*) * 100.0 / (select count(*) from clusters) as pct_raw,"
    " cast(count(*) as double) / (select count(*) from clusters) as share from clusters group by cluster),\n"
    "lj as (select c.session_id, c.cluster, coalesce(s.attack_cat, 'Normal') as category"
    " from clusters c join sessions s on s.session_id = c.session_id),\n"
    "cnt as (select cluster, category, count(*) as n from lj group by all),\n"
    "ct as (select g.cluster, k.category, cast(coalesce(cnt.n, 0) as bigint) as n"
    " from (select distinct cluster from cnt) g cross join (select distinct category from cnt) k"
    " left join cnt on cnt.cluster = g.cluster and cnt.category = k.category),\n"
    "pur as (select cluster, max(n) as n_dominant, sum(n) as cluster_total from ct group by cluster)\n"
)


def sw(body: str) -> str:
    return S.with_base(_STANDIN_SQL + body)


def RE(expr: str, digits: int) -> str:
    """Report rounding (half to even) in DuckDB."""
    return f"round_even(cast({expr} as double), {digits})"


def rounded(df: DataFrame, **digits) -> DataFrame:
    return df.withColumns({c: validate.round_even(c, d) for c, d in digits.items()})


@register("cluster_distribution", sw(f"select cluster, n, {RE('pct_raw', 2)} as pct from dist"))
def q_cluster_distribution(spark, sf):
    return rounded(validate.cluster_distribution(standin(spark, sf)["clusters"]).select("cluster", "n", "pct"), pct=2)


@register(
    "rare_clusters",
    sw(f"select cluster, n, {RE('pct_raw', 2)} as pct from dist where share < {DEFAULTS.rare_share!r}"),
)
def q_rare_clusters(spark, sf):
    return rounded(validate.rare_clusters(standin(spark, sf)["clusters"], DEFAULTS.rare_share).select("cluster", "n", "pct"), pct=2)


@register(
    "cluster_feature_means",
    sw(
        "select c.cluster, "
        + ", ".join(f"round(avg(x.{f}), 6) as {f}" for f in S.FEATURE_ORDER)
        + " from scaled x join clusters c on c.session_id = x.session_id group by c.cluster"
    ),
)
def q_cluster_feature_means(spark, sf):
    st = standin(spark, sf)
    m = validate.cluster_feature_means(st["wide"], None, S.FEATURE_ORDER)
    return m.select("cluster", *[r6(c) for c in S.FEATURE_ORDER])


@register("crosstab", sw("select cluster, category, n from ct"))
def q_crosstab(spark, sf):
    st = standin(spark, sf)
    return validate.crosstab_long(st["labelled"])


#: The market segments of the customer table.
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register(
    "crosstab_wide",
    sw(
        "select cluster, "
        + ", ".join(f"cast(count(*) filter (where category = '{c}') as bigint) as \"{c}\"" for c in MARKET_SEGMENTS)
        + " from lj group by cluster"
    ),
)
def q_crosstab_wide(spark, sf):
    st = standin(spark, sf)
    return validate.crosstab_wide(validate.crosstab_long(st["labelled"]))


@register("crosstab_log1p", sw("select cluster, category, n, round(ln(1 + cast(n as double)), 6) as log1p_n from ct"))
def q_crosstab_log1p(spark, sf):
    st = standin(spark, sf)
    ct = validate.crosstab_log1p(validate.crosstab_long(st["labelled"]))
    return ct.select("cluster", "category", "n", r6("log1p_n"))


@register(
    "purity",
    sw(f"select cluster, n_dominant, cast(cluster_total as bigint) as cluster_total, "
       f"{RE('cast(n_dominant as double) / cluster_total', 4)} as purity from pur"),
)
def q_purity(spark, sf):
    st = standin(spark, sf)
    p = validate.purity(validate.crosstab_long(st["labelled"]))
    return rounded(p.select("cluster", "n_dominant", F.col("cluster_total").cast("bigint").alias("cluster_total"), "purity"), purity=4)


@register(
    "dominant_category",
    sw(
        "select cluster, category as dominant_category, n as sessions_in_cat, cast(cluster_total as bigint) as cluster_total, "
        + RE("n * 100.0 / cluster_total", 2)
        + " as purity_pct from (select *, row_number() over (partition by cluster order by n desc, category) as rk,"
        " sum(n) over (partition by cluster) as cluster_total from ct) where rk = 1"
    ),
)
def q_dominant_category(spark, sf):
    st = standin(spark, sf)
    return rounded(validate.dominant_category(validate.crosstab_long(st["labelled"])), purity_pct=2)


_ARI_SQL = """,
pc as (select cast(sum(n * n) as double) as S, cast(sum(n) as double) as N from ct),
pa as (select cast(sum(a * a) as double) as A from (select sum(n) as a from ct group by cluster)),
pb as (select cast(sum(b * b) as double) as B from (select sum(n) as b from ct group by category)),
po as (select sum(n_dominant) / sum(cluster_total) as overall from pur),
q as (select S - N as tp, A - S as fp, B - S as fn, N * N + S - A - B as tn, overall, N from pc, pa, pb, po)
"""


@register(
    "adjusted_rand",
    S.with_base(
        _STANDIN_SQL
        + _ARI_SQL
        + "select "
        + RE("overall", 4)
        + " as overall_purity, "
        + RE(
            "case when fn = 0 and fp = 0 then 1.0 else 2.0 * (tp * tn - fn * fp)"
            " / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) end",
            4,
        )
        + " as ari, cast(N as bigint) as n_sessions from q"
    ),
)
def q_adjusted_rand(spark, sf):
    st = standin(spark, sf)
    return rounded(validate.agreement(validate.crosstab_long(st["labelled"])), overall_purity=4, ari=4)


@register(
    "contamination_flags",
    sw("select session_id, round(anomaly_score, 6) as anomaly_score, anomaly_flag from tri"),
)
def q_contamination_flags(spark, sf):
    _, t = triaged(spark, sf)
    return t.select("session_id", r6("anomaly_score"), "anomaly_flag")


@register(
    "soc_queue",
    sw(
        "select cast(row_number() over (order by t.anomaly_score, t.session_id) as integer) as rank, t.session_id, t.km_cluster, t.anomaly_flag, "
        "round(t.anomaly_score, 6) as anomaly_score, "
        + ", ".join(f"round(x.{f}, 6) as {f}" for f in S.FEATURE_ORDER)
        + f" from tri t join scaled x on x.session_id = t.session_id where t.anomaly_flag = 1"
        f" order by t.anomaly_score, t.session_id limit {DEFAULTS.queue_top_n}"
    ),
)
def q_soc_queue(spark, sf):
    st, t = triaged(spark, sf)
    q = triage.soc_queue(t.drop("dbscan_noise"), None, DEFAULTS.queue_top_n)
    return q.select("rank", "session_id", "km_cluster", "anomaly_flag", r6("anomaly_score"), *[r6(c) for c in S.FEATURE_ORDER])


@register(
    "anomaly_by_cluster",
    sw(
        "select km_cluster as cluster, count(*) as sessions_in_cluster, cast(sum(anomaly_flag) as bigint) as if_anomalies, "
        + RE("sum(anomaly_flag) * 100.0 / count(*)", 2)
        + " as if_anomaly_rate_pct from tri group by km_cluster"
    ),
)
def q_anomaly_by_cluster(spark, sf):
    _, t = triaged(spark, sf)
    return rounded(triage.anomaly_by_cluster(t), if_anomaly_rate_pct=2)


@register(
    "dual_flagged",
    sw(
        "select n_sessions, n_anomalies, "
        + RE("n_anomalies * 100.0 / n_sessions", 2)
        + " as anomaly_pct, dual_flagged, "
        + RE("dual_flagged * 100.0 / greatest(n_anomalies, 1)", 1)
        + " as dual_pct from (select count(*) as n_sessions, cast(sum(anomaly_flag) as bigint) as n_anomalies,"
        " cast(count(*) filter (where anomaly_flag = 1 and dbscan_noise = 1) as bigint) as dual_flagged from tri)"
    ),
)
def q_dual_flagged(spark, sf):
    _, t = triaged(spark, sf)
    return rounded(triage.anomaly_totals(t), anomaly_pct=2, dual_pct=1)


_VOTES_SQL = (
    ", votes as (select t.*, coalesce(r.rare, 0) as rare_segment,"
    " coalesce(r.rare, 0) + dbscan_noise + anomaly_flag as votes from tri t"
    f" left join (select cluster, 1 as rare from dist where share < {DEFAULTS.rare_share!r}) r on r.cluster = t.km_cluster)\n"
)


@register(
    "consensus_rank",
    sw(
        _VOTES_SQL
        + "select cast(row_number() over (order by votes desc, anomaly_score, session_id) as integer) as rank, session_id, km_cluster,"
        " votes, rare_segment, dbscan_noise, anomaly_flag, round(anomaly_score, 6) as anomaly_score from votes"
        f" where votes > 0 order by votes desc, anomaly_score, session_id limit {DEFAULTS.queue_top_n}"
    ),
)
def q_consensus_rank(spark, sf):
    st, t = triaged(spark, sf)
    rare = validate.rare_clusters(st["clusters"], DEFAULTS.rare_share)
    r = triage.consensus_rank(triage.consensus_votes(t, rare), DEFAULTS.queue_top_n)
    return r.select("rank", "session_id", "km_cluster", "votes", "rare_segment", "dbscan_noise", "anomaly_flag", r6("anomaly_score"))


@register(
    "consensus_votes",
    sw(_VOTES_SQL + "select votes, count(*) as n_sessions from votes group by votes"),
)
def q_consensus_votes(spark, sf):
    st, t = triaged(spark, sf)
    rare = validate.rare_clusters(st["clusters"], DEFAULTS.rare_share)
    return triage.consensus_votes(t, rare).groupBy("votes").agg(F.count(F.lit(1)).alias("n_sessions"))


@register(
    "score_histogram",
    sw(
        """, g as (select anomaly_flag, min(anomaly_score) as mn, max(anomaly_score) as mx, count(*) as n_group,
                 case when anomaly_flag = 1 then 40 else 60 end as nb from tri group by anomaly_flag),
g2 as (select *, case when mn = mx then mn - 0.5 else mn end as lo, case when mn = mx then mx + 0.5 else mx end as hi from g),
h as (select t.anomaly_flag, cast(least(floor((t.anomaly_score - g2.lo) * (g2.nb / (g2.hi - g2.lo))), g2.nb - 1) as integer) as bin,
             g2.lo, g2.hi, g2.nb, g2.n_group, count(*) as n
      from tri t join g2 on g2.anomaly_flag = t.anomaly_flag group by all)
select anomaly_flag, bin, round(lo + bin * ((hi - lo) / nb), 6) as bin_lo, n,
       round(n / (n_group * ((hi - lo) / nb)), 6) as density from h"""
    ),
)
def q_score_histogram(spark, sf):
    _, t = triaged(spark, sf)
    h = triage.score_histogram(t)
    return h.select("anomaly_flag", "bin", r6("bin_lo"), "n", r6("density"))


#: The caller's table of this query.
RISK_ROWS = [(3, "HIGH RISK", "Scanning"), (6, "CRITICAL RISK", "Large uploads"), (9, "HIGH RISK", "Regular beacons")]


@register(
    "risk_annotation",
    sw(
        ", risk(cluster, tier, subtitle) as (values (3, 'HIGH RISK', 'Scanning'),"
        " (6, 'CRITICAL RISK', 'Large uploads'), (9, 'HIGH RISK', 'Regular beacons'))\n"
        "select d.cluster, d.n as sessions, coalesce(r.tier, 'ELEVATED RISK') as tier,"
        " coalesce(r.subtitle, 'Anomalous Cluster ' || cast(d.cluster as varchar)) as subtitle"
        " from dist d left join risk r on r.cluster = d.cluster"
    ),
)
def q_risk_annotation(spark, sf):
    return triage.risk_annotation(spark, standin(spark, sf)["clusters"], RISK_ROWS)


# --- C5, A10 on the customer profile (3-d points) ---------------------------------

from flowtriage.operators import density  # noqa: E402

PROFILE_EPS = 0.5
PROFILE_COLS = ["x", "y", "z"]


def _dbscan_sql(eps: float, min_samples: int) -> str:
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PROFILE_COLS)
    return f""",
pairs as (select a.customer_id as i, b.customer_id as j from profile a join profile b on {d2} <= {eps * eps!r}),
nb as (select i, count(*) as n from pairs group by i),
core as (select i from nb where n >= {min_samples}),
ce as (select p.i, p.j from pairs p join core c1 on c1.i = p.i join core c2 on c2.i = p.j),
reach as (select i, min(root) as comp from (
    with recursive r(i, root) as (select i, i from core union select ce.j, r.root from r join ce on ce.i = r.i)
    select * from r) group by i),
num as (select comp, cast(dense_rank() over (order by comp) - 1 as integer) as cluster from (select distinct comp from reach)),
corelab as (select reach.i, num.cluster from reach join num on num.comp = reach.comp),
border as (select p.i, min(cl.cluster) as cluster from pairs p join corelab cl on cl.i = p.j
           where p.i not in (select i from core) group by p.i),
db as (select profile.customer_id, cast(coalesce(corelab.cluster, border.cluster, -1) as integer) as cluster
       from profile left join corelab on corelab.i = profile.customer_id left join border on border.i = profile.customer_id)
"""


def _profile_dbscan(spark, sf):
    p = src.customer_profile(spark, sf)
    return density.dbscan(p, PROFILE_COLS, PROFILE_EPS, DEFAULTS.dbscan_min_samples, key="customer_id")


@register("dbscan", S.with_base(_dbscan_sql(PROFILE_EPS, DEFAULTS.dbscan_min_samples) + "select customer_id, cluster from db"))
def q_dbscan(spark, sf):
    return _profile_dbscan(spark, sf)


@register(
    "dbscan_summary",
    S.with_base(
        _dbscan_sql(PROFILE_EPS, DEFAULTS.dbscan_min_samples)
        + "select cast(count(distinct cluster) filter (where cluster >= 0) as bigint) as n_clusters,"
        " cast(count(*) filter (where cluster = -1) as bigint) as n_noise, "
        + RE("count(*) filter (where cluster = -1) * 100.0 / count(*)", 4)
        + " as noise_pct, count(*) - count(*) filter (where cluster = -1) as n_clustered from db"
    ),
)
def q_dbscan_summary(spark, sf):
    return rounded(validate.dbscan_summary(_profile_dbscan(spark, sf)), noise_pct=4)


# --- C1–C4, W1–W3, F12 ------------------------------------------------------------

from flowtriage.functions.scalar import sample_key_sql  # noqa: E402
from flowtriage.operators import segment  # noqa: E402

_EMB_SQL = """,
emb as (select vec_id, label, cast(embedding as double[]) as v from embeddings),
ecent as (select label as cluster, list(m order by i) as c from (
    select label, i, avg(x) as m from (select label, unnest(v) as x, generate_subscripts(v, 1) as i from emb)
    group by label, i) group by label),
ecent_num as (select cast(dense_rank() over (order by cluster) - 1 as integer) as k, c from ecent)
"""


@register(
    "kmeans_assign",
    S.with_base(
        _EMB_SQL
        + """select vec_id, k as cluster from (
    select e.vec_id, c.k, row_number() over (partition by e.vec_id order by
        list_sum(list_transform(list_zip(e.v, c.c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))), c.k) as rn
    from emb e cross join ecent_num c) where rn = 1"""
    ),
)
def q_kmeans_assign(spark, sf):
    """C2 with fixed centroids (the per-label means of the embeddings)."""
    e = src.embeddings(spark, sf)
    _, C = segment.vector_centroids(e, "embedding", "label")
    return e.select("vec_id", segment.assign_expr(C, "embedding").alias("cluster"))


@register("kmeans_search")
def q_kmeans_search(spark, sf):
    """C1 + C3 + C4 + W3 on the scaled session features (randomised → rows only)."""
    df, m = fitted(spark, sf)
    x = spread(m.transform(df), "session_id", "features")
    res = segment.kmeans_search(x, m.feature_names)
    return res["scores"].withColumn("selected", F.col("k") == F.lit(res["best_k"]))


_SIL_SQL = (
    ",\nsamp as (select * from profile order by "
    + sample_key_sql("customer_id", DEFAULTS.seed)
    + f", customer_id limit {DEFAULTS.silhouette_sample}),\n"
    """pd as (select a.customer_id, a.segment as own, b.segment as other,
             sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) as d
      from samp a join samp b on a.customer_id <> b.customer_id),
pm as (select customer_id, own, other, avg(d) as md from pd group by all),
ps as (select customer_id, max(case when other = own then md end) as a, min(case when other <> own then md end) as b from pm group by customer_id),
sil as (select avg(case when a is null then 0.0 else (b - a) / greatest(a, b) end) as s from ps)
"""
)


@register("silhouette_exact", S.with_base(_SIL_SQL + "select round(s, 4) as silhouette from sil"))
def q_silhouette_exact(spark, sf):
    """C3 (exact Euclidean) of the market-segment labelling of the customer profile."""
    p = src.customer_profile(spark, sf)
    codes = sorted(r[0] for r in p.select("segment").distinct().collect())
    lab = p.withColumn("seg_code", F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("segment")).cast("int"))
    sample = segment.silhouette_sample(lab, "customer_id", DEFAULTS.silhouette_sample, DEFAULTS.seed)
    s = segment.silhouette_scores(sample, PROFILE_COLS, ["seg_code"], key="customer_id")["seg_code"]
    return spark.createDataFrame([(round(s, 4),)], "silhouette double")


def _emb_k_scores(spark, sf):
    """Silhouette of 'nearest of the first K label centroids' for K = 2..10 (C2 + C3)."""
    e = src.embeddings(spark, sf)
    _, C = segment.vector_centroids(e, "embedding", "label")
    sample = segment.silhouette_sample(e.select("vec_id", "embedding"), "vec_id", DEFAULTS.silhouette_sample, DEFAULTS.seed)
    wide, cols = segment.vector_columns(sample, "embedding")
    ks = [k for k in range(DEFAULTS.k_min, DEFAULTS.k_max + 1) if k <= C.shape[0]]
    labelled = wide.select("vec_id", *cols, *[segment.assign_expr(C[:k], "embedding").alias(f"k{k}") for k in ks])
    sil = segment.silhouette_scores(labelled, cols, [f"k{k}" for k in ks], key="vec_id")
    return spark.createDataFrame([(k, round(sil[f"k{k}"], 4)) for k in ks], "k int, silhouette double")


_KSIL_SQL = (
    _EMB_SQL
    + ",\nesamp as (select * from emb order by "
    + sample_key_sql("vec_id", DEFAULTS.seed)
    + f", vec_id limit {DEFAULTS.silhouette_sample}),\n"
    + f"""kk as (select range as k from range({DEFAULTS.k_min}, {DEFAULTS.k_max + 1})),
ed as (select s.vec_id, c.k as idx,
              list_sum(list_transform(list_zip(s.v, c.c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) as d
       from esamp s cross join ecent_num c),
elab as (select vec_id, k, idx as cl from (
           select ed.vec_id, kk.k, ed.idx, row_number() over (partition by ed.vec_id, kk.k order by ed.d, ed.idx) as rn
           from ed join kk on ed.idx < kk.k) where rn = 1),
epd as (select a.vec_id as i, b.vec_id as j,
               sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))) as d
        from esamp a join esamp b on a.vec_id <> b.vec_id),
epm as (select la.k, p.i, la.cl as own, lb.cl as other, avg(p.d) as md
        from epd p join elab la on la.vec_id = p.i join elab lb on lb.vec_id = p.j and lb.k = la.k
        group by all),
eps as (select k, i, max(case when other = own then md end) as a, min(case when other <> own then md end) as b
        from epm group by k, i),
ksil as (select cast(k as integer) as k, round(avg(case when a is null then 0.0 else (b - a) / greatest(a, b) end), 4) as silhouette
         from eps group by k)
"""
)


@register("silhouette_by_k", S.with_base(_KSIL_SQL + "select k, silhouette from ksil"))
def q_silhouette_by_k(spark, sf):
    """C3 for every K of a deterministic K search over the embeddings."""
    return _emb_k_scores(spark, sf)


@register(
    "best_k",
    S.with_base(_KSIL_SQL + "select k, silhouette from ksil order by silhouette desc, k limit 1"),
)
def q_best_k(spark, sf):
    """Highest silhouette (rounded to 4), smallest K on ties."""
    return segment.best_k(_emb_k_scores(spark, sf))


def _standin_centroids(spark, sf):
    st = standin(spark, sf)
    means = validate.cluster_feature_means(st["wide"], None, S.FEATURE_ORDER)
    return segment.centroids_long(means.select("cluster", *[r6(c) for c in S.FEATURE_ORDER]), S.FEATURE_ORDER)


_CENT_SQL = (
    ",\ncmeans as (select c.cluster, "
    + ", ".join(f"round(avg(x.{f}), 6) as {f}" for f in S.FEATURE_ORDER)
    + " from scaled x join clusters c on c.session_id = x.session_id group by c.cluster),\n"
    "cl as (select cluster, feature, value from (unpivot cmeans on "
    + ", ".join(S.FEATURE_ORDER)
    + " into name feature value value))\n"
)


@register(
    "centroid_top_features",
    sw(
        _CENT_SQL
        + f"""select cluster, side, rank, feature, value from (
  select cluster, 'high' as side, cast(row_number() over (partition by cluster order by value desc, feature) as integer) as rank, feature, value from cl
  union all
  select cluster, 'low', cast(row_number() over (partition by cluster order by value, feature) as integer), feature, value from cl)
where rank <= {DEFAULTS.top_features_n}"""
    ),
)
def q_centroid_top_features(spark, sf):
    r = segment.centroid_top_features(_standin_centroids(spark, sf), DEFAULTS.top_features_n)
    return r.withColumn("rank", F.col("rank").cast("int"))


@register(
    "discriminating_features",
    sw(
        _CENT_SQL
        + f""", fs as (select feature, avg(abs(value)) as mean_abs from cl group by feature),
top as (select feature, mean_abs, cast(row_number() over (order by mean_abs desc, feature) as integer) as feature_rank from fs
        order by mean_abs desc, feature limit {DEFAULTS.heatmap_features_n})
select top.feature_rank, cl.feature, cl.cluster, cl.value, round(top.mean_abs, 6) as mean_abs from cl join top on top.feature = cl.feature"""
    ),
)
def q_discriminating_features(spark, sf):
    r = segment.discriminating_features(_standin_centroids(spark, sf), DEFAULTS.heatmap_features_n)
    return r.select(F.col("feature_rank").cast("int").alias("feature_rank"), "feature", "cluster", "value", r6("mean_abs"))


@register(
    "scatter_sample",
    sw(
        "select x.session_id, round(x.sbytes, 6) as sbytes, round(x.dbytes, 6) as dbytes, c.cluster"
        " from scaled x join clusters c on c.session_id = x.session_id order by "
        + sample_key_sql("x.session_id", DEFAULTS.seed)
        + f", x.session_id limit {DEFAULTS.scatter_sample}"
    ),
)
def q_scatter_sample(spark, sf):
    st = standin(spark, sf)
    s = segment.scatter_sample(st["wide"], None, DEFAULTS.scatter_x, DEFAULTS.scatter_y, DEFAULTS.scatter_sample)
    return s.select("session_id", r6("sbytes"), r6("dbytes"), "cluster")


# --- Q1, Q2 -------------------------------------------------------------------------

from flowtriage.operators import search  # noqa: E402

SEARCH_K = 10
SEARCH_LABEL = 6
# Query profile for Q2 (standardised units): outbound-heavy, large packets, long sessions.
SEARCH_PROFILE = {"outbound_dominance_ratio": 2.0, "bytes_per_packet": 2.0, "dur": 1.0, "packet_rate": -1.0}


@register(
    "similar_to_centroid",
    S.with_base(
        _EMB_SQL
        + f""", q as (select c from ecent where cluster = {SEARCH_LABEL}),
sc as (select e.vec_id, e.label as cluster,
              list_dot_product(e.v, q.c) / (sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(q.c, q.c))) as sim
       from emb e cross join q)
select vec_id, cluster, round(sim, 6) as similarity_score,
       cast(row_number() over (order by sim desc, vec_id) as integer) as rank
from sc order by sim desc, vec_id limit {SEARCH_K}"""
    ),
)
def q_similar_to_centroid(spark, sf):
    e = src.embeddings(spark, sf)
    r = search.similar_to_centroid(e, "embedding", "label", SEARCH_LABEL, "vec_id", SEARCH_K)
    return r.select("vec_id", "cluster", r6("similarity_score"), F.col("rank").cast("int").alias("rank"))


_PROF_DOT = " + ".join(f"x.{c} * {float(v)!r}" for c, v in SEARCH_PROFILE.items())
_PROF_NN = " + ".join(f"x.{c} * x.{c}" for c in SEARCH_PROFILE)
_PROF_QN = sum(v * v for v in SEARCH_PROFILE.values()) ** 0.5


@register(
    "similar_to_profile",
    sw(
        f""", sc as (select x.session_id, c.cluster, ({_PROF_DOT}) / (sqrt({_PROF_NN}) * {_PROF_QN!r}) as sim
       from scaled x join clusters c on c.session_id = x.session_id)
select session_id, cluster, round(sim, 6) as similarity_score,
       cast(row_number() over (order by sim desc, session_id) as integer) as rank
from sc where sim is not null order by sim desc, session_id limit {SEARCH_K}"""
    ),
)
def q_similar_to_profile(spark, sf):
    st = standin(spark, sf)
    x = st["wide"]
    r = search.similar_to_profile(x, SEARCH_PROFILE, "session_id", SEARCH_K, "cluster")
    return r.select("session_id", "cluster", r6("similarity_score"), F.col("rank").cast("int").alias("rank"))


# --- I1, I2 (randomised → rows only) ----------------------------------------------

from flowtriage.operators import iforest  # noqa: E402


def _forest_scores(spark, sf):
    df, m = fitted(spark, sf)
    x = spread(m.transform(df), "session_id", "features")
    forest = iforest.fit_isolation_forest(x, m.feature_names, DEFAULTS.n_trees, seed=DEFAULTS.seed)
    raw = materialise(iforest.score(x, forest), "scores")
    scored, _ = triage.contamination_flags(raw, DEFAULTS.contamination)
    return x, scored


@register("isolation_forest")
def q_isolation_forest(spark, sf):
    _, scored = _forest_scores(spark, sf)
    return scored.select("session_id", r6("anomaly_score"), "anomaly_flag")


# --- F14–F17, S2, M6, W6 -------------------------------------------------------------

from flowtriage.operators import rules_view  # noqa: E402


def _case_map(expr: str, d: dict, lower_keys: bool) -> str:
    whens = " ".join(
        "when '{}' then '{}'".format((k.lower() if lower_keys else k).replace("'", "''"), v.replace("'", "''"))
        for k, v in d.items()
    )
    return f"(case {expr} {whens} end)"


def _title_sql(expr: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({expr}, ' '),"
        " lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ')"
    )


def _phrase_sql(x: str) -> str:
    q = f"regexp_extract(lower({x}), '^(.*)_(high|low|medium)$', 2)"
    base = f"substring({x}, 1, length({x}) - length({q}) - 1)"
    alias = f"coalesce({_case_map(base, rules_view.SHORT_LABELS, False)}, {_title_sql(f'replace({base}, chr(95), chr(32))')})"
    binned = f"upper(substring({q}, 1, 1)) || lower(substring({q}, 2)) || ' ' || {alias}"
    return f"(case when {q} <> '' then {binned} else coalesce({_case_map(x, rules_view.SHORT_LABELS, False)}, {x}) end)"


def _human_sql(lst: str) -> str:
    return (
        f"array_to_string(list_transform({lst}, lambda x: coalesce("
        + _case_map("lower(x)", rules_view.TOKEN_LABELS, True)
        + ", x)), ' + ')"
    )


_LABELS_SQL = f""",
lab as (select antecedent, consequent, a_list, c_list, lift, confidence,
    array_to_string(list_transform(a_list, lambda x: {_phrase_sql('x')}), ' + ') as a_ph,
    array_to_string(list_transform(c_list, lambda x: {_phrase_sql('x')}), ' + ') as c_ph,
    antecedent || '  →  ' || consequent as lbl from rules)
select antecedent, consequent,
       {_human_sql('a_list')} as antecedent_text,
       {_human_sql('c_list')} as consequent_text,
       case when length(a_ph || ' -> ' || c_ph) <= {rules_view.TITLE_MAX} then a_ph || ' -> ' || c_ph
            else substring(a_ph, 1, {rules_view.TITLE_MAX - 3}) || '...' end as pattern_title,
       case when length(lbl) > {rules_view.CHART_LABEL_MAX} then substring(lbl, 1, {rules_view.CHART_LABEL_MAX - 3}) || '...'
            else lbl end as chart_label,
       case when lift > 7 then 'strong' when lift > 5 then 'elevated' else 'base' end as lift_tier,
       case when confidence >= 0.85 then 'high' else 'moderate' end as confidence_tier
from lab"""


@register("rule_labels", _RULES_SQL + _LABELS_SQL)
def q_rule_labels(spark, sf):
    return rules_view.rule_labels(_rules(spark, sf))


@register(
    "rules_export",
    _RULES_SQL + "select antecedent, consequent, " + S.round6(["support", "confidence", "lift"]) + " from rules",
)
def q_rules_export(spark, sf):
    return rules_view.export_rows(_rules(spark, sf))


def _segment_rules(spark, sf):
    st = standin(spark, sf)
    m = st["model"]
    seg = F.col("__code_proto") * 3 + F.col("__code_service")
    txn, cols, _ = mining.build_transactions(m.with_codes(st["df"]).withColumn("cluster", seg), keep=["cluster"])
    its = materialise(mining.frequent_itemsets(txn, cols, DEFAULTS.min_support, segment_col="cluster"), "segment-itemsets")
    return st, mining.association_rules(its, DEFAULTS.min_confidence, segment_col="cluster")


_SEG_SQL = S.with_base(
    _STANDIN_SQL
    + ","
    + S.tercile_ctes()
    + ", txs as (select t.*, c.cluster from txn t join clusters c on c.session_id = t.session_id),"
    + S.itemset_ctes(DEFAULTS.min_support, txn="txs", seg="cluster")
    + ","
    + S.rules_ctes(DEFAULTS.min_confidence, seg="cluster")
)


@register(
    "segment_rules",
    _SEG_SQL + "select cluster, antecedent, consequent, " + S.round6(["support", "confidence", "lift"]) + " from rules",
)
def q_segment_rules(spark, sf):
    _, r = _segment_rules(spark, sf)
    r = mining.rule_strings(r)
    return r.select(
        "cluster",
        F.col("antecedent_str").alias("antecedent"),
        F.col("consequent_str").alias("consequent"),
        r6("support"),
        r6("confidence"),
        r6("lift"),
    )


@register(
    "segment_top_rules",
    _SEG_SQL
    + f""", pri as (select cluster from dist where share < {DEFAULTS.rare_share!r}),
rk as (select r.*, cast(row_number() over (partition by r.cluster order by lift desc, antecedent, consequent) as integer) as rank
       from rules r join pri on pri.cluster = r.cluster)
select cluster, rank, antecedent, consequent, round(lift, 6) as lift, rank = 1 as is_best
from rk where rank <= {DEFAULTS.segment_rules_top_n}""",
)
def q_segment_top_rules(spark, sf):
    st, r = _segment_rules(spark, sf)
    pri = [row[0] for row in validate.rare_clusters(st["clusters"], DEFAULTS.rare_share).select("cluster").collect()]
    top = mining.top_rules_per_segment(r, "cluster", pri, DEFAULTS.segment_rules_top_n)
    return top.select(
        "cluster",
        F.col("rank").cast("int").alias("rank"),
        F.col("antecedent_str").alias("antecedent"),
        F.col("consequent_str").alias("consequent"),
        r6("lift"),
        "is_best",
    )


# --- S8 run report (metrics table) ---------------------------------------------------

from flowtriage.plans import report  # noqa: E402


@register(
    "run_report",
    S.with_base(
        _STANDIN_SQL
        + _dbscan_sql(PROFILE_EPS, DEFAULTS.dbscan_min_samples)
        + _KSIL_SQL
        + f"""
select 'dataset' as section, 'feature_count' as name, cast({len(S.FEATURE_ORDER)} as double) as value
union all select 'kmeans', 'best_k', cast((select k from ksil order by silhouette desc, k limit 1) as double)
union all select 'dbscan', 'eps', cast({PROFILE_EPS!r} as double)
union all select 'dbscan', 'min_samples', cast({DEFAULTS.dbscan_min_samples} as double)
union all select 'dataset', 'total_records', cast(count(*) as double) from clusters
union all select 'silhouette', 'k=' || cast(k as varchar), silhouette from ksil
union all select 'cluster_size', 'cluster_' || cast(cluster as varchar), cast(n as double) from dist
union all select 'cluster_pct', 'cluster_' || cast(cluster as varchar), {RE('pct_raw', 2)} from dist
union all select 'rare_cluster', 'cluster_' || cast(cluster as varchar), 1.0 from dist where share < {DEFAULTS.rare_share!r}
union all select 'dbscan', 'n_clusters', cast(count(distinct cluster) filter (where cluster >= 0) as double) from db
union all select 'dbscan', 'n_noise', cast(count(*) filter (where cluster = -1) as double) from db
union all select 'dbscan', 'noise_pct', {RE('count(*) filter (where cluster = -1) * 100.0 / count(*)', 4)} from db
"""
    ),
)
def q_run_report(spark, sf):
    st = standin(spark, sf)
    scores = _emb_k_scores(spark, sf)
    best = segment.best_k(scores).first()["k"]
    return report.run_metrics(
        spark, st["clusters"], _profile_dbscan(spark, sf), scores, best, len(S.FEATURE_ORDER), PROFILE_EPS,
        DEFAULTS.dbscan_min_samples, DEFAULTS.rare_share,
    )


# --- whole run (randomised models → rows only) -------------------------------------

from flowtriage.plans import triage_run  # noqa: E402


@register("triage_queue")
def q_triage_queue(spark, sf):
    """All stages end to end; the consensus-ranked analyst queue (top 20)."""
    r = triage_run.run_triage(spark, sessions(spark, sf))
    return triage_run.triage_queue(r)


# --- J1, J2/J3 as explicit key joins of separately produced tables -------------------


@register(
    "label_join",
    sw("select c.session_id, c.cluster, coalesce(s.attack_cat, 'Normal') as category"
       " from clusters c join sessions s on s.session_id = c.session_id"),
)
def q_label_join(spark, sf):
    """Segment labels ⋈ withheld categories (from the raw session view)."""
    st = standin(spark, sf)
    labels = sessions(spark, sf).select("session_id", "attack_cat")
    return validate.label_join(st["clusters"], labels)


@register(
    "triage_join",
    sw("select session_id, round(anomaly_score, 6) as anomaly_score, anomaly_flag, km_cluster, dbscan_noise from tri"),
)
def q_triage_join(spark, sf):
    """Flagged scores ⋈ segments ⋈ DBSCAN noise, each a separate table."""
    st = standin(spark, sf)
    scored, _ = triage.contamination_flags(st["raw"], DEFAULTS.contamination)
    t = triage.attach(scored, st["clusters"], st["noise"])
    return t.select("session_id", r6("anomaly_score"), "anomaly_flag", "km_cluster", "dbscan_noise")


@register(
    "eps_neighbours",
    S.with_base(
        f"""select a.customer_id, count(*) as n from profile a join profile b
on {" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PROFILE_COLS)} <= {PROFILE_EPS * PROFILE_EPS!r} group by a.customer_id"""
    ),
)
def q_eps_neighbours(spark, sf):
    """Customers within eps of each customer of the profile, itself included."""
    return density.neighbour_counts(src.customer_profile(spark, sf), PROFILE_COLS, PROFILE_EPS, "customer_id")


def _session_density(spark, sf):
    """C5 with the reference defaults (eps 1.5, min_samples 10) on the scaled session features, rounded to 6 places
    so that every engine measures the same distances."""
    df, m = fitted(spark, sf)
    x = spread(m.transform(df), "session_id", "features")
    rounded_x = x.select("session_id", *[r6(c) for c in m.feature_names])
    return density.dbscan(rounded_x, m.feature_names, DEFAULTS.dbscan_eps, DEFAULTS.dbscan_min_samples)


@register("dbscan_sessions")
def q_dbscan_sessions(spark, sf):
    """Cluster of every session; ``dbscan_sessions_noise`` checks the noise set against DuckDB, ``dbscan`` the clusters."""
    return _session_density(spark, sf)


_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in S.FEATURE_ORDER)


@register(
    "dbscan_sessions_noise",
    S.with_base(
        f""",
z as (select {", ".join(f"round({c}, 6) as {c}" for c in S.FEATURE_ORDER)}, session_id from scaled),
u as (select {", ".join(S.FEATURE_ORDER)}, count(*) as w, min(session_id) as id from z group by all),
near as (select a.id as i, b.id as j, b.w as w from u a join u b on {_D2} <= {DEFAULTS.dbscan_eps**2!r}),
core as (select i from near group by i having sum(w) >= {DEFAULTS.dbscan_min_samples}),
reached as (select distinct near.i from near join core on core.i = near.j)
select z.session_id, r.i is null as is_noise from z
join u on {" and ".join(f"z.{c} = u.{c}" for c in S.FEATURE_ORDER)} left join reached r on r.i = u.id"""
    ),
)
def q_dbscan_sessions_noise(spark, sf):
    return _session_density(spark, sf).select("session_id", (F.col("cluster") == -1).alias("is_noise"))


@register(
    "rules_on_imputed",
    S.with_base("," + S.tercile_ctes("imp") + "," + S.itemset_ctes(DEFAULTS.min_support) + "," + S.rules_ctes(DEFAULTS.min_confidence))
    + "select antecedent, consequent, " + S.round6(["support", "confidence", "lift"]) + " from rules",
)
def q_rules_on_imputed(spark, sf):
    """M8 as the run does it: rules mined on the imputed frame."""
    df, m = fitted(spark, sf)
    _, rules = mining.mine_rules(m.impute(df), DEFAULTS.min_support, DEFAULTS.min_confidence)
    return _rule_out(rules)


@register("session_csv", S.with_base("select " + "session_id, dur, proto, service, state, spkts, dpkts, sbytes, dbytes, label, attack_cat from sessions"))
def q_session_csv(spark, sf):
    """The session view written as headered CSV with its columns in another order, and loaded by name."""
    s = sessions(spark, sf).withColumnRenamed("session_id", "id")
    path = f"{shared_dir(spark)}/session-csv-{uuid.uuid4().hex}"
    s.select(*sorted(s.columns, reverse=True)).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField(c, s.schema[c].dataType) for c in s.columns])
    return src.load_sessions(spark, path, schema=schema)


@register(
    "encode_many_values",
    "select o_orderkey, cast(dense_rank() over (order by c_name) - 1 as integer) as c_name,"
    " cast(dense_rank() over (order by cast(o_orderdate as varchar)) - 1 as integer) as o_day"
    " from orders join customer on c_custkey = o_custkey",
)
def q_encode_many_values(spark, sf):
    """T3 over text columns with thousands of values."""
    o = spark.read.parquet(table_path(sf, "orders")).select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("string").alias("o_day"))
    c = spark.read.parquet(table_path(sf, "customer")).select("c_custkey", "c_name")
    df = materialise(o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_day"), "orders")
    return prep.fit_preprocessor(df, key="o_orderkey", label_cols=()).encode(df)


_GAPS = "case when o_orderkey % 7 = 0 then null when o_orderkey % 5 = 0 then cast('nan' as double) else o_totalprice end"


@register(
    "scale_with_nan",
    f"""with g as (select o_orderkey, {_GAPS} as price from orders),
i as (select o_orderkey, case when price is null or isnan(price) then (select median(price) from g where not isnan(price)) else price end as price from g)
select o_orderkey, round((price - (select avg(price) from i)) / (select stddev_pop(price) from i), 6) as price from i""",
)
def q_scale_with_nan(spark, sf):
    """T1 + T4 where NaN is missing as null is."""
    price = F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_orderkey") % 5 == 0, float("nan")).otherwise(F.col("o_totalprice"))
    df = spark.read.parquet(table_path(sf, "orders")).select("o_orderkey", price.cast("double").alias("price"))
    m = prep.fit_preprocessor(df, key="o_orderkey", label_cols=())
    return m.transform(df).select("o_orderkey", r6("price"))


# --- C1, I2 from fixed parameters ------------------------------------------------------


@register(
    "lloyd_step",
    S.with_base(
        f""",
z as (select session_id, {", ".join(f"round({c}, 6) as {c}" for c in S.FEATURE_ORDER)} from scaled),
cen as (select row_number() over (order by session_id) - 1 as k, * from (select * from z order by session_id limit 4)),
d as (select a.session_id, b.k, {_D2} as d2, row_number() over (partition by a.session_id order by {_D2}, b.k) as rn from z a cross join cen b)
select cast(d.k as integer) as cluster, count(*) as n, round(sum(d2), 3) as inertia, {", ".join(f"round(avg(z.{c}), 6) as {c}" for c in S.FEATURE_ORDER)}
from d join z on z.session_id = d.session_id where rn = 1 group by d.k"""
    ),
)
def q_lloyd_step(spark, sf):
    """One pass of the K-Means fit from fixed centres (the four smallest sessions)."""
    df, m = fitted(spark, sf)
    names = m.feature_names
    x = materialise(m.transform(df).select("session_id", *[r6(c) for c in names]), "features")
    first = x.orderBy("session_id").limit(4).toPandas()
    sums, n, inertia = segment.lloyd_pass(x, names, {0: first[names].to_numpy(dtype=float)})[0]
    rows = [(k, int(n[k]), float(inertia[k]), *[float(v / n[k]) for v in sums[k]]) for k in range(4) if n[k]]
    out = spark.createDataFrame(rows, "cluster int, n bigint, inertia double, " + ", ".join(f"{c} double" for c in names))
    return out.select("cluster", "n", F.round("inertia", 3).alias("inertia"), *[r6(c) for c in S.FEATURE_ORDER])


#: A fixed forest: (tree, node, feature, threshold, left, right, size).
FIXED_FOREST = [
    (0, 0, 0, 0.25, 1, 2, 8), (0, 1, -1, 0.0, -1, -1, 3), (0, 2, 4, -0.5, 3, 4, 5), (0, 3, -1, 0.0, -1, -1, 1), (0, 4, -1, 0.0, -1, -1, 4),
    (1, 0, 6, 0.1, 1, 2, 8), (1, 1, -1, 0.0, -1, -1, 6), (1, 2, -1, 0.0, -1, -1, 2),
    (2, 0, 1, 0.0, 1, 2, 8), (2, 1, 8, 0.4, 3, 4, 5), (2, 2, -1, 0.0, -1, -1, 3), (2, 3, -1, 0.0, -1, -1, 4), (2, 4, -1, 0.0, -1, -1, 1),
]
_C = "2 * (ln({n} - 1.0) + 0.5772156649) - 2 * ({n} - 1.0) / {n}"


@register(
    "forest_scores",
    S.with_base(
        f""",
z as (select session_id, {", ".join(f"round({c}, 6) as {c}" for c in S.FEATURE_ORDER)} from scaled),
h as (select session_id,
  case when {S.FEATURE_ORDER[0]} <= 0.25 then 1 + {_C.format(n="3")} when {S.FEATURE_ORDER[4]} <= -0.5 then 2 else 2 + {_C.format(n="4")} end
  + case when {S.FEATURE_ORDER[6]} <= 0.1 then 1 + {_C.format(n="6")} else 1 + 1 end
  + case when {S.FEATURE_ORDER[1]} > 0 then 1 + {_C.format(n="3")} when {S.FEATURE_ORDER[8]} <= 0.4 then 2 + {_C.format(n="4")} else 2 end as path from z)
select session_id, round(-pow(2, -(path / 3) / ({_C.format(n="8")})), 9) as anomaly_score from h"""
    ),
)
def q_forest_scores(spark, sf):
    """Scores of a fixed three-tree forest of sample size 8."""
    df, m = fitted(spark, sf)
    x = m.transform(df).select("session_id", *[r6(c) for c in m.feature_names])
    nodes = pd.DataFrame(FIXED_FOREST, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])
    raw = iforest.score(x, iforest.Forest(list(S.FEATURE_ORDER), 8, 3, nodes))
    return raw.select("session_id", F.round("anomaly_score", 9).alias("anomaly_score"))


from flowtriage.plans import catalog_more  # noqa: E402,F401  registers further queries
