"""Further registered queries: stored models, ε-pairs, simplified silhouette, given itemsets, wide baskets, quarantine,
K search from given centres, trees from given draws, quantile sketches, the report from the writes."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtriage.operators import baskets, density, iforest, segment
from flowtriage.plans import sql as S
from flowtriage.config import DEFAULTS
from flowtriage.functions import sketches as sk
from flowtriage.functions.scalar import sample_key_sql
from flowtriage.plans import report
from flowtriage.plans.catalog import FIXED_FOREST, ORACLE, PROFILE_COLS, PROFILE_EPS, _dbscan_sql, _emb_k_scores, _profile_dbscan, _rule_out, fitted, r6, register, sessions, standin
from flowtriage.runtime import shared_dir, table_path
from flowtriage.sources import model_store
from flowtriage.sources import sessions as src
from flowtriage.streaming.scoring import FittedTriage

# --- model store ------------------------------------------------------------------------


def _stored(spark, m: FittedTriage) -> FittedTriage:
    """``m`` saved below the shared folder and loaded by another session."""
    path = f"{shared_dir(spark)}/models-{uuid.uuid4().hex}"
    return model_store.load(spark.newSession(), path, model_store.save(spark, m, path))


@register("stored_preprocess", ORACLE["preprocess_matrix"])
def q_stored_preprocess(spark, sf):
    """T6 by a model that was saved and loaded."""
    df, m = fitted(spark, sf)
    p = _stored(spark, FittedTriage(m)).prep
    p.dictionary = spark.read.schema(p.dictionary.schema).parquet(*p.dictionary.inputFiles())
    x = p.transform(df, keep=["label", "attack_cat"])
    return x.select("session_id", *[r6(c) for c in S.FEATURE_ORDER], "label", "attack_cat")


@register("stored_forest_scores", ORACLE["forest_scores"])
def q_stored_forest_scores(spark, sf):
    """I2 by a forest that was saved and loaded."""
    df, m = fitted(spark, sf)
    x = m.transform(df).select("session_id", *[r6(c) for c in m.feature_names])
    nodes = pd.DataFrame(FIXED_FOREST, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])
    got = _stored(spark, FittedTriage(m, forest=iforest.Forest(list(S.FEATURE_ORDER), 8, 3, nodes), offset=-0.5))
    return iforest.score(x, got.forest).select("session_id", F.round("anomaly_score", 9).alias("anomaly_score"))


# --- J6 ---------------------------------------------------------------------------------

_GAP = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in PROFILE_COLS)


@register(
    "eps_pairs",
    S.with_base(
        f""",
u as (select {", ".join(PROFILE_COLS)}, min(customer_id) as id, count(*) as w from profile group by {", ".join(PROFILE_COLS)})
select a.id as a, b.id as b, a.w as w_a, b.w as w_b, round(sqrt({_GAP}), 9) as distance
from u a join u b on a.id < b.id and {_GAP} <= {PROFILE_EPS * PROFILE_EPS!r}"""
    ),
)
def q_eps_pairs(spark, sf):
    """J6 as a table: pairs of different customer profiles within eps, each once."""
    pairs, _ = density.eps_pairs(src.customer_profile(spark, sf), PROFILE_COLS, PROFILE_EPS, "customer_id")
    return pairs.select("a", "b", "w_a", "w_b", F.round("distance", 9).alias("distance"))


# --- C3 simplified ----------------------------------------------------------------------


@register(
    "silhouette_simplified",
    S.with_base(
        f""",
pd as (select a.customer_id, a.segment as own, b.segment as other, {_GAP} as d from profile a join profile b on a.customer_id <> b.customer_id),
pm as (select customer_id, own, other, avg(d) as md from pd group by all),
ps as (select customer_id, max(case when other = own then md end) as a, min(case when other <> own then md end) as b from pm group by customer_id)
select round(avg(case when a is null then 0.0 else (b - a) / greatest(a, b) end), 9) as silhouette, count(*) as n_rows,
       cast((select count(distinct segment) from profile) as integer) as n_clusters from ps"""
    ),
)
def q_silhouette_simplified(spark, sf):
    """C3 by squared distance over all customers, labelled by market segment; the oracle measures all pairs."""
    p = src.customer_profile(spark, sf)
    lab = p.withColumn("label", F.hash("segment"))
    return segment.silhouette_simplified(lab, PROFILE_COLS, "label").withColumn("silhouette", F.round("silhouette", 9))


# --- M2, M3 -----------------------------------------------------------------------------

_BASKETS = """with lines as (
    select l_orderkey, unnest(['brand_' || p_brand, 'type_' || p_type, 'flag_' || l_returnflag || l_linestatus,
                               'off_' || cast(cast(round(l_discount * 100) as integer) as varchar), 'month_' || cast(month(l_shipdate) as varchar)]) as item
    from lineitem join part on p_partkey = l_partkey),
b as (select l_orderkey, list_sort(list(distinct item)) as items from lines where item is not null group by l_orderkey),
total as (select count(*) as t from b)
"""
GIVEN = [["flag_AF", "flag_RF"], ["off_5"], ["month_1", "month_2", "month_3"], ["off_1", "flag_NO", "off_1"], ["nowhere"], [], ["month_12", "off_10", "flag_AF"], ["off_5"]]
BASKET_SUPPORT, BASKET_CONFIDENCE = 0.2, 0.5


def _baskets(spark, sf) -> DataFrame:
    """Per order what its lines are: brands, types, flags, discounts, months; up to some forty items."""
    lines = spark.read.parquet(table_path(sf, "lineitem")).join(spark.read.parquet(table_path(sf, "part")), F.col("p_partkey") == F.col("l_partkey"))
    items = F.array(
        F.concat(F.lit("brand_"), "p_brand"), F.concat(F.lit("type_"), "p_type"), F.concat(F.lit("flag_"), "l_returnflag", "l_linestatus"),
        F.concat(F.lit("off_"), F.round(F.col("l_discount") * 100).cast("int").cast("string")), F.concat(F.lit("month_"), F.month("l_shipdate").cast("string")),
    )
    # one row per line, not per item, is grouped
    grouped = lines.select("l_orderkey", items.alias("line")).groupBy("l_orderkey").agg(F.flatten(F.collect_list("line")).alias("items"))
    return grouped.select("l_orderkey", F.array_distinct(F.array_compact("items")).alias("items"))


_GIVEN_SQL = ", ".join("([" + ", ".join(f"'{x}'" for x in g) + "]::varchar[])" for g in GIVEN)


@register(
    "itemset_support",
    _BASKETS
    + f""", given(items) as (values {_GIVEN_SQL})
select array_to_string(items, ' AND ') as items, (select count(*) from b where list_has_all(b.items, given.items)) as n,
       round((select count(*) from b where list_has_all(b.items, given.items)) / (select t from total)::double, 9) as support from given""",
)
def q_itemset_support(spark, sf):
    """M2 for itemsets that a caller names."""
    given = spark.createDataFrame([(g,) for g in GIVEN], "items array<string>")
    got = baskets.itemset_support(_baskets(spark, sf), given)
    return got.select(F.array_join("items", " AND ").alias("items"), "n", F.round("support", 9).alias("support"))


_LEVELS = (
    _BASKETS
    + f""", one as (
    select item, n, 1::bigint << cast(row_number() over (order by item) - 1 as integer) as bit
    from (select item, count(*) as n from (select unnest(items) as item from b) group by item) where n / (select t from total)::double >= {BASKET_SUPPORT}),
masks as (select m, count(*) as c from (select bit_or(bit) as m from (select l_orderkey, unnest(items) as item from b) x join one on one.item = x.item group by l_orderkey) group by m),
f as (select * from (
    with recursive f(mask, top, n) as (
        select bit, bit, n from one
        union all
        select f.mask | one.bit, one.bit, sum(c)::bigint from f join one on one.bit > f.top join masks on (m & (f.mask | one.bit)) = (f.mask | one.bit)
        group by 1, 2 having sum(c) / (select t from total)::double >= {BASKET_SUPPORT})
    select * from f)),
sets as (select (select list(item order by item) from one where bit & mask <> 0) as items, n, n / (select t from total)::double as support from f)
"""
)


@register("basket_itemsets", _LEVELS + "select array_to_string(items, ' AND ') as items, cast(len(items) as integer) as size, n, round(support, 9) as support from sets")
def q_basket_itemsets(spark, sf):
    """M3 + M4 on wide baskets."""
    found = baskets.apriori(_baskets(spark, sf), min_support=BASKET_SUPPORT)
    return found.select(F.array_join("items", " AND ").alias("items"), "size", "n", F.round("support", 9).alias("support"))


@register(
    "basket_rules",
    _LEVELS
    + f""", cut as (select items, support, unnest(range(1, (2 ** len(items))::bigint - 1)) as mask from sets where len(items) >= 2),
halves as (select support, [items[i + 1] for i in range(len(items)) if (mask >> i) & 1 = 1] as ante, [items[i + 1] for i in range(len(items)) if (mask >> i) & 1 = 0] as cons from cut),
rules as (select ante, cons, h.support, h.support / a.support as confidence, h.support / a.support / c.support as lift
          from halves h join sets a on a.items = h.ante join sets c on c.items = h.cons)
select array_to_string(ante, ' AND ') as antecedent, array_to_string(cons, ' AND ') as consequent, {S.round6(["support", "confidence", "lift"])}
from rules where confidence >= {BASKET_CONFIDENCE} and lift > 1""",
)
def q_basket_rules(spark, sf):
    """M5 on wide baskets."""
    return _rule_out(baskets.mine_baskets(_baskets(spark, sf), min_support=BASKET_SUPPORT, min_confidence=BASKET_CONFIDENCE)[1])


# --- S1 with a reject table -------------------------------------------------------------

_FAULTS = {"dur": 97, "sbytes": 89, "label": 83}


@register(
    "session_quarantine",
    S.with_base(
        """select 'rejected' as kind, 'dur' as "column", 'not double' as reason, count(*) as n from sessions where session_id % 97 = 0 and session_id % 79 <> 0
union all select 'rejected', 'sbytes', 'not bigint', count(*) from sessions where session_id % 89 = 0 and session_id % 79 <> 0
union all select 'rejected', 'label', 'not int', count(*) from sessions where session_id % 83 = 0 and session_id % 79 <> 0
union all select 'rejected', null, 'number of fields', count(*) from sessions where session_id % 79 = 0
union all select 'good', null, null, count(*) from sessions
          where session_id % 97 <> 0 and session_id % 89 <> 0 and session_id % 83 <> 0 and session_id % 79 <> 0"""
    ),
)
def q_session_quarantine(spark, sf):
    """Sessions written as CSV with planted faults; rejects by column and reason, and the good rows."""
    s = sessions(spark, sf).withColumnRenamed("session_id", "id")
    path = f"{shared_dir(spark)}/faulty-csv-{uuid.uuid4().hex}"
    fields = []
    for c in s.columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        fields.append(F.when(F.col("id") % _FAULTS[c] == 0, F.concat(F.lit("x"), text)).otherwise(text) if c in _FAULTS else text)
    line = F.concat_ws(",", *fields)
    line = F.when(F.col("id") % 79 == 0, F.concat(line, F.lit(",surplus"))).otherwise(line)
    # every file of the folder has a header
    rows = s.select(line.alias("value")).sortWithinPartitions("value")
    head = ",".join(s.columns)
    rows.mapInPandas(lambda batches: _headed(batches, head), "value string").write.text(path)
    schema = T.StructType([T.StructField(c, s.schema[c].dataType) for c in s.columns])
    good, rejected = src.quarantine_sessions(spark, path, schema)
    bad = src.reject_counts(rejected).select(F.lit("rejected").alias("kind"), "column", "reason", "n")
    none = F.lit(None).cast("string")
    return bad.unionByName(good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("kind"), none.alias("column"), none.alias("reason"), "n"))


def _headed(batches, head: str):
    first = True
    for batch in batches:
        yield pd.concat([pd.DataFrame({"value": [head]}), batch]) if first else batch
        first = False


# --- C4 from given centres, F8, I1 from given draws ---------------------------------------

SEARCH_KS, SEARCH_PASSES = (2, 3, 4), 5
_CEN_GAP = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in PROFILE_COLS)
_ORDERED_SAMPLE = f"order by {sample_key_sql('customer_id', DEFAULTS.seed)}, customer_id limit {DEFAULTS.silhouette_sample}"


def _search_sql() -> str:
    """Lloyd passes for every K at once: c0, the smallest customers, to the last centres; own, the rows' nearest of these."""
    mean = ", ".join(f"avg({c}) as {c}" for c in PROFILE_COLS)
    kept = ", ".join(f"coalesce(m.{c}, c.{c}) as {c}" for c in PROFILE_COLS)
    near = f"""(select p.*, c.k, c.j, {_CEN_GAP} as d2 from profile p join c{{i}} c on true
    qualify row_number() over (partition by p.customer_id, c.k order by {_CEN_GAP}, c.j) = 1)"""
    out = f""",
ks as (select unnest({list(SEARCH_KS)}) as k),
first as (select row_number() over (order by customer_id) - 1 as j, {", ".join(PROFILE_COLS)} from (select * from profile order by customer_id limit {max(SEARCH_KS)})),
c0 as (select k, first.* from first join ks on j < k)"""
    for i in range(SEARCH_PASSES):
        out += f""",
m{i} as (select k, j, {mean} from {near.format(i=i)} group by k, j),
c{i + 1} as (select c.k, c.j, {kept} from c{i} c left join m{i} m on m.k = c.k and m.j = c.j)"""
    return out + f""",
own as {near.format(i=SEARCH_PASSES)},
cost as (select k, sum(d2) as inertia from own group by k),
samp as (select customer_id from profile {_ORDERED_SAMPLE}),
so as (select own.* from own join samp on samp.customer_id = own.customer_id),
pm as (select a.k, a.customer_id, a.j as own, b.j as other, avg(sqrt({_GAP})) as md from so a join so b on a.k = b.k and a.customer_id <> b.customer_id group by all),
ps as (select k, customer_id, max(case when other = own then md end) as a, min(case when other <> own then md end) as b from pm group by all),
sil as (select k, round(avg(case when a is null then 0.0 else (b - a) / greatest(a, b) end), 4) as silhouette from ps group by k)
select cast(sil.k as integer) as k, silhouette, round(inertia, 4) as inertia, row_number() over (order by silhouette desc, sil.k) = 1 as selected
from sil join cost on cost.k = sil.k"""


@register("kmeans_search_fixed", S.with_base(_search_sql()))
def q_kmeans_search_fixed(spark, sf):
    """C1 + C3 + C4 + W3 on the customer profile from given centres (the smallest customers), a fixed number of passes."""
    p = src.customer_profile(spark, sf)
    first = p.orderBy("customer_id").limit(max(SEARCH_KS)).toPandas()[PROFILE_COLS].to_numpy(dtype=float)
    init = {k: first[:k] for k in SEARCH_KS}
    res = segment.kmeans_search(p, PROFILE_COLS, SEARCH_KS, key="customer_id", init=init, max_iter=SEARCH_PASSES, tol=0.0)
    chosen = (F.col("k") == F.lit(res["best_k"])).alias("selected")
    return res["scores"].select("k", "silhouette", F.round("inertia", 4).alias("inertia"), chosen)


@register(
    "silhouette_without_noise",
    S.with_base(
        _dbscan_sql(PROFILE_EPS, DEFAULTS.dbscan_min_samples)
        + f""",
samp as (select * from (select p.* from profile p join db on db.customer_id = p.customer_id where db.cluster <> -1) {_ORDERED_SAMPLE}),
pm as (select a.customer_id, a.segment as own, b.segment as other, avg(sqrt({_GAP})) as md from samp a join samp b on a.customer_id <> b.customer_id group by all),
ps as (select customer_id, max(case when other = own then md end) as a, min(case when other <> own then md end) as b from pm group by customer_id)
select round(avg(case when a is null then 0.0 else (b - a) / greatest(a, b) end), 4) as silhouette, count(*) as n_rows from ps"""
    ),
)
def q_silhouette_without_noise(spark, sf):
    """F8 + C3: market segments of the customer profile, the noise of its DBSCAN being no cluster."""
    p = src.customer_profile(spark, sf)
    noise = density.dbscan(p, PROFILE_COLS, PROFILE_EPS, DEFAULTS.dbscan_min_samples, key="customer_id")
    label = F.when(F.col("cluster") == -1, -1).otherwise(F.pmod(F.hash("segment"), F.lit(1 << 30)))
    lab = p.join(noise, "customer_id").withColumn("label", label)
    sample = segment.silhouette_sample(lab, "customer_id", label_col="label")
    s = segment.silhouette_scores(sample, PROFILE_COLS, ["label"], key="customer_id")["label"]
    n = F.count(F.lit(1))
    return sample.agg(F.when(n > 0, F.lit(round(s, 4))).alias("silhouette"), n.alias("n_rows"))


GROWN_TREES, GROWN_PSI = 3, 64


def _place_draws(tree: int, places: int) -> np.ndarray:
    at = np.arange(places)[:, None] * np.array([0.618, 0.732]) + tree * np.array([0.414, 0.236])
    return at - np.floor(at)


def _grown_sql() -> str:
    """The trees level by level: s, the rows at each place; c, what each place splits by."""
    n, draw = len(S.FEATURE_ORDER), "place * {} + t * {} - floor(place * {} + t * {})"
    u, w = draw.format(0.618, 0.414, 0.618, 0.414), draw.format(0.732, 0.236, 0.732, 0.236)
    out = f""",
s0 as (select t, 1::bigint as place, v from (
    select t, session_id, [{", ".join(f"round({c}, 6)" for c in S.FEATURE_ORDER)}] as v, ((session_id * 7919 + (t + 1) * 104729) % 1000003) / 1000003.0::double as u
    from scaled join (select unnest(range({GROWN_TREES})) as t) on true)
    qualify row_number() over (partition by t order by u, session_id) <= {GROWN_PSI})"""
    last = iforest.height_limit(GROWN_PSI)
    for i in range(last + 1):
        split = "false" if i == last else "n > 1 and len(us) > 0"
        out += f""",
m{i} as (select t, place, j, min(v[j]) as lo, max(v[j]) as hi, count(*) as n from s{i} join (select unnest(range(1, {n + 1})) as j) on true group by all),
g{i} as (select t, place, max(n) as n, list(j order by j) filter (where hi > lo) as us from m{i} group by all),
f{i} as (select t, place, n, case when {split} then us[1 + cast(floor(({u}) * len(us)) as integer)] end as f from g{i}),
c{i} as (select f.t, f.place, f.n, f.f, lo + ({w.replace("place", "f.place").replace(" t ", " f.t ")}) * (hi - lo) as cut
         from f{i} f left join m{i} m on m.t = f.t and m.place = f.place and m.j = f.f)"""
        if i < last:
            out += f""",
s{i + 1} as (select s.t, s.place * 2 + case when v[f] <= cut then 0 else 1 end as place, v from s{i} s join c{i} c on c.t = s.t and c.place = s.place where f is not null)"""
    both = " union all ".join(f"select * from c{i}" for i in range(last + 1))
    return out + f"""
select t as tree, place, cast(coalesce(f - 1, -1) as integer) as feature, round(coalesce(cut, 0.0), 9) as threshold, n as size from ({both})"""


@register("forest_grown", S.with_base(_grown_sql()))
def q_forest_grown(spark, sf):
    """I1 from given draws: the trees' rows by a chance that is arithmetic of the id, the splits by that of their place."""
    df, m = fitted(spark, sf)
    x = m.transform(df).select("session_id", *[r6(c) for c in S.FEATURE_ORDER])
    chance = ((F.col("session_id") * 7919 + (F.col("tree") + 1) * 104729) % 1000003) / F.lit(1000003.0)
    dealt = x.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(GROWN_TREES - 1)))).withColumn("u", chance)
    dealt = dealt.where(F.col("u") <= iforest.draw_share(GROWN_PSI, df.count())).withColumnRenamed("session_id", "k")
    nodes = iforest.grow_forest(dealt, S.FEATURE_ORDER, GROWN_PSI, _place_draws)
    return nodes.select("tree", "place", "feature", F.round("threshold", 9).alias("threshold"), "size")


# --- T1, F11, I3 from sketches ------------------------------------------------------------

_SKETCHED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_STEPS = (0.0, 0.04, 1 / 3, 0.5, 2 / 3, 0.95, 1.0)


@register(
    "quantile_sketches",
    " union all ".join(
        f"select '{c}' as \"column\", {p!r}::double as p, count({c}) as total, true as within, "
        f"count(distinct case when {c} is not null then strftime(l_shipdate, '%Y-%m') end) as parts from lineitem"
        for c in _SKETCHED
        for p in _STEPS
    ),
)
def q_quantile_sketches(spark, sf):
    """Quantiles merged from one stored sketch per month and column, each held against its rank among all rows.

    ``within``: the values below and up to the quantile enclose its rank, give or take the stated error.
    """
    rows = spark.read.parquet(table_path(sf, "lineitem")).select("l_shipdate", *_SKETCHED)
    path = f"{shared_dir(spark)}/sketches-{uuid.uuid4().hex}"
    sk.keep(sk.sketch(rows, list(_SKETCHED), F.date_format("l_shipdate", "yyyy-MM")), path)
    parts = sk.kept(spark, path)
    found = sk.quantile_table(parts, {c: list(_STEPS) for c in _SKETCHED})
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in _SKETCHED])
    counts = rows.select(F.explode(cells).alias("e")).select("e.*").groupBy("column", "v").agg(F.count(F.lit(1)).alias("c"))
    near = found.join(counts, "column").groupBy("column", "p", "total", "value").agg(
        F.sum(F.when(F.col("v") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto"),
    )
    slack = sk.RANK_ERROR * F.col("total") + 1
    wanted = F.col("p") * F.col("total")
    near = near.withColumn("within", (F.col("below") - slack <= wanted) & (F.col("upto") + slack >= wanted))
    months = parts.groupBy("column").agg(F.count(F.lit(1)).alias("parts"))
    return near.join(months, "column").select("column", "p", "total", "within", "parts")


# --- S8 from the writes -------------------------------------------------------------------


@register("run_report_observed", ORACLE["run_report"])
def q_run_report_observed(spark, sf):
    """S8, A1, A10 and A11 from counts taken while segments and density labels are written."""
    clusters = standin(spark, sf)["clusters"]
    _, sizes = report.write_segments(clusters, range(9))
    _, seen = report.write_density(_profile_dbscan(spark, sf))
    scores = _emb_k_scores(spark, sf)
    best = segment.best_k(scores).first()["k"]
    return report.observed_metrics(
        spark, sizes, seen, scores, best, len(S.FEATURE_ORDER), PROFILE_EPS, DEFAULTS.dbscan_min_samples, DEFAULTS.rare_share
    )
