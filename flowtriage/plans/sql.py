"""Shared DuckDB oracle SQL fragments (independent re-statements of each view)."""

from __future__ import annotations

from flowtriage.config import DEFAULTS
from flowtriage.sources.sessions import PROFILE_SQL, SESSIONS_SQL

NUMERIC_FEATURES = ["dur", "spkts", "dpkts", "sbytes", "dbytes"]
TEXT_FEATURES = ["proto", "service", "state"]
RATIOS = list(DEFAULTS.continuous_items)
# Feature order of the derived session table after the label split.
FEATURE_ORDER = ["dur", "proto", "service", "state", "spkts", "dpkts", "sbytes", "dbytes"] + RATIOS
ITEM_COLS = list(DEFAULTS.categorical_items) + RATIOS


def _sdiv(num: str, den: str) -> str:
    return (
        f"case when ({den}) = 0 or ({den}) is null or ({num}) is null then cast(0 as double) "
        f"else coalesce(({num}) / ({den}), cast(0 as double)) end"
    )


def features_sql() -> str:
    sb, db = "cast(sbytes as double)", "cast(dbytes as double)"
    sp, dp = "cast(spkts as double)", "cast(dpkts as double)"
    du = "cast(dur as double)"
    return ",\n".join(
        [
            f"{_sdiv(sb, f'{sb} + {db}')} as outbound_dominance_ratio",
            f"{_sdiv(sp, du)} as packet_rate",
            f"{_sdiv(sb, sp)} as bytes_per_packet",
            f"{_sdiv(f'{sp} - {dp}', f'{sp} + {dp}')} as packet_asymmetry",
        ]
    )


def _mode(col: str, src: str) -> str:
    return f"(select {col} from {src} where {col} is not null group by {col} order by count(*) desc, {col} limit 1)"


def base_ctes() -> str:
    """sessions, feat (F2–F5), imp (T1/T2), enc (T3), stats / scaled (T4)."""
    imp_cols = ["session_id"]
    for c in FEATURE_ORDER:
        if c in NUMERIC_FEATURES:
            imp_cols.append(
                f"coalesce(cast({c} as double), (select median(cast({c} as double)) from feat)) as {c}"
            )
        elif c in TEXT_FEATURES:
            imp_cols.append(f"coalesce({c}, {_mode(c, 'feat')}) as {c}")
        else:
            imp_cols.append(c)
    imp_cols += ["label", "attack_cat"]
    enc_cols = ["session_id"]
    for c in FEATURE_ORDER:
        if c in TEXT_FEATURES:
            enc_cols.append(f"cast(dense_rank() over (order by {c}) - 1 as integer) as {c}")
        else:
            enc_cols.append(c)
    enc_cols += ["label", "attack_cat"]
    stat_cols = []
    for c in FEATURE_ORDER:
        stat_cols.append(f"avg(cast({c} as double)) as m_{c}")
        stat_cols.append(
            f"case when stddev_pop(cast({c} as double)) < 2.220446049250313e-15 then cast(1 as double) "
            f"else stddev_pop(cast({c} as double)) end as s_{c}"
        )
    scaled_cols = ["session_id"] + [f"(cast({c} as double) - m_{c}) / s_{c} as {c}" for c in FEATURE_ORDER]
    scaled_cols += ["label", "attack_cat"]
    return f"""
sessions as ({SESSIONS_SQL}),
feat as (select *, {features_sql()} from sessions),
imp as (select {", ".join(imp_cols)} from feat),
enc as (select {", ".join(enc_cols)} from imp),
stats as (select {", ".join(stat_cols)} from enc),
scaled as (select {", ".join(scaled_cols)} from enc, stats),
profile as ({PROFILE_SQL})
"""


def with_base(body: str) -> str:
    return f"with {base_ctes()}{body}"


def round6(cols) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in cols)


def tercile_ctes(src: str = "feat") -> str:
    """Bins at quantile_cont 1/3 and 2/3 and the 7 item tokens per session (M1)."""
    q = ", ".join(
        f"quantile_cont({c}, cast(1 as double) / 3) as lo_{c}, quantile_cont({c}, cast(2 as double) / 3) as hi_{c}"
        for c in RATIOS
    )
    toks = []
    for c in DEFAULTS.categorical_items:
        toks.append(f"'{c}_' || lower(trim(coalesce(cast({c} as varchar), 'nan'), ' \t\n\r\x0b\x0c')) as {c}")
    for c in RATIOS:
        toks.append(
            f"'{c}_' || case when {c} <= lo_{c} then 'low' when {c} <= hi_{c} then 'medium' else 'high' end as {c}"
        )
    return f"""
edges as (select {q} from {src}),
txn as (select session_id, {", ".join(toks)} from {src}, edges)
"""


def itemset_ctes(min_support: float, txn: str = "txn", seg: str | None = None) -> str:
    """Cube over the 7 item columns; wide itemsets with a presence bitmask."""
    cols = ", ".join(ITEM_COLS)
    k = len(ITEM_COLS)
    seg_sel = f"{seg}, " if seg else ""
    if seg:
        sets = ", ".join(
            "(" + ", ".join([seg] + [c for j, c in enumerate(ITEM_COLS) if (m >> j) & 1]) + ")"
            for m in range(1 << k)
        )
        group = f"grouping sets ({sets})"
        total = f"(select {seg} as t_seg, count(*) as total from {txn} group by {seg}) tot on tot.t_seg = c.{seg}"
        gcols = f"grouping({cols})"
    else:
        group = f"cube ({cols})"
        total = f"(select count(*) as total from {txn}) tot on true"
        gcols = f"grouping({cols})"
    items = "list_sort(list_filter([" + cols + "], lambda x: x is not null))"
    return f"""
cells as (select {seg_sel}{cols}, {gcols} as gid, count(*) as n from {txn} group by {group}),
its as (select c.*, {(1 << k) - 1} - gid as present, {items} as items,
               cast(n as double) / cast(tot.total as double) as support
        from cells c join {total}
        where gid <> {(1 << k) - 1} and cast(n as double) / cast(tot.total as double) >= {min_support!r})
"""


def rules_ctes(min_confidence: float, seg: str | None = None) -> str:
    """Rules via bitmask over the wide itemset columns (no arrays involved)."""
    k = len(ITEM_COLS)
    bit = {c: 1 << (k - 1 - i) for i, c in enumerate(ITEM_COLS)}
    a_cols = ", ".join(f"case when (m & {bit[c]}) <> 0 then {c} end as a_{c}" for c in ITEM_COLS)
    c_cols = ", ".join(f"case when ((present - m) & {bit[c]}) <> 0 then {c} end as c_{c}" for c in ITEM_COLS)
    seg_sel = f"i.{seg}, " if seg else ""
    seg_eq_a = f"a.{seg} = x.{seg} and " if seg else ""
    seg_eq_c = f"c.{seg} = x.{seg} and " if seg else ""
    seg_x = f"x.{seg}, " if seg else ""
    eq_a = " and ".join(f"a.{c} is not distinct from x.a_{c}" for c in ITEM_COLS)
    eq_c = " and ".join(f"c.{c} is not distinct from x.c_{c}" for c in ITEM_COLS)
    a_items = "list_sort(list_filter([" + ", ".join(f"x.a_{c}" for c in ITEM_COLS) + "], lambda v: v is not null))"
    c_items = "list_sort(list_filter([" + ", ".join(f"x.c_{c}" for c in ITEM_COLS) + "], lambda v: v is not null))"
    return f"""
masks as (select range as m from range(1, {(1 << k) - 1})),
cand as (select {seg_sel}i.support, i.present, masks.m, {a_cols}, {c_cols}
         from its i join masks on (masks.m & i.present) = masks.m and masks.m <> i.present),
rules as (select {seg_x}array_to_string({a_items}, ' AND ') as antecedent,
                 {a_items} as a_list, {c_items} as c_list,
                 array_to_string({c_items}, ' AND ') as consequent,
                 x.support as support,
                 x.support / a.support as confidence,
                 (x.support / a.support) / c.support as lift
          from cand x
          join its a on {seg_eq_a}a.present = x.m and {eq_a}
          join its c on {seg_eq_c}c.present = x.present - x.m and {eq_c}
          where x.support / a.support >= {min_confidence!r} and (x.support / a.support) / c.support > 1.0)
"""


__all__ = ["with_base", "round6", "tercile_ctes", "itemset_ctes", "rules_ctes", "PROFILE_SQL", "SESSIONS_SQL"]
