"""Exact quantiles with linear interpolation, computed by distributed refinement.

Spark's exact ``percentile`` keeps every distinct value of a global
aggregate in one buffer, which does not survive 100 TB.  Here each order
statistic is found by repeated equal-width histograms over a shrinking value
range: one aggregation per round, each with ``bins`` groups per target, map-side
combined, so only ``targets × bins`` small rows ever reach the driver.  The
range of the next round is the [min, max] of the bucket holding the wanted
rank, so no value is lost to floating-point edges.  A round resolves a target
when its bucket holds one distinct value.

Before the first round, ``percentile_approx`` brackets each rank (its rank error
is bounded by n / accuracy), so the rounds only touch rows near the targets.
Infinite values keep their rank: they are counted apart and never binned.

Interpolation is linear between neighbouring order statistics, as pandas
``quantile`` / SQL ``quantile_cont``: ``h = (n-1)p``, ``d = h - floor h``,
``x[floor h]·(1-d) + x[ceil h]·d``.
NaN and null values are skipped (pandas ``skipna``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


ACCURACY = 10_000


def _valid(c: str):
    v = F.col(c).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def exact_quantiles(
    df: DataFrame,
    spec: dict[str, list[float]],
    bins: int = 4096,
    max_rounds: int = 200,
) -> dict[str, list[float | None]]:
    """Return ``{column: [quantile for each p]}``; ``None`` for an all-null column."""
    cols = list(spec)
    if not cols:
        return {}
    return _refine(df.select(*cols), spec, cols, bins, max_rounds)


def _refine(df: DataFrame, spec: dict, cols: list, bins: int, max_rounds: int) -> dict:
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        ok = _valid(c)
        finite = F.when(ok, v)
        aggs += [
            F.count_if(ok).alias(f"n{i}"),
            F.count_if(v == float("-inf")).alias(f"neg{i}"),
            F.count_if(v == float("inf")).alias(f"pos{i}"),
            F.min(finite).alias(f"lo{i}"),
            F.max(finite).alias(f"hi{i}"),
            # finite values only: the bracket of the k-th percent step of the column
            F.percentile_approx(finite, [k / 100 for k in range(101)], ACCURACY).alias(f"at{i}"),
        ]
    head = df.agg(*aggs).first()

    # target = (column, rank); state = [L, U, below]; ranks count finite values only
    state: dict[tuple[str, int], list] = {}
    solved: dict[tuple[str, int], float] = {}
    plan: dict[str, list] = {}
    for i, c in enumerate(cols):
        n, neg = head[f"n{i}"], head[f"neg{i}"]
        total = neg + n + head[f"pos{i}"]
        plan[c] = []
        for p in spec[c]:
            if total == 0:
                plan[c].append(None)
                continue
            h = (total - 1) * float(p)
            lo_r, hi_r = int(math.floor(h)), int(math.ceil(h))
            plan[c].append((h, lo_r, hi_r))
            for r in (lo_r, hi_r):
                if r < neg:
                    solved[(c, r)] = float("-inf")
                elif r >= neg + n:
                    solved[(c, r)] = float("inf")
                elif (c, r) not in state:
                    steps = head[f"at{i}"]
                    part = (r - neg) / n
                    slack = 2.0 / ACCURACY + 2.0 / n
                    L = steps[max(0, math.floor((part - slack) * 100))] if part - slack > 0 else head[f"lo{i}"]
                    U = steps[min(100, math.ceil((part + slack) * 100))] if part + slack < 1 else head[f"hi{i}"]
                    state[(c, r)] = [L, U, None]
    # how many finite values lie below each bracket, and whether it holds its rank
    if state:
        index = {c: i for i, c in enumerate(cols)}
        probes = []
        for j, ((c, r), (L, U, _)) in enumerate(state.items()):
            v, ok = F.col(c).cast("double"), _valid(c)
            probes += [F.count_if(ok & (v < L)).alias(f"b{j}"), F.count_if(ok & (v <= U)).alias(f"u{j}")]
        seen = df.agg(*probes).first()
        for j, (t, s) in enumerate(state.items()):
            i = index[t[0]]
            neg = head[f"neg{i}"]
            if seen[f"b{j}"] <= t[1] - neg < seen[f"u{j}"]:
                s[2] = seen[f"b{j}"] + neg
            else:
                s[:] = [head[f"lo{i}"], head[f"hi{i}"], neg]
            if s[0] == s[1]:
                solved[t] = s[0]

    for _ in range(max_rounds):
        active = [t for t in state if t not in solved]
        if not active:
            break
        ranges: dict[tuple[str, float, float], int] = {}
        for t in active:
            c = t[0]
            L, U, _b = state[t]
            ranges.setdefault((c, L, U), len(ranges))
        entries = []
        for (c, L, U), rid in ranges.items():
            v = F.col(c).cast("double")
            half = (U / 2.0 - L / 2.0)
            pos = (v / 2.0 - F.lit(L / 2.0)) / F.lit(half) * F.lit(float(bins))
            b = F.least(F.greatest(F.floor(pos), F.lit(0)), F.lit(bins - 1))
            inr = _valid(c) & (v >= F.lit(L)) & (v <= F.lit(U))
            entries.append(F.when(inr, F.struct(F.lit(rid).alias("rid"), b.cast("int").alias("b"), v.alias("v"))))
        rows = (
            df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
            .groupBy(F.col("e.rid").alias("rid"), F.col("e.b").alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("mn"), F.max("e.v").alias("mx"))
            .collect()
        )
        hist: dict[int, list] = {}
        for r in rows:
            hist.setdefault(r["rid"], []).append((r["b"], r["n"], r["mn"], r["mx"]))
        for t in active:
            c, rank = t
            L, U, below = state[t]
            buckets = sorted(hist.get(ranges[(c, L, U)], []))
            acc = below
            for b, n, mn, mx in buckets:
                if rank < acc + n:
                    if mn == mx:
                        solved[t] = mn
                    elif mn == L and mx == U:
                        raise RuntimeError(f"quantile refinement made no progress on {c}")
                    else:
                        state[t] = [mn, mx, acc]
                    break
                acc += n
            else:  # pragma: no cover - counts always cover the rank
                raise RuntimeError(f"rank {rank} outside histogram for {c}")
    else:
        raise RuntimeError("exact_quantiles did not converge")

    out: dict[str, list[float | None]] = {}
    for c in cols:
        vals = []
        for item in plan[c]:
            if item is None:
                vals.append(None)
                continue
            h, lo_r, hi_r = item
            a, b = solved[(c, lo_r)], solved[(c, hi_r)]
            d = h - lo_r
            vals.append(a if lo_r == hi_r or a == b else a * (1.0 - d) + b * d)
        out[c] = vals
    return out


def exact_quantile(df: DataFrame, col: str, p: float) -> float | None:
    return exact_quantiles(df, {col: [p]})[col][0]
