"""Column-level building blocks (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes for ASCII text.
_WHITESPACE = " \t\n\r\x0b\x0c"

# Modulus for the partition-independent sample key (a Mersenne prime).
_SAMPLE_P = 2147483647


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(num, den, fill: float = 0.0) -> Column:
    """num/den; a zero or null divisor, or any NaN result, yields ``fill``.

    ``try_divide`` keeps ANSI mode from raising on a zero divisor; ``nanvl``
    turns NaN (inf/inf, NaN inputs) into null before the final fill.
    ±inf from an infinite numerator is kept, as in the reference.
    """
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.coalesce(F.nanvl(q, F.lit(None).cast("double")), F.lit(float(fill)))


def item_token(col_name: str) -> Column:
    """categorical value → ``<col>_<stripped lower-case value>``; null → ``<col>_nan``."""
    raw = F.coalesce(F.col(col_name).cast("string"), F.lit("nan"))
    return F.concat(F.lit(col_name + "_"), F.lower(F.btrim(raw, F.lit(_WHITESPACE))))


def tercile_token(col_name: str, lo: float, hi: float) -> Column:
    """``<= lo`` low, ``<= hi`` medium, else high (null / NaN fall to high)."""
    v = F.col(col_name).cast("double")
    label = F.when(v <= F.lit(lo), "low").when(v <= F.lit(hi), "medium").otherwise("high")
    return F.concat(F.lit(col_name + "_"), label)


def sample_key(key, seed: int) -> Column:
    """Partition-independent pseudo-random order for seeded sampling.

    Integer-only mixing (two multiplicative steps around a xor-shift) so the
    same order is reproducible by any SQL engine; no overflow for any bigint.
    """
    p = F.lit(_SAMPLE_P)
    h1 = F.pmod(_c(key).cast("bigint"), p)
    h2 = F.pmod(h1 * F.lit(48271) + F.lit(int(seed)), p)
    h3 = h2.bitwiseXOR(F.shiftright(h2, 13))
    return F.pmod(h3 * F.lit(69621), p)


def sample_key_sql(key_sql: str, seed: int) -> str:
    """DuckDB/ANSI text of :func:`sample_key` (used by oracle SQL)."""
    h1 = f"(({key_sql}) % {_SAMPLE_P} + {_SAMPLE_P}) % {_SAMPLE_P}"
    h2 = f"(({h1}) * 48271 + {int(seed)}) % {_SAMPLE_P}"
    h3 = f"xor(({h2}), (({h2}) >> 13))"
    return f"(({h3}) * 69621) % {_SAMPLE_P}"


def bounded_sample(df, key: str, n: int, seed: int):
    """The ``n`` rows with the smallest :func:`sample_key` (ties by key), all rows if fewer.

    Only rows below a threshold a little above the n-th smallest key are sorted
    and merged; it is widened if it turns out short.
    """
    total = df.count()
    if total <= n:
        return df
    k = sample_key(F.col(key), seed)
    share = min(1.0, 1.2 * n / total + 20.0 / total)
    while share < 1.0:
        near = df.where(k < F.lit(int(share * _SAMPLE_P)))
        if near.count() >= n:
            return near.orderBy(k, F.col(key)).limit(n)
        share = min(1.0, 2 * share)
    return df.orderBy(k, F.col(key)).limit(n)


def sq_distance(left: list[Column], right: list[Column]) -> Column:
    """Squared Euclidean distance between two equally long column lists."""
    terms = [(a - b) * (a - b) for a, b in zip(left, right)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def lift_tier(lift) -> Column:
    """F17 (chart tiers): lift > 7 strong, > 5 elevated, else base."""
    c = _c(lift)
    return F.when(c > 7, "strong").when(c > 5, "elevated").otherwise("base")


def confidence_tier(conf) -> Column:
    """confidence >= 0.85 high, else moderate."""
    return F.when(_c(conf) >= 0.85, "high").otherwise("moderate")
