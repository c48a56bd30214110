"""Operator 3, quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps its measurements
and a bit per failed rule.  A policy is a named, versioned set of rules: a
document is kept when ``failed & mask`` is 0.  Ablations (what would be kept
without one rule, what one rule alone drops) come from the ledger alone by
bitwise operations, without reading a text again.

Null text has no words and one empty line.  Rows are independent of each
other, so repeated rows, null ids, and extra columns change nothing; columns
of the result replace input columns of the same name.  An empty table gives an
empty ledger.

Scale: one pass without a shuffle; ablations shuffle one row per failure mask
and task.  Windows of words are compared by 64-bit hashes inside the row, in
n log n, and only in texts that repeat a window at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_names

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements; the bit is its place in the rule book."""

    name: str
    fails: str


#: Append only: the position of a rule is its bit in stored ledgers.
RULES = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("shouting", "100 * n_upper > 50 * n_letters"),
    Rule("word_length", "word_chars > 20 * n_words or word_chars < 2 * n_words"),
    Rule("too_long", "n_words > 1000000"),
)

#: Policies by version: names of rules.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "symbols"),
    "v2": ("too_few_words", "repeated_windows", "symbols", "duplicate_lines", "shouting", "word_length"),
}


def mask_of(policy: str | tuple[str, ...], rules=RULES, policies=None) -> int:
    names = (policies or POLICIES)[policy] if isinstance(policy, str) else policy
    bits = {r.name: 1 << i for i, r in enumerate(rules)}
    return sum(bits[n] for n in set(names))


def _n_repeat(hashes: Column, n_words: Column, window: int) -> Column:
    """Words in windows that occur twice or more, from the hash of the window at each position."""
    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(sorted_rows):
        def twin(x, i):
            return (F.get(sorted_rows, i - 1)["h"] == x["h"]) | (F.get(sorted_rows, i + 1)["h"] == x["h"])

        return F.sort_array(F.transform(F.filter(sorted_rows, lambda x, i: F.coalesce(twin(x, i), F.lit(False))), lambda x: x["i"]))

    def total(starts):
        return F.aggregate(
            F.transform(starts, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - p, F.lit(window)))),
            F.lit(0).cast("long"),
            lambda acc, x: acc + x,
        )

    # one-element transforms bind the sorted arrays once
    starts = F.flatten(F.transform(F.array(keyed), covered))
    return F.element_at(F.transform(F.array(starts), total), 1)


def measure(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the measurements (long): n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_letters, n_upper."""
    made = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_letters n_upper".split()
    docs = free_names(docs, *made, "_t", "_b", "_w", "_wh", "_h", "_l")
    keep = docs.columns
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(t, F.lit(SPACE))
    step = docs.withColumn("_wh", F.when(bare == "", F.array().cast("array<long>")).otherwise(
        F.transform(F.split(bare, r"[\x20\x09-\x0D]+", -1), lambda w: F.xxhash64(w))
    ))
    size = F.size("_wh")
    last = size - window
    windows = F.when(
        last >= 1, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("_wh", i + k) for k in range(window)]))
    ).otherwise(F.array().cast("array<long>"))
    step = step.withColumn("_h", windows)
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    step = step.withColumn("_l", lines)
    repeats = F.when(F.size(F.array_distinct("_h")) == F.size("_h"), F.lit(0).cast("long")).otherwise(_n_repeat(F.col("_h"), size, window))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    upper = F.length(F.regexp_replace(t, r"[^\p{Lu}]+", ""))
    values = {
        "n_words": size,
        "word_chars": F.length(F.translate(t, SPACE, "")),
        "n_symbols": F.length(t) - F.length(F.translate(t, "#*$%&|<>", "")),
        "n_lines": F.size("_l"),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": repeats,
        "n_letters": letters,
        "n_upper": upper,
    }
    return step.select(*keep, *[values[m].cast("long").alias(m) for m in made])


def build_ledger(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` without ``text``, with the measurements and ``failed``, a long with bit i set when rule i fails."""
    measured = measure(free_names(docs, "failed"), text).drop(text)
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failed", bits)


def passes(policy, rules=RULES) -> Column:
    """Verdict of a policy from the ledger's ``failed`` column."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(policy, rules)).cast("long")) == 0


def ablations(ledger: DataFrame, policy, rules=RULES) -> DataFrame:
    """(rule, n_failed, n_only, n_kept_without): for each rule of the policy the documents it fails, those that no
    other rule of the policy fails, and those kept if it were taken out; plus rule null for the policy as a whole."""
    mask = mask_of(policy, rules)
    masks = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    named = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(rules) if mask >> i & 1]
    named.append(F.struct(F.lit(None).cast("string").alias("rule"), F.lit(0).cast("long").alias("bit")))
    x = masks.withColumn("r", F.explode(F.array(*named)))
    rest = F.col("m").bitwiseAND(F.bitwise_not(F.col("r.bit")))
    hit = F.when(F.col("r.bit") == 0, F.col("m") != 0).otherwise(F.col("m").bitwiseAND(F.col("r.bit")) != 0)
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        count(hit).alias("n_failed"), count(hit & (rest == 0)).alias("n_only"), count(rest == 0).alias("n_kept_without")
    )
