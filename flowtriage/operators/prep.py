"""Impute, split labels, label-encode, standardise.

``fit_preprocessor`` runs a handful of aggregate jobs.  The driver keeps
per-column numbers only (medians, modes, means, population std, category
counts); the category dictionary of any size is a table (column, value, n,
code) in the shared folder, built by one count and a distributed rank, and is
joined on the value with the strategy Catalyst picks.

NaN is missing everywhere, as null.  A value that the fit did not see (only
possible on other data) gets, by ``unseen``: the extra code k (``"other"``),
null (``"null"``), or raises when the row is computed (``"error"``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtriage.config import DEFAULTS
from flowtriage.functions import sketches as sk
from flowtriage.functions.quantiles import exact_quantiles
from flowtriage.runtime import dense_rank, materialise

_EPS_STD = 10 * 2.220446049250313e-16

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def number(c: str) -> Column:
    """Column as double with NaN as null."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


@dataclass
class PrepModel:
    key: str
    label_cols: list
    numeric_cols: list
    text_cols: list
    feature_names: list
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    n_categories: dict = field(default_factory=dict)
    dictionary: DataFrame | None = None
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    unseen: str = "other"

    def source(self, feature: str) -> str:
        """Input column of a feature; the key as a feature goes by ``<key>_value``."""
        return self.key if feature == f"{self.key}_value" and self.key in self.numeric_cols else feature

    # --- T1/T2 ------------------------------------------------------------
    def impute_expr(self, c: str) -> Column:
        if c in self.numeric_cols:
            v = number(c)
            return F.coalesce(v, F.lit(self.medians[c])) if c in self.medians else v
        v = F.col(c)
        return F.coalesce(v, F.lit(self.modes[c])) if c in self.modes else v

    def impute(self, df: DataFrame) -> DataFrame:
        """Fill missing values (numeric → median as double, text → mode); other columns and the key kept."""
        return df.withColumns({c: self.impute_expr(c) for c in self.numeric_cols + self.text_cols if c != self.key})

    # --- F7 -----------------------------------------------------------------
    def split_labels(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        labels = [c for c in self.label_cols if c in df.columns]
        return df.drop(*labels), df.select(self.key, *labels)

    # --- T3 -----------------------------------------------------------------
    def with_codes(self, df: DataFrame, cols: list | None = None) -> DataFrame:
        """``df`` with ``__code_<c>`` for text columns: the rank of the imputed value among the fitted ones."""
        for c in self.text_cols if cols is None else cols:
            d = self.dictionary.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("code").cast("int").alias("__code"))
            df = df.withColumn("__k", self.impute_expr(c)).join(d, F.col("__k") == F.col("__v"), "left")
            new = F.col("__k").isNotNull() & F.col("__code").isNull()
            if self.unseen == "other":
                code = F.when(new, F.lit(self.n_categories[c])).otherwise(F.col("__code"))
            elif self.unseen == "error":
                code = F.when(new, F.raise_error(F.concat(F.lit(f"value of {c} not seen by the fit: "), "__k")).cast("int")).otherwise(F.col("__code"))
            else:
                code = F.col("__code")
            df = df.withColumn(f"__code_{c}", code).drop("__k", "__v", "__code")
        return df

    def encode(self, df: DataFrame) -> DataFrame:
        """Text columns → 0-based rank of the sorted distinct (imputed) values."""
        names = df.columns
        out = self.with_codes(df)
        return out.select(*[F.col(f"__code_{c}").alias(c) if c in self.text_cols else F.col(c) for c in names])

    # --- T4/T5 --------------------------------------------------------------
    def feature_expr(self, feature: str) -> Column:
        """Imputed, encoded (not yet scaled) value of a feature as double, over ``with_codes``."""
        c = self.source(feature)
        return F.col(f"__code_{c}").cast("double") if c in self.text_cols else self.impute_expr(c)

    def scale_expr(self, c: str, raw: Column) -> Column:
        return (raw - F.lit(self.means[c])) / F.lit(self.stds[c])

    def scaled_expr(self, feature: str) -> Column:
        return self.scale_expr(feature, self.feature_expr(feature))

    def transform(self, df: DataFrame, keep: list | None = None) -> DataFrame:
        """Key + scaled features; the key column itself passes through unchanged."""
        cols = [F.col(self.key)] + [F.col(k) for k in (keep or [])]
        cols += [self.scaled_expr(c).alias(c) for c in self.feature_names]
        return self.with_codes(df).select(*cols)

    def unscaled(self, df: DataFrame) -> DataFrame:
        """Key + imputed and encoded features, before scaling."""
        return self.with_codes(df).select(F.col(self.key), *[self.feature_expr(c).alias(c) for c in self.feature_names])

    def inverse(self, scaled: DataFrame) -> DataFrame:
        """T5: x·std + mean for every feature column."""
        return scaled.withColumns(
            {c: F.col(c) * F.lit(self.stds[c]) + F.lit(self.means[c]) for c in self.feature_names if c in scaled.columns}
        )

    def params(self, spark) -> DataFrame:
        """Fitted parameters as a small table (feature, mean, std, median, mode, n_categories)."""
        rows = []
        for f in self.feature_names:
            c = self.source(f)
            rows.append((f, float(self.means[f]), float(self.stds[f]), self.medians.get(c), self.modes.get(c), self.n_categories.get(c)))
        return spark.createDataFrame(
            rows, "feature string, mean double, std double, median double, mode string, n_categories bigint"
        )


def _split_types(df: DataFrame, cols: list) -> tuple[list, list]:
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in cols if isinstance(types[c], _NUMERIC)]
    text = [c for c in cols if isinstance(types[c], T.StringType)]
    return numeric, text


def fit_medians(df: DataFrame, cols: list, sketches: DataFrame | None = None) -> dict:
    """T1 fit: exact median of every numeric column that has a value (null and NaN skipped); from ``sketches``, where
    given, within their rank error and without reading ``df``."""
    spec = {c: [0.5] for c in cols}
    q = exact_quantiles(df, spec) if sketches is None else sk.quantiles(sketches, spec)
    return {c: q[c][0] for c in cols if q[c][0] is not None}


def value_counts(df: DataFrame, cols: list) -> DataFrame:
    """(column, value, n) for every non-null value of the given text columns."""
    packed = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return (
        df.select(F.explode(packed).alias("e"))
        .where(F.col("e.value").isNotNull())
        .groupBy(F.col("e.column").alias("column"), F.col("e.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fit_dictionary(df: DataFrame, cols: list) -> tuple[dict, dict, DataFrame | None]:
    """T2 + T3 fit from one value count: modes, category counts, and the dictionary table.

    Mode: highest count, smallest value on ties.  Code: rank among the sorted
    distinct values (the mode is one of them, so imputed rows never miss).
    """
    if not cols:
        return {}, {}, None
    table = materialise(dense_rank(value_counts(df, cols), ["column"], "value", "code", "value-counts"), "dictionary")
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    rows = table.groupBy("column").agg(best.alias("mode"), F.count(F.lit(1)).alias("k")).collect()
    missing = [c for c in cols if c not in {r["column"] for r in rows}]
    if missing:
        raise ValueError(f"cannot impute text columns {missing}: every value is null")
    return {r["column"]: r["mode"] for r in rows}, {r["column"]: r["k"] for r in rows}, table


def fit_preprocessor(
    df: DataFrame,
    key: str = "session_id",
    label_cols=DEFAULTS.label_cols,
    feature_cols: list | None = None,
    unseen: str = "other",
    sketches: DataFrame | None = None,
) -> PrepModel:
    """Fit T1–T4 on ``df`` (labels are split off and never imputed or used).

    ``feature_cols`` may name the key, which then is a feature as well.  With ``sketches`` the medians are approximate.
    """
    if unseen not in ("other", "null", "error"):
        raise ValueError(f"unseen must be other, null or error, not {unseen!r}")
    labels = [c for c in label_cols if c in df.columns]
    cols = feature_cols or [c for c in df.columns if c != key and c not in labels]
    numeric, text = _split_types(df, cols)
    unknown = [c for c in cols if c not in numeric and c not in text]
    if unknown:
        raise TypeError(f"unsupported feature column types: {unknown}")
    if key in text:
        raise TypeError("a text key cannot be a feature")
    feature_names = [f"{key}_value" if c == key else c for c in cols]

    modes, sizes, table = fit_dictionary(df, text)
    model = PrepModel(key, labels, numeric, text, feature_names, fit_medians(df, numeric, sketches), modes, sizes, table, unseen=unseen)

    # T4 fit: mean and population std of the imputed/encoded values, one aggregate.
    raw = model.unscaled(df)
    stats = raw.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(feature_names)],
        *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(feature_names)],
    ).first()
    for i, c in enumerate(feature_names):
        m, s = stats[f"m_{i}"], stats[f"s_{i}"]
        model.means[c] = float(m) if m is not None else 0.0
        model.stds[c] = float(s) if s is not None and s >= _EPS_STD else 1.0
    return model
