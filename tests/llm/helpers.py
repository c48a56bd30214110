"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "size long, score double, n_lines string, _k1 int, copies string, class_id int, lang_pred int, ids int, failed string, n_replaced int"


def docs(spark, rows):
    """rows of (doc_id, text[, lang[, source]])."""
    full = []
    for r in rows:
        r = (*r, *([None] * (4 - len(r))))
        full.append((*r, None if r[1] is None else len(r[1])))
    return spark.createDataFrame(full, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(7).cast(part.split()[1]).alias(part.split()[0]) for part in CLASH.split(", ") if part.split()[0] not in df.columns])


def awkward(spark):
    """Null and empty texts, null ids and sources, repeated rows, a very long text, signs beyond the BMP."""
    long_text = "\n".join(f"line {i % 700} of a long text, with word{i}" for i in range(6000))
    return docs(
        spark,
        [
            (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, "one two three", "en", "b"), (4, "one two three", "en", "b"),
            (None, "one two three", None, None), (5, long_text, "en", "a"), (6, "😀 日本語 straße É\x1c\x85", "de", "c"), (None, None, None, None),
        ],
    )


def many(spark, sf_dir="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
