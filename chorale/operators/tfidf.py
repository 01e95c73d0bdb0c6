"""TF-IDF over one- and two-word terms.

tf is 1 + ln(count), idf is ln((1 + N) / (1 + df)) + 1, rows have unit length.
The vocabulary keeps terms in at least ``min_df`` texts, then the
``max_features`` with the highest total count (ties in term order).

Fitting shuffles once, on the term, after counts were combined inside each
task. Transforming shuffles nothing: a text is counted against the vocabulary,
weighted and scaled inside its own row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def with_terms(df: DataFrame, text_col: str, out: str, ngrams: tuple[int, int] = (1, 2)) -> DataFrame:
    """Add the array of all terms of a text, in order of appearance per size."""
    low, high = ngrams
    df = df.withColumn("_tokens", tokens(F.col(text_col)))
    t = F.col("_tokens")
    parts, longer = [], t
    for size in range(1, high + 1):
        if size > 1:
            rest = F.slice(t, size, F.greatest(F.size(t) - size + 1, F.lit(0)))
            longer = F.zip_with(
                F.slice(longer, 1, F.greatest(F.size(t) - size + 1, F.lit(0))),
                rest,
                lambda a, b: F.concat(a, F.lit(" "), b),
            )
        if size >= low:
            parts.append(longer)
    return df.withColumn(out, F.concat(*parts)).drop("_tokens")


@dataclass(frozen=True)
class TfidfModel:
    vocabulary: list[str]
    idf: list[float]
    ngrams: tuple[int, int]

    def transform(self, df: DataFrame, text_col: str, out: str = "tfidf") -> DataFrame:
        """Add struct<indices, values>: the unit-length sparse row of a text."""
        if not self.vocabulary:
            empty = F.struct(
                F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values")
            )
            return df.withColumn(out, empty)
        counter = CountVectorizerModel.from_vocabulary(
            self.vocabulary, inputCol="_terms", outputCol="_counts", minTF=1.0
        )
        # One text literal, folded to an array once: no join with the vocabulary.
        idf = F.split(F.lit(",".join(map(repr, self.idf))), ",").cast("array<double>")
        counted = counter.transform(with_terms(df, text_col, "_terms", self.ngrams)).withColumn(
            "_counts", F.unwrap_udt("_counts")
        )
        weighted = counted.withColumn(
            "_weights",
            F.zip_with(
                F.col("_counts.indices"),
                F.col("_counts.values"),
                lambda i, n: (1 + F.log(n)) * F.get(idf, i),
            ),
        )
        # The norm goes in as a repeated array, so it is summed once per row
        # and not once per element.
        w = F.col("_weights")
        norm = F.sqrt(F.aggregate(w, F.lit(0.0), lambda s, x: s + x * x))
        unit = F.zip_with(w, F.array_repeat(norm, F.size(w)), lambda x, n: x / n)
        return weighted.withColumn(
            out, F.struct(F.col("_counts.indices").alias("indices"), unit.alias("values"))
        ).drop("_terms", "_counts", "_weights")

    def long_form(self, df: DataFrame, text_col: str, key: str) -> DataFrame:
        """(key, term, weight), one row per term of a text."""
        names = F.split(F.lit("\n".join(self.vocabulary)), "\n")
        return (
            self.transform(df.select(key, text_col), text_col)
            .select(key, F.inline_outer(F.arrays_zip("tfidf.indices", "tfidf.values")))
            .filter(F.col("indices").isNotNull())
            .select(key, F.get(names, F.col("indices")).alias("term"), F.col("values").alias("weight"))
        )


def term_counts(df: DataFrame, text_col: str, ngrams: tuple[int, int] = (1, 2)) -> DataFrame:
    """(term, df, total) over all texts.

    A text gives its terms and, marked, its distinct terms: two plain lists, as
    sorting and counting inside the row cost more than the rows they save.
    """
    terms = with_terms(df.select(text_col), text_col, "_terms", ngrams)
    lists = F.array(
        F.struct(F.array_distinct("_terms").alias("terms"), F.lit(1).alias("df"), F.lit(0).alias("n")),
        F.struct(F.col("_terms").alias("terms"), F.lit(0).alias("df"), F.lit(1).alias("n")),
    )
    return (
        terms.select(F.inline(lists))
        .select(F.explode("terms").alias("term"), "df", "n")
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("n").alias("total"))
    )


def fit_tfidf(
    df: DataFrame,
    text_col: str,
    max_features: int = 10_000,
    ngrams: tuple[int, int] = (1, 2),
    min_df: int = 2,
) -> TfidfModel:
    n = df.count()
    rows = (
        term_counts(df, text_col, ngrams)
        .filter(F.col("df") >= min_df)
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
        .collect()
    )
    rows.sort(key=lambda r: r["term"])
    return TfidfModel(
        [r["term"] for r in rows],
        [math.log((1 + n) / (1 + r["df"])) + 1 for r in rows],
        ngrams,
    )
