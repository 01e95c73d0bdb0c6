"""Distribution reports and the tables behind the exploratory figures."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.config import REPORT_STOP_WORDS
from chorale.functions.text import words
from chorale.operators.sampling import first_per_group
from chorale.session import small_side


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per non-null label, largest first."""
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), label)
    )


def _share(counts: DataFrame) -> Column:
    """Share of each ``n`` in their sum: one number from a subquery, however many labels."""
    return F.col("n") / counts.agg(F.sum("n")).scalar()


def distribution_report(df: DataFrame, label: str) -> DataFrame:
    """Rows and percentage per label; null is a label here."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.bround(_share(counts) * 100, 2))


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """Share per label to three digits."""
    counts = class_counts(df, label)
    return counts.select(label, F.bround(_share(counts), 3).alias("share"))


def counts_with_zeros(df: DataFrame, label: str, targets: Sequence[str]) -> DataFrame:
    """Rows per target label, zero for absent ones."""
    wanted = df.sparkSession.createDataFrame([(t,) for t in targets], f"{label} string")
    counts = df.filter(F.col(label).isin(list(targets))).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, label, "left").select(label, F.coalesce("n", F.lit(0)).alias("n"))


def group_means(df: DataFrame, group: str, cols: Sequence[str], digits: int = 3) -> DataFrame:
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(*[F.bround(F.avg(c), digits).alias(c) for c in cols])
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form.

    One aggregation over the table computes each unordered pair once.
    """
    pairs = list(combinations(cols, 2))
    names = {pair: f"_r{i}" for i, pair in enumerate(pairs)}
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(names[a, b]) for a, b in pairs]
    aggs += [F.corr(F.col(c).cast("double"), F.col(c).cast("double")).alias(f"_d{i}") for i, c in enumerate(cols)]

    def cell(a: str, b: str, name: str) -> Column:
        return F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(name).alias("r"))

    cells = [cell(c, c, f"_d{i}") for i, c in enumerate(cols)]
    for (a, b), name in names.items():
        cells += [cell(a, b, name), cell(b, a, name)]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.countDistinct(col).alias("n"))


def report_words(text: Column) -> Column:
    """Lower-cased words reduced to their letters."""
    return F.transform(words(F.lower(text)), lambda w: F.regexp_replace(w, r"\P{L}+", ""))


def top_words(
    df: DataFrame,
    label: str,
    text: str,
    key: Sequence[str],
    top_k: int = 25,
    texts_per_label: int | None = None,
    stop_words: Sequence[str] = REPORT_STOP_WORDS,
) -> DataFrame:
    """Most frequent words per label, ties in word order.

    Counts all texts, or the first ``texts_per_label`` of a label in key order
    where a number is asked for.
    """
    rows = df.filter(F.col(label).isNotNull()).select(*dict.fromkeys([label, text, *key]))
    if texts_per_label is not None:
        # Only keys are ranked; the texts of the chosen keys are fetched after.
        chosen = first_per_group(rows.select(label, *key), label, list(key), texts_per_label, key)
        rows = rows.join(small_side(chosen.select(*key)), list(key), "left_semi")
    word = F.col("word")
    counted = (
        rows.select(label, F.explode(report_words(F.col(text))).alias("word"))
        .filter((F.length(word) >= 3) & ~word.isin(list(stop_words)))
        .groupBy(label, "word")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    place = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("count"), "word"))
    return counted.withColumn("_place", place).filter(F.col("_place") <= top_k).drop("_place")


def split_report(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows per split and class with totals: null marks a total."""
    cells = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("_c"))
    return cells.rollup(split, label).agg(F.sum("_c").alias("n"), F.grouping_id().alias("level"))
