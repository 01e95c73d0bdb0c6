"""Ten numeric features of a text, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.config import LYRIC_FEATURES
from chorale.functions.arrays import with_runs
from chorale.functions.text import WS, line_count, words


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def lexical_features(df: DataFrame, text_col: str, prefix: str = "lyr_") -> DataFrame:
    """Append the ten features. Blank and null texts get zero everywhere."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    folded = words(F.lower(text))
    n = F.col("_n_words")
    lines = line_count(text)
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(text, r"\P{IsUppercase}+", ""))
    visible = F.length(F.regexp_replace(text, f"(?U)[{WS}]+", ""))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when((n > 0) & (bottom > 0), top / bottom).otherwise(0.0)

    # Size, distinct count and top frequency all come from the counted words.
    staged = with_runs(df.withColumn("_folded", folded), "_folded", "_runs").withColumns(
        {
            "_n_words": F.size("_folded"),
            "_n_unique": F.coalesce(F.size("_runs"), F.lit(0)),
            "_top_word": F.array_max("_runs.n"),
        }
    )
    values = {
        "word_count": n,
        "unique_word_count": F.col("_n_unique"),
        "vocab_diversity": ratio(F.col("_n_unique"), n),
        "line_count": F.when(n > 0, lines).otherwise(0),
        "avg_word_length": ratio(visible, n),
        "avg_line_length": ratio(n, lines),
        "exclaim_density": ratio(_occurrences(text, "!"), n),
        "question_density": ratio(_occurrences(text, "?"), n),
        "repetition_ratio": ratio(F.col("_top_word"), n),
        "uppercase_ratio": ratio(capitals, letters),
    }
    return staged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[values[name].alias(prefix + name) for name in LYRIC_FEATURES],
    )
