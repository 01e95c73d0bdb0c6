"""Quality rules whose cut-offs follow each language and source.

Measures are taken from whole texts in one pass of built-in functions. Each
(language, source) keeps, for every measure, a quantile sketch: counts in
log-linear cells (at most 1/64 wide, relative to their value). Such sketches
merge by adding counts, in any order and with the same result, so groups that
are too small to judge take the merged sketch of their language, and then that
of all rows. A cut-off lies ``FENCE`` spreads beyond the outer quartile, and the filter
joins every row with the cut-offs of its group.

Defined results: a null text has no words and fails the base rule; null
languages and sources are groups of their own; repeated rows count as often as
they occur; equal measures fall on the same side; texts of any length are measured
whole, one at a time; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import SPACE, equi, let
from chorale.session import materialize

# Words in a window of the repetition rule.
SPAN = 8
# Rows that a group needs for cut-offs of its own.
ENOUGH = 200
# Spreads (quartile distances) between the outer quartile and the cut-off.
FENCE = 4
# Measures as whole numbers, and the least spread taken for each.
RATIOS = {
    "symbols": ("10000 * n_symbols", "word_chars", 100),
    "dup_lines": ("10000 * n_dup_lines", "n_lines", 100),
    "repeats": ("10000 * n_repeat_words", "n_words", 100),
    "word_length": ("1000 * word_chars", "n_words", 500),
}


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of ``SPAN`` words which the text has twice or more."""

    def window(i: Column) -> Column:
        return F.slice(words, i, SPAN)

    starts = F.sequence(F.lit(1), F.size(words) - (SPAN - 1))

    def exact() -> Column:
        """Windows side by side in order; those equal to a neighbour cover their words."""
        placed = F.sort_array(F.transform(starts, lambda i: F.struct(F.array_join(window(i), " ").alias("w"), i.alias("i"))))

        def covered(s: Column) -> Column:
            found = F.transform(
                s,
                lambda x, k: F.when(
                    F.coalesce(x["w"] == F.get(s, k - 1)["w"], F.lit(False))
                    | F.coalesce(x["w"] == F.get(s, k + 1)["w"], F.lit(False)),
                    x["i"],
                ),
            )
            at = F.sort_array(F.filter(found, lambda i: i.isNotNull()))
            return let(
                at,
                lambda p: F.aggregate(
                    F.transform(p, lambda i, k: F.least(F.lit(SPAN), F.coalesce(F.get(p, k + 1) - i, F.lit(SPAN)))),
                    F.lit(0),
                    lambda a, b: a + b,
                ),
            )

        return let(placed, covered)

    def paired(hashes: Column, ahead: int) -> Column:
        return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + ahead)))

    # Hashes of 2, 4, then 8 words from each place. Few texts repeat a window, and distinct
    # hashes prove that one doesn't; shorter ends can only send a text to the exact way.
    hashes = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda a: let(paired(a, 1), lambda b: let(paired(b, 2), lambda c: paired(c, 4))),
    )
    return F.when(F.size(words) < SPAN, 0).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact()))
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the measures of the whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("c"), repeated_words(w).alias("r")
        ),
    )
    doubled = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    others = [c for c in docs.columns if c != text]
    once = docs.select(
        *others,
        counts.alias("_words"),
        doubled.alias("_lines"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    return once.select(
        *others,
        F.col("_words.n").cast("long").alias("n_words"),
        F.col("_words.c").cast("long").alias("word_chars"),
        "n_symbols",
        F.col("_lines.n").cast("long").alias("n_lines"),
        F.col("_lines.d").cast("long").alias("n_dup_lines"),
        F.col("_words.r").cast("long").alias("n_repeat_words"),
    )


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, cell, n): one mergeable sketch per group and measure."""
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("measure"), F.expr(f"({a}) div greatest({b}, 1)").alias("value"))
                for name, (a, b, _) in RATIOS.items()
            ]
        )
    )
    flat = rows.select("lang", "source", cells.alias("c")).select("lang", "source", "c.measure", "c.value")
    bits = "greatest(length(bin(value)) - 7, 0)"
    cell = F.expr(f"shiftleft(shiftright(value, {bits}), {bits})").alias("cell")
    return flat.groupBy("lang", "source", "measure", cell).agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    """Per group of ``keys``: its rows, and low and high cut-offs of each measure."""
    merged = sketch.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys, "measure").orderBy("cell")
    whole = Window.partitionBy(*keys, "measure")
    summed = merged.select(
        *keys, "measure", "cell", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("rows")
    )
    quartiles = summed.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        F.min(F.when(F.col("upto") * 4 >= F.col("rows"), F.col("cell"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("rows") * 3, F.col("cell"))).alias("q3"),
    )
    columns = [F.max("rows").alias(f"rows{suffix}")]
    for name, (_, _, least) in RATIOS.items():
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * FENCE
        mine = F.col("measure") == name
        columns += [
            F.max(F.when(mine, F.col("q1") - spread)).alias(f"{name}_low{suffix}"),
            F.max(F.when(mine, F.col("q3") + spread)).alias(f"{name}_high{suffix}"),
        ]
    return quartiles.groupBy(*keys).agg(*columns)


def cutoffs(sketch: DataFrame) -> DataFrame:
    """One row of cut-offs for each (lang, source), from the narrowest level with ``ENOUGH`` rows."""
    own, lang = _fences(sketch, ["lang", "source"], ""), _fences(sketch, ["lang"], "_l")
    every = _fences(sketch.withColumn("every", F.lit(0)), ["every"], "_e")
    joined = equi(equi(own, lang, ["lang"]).withColumn("every", F.lit(0)), every, ["every"])
    limits = [f"{name}_{side}" for name in RATIOS for side in ("low", "high")]

    def level(c: str) -> Column:
        return (
            F.when(F.col("rows") >= ENOUGH, F.col(c))
            .when(F.col("rows_l") >= ENOUGH, F.col(f"{c}_l"))
            .otherwise(F.col(f"{c}_e"))
            .alias(c)
        )

    return joined.select("lang", "source", *[level(c) for c in limits])


def judge(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each row's measures, ``base_failed``, ``failed`` (measures beyond a cut-off) and ``kept``."""
    rows = docs.select(F.col(key).alias("key"), "lang", "source", "text")
    rows = materialize(measured(rows), "measures")
    bad = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumn("base_failed", bad)
    # A few hundred cells a group: written once, then read by the three levels.
    sketch = materialize(sketches(rows.filter("NOT base_failed")), "sketches")
    limits = materialize(cutoffs(sketch), "cutoffs")
    # Groups in which all rows fail the base have no cut-offs, and need none.
    joined = equi(rows, limits, ["lang", "source"], "left")
    failed = F.filter(
        F.array(
            *[
                F.when(
                    F.expr(f"({a}) div greatest({b}, 1) NOT BETWEEN {name}_low AND {name}_high"), F.lit(name)
                )
                for name, (a, b, _) in RATIOS.items()
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return joined.select(
        F.col("key").alias(key), "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        "n_repeat_words", "base_failed", failed.alias("failed"),
        (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"),
    )
