"""Exact order statistics without gathering a group.

``percentile`` keeps every distinct value of a group in one buffer. Here a
bounded sketch proposes a bracket for each wanted position. One wide pass
counts the rows below and inside every bracket, which proves that it holds its
position; a bracket that misses is opened to the side of its position, and one
that is wide is narrowed by a sketch of the values inside it, until all hold. Only values inside the brackets
are then ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.session import materialize, small_side

# Accuracy of the sketches, what they may miss a rank by with room to spare, and rows of a bracket that is narrowed.
ACCURACY = 2_000
_MARGIN = 3 / ACCURACY
WIDE = 100_000


def _brackets(df: DataFrame, group: str | None, cols: Sequence[str], probs: Sequence[float]):
    """(group, column, prob, n, lo, hi, min, max): one row per wanted quantile."""
    wanted = sorted({0.0, 1.0, *[max(0.0, p - _MARGIN) for p in probs], *[min(1.0, p + _MARGIN) for p in probs]})
    at = {p: i for i, p in enumerate(wanted)}
    aggs = []
    for c in cols:
        value = _number(df, c)
        aggs += [
            F.count(value).alias(f"{c}__n"),
            F.percentile_approx(value, [float(p) for p in wanted], ACCURACY).alias(f"{c}__q"),
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
        ]
    keys = [group] if group else []
    wide = df.groupBy(*keys).agg(*aggs)
    rows = []
    for c in cols:
        for p in probs:
            small = F.col(f"{c}__n") <= ACCURACY
            rows.append(
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(float(p)).alias("prob"),
                    F.col(f"{c}__n").alias("n"),
                    F.when(small, F.col(f"{c}__min"))
                    .otherwise(F.col(f"{c}__q")[at[max(0.0, p - _MARGIN)]]).alias("lo"),
                    F.when(small, F.col(f"{c}__max"))
                    .otherwise(F.col(f"{c}__q")[at[min(1.0, p + _MARGIN)]]).alias("hi"),
                    F.col(f"{c}__min").alias("min"),
                    F.col(f"{c}__max").alias("max"),
                )
            )
    return wide.select(*keys, F.inline(F.array(*rows))).filter(F.col("n") > 0)


def _stacked(df: DataFrame, keys: list[str], cols: Sequence[str]) -> DataFrame:
    """(keys, column, x): one row per non-null value."""
    cells = [F.struct(F.lit(c).alias("column"), _number(df, c).alias("x")) for c in cols]
    return df.select(*keys, F.inline(F.array(*cells))).filter(F.col("x").isNotNull())


def _number(df: DataFrame, c: str):
    """Whole numbers keep their type, so large keys stay exact."""
    kind = "bigint" if df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long") else "double"
    return F.col(c).cast(kind)


def _inside(df: DataFrame, keys: list[str], cols: Sequence[str], probs: Sequence[float], brackets: DataFrame) -> DataFrame:
    """Rows with the brackets of their group, two columns for each column and probability."""
    ends = []
    for c in cols:
        for p in probs:
            own = (F.col("column") == c) & (F.col("prob") == float(p))
            ends += [F.max(F.when(own, F.col(end))).alias(f"_{end}|{c}|{float(p)}") for end in ("lo", "hi")]
    listed = brackets.groupBy(*keys).agg(*ends)
    listed = small_side(listed)
    if keys:
        return df.join(listed, keys)
    return df.withColumn("_all", F.lit(0)).join(listed.withColumn("_all", F.lit(0)), "_all").drop("_all")


def _checked(df: DataFrame, keys: list[str], cols: Sequence[str], probs: Sequence[float], brackets: DataFrame) -> DataFrame:
    """``brackets`` with the rows below and inside each, counted in one pass."""
    rows = _inside(df, keys, cols, probs, brackets)
    sums, parts = [], []
    for c in cols:
        for p in probs:
            x, at = _number(df, c), {end: F.col(f"`_{end}|{c}|{float(p)}`") for end in ("lo", "hi")}
            name = f"{c}|{float(p)}"
            sums += [F.count_if(x < at["lo"]).alias(f"{name}|b"), F.count_if(x.between(at["lo"], at["hi"])).alias(f"{name}|i")]
            parts.append(
                F.struct(
                    F.lit(c).alias("column"), F.lit(float(p)).alias("prob"),
                    F.col(f"`{name}|b`").alias("below"), F.col(f"`{name}|i`").alias("inside"),
                )
            )
    counts = rows.groupBy(*keys).agg(*sums).select(*keys, F.inline(F.array(*parts)))
    return materialize(brackets.join(counts, [*keys, "column", "prob"]), "brackets")


def _held(df: DataFrame, group: str | None, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(group, column, prob, n, lo, hi, below, inside): brackets that hold their positions, none of them wide if it can be helped."""
    keys = [group] if group else []
    brackets = materialize(_brackets(df, group, cols, probs), "brackets")
    position = F.col("prob") * (F.col("n") - 1)
    first, last = F.floor(position), F.ceil(position)
    narrowed = False
    while True:
        found = _checked(df, keys, cols, probs, brackets)
        early, late = first < F.col("below"), last >= F.col("below") + F.col("inside")
        if not found.filter(early | late).isEmpty():
            # The whole range holds every position: this happens once for each side.
            brackets = found.select(
                *keys, "column", "prob", "n", "min", "max",
                F.when(early, F.col("min")).otherwise(F.col("lo")).alias("lo"),
                F.when(late, F.col("max")).otherwise(F.col("hi")).alias("hi"),
            )
            continue
        wide = (F.col("inside") > WIDE) & (F.col("lo") < F.col("hi"))
        if narrowed or found.filter(wide).isEmpty():
            return found
        narrowed = True
        brackets = _narrowed(df, keys, cols, probs, found, first, last, wide)


def _narrowed(df, keys, cols, probs, found: DataFrame, first, last, wide) -> DataFrame:
    """``found`` with tighter brackets where they are wide, by a sketch of the values inside."""
    # Values of wide brackets, each once for every bracket it lies in.
    open_ones = small_side(found.filter(wide))
    values = _stacked(df, keys, cols).join(open_ones, [*keys, "column"]).filter(F.col("x").between(F.col("lo"), F.col("hi")))
    shares = [i / 200 for i in range(201)]
    sketch = values.groupBy(*keys, "column", "prob").agg(F.percentile_approx("x", shares, ACCURACY).alias("q"))
    joined = found.join(sketch, [*keys, "column", "prob"], "left")

    def at(index, step):
        place = F.floor(200 * (index - F.col("below")) / F.col("inside")).cast("int") + step
        return F.get("q", F.greatest(F.least(place, F.lit(200)), F.lit(0)))

    return joined.select(
        *keys, "column", "prob", "n", "min", "max",
        F.coalesce(at(first, -1), F.col("lo")).alias("lo"), F.coalesce(at(last, 2), F.col("hi")).alias("hi"),
    )


def _ranked(df: DataFrame, group: str | None, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Distinct values inside the brackets with the rank their last copy has."""
    keys, probs = [group] if group else [], sorted(set(map(float, probs)))
    held = _held(df, group, cols, probs)
    rows = _inside(df, keys, cols, probs, held)
    cells = []
    for c in cols:
        for p in probs:
            x, at = _number(df, c), {end: F.col(f"`_{end}|{c}|{p}`") for end in ("lo", "hi")}
            inside = x.between(at["lo"], at["hi"])
            cells.append(F.when(inside, F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"), x.alias("x"))))
    values = rows.select(*keys, F.inline(F.filter(F.array(*cells), lambda v: v.isNotNull())))
    counted = values.groupBy(*keys, "column", "prob", "x").agg(F.count(F.lit(1)).alias("_c"))
    counted = counted.join(small_side(held.select(*keys, "column", "prob", "n", "below")), [*keys, "column", "prob"])
    upto = F.sum("_c").over(Window.partitionBy(*keys, "column", "prob").orderBy("x"))
    return counted.withColumn("_upto", upto + F.col("below")).drop("below")


def _reached(index):
    """Lowest value whose copies reach past a zero-based position."""
    return F.min(F.when(F.col("_upto") > index, F.col("x")))


def exact_quantiles(
    df: DataFrame, group: str | None, cols: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """(group, column, prob, n, value) with linear interpolation; nulls skipped."""
    keys = [group] if group else []
    position = F.col("prob") * (F.col("n") - 1)
    below, above = F.floor(position), F.ceil(position)
    return (
        _ranked(df, group, cols, probs)
        .groupBy(*keys, "column", "prob", "n")
        .agg(_reached(below).cast("double").alias("_lo"), _reached(above).cast("double").alias("_hi"))
        .select(
            *keys, "column", "prob", "n",
            (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (position - below)).alias("value"),
        )
    )


def nth_value(df: DataFrame, col: str, n: int):
    """The ``n``-th lowest value of a column, or None when there are no more rows."""
    total = df.agg(F.count(col)).first()[0]
    if total <= n:
        return None
    ranked = _ranked(df, None, [col], [(n - 1) / (total - 1)])
    return ranked.agg(_reached(F.lit(n - 1))).first()[0]


def box_stats(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Quartiles and whiskers per group and column.

    A whisker is the most extreme value within 1.5 IQR of the box, and never
    falls inside the box.
    """
    quartiles = (
        exact_quantiles(df, group, cols, [0.25, 0.5, 0.75])
        .groupBy(group, "column")
        .pivot("prob", [0.25, 0.5, 0.75])
        .agg(F.first("value"))
        .withColumnsRenamed({"0.25": "q1", "0.5": "median", "0.75": "q3"})
    )
    quartiles = small_side(quartiles)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col("x")
    return (
        _stacked(df, [group], cols)
        .join(quartiles, [group, "column"])
        .groupBy(group, "column", "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(x >= F.col("q1") - reach, x)).alias("_lo"),
            F.max(F.when(x <= F.col("q3") + reach, x)).alias("_hi"),
        )
        .select(
            group, "column", "n", "q1", "median", "q3",
            F.least("_lo", "q1").alias("whisker_low"),
            F.greatest("_hi", "q3").alias("whisker_high"),
        )
    )


def summary(df: DataFrame, col: str) -> DataFrame:
    """Median, minimum and maximum of one column."""
    return (
        exact_quantiles(df, None, [col], [0.0, 0.5, 1.0])
        .groupBy("n")
        .pivot("prob", [0.5, 0.0, 1.0])
        .agg(F.first("value"))
        .withColumnsRenamed({"0.5": "median", "0.0": "min", "1.0": "max"})
        .select("n", "median", "min", "max")
    )
