"""Counting inside one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _run_starts(items: Column) -> Column:
    """(item, at): where a sorted array takes a new value."""
    shifted = F.concat(
        F.array(F.lit(None).cast("string")), F.slice(items, 1, F.greatest(F.size(items) - 1, F.lit(0)))
    )
    changed = F.zip_with(items, shifted, lambda x, before: F.when(~x.eqNullSafe(before), x))
    placed = F.transform(changed, lambda x, i: F.struct(x.alias("item"), i.alias("at")))
    return F.filter(placed, lambda s: s["item"].isNotNull())


def _runs(starts: Column, n: Column) -> Column:
    ends = F.concat(F.slice(starts["at"], 2, F.size(starts)), F.array(n))
    return F.zip_with(
        starts,
        ends,
        lambda s, e: F.when(s.isNotNull(), F.struct(s["item"].alias("item"), (e - s["at"]).alias("n"))),
    )


def numbered(items: Column) -> Column:
    """Each string marked with how many equal ones came before, sorted."""
    ordered = F.sort_array(items)
    runs = _runs(_run_starts(ordered), F.size(ordered))
    marked = F.transform(
        runs,
        lambda r: F.transform(
            F.sequence(F.lit(0), r["n"] - 1), lambda k: F.concat(r["item"], F.lit("#"), k.cast("string"))
        ),
    )
    return F.when(F.size(ordered) > 0, F.flatten(marked)).otherwise(F.array().cast("array<string>"))


def with_runs(df: DataFrame, array_col: str, out: str) -> DataFrame:
    """Add array<struct<item, n>>: each distinct string and its count.

    Sort, find where the value changes, subtract neighbours: n log n per row
    and no shuffle. The steps are separate projections so that the sorted array
    is built once. No lambda refers to a whole array: when a later filter is
    pushed below these projections, the work stays n log n.
    """
    items = F.col("_sorted")
    staged = df.withColumn("_sorted", F.sort_array(array_col)).withColumn(
        "_starts", F.when(F.size(items) > 0, _run_starts(items))
    )
    return staged.withColumn(out, _runs(F.col("_starts"), F.size(items))).drop("_sorted", "_starts")
