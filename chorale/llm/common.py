"""What several operators share: null-safe joins, ranks without gathering, bounded batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chorale.session import materialize

# White space and words of the contracts, as Java and Python both read them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def equi(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null equal to null; the keys stay once."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    condition = None
    for k in keys:
        part = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, rank: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row inside its group.

    Rows are dealt by range over group and order, so a group with a third of
    all rows lies in many tasks. A row's place inside its task is known from
    the sorted write; small sums per (task, group) turn places into ranks.
    Rows that tie in ``order`` get their ranks in any order.
    """
    placed = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    sizes = placed.groupBy("_task", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # Exclusive running sums over the tasks of a group: one row per task and group.
    window = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(window), F.lit(0)))
    joined = equi(placed, offsets.select("_task", *group, "_first", "_before"), ["_task", *group])
    return joined.withColumn(rank, F.col("_at") - F.col("_first") + F.col("_before")).drop(
        "_at", "_task", "_first", "_before"
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def md5_int(*parts: Column | str) -> Column:
    """A seeded number from 0 to 2^32 - 1 that SQL engines agree on."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one holds about ``most`` bytes of ``column``, and a row at least."""
    for batch in batches:
        array = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(array), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def salted(left: DataFrame, right: DataFrame, keys: Sequence[str], row: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """``equi`` for a left side in which one key may hold a third of all rows.

    Left rows are dealt into ``salts`` parts by their ``row`` id; the right
    side, which has few rows a key, is repeated for each part and merged: a
    repeated table is no small one.
    """
    part = F.pmod(F.xxhash64(row), F.lit(salts)).alias("_salt")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_salt")
    return equi(left.select("*", part), right.select("*", every).hint("merge"), [*keys, "_salt"], how).drop("_salt")
