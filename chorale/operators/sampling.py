"""Exact, repeatable sampling, balancing, deduplication and splitting.

Rows are ranked by a digest of (seed, key), so a result depends on the data and
the seed only, never on partitioning. ``key`` must identify a row.

"The first n rows of a class" never sorts the class. Digests are uniform, so
one narrow pass counts rows per (class, digest prefix); the prefix holding the
n-th row is known from running sums; only that 1/4096 of the class is ranked to
read off the digest of the n-th row. Rows are then kept or labelled by comparing
their digest with that cut: a map-side step that moves no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.session import small_side

PREFIX_DIGITS = 3
MAX_CLASSES = 1_000_000


def digest_rank(seed: int, *key: str) -> Column:
    """Uniform rank of a row: md5 of the seed and the key columns."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def _prefix_counts(df: DataFrame, cls: Column, rank: Column) -> DataFrame:
    return (
        df.select(cls.alias("_class"), F.substring(rank, 1, PREFIX_DIGITS).alias("_prefix"))
        .groupBy("_class", "_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def class_totals(counts: DataFrame, label: str, n: str) -> dict:
    """Rows per class on the driver: one entry per class, size checked."""
    rows = counts.groupBy(label).agg(F.sum(n).alias("_t")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}")
    return {r[0]: r[1] for r in rows}


def _cuts(
    df: DataFrame, cls: Column, rank: Column, prefixes: DataFrame, takes: list[tuple]
) -> DataFrame:
    """Digest of the ``take``-th row, per (class, cut)."""
    spark = df.sparkSession
    schema = f"_class {prefixes.schema['_class'].dataType.simpleString()}, _cut string, _take bigint"
    wanted = spark.createDataFrame(takes, schema)
    if len(takes) <= 20_000:
        wanted = F.broadcast(wanted)
    upto = F.sum("_n").over(Window.partitionBy("_class").orderBy("_prefix"))
    hit = (
        prefixes.withColumn("_hi", upto)
        .join(wanted.withColumnRenamed("_class", "_wanted"), F.col("_class").eqNullSafe(F.col("_wanted")))
        .filter((F.col("_hi") >= F.col("_take")) & (F.col("_hi") - F.col("_n") < F.col("_take")))
        .select("_class", "_prefix", "_cut", (F.col("_take") - F.col("_hi") + F.col("_n")).alias("_nth"))
    )
    inside = (
        df.select(cls.alias("_class"), rank.alias("_rank"))
        .withColumn("_prefix", F.substring("_rank", 1, PREFIX_DIGITS))
    )
    hit = small_side(hit.withColumnsRenamed({"_class": "_hit", "_prefix": "_at_prefix"}))
    same = F.col("_class").eqNullSafe(F.col("_hit")) & (F.col("_prefix") == F.col("_at_prefix"))
    inside = inside.join(hit, same)
    nth = F.row_number().over(Window.partitionBy("_class", "_prefix", "_cut").orderBy("_rank"))
    return (
        inside.withColumn("_row", nth)
        .filter(F.col("_row") == F.col("_nth"))
        .select("_class", "_cut", F.col("_rank").alias("_at"))
    )


# Up to this many classes, their cuts are written into the plan as one CASE.
INLINE_CLASSES = 64


def _with_cuts(df: DataFrame, cls: Column, cuts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add each row's cuts (null where its class has none).

    A handful of classes needs no join at all; more are joined, the cuts being
    copied to every task when their counted number allows.
    """
    rows = cuts.limit(INLINE_CLASSES + 1).collect()
    if len(rows) > INLINE_CLASSES:
        return df.join(small_side(cuts), cls.eqNullSafe(F.col("_class")), "left").drop("_class")
    columns = {}
    for name in names:
        cut = F.lit(None).cast("string")
        for row in rows:
            cut = F.when(cls.eqNullSafe(F.lit(row["_class"])), F.lit(row[name])).otherwise(cut)
        columns[name] = cut
    return df.withColumns(columns)


def take_per_class(
    df: DataFrame, cls: Column, key: Sequence[str], n: int, seed: int
) -> DataFrame:
    """At most ``n`` rows of every class, null being one: those with the lowest digests."""
    if n < 0:
        raise ValueError(f"rows wanted: {n}")
    if n == 0:
        return df.limit(0)
    rank = digest_rank(seed, *key)
    prefixes = _prefix_counts(df, cls, rank).persist()
    try:
        totals = class_totals(prefixes, "_class", "_n")
        takes = [(c, "n", n) for c, total in totals.items() if total > n]
        if not takes:
            return df
        marked = _with_cuts(df, cls, _cuts(df, cls, rank, prefixes, takes).drop("_cut"), ["_at"])
    finally:
        prefixes.unpersist()
    return marked.filter(F.col("_at").isNull() | (rank <= F.col("_at"))).drop("_at")


def sample_exact(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement; all rows when there are fewer."""
    return take_per_class(df, F.lit(1), key, n, seed)


def first_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the lowest value of a numeric key; which of equal ones is open."""
    from chorale.operators.quantiles import nth_value

    if n < 0:
        raise ValueError(f"rows wanted: {n}")
    if n == 0:
        return df.limit(0)
    cut = nth_value(df, key, n)
    if cut is None:
        return df
    upto = df.filter(F.col(key) <= F.lit(cut))
    below, at = (df.filter(c).count() for c in (F.col(key) < F.lit(cut), F.col(key) == F.lit(cut)))
    if below + at == n:
        return upto
    return df.filter(F.col(key) < F.lit(cut)).unionByName(df.filter(F.col(key) == F.lit(cut)).limit(n - below))


def filter_targets(df: DataFrame, label: str, targets: Iterable[str]) -> DataFrame:
    return df.filter(F.col(label).isin(list(targets)))


STRATEGIES = ("undersample", "cap", "none")


def check_balancing(strategy: str, samples_per_class: int) -> None:
    """Settings that no table could satisfy are refused before any job runs."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy {strategy!r} is none of {', '.join(STRATEGIES)}")
    if samples_per_class < 0:
        raise ValueError(f"samples_per_class is below zero: {samples_per_class}")


def check_split_sizes(test_size: float, val_size: float) -> None:
    """Test rows there must be, and rows must be left for training."""
    if not 0 < test_size < 1 or not 0 <= val_size < 1 or test_size + val_size >= 1:
        raise ValueError(f"no rows for one side: test {test_size}, validation {val_size}")


def balance(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    strategy: str = "undersample",
    samples_per_class: int = 4000,
    seed: int = 42,
    targets: Iterable[str] | None = None,
) -> DataFrame:
    """Cut large classes to ``samples_per_class`` rows.

    ``undersample`` and ``cap`` keep the same rows: both leave a class at or
    below the limit whole. ``none`` only filters to the targets.
    """
    check_balancing(strategy, samples_per_class)
    if targets is not None:
        df = filter_targets(df, label, targets)
    if strategy == "none":
        return df
    df = df.filter(F.col(label).isNotNull())
    return take_per_class(df, F.col(label), key, samples_per_class, seed)


def starved_classes(df: DataFrame, label: str, minimum: int = 500) -> DataFrame:
    """Classes with fewer than ``minimum`` rows."""
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") < minimum)
    )


def _identity(cols: Sequence[str]) -> Column:
    """Fixed-width stand-in for the values of ``cols``; null equals null."""
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def dedupe(df: DataFrame, on: Sequence[str], key: Sequence[str], seed: int = 42) -> DataFrame:
    """One row per distinct ``on``: the one with the lowest digest.

    Groups of copies shrink to one candidate per map task before the shuffle,
    and only digests and keys travel; the chosen rows come back by a semi-join
    on the row key, which is spread evenly however large a group of copies is.
    """
    on = [c for c in on if c in df.columns]
    if not on:
        return df
    candidate = F.struct(digest_rank(seed, *key).alias("_rank"), *[F.col(k) for k in key])
    kept = (
        df.groupBy(_identity(on).alias("_id"))
        .agg(F.min(candidate).alias("_first"))
        .select("_first.*")
        .drop("_rank")
    )
    return df.join(kept, list(key), "left_semi")


def split_quotas(counts: dict, test_size: float, val_size: float) -> dict:
    """Rows per class for (train, val, test), by largest remainder.

    At each cut the side that stays for training gets its proportional share
    of every class, rounded down; spare seats go to the largest remainders,
    ties to the lower label.
    """

    def seats(sizes: dict, kept: int) -> dict:
        total = sum(sizes.values())
        share = {c: divmod(n * kept, total) for c, n in sizes.items()}
        spare = kept - sum(q for q, _ in share.values())
        extra = set(sorted(share, key=lambda c: (-share[c][1], str(c)))[:spare])
        return {c: share[c][0] + (c in extra) for c in sizes}

    def check(sizes: dict, held_out: int) -> None:
        small = [c for c, n in sizes.items() if n < 2]
        if small:
            raise ValueError(f"classes with fewer than 2 rows: {sorted(map(str, small))}")
        if held_out < len(sizes) or sum(sizes.values()) - held_out < len(sizes):
            raise ValueError("a side of the split is smaller than the number of classes")

    total = sum(counts.values())
    n_test = math.ceil(test_size * total)
    check(counts, n_test)
    inner = seats(counts, total - n_test)
    if val_size > 0:
        n_val = math.ceil(val_size / (1 - test_size) * (total - n_test))
        check(inner, n_val)
        train = seats(inner, total - n_test - n_val)
    else:
        train = inner
    return {c: (train[c], inner[c] - train[c], counts[c] - inner[c]) for c in counts}


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    dedupe_on: Sequence[str] | None = None,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` (train / val / test) with exact quotas per class.

    Without the label column the split is unstratified. The rows passed to
    this function are read three times (two narrow passes), so hand it a table
    that is cheap to read.
    """
    check_split_sizes(test_size, val_size)
    if dedupe_on:
        df = dedupe(df, dedupe_on, key, seed)
    cls = F.col(label) if label in df.columns else F.lit("all")
    rank = digest_rank(seed, *key)
    prefixes = _prefix_counts(df, cls, rank).persist()
    try:
        totals = class_totals(prefixes, "_class", "_n")
        if None in totals:
            raise ValueError(f"{totals[None]} rows without {label!r} cannot be split by it")
        quotas = split_quotas(totals, test_size, val_size)
        takes = []
        for c, (train, val, _) in quotas.items():
            takes += [(c, "train", train), (c, "val", train + val)]
        cuts = (
            _cuts(df, cls, rank, prefixes, takes)
            .groupBy("_class")
            .pivot("_cut", ["train", "val"])
            .agg(F.first("_at"))
            .withColumnsRenamed({"train": "_train", "val": "_val"})
        )
        marked = _with_cuts(df, cls, cuts, ["_train", "_val"])
    finally:
        prefixes.unpersist()
    side = (
        F.when(rank <= F.coalesce("_train", F.lit("")), "train")
        .when(rank <= F.coalesce("_val", F.lit("")), "val")
        .otherwise("test")
    )
    return marked.withColumn("split", side).drop("_train", "_val")


def shuffle_rows(df: DataFrame, key: Sequence[str], seed: int = 42) -> DataFrame:
    """A repeatable random order of all rows (a range sort on the digest)."""
    return df.orderBy(digest_rank(seed, *key))


def first_per_group(
    df: DataFrame, group: str, order: Sequence[Column | str], n: int, key: Sequence[str], lanes: int = 64
) -> DataFrame:
    """The first ``n`` rows of every group.

    Each group is dealt over ``lanes`` sub-groups first, and at most ``n`` rows
    of each go on, so no task ever holds a whole group.
    """
    lane = F.pmod(F.xxhash64(*key), F.lit(lanes))
    dealt = df.withColumn("_lane", lane)
    for part in ([group, "_lane"], [group]):
        place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        dealt = dealt.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    return dealt.drop("_lane")
