"""Scores of classifications and clusterings.

Each score starts from one grouped count over the table; everything after it
works on at most (classes x classes) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.operators.sampling import sample_exact
from chorale.session import SMALL_ROWS, materialize, small_side


def _pair_counts(df: DataFrame, truth: str, pred: str, weight: str | None = None) -> DataFrame:
    """Rows per pair; with ``weight``, rows are counted already."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(n.alias("n"))


def _per_label(pairs: DataFrame) -> DataFrame:
    """(label, hits, support, predicted) over labels in truth or prediction."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(zero)
    as_truth = F.struct(
        F.col("truth").alias("label"), hit.alias("hits"), F.col("n").alias("support"), zero.alias("predicted")
    )
    as_pred = F.struct(
        F.col("pred").alias("label"), zero.alias("hits"), zero.alias("support"), F.col("n").alias("predicted")
    )
    return (
        pairs.select(F.inline(F.array(as_truth, as_pred)))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("hits", "support", "predicted")])
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _scored(per_label: DataFrame) -> DataFrame:
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return per_label.select(
        "label",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, support + predicted).alias("f1"),
        "support",
        "hits",
    )


def _labels_frame(df: DataFrame, labels: Sequence) -> DataFrame:
    return df.sparkSession.createDataFrame([(v,) for v in labels], ["label"])


def class_scores(
    df: DataFrame, truth: str, pred: str, labels: Sequence | None = None, weight: str | None = None
) -> DataFrame:
    """(label, precision, recall, f1, support), zero where undefined."""
    scored = _scored(_per_label(_pair_counts(df, truth, pred, weight))).drop("hits")
    if labels is None:
        return scored
    return _labels_frame(df, labels).join(scored, "label", "left").na.fill(0)


def overall_scores(df: DataFrame, truth: str, pred: str, weight: str | None = None) -> DataFrame:
    """(accuracy, macro_f1, weighted_f1, n) in one row."""
    n = F.sum("support")
    return _scored(_per_label(_pair_counts(df, truth, pred, weight))).agg(
        (F.sum("hits") / n).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"),
        n.alias("n"),
    )


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Per-class rows plus the accuracy, macro and weighted averages."""
    scored = _scored(_per_label(_pair_counts(df, truth, pred)))
    n = F.sum("support")
    cols = ("precision", "recall", "f1")
    weighted = [(F.sum(F.col(c) * F.col("support")) / n).alias(f"w_{c}") for c in cols]
    means = scored.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *weighted,
        (F.sum("hits") / n).alias("acc"), n.alias("support"),
    )

    def line(name: str, prefix: str) -> Column:
        return F.struct(F.lit(name).alias("label"), *[F.col(f"{prefix}_{c}").alias(c) for c in cols], F.col("support"))

    accuracy = F.struct(
        F.lit("accuracy").alias("label"), *[F.col("acc").alias(c) for c in cols], F.col("support")
    )
    averages = means.select(F.inline(F.array(accuracy, line("macro avg", "m"), line("weighted avg", "w"))))
    return scored.drop("hits").withColumn("label", F.col("label").cast("string")).unionByName(averages)


def confusion_matrix(
    df: DataFrame, truth: str, pred: str, labels: Sequence, normalize: bool = False
) -> DataFrame:
    """One row per true label, one column per predicted label, zero-filled."""
    counted = (
        df.groupBy(F.col(truth).alias("label"))
        .pivot(pred, list(labels))
        .agg(F.count(F.lit(1)))
    )
    names = [str(v) for v in labels]
    wide = _labels_frame(df, labels).join(counted, "label", "left").na.fill(0)
    if not normalize:
        return wide
    total = sum((F.col(f"`{c}`") for c in names[1:]), F.col(f"`{names[0]}`"))
    return wide.select("label", *[_ratio(F.col(f"`{c}`"), total).alias(c) for c in names])


def recall_ranking(df: DataFrame, truth: str, pred: str, labels: Sequence) -> DataFrame:
    """(label, recall, baseline), best first; the baseline is a random guess."""
    return (
        class_scores(df, truth, pred, labels)
        .select("label", "recall", F.lit(1.0 / len(labels)).alias("baseline"))
        .orderBy(F.desc("recall"), "label")
    )


# --- clustering --------------------------------------------------------------


def cluster_composition(df: DataFrame, cluster: str, label: str, labels: Sequence) -> DataFrame:
    """(cluster, label, n, fraction): make-up of each cluster, zeros included."""
    counts = df.groupBy(cluster).pivot(label, list(labels)).agg(F.count(F.lit(1)))
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("_size"))
    cells = [
        F.struct(F.lit(v).alias("label"), F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias("n")) for v in labels
    ]
    return (
        counts.join(sizes, cluster)
        .select(cluster, "_size", F.inline(F.array(*cells)))
        .select(cluster, "label", "n", (F.col("n") / F.col("_size")).alias("fraction"))
    )


def dominant_labels(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """(cluster, label, hits, size): most frequent label, ties to the lower."""
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(label).alias("label")))
    return (
        counts.groupBy(cluster)
        .agg(best.alias("b"), F.sum("n").alias("size"))
        .select(cluster, F.col("b.label").alias("label"), (-F.col("b.m")).alias("hits"), "size")
    )


def purity(df: DataFrame, cluster: str, label: str) -> DataFrame:
    return dominant_labels(df, cluster, label).agg((F.sum("hits") / F.sum("size")).alias("purity"))


def adjusted_rand(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Adjusted Rand index from pair counts of cells, rows, columns and all."""
    n = F.col("n").cast("double")
    cells = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("_c"))
    cube = (
        cells.cube(cluster, label)
        .agg(F.sum("_c").alias("n"), F.grouping_id().alias("level"))
        .groupBy()
        .pivot("level", [0, 1, 2, 3])
        .agg(F.sum(n * (n - 1) / 2))
        .toDF("cells", "rows", "cols", "total")
    )
    expected = F.col("rows") * F.col("cols") / F.col("total")
    best = (F.col("rows") + F.col("cols")) / 2
    return cube.select(
        F.when(best == expected, 1.0).otherwise((F.col("cells") - expected) / (best - expected)).alias("ari")
    )


def _width(df: DataFrame, vector: str) -> int:
    row = df.select(F.size(vector)).first()
    if row is None:
        raise ValueError("no rows")
    return row[0]


def _distance(a: str, b: str) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def centroids(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """(cluster, centre): one hash aggregation with a mean per coordinate."""
    width = _width(df, vector)
    means = df.groupBy(cluster).agg(
        *[F.avg(F.col(vector)[i].cast("double")).alias(f"_m{i}") for i in range(width)]
    )
    return means.select(cluster, F.array(*[F.col(f"_m{i}") for i in range(width)]).alias("centre"))


def davies_bouldin(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Mean over clusters of the worst (spread_i + spread_j) / distance_ij."""
    df = df.select(F.col(vector).cast("array<double>").alias("v"), F.col(cluster).alias("c"))
    centre = small_side(centroids(df, "v", "c"))
    spread = (
        df.join(centre, "c")
        .groupBy("c", "centre")
        .agg(F.avg(_distance("v", "centre")).alias("spread"))
        .limit(SMALL_ROWS + 1)
        .collect()
    )
    if len(spread) > SMALL_ROWS:
        raise ValueError("too many clusters")
    centre_matrix = np.array([r["centre"] for r in spread])
    widths = np.array([r["spread"] for r in spread])
    worst = []
    for i in range(len(spread)):
        gap = np.sqrt(((centre_matrix - centre_matrix[i]) ** 2).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            score = (widths + widths[i]) / gap
        score[i] = 0.0
        worst.append(np.nan_to_num(score, nan=0.0, posinf=np.inf).max())
    return df.sparkSession.createDataFrame([(float(np.mean(worst)),)], "davies_bouldin double")


# Bytes of a block of the silhouette's rows, and rows of both sides compared at once inside one.
BLOCK_BYTES, SLICE_ROWS = 8 << 20, 1_024


def silhouette(
    df: DataFrame, vector: str, cluster: str, key: Sequence[str], sample: int | None = None, seed: int = 42
) -> DataFrame:
    """Mean Euclidean silhouette of all rows, or of ``sample`` of them where asked for.

    Every two blocks of rows meet once; a meeting gives, for each row of either
    block, its summed distances to the clusters in the other. No pair of rows
    leaves a task. A block has as many rows as fit its bytes, so a table is
    copied once for each ``BLOCK_BYTES`` it has; a task holds two blocks and the
    distances of ``SLICE_ROWS`` by ``SLICE_ROWS`` rows, whatever their width.

    The score of a sample of n rows has a standard error of about its standard
    deviation over the square root of n: 0.5 / sqrt(3000) is below 0.01.
    """
    rows = df.select(*key, F.col(vector).cast("array<double>").alias("v"), F.col(cluster).cast("string").alias("c"))
    if sample is not None:
        rows = sample_exact(rows, sample, key, seed)
    rows = materialize(rows.select("v", "c", F.xxhash64(*key).alias("k")), "silhouette")
    sizes = rows.groupBy("c").agg(F.count(F.lit(1)).alias("size"))
    # What a row holds besides its vector counts too.
    total = rows.agg(F.coalesce(F.sum(8 * F.size("v") + 64), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_BYTES) or 1
    own = F.pmod("k", F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1)))
    dealt = rows.withColumn("own", own).withColumn("o", every)
    both = dealt.select("v", "c", "k", "own", F.least("own", "o").alias("a"), F.greatest("own", "o").alias("b"))

    def distances(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own, first = table.column("own").to_numpy(), table.column("a")[0].as_py()
        x = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(own), -1)
        label = table.column("c").combine_chunks()
        names, codes = np.unique(label.fill_null("None").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        squares, member = (x * x).sum(axis=1), np.eye(len(names))[codes]
        total = np.zeros((len(own), len(names)))
        same = first == table.column("b")[0].as_py()
        left, right = np.flatnonzero(own == first), np.flatnonzero(own != first)
        mine, others = ([side[at : at + SLICE_ROWS] for at in range(0, len(side), SLICE_ROWS)] for side in (left, left if same else right))
        for i, p in enumerate(mine):
            # Inside one block each two slices are compared once, too.
            for j, q in enumerate(others):
                if same and j < i:
                    continue
                gap = squares[p][:, None] + squares[q] - 2 * x[p] @ x[q].T
                gap = np.sqrt(np.maximum(gap, 0, out=gap), out=gap)
                total[p] += gap @ member[q]
                if not same or i != j:
                    total[q] += gap.T @ member[p]
        # A row was compared with the clusters of the other block.
        held = np.zeros((2, len(names)), bool)
        held[(own != first).astype(int), codes] = True
        row, name = np.nonzero(held[np.zeros(len(own), int) if same else (own == first).astype(int)])
        columns = [table.column("k").take(pa.array(row)), label.take(pa.array(row)), pa.array(names[name]), pa.array(total[row, name])]
        return pa.table(columns, names=["row", "c", "other", "total"])

    met = both.groupBy("a", "b").applyInArrow(distances, "row long, c string, other string, total double")
    summed = met.groupBy("row", "c", "other").agg(F.sum("total").alias("total"))
    sized = summed.join(sizes.withColumnRenamed("c", "other"), "other")
    same = F.col("c") == F.col("other")
    means = sized.groupBy("row", "c").agg(
        F.max(F.when(same, F.col("total") / F.greatest(F.col("size") - 1, F.lit(1)))).alias("inner"),
        F.max(F.when(same, F.col("size"))).alias("own"),
        F.min(F.when(~same, F.col("total") / F.col("size"))).alias("outer"),
    )
    s = (F.col("outer") - F.col("inner")) / F.greatest("outer", "inner", F.lit(1e-300))
    return means.agg(F.avg(F.when(F.col("own") == 1, 0.0).otherwise(s)).alias("silhouette"))
