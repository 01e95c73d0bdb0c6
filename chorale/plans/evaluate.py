"""Supervised and unsupervised evaluation of a built dataset."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce as reduce_frames

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.config import TARGET_GENRES
from chorale.operators import classify, cluster, metrics, reduce
from chorale.operators.features import build_features, dense_matrix
from chorale.operators.neighbours import knn_predict
from chorale.session import materialize


def predict_splits(
    parts: DataFrame, model: str, mode: str, key: str, label: str = "genre", max_features: int = 10_000,
    seed: int = 42, **overrides,
) -> tuple[DataFrame, dict]:
    """(key, split, label, predicted) for val and test, and what was fitted.

    ``mode`` is audio, lyrics or both; the table must have its columns.
    """
    if mode not in ("audio", "lyrics", "both"):
        raise ValueError(f"unknown mode: {mode!r}")
    bundle = build_features(
        parts, [key, label], max_features=max_features, use_audio=mode in ("audio", "both"),
        use_tfidf=mode in ("lyrics", "both"), use_lyric_numerics=mode in ("lyrics", "both"),
    )
    if model == "knn":
        params = {**classify.settings(classify.NEIGHBOURS, mode), **overrides}
        held_out = bundle.arrays.filter(F.col("split") != "train")
        found = knn_predict(
            bundle.arrays.filter(F.col("split") == "train"), held_out, "features", label, key, **params
        )
        scored = held_out.select(key, "split", label).join(found, key)
        return scored.withColumnRenamed("prediction", "predicted"), {"bundle": bundle, "model": None}
    encoder = classify.label_encoder(bundle.vectors.filter(F.col("split") == "train"), label)
    rows = encoder.transform(bundle.vectors)
    train, held_out = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") != "train")
    if model == "logistic":
        fitted = classify.fit_logistic(train, mode, **overrides)
    elif model == "xgboost":
        fitted = classify.fit_boosted(train, mode, seed=seed, **overrides)
    else:
        raise ValueError(f"unknown model: {model!r}")
    decoder = classify.label_decoder(encoder.labels)
    scored = decoder.transform(fitted.transform(held_out)).select(key, "split", label, "predicted")
    return scored, {"bundle": bundle, "model": fitted, "labels": list(encoder.labels)}


def prediction_counts(scored: DataFrame, label: str = "genre") -> DataFrame:
    """(split, label, predicted, n): the one pass over the predictions; every score follows from it."""
    counts = scored.groupBy("split", label, "predicted").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts, "predictions")


def supervised_metrics(scored: DataFrame, label: str = "genre", labels: Sequence[str] = TARGET_GENRES) -> DataFrame:
    """(split, metric, label, predicted, value): overall scores, scores per class and the confusion matrix."""
    counts = prediction_counts(scored, label)
    tables = []
    for split in ("val", "test"):
        rows = counts.filter(F.col("split") == split)
        whole = metrics.overall_scores(rows, label, "predicted", "n")
        single = metrics.class_scores(rows, label, "predicted", labels, "n")
        tables += [
            whole.unpivot([], ["accuracy", "macro_f1", "weighted_f1"], "metric", "value").withColumn("label", F.lit(None).cast("string")),
            single.unpivot("label", ["f1", "recall", "precision"], "metric", "value"),
        ]
        tables[-2:] = [t.withColumn("split", F.lit(split)).withColumn("predicted", F.lit(None).cast("string")) for t in tables[-2:]]
    pairs = counts.filter(F.col("split").isin("val", "test"))
    tables.append(
        pairs.select("split", F.lit("confusion").alias("metric"), F.col(label).alias("label"), "predicted", F.col("n").cast("double").alias("value"))
    )
    order = ["split", "metric", "label", "predicted", "value"]
    return reduce_frames(DataFrame.unionByName, [t.select(order) for t in tables])


def cluster_table(df: DataFrame, model: str, mode: str, key: str, k: int = 6, covariance: str = "full",
                  label: str = "genre", seed: int = 42, **overrides) -> tuple[DataFrame, DataFrame | None]:
    """(key, label, x, cluster) and, for mixtures, their fit scores."""
    matrix, _ = dense_matrix(df, mode, [key, label])
    if model == "kmeans":
        fitted = cluster.fit_kmeans(matrix, "x", k, seed=seed, **overrides)
        return cluster.assign_kmeans(fitted, matrix, "x"), None
    if model == "gmm":
        fitted = cluster.fit_mixture(matrix, "x", k, covariance, seed=seed, **overrides)
        return cluster.assign_mixture(fitted, matrix, "x"), cluster.mixture_scores(fitted, matrix, "x")
    raise ValueError(f"unknown model: {model!r}")


def cluster_metrics(clustered: DataFrame, key: str, label: str = "genre", seed: int = 42) -> DataFrame:
    """One row: silhouette, davies_bouldin, ari, purity, n_clusters."""
    parts = {
        "silhouette": metrics.silhouette(clustered, "x", "cluster", [key], seed=seed),
        "davies_bouldin": metrics.davies_bouldin(clustered, "x", "cluster"),
        "ari": metrics.adjusted_rand(clustered, "cluster", label),
        "purity": metrics.purity(clustered, "cluster", label),
        "n_clusters": clustered.agg(F.countDistinct("cluster").cast("double").alias("n_clusters")),
    }
    # Each part is one number, so the row is put together on the driver.
    row = tuple(float(part.first()[0]) for part in parts.values())
    return clustered.sparkSession.createDataFrame([row], ", ".join(f"{name} double" for name in parts))


def cluster_report(clustered: DataFrame, key: str, scores: DataFrame | None = None, label: str = "genre", seed: int = 42) -> DataFrame:
    """(metric, cluster, label, value): whole-clustering scores, a mixture's own scores, each cluster's size and its
    dominant label with the rows that have it."""
    numbers = cluster_metrics(clustered, key, label, seed)
    if scores is not None:
        numbers = numbers.join(scores.withColumns({"converged": F.col("converged").cast("double"), "n_iter": F.col("n_iter").cast("double")}))
    names = [f.name for f in numbers.schema.fields if f.dataType.typeName() == "double"]
    whole = numbers.unpivot([], names, "metric", "value").select(
        "metric", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("string").alias("label"), "value"
    )
    chosen = materialize(metrics.dominant_labels(clustered, "cluster", label), "dominant")
    single = [
        chosen.select(F.lit(name).alias("metric"), F.col("cluster").cast("int").alias("cluster"), shown.alias("label"), F.col(value).cast("double").alias("value"))
        for name, shown, value in (("size", F.lit(None).cast("string"), "size"), ("dominant", F.col("label"), "hits"))
    ]
    return reduce_frames(DataFrame.unionByName, [whole, *single])


def projection_2d(clustered: DataFrame, key: str, label: str = "genre") -> DataFrame:
    """(key, label, cluster, pc1, pc2) for a scatter plot."""
    model = reduce.fit_pca(clustered, "x", 2)
    scored = reduce.project(model, clustered, "x")
    return scored.select(key, label, "cluster", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"))


def to_json(table: DataFrame) -> str:
    """All rows of a metrics table as JSON text, fetched partition by partition."""
    return json.dumps([r.asDict(recursive=True) for r in table.toLocalIterator()], indent=2, default=str)
