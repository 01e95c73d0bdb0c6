"""Classifiers on a ``features`` vector, and the reports on fitted ones."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.operators import boosting
from chorale.operators.metrics import overall_scores
from chorale.operators.sampling import class_totals

# --- Fixed values: settings of the three classifiers per feature mode --------
LOGISTIC = {
    "audio": {"C": 1.0, "maxIter": 10_000},
    "lyrics": {"C": 2.0, "maxIter": 50_000},
}
NEIGHBOURS = {
    "audio": {"k": 15, "metric": "euclidean"},
    "lyrics": {"k": 11, "metric": "cosine"},
}
BOOSTED = {
    "audio": {"maxIter": 500, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8", "minInstancesPerNode": 3},
    "lyrics": {"maxIter": 700, "maxDepth": 3, "stepSize": 0.08, "subsamplingRate": 0.8,
               "featureSubsetStrategy": "0.3", "minInstancesPerNode": 5},
}
# --- end of fixed values -----------------------------------------------------


def settings(table: Mapping[str, dict], mode: str) -> dict:
    """``both`` takes the audio settings."""
    return dict(table["lyrics" if mode == "lyrics" else "audio"])


def label_encoder(train: DataFrame, label: str, out: str = "y") -> StringIndexerModel:
    """Labels in sorted order as 0, 1, ...; an unseen label is an error."""
    return StringIndexer(
        inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(train)


def label_decoder(labels: Sequence[str], source: str = "prediction", out: str = "predicted") -> IndexToString:
    return IndexToString(inputCol=source, outputCol=out, labels=list(labels))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight n / (classes * rows of the class), so every class weighs the same."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = class_totals(counts, label, "_n")
    n, k = sum(totals.values()), len(totals)
    table = df.sparkSession.createDataFrame(
        [(c, n / (k * size)) for c, size in totals.items()],
        f"{label} {df.schema[label].dataType.simpleString()}, {out} double",
    )
    return df.join(F.broadcast(table) if k <= 20_000 else table, label, "left")


def fit_logistic(train: DataFrame, mode: str = "audio", label: str = "y", **overrides) -> LogisticRegressionModel:
    """Multinomial, L2, classes weighted equally.

    C weighs the summed loss against the penalty; Spark averages the loss, so
    its parameter is 1 / (C * total weight), and the total weight is the row
    count.
    """
    params = {**settings(LOGISTIC, mode), **overrides}
    weighted = with_class_weight(train, label).persist()
    try:
        model = LogisticRegression(
            featuresCol="features", labelCol=label, weightCol="weight", family="multinomial",
            elasticNetParam=0.0, standardization=False, tol=1e-6,
            maxIter=params["maxIter"], regParam=1.0 / (params["C"] * weighted.count()),
        ).fit(weighted)
    finally:
        weighted.unpersist()
    return model


def logistic_gradient(model: LogisticRegressionModel, train: DataFrame, label: str = "y") -> DataFrame:
    """(label, largest): the largest partial derivative of the penalised loss in each class; zero at the optimum."""
    k, width = model.coefficientMatrix.toArray().shape

    def fold(batches):
        total, weight = np.zeros((k, width + 1)), 0.0
        for pdf in batches:
            x = np.hstack([np.array(pdf["x"].tolist()).reshape(len(pdf), -1), np.ones((len(pdf), 1))])
            gap = np.array(pdf["p"].tolist()).reshape(len(pdf), -1) - np.eye(k)[pdf["y"].astype(int)]
            w = pdf["weight"].to_numpy()
            total, weight = total + (gap * w[:, None]).T @ x, weight + w.sum()
        flat = np.append(total.ravel(), weight)
        yield pd.DataFrame({"i": np.arange(flat.size), "v": flat})

    scored = model.transform(with_class_weight(train, label)).select(
        vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"), F.col(label).alias("y"), "weight"
    )
    # One number for each coefficient of the model.
    sums = scored.mapInPandas(fold, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    flat = np.array([r["v"] for r in sums])
    slope = flat[:-1].reshape(k, width + 1) / flat[-1]
    slope[:, :-1] += model.getRegParam() * model.coefficientMatrix.toArray()
    rows = [(float(c), float(np.abs(slope[c]).max())) for c in range(k)]
    return train.sparkSession.createDataFrame(rows, f"{label} double, largest double")


def fit_boosted(
    train: DataFrame, mode: str = "audio", label: str = "y", seed: int = 42, **overrides
) -> boosting.BoostedModel:
    """Gradient-boosted trees, one binary ensemble per class, rows weighted.

    One-vs-rest as by MLlib's binary trees, which replaces a softmax objective;
    the ensembles of all classes grow in the same passes over sparse rows.
    """
    params = {**settings(BOOSTED, mode), **overrides}
    return boosting.fit(with_class_weight(train, label), label, "weight", seed, **params)


def random_search(
    fit: Callable[..., object],
    train: DataFrame,
    validation: DataFrame,
    grid: Mapping[str, Sequence],
    trials: int,
    label: str = "y",
    seed: int = 42,
) -> DataFrame:
    """(trial, params, val_macro_f1), best first: seeded draws from a grid, no setting twice.

    As many trials as the grid has settings try all of them.
    """
    names = sorted(grid)
    every = [dict(zip(names, chosen)) for chosen in itertools.product(*(list(grid[name]) for name in names))]
    rows = []
    for trial, params in enumerate(random.Random(seed).sample(every, min(trials, len(every)))):
        scored = fit(train, label=label, **params).transform(validation)
        score = overall_scores(scored, label, "prediction").first()["macro_f1"]
        rows.append((trial, str(params), score))
    rows.sort(key=lambda r: (-r[2], r[0]))
    return train.sparkSession.createDataFrame(rows, "trial int, params string, val_macro_f1 double")


# --- what a fitted model says about its features -----------------------------


def _top(df, names, scores, n: int | None) -> DataFrame:
    ranked = sorted(zip(names, map(float, scores)), key=lambda p: (-p[1], p[0]))[:n]
    return df.createDataFrame([(i + 1, f, s) for i, (f, s) in enumerate(ranked)], "rank int, feature string, score double")


def gain_importance(spark, model: boosting.BoostedModel, names: Sequence[str], top_n: int = 15) -> DataFrame:
    """Gain importance averaged over the one-vs-rest ensembles."""
    return _top(spark, names, model.importances.mean(axis=0), top_n)


def coefficient_importance(spark, model: LogisticRegressionModel, names: Sequence[str]) -> DataFrame:
    """Mean absolute coefficient over the classes."""
    return _top(spark, names, np.abs(model.coefficientMatrix.toArray()).mean(axis=0), None)


def top_words_by_coefficient(
    spark, model: LogisticRegressionModel, names: Sequence[str], labels: Sequence[str], n: int = 10
) -> DataFrame:
    """(label, rank, word, coefficient): strongest TF-IDF terms per class."""
    terms = [i for i, name in enumerate(names) if name.startswith("tfidf::")]
    rows = []
    for label, line in zip(labels, model.coefficientMatrix.toArray()):
        best = sorted(terms, key=lambda i: (-line[i], names[i]))[:n]
        rows += [
            (label, r + 1, names[i].removeprefix("tfidf::"), float(line[i])) for r, i in enumerate(best)
        ]
    return spark.createDataFrame(rows, "label string, rank int, word string, coefficient double")
