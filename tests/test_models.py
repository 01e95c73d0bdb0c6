"""Features, classifiers, clusterings, projections and their scores."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chorale.operators import classify, cluster, features, language, metrics, neighbours, reduce, scaling, tfidf
from chorale.plans import evaluate, queries


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    centres = np.array([[0, 0, 0], [6, 0, 1], [0, 7, -1]])
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((i, "abc"[c], [float(v) for v in rng.normal(centres[c], 1.0 + c * 0.2)]))
    return spark.createDataFrame(rows, "id int, genre string, x array<double>").repartition(4).persist()


def arrays(points):
    rows = sorted(points.collect())
    return np.array([r["x"] for r in rows]), np.array([r["genre"] for r in rows]), [r["id"] for r in rows]


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0)], "a double, b double")
    scaler = scaling.fit_scaler(df, ["a", "b", "missing"])
    assert scaler.mean["a"] == pytest.approx(1.0)
    assert scaler.scale == {"a": pytest.approx(np.std([1, 2, 0])), "b": 1.0}
    with pytest.raises(ValueError):
        scaling.fit_scaler(df, ["missing"])


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, "The cat the dog"), (2, "the cat"), (3, "x"), (4, None)], "id int, t string")
    model = tfidf.fit_tfidf(df, "t")
    assert model.vocabulary == ["cat", "the", "the cat"]
    idf = math.log(5 / 3) + 1
    rows = {(r["id"], r["term"]): r["weight"] for r in model.long_form(df, "t", "id").collect()}
    weights = {"cat": idf, "the": (1 + math.log(2)) * idf, "the cat": idf}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    assert {t: rows[1, t] for t in weights} == pytest.approx({t: w / norm for t, w in weights.items()})
    assert {i for i, _ in rows} == {1, 2}
    assert tfidf.fit_tfidf(df, "t", max_features=1).vocabulary == ["the"]


def test_terms_are_counted_without_sorting_rows(spark):
    df = spark.createDataFrame([(1, "The cat the cat"), (2, "the dog"), (3, "x"), (4, None)], "id int, t string")
    counts = tfidf.term_counts(df, "t")
    assert {tuple(r) for r in counts.collect()} == {
        ("the", 2, 3), ("cat", 1, 2), ("dog", 1, 1), ("the cat", 1, 2), ("cat the", 1, 1), ("the dog", 1, 1),
    }
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in plan and plan.count("Aggregate") == 1


def test_feature_table(spark):
    df = spark.createDataFrame(
        [(1, "pop", "train", "a cat a cat", 3.0), (2, "pop", "train", "cat dog", 4.0), (3, "rock", "val", "dog cat", 5.0)],
        "id int, genre string, split string, lyrics_clean string, lyr_word_count double",
    )
    bundle = features.build_features(df, ["id", "genre"], min_df=1)
    assert bundle.names[-1] == "lyr_word_count" and "tfidf::dog" in bundle.names
    row = bundle.vectors.filter("id = 3").first()["features"]
    assert row.size == len(bundle.names) and row[row.size - 1] == 5.0
    with pytest.raises(ValueError):
        features.build_features(df.drop("lyrics_clean", "lyr_word_count"), ["id", "genre"])


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("block", [10**6, 16])
def test_neighbours_against_brute_force(points, monkeypatch, metric, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    stored, queries = points.filter("id % 4 <> 0"), points.filter("id % 4 = 0")
    got = neighbours.nearest(stored, queries, "x", "genre", "id", 5, metric).collect()
    x, _, ids = arrays(points)
    if metric == "cosine":
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        gap = 1 - x @ x.T
    else:
        gap = np.linalg.norm(x[:, None] - x[None], axis=2)
    for q in range(0, 240, 4):
        want = sorted((s for s in range(240) if s % 4), key=lambda s: (gap[q, s], s))[:5]
        mine = sorted((r for r in got if r["id"] == q), key=lambda r: r["distance"])
        assert [r["neighbour"] for r in mine] == want
        assert [r["distance"] for r in mine] == pytest.approx([gap[q, s] for s in want], abs=1e-9)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_clustered_neighbours_visit_few_cells(spark, monkeypatch, metric):
    """On clustered data a query meets less than a tenth of the blocks; zero rows and ties are as by brute force."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 32)
    rng, counted = np.random.default_rng(5), []
    centres = rng.standard_normal((40, 12)) * 20
    x = np.concatenate([c + rng.standard_normal((50, 12)) * 0.2 for c in centres] + [np.zeros((3, 12)), centres[:1], centres[:1]])
    df = spark.createDataFrame([(i, "a", [float(u) for u in v]) for i, v in enumerate(x)], "id int, g string, x array<double>")
    inner = neighbours._visited

    def visited(asked, cells, rows, *rest):
        counted.append((asked.count(), (rows > 0).sum()))
        return inner(asked, cells, rows, *rest)

    monkeypatch.setattr(neighbours, "_visited", visited)
    queries = df.filter("id % 5 = 0 OR id >= 2000")
    got = neighbours.nearest(df, queries, "x", "g", "id", 4, metric).collect()
    if metric == "cosine":
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        unit = x / np.where(norm == 0, 1, norm)
        gap = np.maximum(1 - unit @ unit.T, 0)
    else:
        gap = np.linalg.norm(x[:, None] - x[None], axis=2)
    asked = [*range(0, 2000, 5), *range(2001, len(x))]
    for q in asked:
        mine = sorted(r["distance"] for r in got if r["id"] == q)
        assert mine == pytest.approx(np.sort(gap[q])[:4], abs=1e-7)
    zero = sorted(r["neighbour"] for r in got if r["id"] == 2001)
    assert zero == ([0, 1, 2, 3] if metric == "cosine" else sorted([2000, 2001, 2002, zero[0] if zero[0] < 2000 else zero[3]]))
    cells = counted[0][1]
    assert cells >= 40 and sum(n for n, _ in counted) < 0.1 * len(asked) * cells


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("narrow", [1_024, 1])
def test_neighbours_where_nothing_is_ruled_out(spark, monkeypatch, metric, narrow):
    """In many dimensions blocks meet as wholes: rows are copied once a block, not once a visit, and results stay exact."""
    for name, value in (("BLOCK_ROWS", 16), ("MEETING_ROWS", 40), ("TILE", 16), ("NARROW", narrow)):
        monkeypatch.setattr(neighbours, name, value)
    rng, visits, blocks = np.random.default_rng(9), [], []
    x = rng.standard_normal((400, 24)) * (rng.random((400, 24)) < 0.6)
    x[7], x[8], x[9] = 0, x[11], x[11]
    df = spark.createDataFrame([(i, "a", [float(u) for u in v]) for i, v in enumerate(x)], "id int, g string, x array<double>")
    cut, inner = neighbours._blocks, neighbours._visited

    def counted(frame, pivots):
        found = cut(frame, pivots)
        sizes = [r["count"] for r in found[0].groupBy("_block").count().collect()]
        assert len(sizes) == found[1] and max(sizes) <= 40
        blocks.append(found[1])
        return found

    def visited(asked, *rest):
        visits.append(asked.count())
        return inner(asked, *rest)

    monkeypatch.setattr(neighbours, "_blocks", counted)
    monkeypatch.setattr(neighbours, "_visited", visited)
    got = neighbours.nearest(df, df.filter("id % 4 = 0"), "x", "g", "id", 5, metric).collect()
    if metric == "cosine":
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        unit = x / np.where(norm == 0, 1, norm)
        gap = np.maximum(1 - unit @ unit.T, 0)
    else:
        gap = np.linalg.norm(x[:, None] - x[None], axis=2)
    for q in range(0, 400, 4):
        mine = sorted((r["distance"], r["neighbour"]) for r in got if r["id"] == q)
        assert [d for d, _ in mine] == pytest.approx(np.sort(gap[q])[:5], abs=1e-7)
        assert len({s for _, s in mine}) == 5
    assert len(visits) == 1 and visits[0] < 3 * 100 and blocks[1] > 5


def test_outlines_spare_wide_products(monkeypatch):
    """Rows whose length lies in few columns are told apart by these: no tile is multiplied over all its columns."""
    rng, parts, part = np.random.default_rng(3), [], neighbours._Sparse.part
    x = np.hstack([rng.random((300, 3)) * 400, rng.random((300, 2_000)) * (rng.random((300, 2_000)) < 0.02)])
    x[5], x[6] = x[7], 0

    def table(keys):
        rows = [np.flatnonzero(x[i]) for i in keys]
        columns = [keys, ["a"] * len(keys), [0] * len(keys), [math.inf] * len(keys), rows, [x[i][r] for i, r in zip(keys, rows)]]
        types = [pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64())]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["_key", "_label", "_cell", "_tau", "_i", "_v"])

    monkeypatch.setattr(neighbours._Sparse, "part", lambda self, lo, hi: parts.append(lo) or part(self, lo, hi))
    meet = neighbours._meeting(x.shape[1], 4, "cosine", np.arange(3))
    queries = [i for i in range(0, 300, 7) if i != 6]
    got = meet(table(queries), table([*range(300)])).to_pylist()
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    for q in queries:
        mine = sorted((r["distance"], r["neighbour"]) for r in got if r["_q"] == q)
        assert [d for d, _ in mine] == pytest.approx(np.sort(np.maximum(1 - unit @ unit[q], 0))[:4], abs=1e-12)
    assert [r["neighbour"] for r in got if r["_q"] == 7][:2] == [5, 7] and not parts


def test_zero_distance_outvotes(spark):
    near = spark.createDataFrame(
        [(1, "a", 0.0), (1, "b", 0.001), (1, "b", 0.001), (2, "a", 1.0), (2, "b", 0.5)], "id int, label string, distance double"
    )
    assert {r["id"]: r["prediction"] for r in neighbours.vote(near, "id").collect()} == {1: "a", 2: "b"}


def test_logistic_and_importance(points, spark):
    rows = cluster.as_ml(points, "x")
    encoder = classify.label_encoder(rows, "genre")
    encoded = encoder.transform(rows)
    model = classify.fit_logistic(encoded, maxIter=50)
    scored = classify.label_decoder(encoder.labels).transform(model.transform(encoded))
    assert metrics.overall_scores(scored, "genre", "predicted").first()["accuracy"] > 0.95
    assert classify.coefficient_importance(spark, model, ["x", "y", "z"]).count() == 3
    words = classify.top_words_by_coefficient(spark, model, ["tfidf::u", "tfidf::v", "other"], encoder.labels, 1)
    assert {r["word"] for r in words.collect()} <= {"u", "v"} and words.count() == 3
    with pytest.raises(Exception):
        encoder.transform(rows.withColumn("genre", F.lit("unseen"))).collect()


def test_boosted_trees(points, spark):
    rows = cluster.as_ml(points, "x")
    encoded = classify.label_encoder(rows, "genre").transform(rows)
    model = classify.fit_boosted(encoded, maxIter=2, maxDepth=2)
    assert metrics.overall_scores(model.transform(encoded), "y", "prediction").first()["accuracy"] > 0.9
    assert classify.gain_importance(spark, model, ["x", "y", "z"], 2).count() == 2


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "genre string")
    weights = {r["genre"]: r["weight"] for r in classify.with_class_weight(df, "genre").collect()}
    assert weights == {"a": pytest.approx(4 / 6), "b": 2.0}


def test_language_filter(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    detector = language.LanguageFilter(("fr",)).fit(docs, "text", "lang")
    short = spark.createDataFrame([(None,), ("too short",)], "text string")
    assert {r["language"] for r in detector.detect(short, "text").collect()} == {"unknown"}
    kept = detector.filter_dataframe(docs.filter("n_chars > 60"), "text", None)
    assert kept.filter("lang = 'fr'").count() / kept.count() > 0.95
    assert language.LanguageFilter(("de",)).filter_dataframe(docs, "text", "lang").select("lang").distinct().count() == 1
    with pytest.raises(ValueError):
        language.LanguageFilter().detect(docs, "text")


def test_language_models_too_large_to_copy_are_joined(spark, data_dir, monkeypatch):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").withColumn("_row0", F.lit(1))
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    model = language.LanguageFilter().fit(docs, "text", "lang")
    here = sorted(map(str, model.detect(docs, "text").select("doc_id", "language").collect()))
    monkeypatch.setattr(language, "HELD_CELLS", 0)
    assert sorted(map(str, model.detect(docs, "text").select("doc_id", "language").collect())) == here
    assert language.LanguageFilter().fit(docs.limit(0), "text", "lang").detect(docs, "text").count() == docs.count()


def test_language_texts_become_strings_one_at_a_time():
    read = []

    class Value(str):
        def as_py(self):
            read.append(self)
            return str(self)

    class Batch:
        def column(self, name):
            return [Value(f"{name} {i}") for i in range(3)]

    pairs = language._pairs(Batch(), "row")
    assert next(pairs) == ("row 0", "text 0") and len(read) == 2
    assert [text for _, text in pairs] == ["text 1", "text 2"]


def test_language_slices(monkeypatch):
    text = "AbcÄ漢😀 xyz" * 50
    whole = np.concatenate(list(language._trigrams(text)))
    monkeypatch.setattr(language, "SLICE", 7)
    assert (np.concatenate(list(language._trigrams(text))) == whole).all() and whole.size == len(text) - 2


def test_kmeans_finds_the_groups(points):
    model = cluster.fit_kmeans(points, "x", 3, restarts=2)
    found = cluster.assign_kmeans(model, points, "x")
    assert metrics.purity(found, "cluster", "genre").first()[0] > 0.95
    inertia = [r["inertia"] for r in cluster.elbow(points, "x", (2, 3), restarts=1).collect()]
    assert inertia[0] > inertia[1]


@pytest.mark.parametrize("shape", cluster.COVARIANCES)
def test_mixtures(points, shape):
    model = cluster.fit_mixture(points, "x", 3, shape, restarts=1)
    found = cluster.assign_mixture(model, points, "x")
    assert metrics.purity(found, "cluster", "genre").first()[0] > 0.95
    row = cluster.mixture_scores(model, points, "x").first()
    assert row["converged"] and row["bic"] > row["aic"]
    x, _, _ = arrays(points)
    total = sum(
        w * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m))
        / math.sqrt((2 * math.pi) ** 3 * np.linalg.det(c))
        for w, m, c in zip(model.weights, model.means, model.covariances)
    )
    assert row["log_likelihood_per_sample"] == pytest.approx(np.log(total).mean(), abs=1e-9)


def test_published_information_criteria():
    assert cluster.covariance_parameters(6, 9, "full") == 329
    assert cluster.covariance_parameters(6, 10, "full") == 395
    for loglik, n, p, bic, aic in ((-6.1830, 24_000, 329, 300102.38, 297442.15), (1.4694, 20_000, 395, -54863.27, -57985.15)):
        got = cluster.information_criteria(loglik * n, n, p)
        assert got == pytest.approx((bic, aic), abs=3)
        assert got[0] - got[1] == pytest.approx(bic - aic, abs=0.02)
    assert [cluster.covariance_parameters(2, 3, s) for s in cluster.COVARIANCES] == [19, 13, 13, 9]


def test_unknown_shape(points):
    with pytest.raises(ValueError):
        cluster.fit_mixture(points, "x", 2, "round")


def test_components(points, spark):
    x, _, _ = arrays(points)
    model = reduce.fit_pca(points, "x", 2)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert model.variance_ratio == pytest.approx((values / values.sum())[::-1][:2])
    assert np.abs(model.directions @ vectors[:, ::-1][:, :2]) == pytest.approx(np.eye(2), abs=1e-8)
    row = reduce.pca_scores(model, points, "x").first()
    centred = x - x.mean(axis=0)
    back = centred @ model.directions.T @ model.directions
    assert row["reconstruction_mse"] == pytest.approx(((centred - back) ** 2).mean())
    assert reduce.components_for([0.3, 0.2]) == 3 and reduce.components_for([0.9, 0.06]) == 2
    assert reduce.loadings(spark, model, ["a", "b", "c"]).count() == 6


def test_silhouette_holds_tiles_not_blocks(spark, monkeypatch):
    """Narrow rows make blocks of many rows; no array of distances is wider than a slice, and each two rows meet once."""
    rng = np.random.default_rng(4)
    x, c = rng.standard_normal((3000, 2)), rng.integers(0, 3, 3000)
    x[:, 0] += 2 * c
    df = spark.createDataFrame([(i, [float(u) for u in v], int(g)) for i, (v, g) in enumerate(zip(x, c))], "id int, x array<double>, c int")
    gap = np.linalg.norm(x[:, None] - x[None], axis=2)
    means = np.stack([gap[:, c == g].sum(axis=1) / ((c == g).sum() - (c == g)) for g in range(3)], axis=1)
    inner = means[np.arange(3000), c]
    means[np.arange(3000), c] = np.inf
    want = ((means.min(axis=1) - inner) / np.maximum(means.min(axis=1), inner)).mean()
    monkeypatch.setattr(metrics, "SLICE_ROWS", 64)
    for size in (8 << 20, 60_000):
        monkeypatch.setattr(metrics, "BLOCK_BYTES", size)
        assert metrics.silhouette(df, "x", "c", ["id"]).first()[0] == pytest.approx(want, abs=1e-7)
    # The work of one meeting is done in slices of both sides: the greatest array of the task stays small.
    import tracemalloc

    work, table = [], pa.table({"v": x.tolist(), "c": c.astype(str), "k": np.arange(3000), "own": np.zeros(3000, int), "a": [0] * 3000, "b": [0] * 3000})
    monkeypatch.setattr(metrics, "BLOCK_BYTES", 8 << 20)
    grouped = type(df.groupBy("c"))
    monkeypatch.setattr(grouped, "applyInArrow", lambda self, f, schema, run=grouped.applyInArrow: (work.append(f), run(self, f, schema))[1])
    metrics.silhouette(df, "x", "c", ["id"])
    tracemalloc.start()
    assert work[-1](table).num_rows == 9000
    assert tracemalloc.get_traced_memory()[1] < 3_000_000
    tracemalloc.stop()


def test_cluster_scores_against_numpy(points):
    x, genre, _ = arrays(points)
    gap = np.linalg.norm(x[:, None] - x[None], axis=2)
    s = []
    for i in range(len(x)):
        own = genre == genre[i]
        a = gap[i, own].sum() / (own.sum() - 1)
        b = min(gap[i, genre == g].mean() for g in set(genre) - {genre[i]})
        s.append((b - a) / max(a, b))
    assert metrics.silhouette(points, "x", "genre", ["id"]).first()[0] == pytest.approx(np.mean(s))
    centre = {g: x[genre == g].mean(axis=0) for g in "abc"}
    spread = {g: np.linalg.norm(x[genre == g] - centre[g], axis=1).mean() for g in "abc"}
    worst = [
        max((spread[g] + spread[h]) / np.linalg.norm(centre[g] - centre[h]) for h in "abc" if h != g) for g in "abc"
    ]
    assert metrics.davies_bouldin(points, "x", "genre").first()[0] == pytest.approx(np.mean(worst))


def test_perfect_and_single_clusterings(points):
    same = points.withColumn("cluster", F.col("genre"))
    assert metrics.adjusted_rand(same, "cluster", "genre").first()[0] == pytest.approx(1.0)
    flat = points.withColumn("cluster", F.lit(0))
    assert metrics.adjusted_rand(flat, "cluster", "genre").first()[0] == pytest.approx(0.0)
    assert {r["label"] for r in metrics.dominant_labels(flat, "cluster", "genre").collect()} == {"a"}


def test_undefined_scores_are_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "y string, p string")
    rows = {r["label"]: r for r in metrics.class_scores(df, "y", "p", ("a", "b", "c", "d")).collect()}
    assert rows["b"]["f1"] == rows["c"]["recall"] == rows["d"]["precision"] == 0.0
    overall = metrics.overall_scores(df, "y", "p").first()
    assert overall["macro_f1"] == pytest.approx(0.5 / 3)
    assert overall["weighted_f1"] == pytest.approx(0.5 * 2 / 3)


def test_model_queries_use_the_operators_defaults(spark, data_dir, monkeypatch):
    """No query asks for fewer rounds, restarts or sizes than the operator's own."""
    seen = []

    def record(*args, **kwargs):
        seen.append((args, kwargs))
        raise InterruptedError

    for module, name in ((evaluate, "predict_splits"), (evaluate, "cluster_table"), (cluster, "fit_kmeans"),
                         (cluster, "elbow"), (cluster, "mixture_sweep"), (classify, "fit_logistic")):
        monkeypatch.setattr(module, name, record)
    monkeypatch.setattr(queries, "_audio_parts", lambda *a: None)
    monkeypatch.setattr(queries, "_doc_bundle", lambda *a: (None, 10_000))
    monkeypatch.setattr(features, "build_features", lambda *a, **k: (_ for _ in ()).throw(InterruptedError))
    monkeypatch.setattr(queries, "materialize", lambda df, name: df)
    names = ("boosted_trees_audio", "importance_by_gain", "mixture_sweep", "mixture_full", "kmeans_clusters",
             "kmeans_elbow", "kmeans_metrics", "cluster_scatter", "logistic_text", "top_words_by_coefficient")
    for name in names:
        with pytest.raises(InterruptedError):
            queries.QUERIES[name](spark, data_dir)
    assert len(seen) == len(names)
    assert all(set(kwargs) <= {"max_features"} for _, kwargs in seen)
    assert not any(isinstance(a, (range, tuple)) for args, _ in seen for a in args)


def test_random_search_tries_no_setting_twice(points):
    rows = cluster.as_ml(points, "x")
    rows = classify.label_encoder(rows, "genre").transform(rows).persist()
    tried = []

    def fit(train, label, **params):
        tried.append(tuple(sorted(params.items())))
        return classify.fit_logistic(train, "audio", label, maxIter=1, C=params["C"])

    found = classify.random_search(fit, rows, rows, {"C": (0.1, 1.0), "unused": (1, 2)}, trials=9).collect()
    assert len(found) == len(tried) == len(set(tried)) == 4
    assert [r["val_macro_f1"] for r in found] == sorted((r["val_macro_f1"] for r in found), reverse=True)


def test_sums_of_nearest_rows_against_brute_force():
    """The first of equally near centres has the row, as it would by argmin."""
    x = np.random.default_rng(1).normal(size=(300, 3))
    held = [(7, x[:2].copy()), (9, np.repeat(x[5:7], 2, axis=0))]
    for (i, flat), (name, centres) in zip(cluster._nearest_sums(x, held), held):
        gap = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        member = np.eye(len(centres))[gap.argmin(axis=1)]
        table = flat[:-1].reshape(len(centres), -1)
        assert i == name and table[:, 0].tolist() == member.sum(axis=0).tolist()
        assert table[:, 1:] == pytest.approx(member.T @ x) and flat[-1] == pytest.approx(gap.min(axis=1).sum())


def test_fits_of_many_sizes_equal_fits_of_one(points):
    """Fits that advance together do not influence each other, nor do partitions."""
    together = cluster.fit_kmeans_sizes(points, "x", (2, 3, 5), restarts=2)
    for k in (2, 5):
        alone = cluster.fit_kmeans(points.repartition(3), "x", k, restarts=2)
        assert alone.inertia == pytest.approx(together[k].inertia)
        assert alone.centres == pytest.approx(together[k].centres)
    x, _, _ = arrays(points)
    fit = together[3]
    gap = ((x[:, None] - fit.centres[None]) ** 2).sum(axis=2)
    assert fit.inertia == pytest.approx(gap.min(axis=1).sum())
    assert fit.centres == pytest.approx(np.array([x[gap.argmin(axis=1) == j].mean(axis=0) for j in range(3)]), abs=1e-3)


def test_mixtures_of_all_shapes_share_their_passes(points):
    """Each shape's likelihood grows with its freedom, and weights and moments are those of the rows."""
    specs = [(shape, 3) for shape in cluster.COVARIANCES]
    fits = dict(zip(cluster.COVARIANCES, cluster.fit_mixtures(points, "x", specs, restarts=2)))
    x, _, _ = arrays(points)
    for m in fits.values():
        assert m.weights.sum() == pytest.approx(1) and m.weights @ m.means == pytest.approx(x.mean(axis=0))
    assert fits["full"].log_likelihood >= fits["diag"].log_likelihood - 1e-3 >= fits["spherical"].log_likelihood - 2e-3
    alone = cluster.fit_mixture(points.repartition(2), "x", 3, "tied", restarts=2)
    assert alone.log_likelihood == pytest.approx(fits["tied"].log_likelihood)


def test_few_distinct_rows(spark):
    df = spark.createDataFrame([([1.0, 2.0],)] * 5 + [([3.0, 4.0],)] * 4, "x array<double>")
    fit = cluster.fit_kmeans(df, "x", 4, restarts=2)
    assert len(fit.centres) == 2 and fit.inertia == pytest.approx(0)
    with pytest.raises(ValueError):
        cluster.fit_kmeans(df.limit(0), "x", 2, restarts=1)


def test_logistic_gradient_vanishes_at_the_optimum(points):
    rows = cluster.as_ml(points, "x")
    rows = classify.label_encoder(rows, "genre").transform(rows)
    done, early = classify.fit_logistic(rows), classify.fit_logistic(rows, maxIter=1)
    assert max(r["largest"] for r in classify.logistic_gradient(done, rows).collect()) < 1e-4
    assert max(r["largest"] for r in classify.logistic_gradient(early, rows).collect()) > 1e-3


def test_distances_of_wide_rows_touch_their_entries_only(monkeypatch):
    """By Euclid too only query rows are written out, in few steps; pairs would be 10,000 numbers each."""
    rng = np.random.default_rng(3)
    width, n = 10_000, 60
    at = [np.sort(rng.choice(width, rng.integers(0, 30), replace=False)).astype(np.int32) for _ in range(n)]
    value = [rng.normal(size=len(i)) for i in at]
    value[4][:] = 0
    at[1], value[1] = at[0], value[0].copy()
    table = pa.table([pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64()))], names=["_i", "_v"])
    held, cells, filled = neighbours._Sparse(table, False), [], neighbours._filled
    monkeypatch.setattr(neighbours, "_filled", lambda shape, *rest: cells.append(shape[0]) or filled(shape, *rest))
    rows, cols = (x.ravel() for x in np.indices((n, n)))
    found = neighbours._pair_distances(held, held, rows, cols, width, "euclidean")
    dense = np.zeros((n, width))
    for i in range(n):
        dense[i, at[i]] = value[i]
    assert np.allclose(found, np.sqrt(((dense[rows] - dense[cols]) ** 2).sum(axis=1)), atol=1e-12)
    assert (found[rows == cols] == 0).all() and (found[cols == 0] == found[cols == 1]).all()
    # Every row once, not every pair twice.
    assert sum(cells) == n


def test_meetings_in_rounds_find_the_same(spark, monkeypatch):
    """What a round sends is bounded; its k best join those of the others."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(160):
        at = np.sort(rng.choice(1_500, 12, replace=False))
        rows.append((i, "ab"[i % 2], Vectors.sparse(1_500, at.tolist(), rng.random(12).tolist())))
    table = spark.createDataFrame(rows, ["id", "genre", "features"]).withColumn("features", F.unwrap_udt("features"))
    stored, queries_ = table.filter("id < 110"), table.filter("id >= 100")
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "MEETING_ROWS", 20)

    def found():
        kept = neighbours.nearest(stored, queries_, "features", "genre", "id", 3, "cosine").collect()
        return sorted((r["id"], round(r["distance"], 9), r["neighbour"], r["label"]) for r in kept)

    once, made, rounds = found(), [], neighbours._rounds
    monkeypatch.setattr(neighbours, "ROUND", 0)
    monkeypatch.setattr(neighbours, "ROUND_BYTES", 1)
    monkeypatch.setattr(neighbours, "_rounds", lambda *a: made.append(rounds(*a)) or made[-1])
    assert found() == once and len(made[0]) > 2
    x = np.array([r[2].toArray() for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    gap = 1 - x[100:] @ x[:110].T
    assert np.allclose([d for _, d, _, _ in once], np.sort(gap, axis=1)[:, :3].ravel(), atol=1e-8)


def test_rounds_send_what_they_may():
    visits = [{"_block": b, "bytes": 100} for b in (0, 0, 2, 3, 7)]
    more = neighbours.MEETING_BYTES
    assert neighbours._rounds(visits, [(0, 0), (2, 0), (3, 0), (7, 0)], 2 * more + 400) == [(0, 2), (3, 7)]
    assert neighbours._rounds(visits, [(0, 0), (2, 0), (3, 0), (7, 0)], 1) == [(0, 0), (2, 2), (3, 3), (7, 7)]
    assert neighbours._rounds([], [], 1) == []
