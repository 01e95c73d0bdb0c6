"""Sources, sinks, whole builds, the gate and the stream."""

from __future__ import annotations

import dataclasses
import json
import random

import pytest
from pyspark.sql import functions as F

from chorale.api import FeatureEngineer, Pipeline
from chorale.config import AUDIO_FEATURES, ROWS_PER_CLASS
from chorale.operators import catalogue, guards, profile
from chorale.operators.catalogue import CatalogueTables
from chorale.plans import build, evaluate, queries
from chorale.plans.sample_tables import catalogue_tables, lyrics_table
from chorale.sources import readers, sinks
from chorale.streaming.ingest import ingest_lyrics, lyrics_stream

LYRICS = build.Choices(per_class=25, languages=("en", "fr", "de", "es"), words=(5, 2000))


def test_catalogue_join(spark):
    tables = CatalogueTables(
        spark.createDataFrame(
            [("t1", "One", "50", 1, 0), ("t2", "Two", "5", 1, 0), ("t3", "Three", "x", 1, 0), ("t4", "Four", "10", 1, 1)],
            "id string, name string, popularity string, duration long, explicit int",
        ),
        spark.createDataFrame([(t, *[0.5] * 9) for t in ("t1", "t2", "t3", "t4")],
                              "id string, " + ", ".join(f"{c} double" for c in AUDIO_FEATURES)),
        spark.createDataFrame([("t1", "a"), ("t1", "b"), ("t1", "c"), ("t4", "c")], "track_id string, artist_id string"),
        spark.createDataFrame([("a", "Zed"), ("b", "Bob"), ("c", "Abe")], "id string, name string"),
        spark.createDataFrame([("a", "jazz"), ("a", "trap"), ("b", "indie rock"), ("b", "trap")], "artist_id string, genre_id string"),
    )
    rows = readers.load_catalogue(tables).collect()
    # Abe has no genre, so he counts neither as an artist nor for track four.
    assert [(r["track_id"], r["artists"], r["track_genre"], r["popularity"]) for r in rows] == [
        ("t1", "Bob", "indie rock", 50)
    ]


def test_catalogue_folds_numbers(spark, monkeypatch):
    """Few genres are folded as bits, and names by their place: no lists are gathered by track, and rows are as from lists."""
    rng = random.Random(8)
    names = [None, "Zoë", "Bob", "Bob", "Äbe", "abe", "Abe", ""] + [f"n{i % 9}" for i in range(40)]
    tracks = [(f"t{i}", f"n{i}", "20", i, 0) for i in range(60)]
    tables = CatalogueTables(
        spark.createDataFrame(tracks, "id string, name string, popularity string, duration long, explicit int"),
        spark.createDataFrame([(t[0], *[0.5] * 9) for t in tracks], "id string, " + ", ".join(f"{c} double" for c in AUDIO_FEATURES)),
        spark.createDataFrame([(rng.choice(tracks)[0], rng.randrange(50)) for _ in range(150)], "track_id string, artist_id int"),
        spark.createDataFrame([*enumerate(names), (2, "A second name")], "id int, name string"),
        spark.createDataFrame(
            [(rng.randrange(50), rng.choice([None, *(f"g{i}" for i in range(catalogue.MASKED_GENRES))])) for _ in range(200)],
            "artist_id int, genre_id string",
        ),
    )
    masked = catalogue.join_catalogue(tables)
    assert "collect_set" not in masked._jdf.queryExecution().optimizedPlan().toString()
    found = sorted(masked.collect())
    monkeypatch.setattr(catalogue, "MASKED_GENRES", 3)
    listed = catalogue.join_catalogue(tables)
    assert "collect_set" in listed._jdf.queryExecution().optimizedPlan().toString()
    assert found == sorted(listed.collect()) and len(found) > 30


def test_cached_join_is_read_back(spark, data_dir, tmp_path):
    tables = catalogue_tables(spark, data_dir)
    first = readers.load_catalogue(tables, cache_dir=str(tmp_path)).count()
    assert (tmp_path / "catalogue_pop10.parquet").exists()
    empty = CatalogueTables(*[t.limit(0) for t in (tables.tracks, tables.audio_features, tables.track_artists, tables.artists, tables.artist_genres)])
    assert readers.load_catalogue(empty, cache_dir=str(tmp_path)).count() == first
    assert readers.load_catalogue(empty, 11, cache_dir=str(tmp_path)).count() == 0


def test_lyrics_csv(spark, tmp_path):
    path = tmp_path / "lyrics.csv"
    header = "title,tag,artist,year,views,features,lyrics,id,language_cld3,language_ft,language\n"
    path.write_text(header + 'NA,pop,A,2001,5,,"line ""one""\nline two",7,en,en,en\nB,rap,C,x,,,text,8,en,en,en\n')
    rows = readers.load_lyrics(spark, str(path)).orderBy("id").collect()
    assert rows[0]["title"] == "NA" and rows[0]["lyrics"] == 'line "one"\nline two'
    assert (rows[0]["year"], rows[1]["year"]) == (2001, None)
    assert readers.load_lyrics(spark, str(path), nrows=1).first()["id"] == 7
    with pytest.raises(ValueError):
        readers.read_table(spark, "lyrics.xlsx")
    with pytest.raises(ValueError):
        guards.require_columns(spark.range(1), ["title"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(" x ", 1)], "a string, b int")
    sinks.write_csv(df, str(tmp_path / "t.csv"))
    assert spark.read.csv(str(tmp_path / "t.csv"), header=True).first()["a"] == " x "
    sinks.write_table(df, str(tmp_path / "t.parquet"))
    assert readers.read_table(spark, str(tmp_path / "t.parquet")).count() == 1


def test_audio_run(spark, data_dir, tmp_path):
    config = build.Choices(per_class=60)
    meta = Pipeline(config).run_all(str(tmp_path), "audio", tables=catalogue_tables(spark, data_dir))
    counts = meta["row_counts"]
    full, parts = spark.read.parquet(f"{tmp_path}/full"), spark.read.parquet(f"{tmp_path}/splits")
    assert counts["full"] == full.count() >= parts.count() == sum(counts[s] for s in ("train", "val", "test"))
    assert json.loads("\n".join(r[0] for r in spark.read.text(f"{tmp_path}/metadata").collect()))["mode"] == "audio"
    assert sum(meta["class_distribution"]["train"].values()) == counts["train"]
    assert meta["starved_classes"] and all(0 < n < build.FEW_ROWS for n in meta["starved_classes"].values())
    lost = guards.dataset_report(spark, f"{tmp_path}/nowhere", guards.AUDIO_GATE).collect()
    assert [(r["split"], r["status"]) for r in lost] == [(p, "fail") for p in guards.PARTS]
    whole = guards.dataset_report(spark, str(tmp_path), guards.AUDIO_GATE, min_per_class=1)
    assert whole.filter("check = 'part_present'").count() == 0 and whole.count() >= 15
    report = guards.quality_report(full, parts, guards.AUDIO_GATE, min_per_class=1)
    leaks = report.filter("check = 'leakage'").collect()
    assert len(leaks) == 3 and {r["status"] for r in leaks} == {"pass"}
    assert guards.gate_passed(report.filter("check <> 'classes_present'"))
    scored, _ = evaluate.predict_splits(parts, "knn", "audio", "track_id", k=5)
    assert {r["split"] for r in evaluate.supervised_metrics(scored).collect()} == {"val", "test"}
    clustered, fit = evaluate.cluster_table(full, "gmm", "audio", "track_id", k=2, restarts=1, max_iter=3)
    assert fit.count() == 1
    assert evaluate.cluster_metrics(clustered, "track_id").first()["n_clusters"] <= 2
    assert evaluate.projection_2d(clustered, "track_id").count() == full.count()
    with pytest.raises(ValueError):
        Pipeline().run_all(str(tmp_path), "video")


def test_lyrics_build_and_gate(spark, data_dir):
    data = build.build_lyrics(lyrics_table(spark, data_dir), LYRICS)
    assert {"lyr_word_count", "lyrics_clean", "word_count"} <= set(data.full.columns)
    assert data.full.groupBy("genre").count().agg(F.max("count")).first()[0] <= 25
    assert data.full.filter("word_count not between 5 and 2000").count() == 0
    assert data.full.filter(F.col("lyrics_clean").rlike("Contributors|You might|Embed$|Produced by")).count() == 0
    report = guards.quality_report(data.full, data.parts, guards.LYRICS_GATE, min_per_class=1)
    failed = report.filter("status = 'fail'").collect()
    assert {r["check"] for r in failed} == {"classes_present"}
    assert {r["detail"] for r in failed if r["split"] == "full"} == {"country,electronic"}
    assert not guards.gate_passed(report)


def test_features_do_not_depend_on_order(spark, data_dir):
    """Balancing before featurising gives the rows of the other order."""
    lyrics = lyrics_table(spark, data_dir)
    everything = FeatureEngineer().lyric_features(build.cleaned_lyrics(build.labelled_lyrics(lyrics, LYRICS), LYRICS))
    full = build.build_lyrics(lyrics, LYRICS).full
    assert full.select(everything.columns).exceptAll(everything).count() == 0


def test_none_strategy(spark, data_dir):
    config = dataclasses.replace(LYRICS, per_class=None)
    lyrics = lyrics_table(spark, data_dir)
    kept = build.cleaned_lyrics(build.labelled_lyrics(lyrics, config), config)
    assert build.build_lyrics(lyrics, config).full.count() == kept.count()


def test_early_filter_keeps_null_tags(spark):
    df = spark.createDataFrame([("en", None), ("en", "misc"), ("fr", "pop"), (None, "pop")], "language string, tag string")
    assert [r["tag"] for r in build.early_filter(df, ("en",)).collect()] == [None]


def test_null_guard(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    guards.assert_no_nulls(df, ["a"])
    with pytest.raises(ValueError, match="b"):
        guards.assert_no_nulls(df, ["a", "b"])


def test_case_variants_are_a_leak(spark):
    df = spark.createDataFrame([("A", "x", "train"), ("a", "X", "test"), ("b", "y", "val")], "artist string, title string, split string")
    shared = {(r[0], r[1]): r[2] for r in guards.split_overlaps(df, ["artist", "title"]).collect()}
    assert shared == {("train", "val"): 0, ("train", "test"): 1, ("val", "test"): 0}


def test_correlation_skips_null_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "a double, b double")
    rows = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert rows["a", "b"] == pytest.approx(1.0) and len(rows) == 4


def test_stream_equals_batch(spark, data_dir, tmp_path):
    lyrics = lyrics_table(spark, data_dir)
    columns = [f.name for f in readers.LYRICS_SCHEMA.fields]
    padded = lyrics.select(
        *[F.col(c) if c in lyrics.columns else F.lit(None).cast(readers.LYRICS_SCHEMA[c].dataType).alias(c) for c in columns]
    )
    padded.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lyrics_stream(spark, str(tmp_path / "in"), files_per_chunk=1)
    query = ingest_lyrics(stream, str(tmp_path / "out"), str(tmp_path / "state"), LYRICS)
    query.awaitTermination(120)
    batch = build.cleaned_lyrics(build.labelled_lyrics(padded, LYRICS), LYRICS)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert streamed.count() == batch.count() > 0
    assert streamed.select("id", "lyrics_clean").exceptAll(batch.select("id", "lyrics_clean")).count() == 0


def test_a_chunk_has_files_for_all_cores(spark, data_dir, tmp_path, monkeypatch):
    """Chunks of a few files leave most cores idle, whatever the folder's size."""
    files = spark.sparkContext.defaultParallelism + 1
    lyrics = lyrics_table(spark, data_dir)
    lyrics.repartition(files).write.parquet(str(tmp_path / "in"))
    started = []

    def ingest(stream, *rest):
        started.append(ingest_lyrics(stream, *rest))
        return started[-1]

    ingest(lyrics_stream(spark, str(tmp_path / "in"), schema=lyrics.schema), str(tmp_path / "out"), str(tmp_path / "state"), LYRICS).awaitTermination()
    monkeypatch.setattr(queries, "ingest_lyrics", ingest)
    queries.QUERIES["chunked_ingest"](spark, data_dir)
    assert [sum(p["numInputRows"] > 0 for p in q.recentProgress) for q in started] == [1, 1, 1]


def test_model_queries_use_the_default_build(spark, data_dir, monkeypatch):
    """Audio models see ROWS_PER_CLASS rows a class, not those of a smaller build."""
    seen = []

    def build_audio(tables, choices=None):
        seen.append(choices)
        raise InterruptedError

    monkeypatch.setattr(build, "build_audio", build_audio)
    for name in ("logistic_audio", "knn_audio", "boosted_trees_audio", "random_search", "importance_by_coefficient",
                 "importance_by_gain", "kmeans_metrics", "mixture_full"):
        with pytest.raises(InterruptedError):
            queries.QUERIES[name](spark, data_dir)
    assert len(seen) == 8 and all(c.per_class == ROWS_PER_CLASS for c in seen)
