"""Balancing, deduplication, splits and exact quantiles."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.api import ClassBalancer, DataSplitter
from chorale.operators import quantiles, sampling


def rank(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    """6,000 rows; one class and one group of copies hold most of them."""
    label = F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small")
    title = F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string"))
    return spark.range(6000).select("id", label.alias("genre"), title.alias("title"))


def test_balance_takes_lowest_digests(rows):
    kept = sampling.balance(rows, "genre", ["id"], samples_per_class=700)
    got = {r["id"] for r in kept.collect()}
    want = set()
    by_class = {}
    for r in rows.collect():
        by_class.setdefault(r["genre"], []).append(r["id"])
    for ids in by_class.values():
        want |= set(sorted(ids, key=rank)[:700])
    assert got == want
    assert Counter(r["genre"] for r in kept.collect()) == {"big": 700, "mid": 700, "small": 600}


def test_balance_strategies(rows):
    cap = ClassBalancer(["id"], "cap", 500)
    assert cap.balance(rows).count() == 1500
    none = ClassBalancer(["id"], "none")
    assert none.balance(rows, target_classes=("big", "small")).count() == 4800
    assert {r["genre"] for r in cap.starved(rows).collect()} == set()
    assert {r["genre"] for r in ClassBalancer(["id"], "cap", 500, 1000).starved(rows).collect()} == {"small"}
    with pytest.raises(ValueError):
        ClassBalancer(["id"], "half")
    with pytest.raises(ValueError):
        sampling.balance(rows, "genre", ["id"], "half")


def test_null_labels_vanish(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, genre string")
    assert [r["id"] for r in sampling.balance(df, "genre", ["id"]).collect()] == [1]


@pytest.mark.parametrize("pieces", [1, 17])
def test_partitioning_does_not_matter(rows, pieces):
    df = rows.repartition(pieces)
    assert sorted(r["id"] for r in sampling.sample_exact(df, 50, ["id"]).collect()) == sorted(
        sorted(range(6000), key=rank)[:50]
    )
    first = sorted(r["id"] for r in sampling.dedupe(df, ["title"], ["id"]).collect())
    copies = min((i for i in range(0, 6000, 3)), key=rank)
    assert first == sorted([i for i in range(6000) if i % 3] + [copies])
    split = sampling.stratified_split(df, "genre", ["id"])
    digest = sorted((r["id"], r["split"]) for r in split.collect())
    assert hashlib.md5(str(digest).encode()).hexdigest() == hashlib.md5(
        str(sorted((r["id"], r["split"]) for r in sampling.stratified_split(rows, "genre", ["id"]).collect())).encode()
    ).hexdigest()


def test_sample_larger_than_table(rows):
    assert sampling.sample_exact(rows, 10_000, ["id"]).count() == 6000


def test_nulls_are_equal_when_deduplicating(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "-", "x"), (4, "", "x")], "id int, a string, b string")
    assert sampling.dedupe(df, ["a", "b"], ["id"]).count() == 3
    assert sampling.dedupe(df, ["missing"], ["id"]).count() == 4


def test_split_is_exact_and_disjoint(rows):
    train, val, test = DataSplitter(["id"]).split(rows, dedupe_on=("artist", "title"))
    ids = [sorted(r["id"] for r in part.collect()) for part in (train, val, test)]
    assert [len(x) for x in ids] == [2800, 600, 601]
    assert len(set(ids[0]) | set(ids[1]) | set(ids[2])) == 4001


def test_quotas_of_the_published_audio_split():
    counts = {"country": 3956, "electronic": 3996, "hip-hop": 3998, "pop": 3994, "r&b": 3969, "rock": 3997}
    quotas = sampling.split_quotas(counts, 0.15, 0.15)
    assert [sum(q[i] for q in quotas.values()) for i in range(3)] == [16736, 3587, 3587]
    assert {c: q[0] for c, q in quotas.items()} == {
        "hip-hop": 2798, "rock": 2797, "electronic": 2797, "pop": 2796, "r&b": 2779, "country": 2769,
    }
    assert {c: q[1] for c, q in quotas.items()} == {
        "hip-hop": 600, "rock": 600, "electronic": 599, "pop": 599, "r&b": 595, "country": 594,
    }


def test_split_arguments(rows):
    for sizes in ({"test_size": 0}, {"test_size": 1}, {"val_size": -0.1}, {"val_size": 1}):
        with pytest.raises(ValueError):
            DataSplitter(["id"], **sizes)
    with pytest.raises(ValueError):
        sampling.split_quotas({"a": 100, "b": 1}, 0.15, 0.15)
    with pytest.raises(ValueError):
        sampling.split_quotas({c: 2 for c in "abcdefghij"}, 0.05, 0.05)
    no_val = sampling.stratified_split(rows, "genre", ["id"], val_size=0)
    assert {r["split"] for r in no_val.select("split").distinct().collect()} == {"train", "test"}


def test_first_per_group(rows):
    kept = sampling.first_per_group(rows, "genre", ["id"], 5, ["id"], lanes=4)
    assert sorted(r["id"] for r in kept.filter("genre = 'big'").collect()) == [0, 1, 2, 3, 4]
    assert kept.count() == 15


def test_first_n(rows):
    assert sorted(r["id"] for r in sampling.first_n(rows, 321, "id").collect()) == list(range(321))
    assert sampling.first_n(rows, 10**6, "id").count() == 6000


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_exact_quantiles(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "_MARGIN", 3 / accuracy)
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=3000) ** 3, np.full(1500, 0.25)])
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("g", None)], "g string, x double")
    rows = quantiles.exact_quantiles(df, "g", ["x"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()
    got = {r["prob"]: r["value"] for r in rows}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 50.0]
    df = spark.createDataFrame([("g", v) for v in values], "g string, x double")
    row = quantiles.box_stats(df, "g", ["x"]).first()
    assert (row["q1"], row["median"], row["q3"]) == (2.75, 4.5, 6.25)
    assert (row["whisker_low"], row["whisker_high"]) == (1.0, 7.0)


def test_many_classes_and_the_shuffled_fallback(spark, monkeypatch):
    df = spark.range(2000).select("id", (F.col("id") % 80).cast("string").alias("genre"))
    want = sorted((r["id"], r["split"]) for r in sampling.stratified_split(df, "genre", ["id"]).collect())
    assert len(want) == 2000
    kept = Counter(r["genre"] for r in sampling.balance(df, "genre", ["id"], samples_per_class=10).collect())
    assert set(kept.values()) == {10} and len(kept) == 80
    monkeypatch.setattr(sampling, "small_side", lambda side: side)
    again = sorted((r["id"], r["split"]) for r in sampling.stratified_split(df, "genre", ["id"]).collect())
    assert again == want


def test_no_rows_and_negative_numbers(spark):
    rows = spark.range(100).withColumn("c", F.col("id") % 3)
    assert sampling.sample_exact(rows, 0, ["id"]).count() == 0
    assert sampling.first_n(rows, 0, "id").count() == 0
    assert sampling.balance(rows, "c", ["id"], samples_per_class=0).count() == 0
    for call in (lambda: sampling.sample_exact(rows, -1, ["id"]), lambda: sampling.first_n(rows, -1, "id"), lambda: sampling.balance(rows, "c", ["id"], samples_per_class=-1)):
        with pytest.raises(ValueError):
            call()


def test_null_labels(spark):
    """A null class is cut as others are; a split by a label that rows lack is refused."""
    rows = spark.range(90).withColumn("c", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    kept = sampling.take_per_class(rows, F.col("c"), ["id"], 7, 1)
    assert {r["c"]: r["count"] for r in kept.groupBy("c").count().collect()} == {None: 7, 1: 7, 2: 7}
    with pytest.raises(ValueError, match="30 rows"):
        sampling.stratified_split(rows, "c", ["id"])


def test_first_rows_of_equal_keys(spark):
    rows = spark.createDataFrame([(k,) for k in (1, 2, 2, 2, 3)], "id long")
    for n in range(6):
        assert sorted(r.id for r in sampling.first_n(rows, n, "id").collect()) == [1, 2, 2, 2, 3][:n]


def test_quotas_of_many_classes():
    counts = {i: 6 + i % 5 for i in range(20_000)}
    quotas = sampling.split_quotas(counts, 0.4, 0.3)
    assert all(sum(quotas[c]) == n for c, n in counts.items())


@pytest.mark.parametrize("spoil", ["low", "high", "wide"])
def test_quantiles_survive_a_bad_sketch(spark, monkeypatch, spoil):
    """Brackets that miss their position, or hold far too much, are found out by counting."""
    rng = np.random.default_rng(3)
    rows = [("ab"[i % 2], float(x), int(1000 * x)) for i, x in enumerate(rng.lognormal(size=3000))] + [("a", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y long")
    inner = quantiles._brackets

    def bad(*args):
        b = inner(*args)
        if spoil == "wide":
            return b.withColumns({"lo": F.col("min"), "hi": F.col("max")})
        edge = F.col("min") if spoil == "low" else F.col("max")
        return b.withColumns({"lo": edge, "hi": edge})

    monkeypatch.setattr(quantiles, "_brackets", bad)
    monkeypatch.setattr(quantiles, "WIDE", 100)
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {(r.g, r.column, r.prob): (r.n, r.value) for r in quantiles.exact_quantiles(df, "g", ["x", "y"], probs).collect()}
    for g in "ab":
        for column, at in (("x", 1), ("y", 2)):
            own = [r[at] for r in rows if r[0] == g and r[at] is not None]
            for p in probs:
                assert got[g, column, p] == (len(own), pytest.approx(float(np.quantile(own, p))))
