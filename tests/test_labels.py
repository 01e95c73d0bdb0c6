"""Label maps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chorale.api import GenreMapper
from chorale.functions import labels as lb

CATALOGUE = {
    "pop": "pop", "dance pop": "pop", "synth-pop": "pop", "electropop": "pop",
    "hip hop": "hip-hop", "rap": "hip-hop", "trap": "hip-hop", "conscious hip hop": "hip-hop",
    "pop rap": "hip-hop", "emo rap": "hip-hop", "therapy": "hip-hop",
    "r&b": "r&b", "neo soul": "r&b", "contemporary r&b": "r&b", "pop soul": "r&b",
    "country": "country", "country pop": "country", "country rap": "country",
    "electronic": "electronic", "edm": "electronic", "dubstep": "electronic", "deep house": "electronic",
    "uk garage": "electronic", "garage rock": "rock", "rock": "rock", "indie rock": "rock", "metal": "rock",
    "pop rock": "rock", "demo": "rock", " Dance POP ": "pop",
    "classical": None, "jazz": None, "comedy": None, "": None, None: None,
}
TAGS = {"pop": "pop", "rap": "hip-hop", "rb": "r&b", " R-B": "r&b", "rock": "rock", "country": "country",
        "misc": None, "": None, None: None}


@pytest.mark.parametrize("mapper, cases", [(lb.map_by_substring, CATALOGUE), (lb.map_by_tag, TAGS)])
def test_maps(spark, mapper, cases):
    rows = spark.createDataFrame(list(cases.items()), "raw string, want string")
    wrong = rows.withColumn("got", mapper(F.col("raw"))).filter(~F.col("got").eqNullSafe(F.col("want")))
    assert wrong.collect() == []


def test_empty_map(spark):
    assert spark.range(1).select(lb.map_by_tag(F.lit("x"), {})).first()[0] is None


def test_first_mapped(spark):
    rows = spark.createDataFrame([(["jazz", " Indie Rock", "pop"],), (["jazz"],), ([],), (None,)], "g array<string>")
    assert [r[0] for r in rows.select(lb.first_mapped(F.col("g"))).collect()] == ["Indie Rock", None, None, None]


def test_reconcile(spark):
    rows = spark.createDataFrame([("pop", "rock"), (None, "rock"), ("pop", None), (None, None)], "a string, b string")
    got = [r[0] for r in rows.select(lb.reconcile(F.col("a"), F.col("b"))).collect()]
    assert got == ["pop", "rock", "pop", None]


def test_annotate(spark):
    rows = spark.createDataFrame([("pop",), ("rap",), ("classical",), ("hip hop",)], "track_genre string")
    mapper = GenreMapper()
    kept = mapper.annotate(rows, "track_genre", drop_unmapped=False)
    assert [r["genre"] for r in kept.collect()] == ["pop", "hip-hop", None, "hip-hop"]
    assert mapper.annotate(rows, "track_genre").count() == 3
    with pytest.raises(ValueError):
        mapper.annotate(rows, "track_genre", source="other")


def test_distribution_report(spark):
    rows = spark.createDataFrame([("pop",), ("pop",), ("rock",), (None,)], "genre string")
    report = {r["genre"]: (r["n"], r["pct"]) for r in GenreMapper.distribution_report(rows).collect()}
    assert report == {"pop": (2, 50.0), "rock": (1, 25.0), None: (1, 25.0)}
