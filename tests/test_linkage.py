"""Fuzzy linkage against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chorale.operators.linkage import DatasetMatcher, match_quality_report


def link(left, right, threshold):
    return DatasetMatcher(threshold).match(left, right, ("artist", "title"), ("artists", "track_name"), "id", "id")


def test_fixture_pairs(songs, tracks):
    out = link(songs, tracks, 80).collect()
    assert {(r["left_id"], r["right_id"]) for r in out} == {(1, 11), (2, 12), (3, 13)}
    assert all(r["match_score"] >= 80 for r in out)


def test_stricter_thresholds_never_add_rows(songs, tracks):
    found = [{(r["left_id"], r["right_id"]) for r in link(songs, tracks, t).collect()} for t in (10, 70, 87, 99)]
    assert all(a >= b for a, b in zip(found, found[1:]))


def test_no_common_artist(songs, tracks):
    other = tracks.withColumn("artists", F.lit("Somebody Else"))
    assert link(songs, other, 50).count() == 0


def test_report(songs, tracks):
    report = match_quality_report(link(songs, tracks, 80)).collect()
    assert [(r["band"], r["n"], r["pct"]) for r in report] == [(95, 3, 100.0)]


def test_threshold_range():
    with pytest.raises(ValueError):
        DatasetMatcher(0)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(left, right, threshold):
    best = {}
    for li, la, lt in left:
        for ri, ra, rt in right:
            if la != ra:
                continue
            sim = 100 * (1 - distance(lt, rt) / max(len(lt), len(rt)))
            a, b = set(lt.split()), set(rt.split())
            short, long = sorted((a, b), key=len)
            score = 100.0 if len(short) >= 2 and short <= long else sim
            if score >= threshold:
                best[li] = min(best.get(li, (1, 1, "", 0)), (-score, -sim, rt, ri))
    return {li: (ri, round(-s, 9)) for li, (s, _, _, ri) in best.items()}


@pytest.mark.parametrize("threshold", [30, 60, 75, 87, 95])
def test_nothing_is_missed(spark, threshold):
    draw = random.Random(threshold)
    words = ["ab", "abc", "b", "lovely", "lonely", "night", "nights", "a1", "road", "rode"]

    def title():
        text = " ".join(draw.choice(words) for _ in range(draw.randint(1, 4)))
        for _ in range(draw.randint(0, 2)):
            at = draw.randrange(len(text))
            text = text[:at] + draw.choice("abx") + text[at + draw.randint(0, 1):]
        return " ".join(text.split())

    left = [(i, draw.choice("pq"), title()) for i in range(80)]
    right = [(i, draw.choice("pq"), title()) for i in range(100, 180)]
    got = link(
        spark.createDataFrame(left, "id int, artist string, title string"),
        spark.createDataFrame(right, "id int, artists string, track_name string"),
        threshold,
    ).collect()
    assert {r["left_id"]: (r["right_id"], round(r["match_score"], 9)) for r in got} == brute(left, right, threshold)
