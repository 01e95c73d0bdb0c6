"""Queries against their SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


# Builds and linkage have their own tests; these are the one-step operators.
SLOW = {
    "audio_build", "lyrics_build", "dataset_sink", "quality_gate", "fuzzy_link", "fuzzy_link_report",
    "catalogue_scan", "lyrics_csv_scan", "mixture_one_component", "tfidf_weights", "term_counts",
}


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, con, data_dir, name):
    assert compare(spark, con, data_dir, name).startswith("ok")


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["split", "lang", "n", "words"]
    assert frame.count() > 0
