"""Label normalisation: substring taxonomy, exact tags, reconciliation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from chorale.config import CATALOGUE_PATTERNS, TAG_LABELS
from chorale.functions.text import strip


def by_length(patterns: Mapping[str, Iterable[str]]) -> list[tuple[str, str]]:
    """(pattern, label) pairs, longest pattern first, ties in config order."""
    pairs = [(p.lower(), label) for label, group in patterns.items() for p in group]
    return sorted(pairs, key=lambda pair: len(pair[0]), reverse=True)


def map_by_substring(
    raw: Column, patterns: Mapping[str, Iterable[str]] = CATALOGUE_PATTERNS
) -> Column:
    """Label of the first pattern contained in the value, else null.

    One CASE chain: a few dozen byte searches inside generated code.
    """
    value = strip(F.lower(raw))
    chain = F
    for pattern, label in by_length(patterns):
        chain = chain.when(value.contains(pattern), label)
    return chain.otherwise(None) if chain is not F else F.lit(None).cast("string")


def map_by_tag(raw: Column, tags: Mapping[str, str] = TAG_LABELS) -> Column:
    """Label of the whole tag, else null."""
    value = strip(F.lower(raw))
    chain = F
    for tag, label in tags.items():
        chain = chain.when(value == tag, label)
    return chain.otherwise(None) if chain is not F else F.lit(None).cast("string")


def first_mapped(
    raw_labels: Column, patterns: Mapping[str, Iterable[str]] = CATALOGUE_PATTERNS
) -> Column:
    """First entry of an array that maps to any label, as written."""
    any_pattern = "|".join(
        rf"\Q{p.lower()}\E" for group in patterns.values() for p in group
    )
    hits = F.filter(raw_labels, lambda g: F.lower(g).rlike(any_pattern))
    return strip(F.try_element_at(hits, F.lit(1)))


def reconcile(catalogue_label: Column, lyrics_label: Column) -> Column:
    """The catalogue's label where there is one, else the lyrics source's."""
    return F.coalesce(catalogue_label, lyrics_label)
