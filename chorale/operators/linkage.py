"""Fuzzy record linkage between two tables of (artist, title).

Score of two normalised titles, 0 to 100: the edit similarity, or 100 when the
words of the shorter title (two at least) all occur in the longer one. Only
rows with the same normalised primary artist are compared. Every left row gets
its best partner at or above the threshold; ties go to the closer spelling,
then to the lower right title, then to the lower right key.

Titles of one artist are never paired all against all:

* both sides shrink to distinct (artist, title) pairs, so copies cost nothing;
* equal titles are found by an equi-join, and those left titles are done;
* other candidates share a *signature*. For edit similarity t two strings of
  which the longer has n characters differ by at most floor((1-t)n) edits, and
  one edit destroys at most q of the q-grams. So in any fixed order of the
  q-grams the first few of both strings must meet (prefix filter). Strings too
  short for that bound use single characters, for which it holds at any
  positive threshold;
* for contained titles, the shorter one is looked up by its rarest word.

The filters are lossless: they only skip pairs that cannot reach the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions.arrays import numbered
from chorale.functions.text import normalize_artist, normalize_title
from chorale.session import materialize

FREQUENT = 256


def edit_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise(100 * (1 - F.levenshtein(a, b) / longest))


def _contained(a: Column, b: Column) -> Column:
    """The shorter word set has two words or more, all of them in the other."""

    def inside(x: Column, y: Column) -> Column:
        return (F.size(x) >= 2) & (F.size(x) <= F.size(y)) & (F.size(F.array_except(x, y)) == 0)

    return inside(a, b) | inside(b, a)


def title_words(title: Column) -> Column:
    return F.array_distinct(F.filter(F.split(title, " "), lambda w: w != ""))


def title_score(a: Column, b: Column) -> Column:
    return F.when(_contained(title_words(a), title_words(b)), 100.0).otherwise(edit_similarity(a, b))


def _gram_size(t: float) -> int:
    """Longest gram whose prefix filter still binds for titles of usual length."""
    return 3 if t >= 0.85 else 2 if t >= 0.7 else 1


def _grams(title: Column, q: int) -> Column:
    """The q-grams, the n-th copy of one marked with n so that bags compare."""
    last = F.length(title) - (q - 1)
    raw = F.when(
        last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(title, i, F.lit(q)))
    ).otherwise(F.array().cast("array<string>"))
    return numbered(raw)


def _frequent(df: DataFrame, items: Column) -> list[str]:
    """The most frequent items, most frequent first; never more than FREQUENT."""
    counted = df.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.filter(F.col("n") > 1).orderBy(F.desc("n"), "item").limit(FREQUENT).collect()
    return [r["item"] for r in rows]


def _rare_first(items: Column, frequent: Sequence[str]) -> Column:
    """Items in a fixed order that puts the frequent ones last."""
    common = F.array(*[F.lit(i) for i in frequent]).cast("array<string>")

    def key(x: Column) -> Column:
        # 0 for a rare item, else higher for more frequent ones.
        place = F.array_position(common, x)
        return F.struct(F.when(place == 0, 0).otherwise(len(frequent) + 1 - place).alias("k"), x.alias("x"))

    return F.transform(F.array_sort(F.transform(items, key)), lambda s: s["x"])


def _edit_signatures(title: Column, t: float, frequent: dict[int, list[str]]) -> Column:
    """Signatures at least one of which two titles at similarity t share."""
    n = F.length(title)
    q = _gram_size(t)
    # Grams two strings must share, from below, given the length of either one.
    common_chars = F.ceil(t * n - 1e-9)
    common_grams = F.ceil((1 - q * (1 - t)) * n - (q - 1) - 1e-9)
    short = 0 if q == 1 else math.ceil(q / (1 - q * (1 - t)))

    def prefix(size: int, common: Column) -> Column:
        grams = _rare_first(_grams(title, size), frequent[size])
        length = F.greatest(F.size(grams) - common + 1, F.lit(0)).cast("int")
        return F.transform(F.slice(grams, 1, length), lambda g: F.concat(F.lit(f"{size}:"), g))

    singles = prefix(1, common_chars)
    if q == 1:
        return singles
    none = F.array().cast("array<string>")
    # A title shorter than `short` may share no gram with its partner, whose
    # length is then at most short / t: both meet through single characters.
    by_gram = F.when((n >= short) & (common_grams >= 1), prefix(q, common_grams)).otherwise(none)
    by_char = F.when(n <= short / t + 1, singles).otherwise(none)
    return F.concat(by_gram, by_char)


class DatasetMatcher:
    """Link two tables on artist (exact after normalising) and title (fuzzy)."""

    def __init__(self, threshold: float = 87) -> None:
        if not 0 < threshold <= 100:
            raise ValueError("threshold must be in (0, 100]")
        self.threshold = threshold

    normalize_title = staticmethod(normalize_title)
    normalize_artist = staticmethod(normalize_artist)

    def match(
        self,
        left: DataFrame,
        right: DataFrame,
        left_keys: tuple[str, str],
        right_keys: tuple[str, str],
        left_id: str,
        right_id: str,
    ) -> DataFrame:
        """(left_id, right_id, left_title, right_title, match_score)."""
        lhs = self._normalised(left, left_keys, left_id)
        rhs = self._normalised(right, right_keys, right_id)
        # Both are read several times below; stored, they are normalised once.
        left_titles = materialize(lhs.select("artist", F.col("title").alias("lt")).distinct(), "titles")
        right_titles = materialize(
            rhs.groupBy("artist", F.col("title").alias("rt")).agg(F.min("id").alias("rid")), "titles"
        )

        equal = left_titles.join(
            right_titles.withColumn("lt", F.col("rt")), ["artist", "lt"]
        ).select("artist", "lt", "rt", "rid", F.lit(100.0).alias("match_score"))
        open_left = left_titles.join(
            right_titles.select("artist", F.col("rt").alias("lt")), ["artist", "lt"], "left_anti"
        )
        best = equal.unionByName(self._best_unequal(open_left, right_titles))
        return (
            lhs.withColumnRenamed("title", "lt")
            .join(best, ["artist", "lt"])
            .select(
                F.col("id").alias("left_id"),
                F.col("rid").alias("right_id"),
                F.col("lt").alias("left_title"),
                F.col("rt").alias("right_title"),
                "match_score",
            )
        )

    @staticmethod
    def _normalised(df: DataFrame, keys: tuple[str, str], row_id: str) -> DataFrame:
        artist, title = keys
        return df.select(
            F.col(row_id).alias("id"),
            normalize_artist(F.col(artist), primary_only=True).alias("artist"),
            normalize_title(F.col(title)).alias("title"),
        ).filter((F.col("artist") != "") & (F.col("title") != ""))

    def _best_unequal(self, left: DataFrame, right: DataFrame) -> DataFrame:
        t = self.threshold / 100
        lt, rt = F.col("lt"), F.col("rt")
        n_left, n_right = F.length(lt), F.length(rt)
        frequent = {q: _frequent(right, _grams(rt, q)) for q in {1, _gram_size(t)}}
        near = (
            left.withColumn("sig", F.explode(_edit_signatures(lt, t, frequent)))
            .join(right.withColumn("sig", F.explode(_edit_signatures(rt, t, frequent))), ["artist", "sig"])
            .filter(F.least(n_left, n_right) >= t * F.greatest(n_left, n_right) - 1e-9)
            .drop("sig")
        )
        heavy = _frequent(right, title_words(rt))
        inside = self._word_lookup(left, "lt", right, "rt", heavy).unionByName(
            self._word_lookup(right, "rt", left, "lt", heavy)
        )
        scored = (
            near.unionByName(inside)
            .withColumn("match_score", title_score(lt, rt))
            .filter(F.col("match_score") >= self.threshold)
        )
        # Lowest struct wins; a pair found twice changes nothing.
        rank = F.struct(
            (-F.col("match_score")).alias("s"), (-edit_similarity(lt, rt)).alias("e"), rt.alias("rt"), "rid"
        )
        return (
            scored.groupBy("artist", "lt")
            .agg(F.min(rank).alias("b"))
            .select("artist", "lt", F.col("b.rt"), F.col("b.rid"), (-F.col("b.s")).alias("match_score"))
        )

    @staticmethod
    def _word_lookup(short: DataFrame, s: str, long: DataFrame, g: str, heavy: list[str]) -> DataFrame:
        """Pairs where the rarest word of ``short`` occurs in ``long``."""
        words = title_words(F.col(s))
        rarest = F.when(F.size(words) >= 2, F.try_element_at(_rare_first(words, heavy), F.lit(1)))
        probe = short.withColumn("word", rarest).filter(F.col("word").isNotNull())
        table = long.withColumn("word", F.explode(title_words(F.col(g))))
        return (
            probe.join(table, ["artist", "word"])
            .filter(_contained(title_words(F.col(s)), title_words(F.col(g))))
            .select("artist", "lt", "rt", "rid")
        )


def match_quality_report(matches: DataFrame) -> DataFrame:
    """(band, n, pct): matches per score band, 5 points wide."""
    low = F.least(F.floor(F.col("match_score") / 5) * 5, F.lit(95)).cast("int")
    from chorale.operators.profile import distribution_report

    return distribution_report(matches.select(low.alias("band")), "band")
