"""Language detection from character trigrams counted exactly per language.

Fitting is one pass that counts trigrams and one grouped sum; the model is a
table with a row for each trigram seen in training. Texts are scored by naive
Bayes. A model of bounded size is copied to tasks and texts are scored where
they are; a larger one is joined to the trigrams of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.operators.sampling import class_totals
from chorale.session import materialize

MIN_CHARS_FOR_DETECTION = 30
# Numbers of a model that tasks may hold a copy of (32 MB), and characters worked on at once.
HELD_CELLS, SLICE = 4_000_000, 1 << 20


def _trigrams(text: str) -> Iterator[np.ndarray]:
    """Three code points as one number, A-Z lower-cased, slice by slice."""
    for at in range(0, max(len(text) - 2, 0), SLICE):
        c = np.frombuffer(text[at : at + SLICE + 2].encode("utf-32-le"), "<u4").astype(np.int64)
        c += 32 * ((c >= 65) & (c <= 90))
        yield (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]


def _pairs(batch: pa.RecordBatch, first: str) -> Iterator[tuple]:
    """Rows of ``first`` and text; a batch may be large, so texts become Python strings one at a time."""
    for value, text in zip(batch.column(first), batch.column("text"), strict=True):
        yield value.as_py(), text.as_py()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n), summed over about ``SLICE`` trigrams at a time."""

    def rows(parts: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
        counted = [(lang, *np.unique(np.concatenate(own), return_counts=True)) for lang, own in parts.items()]
        lang = [lang for lang, grams, _ in counted for _ in range(grams.size)]
        columns = [np.concatenate([c[k] for c in counted]) if counted else np.zeros(0, np.int64) for k in (1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), *map(pa.array, columns)], names=["lang", "gram", "n"])

    parts: dict[str, list[np.ndarray]] = {}
    held = 0
    for batch in batches:
        for lang, text in _pairs(batch, "lang"):
            for grams in _trigrams(text):
                parts.setdefault(lang, []).append(grams)
                held += grams.size
                if held > SLICE:
                    yield rows(parts)
                    parts, held = {}, 0
    yield rows(parts)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, gram, n) of each text."""
    for batch in batches:
        for row, text in _pairs(batch, "row"):
            for part in _trigrams(text):
                grams, n = np.unique(part, return_counts=True)
                columns = [pa.array(np.full(grams.size, row)), pa.array(grams), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "gram", "n"])


class LanguageFilter:
    """Keep texts in the wanted languages.

    An existing language column is trusted. Without one, languages come from a
    model fitted on labelled texts. Trigrams never seen in training say nothing.
    """

    def __init__(self, languages_to_keep: Sequence[str] = ("en",), min_chars: int = MIN_CHARS_FOR_DETECTION) -> None:
        self.languages_to_keep = tuple(languages_to_keep)
        self.min_chars = min_chars
        self.model: DataFrame | None = None

    def fit(self, df: DataFrame, text_col: str, language_col: str) -> "LanguageFilter":
        """Learn from all rows that have a text and a language."""
        rows = df.select(F.col(language_col).alias("lang"), F.col(text_col).alias("text")).dropna()
        texts = class_totals(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang", "n")
        counts = rows.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        counts = materialize(counts, "trigrams")
        totals = class_totals(counts, "lang", "n")
        self.languages = sorted(texts)
        self.priors = [float(np.log(texts[x] / sum(texts.values()))) for x in self.languages]
        grams = counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
        distinct = grams.count()
        seen = F.array(*[F.coalesce(F.col("by")[x], F.lit(0)) for x in self.languages]).cast("array<bigint>")
        whole = F.array(*[F.lit(float(totals.get(x, 0) + distinct)) for x in self.languages]).cast("array<double>")
        weights = F.zip_with(seen, whole, lambda n, total: F.log((n + 1) / total))
        self.model, self.size = materialize(grams.select("gram", weights.alias("weights")), "languages"), distinct
        return self

    def _scored_in_place(self, text):
        table = self.model.toArrow()
        grams = table.column("gram").to_numpy()
        weights = table.column("weights").combine_chunks().flatten().to_numpy().reshape(len(grams), len(self.languages))
        order = np.argsort(grams)
        grams, weights = grams[order], weights[order]
        held = self.model.sparkSession.sparkContext.broadcast((grams, weights, np.array(self.priors), self.languages))

        @F.pandas_udf("string")
        def detected(texts: pd.Series) -> pd.Series:
            grams, weights, priors, names = held.value
            out = []
            for text in texts:
                score = priors.copy()
                for own in _trigrams(text):
                    if not len(grams):
                        continue
                    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                    score += weights[at[grams[at] == own]].sum(axis=0)
                out.append(names[int(score.argmax())])
            return pd.Series(out, dtype=object)

        return detected(text)

    def _scored_by_join(self, rows: DataFrame) -> DataFrame:
        """(row, language) of ``rows`` (row, text)."""
        found = rows.mapInArrow(_distinct, "row long, gram long, n long").join(self.model, "gram")
        sums = [F.sum(F.col("n") * F.col("weights")[i]).alias(f"s{i}") for i in range(len(self.languages))]
        scored = rows.select("row").join(found.groupBy("row").agg(*sums), "row", "left")
        # The greatest score; of equal ones, the first language.
        best = F.array(
            *[
                F.struct((F.coalesce(f"s{i}", F.lit(0.0)) + p).alias("s"), F.lit(-i).alias("i"), F.lit(x).alias("lang"))
                for i, (p, x) in enumerate(zip(self.priors, self.languages))
            ]
        )
        return scored.select("row", F.array_max(best)["lang"].alias("language"))

    def detect(self, df: DataFrame, text_col: str, out: str = "language") -> DataFrame:
        """Add the detected language; short or missing text is 'unknown'."""
        if self.model is None:
            raise ValueError("fit the detector on labelled texts first")
        kept = [F.col(f"`{c}`") for c in df.columns if c != out]
        text = F.col(f"`{text_col}`")
        usable = F.coalesce(F.length(text) >= self.min_chars, F.lit(False))
        if not self.languages:
            return df.select(*kept, F.lit("unknown").alias(out))
        if self.size * len(self.languages) <= HELD_CELLS:
            named = F.when(usable, self._scored_in_place(F.when(usable, text).otherwise(""))).otherwise("unknown")
            return df.select(*kept, named.alias(out))
        stored = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "texts")
        named = self._scored_by_join(stored.filter(usable).select(F.col("_row").alias("row"), text.alias("text")))
        named = named.select(F.col("row").alias("_row"), F.col("language").alias("_language"))
        return stored.join(named, "_row", "left").select(*kept, F.coalesce("_language", F.lit("unknown")).alias(out))

    def filter_dataframe(
        self, df: DataFrame, text_col: str = "lyrics", language_col: str | None = "language"
    ) -> DataFrame:
        if not (language_col and language_col in df.columns):
            language_col = "language"
            df = self.detect(df, text_col, language_col)
        return df.filter(F.col(language_col).isin(list(self.languages_to_keep)))
