"""Dataset builds: catalogue (audio) and lyrics, from raw tables to splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.config import (
    AUDIO_FEATURES,
    LANGUAGES_KEPT,
    ROWS_PER_CLASS,
    SEED,
    TARGET_GENRES,
    TEST_SHARE,
    VAL_SHARE,
    WORDS_KEPT,
)
from chorale.functions.labels import map_by_substring, map_by_tag
from chorale.functions.lexical import lexical_features
from chorale.functions.text import USUAL_STEPS, between, clean, word_count
from chorale.operators.catalogue import CatalogueTables
from chorale.operators.guards import keep_columns, require_columns
from chorale.operators.sampling import balance, filter_targets, starved_classes, stratified_split
from chorale.session import materialize
from chorale.sources.readers import load_catalogue, load_lyrics
from chorale.sources.sinks import write_dataset

AUDIO_COLUMNS = ("track_id", "track_name", "artists", "popularity", "genre", *AUDIO_FEATURES)


@dataclass(frozen=True)
class Choices:
    """What a build keeps of its input, and how it divides it.

    ``per_class`` rows of each target are chosen (None: all of them); ``words``
    is the length window of a cleaned text, ``held_out`` the test and
    validation shares.
    """

    per_class: int | None = ROWS_PER_CLASS
    targets: tuple[str, ...] = TARGET_GENRES
    held_out: tuple[float, float] = (TEST_SHARE, VAL_SHARE)
    seed: int = SEED
    words: tuple[int, int] = WORDS_KEPT
    languages: tuple[str, ...] = LANGUAGES_KEPT
    steps: frozenset[str] = USUAL_STEPS


USUAL = Choices()


@dataclass(frozen=True)
class Dataset:
    """``full`` is the balanced table; ``parts`` the deduplicated rows with a
    ``split`` column. Deduplication comes after balancing, so ``parts`` may
    have fewer rows. ``starved`` lists targets that had fewer than
    ``FEW_ROWS`` rows to choose from, with their number."""

    full: DataFrame
    parts: DataFrame
    starved: DataFrame


# A class with fewer rows than this is reported.
FEW_ROWS = 500


def _starved(rows: DataFrame, choices: Choices) -> DataFrame:
    return starved_classes(rows.filter(F.col("genre").isin(list(choices.targets))), "genre", FEW_ROWS)


def _balanced(df: DataFrame, key: Sequence[str], choices: Choices) -> DataFrame:
    if choices.per_class is None:
        return filter_targets(df, "genre", choices.targets)
    return balance(df, "genre", key, "undersample", choices.per_class, choices.seed, choices.targets)


def stored_keys(survivors: DataFrame, key: Sequence[str], label: str) -> DataFrame:
    """Keys and labels of rows that cost much to find, stored for the passes that follow."""
    return materialize(survivors.select(*key, label), "survivors")


def balance_by_key(
    source: DataFrame,
    survivors: DataFrame,
    key: Sequence[str],
    label: str,
    per_class: int,
    targets: Sequence[str] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Rows of ``source`` that a balanced choice among ``survivors`` keeps.

    ``survivors`` holds the stored keys and labels of the rows that passed the
    costly filters. It is balanced in narrow passes; the
    chosen keys then select whole rows, which need no filtering again. The
    stored keys have a known size, so Spark copies them to every task when
    they are few and shuffles otherwise.
    """
    chosen = balance(survivors, label, key, "undersample", per_class, seed, targets)
    return source.join(materialize(chosen.select(*key), "chosen"), list(key), "left_semi")


def _split(full: DataFrame, key: Sequence[str], on: Sequence[str], choices: Choices) -> DataFrame:
    return stratified_split(full, "genre", key, on, *choices.held_out, choices.seed)


def build_audio(catalogue: DataFrame, choices: Choices = USUAL) -> Dataset:
    """Label, project, balance and split a joined catalogue.

    The labelled rows are stored once because balancing reads them in several
    narrow passes; so is the balanced table, which feeds two outputs.
    """
    require_columns(catalogue, ("track_name", "artists", "track_genre", "danceability", "energy", "valence", "tempo"))
    labelled = catalogue.withColumn("genre", map_by_substring(F.col("track_genre"))).filter(
        F.col("genre").isNotNull()
    )
    labelled = materialize(keep_columns(labelled, AUDIO_COLUMNS), "labelled")
    full = materialize(_balanced(labelled, ["track_id"], choices), "balanced")
    return Dataset(full, _split(full, ["track_id"], ("artists", "track_name"), choices), _starved(labelled, choices))


def early_filter(df: DataFrame, languages: Sequence[str], language: str = "language", tag: str = "tag") -> DataFrame:
    """Wanted languages, no miscellaneous tag; a null tag stays for now."""
    return df.filter(F.col(language).isin(list(languages)) & ~F.col(tag).eqNullSafe("misc"))


def labelled_lyrics(lyrics: DataFrame, choices: Choices = USUAL) -> DataFrame:
    """Rows in a wanted language, of plausible raw length, with a label.

    All of it is cheap and sits below the cleaning. The raw length may be twice
    the limit because cleaning only removes text.
    """
    fewest, most = choices.words
    kept = early_filter(lyrics, choices.languages).filter(between(word_count(F.col("lyrics")), fewest, 2 * most))
    return with_genre(kept).filter(F.col("genre").isNotNull())


def with_genre(lyrics: DataFrame) -> DataFrame:
    return lyrics.withColumn("genre", map_by_tag(F.col("tag")))


def with_clean_text(labelled: DataFrame, choices: Choices = USUAL) -> DataFrame:
    """Add lyrics_clean and word_count."""
    cleaned = clean(labelled, "lyrics", "lyrics_clean", choices.steps)
    return cleaned.withColumn("word_count", word_count(F.col("lyrics_clean")).cast("int"))


def cleaned_lyrics(labelled: DataFrame, choices: Choices = USUAL) -> DataFrame:
    """Clean, and keep texts of usable length."""
    return with_clean_text(labelled, choices).filter(between(F.col("word_count"), *choices.words))


def build_lyrics(lyrics: DataFrame, choices: Choices = USUAL, key: str = "id") -> Dataset:
    """Filter, label, clean, balance, featurise and split a lyrics table.

    Balancing keeps a few rows of many, so only keys and labels go through it.
    The chosen rows are fetched, cleaned again for output, and get features.
    Features depend on their own row alone, so computing them after balancing
    changes nothing.
    """
    require_columns(lyrics, ("title", "artist", "lyrics", "tag", key))
    survivors = cleaned_lyrics(labelled_lyrics(lyrics, choices), choices)
    narrow = stored_keys(survivors, [key], "genre")
    if choices.per_class is None:
        chosen = filter_targets(survivors, "genre", choices.targets)
    else:
        rows = balance_by_key(lyrics, narrow, [key], "genre", choices.per_class, choices.targets, choices.seed)
        chosen = with_clean_text(with_genre(rows), choices)
    full = lexical_features(chosen, "lyrics_clean")
    full = materialize(full, "balanced")
    return Dataset(full, _split(full, [key], ("artist", "title"), choices), _starved(narrow, choices))


class Pipeline:
    """Both builds from sources to written datasets."""

    def __init__(self, choices: Choices = USUAL) -> None:
        self.choices = choices

    def run_audio(self, tables: CatalogueTables, output_dir: str, min_popularity: int = 10,
                  cache_dir: str | None = None) -> dict:
        data = build_audio(load_catalogue(tables, min_popularity, cache_dir), self.choices)
        return self._written(data, output_dir, "audio")

    def run_lyrics(self, spark, path: str, output_dir: str, sample_n: int | None = None) -> dict:
        # A sample is drawn from all rows: a prefix of the ids would favour old entries.
        lyrics = load_lyrics(spark, path, sample_n=sample_n)
        data = build_lyrics(lyrics, self.choices)
        return self._written(data, output_dir, "lyrics")

    def _written(self, data: Dataset, output_dir: str, mode: str) -> dict:
        """The metadata, with the starved classes; there are at most as many as targets."""
        few = {r["genre"]: r["n"] for r in data.starved.collect()}
        return {**write_dataset(data.full, data.parts, "genre", output_dir, mode), "starved_classes": few}

    def run_all(self, output_dir: str, mode: str = "audio", **sources) -> dict:
        if mode == "audio":
            return self.run_audio(output_dir=output_dir, **sources)
        if mode == "lyrics":
            return self.run_lyrics(output_dir=output_dir, **sources)
        raise ValueError(f"unknown mode: {mode!r}")
