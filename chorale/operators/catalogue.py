"""The catalogue join: tracks, features, artists and their genres."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.config import AUDIO_FEATURES
from chorale.functions.labels import first_mapped
from chorale.session import materialize

# Genres that fit the bits of one number.
MASKED_GENRES = 63


@dataclass(frozen=True)
class CatalogueTables:
    tracks: DataFrame
    audio_features: DataFrame
    track_artists: DataFrame
    artists: DataFrame
    artist_genres: DataFrame


def _one_per_id(df: DataFrame, *cols: str) -> DataFrame:
    return df.select("id", *cols).dropDuplicates(["id"])


def _by_arrays(t: CatalogueTables, genres: DataFrame) -> DataFrame:
    """(track_id, artists, genres): any number of genres."""
    sets = genres.groupBy("artist_id").agg(F.collect_set("genre_id").alias("_genres"))
    artists = t.artists.select(F.col("id").alias("artist_id"), "name").join(sets, "artist_id")
    return (
        t.track_artists.select("track_id", "artist_id")
        .join(artists, "artist_id")
        .groupBy("track_id")
        .agg(
            F.min("name").alias("artists"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("_genres")))).alias("genres"),
        )
    )


def _by_masks(t: CatalogueTables, genres: DataFrame, names: list) -> DataFrame:
    """The same from whole numbers: an artist's place in the order of names, and a bit for each of its genres.

    Numbers are folded in place, while arrays and strings would be sorted by track first. Places ascend with the
    names, as artists are dealt by range; they need not be without gaps.
    """
    known = F.array(*[F.lit(n).cast(genres.schema["genre_id"].dataType) for n in names])
    place = F.array_position(known, F.col("genre_id")).cast("int") - 1
    bits = genres.withColumn("_at", place).groupBy("artist_id").agg(F.bit_or(F.expr("shiftleft(1L, _at)")).alias("_mask"))
    placed = t.artists.select(F.col("id").alias("artist_id"), "name").join(bits, "artist_id")
    placed = placed.repartitionByRange("name").sortWithinPartitions("name")
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), "artists")
    numbers = placed.select("artist_id", "_mask", F.when(F.col("name").isNotNull(), F.col("_place")).alias("_place"))
    folded = (
        t.track_artists.select("track_id", "artist_id")
        .join(numbers, "artist_id")
        .groupBy("track_id")
        .agg(F.min("_place").alias("_place"), F.bit_or("_mask").alias("_mask"))
    )
    named = folded.join(placed.select("_place", F.col("name").alias("artists")), "_place", "left")
    return named.select("track_id", "artists", F.filter(known, lambda _, i: F.getbit("_mask", i) == 1).alias("genres"))


def join_catalogue(t: CatalogueTables, min_popularity: int = 10) -> DataFrame:
    """One row per track with its first artist name and its set of genres.

    An artist's genres are folded into one number, or one array where they are many, before they meet
    the tracks, so the artist-by-genre product never exists; the artist side is then folded
    per track, and tracks, features and artist summary meet one to one on the
    track id. Artists without genres contribute nothing, as in an inner join.
    """
    popular = t.tracks.withColumn(
        "popularity", F.expr("try_cast(popularity as int)")
    ).filter(F.col("popularity") >= min_popularity)
    tracks = _one_per_id(popular, "name", "popularity", "duration", "explicit")
    genres = t.artist_genres.filter(F.col("genre_id").isNotNull())
    # At most one name more than fit.
    names = genres.select("genre_id").distinct().orderBy("genre_id").limit(MASKED_GENRES + 1).collect()
    if 0 < len(names) <= MASKED_GENRES:
        per_track = _by_masks(t, genres, [r["genre_id"] for r in names])
    else:
        per_track = _by_arrays(t, genres)
    features = _one_per_id(t.audio_features, *AUDIO_FEATURES)
    return (
        tracks.join(features, "id")
        .withColumnRenamed("id", "track_id")
        .join(per_track, "track_id")
        .select(
            "track_id",
            F.col("name").alias("track_name"),
            "popularity",
            F.col("duration").alias("duration_ms"),
            "explicit",
            "artists",
            *AUDIO_FEATURES,
            "genres",
        )
    )


def resolve_genre(joined: DataFrame) -> DataFrame:
    """Replace the genre set by its first entry that maps to a label."""
    return joined.withColumn("track_genre", first_mapped(F.col("genres"))).drop("genres")
