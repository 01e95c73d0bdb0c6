"""The engine's inputs expressed over the TPC-H-like sample tables.

Gives the catalogue tables, a lyrics table and a two-sided linkage input as
projections of whole sample tables, with the same definitions in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.operators.catalogue import CatalogueTables
from chorale.sources.readers import spread

# Raw genre strings dealt to suppliers by nation and by key.
RAW_GENRES = (
    "dance pop", "trap", "indie rock", "neo soul", "outlaw country", "deep house", "jazz",
    "pop rap", "uk garage", "classical", "country rap", "Hard Rock", " funk ",
)
# Tags dealt to documents by language.
TAG_BY_LANGUAGE = {"en": "rap", "fr": " Pop", "de": "rock", "es": "r-b"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def _genre_of(n):
    return F.get(F.array(*[F.lit(g) for g in RAW_GENRES]), (n % len(RAW_GENRES)).cast("int"))


def catalogue_tables(spark: SparkSession, folder: str) -> CatalogueTables:
    orders, supplier = table(spark, folder, "orders"), table(spark, folder, "supplier")
    lineitem = table(spark, folder, "lineitem")
    tracks = orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("track "), F.col("o_custkey").cast("string")).alias("name"),
        F.floor(F.col("o_totalprice") / 5000).cast("string").alias("popularity"),
        F.col("o_custkey").alias("duration"),
        (F.col("o_orderstatus") == "F").alias("explicit"),
    )
    features = lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
        (F.max("l_discount") * 10).alias("danceability"),
        (F.max("l_quantity") / 50).alias("energy"),
        (F.min("l_quantity") - 60).alias("loudness"),
        (F.min("l_discount") * 10).alias("speechiness"),
        (F.max("l_tax") * 10).alias("acousticness"),
        (F.min("l_tax") * 10).alias("instrumentalness"),
        (F.min("l_quantity") / 50).alias("liveness"),
        (F.max("l_linenumber").cast("double") / 7).alias("valence"),
        (F.max("l_quantity") * 4 + 40).alias("tempo"),
    )
    pairs = lineitem.select(F.col("l_orderkey").alias("track_id"), F.col("l_suppkey").alias("artist_id"))
    artists = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    genres = supplier.select(
        F.col("s_suppkey").alias("artist_id"),
        F.explode(F.array(_genre_of(F.col("s_nationkey")), _genre_of(F.col("s_suppkey")))).alias("genre_id"),
    )
    return CatalogueTables(tracks, features, pairs, artists, genres)


_GENRE_LIST = "[" + ", ".join(f"'{g}'" for g in RAW_GENRES) + "]"

CATALOGUE_SQL = f"""
tracks AS (
  SELECT o_orderkey AS id, 'track ' || o_custkey AS name,
         floor(o_totalprice / 5000)::INTEGER AS popularity,
         o_custkey AS duration, o_orderstatus = 'F' AS explicit
  FROM orders),
audio_features AS (
  SELECT l_orderkey AS id, max(l_discount) * 10 AS danceability, max(l_quantity) / 50 AS energy,
         min(l_quantity) - 60 AS loudness, min(l_discount) * 10 AS speechiness,
         max(l_tax) * 10 AS acousticness, min(l_tax) * 10 AS instrumentalness,
         min(l_quantity) / 50 AS liveness, max(l_linenumber)::DOUBLE / 7 AS valence,
         max(l_quantity) * 4 + 40 AS tempo
  FROM lineitem GROUP BY l_orderkey),
artist_genres AS (
  SELECT s_suppkey AS artist_id, s_name AS artist,
         unnest([({_GENRE_LIST})[s_nationkey % {len(RAW_GENRES)} + 1],
                 ({_GENRE_LIST})[s_suppkey % {len(RAW_GENRES)} + 1]]) AS genre_id
  FROM supplier),
joined AS (
  SELECT t.id AS track_id, any_value(t.name) AS track_name, any_value(t.popularity) AS popularity,
         any_value(t.duration) AS duration_ms, any_value(t.explicit) AS explicit,
         min(g.artist) AS artists, any_value(af.danceability) AS danceability,
         any_value(af.energy) AS energy, any_value(af.loudness) AS loudness,
         any_value(af.speechiness) AS speechiness, any_value(af.acousticness) AS acousticness,
         any_value(af.instrumentalness) AS instrumentalness, any_value(af.liveness) AS liveness,
         any_value(af.valence) AS valence, any_value(af.tempo) AS tempo,
         list_sort(list(DISTINCT g.genre_id)) AS genres
  FROM tracks t
  JOIN audio_features af ON af.id = t.id
  JOIN lineitem l ON l.l_orderkey = t.id
  JOIN artist_genres g ON g.artist_id = l.l_suppkey
  WHERE t.popularity >= 10
  GROUP BY t.id)"""


def lyrics_table(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as lyrics: tag by language, artist by source, title by digest."""
    tag = F
    for lang, value in TAG_BY_LANGUAGE.items():
        tag = tag.when(F.col("lang") == lang, value)
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        F.md5("text").alias("title"),
        tag.otherwise("misc").alias("tag"),
        F.col("source").alias("artist"),
        F.lit(None).cast("int").alias("year"),
        F.concat(
            F.lit("12 Contributors\n[Intro]\n"), F.col("text"),
            F.lit("\nProduced by A & B\nYou might also like\n7Embed"),
        ).alias("lyrics"),
        F.col("lang").alias("language"),
        F.lit(None).cast("string").alias("features"),
    )


_TAG_CASE = " ".join(f"WHEN '{lang}' THEN '{value}'" for lang, value in TAG_BY_LANGUAGE.items())

LYRICS_SQL = f"""
lyrics AS (
  SELECT doc_id AS id, md5(text) AS title, CASE lang {_TAG_CASE} ELSE 'misc' END AS tag,
         source AS artist,
         concat('12 Contributors', chr(10), '[Intro]', chr(10), text, chr(10), 'Produced by A & B',
                chr(10), 'You might also like', chr(10), '7Embed') AS lyrics,
         lang AS language
  FROM documents)"""


def linkage_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Small parts against large parts: brand as artist, name as title."""
    part = table(spark, folder, "part")
    left = part.filter(F.col("p_size") <= 25).select("p_partkey", F.col("p_brand").alias("artist"), F.col("p_name").alias("title"))
    suffix = (
        F.when(F.col("p_type") == "ECONOMY", " - Remastered 2009")
        .when(F.col("p_type") == "STANDARD", " (feat. Somebody Élse)")
        .otherwise("")
    )
    right = part.filter(F.col("p_size") > 25).select(
        "p_partkey",
        F.concat("p_brand", F.lit(" & Others")).alias("artists"),
        F.concat("p_name", suffix).alias("track_name"),
    )
    return left, right
