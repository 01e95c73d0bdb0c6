"""Table readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorale.operators.catalogue import CatalogueTables, join_catalogue, resolve_genre
from chorale.operators.guards import require_columns
from chorale.operators.sampling import first_n, sample_exact

LYRICS_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("tag", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("views", T.LongType()),
        T.StructField("features", T.StringType()),
        T.StructField("lyrics", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("language_cld3", T.StringType()),
        T.StructField("language_ft", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)
LYRICS_COLUMNS = ("id", "title", "tag", "artist", "year", "lyrics", "language", "features")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read by extension: Parquet, CSV or tab-separated text."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if suffix == "parquet":
        return reader.parquet(path)
    if suffix in ("csv", "tsv", "tab"):
        sep = "," if suffix == "csv" else "\t"
        return reader.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=True)
    raise ValueError(f"unsupported table format: {path}")


def spread(df: DataFrame) -> DataFrame:
    """Deal a table that arrives in fewer pieces than there are cores.

    Only small inputs (one file, one row group) are moved; a table with enough
    splits is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    # Always true; but filters are not pushed past a non-deterministic one, so
    # costly tests run after the rows were dealt and not in the one scan task.
    return df.repartition(cores).filter(F.spark_partition_id() >= 0)


def load_lyrics(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = LYRICS_COLUMNS,
    nrows: int | None = None,
    sample_n: int | None = None,
    sample_seed: int = 42,
    key: str = "id",
) -> DataFrame:
    """The lyrics table: chosen columns, optionally the first rows, optionally
    an exact sample of those. One quoted CSV is one task; land it as Parquet."""
    schema = LYRICS_SCHEMA if not path.endswith(".parquet") else None
    df = read_table(spark, path, schema)
    require_columns(df, ("title", "artist", "lyrics", "tag"))
    df = df.select([c for c in columns if c in df.columns])
    if nrows is not None:
        df = first_n(df, nrows, key)
    if sample_n is not None:
        df = sample_exact(df, sample_n, [key], sample_seed)
    return df


def load_catalogue(
    tables: CatalogueTables,
    min_popularity: int = 10,
    cache_dir: str | None = None,
    sample_n: int | None = None,
    sample_seed: int = 42,
) -> DataFrame:
    """The joined catalogue with one raw genre per track; bytes that are no text are marked in names.

    With ``cache_dir`` the join is written once per popularity threshold and
    read back afterwards.
    """
    spark = tables.tracks.sparkSession

    def build() -> DataFrame:
        return repair_utf8(resolve_genre(join_catalogue(tables, min_popularity)), "track_name", "artists")

    df = build() if cache_dir is None else cached(
        spark, f"{cache_dir.rstrip('/')}/catalogue_pop{min_popularity}.parquet", build
    )
    if sample_n is not None:
        df = sample_exact(df, sample_n, ["track_id"], sample_seed)
    return df


def cached(spark: SparkSession, path: str, build) -> DataFrame:
    """Read ``path`` when a finished table is there, else build and write it."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def repair_utf8(df: DataFrame, *cols: str) -> DataFrame:
    """Binary columns as text, undecodable bytes as U+FFFD."""
    return df.withColumns({c: F.make_valid_utf8(F.col(c).cast("string")) for c in cols})
