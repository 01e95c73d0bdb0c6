"""Two-pass shuffle of a table into shards of equal row counts.

Pass one scatters rows by a seeded hash into buckets that fit a task's memory;
pass two Fisher-Yates shuffles each bucket (Spark's ``shuffle`` of an array)
and writes it. The order of buckets and places in them is a random order of
all rows, and every shard is a run of it, so shard sizes differ by one row at
most. A bucket may feed two shards; a shard may hold parts of many buckets.

The hash covers the key and the row's place in the input, so copies of one row
scatter as well as others. The same files read with the same settings and seed
give the same buckets.

There are as many buckets as rows and bytes ask for. Long texts scatter like
others, so a bucket is seldom much larger than meant; it holds whole rows, one at
least, and a text of any length that Spark can hold is one.

Defined results: null keys and texts are rows as others are; all columns are kept, and an empty table gives no shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.session import materialize

# Rows, and bytes of texts, that a bucket is meant to hold.
BUCKET_ROWS, BUCKET_BYTES = 1024, 16 << 20


def bucket_count(df: DataFrame, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    """Rows of ``df``, and into how many buckets they go, by their number and by the bytes of their texts."""
    texts = [F.octet_length(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    weight = sum((F.coalesce(t, F.lit(0)).cast("long") for t in texts), F.lit(16).cast("long"))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).first()
    return rows, max(1, -(-rows // bucket_rows), -(-size // bucket_bytes))


def shuffled_shards(
    df: DataFrame, shards: int, key: str, seed: int = 17, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows of ``df`` as ``row`` (a struct), with ``shard`` and ``slot`` (from 0 without gaps)."""
    rows, buckets = bucket_count(df, bucket_rows, bucket_bytes)
    place = F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.monotonically_increasing_id())
    scattered = df.select(F.pmod(place, F.lit(buckets)).alias("bucket"), F.struct("*").alias("row"))
    shuffled = scattered.groupBy("bucket").agg(F.shuffle(F.collect_list("row"), seed).alias("rows"))
    written = materialize(shuffled.select("bucket", F.size("rows").cast("long").alias("n"), F.posexplode("rows")), "shards")
    # One narrow row per bucket; the sums run over buckets, not over rows.
    firsts = written.filter("pos = 0").select("bucket", "n")
    blocks = firsts.withColumn("block", F.shiftright("bucket", 10))
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("block").agg(F.sum("n").alias("total"))
    sums = sums.select("block", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("start"))
    starts = blocks.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, "block")
    starts = starts.select("bucket", (F.col("start") + F.col("inside")).alias("before"))
    placed = written.join(starts, "bucket").withColumn("at", F.col("before") + F.col("pos"))
    # Shard s begins at ceil(s * rows / shards).
    shard = F.expr(f"(at * {shards}) div {max(rows, 1)}")
    begin = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return (
        placed.select(F.col("col").alias("row"), "at", shard.alias("shard"))
        .select("row", F.col("shard").cast("int").alias("shard"), (F.col("at") - begin).alias("slot"))
    )
