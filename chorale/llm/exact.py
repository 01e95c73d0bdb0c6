"""Exact duplicates by recipes: texts as ordered lists of verified chunk ids.

A text with its white space normalised is cut where a rolling hash of the last
bytes says so, hence equal passages are cut alike. Chunks go by a 64-bit hash;
one pass groups chunk contents by that hash and finds hashes that stand for
different contents. Chunks of such a hash are numbered by content, so an id
never means two contents. From then on only lists of ids travel: texts are
equal when their lists are.

Defined results: a null text counts as empty; the smallest key of a group
stays, null first, and of repeated rows one; a text of any length is cut whole,
alone in its batch if it is long; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import equi, pieces, salted
from chorale.session import materialize

# Bytes of a chunk: least, most, and the bits that make a cut (2 KB on average beyond the least).
LEAST, MOST, CUT_BITS = 256, 16_384, 11
# Bytes that a cut depends on (a power of two), and bytes hashed at once.
REACH, STRETCH = 32, 1 << 20
# The column that tells rows of one key apart while documents are joined.
PRINT = "_chorale_print"
_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def normal(text: bytes) -> bytes:
    """Runs of white space as one space."""
    text = text.translate(_BLANKS)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def _cut_places(text: bytes) -> np.ndarray:
    """Ends of bytes after which the rolling hash allows a cut."""
    found = []
    for at in range(0, len(text), STRETCH):
        begin = max(0, at - REACH + 1)
        h = _GEAR[np.frombuffer(text, np.uint8, min(len(text), at + STRETCH) - begin, begin)]
        # The hash of 1, 2, 4 ... REACH bytes up to each place, from those of half as many.
        width = 1
        while width < REACH:
            longer = h.copy()
            longer[width:] += h[:-width] << np.uint32(width)
            h, width = longer, width * 2
        ends = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + begin + 1
        found.append(ends[ends > at])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunks(text: bytes) -> list[bytes]:
    """``text`` in content-defined chunks; none for an empty text."""
    if len(text) <= LEAST:
        return [text] if text else []
    cuts, last = [], 0
    for end in [*_cut_places(text).tolist(), len(text)]:
        while end - last > MOST:
            last += MOST
            cuts.append(last)
        if end - last >= LEAST or end == len(text) > last:
            last = end
            cuts.append(last)
    return [text[a:b] for a, b in zip([0, *cuts], cuts)]


def _hashes(parts: list[bytes], bits: int) -> np.ndarray:
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    return (h >> np.uint64(64 - bits)).view(np.int64)


def _recipes(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            lists, digests = [], []
            for text in batch.column("text").to_pylist():
                text = normal(text or b"")
                digests.append(hashlib.sha256(text).hexdigest())
                lists.append(_hashes(chunks(text), bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("row"), batch.column("print"), pa.array(digests, pa.string()), pa.array(lists, pa.list_(pa.int64()))],
                names=["key", "row", "print", "text_sha256", "recipe"],
            )

    return run


def _contents(bits: int):
    """(row, at, hash, chunk) for every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows, places, parts = [], [], []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = chunks(normal(text or b""))
                rows += [row] * len(own)
                places += range(len(own))
                parts += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(places, pa.int64()), pa.array(_hashes(parts, bits), pa.int64()), pa.array(parts, pa.binary())],
                names=["row", "at", "hash", "chunk"],
            )

    return run


def recipes(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """(key, row, print, text_sha256, recipe, variants): equal normalised texts, and no others, have equal lists.

    ``variants`` numbers the contents of hashes that stand for several; it is
    empty for all other texts.
    """
    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    # A print of the text as it is tells rows of one key apart.
    printed = rows.withColumn("print", F.xxhash64("text"))
    made = printed.mapInArrow(_recipes(bits), f"key {kind}, row long, print long, text_sha256 string, recipe array<long>")
    made = materialize(made, "recipes")
    content = rows.select("row", "text").mapInArrow(_contents(bits), "row long, at long, hash long, chunk binary")
    # Each content moves once: distinct in its task first, then by hash and content.
    distinct = content.select("hash", "chunk").distinct()
    several = materialize(distinct.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "collisions")
    none = F.array().cast("array<struct<at:long,number:long>>")
    if several.isEmpty():
        return made.withColumn("variants", none)
    # Only chunks of those hashes are looked at again, and numbered by a digest of their content.
    number = F.sha2("chunk", 256)
    parts = content.join(several, "hash").select("row", "at", "hash", number.alias("digest"))
    parts = materialize(parts, "collided")
    listed = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("variants"))
    return made.join(listed, "row", "left").withColumn(
        "variants", F.coalesce("variants", F.array().cast("array<struct<at:long,digest:string>>"))
    )


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """Per row: key, print, keep (key of the row that stays), group_size, kept, text_sha256."""
    lists = recipes(docs, key, text, bits)
    same = ["recipe", "variants"]
    groups = lists.groupBy(*same).agg(F.min(F.struct("key", "row")).alias("first"), F.count("*").alias("size"))
    groups = materialize(groups.filter("size > 1"), "copies")
    # A third of all rows may be copies of one text.
    joined = salted(lists, groups, same, "row", "left")
    return joined.select(
        "key", "print",
        F.when(F.col("first").isNull(), F.col("key")).otherwise(F.col("first.key")).alias("keep"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def unique(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, as they are."""
    kept = duplicates(docs, key, text).filter("kept").select(F.col("key").alias(key), F.col("print").alias(PRINT))
    kept = materialize(kept, "kept")
    printed = docs.withColumn(PRINT, F.xxhash64(F.col(text).cast("binary")))
    stay = equi(printed, kept, [key, PRINT], "left_semi")
    if docs.count() != docs.select(key).distinct().count():
        # Rows may repeat key and text; one of them stays.
        stay = stay.dropDuplicates([key, PRINT])
    return stay.drop(PRINT)
