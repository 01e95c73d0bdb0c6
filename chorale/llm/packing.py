"""Documents packed into fixed token budgets by the histogram of their lengths.

Texts become token ids with one end id; documents longer than a sequence are
cut into full pieces and a rest. Only the counts of each piece length (at most
``size`` numbers) reach the driver, where the longest lengths are placed
first, each into the emptiest kind of pack that has room. Kinds of packs with
their counts are then joined back to the pieces by rank inside each length.

Tokenizing: words repeat, so each distinct word of a batch is encoded once, by
the quicker library with the same vocabulary. A text is cut only before a
single space that precedes a non-space, where the tokenizer's own pattern
always cuts, so ids equal those of the whole text. Texts with other spacing
are encoded whole; strings of special tokens are tokens, as the tokenizer's
file has it.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import pieces, ranked
from chorale.session import materialize

# Bytes of text tokenized at once.
STRETCH = 4 << 20
_ODD = re.compile(r" (?:\s|\Z)")


class _Words:
    """Ids of whole texts, with each distinct word of a batch encoded once."""

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.special]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self.bytes = np.zeros(max(merges.values()) + 1, np.int64)
        for token, rank in merges.items():
            self.bytes[rank] = len(token)

    def _joined(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each after a space, and how many each has."""
        one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        text = " " + pa.compute.binary_join(one, pa.scalar(" ", words.type))[0].as_py()
        ids = self.fast.encode_to_numpy(text) if len(words) else np.zeros(0, np.uint32)
        ends = np.cumsum(pa.compute.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        upto = np.searchsorted(np.cumsum(self.bytes[ids]), ends, side="right")
        return ids, np.diff(upto, prepend=0)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        plain, out = [], [None] * len(texts)
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)
            elif _ODD.search(text):
                out[i] = np.array(self.fast.encode_ordinary(text), np.int64)
            else:
                plain.append(i)
        if not plain:
            return out
        lists = pa.compute.split_pattern(pa.array([texts[i] for i in plain], pa.large_string()), " ")
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        words = lists.flatten()
        later = np.ones(len(words), bool)
        later[first] = False
        coded = words.filter(pa.array(later)).dictionary_encode()
        ids, sizes = self._joined(coded.dictionary)
        # The first word of a text follows no space; it stands for itself.
        heads = [np.array(self.fast.encode_ordinary(w), np.int64) for w in words.take(pa.array(first)).to_pylist()]
        pool = np.concatenate([ids.astype(np.int64), *heads])
        sizes = np.concatenate([sizes, np.fromiter(map(len, heads), np.int64, len(heads))])
        starts = np.cumsum(sizes) - sizes
        numbers = np.empty(len(words), np.int64)
        numbers[later] = coded.indices.to_numpy()
        numbers[first] = len(coded.dictionary) + np.arange(len(plain))
        edges = np.append(first, len(words))
        for k, i in enumerate(plain):
            own = numbers[edges[k] : edges[k + 1]]
            n = sizes[own]
            shift = np.repeat(starts[own] - (np.cumsum(n) - n), n)
            out[i] = pool[shift + np.arange(shift.size)]
        return out


def _encoder(path: str, ranks: str, end: int, size: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(path, ranks)
        for batch in pieces(batches, "text", STRETCH):
            rows, out = [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for row, ids in enumerate(words.ids(texts)):
                ids = np.append(ids, end).astype("<u4")
                for start in range(0, ids.size, size):
                    one = ids[start : start + size]
                    rows.append(row)
                    out.append((start, one.size, zlib.crc32(one.tobytes()), ids.size, one if keep_ids else None))
            columns = [batch.column("key").take(pa.array(rows, pa.int64()))]
            columns += [pa.array([x[k] for x in out], pa.int64()) for k in range(4)]
            names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array([x[4].astype(np.int32) for x in out], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def tokenized(
    docs: DataFrame, path: str, ranks: str, key: str = "doc_id", text: str = "text", size: int = 1024, end: int = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece of at most ``size`` ids: key, start, length, ids_crc32, doc_tokens (and ids).

    ``path`` is the tokenizer's file, ``ranks`` the file with the same vocabulary as ranks.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.mapInArrow(_encoder(path, ranks, end, size, keep_ids), schema + (", ids array<int>" if keep_ids else ""))


def pack_kinds(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Kinds of packs as (count, lengths), from how often each length occurs."""
    # By the room left: kinds of packs that lack a length, as [count, lengths].
    open_kinds: list[list[list]] = [[] for _ in range(size + 1)]
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], size
        while left:
            while room >= length and not open_kinds[room]:
                room -= 1
            if room < length:
                open_kinds[size - length].append([left, [length]])
                break
            count, lengths = open_kinds[room].pop()
            placed = min(count, left)
            if count > placed:
                open_kinds[room].append([count - placed, lengths])
            open_kinds[room - length].append([placed, [*lengths, length]])
            left -= placed
    return [(count, lengths) for kinds in open_kinds for count, lengths in kinds]


def packed(rows: DataFrame, size: int = 1024) -> DataFrame:
    """``rows`` (key, start, length, ...) with sequence_id and offset; nothing is longer than ``size``."""
    # Ranking reads its rows twice; texts are tokenized once.
    rows = ranked(materialize(rows, "tokenized"), ["length"], [F.col("key"), F.col("start")], "pieces")
    rows = materialize(rows, "ranked")
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    runs, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for count, lengths in pack_kinds(histogram, size):
        offset = 0
        for length in lengths:
            runs.append((length, taken[length], taken[length] + count, sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    runs_df = rows.sparkSession.createDataFrame(runs, "length long, low long, high long, first long, offset long")
    # Five numbers a run: a copy for every executor only up to a few MB.
    if len(runs) <= 1 << 16:
        runs_df = F.broadcast(runs_df)
    joined = rows.join(runs_df, (rows["length"] == runs_df["length"]) & (rows["rank"] >= runs_df["low"]) & (rows["rank"] < runs_df["high"]))
    kept = [rows[c] for c in rows.columns if c != "rank"]
    return joined.select(*kept, (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")


def assembled(packed_rows: DataFrame, size: int = 1024, pad: int = 0) -> DataFrame:
    """The sequences themselves: sequence_id and ``size`` ids, from packed rows that kept their ids."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed_rows.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
    return joined.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad), F.lit(size) - F.size("ids"))).alias("ids"))
