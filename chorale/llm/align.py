"""Alignment of a byte-level and a piece tokenizer by the byte ranges of their tokens.

Each text, a space before it, is tokenized twice. The character offsets of the
byte-level tokenizer and the spans in the piece tokenizer's proto are coarse
cuts. Where a token holds a part of a character only, or is a byte that
stands for itself, its end comes from the bytes it decodes to. Every token is held against the
bytes of its range; a text with a token that differs has no tokens.

Both tokenizers cut before a single space between two other characters: the
byte-level one by its pattern, the other because no piece has a space after
another character (looked up in its vocabulary). A stretch between such places
is thus aligned once, however often it comes, and a long text is worked on in
slices.

Counts over all texts: tasks work on batches of documents. A batch asks once
for each id pair in it; pair counts are summed over all batches, marked if
they are the highest of their first id, and joined back to what batches ask. No table of
pairs is copied to tasks.

Defined results: null and empty texts, and texts that one of the tokenizers
does not give back byte by byte, have zeros and an empty digest; strings of special
tokens are plain text; a text without a place to cut is tokenized whole; rows that share a
key are documents of their own; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import pieces
from chorale.session import materialize

# Bytes of text in a batch, characters of a text at once, and stretches remembered.
BATCH, SLICE, HELD = 4 << 20, 1 << 20, 1 << 19
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Matched(NamedTuple):
    """Ids of both tokenizers, the bytes at which their tokens end, and those at which both end."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    cuts: np.ndarray


class Aligner:
    """Two tokenizers, the bytes of their tokens, and the stretches aligned so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        byte_of, names = _byte_of(), {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(byte_of[c] for c in names.get(i, "") if c in byte_of) for i in range(max(names) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = np.array([self.b.is_byte(i) for i in range(len(names))])
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in zip(names, self.b_byte, strict=True)
        ]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.splits = not any("▁" in p.lstrip("▁") for p in names)
        # What an id adds to the digest's text, by what follows it: another id, the other side, another group.
        kinds = ((self.a_bytes, ","), (self.a_bytes, "|"), (self.b_bytes, ","), (self.b_bytes, ";"))
        self.atoms = pa.array([f"{i}{end}" for tokens, end in kinds for i in range(len(tokens))])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.strings: list[bytes] = []
        # Per stretch: tokens of both (-1: it has none), groups, links, and where its links start.
        self.sizes, self.codes = array("q"), array("q")

    def stretches(self, text: str) -> Iterator[list[str]]:
        """The stretches of a text, each without the space before it, slice by slice."""
        at = 0
        while self.splits and len(text) - at > SLICE:
            cut = _CUT.search(text, at + SLICE)
            if not cut:
                break
            yield _CUT.split(text[at : cut.start()])
            at = cut.end()
        rest = text[at:] if at else text
        yield _CUT.split(rest) if self.splits else [rest]

    def a_ends(self, text: str, ids: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Ends in bytes from character offsets; of tokens inside a character, from their own bytes."""
        ends = spans[:, 1]
        if not text.isascii():
            code = np.frombuffer(text.encode("utf-32-le"), "<u4")
            width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            ends = np.concatenate([[0], np.cumsum(width)])[ends]
        # The next token starts in the character in which such a token ends.
        inside = np.append(spans[1:, 0] < spans[:-1, 1], False)
        return np.where(inside, np.cumsum(self.a_sizes[ids]), ends)

    def b_ends(self, ids: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Ends in bytes from the proto's spans, which lack the space before the text; of single bytes, by counting."""
        return np.where(self.b_byte[ids], np.cumsum(self.b_sizes[ids]), spans + 1)

    def matched(self, text: str) -> Matched | None:
        """The tokens of ``text``, with a space before it; None if some token is not the bytes of its range."""
        text = " " + text
        raw = text.encode()
        encoding = self.a.encode(text, add_special_tokens=False)
        found = self.b.encode(text[1:], return_type="proto").pieces
        a = np.array(encoding.ids, np.int64)
        b = np.array([p.id for p in found], np.int64)
        a_ends = self.a_ends(text, a, np.array(encoding.offsets, np.int64).reshape(-1, 2))
        b_ends = self.b_ends(b, np.array([p.end for p in found], np.int64))
        for ids, ends, sizes, tokens in ((a, a_ends, self.a_sizes, self.a_bytes), (b, b_ends, self.b_sizes, self.b_bytes)):
            if (ends != np.cumsum(sizes[ids])).any() or b"".join(map(tokens.__getitem__, ids.tolist())) != raw:
                return None
        return Matched(a, a_ends, b, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True))

    def learn(self, stretches: list[str]) -> None:
        """Align the stretches not seen before, many of them joined to one text."""
        new = [s for s in dict.fromkeys(stretches) if s not in self.known]
        plain, size = [], 0
        for s in new:
            # Joined by spaces they are cut at these again, unless space is at an edge. A text with the piece tokenizer's sign for
            # a space has no tokens.
            if not self.splits or not s or s[0].isspace() or s[-1].isspace() or "▁" in s:
                self._remember([s])
                continue
            plain.append(s)
            size += len(s)
            if size > SLICE:
                self._remember(plain)
                plain, size = [], 0
        if plain:
            self._remember(plain)

    def _remember(self, own: list[str]) -> None:
        found = self.matched(" ".join(own))
        ends = np.cumsum([len(s.encode()) + 1 for s in own])
        if found is None or not np.isin(ends, found.cuts).all():
            if len(own) > 1:
                self._remember(own[: len(own) // 2])
                self._remember(own[len(own) // 2 :])
            else:
                self.known[own[0]] = len(self.strings)
                self.strings.append(b"")
                self.sizes.extend((-1, 0, 0, 0, len(self.codes)))
            return
        a, a_ends, b, b_ends, cuts = found
        # Links: all pieces from the one that holds a token's first byte to the one that holds its last.
        low = np.searchsorted(b_ends, np.concatenate([[0], a_ends[:-1]]), "right")
        width = np.searchsorted(b_ends, a_ends, "left") - low + 1
        upto = np.cumsum(width)
        at = np.arange(upto[-1]) - np.repeat(upto - width, width) + np.repeat(low, width)
        # The digest's text: of each group, its ids of one side, then those of the other.
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_upto, b_upto = np.searchsorted(a_ends, cuts, "right"), np.searchsorted(b_ends, cuts, "right")
        order = np.empty(a.size + b.size, np.int64)
        ends_a, ends_b = a_ends == cuts[a_group], b_ends == cuts[b_group]
        order[np.arange(a.size) + np.concatenate([[0], b_upto[:-1]])[a_group]] = a + len(self.a_bytes) * ends_a
        order[np.arange(b.size) + a_upto[b_group]] = b + 2 * len(self.a_bytes) + len(self.b_bytes) * ends_b
        atoms = self.atoms.take(pa.array(order))
        places = np.frombuffer(atoms.buffers()[1], np.int32)[: len(atoms) + 1]
        written = atoms.buffers()[2].to_pybytes()
        # Running totals at the end of each stretch.
        n_a, n_b = np.searchsorted(a_ends, ends, "right"), np.searchsorted(b_ends, ends, "right")
        totals = np.stack([n_a, n_b, np.searchsorted(cuts, ends, "right"), upto[n_a - 1]], axis=1)
        sizes = np.diff(totals, axis=0, prepend=0)
        starts = len(self.codes) + totals[:, 3] - sizes[:, 3]
        self.sizes.frombytes(np.column_stack([sizes, starts]).astype(np.int64).tobytes())
        self.codes.frombytes((np.repeat(a << 32, width) | b[at]).tobytes())
        edges = [0, *places[n_a + n_b].tolist()]
        for s, x, y in zip(own, edges, edges[1:]):
            self.known[s] = len(self.strings)
            self.strings.append(written[x:y])

    def document(self, text: str) -> tuple[list[int], str, np.ndarray, np.ndarray] | None:
        """Sizes, digest of the groups, distinct link codes, and how often each occurs."""
        totals, digest = np.zeros(4, np.int64), hashlib.sha256()
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for n, stretches in enumerate(self.stretches(text)):
            if n and len(self.known) > HELD:
                self.forget()
            self.learn(stretches)
            own = np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))
            which, often = np.unique(own, return_counts=True)
            sizes = np.frombuffer(self.sizes, np.int64).reshape(-1, 5)[which]
            if (sizes[:, 0] < 0).any():
                return None
            totals += often @ sizes[:, :4]
            digest.update((b";" if n else b"") + b"".join(map(self.strings.__getitem__, own.tolist()))[:-1])
            width = sizes[:, 3]
            at = np.repeat(sizes[:, 4] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            codes = np.concatenate([pairs, np.frombuffer(self.codes, np.int64)[at]])
            weights = np.concatenate([times, np.repeat(often, width)])
            order = np.argsort(codes)
            codes = codes[order]
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            pairs, times = codes[first], np.add.reduceat(weights[order], first)
        return totals.tolist(), digest.hexdigest(), pairs, times


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _batches(a_path: str, b_path: str):
    """Per document its sizes and links, as places in the list of the batch's pairs; and that list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        none = np.zeros(0, np.int64)
        for batch in pieces(batches, "text", BATCH):
            sizes, digests, pairs, times = [], [], [], []
            if len(aligner.known) > HELD:
                aligner.forget()
            texts = batch.column("text").to_pylist()
            # What the batch has that was not seen before is learnt at once; longer texts come slice by slice.
            aligner.learn([s for t in texts if t and len(t) <= SLICE for part in aligner.stretches(t) for s in part])
            for text in texts:
                found = aligner.document(text) if text else None
                totals, digest, own, often = found or ([0] * 4, "", none, none)
                sizes.append(totals)
                digests.append(digest)
                pairs.append(own)
                times.append(often)
            known, places, docs = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            cuts = np.cumsum([len(p) for p in pairs])[:-1]
            n = batch.num_rows
            blank = pa.nulls(n, pa.list_(pa.int64()))
            columns = [pa.array([number] * n, pa.int64()), batch.column("key")]
            columns += [pa.array([s[k] for s in sizes], pa.int64()) for k in range(4)]
            columns += [pa.array(digests), _lists(np.split(places, cuts), pa.int32()), _lists(times, pa.int32()), blank, blank]
            names = ["batch", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "pairs", "docs"]
            rows = pa.RecordBatch.from_arrays(columns, names=names)
            yield rows
            one = [pa.array([number], pa.int64()), *[pa.nulls(1, f.type) for f in rows.schema][1:-2]]
            yield pa.RecordBatch.from_arrays([*one, _lists([known], pa.int64()), _lists([docs], pa.int64())], names=names)
            number += 1

    return run


def _weighed(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Add to each document of a batch what its links' counts come to."""
    answers = answers.sort_by("at")
    counts = answers.column("n").to_numpy() if answers.num_rows else np.zeros(0, np.int64)
    best = answers.column("best").to_numpy() if answers.num_rows else np.zeros(0, bool)
    rows = rows.combine_chunks()
    lists = rows.column("places").chunk(0)
    places, times = lists.flatten().to_numpy(), rows.column("times").chunk(0).flatten().to_numpy().astype(np.int64)
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()

    def summed(values: np.ndarray) -> pa.Array:
        upto = np.concatenate([[0], np.cumsum(values)])
        return pa.array(upto[edges[1:]] - upto[edges[:-1]], pa.int64())

    out = rows.drop_columns(["batch", "places", "times"])
    return out.append_column("n_best", summed(best[places] * times)).append_column("count_sum", summed(counts[places] * times))


def alignments(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    shown = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    lists = "places array<int>, times array<int>, pairs array<long>, docs array<long>"
    made = materialize(rows.mapInArrow(_batches(a_path, b_path), f"batch long, {shown}, {lists}"), "alignments")
    listed = made.filter("pairs IS NOT NULL").select("batch", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "p"))
    asked = listed.select("batch", "at", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = materialize(asked.groupBy("pair").agg(F.sum("docs").alias("n")), "pair_counts")
    first = F.shiftright("pair", 32).alias("first")
    most = materialize(counts.groupBy(first).agg(F.max("n").alias("most")), "best_counts")
    counts = counts.withColumn("first", first).join(most, "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = asked.select(F.col("batch").alias("of"), "at", "pair").join(counts, "pair").select("of", "at", "n", "best")
    documents = made.filter("pairs IS NULL").drop("pairs", "docs")
    return documents.groupBy("batch").cogroup(answers.groupBy("of")).applyInArrow(
        _weighed, f"{shown}, n_best long, count_sum long"
    )


def groups(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The groups themselves: key, at (place in the document), ids of both, and the text's byte range."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = "at long, start long, end long, a array<int>, b array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        for batch in pieces(batches, "text", SLICE):
            owner, out = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                if not text or aligner.document(text) is None:
                    continue
                at = start = 0
                for stretches in aligner.stretches(text):
                    found = aligner.matched(" ".join(stretches))
                    x = np.searchsorted(found.a_ends, found.cuts, "right").tolist()
                    y = np.searchsorted(found.b_ends, found.cuts, "right").tolist()
                    before = i = j = 0
                    for end, k, m in zip(found.cuts.tolist(), x, y, strict=True):
                        # Ranges in the text itself, without the space put before it.
                        owner.append(row)
                        out.append((at, max(start + before - 1, 0), start + end - 1, found.a[i:k], found.b[j:m]))
                        at, before, i, j = at + 1, end, k, m
                    start += before
            columns = [batch.column("key").take(pa.array(owner, pa.int64()))]
            columns += [pa.array([o[k] for o in out], pa.int64()) for k in range(3)]
            columns += [pa.array([o[k] for o in out], pa.list_(pa.int32())) for k in (3, 4)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "at", "start", "end", "a", "b"])

    return rows.mapInArrow(run, f"key {kind}, {schema}")
