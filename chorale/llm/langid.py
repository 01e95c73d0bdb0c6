"""Languages of mixed documents: EM over n-gram likelihoods with a penalty on the set.

Training counts hashed character n-grams (1 to 4 bytes of the lower-cased
letters) per language over all training rows; tables of counts are added up in
blocks, in Spark. A document is then read in short stretches. A stretch has a
likelihood in every language, and expectation-maximisation finds the shares of
languages that explain all stretches best. A document's set starts with its likeliest
language and grows by the one that gains most, while the gain exceeds its penalty;
languages that no longer earn theirs then leave.

The model has ``CELLS`` numbers per language, whatever the size of the corpus.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and no shares; ties go to the language first in order; repeated rows count as
often as they occur; without training rows all is ``und``; other columns are
ignored; texts of any length are read in stretches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import pieces

# Cells of the n-gram table, cells per block when adding up, and n-gram lengths.
CELLS, BLOCK = 1 << 16, 1 << 12
ORDERS = (1, 2, 3, 4)
# Bytes in a stretch with one likelihood, and in what is worked on at once.
STRETCH, SLICE = 48, 1 << 19
# EM ends where no share changes by more; what a language must gain per log(stretches).
TOLERANCE, PENALTY = 1e-4, 3.0
UNKNOWN = "und"

# Letters in lower case; bytes beyond ASCII as they are; all others are one mark.
_FOLD = np.full(256, 32, np.uint8)
for _b in range(256):
    if _b >= 128 or chr(_b).isalpha():
        _FOLD[_b] = ord(chr(_b).lower()) if _b < 128 else _b


def _cells(text: np.ndarray) -> list[np.ndarray]:
    """For each n-gram length, the cell of the n-gram that ends at each byte."""
    folded = _FOLD[text].astype(np.uint32)
    out, h = [], np.zeros(folded.size, np.uint32)
    for n in ORDERS:
        # The n-gram that ends here: the one shorter that ended one byte before, and this byte.
        longer = np.zeros_like(h)
        longer[1:] = h[:-1]
        h = (longer * np.uint32(257) + folded + np.uint32(n)) * np.uint32(2654435761)
        out.append((h >> np.uint32(16)).astype(np.int32))
    return out


def _slices(text: bytes) -> Iterator[np.ndarray]:
    for at in range(0, len(text), SLICE):
        yield np.frombuffer(text, np.uint8, min(SLICE, len(text) - at), at)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language and block, the counts of this task."""
    tables: dict[str, np.ndarray] = {}
    for batch in pieces(batches, "text"):
        langs = batch.column("lang").to_pylist()
        grouped: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, batch.column("text").to_pylist(), strict=True):
            grouped.setdefault(lang, []).append(text)
        for lang, texts in grouped.items():
            table = tables.setdefault(lang, np.zeros(CELLS, np.int64))
            for part in _slices(b" ".join(texts)):
                for cells in _cells(part):
                    table += np.bincount(cells, minlength=CELLS)
    for lang, table in tables.items():
        blocks = table.reshape(-1, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(blocks)), pa.array(range(len(blocks)), pa.int32()), pa.array(list(blocks), pa.list_(pa.int64()))],
            names=["lang", "block", "counts"],
        )


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BLOCK, np.int64)
    for batch in batches:
        total += batch.column("counts").flatten().to_numpy().reshape(-1, BLOCK).sum(axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([total], pa.list_(pa.int64()))],
        names=["lang", "block", "counts"],
    )


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages in order and their log-probabilities per cell, from every labelled row."""
    rows = train.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("text"))
    schema = "lang string, block int, counts array<long>"
    counted = rows.mapInArrow(_counter, schema)
    added = counted.groupBy("lang", "block").applyInArrow(_added, schema)
    # A language has CELLS / BLOCK rows.
    found = added.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    logp = np.zeros((len(langs), CELLS), np.float32)
    totals = np.zeros(len(langs))
    place = {x: i for i, x in enumerate(langs)}
    for batch in found.to_batches():
        for name, block, own in zip(batch.column("lang").to_pylist(), batch.column("block").to_pylist(), batch.column("counts"), strict=True):
            smoothed = own.values.to_numpy() + 0.5
            at = block * BLOCK
            logp[place[name], at : at + BLOCK] = np.log(smoothed)
            totals[place[name]] += smoothed.sum()
    if langs:
        logp -= np.log(totals)[:, None].astype(np.float32)
    return langs, logp


def _stretch_scores(texts: list[bytes], logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretches, languages): summed log-likelihood of the n-grams that end in each stretch.

    Also, where each text's stretches begin. ``logp`` has a row per language.
    """
    # A few spaces before each text keep it apart from the one before; they are a stretch that is left out.
    apart = max(ORDERS)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + apart)
    begins = ends - sizes
    joined = np.frombuffer((b" " * apart).join([b"", *texts]), np.uint8)
    counts = -(-sizes // STRETCH)
    first = np.cumsum(counts + 1) - counts
    edges = np.repeat(begins - (first * STRETCH), counts + 1)
    edges += np.arange(edges.size) * STRETCH
    edges[first - 1] = begins - apart
    out = np.empty((len(logp), edges.size), np.float32)
    at = 0
    while at < edges.size:
        upto = max(at + 1, int(np.searchsorted(edges, edges[at] + SLICE)))
        low = int(edges[at])
        high = int(edges[upto]) if upto < edges.size else joined.size
        before = min(low, apart - 1)
        cells = [c[before:] for c in _cells(joined[low - before : high])]
        for k, table in enumerate(logp):
            total = table[cells[0]]
            for c in cells[1:]:
                total += table[c]
            out[k, at:upto] = np.add.reduceat(total, edges[at:upto] - low)
        at = upto
    kept = np.ones(edges.size, bool)
    kept[first - 1] = False
    return out.T[kept], np.cumsum(counts) - counts


def _shares(like: np.ndarray, first: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for all documents at once: shares (documents, languages) and log-likelihoods.

    ``like`` holds stretches' likelihoods relative to their best language,
    ``first`` where each document's stretches begin, ``start`` the shares to
    begin with: languages at 0 stay out. A document leaves when its shares have
    settled; each round brings the likelihood nearer to its one maximum.
    """
    sizes = np.diff(first, append=len(like))
    shares = start / start.sum(axis=1, keepdims=True)
    under = np.arange(first.size)
    own, begin = like, first
    while under.size:
        size = sizes[under]
        joint = own * np.repeat(shares[under], size, axis=0)
        joint /= joint.sum(axis=1, keepdims=True) + 1e-300
        new = np.add.reduceat(joint, begin, axis=0) / size[:, None]
        moving = np.abs(new - shares[under]).max(axis=1) > TOLERANCE
        shares[under] = new
        if not moving.all():
            own = own[np.repeat(moving, size)]
            under = under[moving]
            begin = np.cumsum(sizes[under]) - sizes[under]
    mixed = np.log((like * np.repeat(shares, sizes, axis=0)).sum(axis=1) + 1e-300)
    return shares, np.add.reduceat(mixed, first)


def infer(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Shares of the chosen language set for every document."""
    n, k = first.size, scores.shape[1]
    sizes = np.diff(first, append=len(scores))
    # Where one language is the best of every stretch, no mixture can be likelier: it has it all.
    leader = scores.argmax(axis=1)
    plain = np.maximum.reduceat(leader, first) == np.minimum.reduceat(leader, first)
    if plain.any():
        shares = np.zeros((n, k))
        shares[plain, leader[first[plain]]] = 1.0
        if not plain.all():
            rest = ~np.repeat(plain, sizes)
            own = sizes[~plain]
            shares[~plain] = infer(scores[rest], np.cumsum(own) - own)
        return shares
    best = scores.max(axis=1, keepdims=True)
    like = np.exp((scores - best).astype(np.float64))
    # The likeliest language alone, then one more at a time: that whose share grows from 0 the most in likelihood.
    alone = np.add.reduceat((scores - best).astype(np.float64), first, axis=0)
    chosen = np.zeros((n, k))
    chosen[np.arange(n), alone.argmax(axis=1)] = 1.0
    top = alone.max(axis=1)
    under = np.arange(n)
    own, begin = like, first
    while under.size:
        size, have = sizes[under], chosen[under]
        # Of each candidate, the likelihood when it takes an even share beside those chosen.
        mixed = (own * np.repeat(have, size, axis=0)).sum(axis=1, keepdims=True)
        part = 1 / ((have > 0).sum(axis=1) + 1)
        part = np.repeat(part, size)[:, None]
        gain = np.add.reduceat(np.log((1 - part) * mixed + part * own + 1e-300), begin, axis=0)
        gain[have > 0] = -np.inf
        more = have.copy()
        at = np.arange(under.size), gain.argmax(axis=1)
        open_ = np.isfinite(gain[at])
        count = (have > 0).sum(axis=1)
        more *= (count / (count + 1))[:, None]
        more[at] = np.where(open_, 1 / (count + 1), more[at])
        shares, fit_ = _shares(own, begin, more)
        value = fit_ - PENALTY * (1 + np.log(size)) * count
        better = open_ & (value > top[under])
        chosen[under[better]], top[under[better]] = shares[better], value[better]
        own = own[np.repeat(better, size)]
        under = under[better]
        begin = np.cumsum(sizes[under]) - sizes[under]
    # A language that later ones have explained away goes again.
    under = np.flatnonzero((chosen > 0).sum(axis=1) > 2)
    while under.size:
        size, less = sizes[under], chosen[under]
        count = (less > 0).sum(axis=1)
        less[np.arange(under.size), np.where(less > 0, less, np.inf).argmin(axis=1)] = 0
        own = like[np.repeat(np.isin(np.arange(n), under), sizes)]
        shares, fit_ = _shares(own, np.cumsum(size) - size, less)
        value = fit_ - PENALTY * (1 + np.log(size)) * (count - 2)
        better = value > top[under]
        chosen[under[better]], top[under[better]] = shares[better], value[better]
        under = under[better & (count > 3)]
    return chosen


def _judged(texts: list[str | None], langs: list[str], logp: np.ndarray) -> tuple[list[str], list[float], list[np.ndarray | None]]:
    """Language, its share, and all shares, of each text."""
    # A letter: any of the alphabet, in whatever script.
    live = [i for i, t in enumerate(texts) if t and langs and any(map(str.isalpha, t))]
    pred, score, mix = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
    if live:
        shares = infer(*_stretch_scores([texts[i].encode(errors="replace") for i in live], logp))
        for i, own in zip(live, shares, strict=True):
            at = int(own.argmax())
            pred[i], score[i], mix[i] = langs[at], min(1.0, float(own[at])), own
    return pred, score, mix


def _predictor(langs: list[str], model, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = model.value
        for batch in pieces(batches, "text"):
            pred, score, shares = _judged(batch.column("text").to_pylist(), langs, logp)
            mix = [
                [] if own is None else [{"lang": langs[j], "share": float(own[j])} for j in np.flatnonzero(own > 1e-9)]
                for own in shares
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(pred), pa.array(score, pa.float64()), pa.array(mix, schema.field("shares").type)],
                schema=schema,
            )

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, lang_pred, score (the share of that language) and shares of the chosen set."""
    langs, logp = model
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    held = rows.sparkSession.sparkContext.broadcast(logp)
    from pyspark.sql.pandas.types import to_arrow_type

    shares = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    schema = pa.schema([("key", to_arrow_type(kind)), ("lang_pred", pa.string()), ("score", pa.float64()), ("shares", shares)])
    spark_schema = f"key {kind.simpleString()}, lang_pred string, score double, shares array<struct<lang:string,share:double>>"
    return rows.mapInArrow(_predictor(langs, held, schema), spark_schema)


def identified(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that have a language, as they are; no row moves."""
    langs, logp = model
    held = docs.sparkSession.sparkContext.broadcast(logp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            pred, _, _ = _judged(batch.column(text).to_pylist(), langs, held.value)
            yield batch.filter(pa.array([p != UNKNOWN for p in pred], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def remainder(key: str, parts: int) -> Column:
    """The fold of a row: a digest of its key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts
