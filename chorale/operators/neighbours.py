"""Exact k-nearest-neighbour classification by a pivot index.

Stored rows are dealt to the nearest of a bounded number of pivots. A query
first visits the cells around it, which gives it k candidates and a distance
within which the true k must lie. By the triangle inequality it then visits
only cells that can hold something as near: those whose radius reaches that
far, and that no plane between two pivots cuts off. Cosine distances are
ordered as distances of unit vectors, so the same index serves both.

Visits are made by blocks: a task multiplies a slice of queries with a block of
stored rows and keeps k candidates per query. No pairs are emitted.

Where distances rule out too little (many dimensions, texts), a query does not
travel to cells one by one, but to blocks of neighbouring cells: those with a cell
that can hold something as near. A block's visitors meet it in slices, so it is copied once for each slice. The distances
found at home still decide: a product drops all pairs that are farther, its rounding allowed for, and only the others are computed exactly.
Wide unit vectors are compared in outline first: by the few columns that hold most of their length, and by what length is left,
which bounds what all other columns may add.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.session import materialize

# Rows of a block, most pivots, and most numbers in their matrix (64 MB, which tasks hold a copy of).
BLOCK_ROWS, PIVOTS, PIVOT_CELLS = 512, 2_048, 8_000_000
_DENSE_CELLS = 4_000_000
# Blocks that meet as wholes: their bytes and most rows, and rows multiplied at once.
MEETING_BYTES, MEETING_ROWS, TILE = 32 << 20, 16_384, 1_024
# Bytes that a round of meetings may shuffle: so many times the queries' own, and at least.
ROUND, ROUND_BYTES = 4, 1 << 30
# Visits beyond this share of all pairs are made as meetings; wider vectors go there at once by cosine.
VISIT_SHARE, NARROW = 1 / 16, 1_024
# Columns of an outline, and the share of a tile's pairs that it must leave to stand alone.
OUTLINE, FEW = 16, 1 / 32


def _pack(df: DataFrame, vector: str) -> DataFrame:
    """Columns _i, _v (index and value arrays) and _d (length) of a vector."""
    kind = df.schema[vector].dataType.typeName()
    if kind == "array":
        dense = F.col(vector).cast("array<double>")
        indices = F.sequence(F.lit(0), F.size(dense) - 1)
        return df.withColumns({"_i": indices, "_v": dense, "_d": F.size(dense)})
    return df.withColumns(
        {"_i": F.col(f"{vector}.indices"), "_v": F.col(f"{vector}.values"), "_d": F.col(f"{vector}.size")}
    )


def _dense(pdf: pd.DataFrame, width: int) -> np.ndarray:
    out = np.zeros((len(pdf), width))
    lengths = pdf["_i"].map(len).to_numpy()
    if lengths.sum():
        rows = np.repeat(np.arange(len(pdf)), lengths)
        out[rows, np.concatenate(pdf["_i"].to_numpy())] = np.concatenate(pdf["_v"].to_numpy())
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm == 0, 1.0, norm)


def _exact(q: np.ndarray, s: np.ndarray, rows: np.ndarray, cols: np.ndarray, metric: str) -> np.ndarray:
    """Distances of chosen pairs, term by term, so that equal rows tie exactly."""
    out = np.empty(len(rows))
    step = max(1, _DENSE_CELLS // max(q.shape[1], 1))
    for lo in range(0, len(rows), step):
        a, b = q[rows[lo : lo + step]], s[cols[lo : lo + step]]
        if metric == "cosine":
            out[lo : lo + step] = np.maximum(1.0 - (a * b).sum(axis=1), 0.0)
        else:
            out[lo : lo + step] = np.sqrt(((a - b) ** 2).sum(axis=1))
    return out


def _shortlist(q: np.ndarray, s: np.ndarray, k: int, metric: str):
    """Pairs that may be among the k nearest: a matrix product finds the k-th
    distance up to rounding, and everything within the rounding stays."""
    if metric == "cosine":
        rough, slack = 1.0 - q @ s.T, 1e-9
    else:
        q2, s2 = (q * q).sum(axis=1)[:, None], (s * s).sum(axis=1)[None, :]
        rough, slack = q2 + s2 - 2 * q @ s.T, 1e-9 * (q2 + s2.max() + 1.0)
    if rough.shape[1] <= k:
        return np.nonzero(np.ones_like(rough, dtype=bool))
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k]
    return np.nonzero(rough <= limit + slack)


def _k_best(queries: pd.DataFrame, stored: pd.DataFrame, width: int, k: int, metric: str):
    """(query row, stored position, distance) of the k nearest per query.

    Stored rows arrive sorted by key, so equal distances go to the lower key.
    """
    q = _dense(queries, width)
    if metric == "cosine":
        q = _unit(q)
    row, pos, dist = np.empty(0, int), np.empty(0, int), np.empty(0)
    step = max(1, _DENSE_CELLS // max(width, 1))
    for lo in range(0, len(stored), step):
        s = _dense(stored.iloc[lo : lo + step], width)
        if metric == "cosine":
            s = _unit(s)
        r, c = _shortlist(q, s, k, metric)
        row = np.concatenate([row, r])
        pos = np.concatenate([pos, c + lo])
        dist = np.concatenate([dist, _exact(q, s, r, c, metric)])
        order = np.lexsort((pos, dist, row))
        row, pos, dist = row[order], pos[order], dist[order]
        first = np.searchsorted(row, row, side="left")
        keep = np.arange(len(row)) - first < k
        row, pos, dist = row[keep], pos[keep], dist[keep]
    return row, pos, dist


def _candidates(batches, stored: pd.DataFrame, width: int, k: int, metric: str):
    step = max(1, _DENSE_CELLS // max(width, len(stored), 1))
    labels, keys = stored["_label"].to_numpy(), stored["_key"].to_numpy()
    for pdf in batches:
        for lo in range(0, len(pdf), step):
            part = pdf.iloc[lo : lo + step]
            row, pos, dist = _k_best(part, stored, width, k, metric)
            yield pd.DataFrame(
                {
                    "_q": part["_key"].to_numpy()[row],
                    "neighbour": keys[pos],
                    "label": labels[pos],
                    "distance": dist,
                }
            )


def _indexed(x: np.ndarray, metric: str, side: int) -> np.ndarray:
    """Rows as the index sees them. Zero rows have a cosine distance of one to all: each side gets an axis for its own."""
    if metric != "cosine":
        return x
    own = np.zeros((len(x), 2))
    own[:, side] = ~x.any(axis=1)
    return np.hstack([_unit(x), own])


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squared = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * x @ y.T
    return np.sqrt(np.maximum(squared, 0))


def _slices(batches, width: int, cells: int = _DENSE_CELLS):
    step = max(1, cells // max(width, 1))
    for pdf in batches:
        for lo in range(0, len(pdf), step):
            yield pdf.iloc[lo : lo + step]


def _cells(stored: DataFrame, pivots: np.ndarray, width: int, metric: str, side: int = 0) -> DataFrame:
    """Rows with their cell and their distance to its pivot."""
    kinds = {f.name: f.dataType.simpleString() for f in stored.schema.fields}

    def place(batches):
        for pdf in _slices(batches, max(width, len(pivots))):
            gap = _gaps(_indexed(_dense(pdf, width), metric, side), pivots)
            cell = gap.argmin(axis=1)
            yield pdf.assign(_cell=cell.astype("int32"), _r=gap[np.arange(len(pdf)), cell])

    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    return materialize(stored.mapInPandas(place, f"{schema}, _cell int, _r double"), "cells")


def _asked(
    queries: DataFrame, pivots: np.ndarray, stats: np.ndarray, width: int, metric: str, k: int, kind: str, counted: bool = False
) -> DataFrame:
    """(query, cell) of the visits: those at home, or with ``_tau`` those beyond home that may hold something as near.

    ``stats`` has, by cell, its rows and its radius. With ``counted`` one number for each slice: the pairs of these visits.
    """
    rows, radius = stats
    # What rounding may take from a distance.
    slack = 1e-6 * (1 + float(np.abs(pivots).max(initial=0)) * math.sqrt(width))
    second = "_tau" in queries.columns

    def choose(batches):
        for pdf in _slices(batches, max(width, len(pivots))):
            gap = _gaps(_indexed(_dense(pdf, width), metric, 1), pivots)
            gap[:, rows == 0] = np.inf
            order = np.argsort(gap, axis=1, kind="stable")
            before = np.cumsum(rows[order], axis=1) - rows[order]
            home = np.zeros(gap.shape, bool)
            np.put_along_axis(home, order, before < k, axis=1)
            wanted = home & (rows > 0)
            if second:
                low = np.maximum(gap - radius, (gap - gap.min(axis=1, keepdims=True)) / 2)
                wanted = ~home & (rows > 0) & (low <= pdf["_tau"].to_numpy()[:, None] + slack)
            if counted:
                yield pd.DataFrame({"pairs": [float((wanted @ rows).sum())]})
                continue
            visits = np.nonzero(wanted)
            step = max(1, _DENSE_CELLS // max(width, 1))
            for at in range(0, len(visits[0]), step):
                q, cell = (v[at : at + step] for v in visits)
                yield pd.DataFrame(
                    {"_key": pdf["_key"].to_numpy()[q], "_i": pdf["_i"].to_numpy()[q], "_v": pdf["_v"].to_numpy()[q], "_cell": cell.astype("int32")}
                )

    if counted:
        return queries.mapInPandas(choose, "pairs double")
    return queries.mapInPandas(choose, f"_key {kind}, _i array<int>, _v array<double>, _cell int")


def _visited(
    asked: DataFrame, cells: DataFrame, rows: np.ndarray, width: int, k: int, metric: str, columns: np.ndarray | None, schema: str, name: str
) -> DataFrame:
    """The k best of every visit. Large cells are cut into blocks, and their visitors into slices."""
    spark = cells.sparkSession
    asked = materialize(asked, name)
    visits = {r["_cell"]: r["count"] for r in asked.groupBy("_cell").count().collect()}
    cuts = [(int(c), -(-int(rows[c]) // BLOCK_ROWS), -(-n // BLOCK_ROWS)) for c, n in visits.items()]
    # One row for each pivot at most.
    cuts = F.broadcast(spark.createDataFrame(cuts, "_cell int, _blocks int, _slices int"))

    def part(n: str):
        return F.pmod(F.xxhash64("_key"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = asked.join(cuts, "_cell").select("_key", "_i", "_v", "_cell", part("_slices").alias("_s"), every("_blocks").alias("_b"))
    right = cells.join(cuts, "_cell").select("_key", "_label", "_i", "_v", "_cell", part("_blocks").alias("_b"), every("_slices").alias("_s"))

    def visit(q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if q.empty or s.empty:
            return pd.DataFrame(columns=["_q", "neighbour", "label", "distance"])
        s = s.sort_values("_key", ignore_index=True)
        return pd.concat(_candidates([q], s, width, k, metric), ignore_index=True)

    keys = ["_cell", "_b", "_s"]
    if columns is not None:
        left = left.withColumn("_tau", F.lit(math.inf))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_meeting(width, k, metric, columns), schema)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(visit, schema)


# --- blocks that meet as wholes ------------------------------------------------


def _blocks(df: DataFrame, pivots: np.ndarray) -> tuple[DataFrame, int]:
    """Rows with ``_block``, and the number of blocks: neighbouring cells together, large cells cut by key."""
    each = df.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.sum(12 * F.size("_v") + 64).alias("bytes")).collect()
    size, rows = np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in each:
        size[r["_cell"]], rows[r["_cell"]] = r["bytes"], r["n"]
    gap = _gaps(pivots, pivots)
    # Small tables make enough blocks for all cores.
    most = min(MEETING_ROWS, max(TILE, rows.sum() / math.sqrt(4 * df.sparkSession.sparkContext.defaultParallelism)))
    share, cuts, block, filled, at = np.maximum(size / MEETING_BYTES, rows / most), [], 0, 0.0, 0
    for _ in range(len(pivots)):
        gap[:, at] = np.inf
        if share[at]:
            if filled and filled + share[at] > 1:
                block, filled = block + 1, 0.0
            parts = math.ceil(share[at])
            cuts.append((at, block, parts))
            block, filled = block + parts - 1, filled + share[at] if parts == 1 else 1.0
        at = int(gap[at].argmin())
    # One row for each pivot at most.
    cuts = F.broadcast(df.sparkSession.createDataFrame(cuts, "_cell int, _first int, _parts int"))
    chosen = F.col("_first") + F.pmod(F.xxhash64("_key"), F.col("_parts")).cast("int")
    return df.join(cuts, "_cell").withColumn("_block", chosen).drop("_first", "_parts"), block + 1


def _reaching(reached: DataFrame, pivots: np.ndarray, stats: np.ndarray, width: int, metric: str, kind: str) -> DataFrame:
    """Queries with their cell and, a bit for each, the cells that may hold something as near as ``_tau``; ``_tau`` is then the distance itself."""
    rows, radius = stats
    slack = 1e-6 * (1 + float(np.abs(pivots).max(initial=0)) * math.sqrt(width))

    def choose(batches):
        for pdf in _slices(batches, max(width, len(pivots))):
            gap = _gaps(_indexed(_dense(pdf, width), metric, 1), pivots)
            cell = gap.argmin(axis=1)
            gap[:, rows == 0] = np.inf
            low = np.maximum(gap - radius, (gap - gap.min(axis=1, keepdims=True)) / 2)
            bits = np.packbits(low <= pdf["_tau"].to_numpy()[:, None] + slack, axis=1)
            yield pdf[["_key", "_i", "_v"]].assign(_tau=pdf["_far"], _cell=cell.astype("int32"), _near=[b.tobytes() for b in bits])

    return materialize(reached.mapInPandas(choose, f"_key {kind}, _i array<int>, _v array<double>, _tau double, _cell int, _near binary"), "reaching")


def _blocks_of(cells: DataFrame, count: int, pivots: int):
    """A column with the blocks that hold rows of the cells of ``_near``."""
    holds = np.zeros((pivots, count), np.float32)
    for r in cells.select("_cell", "_block").distinct().collect():
        holds[r["_cell"], r["_block"]] = 1

    @F.pandas_udf("array<int>")
    def found(near: pd.Series) -> pd.Series:
        bits = np.unpackbits(np.frombuffer(b"".join(near), np.uint8).reshape(len(near), -1), axis=1, count=pivots)
        return pd.Series([np.flatnonzero(row).astype("int32") for row in bits.astype(np.float32) @ holds > 0])

    return found("_near")


class _Sparse:
    """Rows of a table as indices and values, one after another."""

    def __init__(self, table: pa.Table, unit: bool) -> None:
        index, value = (table.column(c).combine_chunks() for c in ("_i", "_v"))
        self.n = table.num_rows
        self.at = np.concatenate([[0], np.cumsum(pc.list_value_length(index).to_numpy())]).astype(np.int64)
        self.index, self.value = index.flatten().to_numpy(), value.flatten().to_numpy().astype(float)
        lengths = np.diff(self.at)
        self.row = np.repeat(np.arange(self.n), lengths)
        self.norm = np.sqrt(np.bincount(self.row, self.value**2, self.n))
        self.longest = int(lengths.max(initial=0))
        if unit:
            self.value = self.value / np.where(self.norm == 0, 1.0, self.norm)[self.row]

    def part(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = slice(self.at[lo], self.at[hi])
        return self.row[cut] - lo, self.index[cut], self.value[cut]

    def outline(self, columns: np.ndarray, width: int) -> np.ndarray:
        """Chosen columns of every row, and the length of what is left; a product of two such rows is never below that of the whole rows."""
        to = np.full(width, -1)
        to[columns] = np.arange(len(columns))
        place = to[self.index]
        out, held = np.zeros((self.n, len(columns) + 1)), place >= 0
        out[self.row[held], place[held]] = self.value[held]
        out[:, -1] = np.sqrt(np.bincount(self.row[~held], self.value[~held] ** 2, self.n))
        return out

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``rows``, index, value) of the entries of chosen rows."""
        lengths = self.at[rows + 1] - self.at[rows]
        place = np.repeat(np.arange(len(rows)), lengths)
        entry = np.arange(len(place)) + np.repeat(self.at[rows] - np.cumsum(lengths) + lengths, lengths)
        return place, self.index[entry], self.value[entry]


def _filled(shape: tuple[int, int], entries, kind=float) -> np.ndarray:
    out = np.zeros(shape, kind)
    out[entries[0], entries[1]] = entries[2]
    return out


def _pair_distances(q: _Sparse, s: _Sparse, rows: np.ndarray, cols: np.ndarray, width: int, metric: str) -> np.ndarray:
    """Distances of chosen pairs, term by term, so that equal rows tie exactly. ``rows`` ascend."""
    out, step = np.empty(len(rows)), max(1, _DENSE_CELLS // max(width, 1) // 4)
    # Only the rows are written out, so those of one row go together.
    most = max(step, _DENSE_CELLS // 4 // max(s.longest, q.longest, 1))
    nth, lo = np.cumsum(np.diff(rows, prepend=rows[:1]) != 0), 0
    while lo < len(rows):
        hi = min(lo + most, int(np.searchsorted(nth, nth[lo] + step)))
        own, place = np.unique(rows[lo:hi], return_inverse=True)
        entries = q.take(own)
        a = _filled((len(own), width), entries)
        b = s.take(cols[lo:hi])
        met = a[place[b[0]], b[1]]
        if metric == "cosine":
            dot = np.bincount(b[0], met * b[2], len(place))
            out[lo:hi] = np.maximum(1.0 - dot, 0.0)
        else:
            # The gaps where the other has an entry, and what a row has besides: its entries without those met.
            at = np.zeros((len(own), width), np.int32)
            lengths = np.bincount(entries[0], minlength=len(own))
            first = np.cumsum(lengths) - lengths
            at[entries[0], entries[1]] = np.arange(len(entries[0])) - first[entries[0]] + 1
            many = lengths[place]
            begin = np.cumsum(many) - many
            pair = np.repeat(np.arange(len(place)), many)
            beside = entries[2][np.arange(len(pair)) - begin[pair] + first[place][pair]]
            hit = at[place[b[0]], b[1]]
            beside[(begin[b[0]] + hit - 1)[hit > 0]] = 0
            gap = met - b[2]
            out[lo:hi] = np.sqrt(np.bincount(b[0], gap * gap, len(place)) + np.bincount(pair, beside * beside, len(place)))
        lo = hi
    return out


def _kth(near: np.ndarray, k: int) -> np.ndarray | float:
    """The k-th largest of each row."""
    return np.partition(near, -k, axis=1)[:, -k] if near.shape[1] >= k else -np.inf


def _tile(q: _Sparse, s: _Sparse, rows: tuple[int, int], cols: tuple[int, int], width: int, tau: np.ndarray, k: int, metric: str, outlines=None):
    """Pairs of a tile that may be within ``tau``, by a product of outlines or else over the columns both sides use.

    Unit vectors are multiplied in single precision; lengths may be far greater than distances, so others in double, and so
    are outlines, as distances between them may be below the rounding of single numbers. Bounds of k pairs lower ``tau``."""
    rough, limit = None, tau[slice(*rows)]
    if outlines:
        left, right = outlines[0][slice(*rows)], outlines[1][slice(*cols)]
        near, wide = left @ right.T, (q.longest + s.longest + 8) * 2.0**-50
        if np.isinf(limit).any():
            # What is left of two rows may also point opposite ways.
            np.minimum(limit, 1 - _kth(near - 2 * np.outer(left[:, -1], right[:, -1]), k) + wide, out=limit)
        rough = near >= (1 - limit - wide)[:, None]
        if np.count_nonzero(rough) <= FEW * rough.size:
            return np.nonzero(rough)
    a, b = q.part(*rows), s.part(*cols)
    shape = rows[1] - rows[0], cols[1] - cols[0]
    scale, used, kind = 1.0, width, np.float32 if metric == "cosine" else np.float64
    if metric != "cosine":
        # Numbers of one at most, as the rounding below supposes.
        scale = max(q.norm[slice(*rows)].max(), s.norm[slice(*cols)].max()) or 1.0
    if width > NARROW:
        seen = np.zeros((2, width), bool)
        seen[0, a[1]] = seen[1, b[1]] = True
        columns = np.flatnonzero(seen.all(axis=0))
        to, used = np.full(width, -1, np.int32), len(columns)
        to[columns] = np.arange(used)
        a, b = ((x[0][(c := to[x[1]]) >= 0], c[c >= 0], x[2][c >= 0]) for x in (a, b))
    left, right = (_filled((n, used), (x[0], x[1], x[2] / scale), kind) for n, x in zip(shape, (a, b)))
    near = left @ right.T
    # As many terms as the shorter row has, each rounded, and the numbers themselves.
    slack = (min(q.longest, s.longest) + 8) * 2.0 ** (-23 if metric == "cosine" else -52)
    if metric == "cosine":
        if outlines:
            np.minimum(limit, 1 - _kth(near, k) + slack + 1e-9, out=limit)
        near = near >= (1 - limit - slack - 1e-9)[:, None].astype(np.float32)
        return np.nonzero(near if rough is None else near & rough)
    own, other = ((x.norm[slice(*cut)] / scale) ** 2 for x, cut in ((q, rows), (s, cols)))
    # 2 q s >= q^2 + s^2 - tau^2, where numbers are at most one.
    bound = own / 2 - (limit / scale * (1 + 1e-9)) ** 2 / 2 - 3 * slack
    near -= other / 2
    return np.nonzero(near >= bound[:, None])


def _meeting(width: int, k: int, metric: str, columns: np.ndarray | None):
    """The k best of the rows of two tables that meet, no farther than ``_tau``; with ``columns``, by outlines first."""

    def meet(own: pa.Table, other: pa.Table) -> pa.Table:
        own, other = own.sort_by("_cell"), other.sort_by("_cell")
        found = []
        if own.num_rows and other.num_rows:
            q, s = _Sparse(own, metric == "cosine"), _Sparse(other, metric == "cosine")
            outlines = None if columns is None else (q.outline(columns, width), s.outline(columns, width))
            tau = own.column("_tau").to_numpy().copy()
            rank = np.empty(s.n, np.int64)
            rank[pc.sort_indices(other.column("_key").combine_chunks()).to_numpy()] = np.arange(s.n)
            for lo in range(0, q.n, TILE):
                rows = lo, min(lo + TILE, q.n)
                row, col, dist = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
                for at in range(0, s.n, TILE):
                    r, c = _tile(q, s, rows, (at, min(at + TILE, s.n)), width, tau, k, metric, outlines)
                    if not len(r):
                        continue
                    r, c = r + lo, c + at
                    row, col = np.concatenate([row, r]), np.concatenate([col, c])
                    dist = np.concatenate([dist, _pair_distances(q, s, r, c, width, metric)])
                    order = np.lexsort((rank[col], dist, row))
                    row, col, dist = row[order], col[order], dist[order]
                    place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                    # What k rows are nearer than need not be looked at again.
                    last = place == k - 1
                    tau[row[last]] = np.minimum(tau[row[last]], dist[last])
                    row, col, dist = row[place < k], col[place < k], dist[place < k]
                found.append((row, col, dist))
        row, col, dist = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
        return pa.table(
            [own.column("_key").take(row), other.column("_key").take(col), other.column("_label").take(col), pa.array(dist, pa.float64())],
            names=["_q", "neighbour", "label", "distance"],
        )

    return meet


def _met(
    reached: DataFrame, cells: DataFrame, pivots: np.ndarray, stats: np.ndarray, width: int, k: int, metric: str, columns: np.ndarray | None,
    kind: str, schema: str,
) -> DataFrame:
    """The k best of every meeting of a block of stored rows and a slice of the queries that it may hold something for."""
    reaching = _reaching(reached, pivots, stats, width, metric, kind)
    (left, _), (right, count) = _blocks(reaching, pivots), _blocks(cells, pivots)
    left = left.withColumnRenamed("_block", "_a").withColumn("_to", _blocks_of(right, count, len(pivots))).drop("_near")
    sent = materialize(left, "sent")
    own = sent.agg(F.sum(12 * F.size("_v") + 64)).first()[0] or 0
    left = sent.withColumn("_block", F.explode("_to")).drop("_to")
    # One row for every two blocks at most. Neighbouring blocks of queries share a slice as far as they fit.
    visits = left.groupBy("_block", "_a").agg(F.count(F.lit(1)).alias("n"), F.sum(12 * F.size("_v") + 64).alias("bytes")).collect()
    slices, block, filled = [], None, 0.0
    most = max([min(TILE, MEETING_ROWS), *(r["n"] for r in visits)])
    for r in sorted(visits, key=lambda r: (r["_block"], r["_a"])):
        share = max(r["n"] / most, r["bytes"] / MEETING_BYTES)
        if r["_block"] != block:
            block, filled, at = r["_block"], 0.0, 0
        elif filled + share > 1:
            filled, at = 0.0, at + 1
        filled += share
        slices.append((block, r["_a"], at))
    spark = reached.sparkSession
    copies = sorted({(block, at) for block, _, at in slices})
    held = spark.createDataFrame(copies, "_block int, _s int")
    left = left.join(F.broadcast(spark.createDataFrame(slices, "_block int, _a int, _s int")), ["_block", "_a"]).drop("_a")
    right = right.join(F.broadcast(held), "_block").select("_key", "_label", "_i", "_v", "_cell", "_block", "_s")
    keys = ["_block", "_s"]

    def meet(some):
        a, b = (side.filter(some).groupBy(*keys) for side in (left, right))
        return a.cogroup(b).applyInArrow(_meeting(width, k, metric, columns), schema)

    # Each round's copies go when its k best are written, so disk does not grow with all that is sent.
    rounds = _rounds(visits, copies, max(ROUND_BYTES, ROUND * own))
    if len(rounds) < 2:
        return meet(F.lit(True))
    return reduce(DataFrame.unionByName, [materialize(_merged(meet(F.col("_block").between(*ends)), k), "met") for ends in rounds])


def _rounds(visits: list, copies: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """First and last blocks of rounds that send about ``most`` bytes, a block at least."""
    sent: dict[int, int] = {}
    for r in visits:
        sent[r["_block"]] = sent.get(r["_block"], 0) + r["bytes"]
    for block, _ in copies:
        sent[block] += MEETING_BYTES
    rounds, filled = [], 0
    for block in sorted(sent):
        if rounds and filled + sent[block] <= most:
            rounds[-1] = rounds[-1][0], block
        else:
            rounds.append((block, block))
            filled = 0
        filled += sent[block]
    return rounds


def nearest(
    stored: DataFrame,
    queries: DataFrame,
    vector: str,
    label: str,
    key: str,
    k: int,
    metric: str = "euclidean",
) -> DataFrame:
    """(key, neighbour, label, distance): the k nearest stored rows per query; of equal distances, the lower keys.

    Keys of queries are distinct, and so are those of stored rows.
    """
    kind = queries.schema[key].dataType.simpleString()
    stored = _pack(stored, vector).select(
        F.col(key).alias("_key"), F.col(label).cast("string").alias("_label"), "_i", "_v", "_d"
    )
    stored = materialize(stored, "stored")
    queries = materialize(_pack(queries, vector).select(F.col(key).alias("_key"), "_i", "_v"), "queries")
    size = stored.agg(F.count(F.lit(1)).alias("n"), F.max("_d").alias("d")).first()
    schema = f"_q {kind}, neighbour {kind}, label string, distance double"
    if not size["n"]:
        return stored.sparkSession.createDataFrame([], schema).withColumnRenamed("_q", key)
    width, stored = size["d"], stored.drop("_d")
    most = max(1, min(PIVOTS, PIVOT_CELLS // max(width, 1), math.ceil(size["n"] / BLOCK_ROWS)))
    drawn = stored.orderBy(F.xxhash64("_key"), "_key").limit(most).select("_i", "_v").toPandas()
    pivots = _indexed(_dense(drawn, width), metric, 0)
    cells = _cells(stored, pivots, width, metric)
    stats = np.zeros((2, len(pivots)))
    for r in cells.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_r").alias("r")).collect():
        stats[:, r["_cell"]] = r["n"], r["r"]
    at_once = width > NARROW and metric == "cosine"
    # The columns that hold most of the pivots' length; which they are decides the work, not the result.
    columns = np.argsort(-(pivots[:, :width] ** 2).sum(axis=0), kind="stable")[:OUTLINE] if at_once else None
    common = (cells, stats[0], width, k, metric, columns, schema)
    home = _merged(_visited(_asked(queries, pivots, stats, width, metric, k, kind), *common, "visits"), k)
    if len(pivots) == 1:
        return home.withColumnRenamed("_q", key)
    home = materialize(home, "home")
    # The k-th distance so far bounds the true one; a cosine distance as one of unit vectors.
    far = F.max("distance") if metric != "cosine" else F.sqrt(2 * F.max("distance"))
    reach = home.groupBy("_q").agg(far.alias("_tau"), F.max("distance").alias("_far")).withColumnRenamed("_q", "_key")
    reached = materialize(queries.join(reach, "_key"), "reach")
    common_asked = (pivots, stats, width, metric, k, kind)
    if not at_once:
        pairs = _asked(reached, *common_asked, counted=True).agg(F.sum("pairs")).first()[0] or 0
    if at_once or pairs > VISIT_SHARE * size["n"] * reached.count():
        return _merged(_met(reached, cells, pivots, stats, width, k, metric, columns, kind, schema), k).withColumnRenamed("_q", key)
    beyond = _asked(reached, *common_asked)
    found = home.unionByName(_visited(beyond, *common, "visits"))
    return _merged(found, k).withColumnRenamed("_q", key)


def _merged(visits: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("_q").orderBy("distance", "neighbour"))
    return visits.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def vote(neighbours: DataFrame, key: str) -> DataFrame:
    """(key, prediction): votes weigh 1 / distance.

    A neighbour at distance zero outweighs all that are not. Ties go to the
    lower label.
    """
    weight = F.when(F.col("distance") > 0, 1 / F.col("distance")).otherwise(0.0)
    tally = neighbours.groupBy(key, "label").agg(
        F.count_if(F.col("distance") == 0).alias("exact"), F.sum(weight).alias("weight")
    )
    far = F.when(F.col("exact") == 0, -F.col("weight")).otherwise(0.0)
    best = F.min(F.struct((-F.col("exact")).alias("e"), far.alias("w"), "label"))
    return tally.groupBy(key).agg(best["label"].alias("prediction"))


def knn_predict(
    stored: DataFrame,
    queries: DataFrame,
    vector: str,
    label: str,
    key: str,
    k: int = 15,
    metric: str = "euclidean",
) -> DataFrame:
    """(key, prediction) for every query row."""
    return vote(nearest(stored, queries, vector, label, key, k, metric), key)
