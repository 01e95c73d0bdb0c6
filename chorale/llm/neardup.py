"""Near duplicates among embeddings by NN-descent.

1. Equal vectors of a label are one class; only classes go on. For the search a
   vector is its int8 rounding, whose distance to the vector is kept: it bounds
   how far a cosine of two roundings can be off.
2. Every class starts with the neighbours it finds in a few blocks, cut by the
   signs of random projections, as many as its label's size asks for.
3. A round refines the lists: each class goes to all its neighbours, and those
   who meet there, neighbours of a neighbour, are compared. A place where more than
   ``MEET`` meet is split at random, anew in every round.
4. A list full of links is saturated and doubles, up to ``MOST``. A saturated list
   keeps its nearest and its farthest links, so that groups of near copies stay tied to each other.
5. Each round is audited: a bounded sample of classes is compared with all
   vectors, and rounds go on, with new start blocks if they must, until the lists that are not
   saturated hold the share ``RECALL`` of their links.
6. Edges above the threshold stay. What the bound leaves open is decided by the
   cosine in double precision. Components follow by repeated minima.
7. Links between saturated classes of a component, too many for lists, are
   counted exactly, block against block, without listing pairs.

Cosines compare vectors of equal label and length only.

Defined results: a null label, and a vector that is null, empty, zero, or holds
null or non-finite numbers, link with nothing; rows with equal vectors, repeated rows too,
link with each other, each counted; null keys come last in naming a component; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import ranked, salted
from chorale.llm.jaccard import components
from chorale.session import materialize

# First and last size of a list, classes in a start block, start blocks of a class, and classes that meet at one place.
FIRST, MOST, LEAF, STARTS, MEET = 16, 64, 256, 4, 64
# Classes in the audit's sample, the share of links to be found, and rounds without it before giving up.
AUDIT, RECALL, ROUNDS = 1024, 0.99, 12
# Vectors in a block of saturated classes.
TILE = 256


@dataclass(frozen=True)
class Neighbours:
    """``nodes``: node, key, rows, gid, n, unit, code, err. ``lists``: node, k, ids, sims. ``recall``: as audited."""

    nodes: DataFrame
    lists: DataFrame
    threshold: float
    band: float
    recall: float
    rounds: int


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vector (double), its int8 rounding, the rounding's distance, and a digest of label and vector."""
    for batch in batches:
        labels = batch.column("tag").to_pylist()
        out = []
        for label, vector in zip(labels, batch.column("vector").to_pylist(), strict=True):
            x = None if label is None or not vector or None in vector else np.array(vector, np.float64)
            if x is None or not np.isfinite(x).all() or not x.any():
                out.append((None,) * 5)
                continue
            unit = x / np.abs(x).max()
            code = np.rint(unit * 127)
            unit /= np.linalg.norm(unit)
            err = float(np.linalg.norm(unit - code / np.linalg.norm(code)))
            # Zero has two signs.
            digest = hashlib.sha256(f"{label}|".encode() + (x + 0.0).tobytes()).digest()
            out.append((x.size, digest, unit.tobytes(), code.astype(np.int8).tobytes(), err))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64())
        columns = [batch.column("key"), batch.column("row"), batch.column("tag")]
        columns += [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "row", "tag", "width", "digest", "unit", "code", "err"])


def _keep(ids: np.ndarray, sims: np.ndarray, k: int, floor: float) -> np.ndarray:
    """Places of the ``k`` to keep: the nearest; of more than ``k`` links, the nearest and the farthest."""
    order = np.lexsort((ids, -sims))
    links = int(np.count_nonzero(sims >= floor))
    if links > k:
        return np.concatenate([order[: k // 2], order[links - (k - k // 2) : links]])
    return order[:k]


def _list_columns(node: list, k: list, ids: list, sims: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(node, pa.int64()), pa.array(k, pa.int32()), pa.array(ids, pa.list_(pa.int64())),
            pa.array(sims, pa.list_(pa.float32())),
        ],
        names=["node", "k", "ids", "sims"],
    )


def _met(floor: float):
    """Compare all who meet at one place; to each, those that its list may take."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("who")
            edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            who = lists.flatten()
            node, worst, k = (who.field(c).to_numpy() for c in ("node", "worst", "k"))
            codes = who.field("code").to_pylist()
            out: tuple[list, list, list, list] = ([], [], [], [])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                x = np.frombuffer(b"".join(codes[a:b]), np.int8).reshape(b - a, -1).astype(np.float32)
                one = 1 / np.sqrt((x * x).sum(axis=1))
                sims = (x @ x.T) * np.outer(one, one)
                np.fill_diagonal(sims, -2)
                better = sims > worst[a:b, None]
                names = node[a:b]
                for i in np.flatnonzero(better.any(axis=1)).tolist():
                    at = np.flatnonzero(better[i])
                    at = at[_keep(names[at], sims[i, at], int(k[a + i]), floor)]
                    out[0].append(names[i])
                    out[1].append(0)
                    out[2].append(names[at])
                    out[3].append(sims[i, at])
            yield _list_columns(*out)

    return run


def _merged(floor: float, most: int):
    """One list of each class out of its own and all it was sent; a saturated one doubles up to ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for node, k, parts in zip(*(batch.column(c).to_pylist() for c in ("node", "k", "parts")), strict=True):
                ids = np.concatenate([np.array(p["ids"], np.int64) for p in parts])
                sims = np.concatenate([np.array(p["sims"], np.float32) for p in parts])
                ids, at = np.unique(ids, return_index=True)
                sims = sims[at]
                if k < most and np.count_nonzero(sims >= floor) >= k:
                    k *= 2
                at = _keep(ids, sims, k, floor)
                out[0].append(node)
                out[1].append(k)
                out[2].append(ids[at])
                out[3].append(sims[at])
            yield _list_columns(*out)

    return run


def _refined(lists: DataFrame, members: DataFrame, most: int, seed: int, floor: float) -> DataFrame:
    """``lists`` after all ``members`` (place, node, code, worst, k) of a place, at most about ``most``, were compared."""
    crowds = materialize(members.groupBy("place").count().filter(F.col("count") > most), "crowds")
    parted = salted(members, crowds, ["place"], "node", "left")
    part = F.pmod(F.xxhash64("node", F.lit(seed)), F.coalesce(F.ceil(F.col("count") / most), F.lit(1)))
    met = parted.groupBy("place", part.alias("part")).agg(F.collect_list(F.struct("node", "code", "worst", "k")).alias("who"))
    schema = "node long, k int, ids array<long>, sims array<float>"
    sent = met.select("who").mapInArrow(_met(floor), schema)
    joined = lists.unionByName(sent).groupBy("node").agg(F.max("k").alias("k"), F.collect_list(F.struct("ids", "sims")).alias("parts"))
    return materialize(joined.mapInArrow(_merged(floor, MOST), schema), "lists")


def _started(lists: DataFrame, nodes: DataFrame, first: int, floor: float) -> DataFrame:
    """``lists`` after comparisons in ``STARTS`` sign blocks of each class."""
    seeds, leaf = range(first, first + STARTS), LEAF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for code, n in zip(batch.column("code").to_pylist(), batch.column("n").to_pylist(), strict=True):
                x = np.frombuffer(code, np.int8).astype(np.float64)
                bits = max(0, math.ceil(math.log2(n / leaf)))
                keys.append([(s, int(((_planes(s, x.size, bits) @ x) > 0) @ (1 << np.arange(bits)))) for s in seeds])
            struct = pa.list_(pa.struct([("seed", pa.int32()), ("signs", pa.int64())]))
            keys = pa.array([[{"seed": s, "signs": v} for s, v in row] for row in keys], struct)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("gid", "node", "code")), keys], names=["gid", "node", "code", "keys"])

    placed = nodes.select("gid", "node", "code", "n").mapInArrow(
        run, "gid long, node long, code binary, keys array<struct<seed:int,signs:long>>"
    )
    members = placed.select("gid", "node", "code", F.explode("keys").alias("s")).select(
        F.struct("gid", "s.seed", "s.signs").alias("place"), "node", "code",
        F.lit(-2.0).cast("float").alias("worst"), F.lit(FIRST).alias("k"),
    )
    return _refined(lists, materialize(members, "starts"), 2 * LEAF, first, floor)


_KNOWN_PLANES: dict[tuple, np.ndarray] = {}


def _planes(seed: int, width: int, bits: int) -> np.ndarray:
    """The first ``bits`` (62 at most) of a seed's projections."""
    if (seed, width) not in _KNOWN_PLANES:
        if len(_KNOWN_PLANES) > 64:
            _KNOWN_PLANES.clear()
        _KNOWN_PLANES[seed, width] = np.random.default_rng(seed).standard_normal((62, width))
    return _KNOWN_PLANES[seed, width][:bits]


def _round(lists: DataFrame, nodes: DataFrame, seed: int, floor: float) -> DataFrame:
    """Every class goes to its neighbours, and stays at its own place."""
    links = F.size(F.filter("sims", lambda s: s >= floor))
    # What beats the worst entry of a full list; of a saturated one, any link.
    worst = F.when(links >= F.col("k"), F.lit(floor)).when(F.size("ids") >= F.col("k"), F.array_min("sims")).otherwise(-2.0)
    own = lists.select("node", "k", "ids", worst.cast("float").alias("worst")).join(nodes.select("node", "code"), "node")
    members = own.select(F.explode(F.concat("ids", F.array("node"))).alias("place"), "node", "code", "worst", "k")
    return _refined(lists, members, MEET, seed, floor)


class _Audit:
    """How many links a bounded sample of classes has, by comparing it with all vectors."""

    def __init__(self, nodes: DataFrame, threshold: float):
        rows = nodes.orderBy(F.xxhash64("node", F.lit(7)), "node").limit(AUDIT).select("node", "gid", "width", "unit").collect()
        self.nodes, self.threshold = nodes, threshold
        by_width: dict[int, list] = {}
        for i, r in enumerate(rows):
            by_width.setdefault(r["width"], []).append((i, r["gid"], np.frombuffer(r["unit"], np.float64)))
        sample = {w: tuple(map(np.array, zip(*v))) for w, v in by_width.items()}
        held, n = nodes.sparkSession.sparkContext.broadcast(sample), len(rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(n, np.int64)
            for batch in batches:
                widths = batch.column("width").to_numpy()
                gids, units = batch.column("gid").to_numpy(), batch.column("unit")
                for width, (at, groups, vectors) in held.value.items():
                    mine = np.flatnonzero(widths == width)
                    if mine.size:
                        x = np.frombuffer(b"".join(units.take(pa.array(mine)).to_pylist()), np.float64).reshape(-1, width)
                        linked = (x @ vectors.T >= threshold) & (gids[mine][:, None] == groups[None])
                        total[at] += linked.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array(total)], names=["i", "n"])

        counted = nodes.select("width", "gid", "unit").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n"))
        # A class always meets itself.
        self.truth = {rows[r["i"]]["node"]: r["n"] - 1 for r in counted.collect()}
        units = [(r["node"], r["unit"]) for r in rows]
        self.sample = nodes.sparkSession.createDataFrame(units, "node long, mine binary")

    def recall(self, lists: DataFrame, floor: float) -> float:
        """The share found of the sample's links, but for saturated classes, whose links are counted in full later."""
        open_ones = lists.filter(F.size(F.filter("sims", lambda s: s >= floor)) < F.col("k"))
        asked = open_ones.join(F.broadcast(self.sample), "node").select("node", "mine", F.explode_outer("ids").alias("other"))
        # At most AUDIT times MOST rows.
        asked = F.broadcast(materialize(asked, "audited"))
        pairs = self.nodes.select(F.col("node").alias("other"), F.col("unit").alias("theirs")).join(asked, "other", "right")
        links = _linked(pairs, self.threshold, ["node"]).groupBy("node").agg(F.sum(F.col("linked").cast("long")).alias("n"))
        found = links.collect()
        true = sum(self.truth[r["node"]] for r in found)
        return sum(r["n"] for r in found) / true if true else 1.0


def _linked(pairs: DataFrame, threshold: float, keep: list[str]) -> DataFrame:
    """``pairs`` (mine, theirs, and what to keep) with ``linked``: the cosine in double precision reaches the threshold."""
    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("mine").to_pylist(), batch.column("theirs").to_pylist(), strict=True)
            linked = [
                a is not None and b is not None and bool(np.frombuffer(a, np.float64) @ np.frombuffer(b, np.float64) >= threshold)
                for a, b in sides
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(linked, pa.bool_())], names=[*keep, "linked"])

    return pairs.select(*keep, "mine", "theirs").mapInArrow(run, f"{schema}, linked boolean")


def _rows(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, row, digest, ...) of every row; null but for key and row where it links with nothing."""
    chosen = df.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(label).cast("string").alias("tag"),
        F.col(vector).alias("vector"),
    )
    kind = chosen.schema["key"].dataType.simpleString()
    schema = f"key {kind}, row long, tag string, width int, digest binary, unit binary, code binary, err double"
    return materialize(chosen.mapInArrow(_prepared, schema), "vectors")


def _classes(rows: DataFrame) -> DataFrame:
    """One node for each distinct vector of a label, with the size of its label."""
    same = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("key").alias("key"), F.count("*").alias("rows"),
        *[F.first(c).alias(c) for c in ("tag", "width", "unit", "code", "err")],
    )
    same = materialize(same, "classes")
    groups = same.groupBy("tag", "width").agg(F.min("node").alias("gid"), F.count("*").alias("n"))
    return materialize(salted(same, materialize(groups, "labels"), ["tag", "width"], "node"), "nodes")


def neighbours(nodes: DataFrame, threshold: float = 0.93) -> Neighbours:
    """Lists of the nearest classes of each, refined until the audit is content."""
    err = nodes.agg(F.max("err")).first()[0] or 0.0
    band = 2 * err + err * err + 1e-6
    floor = threshold - band
    audit = _Audit(nodes, threshold)
    none = F.array().cast("array<long>"), F.array().cast("array<float>")
    lists = nodes.select("node", F.lit(FIRST).alias("k"), none[0].alias("ids"), none[1].alias("sims"))
    lists = _started(lists, nodes, 0, floor)
    recall, rounds = 0.0, 0
    while True:
        # Lists that grew have their new places filled before they are judged.
        grown = lists.groupBy("k").count().collect()
        lists = _round(lists, nodes, rounds, floor)
        rounds += 1
        before, recall = recall, audit.recall(lists, floor)
        settled = sorted(grown) == sorted(lists.groupBy("k").count().collect())
        if recall >= RECALL and settled:
            break
        if rounds >= ROUNDS:
            warnings.warn(f"recall of {recall:.3f} after {rounds} rounds", stacklevel=2)
            break
        if recall < RECALL and recall - before < 0.01:
            lists = _started(lists, nodes, rounds * STARTS, floor)
    return Neighbours(nodes, lists, threshold, band, recall, rounds)


def edges(found: Neighbours) -> DataFrame:
    """(a, b, full): linked classes a < b that a list holds; ``full`` if both lists are saturated."""
    floor, sure = found.threshold - found.band, found.threshold + found.band
    near = F.size(F.filter("sims", lambda s: s >= floor))
    full = materialize(found.lists.filter(near >= F.col("k")).select("node"), "saturated")
    each = found.lists.select("node", F.explode(F.arrays_zip("ids", "sims")).alias("e")).filter(F.col("e.sims") >= floor)
    pairs = each.select(F.least("node", "e.ids").alias("a"), F.greatest("node", "e.ids").alias("b"), F.col("e.sims").alias("sim"))
    pairs = materialize(pairs.groupBy("a", "b").agg(F.max("sim").alias("sim")), "pairs")
    unit = found.nodes.select("node", "unit")
    open_ones = pairs.filter(F.col("sim") < sure)
    open_ones = open_ones.join(unit.toDF("a", "mine"), "a").join(unit.toDF("b", "theirs"), "b")
    decided = _linked(open_ones, found.threshold, ["a", "b"]).filter("linked").select("a", "b")
    linked = pairs.filter(F.col("sim") >= sure).select("a", "b").unionByName(decided)
    for side in ("a", "b"):
        flagged = full.select(F.col("node").alias(side), F.lit(True).alias(f"full_{side}"))
        linked = linked.join(flagged, side, "left")
    both = F.coalesce(F.col("full_a") & F.col("full_b"), F.lit(False))
    return materialize(linked.select("a", "b", both.alias("full")), "edges")


def _tile_counts(threshold: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        tile, node, weight = (rows.column(c).to_numpy() for c in ("tile", "node", "rows"))
        x = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(rows.num_rows, -1)
        first, second = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        linked = x[first] @ x[second].T >= threshold
        if low == high:
            np.fill_diagonal(linked, False)
            return pa.table({"node": node[first], "links": linked @ weight[second]})
        counts = np.concatenate([linked @ weight[second], weight[first] @ linked])
        return pa.table({"node": np.concatenate([node[first], node[second]]), "links": counts})

    return run


def _counted_in_tiles(found: Neighbours, linked: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, links): rows of other saturated classes of its component that a saturated class links with."""
    full = linked.filter("full").select(F.explode(F.array("a", "b")).alias("node")).distinct()
    member = full.join(roots, "node").join(found.nodes.select("node", "rows", "unit"), "node")
    placed = materialize(ranked(member, ["root"], [F.col("node")], "full"), "full").withColumn("tile", F.expr(f"rank div {TILE}"))
    tiles = materialize(placed.groupBy("root").agg((F.max("tile") + 1).alias("tiles")), "tiles")
    spread = salted(placed, tiles, ["root"], "node").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    work = spread.select("root", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "node", "rows", "unit")
    return work.groupBy("root", "low", "high").applyInArrow(_tile_counts(found.threshold), "node long, links long")


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93
) -> DataFrame:
    """Per row: key, n_links (other rows linked directly) and component (least key reachable by links)."""
    rows = _rows(df, key, vector, label)
    nodes = _classes(rows)
    found = neighbours(nodes, threshold)
    linked = edges(found)
    # A root names its component too.
    stars = materialize(components(linked.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")
    roots = materialize(stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct(), "roots")
    listed = linked.filter("NOT full")
    listed = listed.select("a", "b").unionByName(listed.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = nodes.select(F.col("node").alias("b"), F.col("rows").alias("links"))
    counts = listed.join(weight, "b").select(F.col("a").alias("node"), "links").unionByName(_counted_in_tiles(found, linked, roots))
    counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
    keyed = roots.join(nodes.select("node", "key"), "node")
    least = materialize(keyed.groupBy("root").agg(F.min("key").alias("component")), "components")
    named = salted(roots, least, ["root"], "node").select("node", "component")
    done = nodes.select("node", "digest", "rows", "key").join(counts, "node", "left").join(named, "node", "left").select(
        "digest", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "key").alias("component")
    )
    own = rows.select("key", "row", "digest")
    return salted(own, materialize(done, "named"), ["digest"], "row", "left").select(
        "key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component")).alias("component"),
    )
