"""Jaccard self-join of word shingles by a token-group matrix.

1. Every text becomes its set of shingle hashes. Texts with equal sets are one
   class, known by 128 bits of the set; only classes go on.
2. Similar classes form groups: a class follows the leading class of its
   min-hash buckets if they share enough minima. Copies and near copies thus lie in one group
   before any pair is listed.
3. Classes that cannot link leave. The hash space is cut into parts, more of
   them than the k shingles in which linked sets of that size may differ: linked sets
   have some parts alike, so a class whose parts no other class has in the number needed
   links with nothing. Few are left; the shingles of those are counted, and classes leave
   that share too few of them.
4. The matrix holds, for each group, the union of its members' tokens: of each
   member the rarest shingles, as many as leave less than is needed for a
   link. A group that has none of another's tokens bounds their members' overlap below that, and stays
   closed. The other groups are opened: blocks of members are compared set
   against set, inside a group as well.
5. Components of all links, by repeated minima over neighbours.

The number of parts follows from the set's size, by powers of two; a set that may link with
one of the next size class takes part there too. No link is lost: whatever
is left out before a comparison cannot link. A comparison returns as many links as connect
its sets, not all of them.

Shingles are compared by 64-bit hashes; that two shingles of one comparison share
one has odds of about one in 10^13.

Defined results: a null text, or one without a word, has an empty set and links
with nothing; repeated rows, and rows with equal sets, are one class; null keys
form classes as others do and come last in naming a component; a text of any length is one set,
alone in its batch if it is long; other columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import equi, pieces, salted
from chorale.session import materialize

# Minima of a set's sketch, and how many of them a class shares with the leader of its group.
MINIMA, ALIKE = 16, 4
# Shingles in a block of a group, and rounds of leaving out classes by shingles.
BLOCK, PEELS = 200_000, 2
_BLANKS = b" \t\n\x0b\x0c\r"
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWER = 0xD6E8FEB86659FD93
_LETTER = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64)
_SEED = np.uint64(0x5851F42D4C957F2D)
_ISBLANK = np.zeros(256, bool)
_ISBLANK[list(_BLANKS)] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers from any."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's ``words``-word shingles."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.frombuffer(b" " + b" ".join([*texts, b""]), np.uint8)
    begins = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    # Words by differences of running sums of letters times powers.
    powers = np.full(text.size, _POWER, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_LETTER[text] * powers)])
    blank = _ISBLANK[text]
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    inverse = np.full(text.size, pow(_POWER, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    word = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    upto = np.searchsorted(starts, np.append(begins, text.size))
    # A shingle depends on its words and their order.
    shingle = np.zeros(max(0, word.size - words + 1), np.uint64)
    for k in range(words):
        shingle = mixed(shingle * np.uint64(3) + word[k : k + shingle.size])
    out = []
    for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(shingle[a : b - words + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mixed(whole * np.uint64(5) + word[k])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Rule:
    """What a similarity of ``share`` percent and more asks of two sets."""

    def __init__(self, share: int):
        self.share = share

    def needed(self, n: str) -> Column:
        """How many shingles a set of ``n`` shares with one it links with, at least."""
        return F.expr(f"({self.share} * {n} + 99) div 100")

    def levels(self, n: int) -> list[int]:
        """Size classes (by powers of two) in which a set of ``n`` can meet those it links with."""
        own = n.bit_length()
        # A larger set may lie one class higher.
        return [own, own + 1] if 100 * n >= self.share << own else [own]

    def differences(self, n: int) -> int:
        """The most shingles that a set of ``n`` and one it links with, of whatever size, have not in common."""
        return (100 - self.share) * (n + 100 * n // self.share) // (100 + self.share)

    def parts(self, level: int) -> tuple[int, int]:
        """The most shingles that linked sets of a class differ in, and the parts it is cut into."""
        k = (100 - self.share) * 2 * ((1 << level) - 1) // (100 + self.share)
        return k, k + 1 + max(3, k // 8)


def _tokens(own: np.ndarray, level: int, parts: int, differences: int) -> tuple[np.ndarray, int]:
    """A set's tokens at one level, and how many of them a linked set shares at least.

    Each shingle not in common spoils one part at most, so all other parts that
    are not empty here are shared. Where that leaves none, empty
    parts are tokens too, and such sets meet at least there. The level is kept in a token's last byte.
    """
    part = (((own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
    # Sorted by hash is sorted by part.
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    sums = np.add.reduceat(mixed(own ^ _SEED), starts)
    place = mixed(np.array([level], np.uint64))
    token = mixed(sums + part[starts].astype(np.uint64) * _MIX1 + place)
    least = starts.size - differences
    if least <= 0:
        empty = np.setdiff1d(np.arange(parts), part[starts]).astype(np.uint64)
        token = np.concatenate([token, mixed(empty * _MIX2 + place)])
        least = 1
    return (token & ~np.uint64(255)) | np.uint64(level), least


def _prints(sets: list[np.ndarray]) -> list[pa.Array]:
    """Set sizes and two 64-bit sums of each set; equal sets, and in effect no others, have the same."""
    one = np.fromiter((s.sum(dtype=np.uint64) for s in sets), np.uint64, len(sets))
    two = np.fromiter((mixed(s ^ _MIX2).sum(dtype=np.uint64) for s in sets), np.uint64, len(sets))
    return [pa.array([s.size for s in sets], pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]


def _lowered(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or b"").lower() for t in batch.column("text").to_pylist()]


def _sketcher(words: int):
    """Per row: its set's prints and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(MINIMA, dtype=np.uint64) << np.uint64(60)
        for batch in pieces(batches, "text"):
            sets = shingle_sets(_lowered(batch), words)
            sketch = []
            for s in sets:
                at = np.searchsorted(s, edges)
                sketch.append(np.where(at < s.size, s[np.minimum(at, s.size - 1)], 0).view(np.int64) if s.size else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("row"), *_prints(sets), pa.array(sketch, pa.list_(pa.int64()))],
                names=["key", "row", "n", "one", "two", "sketch"],
            )

    return run


def _part_rows(words: int, rule: Rule):
    """Per set and level: its prints, its tokens and how many a linked set shares. Sets seen in a task come once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in pieces(batches, "text"):
            sets = [s for s in shingle_sets(_lowered(batch), words) if s.size]
            prints = _prints(sets)
            rows, level, least, tokens = [], [], [], []
            for i, s in enumerate(sets):
                known = tuple(p[i].as_py() for p in prints)
                if known in seen:
                    continue
                seen.add(known)
                for one in rule.levels(s.size):
                    k, parts = rule.parts(one)
                    # Where linked sets cannot differ, they are one class already.
                    if k:
                        token, needed = _tokens(s, one, parts, rule.differences(s.size))
                        rows.append(i)
                        level.append(one)
                        least.append(needed)
                        tokens.append(token.view(np.int64))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(p.take(at) for p in prints), pa.array(level, pa.int64()), pa.array(least, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))],
                names=["n", "one", "two", "level", "least", "tokens"],
            )

    return run


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(_lowered(batch), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), *_prints(sets), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["class", "n", "one", "two", "tokens"],
            )

    return run


def _compared(rule: Rule):
    """Links between two blocks of sets (or inside one): enough of them to connect all that link."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        name, side = table.column("class").to_numpy(), table.column("side").to_numpy()
        lists = table.column("tokens").chunk(0) if table.num_rows else None
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat, sizes = lists.flatten().to_numpy(), np.diff(offsets)
        owner = np.repeat(np.arange(name.size), sizes)
        # Side 0 and 1 are two blocks; side 2 is one block against itself.
        stored = side[owner] != 0
        order = np.argsort(flat[stored], kind="stable")
        tokens, holder = flat[stored][order], owner[stored][order]
        root = list(range(name.size))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        left, right = [], []
        for q in np.flatnonzero(side != 1).tolist():
            own = flat[offsets[q] : offsets[q + 1]]
            a = np.searchsorted(tokens, own, side="left")
            b = np.searchsorted(tokens, own, side="right")
            width = b - a
            if not width.sum():
                continue
            hit = np.repeat(a - (np.cumsum(width) - width), width) + np.arange(width.sum())
            who, both = np.unique(holder[hit], return_counts=True)
            linked = who[100 * both >= rule.share * (sizes[who] + own.size - both)]
            for s in linked.tolist():
                x, y = find(q), find(s)
                if x != y:
                    root[y] = x
                    left.append(name[q])
                    right.append(name[s])
        return pa.table({"u": pa.array(left, pa.int64()), "v": pa.array(right, pa.int64())})

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v): root is the least node of its component.

    Each round hangs the larger neighbours of every node on its least
    neighbour, then all neighbours that are no larger; trees shrink to stars.
    """
    edges = materialize(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least").select("u", F.least("u", "m").alias("m"))
        hung = salted(both.filter("v > u"), low, ["u"], "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(hung.filter("u <> v").distinct(), "links")
        low = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = salted(edges, low, ["u"], "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(hung.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")


def _grouped(classes: DataFrame) -> DataFrame:
    """(class, group): classes that share ``ALIKE`` minima with a leader of theirs follow it.

    A bucket of equal minima is led by the class whose minima are the most common.
    """
    minima = classes.select("class", F.posexplode("sketch").alias("j", "minimum"))
    buckets = minima.groupBy("j", "minimum").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = materialize(buckets, "buckets")
    keys = ["j", "minimum"]
    common = materialize(salted(minima, buckets, keys, "class"), "minima")
    weight = common.groupBy("class").agg(F.sum(F.round(1000 * F.log("size")).cast("long")).alias("weight"))
    weighted = common.drop("size").join(materialize(weight, "weights"), "class")
    weighted = materialize(weighted, "weighted")
    leaders = weighted.groupBy(*keys).agg(F.max(F.struct("weight", (-F.col("class")).alias("c"))).alias("l"))
    leaders = materialize(leaders.select(*keys, (-F.col("l.c")).alias("leader")), "leaders")
    shared = salted(weighted, leaders, keys, "class").groupBy("class", "leader").agg(F.count("*").alias("alike"))
    best = shared.filter((F.col("alike") >= ALIKE) & (F.col("class") != F.col("leader")))
    best = best.groupBy("class").agg(F.max(F.struct("alike", (-F.col("leader")).alias("l"))).alias("b"))
    return best.select("class", (-F.col("b.l")).alias("group"))


def _shared_parts(rows: DataFrame) -> DataFrame:
    """Rows (class, token, least) whose token another class has too, of classes with enough of them at a level."""
    token, own = Window.partitionBy("token"), Window.partitionBy("class", "level")
    common = rows.withColumn("low", F.min("class").over(token)).withColumn("high", F.max("class").over(token))
    common = common.filter("low <> high").select("class", "token", "least").distinct()
    common = common.withColumn("level", F.col("token").bitwiseAND(255)).withColumn("n", F.count("*").over(own))
    return common.filter("n >= least").drop("n", "level")


def _shared_shingles(rows: DataFrame, rule: Rule) -> DataFrame:
    """Rows (class, n, token, df) of the classes whose shingles others have in a number that allows a link."""
    token, own = Window.partitionBy("token"), Window.partitionBy("class")
    counted = rows.select("class", "n", "token").withColumn("df", F.count("*").over(token))
    shared = F.sum((F.col("df") > 1).cast("long")).over(own)
    return counted.withColumn("shared", shared).filter(F.col("shared") >= rule.needed("n")).drop("shared")


def _prefixes(rows: DataFrame, rule: Rule) -> DataFrame:
    """(class, token): each class's rarest shingles, as many as two linked classes cannot both lack."""
    order = Window.partitionBy("class").orderBy("df", "token")
    placed = rows.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= F.col("n") - rule.needed("n") + 1)
    # What no other class has is in no other union.
    return placed.filter("df > 1").select("class", "token")


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, share: int = 80) -> DataFrame:
    """Per row: key, n_shingles and component (the least key reachable by links of ``share`` percent)."""
    rule = Rule(share)
    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    sketched = rows.mapInArrow(_sketcher(words), f"key {kind}, row long, n long, one long, two long, sketch array<long>")
    sketched = materialize(sketched, "sketches")
    prints = ["n", "one", "two"]
    name = F.xxhash64(*prints).alias("class")
    sets = sketched.filter("n > 0")
    classes = sets.groupBy(*prints).agg(F.min("key").alias("key"), F.count("*").alias("rows"), F.first("sketch").alias("sketch"))
    classes = materialize(classes.select(name, "key", "rows", "n", "sketch"), "classes")
    groups = materialize(_grouped(classes), "groups")

    # Parts first: classes with too few parts that another class has too link with nothing. Twice, as the
    # first time leaves out classes that others needed.
    schema = "n long, one long, two long, level long, least long, tokens array<long>"
    parted = rows.select("text").mapInArrow(_part_rows(words, rule), schema)
    parted = parted.select(name, F.explode("tokens").alias("token"), "least")
    parted = materialize(_shared_parts(parted).distinct(), "parts")
    living = materialize(_shared_parts(parted).select("class").distinct(), "living")
    fetched = living.join(classes.select("class", "key"), "class")
    wanted = equi(rows.select("key", "text"), fetched, ["key"])
    full = wanted.mapInArrow(_set_rows(words), "class long, n long, one long, two long, tokens array<long>")
    # Rows that share the key but not the set drop out; copies are one.
    full = full.filter(F.col("class") == F.xxhash64(*prints)).dropDuplicates(["class"]).select("class", "tokens", "n")
    full = materialize(full, "sets")
    # Then shingles: their true counts among the classes left, which leave out more classes.
    shingles = full.select("class", "n", F.explode("tokens").alias("token"))
    for _ in range(PEELS):
        shingles = materialize(_shared_shingles(shingles, rule), "shingles")
    member = materialize(_prefixes(shingles, rule).join(groups, "class", "left"), "prefixes")
    member = member.select("class", "token", F.coalesce("group", "class").alias("group"))
    # The matrix: the union of each group's tokens, and the groups that share one.
    union = materialize(member.select("group", "token").distinct(), "unions")
    other = union.select("token", F.col("group").alias("other"))
    hits = union.join(other, "token").filter("group < other").select("group", "other").distinct()
    members = materialize(member.select("class", "group").distinct(), "members")
    # Groups of several are compared inside as well.
    alone = members.groupBy("group").count().filter("count > 1").select("group", F.col("group").alias("other"))
    opened = materialize(hits.unionByName(alone), "opened")
    full = materialize(full.join(members, "class"), "opened_sets")
    # Groups are cut into blocks of about BLOCK shingles; a comparison takes two.
    blocks = full.groupBy("group").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    full = full.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), F.col("blocks")))
    sizes = materialize(blocks, "blocks")
    pairs = opened.join(sizes, "group").join(sizes.select(F.col("group").alias("other"), F.col("blocks").alias("others")), "other")
    pairs = pairs.select("group", "other", "others", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("a"))
    pairs = pairs.select("group", "other", "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("b"))
    pairs = pairs.filter("group <> other OR a <= b").withColumn("pair", F.xxhash64("group", "other", "a", "b"))
    same = (F.col("group") == F.col("other")) & (F.col("a") == F.col("b"))
    sides = F.when(same, F.array(F.struct("group", F.col("a").alias("block"), F.lit(2).alias("side")))).otherwise(
        F.array(
            F.struct("group", F.col("a").alias("block"), F.lit(0).alias("side")),
            F.struct(F.col("other").alias("group"), F.col("b").alias("block"), F.lit(1).alias("side")),
        )
    )
    sides = pairs.select("pair", F.explode(sides).alias("s")).select("pair", "s.group", "s.block", "s.side")
    work = full.join(sides, ["group", "block"]).select("pair", "side", "class", "tokens")
    links = materialize(work.groupBy("pair").applyInArrow(_compared(rule), "u long, v long"), "links")
    roots = components(links)
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    linked = linked.withColumnRenamed("node", "class").join(classes.select("class", "key"), "class")
    least = linked.groupBy("root").agg(F.min("key").alias("component"))
    # Classes of one row that link with nothing are their own components, and need no join.
    named = materialize(salted(linked.select("class", "root"), materialize(least, "components"), ["root"], "class"), "named")
    several = classes.filter("rows > 1").select("class", F.col("key").alias("own"))
    table = several.join(named.select("class", "component"), "class", "full").select("class", F.coalesce("component", "own").alias("component"))
    done = sketched.select("key", "row", "n", F.when(F.col("n") > 0, name).alias("class"))
    return salted(done, materialize(table, "named"), ["class"], "row", "left").select(
        "key", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component")
    )


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, share: int = 80) -> DataFrame:
    """The rows of ``docs`` whose key names their component, as they are: one document of each group.

    Rows that share a key are one document.
    """
    found = similar(docs, key, text, words, share).filter("key <=> component")
    return equi(docs, materialize(found.select(F.col("key").alias(key)).distinct(), "kept"), [key], "left_semi")
