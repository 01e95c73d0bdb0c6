"""Temperature mixing of sources, realised as budgeted permutations of blocks.

A source with token share p gets a weight in proportion to p^a. The exponent a
lies between 0 (equal weights) and 1 (as found) and is bisected until the
weights' entropy reaches a target, or no source repeats more often than a
limit. Weights times the budget give each source whole passes over its rows
and a part of one more. In every pass the rows of a source are dealt by seeded
hash into blocks, and blocks and the rows in them are permuted; the last pass
stops at the row where the budget ends.

Running sums go over the blocks of a source and then over the rows of one
block, so the largest source is spread over ``BLOCKS`` groups per pass.

Defined results: a null source is a source; a null or negative token count is 0; a
source without tokens gets weight 0 and one pass; no row is cut in two, so a
source may stay below its budget by less than a row. Rows with equal keys tie
in any order. Texts of any length count by their tokens and are never cut. An empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import SPACE, equi, md5_int
from chorale.session import materialize

BLOCKS = 1024
# Columns that go with documents while they are joined.
PRINT, COPIES = "_chorale_print", "_chorale_copies"
# Exponents tried in one pass over the sources: a bisection of several steps at once.
GRID = 32


def find_exponent(
    sources: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None,
    budget: int | None = None,
) -> float:
    """The largest exponent that meets the entropy (nats), but no less than the limit asks for.

    ``sources`` has tokens per source. Entropy falls and repetition falls as
    the exponent rises, so the limit wins where both are given.
    """
    live = sources.filter("tokens > 0")
    total, most, least = live.agg(F.sum("tokens"), F.max("tokens"), F.min("tokens")).first()
    if not total:
        return 1.0
    p = F.col("tokens") / F.lit(float(total))

    def entropies(exponents: Sequence[float]) -> list[float]:
        sums = [
            s for a in exponents for s in (F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p)))
        ]
        row = live.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        return [math.log(z) - a * t / z for a, z, t in zip(exponents, row[::2], row[1::2], strict=True)]

    def norm(a: float) -> float:
        return live.agg(F.sum(F.pow(p, F.lit(a)))).first()[0]

    def repetition(a: float) -> float:
        if budget is None:
            return (least / most) ** (a - 1)
        return budget / total * (least / total) ** (a - 1) / norm(a)

    # With a limit alone, as flat as it lets them be; without either, as found.
    found = 1.0 if max_repetition is None else 0.0
    if target_entropy is not None:
        low, high = 0.0, 1.0
        for _ in range(6):
            grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
            met = [h >= target_entropy for h in entropies(grid)]
            # The last exponent that still meets the target, and the next.
            at = max((i for i, ok in enumerate(met) if ok), default=0)
            low, high = grid[at], grid[min(at + 1, GRID)]
        found = low
    if max_repetition is not None and repetition(found) > max_repetition:
        low, high = found, 1.0
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (mid, high) if repetition(mid) > max_repetition else (low, mid)
        found = high
    return found


def shared(weighted: DataFrame, budget: int | None = None) -> DataFrame:
    """(source, weight, passes, rest) of sources with tokens and a weight.

    Budget and shares follow from the weight as it is, however small; only the
    weight that is reported is rounded.
    """
    if budget is None:
        # The division is of doubles and its source has tokens, so its weight is above 0.
        needs = F.ceil(F.col("tokens") / F.when(F.col("tokens") > 0, F.col("weight")))
        budget = weighted.agg(F.max(needs)).first()[0] or 0
        share = F.greatest(F.col("tokens"), F.floor(F.col("weight") * budget))
    else:
        share = F.floor(F.col("weight") * budget)
    return weighted.withColumn("share", share).select(
        "source", F.round("weight", 9).alias("weight"),
        F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(1).alias("passes"),
        F.when(F.col("tokens") > 0, F.expr("share % tokens")).otherwise(0).alias("rest"),
    )


def mix(
    docs: DataFrame, keys: Sequence[str], target_entropy: float | None = None, max_repetition: float | None = None,
    budget: int | None = None, seed: int = 5, blocks: int = BLOCKS,
) -> DataFrame:
    """One row for each drawn copy: the keys, source, n_tokens, weight, copy, block, block_at, slot.

    ``docs`` has the keys, source and n_tokens. Without ``budget`` the smallest
    one is taken that leaves every source a whole pass.
    """
    tokens = F.greatest(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.lit(0)).alias("n_tokens")
    rows = materialize(docs.select(*keys, "source", tokens), "mixed")
    sources = materialize(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    a = find_exponent(sources, target_entropy, max_repetition, budget)
    p = F.col("tokens") / F.lit(float(max(total, 1)))
    raised = F.when(F.col("tokens") > 0, F.pow(p, F.lit(a))).otherwise(F.lit(0.0))
    norm = sources.agg(F.sum(raised)).first()[0] or 1.0
    weighted = shared(sources.withColumn("weight", raised / F.lit(norm)), budget)
    weighted = materialize(weighted, "weights")
    block = (md5_int(str(seed), "block", *[F.col(k) for k in keys]) % blocks).alias("block")
    dealt = rows.select("*", block)
    sizes = materialize(dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("size")), "blocks")
    # Each pass permutes the blocks anew; the sums before a block say where it starts.
    passes = F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))).alias("copy")
    each = equi(sizes, weighted, ["source"]).select("*", passes)
    drawn = md5_int(str(seed), "pass", F.col("copy"), F.col("source"), F.col("block"))
    order = Window.partitionBy("source", "copy").orderBy("drawn", "block")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("drawn", drawn).select(
        "source", "block", "copy", "weight", "passes", "rest",
        before.alias("before"), (F.row_number().over(order) - 1).cast("long").alias("block_at"),
    )
    # A block that starts where the budget has ended is out of the last pass.
    each = materialize(each.filter("copy < passes OR before < rest"), "passes")
    copies = equi(dealt, each, ["source", "block"])
    copies = copies.withColumn("at", md5_int(str(seed), "row", F.col("copy"), *[F.col(k) for k in keys]))
    inside = Window.partitionBy("source", "copy", "block").orderBy("at", *keys, "n_tokens")
    upto = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = copies.select(
        *keys, "source", "n_tokens", "weight", "copy", "block", "block_at",
        (F.row_number().over(inside) - 1).cast("long").alias("slot"),
        ((F.col("copy") < F.col("passes")) | (F.col("before") + upto <= F.col("rest"))).alias("within"),
    )
    return placed.filter("within").drop("within")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", max_repetition: float = 1.5) -> DataFrame:
    """The rows of ``docs`` as often as they are drawn; tokens are words."""
    words = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != ""))
    printed = docs.withColumn(PRINT, F.xxhash64(text))
    counted = printed.select(key, PRINT, "source", words.alias("n_tokens"))
    drawn = mix(counted, [key, PRINT], max_repetition=max_repetition)
    # Rows that repeat key and text are drawn each, and share their copies.
    copies = drawn.groupBy(key, PRINT).agg(F.count("*").alias(COPIES))
    times = counted.groupBy(key, PRINT).agg(F.count("*").alias("_rows"))
    copies = materialize(
        equi(copies, times, [key, PRINT]).select(key, PRINT, F.ceil(F.col(COPIES) / F.col("_rows")).alias(COPIES)), "copies"
    )
    joined = equi(printed, copies, [key, PRINT]).withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))))
    return joined.drop(PRINT, COPIES)
