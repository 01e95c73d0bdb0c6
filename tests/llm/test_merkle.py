"""Merkle manifests: a plain recursion over small tables, shapes at every boundary, tampering, proofs of a few."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from chorale.llm import merkle

SCHEMA = "doc_id long, source string, text string, tree string, at long, hash string, row long, path long, root string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain(rows):
    """(doc_id, leaf, subroot, root, siblings) of every row, by recursion."""

    def up(level):
        """The top, and each node's siblings on the way."""
        paths = [""] * len(level)
        owners = [[i] for i in range(len(level))]
        while len(level) > 1:
            above, merged = [], []
            for a in range(0, len(level), 16):
                run = level[a : a + 16]
                for j in range(len(run)):
                    for i in owners[a + j]:
                        paths[i] += "".join(run[:j] + run[j + 1 :])
                above.append(digest(*run))
                merged.append([i for o in owners[a : a + 16] for i in o])
            level, owners = above, merged
        return level[0], paths

    groups = {}
    for doc_id, source, text in rows:
        groups.setdefault(source, []).append((doc_id, digest(field(doc_id), field(source), field(text))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, inner = {}, {}
    for source in order:
        leaves = sorted(groups[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        tops[source], paths = up([h for _, h in leaves])
        inner[source] = list(zip(leaves, paths))
    root, heads = up([tops[s] for s in order])
    return sorted(
        (str(key), h, tops[s], root, digest(path + heads[i]))
        for i, s in enumerate(order) for (key, h), path in inner[s]
    )


def build(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "x", 1, 1, "x") for r in rows], SCHEMA)
    value = [F.col(c) for c in ("doc_id", "source", "text")]
    bent = merkle.leaf(*value[:2], F.translate("text", "ABC", "abc"))
    leaves = df.select("doc_id", "source", merkle.leaf(*value).alias("leaf"), bent.alias("bent"))
    return merkle.build(leaves, "source", "doc_id", carry=["bent"])


def rows_of(proofs):
    return sorted(
        (str(r.key), r.hash, r.subroot, r.root, r.proof)
        for r in proofs.select(F.col("row.doc_id").alias("key"), "hash", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof")).collect()
    )


AWKWARD = [
    (1, None, None), (2, None, ""), (3, "", "Abc"), (None, "", "x"), (None, "", "x"), (None, None, "x"), (5, "é", "-"),
    (5, "é", "-"), (5, "é", "1:-"), (6, "z", "A" * 3_000_000), (7, "=", "tie"), (8, "Z", " \n"),
]


@pytest.mark.parametrize("sizes", [[1], [16], [17], [256], [257], [1, 16, 17, 300], [1] * 40])
def test_shapes_equal_a_plain_recursion(spark, sizes):
    rows = [(i, f"s{g}", f"Text {i}") for g, n in enumerate(sizes) for i in range(g * 1000, g * 1000 + n)]
    made = build(spark, rows)
    assert rows_of(merkle.proofs(made)) == plain(rows)


def test_awkward_rows(spark):
    made = build(spark, AWKWARD)
    assert rows_of(merkle.proofs(made)) == plain(AWKWARD)


def test_empty_table(spark):
    made = build(spark, [])
    assert made.root is None and merkle.proofs(made).count() == 0


def test_tampered_rows_do_not_fold_to_the_root(spark):
    rows = [(i, f"s{i % 3}", "A" if i % 7 == 0 else "a") for i in range(900)]
    made = build(spark, rows)
    proofs = merkle.proofs(made)
    done = proofs.select(
        F.col("row.doc_id").alias("key"),
        (merkle.folded(F.col("row.bent"), F.col("path")) == F.col("root")).alias("bent"),
        (merkle.folded(F.col("hash"), F.col("path")) == F.col("root")).alias("own"),
    ).collect()
    assert len(done) == 900 and all(r.own for r in done)
    assert all(r.bent == (r.key % 7 != 0) for r in done)


@pytest.mark.parametrize("most", [12, 700])
def test_proofs_of_a_few(spark, most):
    rows = [(i, "a" if i < most * 0.9 else "b", f"{i}") for i in range(most)]
    made = build(spark, rows)
    wanted = spark.createDataFrame([(0,), (11,), (most - 1,), (10_000,)], "doc_id long")
    want = {str(k) for k in (0, 11, most - 1)}
    assert rows_of(merkle.proofs(made, wanted)) == [r for r in plain(rows) if r[0] in want]


def test_only_every_second_level_is_stored(spark):
    made = build(spark, [(i, "s", str(i)) for i in range(700)])
    assert [level.count() for level in made.groups] == [700, 3, 1]
