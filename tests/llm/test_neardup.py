"""Near-duplicate vectors against all pairs: noise, pairs, dense and tied groups, awkward rows, small limits."""

from __future__ import annotations

import numpy as np
import pytest

from chorale.llm import neardup

SCHEMA = "vec_id long, embedding array<double>, label int, node long, rows long, gid long, key string, place long"


def frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], c, 0, 0, 0, "x", 0) for k, v, c in rows], SCHEMA)


def plain(rows, threshold=0.93):
    """(key, n_links, component) by all pairs; keys are distinct."""
    usable = [
        (k, np.array(v, float) / np.linalg.norm(v), c) for k, v, c in rows
        if c is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links = {k: [] for k, _, _ in rows}
    for i, (k, v, c) in enumerate(usable):
        for q, w, e in usable[:i]:
            if c == e and v.size == w.size and v @ w >= threshold:
                links[k].append(q)
                links[q].append(k)
    root = {}
    for start in sorted(links):
        stack = [] if start in root else [start]
        while stack:
            k = stack.pop()
            if k not in root:
                root[k] = start
                stack += links[k]
    return sorted((k, len(v), root[k]) for k, v in links.items())


def found(spark, rows):
    return sorted(tuple(r) for r in neardup.near_duplicates(frame(spark, rows)).collect())


def near(rng, centre, cosine):
    """A unit vector at ``cosine`` of ``centre``."""
    other = rng.standard_normal(centre.size)
    other -= (other @ centre) * centre
    return cosine * centre + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def table(rng, noise, pairs, groups, width=32):
    """Noise in three labels, pairs at 0.95, and groups of given sizes whose members lie near the threshold."""
    vectors = [(rng.standard_normal(width), int(rng.integers(3))) for _ in range(noise)]
    for v, c in vectors[:pairs]:
        vectors.append((near(rng, v / np.linalg.norm(v), 0.95) * 3, c))
    for size in groups:
        centre = rng.standard_normal(width)
        centre /= np.linalg.norm(centre)
        vectors += [(near(rng, centre, rng.uniform(0.95, 1)), 1) for _ in range(size)]
    order = rng.permutation(len(vectors))
    return [(int(i), list(map(float, vectors[i][0])), vectors[i][1]) for i in order]


def test_equals_all_pairs(spark):
    rows = table(np.random.default_rng(1), 900, 200, [40, 150])
    assert found(spark, rows) == plain(rows)


def test_small_limits_lose_nothing(spark, monkeypatch):
    """Lists, meetings, blocks and tiles far below the groups' sizes."""
    for name, value in {"FIRST": 4, "MOST": 8, "LEAF": 40, "MEET": 12, "TILE": 16, "AUDIT": 300}.items():
        monkeypatch.setattr(neardup, name, value)
    rows = table(np.random.default_rng(2), 700, 150, [60, 90])
    want, got = plain(rows), found(spark, rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)


def test_tight_groups_tied_by_far_links(spark):
    """Two groups of near-equal vectors, each larger than a list, link with each other at 0.94."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal(32)
    a /= np.linalg.norm(a)
    b = near(rng, a, 0.945)
    rows = [(i, list(near(rng, a if i % 2 else b, 0.99999)), 0) for i in range(300)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows)[0][1] == 299


def test_awkward_rows(spark):
    rows = [
        (1, [1.0, 0, 0], 1), (2, [2.0, 0, 0], 1), (3, [1.0, 0, 0], None), (4, [1.0, 0, 0], 2), (5, [0.0, 0, 0], 1), (6, None, 1),
        (7, [1.0, None, 0], 1), (8, [1.0, float("nan"), 0], 1), (9, [float("inf"), 0, 0], 1), (10, [1.0, 0], 1), (11, [], 1),
        (12, [1.0, -0.0, 0], 1), (13, [-1.0, 0, 0], 1), (14, [1e300, 1e299, 0], 1), (15, [1e-300, 0, 0], 1),
    ]
    assert found(spark, rows) == [
        (1, 4, 1), (2, 4, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 0, 10), (11, 0, 11),
        (12, 4, 1), (13, 0, 13), (14, 4, 1), (15, 4, 1),
    ]
    again = [(None, [1.0, 0], 1), (None, [1.0, 0], 1), (5, [1.0, 0], 1), (5, [1.0, 0], 1), (None, None, 1)]
    got = neardup.near_duplicates(frame(spark, again)).collect()
    assert sorted((r.key or 0, r.n_links, r.component) for r in got if r.n_links) == [(0, 3, 5), (0, 3, 5), (5, 3, 5), (5, 3, 5)]
    assert [tuple(r) for r in got if not r.n_links] == [(None, 0, None)]


def test_hot_vector(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(i), 1.0, -float(i)], 0) for i in range(900)]
    assert [r for r in found(spark, rows) if r[0] % 3 == 0] == [(i, 299, 0) for i in range(0, 900, 3)]


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_nothing_to_compare(spark, rows):
    assert found(spark, rows) == [(1, 0, 1)][: len(rows)]


def test_threshold_is_decided_in_double(spark):
    """Cosines a hair around the threshold: the rounding of the search does not decide."""
    rng = np.random.default_rng(4)
    a = rng.standard_normal(64)
    a /= np.linalg.norm(a)
    rows = [(0, list(a), 0)] + [(i, list(near(rng, a, 0.93 + (1e-9 if i % 2 else -1e-9))), 0) for i in range(1, 60)]
    got = {k: n for k, n, _ in found(spark, rows)}
    assert got == {k: n for k, n, _ in plain(rows)} and got[0] == 30
