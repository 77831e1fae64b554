import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetscope.llm import mining

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    """With columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows], "vec_id long, embedding array<double>, label int, rid long, norm double, home string")


def rows_of(seed, n, dim=6, scale=1.0, labels=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dim))
    return [(k, [float(v) for v in (centres[k % 4] + 0.4 * r.normal(size=dim)) * scale], int(r.integers(labels))) for k in range(n)]


def brute(rows, every, positives=5, negatives=5):
    sound = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
             if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda s: (-s[1], s[0] is None, s[0] or 0, s[2])
    out = []
    for a, (i, v, y) in enumerate(sound):
        if i is None or i % every:
            continue
        scored = [(j, sum(p * q for p, q in zip(v, w, strict=False)), b, z) for b, (j, w, z) in enumerate(sound) if b != a]
        for p in sorted((s for s in scored if s[3] == y), key=order)[:positives]:
            inside = [s for s in scored if s[3] != y and 80 * p[1] <= 100 * s[1] <= 100 * p[1]]
            for k, n in enumerate(sorted(inside, key=order)[:negatives], 1):
                out.append((i, p[0], k, n[0], p[1], n[1]))
    return sorted(out, key=str)


def found(df, every, **more):
    return sorted((tuple(r) for r in mining.hard_negatives(df, F.col("vec_id") % every == 0, **more).collect()), key=str)


HARD = [
    *rows_of(1, 90), (7, [1.0] * 6, 0), (7, [1.0] * 6, 0), (8, [1.0] * 6, 1), (8, [1.0] * 6, 1), (None, [1.0] * 6, 0), (None, [0.9] * 6, 1), (100, None, 1),
    (101, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (102, [NAN] * 6, 1), (103, [INF] + [0.0] * 5, 1), (104, [1.0] * 6, None), (105, [0.0] * 6, 0), (110, [], 2),
    (120, [1.0] * 6, 0), (120, [1.0] * 6, 1), (130, [0.5, 0.5], 0), (140, [-1.0] * 6, 9), (150, [0.001] * 6, 0),
]


@pytest.mark.parametrize("batch", [mining.BATCH, 200])
def test_equal_to_brute_force(spark, batch):
    assert found(vectors(spark, HARD), 10, batch=batch) == brute(HARD, 10)


def test_copies_of_one_vector_and_few_references(spark):
    rows = rows_of(2, 60) + [(1000 + k, [0.5] * 6, k % 2) for k in range(300)]
    assert found(vectors(spark, rows), 20, references=2, seed=1) == brute(rows, 20)


def test_large_components_are_exact(spark):
    rows = rows_of(3, 40, dim=3, scale=2.0**20)
    assert found(vectors(spark, rows), 10) == brute(rows, 10)


def test_bounds_enclose_every_score(spark):
    rows = mining.integers(vectors(spark, rows_of(4, 200, dim=8)))
    block = mining.Rows.of(mining.with_angles(rows, mining.references_of(rows, 5)).toArrow())
    low, high = mining.bounds(block, block)
    got = mining.scores(block, block)
    assert (low <= got).all() and (got <= high).all() and (mining.block_ceiling(block, block) >= got.max(axis=1)).all()
    # the bounds are of use: among clustered vectors many pairs are told apart without a score
    assert (high < got.max(axis=1)[:, None] * 0.5).mean() > 0.1


def test_empty_table(spark):
    assert found(vectors(spark, []), 10) == [] and found(vectors(spark, [(None, None, None)]), 10) == []
