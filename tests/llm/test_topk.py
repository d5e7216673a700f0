import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finseries.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, asks, k):
    vec = [(i, r[0], [math.floor(1024 * x) for x in r[1]]) for i, r in enumerate(rows)
           if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, q, v in vec:
        if not asks(q):
            continue
        got = sorted((-sum(a * b for a, b in zip(v, w)), o is None, o or 0) for j, o, w in vec if j != i and len(w) == len(v))[:k]
        out += [(q, n, None if none else o, -s) for n, (s, none, o) in enumerate(got, 1)]
    return sorted(out, key=repr)


def found(df, k=10, lane_rows=16):
    return sorted((tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k, lane_rows=lane_rows).collect()), key=repr)


def ask(q):
    return q is not None and q % 100 == 0


def test_equals_brute_force_with_ties_nulls_and_repeats(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(5)], i % 3) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 0) for i in range(60)]  # one very common vector: ties at the k-th score
    rows += [(100, rows[100][1], 1), (None, rows[100][1], None), (None, None, 1), (500, None, 1), (600, [0.1, None, 0.0, 0.0, 0.0], 1),
             (700, [float("nan")] * 5, 1), (800, [float("inf")] + [0.0] * 4, 1), (900, [1.0, 2.0], 1), (901, [2.0, 1.0], 1), (1100, [], 1)]
    rows += [((1 << 55) * 100, [0.5] * 5, 1), ((1 << 60) + 1, [0.5] * 5, 1)]
    df = spark.createDataFrame([r for r in rows], SCHEMA)
    assert found(df) == brute(rows, ask, 10)


def test_more_wanted_than_there_are_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [0.0, -1e-20], 1), (200, [-0.3, 0.3], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(rows, ask, 10)
    assert found(df.limit(0)) == [] and found(df.where("vec_id = 1")) == []


def test_extra_columns_with_clashing_names(spark):
    rows = [(i, [float(i % 7), float(i % 5)], 1) for i in range(250)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("rid", "lane", "score", "rank", "low", "v")})
    assert found(df, k=3) == brute(rows, ask, 3)


def test_scores_are_exact_beyond_double_precision():
    q, r = np.array([[2.0 ** 30 + 1, 1.0]]), np.array([[2.0 ** 30 + 1, 1.0], [2.0 ** 40, 0.0]])
    assert topk.scores(q, r).tolist() == [[min((2 ** 30 + 1) ** 2 + 1, topk.LIMIT), min((2 ** 30 + 1) * 2 ** 40, topk.LIMIT)]]


@pytest.mark.parametrize("spread", [1e-3, 1.0, 1e5])
def test_windows_narrow_at_every_scale(spark, spread):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, spread) for _ in range(3)], 1) for i in range(201)]
    assert found(spark.createDataFrame(rows, SCHEMA), k=7) == brute(rows, ask, 7)
