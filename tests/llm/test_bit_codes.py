"""Hard negatives by rotated one-bit codes."""
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regiolake.llm import bit_codes as B
from regiolake.llm import queries as Q

from .conftest import SF

COLUMNS = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k_pos=5, k_neg=5):
    """Rows: (id, vector, label); every row is one of its own."""
    ok = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
          if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, v, y) in enumerate(ok):
        if i is None or i % 100:
            continue
        order = sorted((-dot(v, w), j is None, j or 0, j, z) for m, (j, w, z) in enumerate(ok) if m != n)
        for p, _, _, pid, z in [o for o in order if o[4] == y][:k_pos]:
            fit = [o for o in order if o[4] != y and -80 * p <= -100 * o[0] <= -100 * p][:k_neg]
            out += [(i, pid, r, o[3], -p, -o[0]) for r, o in enumerate(fit, 1)]
    return sorted(out, key=repr)


def found(df):
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def vectors(n, d, seed, shift=0.0):
    x = np.random.default_rng(seed).normal(shift, 1, (n, d)).astype(np.float32)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).tolist()


@pytest.mark.parametrize("d", [64, 128])
def test_rotations_are_orthogonal(d):
    x = np.random.default_rng(1).normal(size=(5, d))
    y = B.rotate(x, 2)
    assert np.allclose(y @ y.T, x @ x.T) and np.allclose(B.rotate(y, 2, back=True), x)
    assert not np.allclose(B.rotate(x, 1), y)


@pytest.mark.parametrize("shift,levels", [(0.0, 1), (0.0, 4), (0.5, 2), (3.0, 3)])
def test_intervals_hold_all_scores_and_shrink_with_levels(shift, levels):
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.normal(shift, 1, (300, 64)))
    v[0], v[1] = 0, v[2]
    mean, q = np.rint(v.mean(0)), v[:20].astype(np.int64)
    halves = []
    for n in range(1, levels + 1):
        x = v - mean
        codes, aligned, rest = B.encode(x, n)
        a = B.Anchors(q, mean, n)
        middle, half = a.interval(slice(0, 20), codes, aligned, rest, np.sqrt((x * x).sum(1)))
        assert (np.abs(q @ v.T - middle) <= half).all()
        halves.append(half.mean())
    assert halves == sorted(halves, reverse=True)


def test_against_brute_force_with_edge_rows(spark):
    rnd = random.Random(2)
    rows = [(i, v, rnd.randrange(3)) for i, v in zip(range(0, 4000, 20), vectors(200, 24, 1, 0.4))]
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (5001, rows[10][1], None), (5002, None, 1), (5003, [1.0, None], 1),
             (5004, [float("nan")] * 24, 1), (5005, [float("inf")] + [0.0] * 23, 2), (None, rows[5][1], 1), (5006, [0.9, 0.1], 2),
             (5007, [], 0), (5100, [0.0] * 24, 0), (5200, [-x for x in rows[0][1]], 9)]
    rows += [(6000 + i, rows[7][1], 2) for i in range(60)]                 # one vector many times: ties by id
    df = spark.createDataFrame([(*r, "x") for r in rows], COLUMNS).repartition(6)
    want = brute(rows)
    assert len(want) > 100
    assert found(B.mine(df, F.col("id") % 100 == 0)) == want
    assert found(B.mine(df, F.col("id") % 100 == 0, levels=1, block_components=64 * 9, tasks=2)) == want


def test_ids_and_labels_of_any_type(spark):
    rows = [(i, v, i % 4) for i, v in zip(range(0, 1000, 10), vectors(100, 8, 4, 0.5))]
    named = spark.createDataFrame([(f"{i:05d}", v, f"l{y}") for i, v, y in rows], "vec_id string, embedding array<double>, label string")
    got = found(B.mine(named, F.col("id").endswith("00")))
    assert got == sorted(((f"{a:05d}", f"{p:05d}", r, f"{n:05d}", s, t) for a, p, r, n, s, t in brute(rows)), key=repr)


def test_empty_and_without_anchors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1, "x")], COLUMNS)
    assert B.mine(df.limit(0), F.col("id") % 100 == 0).count() == 0
    assert B.mine(df, F.col("id") % 100 == 0).columns == B.mine(df, F.lit(True)).columns
    assert B.mine(df, F.lit(True)).count() == 0                          # an anchor without positives


def test_only_few_rows_are_scored():
    """Of rows far from the threshold the interval alone decides."""
    x = np.floor(256 * np.array(vectors(2000, 64, 8)))
    codes, aligned, rest = B.encode(x, 4)
    a = B.Anchors(x[:20].astype(np.int64), np.zeros(64), 4)
    middle, half = a.interval(slice(0, 20), codes, aligned, rest, np.sqrt((x * x).sum(1)))
    least = np.sort(x[:20] @ x.T, axis=1)[:, -6]
    assert ((middle + half >= least[:, None]).sum(1) < 0.2 * len(x)).all()


def test_query_against_brute_force(spark):
    rows = [((r["vec_id"]), r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(i, v, y if i % 7 or y is None else (y + 1) % 10) for i, v, y in rows]
    assert found(Q.op12_bit_code_negatives(spark, SF)) == brute(rows)


def test_matrix_of_a_sliced_column():
    column = pa.array([[1, 2], [3], [], [4, 5, 6]], pa.list_(pa.int32()))
    assert B._matrix(column.slice(1, 3), 4).tolist() == [[3, 0, 0, 0], [0, 0, 0, 0], [4, 5, 6, 0]]
