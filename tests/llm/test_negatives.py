"""Hard negatives, against all scores of all rows; the query itself is compared with SQL in test_sql.py."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>, window string, number int, anchor string, _is_anchor int"


def brute(rows: list[tuple], is_anchor, k: int = 5) -> list[tuple]:
    given = [
        (key, label, [math.floor(256 * x) for x in v])
        for key, label, v in rows
        if None not in (key, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for key, label, v in given:
        if not is_anchor(key):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), other, mark) for other, mark, w in given if other != key]
        for minus, positive, _ in sorted(s for s in scored if s[2] == label)[:k]:
            fits = sorted(s for s in scored if s[2] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus)
            out += [(key, positive, n + 1, s[1], -minus, -s[0]) for n, s in enumerate(fits[:k])]
    return sorted(out)


def mined(spark, rows: list[tuple], every: int) -> list[tuple]:
    docs = spark.createDataFrame([(*r, "a", 1, "b", 1) for r in rows], SCHEMA)
    found = negatives.mine(docs, F.col("vec_id") % every == 0)
    return sorted(map(tuple, found.collect()))


def clustered(n: int, dims: int, seed: int, spread: float = 0.3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    of = rng.integers(0, 6, n)
    lengths = np.exp(rng.normal(size=(n, 1)))
    vectors = (centers[of] + rng.normal(size=(n, dims)) * spread) * lengths
    labels = rng.integers(0, 4, n)
    return [(i, int(labels[i]), vectors[i].tolist()) for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "every"), [(2500, 6, 10), (700, 2, 7)])
def test_by_brute_force(spark, n, dims, every):
    rows = clustered(n, dims, seed=n)
    expected = brute(rows, lambda key: key % every == 0)
    assert len(expected) > 500
    assert mined(spark, rows, every) == expected


def test_coordinates_prune():
    """Buckets are left out, and rows within one, without a change of the result."""
    rows = clustered(4096, 8, seed=3)
    vectors = np.array([np.floor(256 * np.array(v)) for _, _, v in rows])
    order = np.argsort(-negatives._lengths(vectors))
    buckets = []
    for i in range(0, len(rows), 256):
        of = order[i : i + 256]
        row = {"longest": negatives._lengths(vectors[of]).max(), "dims": 8, "item": "<f8", "vectors": vectors[of].tobytes()}
        row["ids"] = np.array([rows[j][0] for j in of], "<i8").tobytes()
        row["labels"] = np.array([rows[j][1] for j in of], "<i8").tobytes()
        row["orders"] = np.argsort(negatives._unit(vectors[of]), axis=0).T.astype(np.uint16).tobytes()
        buckets.append(negatives._Bucket(row))
    limits = [{"low": None, "high": None}]
    held = [{"number": i, "key": i, "label": rows[i][1], "vector": vectors[i], "windows": limits} for i in range(50)]
    state = negatives._Anchors(held, 8, True, 5, False)
    met = []
    verify = state._verify
    state._verify = lambda b, r, c: (met.append(len(r) * len(b.keys[c])), verify(b, r, c))
    for bucket in buckets:
        state.meet(bucket)
    assert sum(met) < 0.25 * 50 * len(rows)
    for i in range(50):
        scores = vectors @ vectors[i]
        same = [j for j in range(len(rows)) if j != i and rows[j][1] == rows[i][1]]
        best = sorted(same, key=lambda j: (-scores[j], j))[:5]
        assert state.found[i, 0].tolist() == best


def test_rows_that_take_no_part(spark):
    inf = float("inf")
    odd = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [1.0, 0.2]), (3, None, [1.0, 0.2]), (4, 2, None), (None, 2, [1.0, 0.2]),
        (5, 2, [1.0, None]), (6, 2, [float("nan"), 1.0]), (7, 2, [inf, 1.0]), (8, 2, [-inf, 1.0]), (9, 2, []), (11, 2, [1.0]),
        (12, 2, [0.9, 0.4, 7.0]), (10, 3, [-1.0, -1.0]), (13, 3, [1.0, 1.0]), (20, 4, [0.0, 0.0]), (21, 4, [0.0, 0.0]),
    ]
    found = mined(spark, odd, 10)
    assert found == brute([(*r[:2], r[2] and r[2] + [0.0] * (3 - len(r[2]))) for r in odd], lambda key: key % 10 == 0)
    assert {r[0] for r in found} == {0, 20}
    assert mined(spark, [], 10) == [] and mined(spark, [(1, 1, [1.0])], 10) == []


def test_ties_and_one_vector_in_most_rows(spark):
    """Equal scores go to the smaller keys, wherever they stand."""
    rng = random.Random(4)
    keys = list(range(1, 3000))
    rng.shuffle(keys)
    rows = [(k, k % 3, [0.5, 0.5] if k % 4 else [rng.random(), rng.random()]) for k in keys]
    assert mined(spark, rows, 500) == brute(rows, lambda key: key % 500 == 0)


def test_numbers_beyond_doubles(spark):
    rng = random.Random(6)
    rows = [(k, k % 2, [float(rng.randrange(2**20, 2**22)) for _ in range(8)]) for k in range(60)]
    rows += [(100 + k, k, [2.0**21, 2.0**21 + k % 2 / 256]) for k in range(2)]
    expected = brute(rows, lambda key: key % 5 == 0)
    assert max(r[4] for r in expected) > 2**60
    assert mined(spark, rows, 5) == expected
