from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import rotation_codes as codes

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, vector string, dim string"


def clustered(rng, n, dim, labels):
    centres = rng.standard_normal((n // 6 + 1, dim))
    rows = []
    for i in range(n):
        centre = centres[rng.integers(len(centres))]
        vector = centre + rng.standard_normal(dim) * rng.choice([0.0, 0.2, 0.33, 0.4])
        rows.append((i, [float(np.float32(x)) for x in vector], int(rng.integers(labels)), "x", "y", "z"))
    return rows


def brute(rows, threshold):
    n = len(rows)
    usable = [
        r[1] is not None
        and r[2] is not None
        and r[0] is not None
        and all(x is not None and np.isfinite(x) for x in r[1])
        and any(r[1])
        for r in rows
    ]
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= threshold:
                    links[i].append(j)
                    links[j].append(i)
    least = [r[0] for r in rows]
    for _ in rows:
        least = [min([least[i], *[least[j] for j in links[i]]]) if links[i] else least[i] for i in range(n)]
    return sorted(
        ((r[0], len(links[i]), least[i], None if r[0] is None else r[0] == least[i]) for i, r in enumerate(rows)), key=str
    )


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    out = codes.near_duplicates(spark, df, **options).select("id", "n_links", "component", "kept")
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize(("dim", "tile_rows", "eps"), [(64, 16, codes.EPS), (64, 1024, None), (5, 16, codes.EPS), (1, 8, codes.EPS)])
def test_links_equal_brute_force(spark, dim, tile_rows, eps):
    rows = clustered(np.random.default_rng(dim), 140, dim, 3)
    expected = brute(rows, codes.THRESHOLD)
    assert found(spark, rows, tile_rows=tile_rows, eps=eps) == expected
    assert sum(r[1] for r in expected) > 20


def test_odd_vectors_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(0, v, 1), (1, [2.0, 4.0, 6.0], 1), (2, v, 2), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0, -0.0, 0.0], 1)]
    rows += [(7, [1.0, None, 3.0], 1), (8, [1.0, float("nan"), 3.0], 1), (9, [1.0, float("inf"), 3.0], 1)]
    rows += [(10, [1.0, 2.0], 1), (11, [-1.0, -2.0, -3.0], 1), (None, v, 1), (12, v, 1), (12, v, 1)]
    rows = [(*r, "x", "y", "z") for r in rows]
    assert found(spark, rows) == brute(rows, codes.THRESHOLD)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_the_estimate_is_unbiased_and_the_bounds_hold():
    rng = np.random.default_rng(3)
    dim, cosine = 64, 0.6
    estimates = []
    for seed in range(300):
        a = rng.standard_normal(dim)
        b = rng.standard_normal(dim)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)
        packed, factor = codes.encode(a[None], seed)
        signs = (np.unpackbits(packed, axis=1, count=dim)[0] * 2.0 - 1) / np.sqrt(dim)
        estimates.append(signs @ (b @ codes.rotation(dim, seed)) / factor[0])
        assert codes.candidates(packed, factor, b[None], cosine, seed)[0, 0]
    assert abs(np.mean(estimates) - cosine) < 0.02


def test_codes_settle_most_pairs():
    rng = np.random.default_rng(4)
    a, b = rng.standard_normal((2, 500, 64))
    open_pairs = codes.candidates(*codes.encode(b, 7), a, codes.THRESHOLD, 7)
    assert open_pairs.mean() < 0.01


def test_a_dense_group_gives_few_links(spark):
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + 0.01 * rng.standard_normal(16)], 1, "x", "y", "z") for i in range(120)]
    out = found(spark, rows, tile_rows=16)
    assert {r[1:3] for r in out} == {(119, 0)}


def test_hot_label_is_cut_into_tiles(spark):
    rows = clustered(np.random.default_rng(2), 200, 8, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    assert codes.near_duplicates(spark, df, tile_rows=8).agg(F.count("*")).first()[0] == 200
