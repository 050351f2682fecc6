from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from candlewick.llm import periodic_runs as pr


def brute(words, min_length=24):
    """All runs by trying every period; of one stretch the least period counts."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        start = None
        for x in range(n - q + 1):
            same = x < n - q and words[x] == words[x + q]
            if same and start is None:
                start = x
            if not same and start is not None:
                if x + q - start >= max(min_length, 3 * q):
                    found.setdefault((start, x + q - start), q)
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def fast(words):
    _, codes = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True) if len(words) else (None, np.zeros(0, int))
    return [tuple(r) for r in np.stack(pr.find_runs(codes.astype(np.int64)), axis=1).tolist()]


def made(rng):
    """Words with runs of many shapes: in runs, across noise, at both ends, with a word changed."""
    words = []
    for _ in range(rng.randint(1, 6)):
        letters = rng.choice([1, 2, 3, 50])
        if rng.random() < 0.3:
            words += [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
            continue
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.4:
            root = root * rng.randint(2, 6) + [rng.randrange(3) for _ in range(rng.randint(0, 3))]
        part = root * rng.randint(2, 7)
        part = part[rng.randint(0, 3) : len(part) - rng.randint(0, 3)]
        if part and rng.random() < 0.3:
            part[rng.randrange(len(part))] = 99
        words += part
    return words[:900]


@pytest.mark.parametrize("seed", range(8))
def test_random_words_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        words = made(rng)
        assert fast(words) == brute(words)


def test_words_with_many_squares():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    flips = [bin(x).count("1") % 2 for x in range(700)]
    for words in (b[:700], flips, [0] * 700, [0] * 300 + [1] + [0] * 300, ([0] * 30 + [1]) * 20, ([0, 1] * 20 + [0]) * 12):
        assert fast(words) == brute(words)


def test_bounds_of_a_run():
    assert fast([0] * 23) == []
    assert fast([0] * 24) == [(0, 24, 1)]
    nine = list(range(9))
    assert fast(nine * 3) == [(0, 27, 9)]
    assert fast((nine * 3)[:-1]) == []
    eight = list(range(8))
    assert fast([77, *eight * 3, 78]) == [(1, 24, 8)]
    assert fast([]) == []
    with pytest.raises(ValueError):
        pr.find_runs(np.zeros(5, np.int64), min_length=10)


def test_a_long_text_of_few_words_is_quick():
    words = np.zeros(300_000, np.int64)
    words[150_000] = 1
    assert [tuple(r) for r in np.stack(pr.find_runs(words), axis=1).tolist()] == [(0, 150_000, 1), (150_001, 149_999, 1)]
    root = np.random.default_rng(3).integers(0, 2, 70_000)
    start, length, period = pr.find_runs(np.tile(root, 4))
    assert (0, 280_000, 70_000) in set(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))


def test_the_tree_answers_like_a_scan():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100):
        values = rng.permutation(3 * n)[:n].astype(np.int64)
        tree = pr.WaveletTree(values)
        low = rng.integers(0, n + 1, 200)
        high = np.minimum(n, low + rng.integers(0, n + 1, 200))
        least = rng.integers(0, 4 * n + 2, 200)
        expected = [min([v for v in values[a:b] if v >= x], default=-1) for a, b, x in zip(low, high, least, strict=True)]
        assert tree.successor(low, high, least).tolist() == expected


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {x for s, length, q in runs for x in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    return (
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in dropped)).hexdigest(),
    )


def test_the_query_equals_brute_force(spark, tmp_path, documents, monkeypatch):
    rng = random.Random(5)
    rows = [(k, " ".join(f"w{x}" for x in made(rng))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, "a " * 30), (203, "a b c\x1fd\x85e\x0bf " * 30), (204, "é ü " * 20), rows[3], (3, "b " * 50)]
    documents(rows).drop("id").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    for at_once in (pr.WORDS_AT_ONCE, 50):
        monkeypatch.setattr(pr, "WORDS_AT_ONCE", at_once)
        found = pr.op13_periodic_runs(spark, str(tmp_path)).collect()
        assert sorted([tuple(r) for r in found], key=str) == sorted([(i, *expected_row(i, t)) for i, t in rows], key=str)
        assert sum(r.n_runs > 0 for r in found) > 40


def test_kept_columns_empty_tables_and_whole_results(spark, documents):
    docs = documents([(1, "x y z " * 10 + "end")]).selectExpr("*", "'q' AS runs")
    row = pr.periodic_runs(docs, keep=["doc_id", "block", "runs"]).first()
    assert row.asDict(recursive=True) == {
        "doc_id": 1, "block": "other", "n_words": 31, "runs": [{"start": 0, "length": 30, "period": 3}], "strongest": 0, "collapsed": "x y z end",
    }
    assert pr.periodic_runs(docs.limit(0)).count() == 0
