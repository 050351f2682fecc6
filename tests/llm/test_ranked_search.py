from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from candlewick.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, k=10):
    rows = [(i, Counter(terms(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n_docs, n_terms = len(rows), sum(r[2] for r in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    found = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for i, c, n in rows:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        found += [(item, r, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def words(rng, n, letters=60):
    return " ".join(f"T{min(rng.randrange(letters), rng.randrange(letters))}" for _ in range(n))


@pytest.fixture
def corpus():
    rng = random.Random(11)
    docs = [(k, words(rng, rng.randint(1, 60))) for k in range(400)]
    docs += [(400 + k, docs[7][1]) for k in range(60)]  # a group of copies: ties at every rank
    docs += [(900, None), (901, ""), (902, "-- ,.!"), (None, docs[7][1]), (None, words(rng, 20)), (5, words(rng, 9)), docs[9]]
    docs += [(903, words(rng, 9000)), (904, "Ünder ünder ÜNDER naïve T1_T2 a\x00b\x7fc"), (905, "rare T3"), (906, "rare t3 T59")]
    items = [(k, words(rng, rng.randint(1, 25), 70)) for k in range(30)]
    items += [(50, None), (51, ""), (52, "nowhere at all"), (53, docs[7][1]), (54, "ÜNDER naïve t2 B"), (55, "rare t3"), items[0], (0, "rare T59 T0 t1")]
    return docs, items


def run(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS item_id", "'x' AS rank", "'x' AS ids").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS part", "1 AS place")
    return sorted((tuple(r) for r in rs.search(d, i, **more).collect()), key=str)


def test_results_equal_scoring_every_document(spark, corpus):
    docs, items = corpus
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, k=1) == brute(docs, items, 1)


def test_small_shards_and_many_blocks_change_nothing(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(rs, "SHARD_DOCS", 40)
    monkeypatch.setattr(rs, "SHARD_TERMS", 800)
    monkeypatch.setattr(rs, "BLOCK_ITEMS", 12)
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == []
    assert run(spark, [(1, None)], items) == []


def test_no_document_is_skipped_that_could_enter_and_bounds_save_work():
    rng = np.random.default_rng(2)
    looked = every = independent = 0
    for round_ in range(60):
        n, n_terms = 300, 12
        held = rng.random((n_terms, n)) < rng.choice([0.02, 0.2, 0.6], n_terms)[:, None]
        held[1::2] &= ~held[::2] | (rng.random((n_terms // 2, n)) < 0.1)  # pairs that seldom meet
        impacts = rng.integers(1, 40, (n_terms, n)) * rng.choice([1, 10, 60], n_terms)[:, None]
        terms_, docs = np.nonzero(held)
        present, dfs = np.unique(terms_, return_counts=True)
        shard = rs.Shard(np.arange(n), present, dfs, docs, impacts[held])
        pairs = [(t, t + 1) for t in range(0, n_terms, 2)]
        lists = []
        for a, b in pairs:
            both, joint = shard.shared(a, b)
            assert joint == max([0, *(impacts[a] + impacts[b])[held[a] & held[b]].tolist()])
            assert both.tolist() == np.flatnonzero(held[a] & held[b]).tolist()
            lists.append((joint, both if len(both) <= 10 else None))
        total = np.where(held, impacts, 0).sum(axis=0)
        floor = int(rng.integers(1, max(2, int(total.max() * 0.8))))
        places, scores, seen = rs.search_shard(shard, pairs, lists, floor, 10)
        assert (total[places] == scores).all()
        best = sorted(zip(-total, range(n), strict=True))[:10]
        wanted = {d for s, d in best if -s >= floor}
        ties = {d for d in range(n) if wanted and total[d] >= max(floor, -best[-1][0])}
        assert wanted <= set(places.tolist()) and ties <= set(places.tolist())
        # Bounds of the terms alone leave fewer of them out.
        loose = [(shard.top.get(a, 0) + shard.top.get(b, 0), None) for a, b in pairs]
        independent += rs.search_shard(shard, pairs, loose, floor, 10)[2]
        looked, every = looked + seen, every + int((total > 0).sum())
    assert looked < independent < every
