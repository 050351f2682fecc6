from __future__ import annotations

import os
import random
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candlewick.llm import token_rollups as rollups

CHANGES = "source string, lang string, tokenizer string, n_tokens long, n_bytes long, sign int, batch string"


def changes(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], CHANGES)


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_bytes) for r in rollup.totals().collect()}


def plain(rows):
    docs, tokens, size = Counter(), Counter(), Counter()
    for source, lang, version, n, b, sign in rows:
        docs[source, lang, version] += sign or 0
        tokens[source, lang, version] += (sign or 0) * (n or 0)
        size[source, lang, version] += (sign or 0) * (b or 0)
    every = {k: (docs[k], tokens[k], size[k]) for k in docs}
    return {k: v for k, v in every.items() if any(v)}


def batches(seed, n=4):
    rng = random.Random(seed)

    def row():
        keys = (rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]))
        return (*keys, rng.choice([None, *range(9)]), rng.randint(0, 50), rng.choice([1, 1, -1, None]))

    return [[row() for _ in range(rng.randint(0, 30))] for _ in range(n)]


def test_totals_are_the_sum_of_all_batches_in_any_order(spark, tmp_path):
    parts = batches(1)
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        rollup = rollups.Rollup(spark, str(tmp_path / "".join(map(str, order))))
        for k in order:
            assert rollup.commit(f"b{k}", changes(spark, parts[k]))
        assert totals(rollup) == plain([r for p in parts for r in p])


def test_a_batch_counts_once(spark, tmp_path):
    parts = batches(2)
    rollup = rollups.Rollup(spark, str(tmp_path))
    assert rollup.commit("b0", changes(spark, parts[0]))
    before = totals(rollup)
    assert not rollup.commit("b0", changes(spark, parts[1]))
    assert not rollups.Rollup(spark, str(tmp_path)).commit("b0", changes(spark, parts[0]))
    assert totals(rollup) == before == plain(parts[0])


def test_a_broken_batch_is_written_anew(spark, tmp_path):
    parts = batches(3)
    rollup = rollups.Rollup(spark, str(tmp_path))
    rollup.commit("b0", changes(spark, parts[0]))
    rollup.commit("b1", changes(spark, parts[1]))
    (tmp_path / "deltas" / "batch=b1" / "_SUCCESS").unlink()
    assert totals(rollup) == plain(parts[0]) and rollup.committed() == {"b0"}
    assert rollup.commit("b1", changes(spark, parts[1]))
    assert totals(rollup) == plain(parts[0] + parts[1])


def test_compaction_keeps_totals_and_batch_ids(spark, tmp_path):
    parts = batches(4)
    rollup = rollups.Rollup(spark, str(tmp_path))
    rollup.compact()
    for k in range(2):
        rollup.commit(f"b{k}", changes(spark, parts[k]))
    rollup.compact()
    rollup.commit("b2", changes(spark, parts[2]))
    rollup.compact()
    assert not rollup.commit("b0", changes(spark, parts[3]))
    assert rollup.committed() == {"b0", "b1", "b2"}
    assert totals(rollup) == plain([r for p in parts[:3] for r in p])


def test_inserts_deletes_and_revisions(spark, documents, tmp_path):
    texts = [(1, "the cat"), (2, "a longer text, twice."), (3, None), (3, ""), (4, "word " * 20_000)]
    found = rollups.counts(documents(texts))
    library = Tokenizer.from_file(public_tokenizers.path(rollups.VOCABULARY))
    expected = [(n, len(library.encode(t or "", add_special_tokens=False).ids), len((t or "").encode())) for n, t in texts]
    assert sorted((r.doc_id, r.n_tokens, r.n_bytes) for r in found.collect()) == sorted(expected)
    assert {r.tokenizer for r in found.collect()} == {"byte_bpe_50k"}
    rollup = rollups.Rollup(spark, str(tmp_path))
    rollup.commit("insert", rollups.signed(found, 1))
    rollup.commit("revise", rollups.revised(found, found.selectExpr("*").replace({"byte_bpe_50k": "v2"}, subset=["tokenizer"])))
    assert sum(v[1] for k, v in totals(rollup).items() if k[2] == "v2") == sum(e[1] for e in expected)
    assert {k[2] for k in totals(rollup)} == {"v2"}
    rollup.commit("delete", rollups.signed(found.replace({"byte_bpe_50k": "v2"}, subset=["tokenizer"]), -1))
    assert totals(rollup) == {}


def test_nothing_and_wrong_names(spark, documents, tmp_path):
    rollup = rollups.Rollup(spark, str(tmp_path))
    assert totals(rollup) == {}
    assert rollup.commit("empty", rollups.signed(rollups.counts(documents([]).limit(0)), 1))
    assert totals(rollup) == {} and not rollup.commit("empty", changes(spark, []))
    for name in ("", "a/b"):
        with pytest.raises(ValueError, match="batch id"):
            rollup.commit(name, changes(spark, []))


def test_the_plan_sums_before_it_shuffles(spark, tmp_path):
    grouped = changes(spark, []).groupBy(*rollups.KEYS).sum("n_tokens")
    assert "partial_sum" in grouped._jdf.queryExecution().executedPlan().toString()


def test_the_query_counts_every_document(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    library = Tokenizer.from_file(public_tokenizers.path(rollups.VOCABULARY))
    expected = {}
    for source, lang, text in duckdb.sql(f"SELECT source, lang, text FROM '{folder}/documents.parquet'").fetchall():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        before = expected.get((source, lang, "byte_bpe_50k"), (0, 0, 0))
        expected[source, lang, "byte_bpe_50k"] = (before[0] + 1, before[1] + n, before[2] + len((text or "").encode()))
    rows = rollups.op10_token_counts(spark, folder).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_bytes) for r in rows} == expected
