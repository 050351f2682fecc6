from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import decontamination as dec


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=80), st.lists(st.sampled_from("abcde"), max_size=80))
def test_longest_common_subsequence(a, b):
    assert dec.common_words(a, b) == plain_lcs(a, b)


VOCABULARY = None


def prose(rng, n):
    global VOCABULARY
    if VOCABULARY is None:
        letters = random.Random(0)
        VOCABULARY = ["".join(letters.choices("abcdefghijklmnop", k=letters.randint(2, 8))) for _ in range(4000)]
    weights = [1 / (k + 3) for k in range(len(VOCABULARY))]
    return rng.choices(VOCABULARY, weights, k=n)


@pytest.fixture(scope="module")
def planted():
    """Items, documents and the pairs that belong together."""
    rng = random.Random(2)
    items = []
    for number in range(30):
        words = prose(rng, rng.randint(12, 60))
        items.append((number, " ".join(words[:-5]) + ". " + " ".join(words[-5:]) + "."))
    docs, pairs = [], set()
    for number in range(120):
        before, after = prose(rng, rng.randint(0, 150)), prose(rng, rng.randint(0, 150))
        middle = []
        if number % 2:
            item = rng.randrange(30)
            middle = items[item][1].split()
            if number % 4 == 3:  # a paraphrase: one word in six is another, the answer stays
                middle = [w if rng.random() > 1 / 6 or k >= len(middle) - 5 else "instead" for k, w in enumerate(middle)]
            if number % 8 == 1:  # with marks after each word, in capitals
                middle = [f"{w.upper()}###" for w in middle]
            pairs.add((number, item))
        docs.append((number, " ".join([*before, *middle, *after])))
    return items, docs, pairs


ITEMS = "item_id long, text string, doc_id string, features string"


def found(spark, df, items, **options):
    benchmark = spark.createDataFrame([(*i, "x", "y") for i in items], ITEMS)
    return {(r.doc_id, r.item_id) for r in dec.contaminated(spark, df, benchmark, **options).collect()}


@pytest.mark.parametrize("item_block", [256, 8])
def test_copies_and_paraphrases_are_found_and_the_rest_left(spark, documents, planted, item_block):
    items, docs, pairs = planted
    assert found(spark, documents(docs), items, item_block=item_block) == pairs


def test_a_low_rank_still_finds_copies(spark, documents, planted):
    items, docs, pairs = planted
    assert {p for p in pairs if p[0] % 4 == 1} <= found(spark, documents(docs), items, rank=24)


def numbers(words):
    return dec.Features().of(" ".join(words)).tolist()


def test_the_answer_decides_on_paraphrases():
    rng = random.Random(5)
    words = prose(rng, 40)
    item = dec.item_of(1, " ".join(words[:30]) + ". " + " ".join(words[30:]) + ".", None)
    kept = [w if k % 3 else "other" for k, w in enumerate(words[:30])]
    assert dec.check(item, numbers(kept + words[30:]))[1:] == (True, True)
    assert dec.check(item, numbers(kept + ["no"] * 10))[2] is False
    assert dec.item_of(1, "a question", "an answer").answer == numbers(["an", "answer"])


def test_short_items_need_every_word():
    item = dec.item_of(1, "what is that", None)
    assert dec.check(item, numbers("x what is that y".split()))[2]
    assert not dec.check(item, numbers("x what is not that y".split()))[2]


def test_randomised_svd_finds_the_leading_space(spark):
    rng = np.random.default_rng(0)
    matrix = rng.standard_normal((80, 6)) @ rng.standard_normal((6, 50)) + 0.001 * rng.standard_normal((80, 50))
    rows = [(list(range(0, 100, 2)), row.tolist()) for row in matrix]
    used, right = dec.randomised_svd(spark, rows, 6)
    assert used.tolist() == list(range(0, 100, 2))
    assert right.T @ right == pytest.approx(np.eye(6), abs=1e-8)
    assert np.linalg.norm(matrix - matrix @ right @ right.T) < 0.01 * np.linalg.norm(matrix)


def test_document_frequencies_count_all_documents(spark, documents):
    df = documents([(1, "One two TWO"), (2, "two ###"), (3, None), (4, "")])
    counts = {r.feature: r.df for r in dec.document_frequencies(dec.tokenised(df)).collect()}
    of = {w: int(dec.Features().of(w)[0]) for w in ("one", "two")}
    assert counts == {-1: 4, of["one"]: 1, of["two"]: 2}


def test_odd_rows(spark, documents, planted):
    items, docs, _ = planted
    text = items[0][1]
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "###"), (5, text + " word" * 100_000)]
    rows += [(6, "word " * 50_000 + text)]
    benchmark = spark.createDataFrame([(0, text), (0, text), (7, None), (8, ""), (None, "!!")], "item_id long, text string")
    out = dec.contaminated(spark, documents(rows + docs[:20:2]), benchmark).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in out) == sorted([("1", 0), ("None", 0), ("5", 0), ("6", 0), ("1", 0)] * 2)


def test_checksums_of_many_words_at_once():
    words = ["", "a", "é", "x" * 31, "y" * 32, "z" * 33, "ü" * 40, "a b", "\0"]
    words += ["".join(random.Random(k).choices("abcé", k=k % 35)) for k in range(200)]
    made = pa.array(words, pa.string()).cast(pa.binary())
    assert dec.checksums(made).tolist() == [zlib.crc32(w.encode()) for w in words]
    assert dec.checksums(made.slice(3, 9)).tolist() == [zlib.crc32(w.encode()) for w in words[3:12]]
    assert dec.checksums(made.slice(0, 0)).tolist() == []


def test_groups_of_items_settle_passages_with_words_of_many_items_without_a_vector(spark, monkeypatch):
    monkeypatch.setattr(dec, "KEPT_SHARE", 2)  # all of each passage: items have no word in common
    rng = random.Random(4)
    items = [dec.item_of(n, " ".join(f"w{n}x{k}" for k in range(30)), None) for n in range(32)]
    mixed = [f"w{n}x{k}" for n in range(32) for k in range(30)]
    texts = [" ".join(rng.choices(mixed, k=200)) for _ in range(40)] + [" ".join(f"w3x{k}" for k in range(30))]
    rows = [(n, dec.words_of(pa.array([t]))[0].as_py()) for n, t in enumerate(texts)]
    weight = np.ones(dec.FEATURES, np.float32)
    space = dec.latent_space(spark, items, weight)
    vectors, summed = [], dec._sums

    def counted(columns, row, starts):
        if columns is space.vectors:
            vectors.append(len(starts))
        return summed(columns, row, starts)

    monkeypatch.setattr(dec, "_sums", counted)
    hits = dec._search(space, weight, rows, dec.COSINE)
    blocks = sum(-(-len(words) // 4 // dec.STEP) for _, words in rows)
    assert [(r["doc_id"], r["item_id"], r["lcs"]) for r in hits] == [(40, 3, 30)]
    assert sum(vectors) < blocks / 4
    space.bounds = np.full_like(space.bounds, 1e6)  # settles nothing
    assert dec._search(space, weight, rows, dec.COSINE) == hits and vectors[-1] > blocks / 2


def test_empty_tables(spark, documents, planted):
    items, docs, _ = planted
    assert found(spark, documents([]).limit(0), items) == set()
    assert found(spark, documents(docs[:3]), []) == set()


def test_an_item_in_a_third_of_the_documents_is_found_as_by_brute_force(spark, documents):
    rng = random.Random(12)
    rare = lambda n: ["".join(rng.choices("qrstuvwxyz", k=9)) for _ in range(n)]
    items = [(number, " ".join(rare(18))) for number in range(6)] + [(6, " ".join(rare(40)))]
    docs = []
    for number in range(300):
        words = rare(rng.randint(60, 120))
        held = [0] if number % 3 == 0 else [number % 7] if number % 10 == 1 else []
        for item in held:
            at = rng.randint(20, 40)
            words[at:at] = items[item][1].split()
        docs.append((number, " ".join(words)))
    made = [dec.item_of(n, t, None) for n, t in items]
    brute = {(n, i.number) for n, t in docs for i in made if dec.check(i, numbers(t.split()))[2]}
    assert len(brute) > 100
    assert found(spark, documents(docs), items) == brute
