from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pytest

from candlewick.llm import language
from candlewick.llm.common import tokenizer_file


def brute_probability(word, pieces, weights, lang):
    """The sum over every way to cut the word."""
    total = 0.0
    n = len(word)
    for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, n), k) for k in range(n)):
        parts = [word[a:b] for a, b in zip((0, *cuts), (*cuts, n), strict=True)]
        chance = 1.0
        for part in parts:
            if part in pieces:
                chance *= weights[pieces.index(part), lang]
            elif len(part) == 1:
                chance *= weights[-1, lang]
            else:
                chance = 0.0
                break
        total += chance
    return total


@pytest.fixture(scope="module")
def model():
    pieces = sorted([language.MARK, f"{language.MARK}a", "a", "b", "ab", "ba", "aba", f"{language.MARK}ab", "bb"])
    weights = np.random.default_rng(0).random((len(pieces) + 1, 2)) / 10
    weights[-1] = language.UNKNOWN
    return language.Model(pieces, ["x", "y"], weights)


@pytest.mark.parametrize("word", ["a", "abab", "bbbaab", "abcab", "zzz", "aéb"])
def test_forward_sums_every_segmentation(model, word):
    found = model.log_probabilities([word])[0]
    for lang in range(2):
        expected = math.log(brute_probability(language.MARK + word, model.pieces, model.weights, lang))
        assert found[lang] == pytest.approx(expected, rel=1e-9)


def test_long_words_and_short_ones_agree(model):
    for word in ("abab", "abcabba" * 5):
        assert model._long(language.MARK + word) == pytest.approx(model.log_probabilities([word])[0], rel=1e-9)
    assert np.isfinite(model.log_probabilities(["ab" * 5000, "q" * 20_000])).all()


def test_expected_counts_are_the_posterior(model):
    counts = np.array([[2.0, 0.0], [0.0, 3.0]])
    found = model.expected(["ab", "ba"], counts)
    lengths = np.array([*map(len, model.pieces), 1])
    assert found.T @ lengths == pytest.approx([2 * 3, 3 * 3])  # each character is in one piece of each word


def test_vocabulary_pieces_are_letters():
    pieces = language.load_pieces(tokenizer_file(language.VOCABULARY))
    assert len(pieces) > 10_000 and language.MARK in pieces and "the" in pieces
    assert all(p.lstrip(language.MARK).isalpha() or p == language.MARK for p in pieces)


def test_held_out_follows_its_definition(spark, documents):
    df = documents([(i, "x") for i in [*range(50), None]])
    found = {r.doc_id: r.h for r in df.select("doc_id", language.held_out().alias("h")).collect()}
    assert found == {None: False, **{i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}}


WORDS = {"en": "the and of with this thing there house", "de": "der und nicht ein haus straße werden über"}


def corpus(rng, n):
    rows = []
    for i in range(n):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(WORDS[lang].split(), 12)), lang))
    return rows


def test_held_out_accuracy_and_defined_cases(spark):
    rows = corpus(np.random.default_rng(1), 120)
    rows += [(1000, None, "en"), (1001, "", None), (1002, "123 !?", "de"), (1003, "THE HOUSE AND " * 20_000, None), (None, "und der", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'q' AS score", "1 AS __text")
    model = language.fit_documents(spark, df, sample_docs=30)
    assert model.languages == ["de", "en"]
    out = language.predict(df, model)
    assert out.columns == ["doc_id", "text", "lang", "__text", "lang_pred", "score"]
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == len(rows)
    assert all(found[i].lang_pred == lang for i, _, lang in rows[:120])
    assert all(0 <= r.score <= 1 for r in found.values())
    assert [(found[i].lang_pred, found[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert (found[1003].lang_pred, found[None].lang_pred) == ("en", "de")


def test_labels_and_sources_do_not_count_for_a_prediction(spark):
    rows = corpus(np.random.default_rng(1), 40)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit_documents(spark, df)
    swapped = df.selectExpr("doc_id + 999 AS doc_id", "text", "'zz' AS lang")
    one = sorted((r.text, r.lang_pred, r.score) for r in language.predict(df, model).collect())
    assert one == sorted((r.text, r.lang_pred, r.score) for r in language.predict(swapped, model).collect())


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = language.fit_documents(spark, df)
    assert [(r.lang_pred, r.score) for r in language.predict(df, model).collect()] == [("und", 0.0)]
    assert language.predict(df.limit(0), model).count() == 0
