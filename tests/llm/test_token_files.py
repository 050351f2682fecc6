from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from candlewick.llm import token_files as files

FILE = public_tokenizers.path(files.VOCABULARY)
LIBRARY = Tokenizer.from_file(FILE)
with open(FILE, encoding="utf-8") as _source:
    OWN = files.ByteTokenizer(_source.read())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


SPECIAL = [None, "", " ", "  ", "a  b", " a b ", "a \n b", "a\n b", "<|endoftext|> x<|endoftext|>", "Ġ Ġx", "é \U0001f389 中"]


def test_special_texts():
    assert [list(np.frombuffer(b, "<u4")) for b in OWN(SPECIAL)] == [ids_of(t) for t in SPECIAL]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("the cat's\n\t.,<|>Ġ "), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_any_texts(texts):
    assert [list(np.frombuffer(b, "<u4")) for b in OWN(texts)] == [ids_of(t) for t in texts]


@pytest.mark.parametrize(("low", "base"), [(50, 60), (70_000, 70_001)])
def test_grammar_round_trip_and_random_access(low, base):
    rng = np.random.default_rng(base)
    phrase = rng.integers(0, low, 40)
    docs = []
    for _ in range(60):
        parts = [phrase[rng.integers(30) :][: rng.integers(1, 30)] for _ in range(rng.integers(0, 12))]
        docs.append(np.concatenate([*parts, rng.integers(0, low, 3), [0]]).astype("<u4"))
    docs += [np.array([0], "<u4"), np.full(1000, 3, "<u4"), np.array([0], "<u4")]
    row = files._shard(0, 0, list(range(len(docs))), [d.tobytes() for d in docs], base)
    assert all(np.array_equal(a, b) for a, b in zip(files.unpack(row), docs, strict=True))
    assert len(row["symbols"]) // row["width"] < sum(map(len, docs)) / 2
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    assert all(max(pair) < base + k for k, pair in enumerate(rules))
    for _ in range(200):
        k = int(rng.integers(len(docs)))
        first, count = int(rng.integers(len(docs[k]))), int(rng.integers(1, 60))
        assert np.array_equal(files.unpack_range(row, k, first, count), docs[k][first : first + count])


def test_pairs_never_cross_documents():
    ids = np.tile(np.array([1, 2], np.uint32), 200)
    symbols, rules, offsets = files.compress(ids, np.arange(0, 400, 2), 100)
    assert len(offsets) == 200 and len(symbols) == 200 and len(rules) == 1
    symbols, rules, _ = files.compress(ids, np.arange(400), 100)
    assert len(symbols) == 400 and not len(rules)


@pytest.mark.parametrize("shard_tokens", [5, 100_000])
def test_files_hold_all_documents_in_order(spark, documents, tmp_path, shard_tokens):
    rng = random.Random(3)
    rows = [(rng.randint(0, 10**6), "the cat sat " * rng.randint(0, 30) + str(rng.random())) for _ in range(80)]
    rows += [(5, None), (6, ""), (7, "same"), (7, "same"), (8, "word " * 20_000), (-3, "x")]
    path = str(tmp_path / "ids")
    files.write(documents(rows), path, shard_tokens=shard_tokens)
    found = sorted(files.read(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for (number, text), row in zip(sorted(rows, key=lambda r: r[0]), found, strict=True):
        ids = [*ids_of(text), 0]
        assert (row.doc_id, row.start, row.n_tokens) == (number, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_rows_with_one_id_and_without(spark, documents, tmp_path):
    rows = [(1, "b"), (1, "a a"), (None, "c"), (1, "c c c")]
    files.write(documents(rows), str(tmp_path / "ids"))
    found = sorted(files.read(spark, str(tmp_path / "ids")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 1, 1]
    assert sorted(r.n_tokens for r in found) == [2, 2, 3, 4]


def test_empty_table(spark, documents, tmp_path):
    files.write(documents([]).limit(0), str(tmp_path / "ids"))
    assert files.read(spark, str(tmp_path / "ids")).count() == 0


def test_stretches_of_known_pieces_are_not_encoded_again():
    with open(FILE, encoding="utf-8") as source:
        own = files.ByteTokenizer(source.read())
    own(["x the cat, sat über"])
    asked, encode = [], own._encode
    own._encode = lambda texts: asked.extend(texts) or encode(texts)
    own._spaced = lambda stretches: pytest.fail(f"encoded again: {stretches}")
    text = "x cat, the, sat, über,\nsat"
    own.new_pieces["\n"], own.new_pieces["sat"] = encode(["\n", "sat"])
    assert [list(np.frombuffer(b, "<u4")) for b in own([text])] == [ids_of(text)]
    assert asked == ["x"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abZ'stm09,.-<|>\n éßÿŉſ×÷²ªµ中\x1f\x7f\xa0"), max_size=30), max_size=4))
def test_pieces_of_common_letters(texts):
    assert [list(np.frombuffer(b, "<u4")) for b in OWN(texts)] == [ids_of(t) for t in texts]


def test_pairs_are_found_by_hash_as_by_bisection(monkeypatch):
    rng = np.random.default_rng(7)
    for kind in (np.uint32, np.uint64):
        chosen = np.unique(rng.integers(0, np.iinfo(kind).max, 4000, kind))
        keys = np.concatenate([rng.choice(chosen, 500), rng.integers(0, np.iinfo(kind).max, 500, kind)])
        number, found = files._places(chosen, keys)
        with monkeypatch.context() as m:
            m.setattr(files, "_ODD", ())
            plain, same = files._places(chosen, keys)
        assert np.array_equal(found, same) and np.array_equal(number[found], plain[found]) and found.sum() >= 500
