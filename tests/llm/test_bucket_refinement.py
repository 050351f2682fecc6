from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from candlewick.llm import bucket_refinement as buckets


def plain(rows, length):
    first = {}
    for number, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1) if number is not None else ():
            key = data[i : i + length]
            first[key] = min(number, first.get(key, number))
    out = []
    for number, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - length + 1) if number is not None else ():
            if first[data[i : i + length]] < number:
                covered[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((number, len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, **options):
    rows = buckets.remove_repeats(df, **options).collect()
    return sorted(
        ((r.id, r.n_bytes, r.n_removed, len(r.spans) // 2, hashlib.sha256(r.kept).hexdigest()) for r in rows), key=str
    )


def edited(seed, alphabet="abcdefgh ", n=40):
    """Documents made of shared passages with small edits, so that repeats begin and end anywhere."""
    rng = random.Random(seed)
    passages = ["".join(rng.choices(alphabet, k=rng.randint(30, 200))) for _ in range(8)]
    rows = []
    for _ in range(n):
        text = "".join(
            "".join(rng.choices(alphabet, k=rng.randint(0, 40))) + rng.choice(passages)[rng.randint(0, 20) :]
            for _ in range(rng.randint(0, 4))
        )
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(alphabet) + text[at + rng.randint(0, 2) :]
        rows.append((rng.randint(-5, 60), text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_result_equals_brute_force(spark, documents, seed):
    rows = edited(seed) + [(3, None), (4, ""), (None, "abc" * 100), (90, "abc" * 100), (91, "abc" * 100), (91, "abc" * 100)]
    assert found(documents(rows), block_bytes=2000) == plain(rows, buckets.LENGTH)


@pytest.mark.parametrize(("length", "q"), [(50, 50), (50, 30), (50, 16), (20, 3), (8, 1), (1, 1)])
def test_any_depth_and_any_first_bucket(spark, documents, length, q):
    rows = edited(7, "ab", 25)
    assert found(documents(rows), length=length, q=q, block_bytes=1000) == plain(rows, length)


def test_periodic_and_multibyte_texts(spark, documents):
    rows = [(1, "a" * 49), (2, "a" * 50), (3, "a" * 5000), (4, "ab" * 2500), (5, "ba" * 2500), (6, "é" * 60), (7, "xé" + "é" * 60)]
    rows += [(8, "a" * 25 + "b" * 25), (9, "c" + "a" * 25 + "b" * 25 + "d")]
    assert found(documents(rows)) == plain(rows, buckets.LENGTH)


def test_stretches_of_a_long_text_meet(spark, documents, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefghij", k=3000))
    pieces = [p for low in (10, 300) for p in [next(buckets.suffixes_of(text[low:].encode(), 50, 25))]]
    assert pieces[0].length == 50
    monkeypatch.setattr(buckets, "_SEGMENT", 64)
    parts = list(buckets.suffixes_of(text.encode(), 50, 25))
    starts = np.concatenate([np.arange(a, b + 1) + p.start for p in parts for a, b in zip(p.first, p.last, strict=True)])
    assert starts.tolist() == list(range(len(text) - 49))


def test_names_depend_on_content_alone():
    data = np.frombuffer(b"xx" + b"some text of a certain length" + b"yy" + b"some text of a certain length", np.uint8)
    for q in (1, 2, 7, 25):
        names = buckets.bucket_names(data, q)
        assert len(names) == len(data) - q + 1 and names[2] == names[33]
        assert len(np.unique(buckets.bucket_names(np.arange(200, dtype=np.uint8), q))) == 200 - q + 1


def test_a_text_in_every_document_costs_a_row_per_block(spark, documents):
    rows = [(i, "the same passage of words in all of the documents there are, and nothing else") for i in range(60)]
    assert found(documents(rows), block_bytes=500) == plain(rows, buckets.LENGTH)


def test_empty_table_and_wrong_parameters(spark, documents):
    assert found(documents([]).limit(0)) == []
    with pytest.raises(ValueError, match="q must"):
        buckets.remove_repeats(documents([]), length=5, q=6)


def test_names_of_a_block_travel_in_few_bytes_and_come_back():
    rng = np.random.default_rng(4)
    names = np.unique(rng.integers(0, 1 << 48, 300_000))
    more = rng.random(len(names)) < 0.1
    packed = buckets._packed(names, more)
    assert len(packed) < 5 * len(names)
    assert all(np.array_equal(a, b) for a, b in zip(buckets._unpacked(packed), (names, more), strict=True))
    assert [len(x) for x in buckets._unpacked(buckets._packed(names[:0], more[:0]))] == [0, 0]


def test_first_step_sends_one_row_per_block_and_range(spark, documents):
    plan = buckets.remove_repeats(documents(edited(1)), block_bytes=2000)._jdf.queryExecution().optimizedPlan().toString()
    assert "part#" in plan and plan.count("Window [count") == 1  # no window over all buckets, one over sides
