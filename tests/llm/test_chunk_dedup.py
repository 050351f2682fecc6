from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from candlewick.llm import blocks, chunk_dedup


def prose(rng, words):
    syllables = ["the", "on", "er", "ti", "na", "sol", "re", "ment", "a", "qui"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def plain_ends(text, reach):
    """Each byte's hash by its recurrence, then the first largest within reach."""
    h, hashes = 0, []
    for byte in text:
        h = (h * 2 + int(chunk_dedup.GEAR[byte])) % 2**32
        hashes.append(h)
    out = []
    for i, value in enumerate(hashes):
        left, right = hashes[max(0, i - reach) : i], hashes[i + 1 : i + 1 + reach]
        if all(x < value for x in left) and all(x <= value for x in right):
            out.append(i + 1)
    return out if not text or out[-1:] == [len(text)] else [*out, len(text)]


@pytest.mark.parametrize("reach", [3, 24])
def test_chunk_ends_follow_the_rolling_hash(reach):
    rng = random.Random(2)
    for text in (b"", b"a", b"aaaa" * 50, prose(rng, 200).encode(), rng.randbytes(3000)):
        assert chunk_dedup.chunk_ends(text, reach).tolist() == plain_ends(text, reach)


def test_stretches_of_a_long_text_meet(monkeypatch):
    text = prose(random.Random(3), 3000).encode()
    whole = chunk_dedup.chunk_ends(text).tolist()
    monkeypatch.setattr(chunk_dedup, "_SEGMENT", 777)
    assert chunk_dedup.chunk_ends(text).tolist() == whole


def test_an_insertion_moves_few_chunks():
    text = prose(random.Random(4), 2000).encode()
    shifted = text[:500] + b"something new" + text[500:]
    digests = [set(map(bytes, chunk_dedup.chunk_digests(t, chunk_dedup.chunk_ends(t)))) for t in (text, shifted)]
    assert len(digests[1] - digests[0]) <= 6


def plain(rows, reach=chunk_dedup.REACH, least_run=chunk_dedup.MIN_RUN):
    first = {}
    for number, text in rows:
        data, at = (text or "").encode(), 0
        for end in plain_ends(data, reach) if number is not None else ():
            key = data[at:end]
            first[key] = min(number, first.get(key, number))
            at = end
    out = []
    for number, text in rows:
        data, at, runs = (text or "").encode(), 0, []
        for end in plain_ends(data, reach):
            if number is not None and first[data[at:end]] < number:
                if runs and runs[-1][1] == at:
                    runs[-1][1] = end
                else:
                    runs.append([at, end])
            at = end
        runs = [r for r in runs if r[1] - r[0] >= least_run]
        kept = blocks.without(data, np.array([r[0] for r in runs], int), np.array([r[1] for r in runs], int))
        out.append((number, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeats():
    rng = random.Random(6)
    passages = [prose(rng, 60) for _ in range(4)]
    rows = [(i, f"{prose(rng, 40)} {passages[i % 4]} {prose(rng, 30)}") for i in range(24)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (101, rows[3][1]), (None, rows[3][1]), (200, None), (201, "")]
    rows += [(202, "z" * 5000), (203, "z" * 5000), (-5, passages[0]), (204, "é" * 3000)]
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 10, 8 << 20])
def test_result_equals_brute_force(spark, documents, block_bytes):
    rows = repeats()
    out = chunk_dedup.remove_repeats(documents(rows), block_bytes=block_bytes)
    found = sorted(
        ((r.id, r.n_bytes, r.n_removed, len(r.spans) // 2, hashlib.sha256(r.kept).hexdigest()) for r in out.collect()), key=str
    )
    assert found == plain(rows)


def test_long_passages_are_found_and_other_documents_left(spark, documents):
    rng = random.Random(8)
    passages = [prose(rng, 55) for _ in range(40)]
    rows = [(i, f"{prose(rng, 80)} {passages[i % 40]} {prose(rng, 80)}") for i in range(80)]
    rows += [(1000 + i, prose(rng, 200)) for i in range(80)]
    out = {r.id: r for r in chunk_dedup.remove_repeats(documents(rows)).collect()}
    assert all(out[i].n_removed >= 100 for i in range(40, 80))
    assert not any(r.n_removed for i, r in out.items() if i < 40 or i >= 1000)


def test_empty_table(spark, documents):
    assert chunk_dedup.remove_repeats(documents([]).limit(0)).count() == 0


def test_short_copies_and_repeats_inside_a_document_go(spark, documents):
    rng = random.Random(9)
    short, other, passage = "a short text of few words", "one that is unlike", prose(rng, 150)
    rows = [(1, short), (2, short), (3, other), (4, passage * 50), (None, short)]
    out = {r.id: r for r in chunk_dedup.remove_repeats(documents(rows)).collect()}
    assert {i: r.n_removed for i, r in out.items() if i != 4} == {1: 0, 2: len(short), 3: 0, None: 0}
    assert bytes(out[4].kept).startswith(passage[:-100].encode())
    assert len(out[4].kept) < 2 * len(passage) and out[4].n_removed + len(out[4].kept) == 50 * len(passage)
    alone = chunk_dedup.remove_repeats(documents([(4, passage * 50)])).collect()
    assert bytes(alone[0].kept) == bytes(out[4].kept)
