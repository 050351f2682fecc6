"""Cutting texts into numbered stretches by Arrow, and the bounds of what a worker keeps."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from candlewick.llm import common, decontamination, language
from candlewick.llm.common import LONGEST_REMEMBERED, Remembered, held, joined, slices, stretches

TEXTS = ["a b  a", "", None, " x\ty\n", "é\u3000b\x1cc\x85d", "b", "\n\n"]


def test_stretches_are_those_between_ascii_white_space():
    distinct, codes, edges = stretches(pa.array(TEXTS, pa.string()))
    cut = [[distinct[c] for c in codes[a:b]] for a, b in zip(edges, edges[1:], strict=False)]
    assert [[s for s in part if s] for part in cut] == [[s.decode() for s in (t or "").encode().split()] for t in TEXTS]
    assert len(set(distinct)) == len(distinct)
    sliced = stretches(pa.array(["z z", *TEXTS], pa.string()).slice(1))
    assert [sliced[0][c] for c in sliced[1]] == [distinct[c] for c in codes] and (sliced[2] == edges).all()


def test_stretches_between_separators_join_to_the_text():
    texts = ["a b c", "", " lead", "trail ", "one"]
    distinct, codes, edges = stretches(pa.array(texts), " ")
    assert [x.decode() for x in joined([d.encode() for d in distinct], codes, edges, b" ").to_pylist()] == texts


def test_slices_hold_every_row_and_so_many_bytes():
    rng = random.Random(3)
    texts = [None if rng.random() < 0.1 else "x" * rng.choice([0, 3, 10, 500]) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts, pa.string())], ["id", "text"])
    parts = list(slices(batch, 1, 600, 40))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(300))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 600 for p in parts)
    assert max(p.num_rows for p in parts) <= 40
    assert list(slices(batch.slice(0, 0), 1)) == []


def test_long_keys_are_not_remembered_and_a_new_stage_frees_the_old_one():
    made = []
    memory = Remembered(10, lambda k: made.append(k) or len(k))
    long = "y" * (LONGEST_REMEMBERED + 1)
    assert [memory["a"], memory["a"], memory[long], memory[long]] == [1, 1, len(long), len(long)]
    assert made == ["a", long, long]
    first = held("one", list)
    assert held("one", list) is first
    held("two", list)
    assert list(common._HELD) == ["two"]


def test_words_as_numbers_are_those_between_any_white_space_without_marks():
    texts = [*TEXTS, "Ab-c, --- (ÄB) 12.5", "ab_c"]
    words = [["".join(c for c in w.lower() if c.isalnum()) for w in (t or "").split()] for t in texts]
    expected = [np.array([zlib.crc32(w.encode()) % decontamination.FEATURES for w in found if w], "<i4").tobytes() for found in words]
    assert decontamination.words_of(pa.array(texts, pa.string())).to_pylist() == expected


def test_a_sample_ends_at_the_same_document_as_a_sort_by_place(spark, monkeypatch):
    monkeypatch.setattr(language, "_CELLS", 512)
    rows = [(i, "a" if i % 3 else "b" if i % 2 else "c") for i in range(9000)] + [(i, "few") for i in range(7)]
    docs = spark.createDataFrame(rows, "id long, lang string")
    placed = docs.select("lang", language._place().alias("p")).collect()
    expected = {}
    for lang in "abc":
        expected[lang] = sorted(r.p for r in placed if r.lang == lang)[19]
    assert language.cut_offs(docs, 20) == expected | {"few": 1 << 53}
    assert language.cut_offs(docs.limit(0), 20) == {}


def test_long_words_are_learnt_from_in_parts():
    model = language.Model(["a", "b", "ab"], ["x"], np.array([[0.2], [0.2], [0.5], [1e-6]]))
    short = model.expected(["ab" * 10], np.array([[1.0]]))
    long = model.expected(["ab" * 400], np.array([[1.0]]))
    assert 30 < long[2, 0] / short[2, 0] < 50
