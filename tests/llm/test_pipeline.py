from __future__ import annotations

import hashlib
import os
import random
import shutil
import struct

import duckdb
import public_tokenizers
import pytest
from oracle_compare import difference, oracle_connection
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from candlewick.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registration():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "personal_data",
        "bpe_encoding",
    ]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_document_or_vector_comes_back(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    table = "embeddings" if name.startswith("op5") else "pages" if name.startswith("op12") else "documents"
    total = duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/{table}.parquet'").fetchall()[0][0]
    if name.startswith(("op4", "op10", "op11")):
        assert rows
    else:
        assert len(rows) == total


@pytest.fixture
def folder(tmp_path):
    def make(rows):
        connection = duckdb.connect()
        connection.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
        connection.executemany("INSERT INTO d VALUES (?, ?, ?, 's', ?)", [(i, t, g, None if t is None else len(t)) for i, t, g in rows])
        connection.execute(f"COPY d TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
        shutil.copy(f"{SF_DIR}/benchmark.parquet", f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def test_stages_on_planted_rows(spark, folder):
    rng = random.Random(1)
    english = "the and of with this thing there house mountain river letter answer question morning evening".split()
    prose = lambda: " ".join(rng.choices(english, k=80)) + " " + "".join(rng.choices("abcdefgh", k=9))
    item = duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet' ORDER BY item_id LIMIT 1").fetchall()[0][0]
    copy, leak, personal = prose(), f"{prose()} {item} {prose()}", f"{prose()} write to ann@mail.example.com {prose()}"
    rows = [(i, prose(), "en") for i in range(40)]
    rows += [(50, copy, "en"), (51, copy, "en"), (51, copy, "en"), (60, leak, "en"), (70, personal, "en")]
    rows += [(80, None, "en"), (81, "", None), (82, "1234 !!", "en"), (None, prose(), "en"), (None, leak + " x", "en")]
    path = folder(rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        kept[name] = docs.collect()
        if name != "bpe_encoding":
            assert docs.columns == COLUMNS
    ids = {n: sorted(str(r.doc_id) for r in found) for n, found in kept.items()}
    clean = [str(i) for i in range(40)]
    assert ids["language_id"] == sorted([*clean, "50", "51", "51", "60", "70", "None", "None"])
    assert ids["simhash_near_dedup"] == sorted([*clean, "50", "60", "70", "None", "None"])
    assert ids["benchmark_decontamination"] == sorted([*clean, "50", "70", "None"])
    assert ids["personal_data"] == ids["benchmark_decontamination"] == ids["bpe_encoding"]
    texts = {r.doc_id: r for r in kept["personal_data"]}
    assert "ann@" not in texts[70].text and "[EMAIL]" in texts[70].text and texts[70].n_chars == len(texts[70].text)
    assert all(texts[i].text == rows[i][1] for i in range(40))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for row in kept["bpe_encoding"]:
        if row.doc_id is not None:
            encoded = library.encode(texts[row.doc_id].text, add_special_tokens=False).ids
            assert row.n_tokens == len(encoded)
            assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(encoded)}I", *encoded)).hexdigest()


def test_of_repeated_ids_one_row_stays(spark, folder):
    path = folder([(5, "a b c", "en"), (5, "a b c", "en"), (6, "a b c", "en"), (7, "x y z", "en")])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, path).collect()
    assert sorted(r.doc_id for r in kept) == [5, 7]


def test_rows_of_one_id_are_one_document_only_if_their_texts_are(spark, folder):
    rows = [(5, "one quite long text of its own", "en"), (5, "alpha beta gamma delta", "en"), (6, "alpha beta gamma delta", "en"), (4, None, "en"), (9, "", "en")]
    path = folder([*rows, (None, "alpha beta gamma delta", "en")])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, path).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("5", "alpha beta gamma delta"), ("5", "one quite long text of its own"), ("None", "alpha beta gamma delta")]
    assert [r.doc_id for r in kept if not r.text] == [4]


def test_without_labels_and_of_short_texts_every_document_with_letters_stays(spark, folder):
    prose = "the house of the rivers and the mountain"
    path = folder([(i, f"{prose} {i}", None) for i in range(20)] + [(30, None, None)])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.language_id(spark, docs, path).count() == 21
    langs = ["en", "fr", "de", "es"]
    path = folder([(i, f"{prose} {i}", langs[i % 4]) for i in range(40)] + [(50, "house", None), (51, "Rio", None), (52, "123", None)])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, path).collect()}
    assert kept >= {*range(40), 50, 51} and 52 not in kept


def test_run_applies_all_stages(spark, folder):
    rows = [(i, f"the house of the {i} rivers and the mountain number {i * 7}", "en") for i in range(30)]
    out = corpus_pipeline.run(spark, folder(rows))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() <= 30


def test_empty_documents(spark, folder):
    path = folder([(1, "x", "en")])
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0, name
