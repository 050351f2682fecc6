from __future__ import annotations

import os

import lake
import pytest
from pyspark.sql import DataFrame

from candlewick.plans import bronze
from candlewick.session import shared_dir

NEWS = ["news_articles", "news_sentiment"]


def test_both_tables_equal_their_own_projection(spark, tmp_path):
    root = str(tmp_path / "landing")
    lake.fill(root)
    lake.write(root, "news", "2026-08-17", [lake.article("N3", None), lake.article("N4", ()), {"id": None}])
    (tmp_path / "landing" / "news" / "date=2026-08-17" / "broken.jsonl").write_text('{"record": {"id": "N5"\n\n')
    envelopes = bronze.landed(spark, root, NEWS[0])
    parts = bronze.fan_out(envelopes, NEWS, str(tmp_path / "staged"))
    for table in NEWS:
        alone = bronze.project(envelopes, table)
        assert parts[table].schema.simpleString() == alone.schema.simpleString()
        assert alone.count() > 0 and alone.exceptAll(parts[table]).isEmpty() and parts[table].exceptAll(alone).isEmpty()
        assert "json" not in parts[table]._jdf.queryExecution().executedPlan().toString().lower()
    assert bronze.fan_out(envelopes, NEWS[1:], str(tmp_path / "one"))[NEWS[1]].count() == parts[NEWS[1]].count()


def test_no_envelopes(spark, tmp_path):
    root = str(tmp_path / "landing")
    lake.fill(root)
    parts = bronze.fan_out(bronze.landed(spark, root, NEWS[0]).limit(0), NEWS, str(tmp_path / "staged"))
    assert [parts[t].count() for t in NEWS] == [0, 0]


def test_a_load_parses_news_once_and_keeps_nothing(spark, db, tmp_path, monkeypatch):
    root = str(tmp_path / "landing")
    lake.fill(root)
    lake.write(root, "news", "2026-08-17", [{"id": None}])
    parsed, real = [], bronze.read_landing
    monkeypatch.setattr(bronze, "read_landing", lambda s, r, source: parsed.append(source) or real(s, r, source))
    monkeypatch.setattr(DataFrame, "persist", lambda *a: pytest.fail("persisted"))
    counts = bronze.load_bronze(spark, landing_root=root, schema=db)
    assert parsed.count("news") == 1
    assert counts["news_articles"] == {"appended": 2, "quarantined": 1}
    assert counts["news_sentiment"]["appended"] == 4
    assert not [f for f in os.listdir(shared_dir(spark)) if f.startswith("fan-out-")]
    again = bronze.load_bronze(spark, landing_root=root, schema=db)
    assert all(c == {"appended": 0, "quarantined": 0} for c in again.values())


def test_an_envelope_is_staged_as_one_row(spark, tmp_path):
    root = str(tmp_path / "landing")
    lake.fill(root)
    envelopes = bronze.landed(spark, root, NEWS[0])
    bronze.fan_out(envelopes, NEWS, str(tmp_path / "staged"))
    assert spark.read.parquet(str(tmp_path / "staged")).count() == envelopes.count()


def test_a_load_of_known_rows_looks_up_keys_alone(spark, db, tmp_path, monkeypatch):
    root = str(tmp_path / "landing")
    lake.fill(root)
    lake.write(root, "splits", "2026-08-17", [{"id": None}])
    looked_up, real = [], bronze.exclude_existing
    monkeypatch.setattr(bronze, "exclude_existing", lambda *a, **k: looked_up.append(k.get("stored")) or real(*a, **k))
    first = bronze.load_bronze(spark, landing_root=root, schema=db)
    assert first["splits"]["quarantined"] == 1 and looked_up == [None] * 6
    lake.write(root, "splits", "2026-08-18", [lake.split("later"), lake.split("later"), {"id": None, "ticker": "X"}])
    counts = bronze.load_bronze(spark, landing_root=root, schema=db)
    assert None not in looked_up[6:]
    assert counts.pop("splits") == {"appended": 2, "quarantined": 1}
    assert all(c == {"appended": 0, "quarantined": 0} for c in counts.values())
    assert not [f for f in os.listdir(shared_dir(spark)) if f.startswith("new-keys-")]
