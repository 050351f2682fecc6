from __future__ import annotations

import json

import lake
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.drift import drift_report, unfold, unknown_values
from candlewick.plans import drift
from candlewick.plans.bronze import mismatched_values
from candlewick.sources import read_landing

FIELDS = (
    "id bigint, price double, active boolean, who struct<name: string, rank: bigint>, "
    "parts array<struct<ticker: string, score: double>>, codes array<bigint>"
)


def schema():
    return T.StructType.fromDDL(FIELDS)


def report(spark, lines):
    df = spark.createDataFrame([(x if isinstance(x, (str, type(None))) else json.dumps(x),) for x in lines], "value string")
    rows = drift_report(unfold(df, schema()), schema()).collect()
    return {(r.path, r.landed): (r.declared, r.n_values, r.n_lost, r.status) for r in rows}


def test_new_fields_at_every_level_are_reported(spark):
    found = report(spark, [{"id": 1, "new": {"a": [1]}, "who": {"name": "x", "more": True}, "parts": [{"ticker": "A", "z": "q"}]}])
    assert found["new", "OBJECT"] == (None, 1, 0, "unknown")
    assert found["who.more", "BOOLEAN"] == (None, 1, 0, "unknown")
    assert found["parts[].z", "STRING"] == (None, 1, 0, "unknown")
    assert not any(path.startswith("new.") for path, _ in found)
    assert found["who", "OBJECT"][3] == found["parts[]", "OBJECT"][3] == found["id", "BIGINT"][3] == "ok"


def test_moved_types_and_bad_nested_values_are_lost(spark):
    found = report(
        spark,
        [
            {"id": "7", "price": "n/a", "who": {"rank": "high"}, "parts": [{"score": 1}, {"score": "bad"}, None, 3]},
            {"id": 7, "price": 2, "who": "The Wire", "parts": {"ticker": "A"}, "codes": [1, "x", None]},
            {"active": "yes", "who": None, "parts": None, "codes": 5},
        ],
    )
    lost = {key: value[1:3] for key, value in found.items() if value[3] == "lost"}
    assert lost == {
        ("id", "STRING"): (1, 1),
        ("price", "STRING"): (1, 1),
        ("active", "STRING"): (1, 1),
        ("who", "STRING"): (1, 1),
        ("who.rank", "STRING"): (1, 1),
        ("parts", "OBJECT"): (1, 1),
        ("parts[]", "BIGINT"): (1, 1),
        ("parts[].score", "STRING"): (1, 1),
        ("codes", "BIGINT"): (1, 1),
        ("codes[]", "STRING"): (1, 1),
    }
    assert found["parts[]", "VOID"] == ("struct<ticker:string,score:double>", 1, 0, "ok")
    assert found["price", "BIGINT"][3] == "ok"


def test_lost_is_what_the_reader_loses(spark):
    values = [1, -3, 1.5, 1e300, "5", "", "NaN", True, None, [1], {"a": 1}, 2**70]
    lines = spark.createDataFrame([(i, json.dumps({"id": v, "price": v, "active": v})) for i, v in enumerate(values)], "i int, value string")
    read = lines.select("i", F.from_json("value", schema()).alias("r")).select("i", "r.id", "r.price", "r.active")
    kept = {(r.i, c) for r in read.collect() for c in ("id", "price", "active") if r[c] is not None}
    unfolded = unfold(lines, schema(), keep=["i"])
    for i, value in enumerate(values):
        for row in drift_report(unfolded.where(F.col("i") == i), schema()).collect():
            assert (row.n_lost == 0) == ((i, row.path) in kept or value is None), (value, row)


def test_unreadable_blank_and_empty(spark):
    found = report(spark, ["", "  ", None, '{"id": 1', "[1]", "3", '{"id": 1, "id": 2}', "{}"])
    assert found == {("$", "UNREADABLE"): (None, 4, 4, "lost")}
    assert report(spark, []) == {}


def test_unknown_values_are_kept_as_variant(spark):
    lines = spark.createDataFrame([(1, '{"id": 1, "x": {"a": [1, 2]}}'), (2, '{"x": "t"}')], "k int, value string")
    rows = unknown_values(unfold(lines, schema(), keep=["k"]))
    assert dict(rows.dtypes)["value"] == "variant"
    assert sorted((r.k, r.path, r.j) for r in rows.select("k", "path", F.to_json("value").alias("j")).collect()) == [
        (1, "x", '{"a":[1,2]}'),
        (2, "x", '"t"'),
    ]


def test_one_parse_and_no_shuffle_before_the_counts(spark):
    lines = spark.range(10).select(F.lit('{"id": 1}').alias("value"))
    plan = unfold(lines, schema())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("Generate explode") == 1


def test_landed_news_with_a_bad_publisher(spark, tmp_path):
    odd = {**lake.article("N2"), "publisher": "The Wire", "premium": True}
    odd["insights"][0]["confidence"] = 0.5
    lake.write(tmp_path, "news", "2026-08-17", [lake.article("N1"), odd])
    rows = {(r.path, r.landed): r for r in drift.landing_drift(spark, str(tmp_path), ["news"]).collect()}
    assert rows["record.publisher", "STRING"].n_lost == 1
    assert rows["record.premium", "BOOLEAN"].status == "unknown"
    assert rows["record.insights[].confidence", "DECIMAL"].status == "unknown"
    assert rows["record.title", "STRING"].n_values == 2
    first_level = {r.column_name: r.rejected for r in mismatched_values(read_landing(spark, str(tmp_path), "news"), "news").collect()}
    assert first_level["publisher"] == 1
    kept = drift.landing_unknown(spark, str(tmp_path), "news")
    assert {"date", "_source_file", "path", "landed", "value"} == set(kept.columns)
    assert kept.count() == 2
