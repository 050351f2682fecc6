from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from candlewick.operators import dedup_latest, event_sequence, top_k_recent
from candlewick.operators.ranking import SPLITS, _parts_by_quantile


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_tie_has_the_same_survivor_on_every_partitioning(spark):
    rows = [(k, 1, f"v{i}") for k in range(20) for i in range(30)]
    survivors = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, t int, v string").repartition(seed + 1)
        latest = dedup_latest(df, ["k"], [F.col("t").desc()])
        survivors.add(tuple(sorted(map(tuple, latest.collect()))))
    assert len(survivors) == 1
    assert {v for _, _, v in survivors.pop()} == {"v9"}


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(4)
    top = top_k_recent(df, ["k"], [F.col("id").desc()], 2)
    assert sorted(map(tuple, top.collect())) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    lines = plan_of(top).splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line)
    assert partial > exchange  # printed below, that is, run before it


def brute_force(rows):
    seq = {}
    by_key = {}
    for key, day, event in rows:
        by_key.setdefault(key, []).append((day, event))
    for key, events in by_key.items():
        events.sort(key=lambda e: e[1])
        events.sort(key=lambda e: (e[0] is not None, e[0] or ""), reverse=True)
        for at, (_, event) in enumerate(events, 1):
            seq[(key, event)] = at
    return seq


def test_event_sequence_equals_brute_force_with_a_hot_key_and_nulls(spark):
    rng = random.Random(7)
    rows = []
    for event in range(3000):
        key = 1 if event % 3 == 0 else rng.choice([None, *range(2, 40)])
        day = rng.choice([None, *[f"2024-01-{d:02d}" for d in range(1, 10)]])
        rows.append((key, day, event))
    df = spark.createDataFrame(rows, "k int, d string, e int").repartition(5)
    expected = brute_force(rows)
    for block in (None, F.floor(F.col("e") / 100)):
        numbered = event_sequence(df, "k", "d", "e", id_block=block).collect()
        assert len(numbered) == len(rows)
        assert {(r.k, r.e): r.event_seq for r in numbered} == expected


def test_event_sequence_never_partitions_rows_by_the_key_alone(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 1)], "k int, d string, e int").repartition(2)
    numbered = event_sequence(df, "k", "d", "e")
    for line in plan_of(numbered).splitlines():
        if "Exchange hashpartitioning(_key" in line and "_day" not in line:
            # only block counts are gathered by key
            assert "_before" not in line
    windows = [line for line in plan_of(numbered).splitlines() if "row_number()" in line]
    assert windows and all("_day" in line for line in windows)


@pytest.mark.parametrize(
    ("kind", "make"),
    [
        ("int", lambda i: i * 3 - 500),
        ("double", lambda i: i / 7),
        ("date", lambda i: date(2000, 1, 1) + timedelta(days=i)),
        ("string", lambda i: f"event-of-the-day-{i:06d}"),
        ("string", lambda i: "é\0" * (i % 3) + f"{i}"),
        ("string", lambda i: "x" * i),
        ("binary", lambda i: bytes([i // 256, i % 256])),
    ],
)
def test_a_hot_date_is_cut_at_quantiles_of_any_kind_of_id(spark, kind, make):
    rng = random.Random(11)
    ids = [make(i) for i in range(1200)]
    if kind == "string":
        ids.sort(key=lambda s: s.encode())
    rows = [(1 if i % 3 else rng.randint(2, 9), "2024-01-02" if i % 3 else f"2024-01-0{i % 7 + 1}", e) for i, e in enumerate(ids)]
    order = {e: i for i, e in enumerate(ids)}
    df = spark.createDataFrame([*rows, (1, "2024-01-02", None)], f"k int, d string, e {kind}").repartition(4)
    numbered = event_sequence(df, "k", "d", "e", split_rows=200)
    expected = brute_force([(k, d, order[e]) for k, d, e in rows])
    found = {(r.k, order[bytes(r.e) if kind == "binary" else r.e]): r.event_seq for r in numbered.collect() if r.e is not None}
    last = expected[1, 1199] + 1  # a missing id comes last on its date
    assert numbered.where("e IS NULL").first().event_seq == last
    assert {k: v - (k[0] == 1 and v > last) for k, v in found.items()} == expected


def test_only_hot_dates_are_cut_and_evenly(spark):
    rows = [(1, "a", f"id-{i:07d}") for i in range(6400)] + [(i % 50, "b", f"x{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, d string, e string")
    parts = _parts_by_quantile(df, ["k", "d"], "e", 1000).groupBy("k", "d", "_part").count().collect()
    hot = [r["count"] for r in parts if r.d == "a"]
    assert len(hot) == SPLITS and max(hot) <= 150
    assert len([r for r in parts if r.d == "b"]) == 50


def test_the_number_of_an_id_is_computed_once_a_row(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), f"id{i:05}") for i in range(300)], "k string, d date, e string")
    split = _parts_by_quantile(df, ["k", "d"], "e", 100)
    assert split.select("_part").distinct().count() > 32
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan  # which would compute it for every cut
    above_the_join = plan[: plan.index("Join")]
    assert "regexp_extract" not in above_the_join  # nor what the ids of a group share for every row
