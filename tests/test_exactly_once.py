"""Promotion and reload that stop at every step: each line once, all tables or none."""

from __future__ import annotations


import lake
import pytest

from candlewick.plans import bronze
from candlewick.sources import promotion, tables
from candlewick.sources.promotion import promote
from candlewick.sources.registry import TABLES
from candlewick.sources.tables import append_table, replace_all, table_or_none


class Stop(RuntimeError):
    pass


def stopping(module, monkeypatch, name, calls=1):
    """Let a function of the module stop the run when it is called for the given time, before it does anything."""
    real, seen = getattr(module, name), []

    def instead(*args, **kwargs):
        seen.append(1)
        if len(seen) == calls:
            raise Stop(name)
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, instead)


def promoted(spark, tmp_path, db):
    promote(spark, str(tmp_path / "dev"), str(tmp_path / "prod"), f"{db}.ledger", ["splits"])


def lines(spark, tmp_path):
    return sorted(r.value for r in spark.read.text(str(tmp_path / "prod" / "splits")).collect())


@pytest.mark.parametrize(
    ("step", "calls"),
    [("_list_staged", 1), ("_publish", 1), ("_hadoop_path", 3), ("append_table", 1)],
    ids=["staged", "decided", "one file moved", "published"],
)
def test_a_promotion_that_stops_leaves_each_line_once(spark, db, tmp_path, monkeypatch, step, calls):
    for day in ("2026-08-17", "2026-08-18"):
        lake.write(tmp_path / "dev", "splits", day, [lake.split(), lake.split()])
    with monkeypatch.context() as patch:
        stopping(promotion, patch, step, calls)
        with pytest.raises(Stop):
            promoted(spark, tmp_path, db)
    lake.write(tmp_path / "dev", "splits", "2026-08-18", [lake.split()])  # comes before the next run
    for _ in range(2):
        promoted(spark, tmp_path, db)
        wanted = sorted(r.value for r in spark.read.text(str(tmp_path / "dev" / "splits")).collect())
        assert lines(spark, tmp_path) == wanted and len(wanted) == 5
    listed = [r.relative_path for r in spark.table(f"{db}.ledger").collect()]
    assert len(listed) == len(set(listed)) > 0
    assert not spark.catalog.tableExists(f"{db}.ledger__manifest")


def test_a_move_that_copied_but_did_not_delete_is_done_again(spark, db, tmp_path):
    lake.write(tmp_path / "dev", "splits", "2026-08-17", [lake.split()])
    promoted(spark, tmp_path, db)
    (there,) = (tmp_path / "prod" / "splits").rglob("part-*.txt")
    staged = tmp_path / "prod" / "_promotion" / "splits" / "date=2026-08-17" / there.name
    staged.parent.mkdir(parents=True, exist_ok=True)
    staged.write_bytes(there.read_bytes())
    spark.createDataFrame([(staged.as_uri(), there.as_uri())], "staged string, target string").write.saveAsTable(f"{db}.ledger__manifest")
    promoted(spark, tmp_path, db)
    assert len(lines(spark, tmp_path)) == 1 and spark.table(f"{db}.ledger").count() == 1


def contents(spark, db):
    return {t: spark.table(f"{db}.{t}").count() for t in TABLES}


@pytest.fixture
def loaded(spark, db, tmp_path):
    lake.fill(tmp_path, days=3)
    bronze.load_bronze(spark, landing_root=str(tmp_path), schema=db)
    for t in TABLES:  # what a reload takes away again
        append_table(spark.table(f"{db}.{t}").limit(1), f"{db}.{t}")
    return contents(spark, db)


def test_a_reload_that_fails_in_the_fifth_table_leaves_all_old_ones(spark, db, tmp_path, loaded, monkeypatch):
    with monkeypatch.context() as patch:
        stopping(bronze, patch, "new_rows", 5)
        with pytest.raises(Stop):
            bronze.reload_bronze(spark, landing_root=str(tmp_path), schema=db)
    assert contents(spark, db) == loaded
    assert not [t.name for t in spark.catalog.listTables(db) if "__staged" in t.name or "__decided" in t.name]
    bronze.reload_bronze(spark, landing_root=str(tmp_path), schema=db)
    assert contents(spark, db) == {t: n - 1 for t, n in loaded.items()}


@pytest.mark.parametrize("renames", [1, 4, 5])
def test_a_reload_that_stops_among_the_swaps_is_finished_by_the_next_access(spark, db, monkeypatch, renames):
    names = [f"{db}.t{k}" for k in range(3)]
    for name in names:
        append_table(spark.range(2).toDF("a"), name)
    with monkeypatch.context() as patch:
        stopping(tables, patch, "_rename", renames)
        with pytest.raises(Stop):
            replace_all({name: lambda: spark.range(5).toDF("a") for name in names}, spark)
    assert [table_or_none(spark, name).count() for name in reversed(names)] == [5, 5, 5]
    assert sorted(t.name for t in spark.catalog.listTables(db)) == ["t0", "t1", "t2"]


def test_tables_of_two_schemas_are_refused(spark):
    with pytest.raises(ValueError):
        replace_all({"a.t": lambda: spark.range(1), "b.t": lambda: spark.range(1)}, spark)
