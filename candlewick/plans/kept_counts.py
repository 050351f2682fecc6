"""Data tests of a table from counts that its changes keep up to date, instead of from the whole table.

Each change of a table is a batch of signed rows: +1 for a row that came, -1 for one that went; a revised row is both.
Beside the table ``t`` stand

* ``t__<test>`` for each test on keys: (key columns, n, attempt), what a batch added to or took from a key's rows;
* ``t__counted``: (batch, attempt, test_name, violations), by how much a batch changed the violations of a test.

A batch that is small beside the counts looks up those of its own keys alone, through a key index, so new keys open no file;
a large one is grouped together with all counts, and the index reads what it lacks when a small batch needs it. A row of counts holds
only if its attempt is in ``t__counted``, which is written last and in one file: a batch that stopped leaves nothing that
counts, and one that is given again changes nothing. Tests for NULL are summed over the batch in a job of their own;
metrics observed while writing could count a repeated task twice. One writer per table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.quality import COMBINATION, NOT_NULL, SINGLE_CURRENT, UNIQUE, Check
from candlewick.sources.key_index import KeyIndex
from candlewick.sources.tables import append_table, replace_table, table_or_none

SIGN = "_sign"
_FOLDED = "folded"
#: A batch of at least one key for so many rows of counts is large: it is added up with all of them.
LARGE = 64


@dataclass(frozen=True)
class KeptCounts:
    """The tests ``checks`` of one table, named ``table``, kept up to date batch by batch."""

    spark: SparkSession
    table: str
    checks: Sequence[Check]

    def _counts(self, check: Check) -> str:
        return f"{self.table}__{check.name}"

    @property
    def _ledger(self) -> str:
        return f"{self.table}__counted"

    def apply(self, changes: DataFrame, batch: str) -> bool:
        """Take in a batch of signed rows (``_sign`` is +1 or -1); False if it was taken in before.

        The batch is read once per test on keys and once more for the tests for NULL.
        """
        ledger = table_or_none(self.spark, self._ledger)
        if ledger is not None and not ledger.filter(F.col("batch") == batch).isEmpty():
            return False
        attempt = uuid.uuid4().hex
        found = self._nulls(changes)
        for check in self.checks:
            if check.kind in (UNIQUE, COMBINATION, SINGLE_CURRENT):
                found[check.name] = self._keys(changes, check, attempt)
            elif check.kind != NOT_NULL:
                raise ValueError(f"unknown check {check.kind!r}")
        entries = [(batch, attempt, name, violations) for name, violations in found.items()]
        listed = self.spark.createDataFrame(entries, "batch string, attempt string, test_name string, violations long")
        append_table(listed.coalesce(1), self._ledger)
        return True

    def _nulls(self, changes: DataFrame) -> dict[str, int]:
        tests = [c for c in self.checks if c.kind == NOT_NULL]
        if not tests:
            return {}
        weight = F.col(SIGN).cast("long")
        sums = changes.agg(*[F.sum(F.when(F.col(c.columns[0]).isNull(), weight).otherwise(0)) for c in tests]).first()
        return {c.name: n or 0 for c, n in zip(tests, sums, strict=True)}

    def _live(self) -> DataFrame:
        folded = self.spark.range(1).select(F.lit(_FOLDED).alias("attempt"))
        ledger = table_or_none(self.spark, self._ledger)
        return folded if ledger is None else folded.union(ledger.select("attempt").distinct())

    def _keys(self, changes: DataFrame, check: Check, attempt: str) -> int:
        """Write what the batch does to each key, and return the change in keys with more than one row."""
        keys, name = list(check.columns), self._counts(check)
        rows = changes
        if check.kind == UNIQUE:
            rows = rows.filter(F.col(keys[0]).isNotNull())
        elif check.kind == SINGLE_CURRENT:
            rows = rows.filter("is_current")
        change = rows.groupBy(*keys).agg(F.sum(F.col(SIGN).cast("long")).alias("n")).filter("n != 0")
        first = table_or_none(self.spark, name) is None
        append_table(change.withColumn("attempt", F.lit(attempt)), name)
        # Read back: its size is known then, and one file holds one attempt, so the others are left out by their bounds.
        own = self.spark.table(name).filter(F.col("attempt") == attempt).select(*keys, "n")
        sides = own.select(*keys, F.col("n").alias("added"), F.lit(0).cast("long").alias("before"))
        known = None if first else self._known(name, keys, own, attempt)
        if known is not None:
            sides = sides.unionByName(known.select(*keys, F.lit(0).cast("long").alias("added"), F.col("n").alias("before")))
        totals = sides.groupBy(*keys).agg(F.sum("before").alias("before"), F.sum("added").alias("added"))
        after = F.count_if(F.col("before") + F.col("added") > 1)
        return totals.agg(after - F.count_if(F.col("before") > 1)).first()[0] or 0

    def _known(self, name: str, keys: list[str], own: DataFrame, attempt: str) -> DataFrame | None:
        """The counts that hold of the batch's keys; of a large batch, those of other keys come with them. They change no
        violations, and to group them all costs less than to build filters of the keys and look each of them up."""
        stored = self.spark.table(name)
        n, before = stored.agg(F.count_if(F.col("attempt") == attempt), F.count_if(F.col("attempt") != attempt)).first()
        if n * LARGE >= before:
            return stored.filter(F.col("attempt") != attempt).join(self._live(), "attempt", "left_semi")
        found = KeyIndex(self.spark, name, tuple(keys)).existing(own.select(*keys))[0]
        if found is None:
            return None
        asked = own.select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        return found.join(self._live(), "attempt", "left_semi").join(asked, same, "left_semi")

    def report(self) -> DataFrame:
        """test_name, model, violations, status as the full report gives them, from the ledger alone."""
        tests = self.spark.createDataFrame([(c.name, c.model) for c in self.checks], "test_name string, model string")
        ledger = table_or_none(self.spark, self._ledger)
        if ledger is None:
            sums = tests.withColumn("violations", F.lit(0).cast("long"))
        else:
            violations = ledger.groupBy("test_name").agg(F.sum("violations").alias("violations"))
            sums = tests.join(violations, "test_name", "left").fillna(0, ["violations"])
        return sums.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("fail"))

    def fold(self) -> None:
        """Replace the many rows of a key by one and drop keys without rows; the reports stay as they are. Worth it once
        the counts are several times as many as the keys."""
        for check in self.checks:
            stored = None if check.kind == NOT_NULL else table_or_none(self.spark, self._counts(check))
            if stored is not None:
                live = stored.join(self._live(), "attempt", "left_semi")
                sums = live.groupBy(*check.columns).agg(F.sum("n").alias("n")).filter("n != 0")
                replace_table(sums.withColumn("attempt", F.lit(_FOLDED)), self._counts(check))
