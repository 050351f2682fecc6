"""An index of the keys that the files of a table hold, so that an append opens only files that may know its keys.

Beside a table ``t`` stand

* ``t__index_files``: one row per data file: rows, and the least and greatest value of the range column;
* ``t__index_blocks``: a blocked Bloom filter of each file's keys;
* ``t__index_filter``: one filter of all keys of the table, 16 bits a key.

A lookup asks the table's filter first: a new key ends there. What may be known is asked of the files' filters, if its
range value lies within a file's bounds. Filters only ever say "may hold", so the exact anti-join stays; it reads the
files named and no others. The index is derived from the files: whatever file it lacks, it reads before a lookup, so a
stop at any point only leaves work to do; rows about files that are gone are passed over.

To the driver come names of files: those of the table, which Spark's own listing holds there as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import bloom
from candlewick.operators.joins import spread_join
from candlewick.sources.tables import append_table, replace_table, table_or_none

#: Keys that a file's filter is made for; one with more answers "may hold" more often.
KEYS_PER_FILE = 1 << 20
#: Keys that the table's filter is made for at first. Once they are exceeded it is built anew for four times the keys there are.
FIRST_CAPACITY = 1 << 20
_HASH = "_key_hash"


@dataclass(frozen=True)
class KeyIndex:
    """The index of ``table`` on ``keys`` and on key parts ``derived`` from other columns; ``range_col`` is a column that
    files can be told apart by, such as a date."""

    spark: SparkSession
    table: str
    keys: tuple[str, ...]
    derived: Mapping[str, Column] = field(default_factory=dict)
    range_col: str | None = None

    def _name(self, part: str) -> str:
        return f"{self.table}__index_{part}"

    def _files(self) -> dict[str, str]:
        """The table's data files by name."""
        rows = table_or_none(self.spark, self.table)
        return {} if rows is None else {path.rsplit("/", 1)[1]: path for path in rows.inputFiles()}

    def _read(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.spark.table(self.table).schema).parquet(*paths)

    def _hashed(self, rows: DataFrame, *more: Column) -> DataFrame:
        value = F.col(self.range_col) if self.range_col else F.lit(None).cast("string")
        on = [*[F.col(k) for k in self.keys], *self.derived.values()]
        return rows.select(F.xxhash64(*on).alias(_HASH), value.alias("value"), *more)

    def refresh(self) -> dict[str, str]:
        """Enter the files that the index lacks, and return all files of the table."""
        files = self._files()
        known = table_or_none(self.spark, self._name("files"))
        have = set() if known is None else {r.file for r in known.select("file").collect()}
        lacking = sorted(path for name, path in files.items() if name not in have)
        if not lacking:
            return files
        # The files table is written last: a file in it is in the other two.
        rows = self._hashed(self._read(lacking), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
        entries = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        append_table(bloom.filter_of(rows, _HASH, bloom.blocks_for(KEYS_PER_FILE), ["file"]), self._name("blocks"))
        self._extend_filter(rows, files)
        append_table(entries, self._name("files"))
        return files

    def _extend_filter(self, added: DataFrame, files: Mapping[str, str]) -> None:
        name = self._name("filter")
        known, filter_ = table_or_none(self.spark, self._name("files")), table_or_none(self.spark, name)
        before = 0 if known is None else known.agg(F.sum("n")).first()[0] or 0
        total = before + added.count()
        blocks = None if filter_ is None else filter_.select("blocks").first()
        if blocks is not None and bloom.blocks_for(total) <= blocks[0]:
            more = bloom.filter_of(added, _HASH, blocks[0])
            append_table(more.withColumn("blocks", F.lit(blocks[0])), name)
            return
        size = bloom.blocks_for(max(FIRST_CAPACITY, 4 * total))
        every = self._hashed(self._read(sorted(files.values())))
        replace_table(bloom.filter_of(every, _HASH, size).withColumn("blocks", F.lit(size)), name)

    def candidates(self, batch: DataFrame) -> list[str]:
        """The paths of the files that may hold a key of the batch."""
        files = self.refresh()
        if not files:
            return []
        filter_ = self.spark.table(self._name("filter"))
        asked = self._hashed(batch).distinct()
        size = filter_.select("blocks").first()[0]
        suspects = bloom.may_hold(asked, _HASH, bloom.merged(filter_.drop("blocks")), size)
        per_file = self.spark.table(self._name("blocks"))
        found = bloom.may_hold(suspects, _HASH, per_file, bloom.blocks_for(KEYS_PER_FILE))
        bounds = self.spark.table(self._name("files")).select("file", "low", "high").distinct()
        within = F.col("value").between(F.col("low"), F.col("high")) if self.range_col else F.lit(True)
        named = spread_join(found, bounds, ["file"], "inner").where(within).select("file").distinct()
        return sorted(files[r.file] for r in named.collect() if r.file in files)

    def existing(self, batch: DataFrame) -> tuple[DataFrame | None, int, int]:
        """(the stored rows of the files that may hold a key of the batch, or None; files to open; files there are)."""
        paths = self.candidates(batch)
        return (self._read(paths) if paths else None), len(paths), len(self._files())
