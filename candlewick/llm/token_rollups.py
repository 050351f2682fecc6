"""Token counts kept by signed changes.

A change is a signed row: an insert adds a document's count to the totals of its source, language and tokenizer
version, a delete takes it away, a revision does both, with the old and the new numbers. Changes come in batches.
A batch is reduced to one row per total it touches and committed as a folder of its own, named by the batch id:

  <root>/deltas/batch=<id>/    the sums of one batch; complete once its _SUCCESS file is there
  <root>/totals/upto=<n>/      the sums of all batches listed in its `batches` column, made by compact()

Totals are additive, so they are the sum over the folders, in any order. A batch that is committed again, by a
retry or a second run, changes nothing; one that broke off is written anew. The work of a batch grows with the
batch alone, and reading with the number of totals.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import ship, slices, table, tokenizer_file
from candlewick.llm.token_files import byte_tokenizer
from candlewick.session import shared_dir

VOCABULARY = "byte_bpe_50k.json"
KEYS = ("source", "lang", "tokenizer")
_SUMS = "n_docs long, n_tokens long, n_bytes long"


def counts(
    docs: DataFrame, tokenizer: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, n_bytes) of each row, by a public byte-level vocabulary.

    A null text has no tokens and no bytes. The tokenizer column holds the vocabulary's name: its version.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_file(tokenizer), encoding="utf-8") as source:
        sent = spark.sparkContext.broadcast(source.read())
    key = uuid.uuid4().hex
    version = tokenizer.rpartition("/")[2].rpartition(".")[0] or tokenizer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_tokenizer(key, sent.value)
        for batch in batches:
            for part in slices(batch, 3):
                n = [len(ids) // 4 for ids in encode(part.column(3))]
                size = pc.fill_null(pc.binary_length(part.column(3)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(n, pa.int64()), size],
                    ["doc_id", "source", "lang", "n_tokens", "n_bytes"],
                )

    found = docs.select(
        F.col(id_col).cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col(text_col).cast("string")
    ).mapInArrow(run, "doc_id long, source string, lang string, n_tokens long, n_bytes long")
    return found.withColumn("tokenizer", F.lit(version))


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Rows of counts as changes: +1 inserts them, -1 deletes them."""
    return rows.select(*KEYS, "n_tokens", "n_bytes", F.lit(sign).alias("sign"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that put new counts in the place of old ones."""
    return signed(old, -1).unionByName(signed(new, 1))


class Rollup:
    """The committed totals below a root folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _folders(self, kind: str) -> list[str]:
        """Complete folders of a kind, by name."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        names = sorted(s.getPath().getName() for s in files.listStatus(place))
        return [n for n in names if self._exists(f"{self.root}/{kind}/{n}/_SUCCESS")]

    def committed(self) -> set[str]:
        """Batch ids that count, compacted ones included."""
        found = {n.partition("=")[2] for n in self._folders("deltas")}
        return found | set(self._compacted()[1])

    def _compacted(self) -> tuple[str | None, list[str]]:
        names = self._folders("totals")
        if not names:
            return None, []
        last = max(names, key=lambda n: int(n.partition("=")[2]))
        listed = self.spark.read.parquet(f"{self.root}/totals-of/{last}").collect()
        return last, [r.batch for r in listed]

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of changes (keys, n_tokens, n_bytes, sign); False if it has been added before.

        The rows are reduced before they are shuffled, so a source with a third of all rows sends one row per
        task. Null keys are totals of their own; a null sign or count adds nothing.
        """
        if not batch or "/" in batch:
            raise ValueError("a batch id is a file name")
        if batch in self.committed():
            return False
        count = lambda c: F.sum(F.coalesce(F.col("sign") * F.col(c), F.lit(0))).alias(c)
        sums = changes.groupBy(*KEYS).agg(
            F.sum(F.coalesce("sign", F.lit(0)).cast("long")).alias("n_docs"), count("n_tokens"), count("n_bytes")
        )
        sums.write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch}")
        return True

    def _sums(self) -> tuple[DataFrame, list[str], int]:
        last, inside = self._compacted()
        names = [n for n in self._folders("deltas") if n.partition("=")[2] not in set(inside)]
        paths = [f"{self.root}/deltas/{n}" for n in names] + ([f"{self.root}/totals/{last}"] if last else [])
        schema = ", ".join([f"{k} string" for k in KEYS]) + ", " + _SUMS
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        number = int(last.partition("=")[2]) if last else 0
        return rows, inside + [n.partition("=")[2] for n in names], number

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens, n_bytes); totals that came back to nothing are left out."""
        rows, _, _ = self._sums()
        sums = [F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_bytes")]
        return rows.groupBy(*KEYS).agg(*sums).where("n_docs != 0 OR n_tokens != 0 OR n_bytes != 0")

    def compact(self) -> None:
        """Fold all batches into one folder; the ids stay listed, so that they stay committed."""
        rows, batches, number = self._sums()
        if not batches:
            return
        listed = self.spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.root}/totals-of/upto={number + 1}")
        sums = [F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_bytes")]
        rows.groupBy(*KEYS).agg(*sums).write.mode("overwrite").parquet(f"{self.root}/totals/upto={number + 1}")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted with a count by characters; of one in ten the draft is deleted again, as if its
    revision came late; then every document gets its count by the byte-level vocabulary, in the place of a draft
    that still stands or as an insert; the last batch comes twice. The totals cover all documents."""
    docs = table(spark, sf_dir, "documents")
    rollup = Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    drafts = docs.select(
        "source",
        "lang",
        "doc_id",
        F.lit("characters").alias("tokenizer"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    late = F.coalesce(F.pmod("doc_id", F.lit(10)) == 3, F.lit(False))
    rollup.commit("insert", signed(drafts, 1))
    rollup.commit("delete", signed(drafts.where(late), -1))
    final = counts(docs)
    for _ in range(2):
        rollup.commit("revise", revised(drafts.where(~late), final))
    rollup.compact()
    return rollup.totals()
