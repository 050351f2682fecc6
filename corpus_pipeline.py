"""From raw documents to token ids: language, near-duplicates, benchmark leaks, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm import bpe_dp, decontamination, language, pii, simhash
from candlewick.llm.common import free_name, stored, table

#: A document whose best language has a smaller share than this among all is rejected, like one without a letter.
LEAST_LANGUAGE_SCORE = 0.5
#: Texts of fewer characters are not rejected for their share: a word or two may belong to several languages.
SHORT_TEXT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language. Rejected are a null or empty text, one without a letter, and one of
    SHORT_TEXT characters or more whose best language has a share below LEAST_LANGUAGE_SCORE. If no document has a label,
    nothing can be learnt and every document stays."""
    model = language.fit_documents(spark, docs)
    if not model.languages:
        return docs
    found = language.predict(docs, model)
    sure = (F.col("score") >= LEAST_LANGUAGE_SCORE) | (F.length("text") < SHORT_TEXT)
    return found.where((F.col("lang_pred") != language.UNDETERMINED) & sure).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the least id (of rows with that id, the least by a hash of the text).

    Rows are told apart by id and text, so rows that share an id are one document only if their texts are the same or
    near. A document without an id is in no group and stays. Null and empty texts have the fingerprint zero and are one
    group. The texts are shuffled once, by id.
    """
    row, component, k = (free_name(docs, name) for name in ("__row", "__component", "__k"))
    keyed = docs.withColumn(row, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    found = simhash.near_duplicates(spark, keyed, id_col=row)
    groups = found.where("id IS NOT NULL").select(F.col("id").alias("node"), F.col("component").alias(component)).distinct()
    named = keyed.select("doc_id", row).where(F.col(row).isNotNull()).distinct().join(groups, F.col(row) == F.col("node"))
    first = named.groupBy(component).agg(F.min(F.struct("doc_id", row)).alias("first"))
    group = stored(spark, first.select(F.col("first.doc_id").alias("kept_id"), F.col(f"first.{row}").alias("kept_row")))
    kept = keyed.join(group, (F.col("doc_id") == F.col("kept_id")) & (F.col(row) == F.col("kept_row")), "left_semi")
    order = F.xxhash64("lang", "source", "n_chars")
    once = kept.withColumn(k, F.row_number().over(Window.partitionBy("doc_id", row).orderBy(order))).where(F.col(k) == 1)
    return once.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found; null and empty texts, in which none can be, stay. Rows are told
    apart by id and text, so that neither a missing nor a repeated id condemns another row."""
    row = free_name(docs, "__row")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = decontamination.contaminated(spark, keyed, table(spark, sf_dir, "benchmark"), id_col=row)
    leaks = stored(spark, found.select(F.col("doc_id").alias("leak")).distinct())
    return keyed.join(leaks, F.col(row) == F.col("leak"), "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced and n_chars counted anew. A null text stays null and keeps
    its n_chars; an empty one stays empty, with 0."""
    clean = pii.redact(docs, pii.train(docs))
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return clean.withColumn("n_chars", length).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text they decode to; a null text counts as empty, with no token."""
    return bpe_dp.digests(docs, keep=["doc_id"])


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("bpe_encoding", bpe_encoding),
]

#: The stages rest on trained models and hashes that SQL does not have; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
