"""Ranked lexical search: exact top-k by MaxScore whose bounds are tightened by precomputed pairs of terms.

The documents are cut into shards. Of each shard an index holds, for the terms that some item of a block of items has,
the documents with that term and how often they have it, and the shard's share of the totals N, L and df. With the
totals known, a second pass *weighs* the index: every posting gets its impact (its whole share of a score), and for each
pair of terms that an item puts side by side when its terms are ordered by weight, the shard gets a pair list: the joint
maximum impact over the documents that hold both, and, if they are few, these documents.

A search goes through an item's pairs. The bound of a pair is the greatest of its joint maximum and the two maxima of
its terms: a document has both terms, or one of them. That is never above the sum of the two maxima, and far below it
where no document holds both with high impacts.

1. The documents of the stored intersections are scored first; the k-th best score so far is the threshold.
2. Pairs are taken in order of their bounds from the least on, as long as the sum of bounds stays below the threshold:
   a document with terms of these alone cannot enter the result. The terms of the other pairs are essential; only
   documents with one of them are looked at.
3. The left-out pairs come in from the greatest bound on. After each, documents whose score so far and bounds still
   open stay below the threshold are dropped, and the threshold rises.

A task carries the threshold of an item from shard to shard. What is left has its exact score; the best k of all tasks
are ranked by score, then by id (a missing id last). Equal to scoring every document: a document is skipped only when
its bound is *below* the threshold, so ties are kept.

Null texts have no terms. A document row is a document: rows with one id are ranked each. An item is a pair of id and
text; repeated item rows count once, and an item without terms has no result. To the driver and to every task go the
terms of one block of items (BLOCK_ITEMS items or BLOCK_BYTES of text, however many items there are) and their df.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm.common import free_name, ship, stored, table

TOP = 10
#: Items searched for in one pass over the documents.
BLOCK_ITEMS = 2000
BLOCK_BYTES = 4 << 20
#: Documents, and terms in all of them, of a shard at most; a longer document is a shard of its own.
SHARD_DOCS = 16384
SHARD_TERMS = 2_000_000
#: A pair's documents are stored if they are at most this share of the shard's; the joint maximum always is.
LIST_SHARE = 1 / 64

_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """ASCII letters and digits and everything beyond ASCII, in maximal stretches, A-Z lower-cased."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_factor(n: int, docs: int, terms: int) -> int:
    """m of a document with n terms."""
    return 10 + 90 * n * docs // terms


# --- index -----------------------------------------------------------------------------------------------------------

_POSTINGS = [
    ("ids", pa.list_(pa.int64())),  # of the shard's documents with a term; null stays null
    ("lengths", pa.list_(pa.int64())),  # their numbers of terms
    ("terms", pa.list_(pa.int32())),  # the terms that occur, ascending
    ("dfs", pa.list_(pa.int64())),  # documents of each
    ("docs", pa.list_(pa.int32())),  # places in ids, by term and ascending
    ("values", pa.list_(pa.int64())),  # occurrences, and once weighed impacts
]
_INDEX_SCHEMA = "ids array<bigint>, lengths array<bigint>, terms array<int>, dfs array<bigint>, docs array<int>, `values` array<bigint>"
_WEIGHED_SCHEMA = _INDEX_SCHEMA + ", pairs array<int>, joint array<bigint>, sizes array<int>, members array<int>"


def _row(columns: dict[str, tuple[np.ndarray | list, pa.DataType]]) -> pa.RecordBatch:
    arrays = []
    for values, kind in columns.values():
        flat = pa.array(values, kind.value_type)
        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _column(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name))[row].values.to_numpy(zero_copy_only=False)


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard, with the postings of the vocabulary's terms."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def shard(ids: list, found: list[np.ndarray], lengths: list[int]) -> pa.RecordBatch:
        sizes = np.array([len(f) for f in found], np.int64)
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        keys = flat * len(ids) + np.repeat(np.arange(len(ids)), sizes)  # by term, then document
        keys, counts = np.unique(keys, return_counts=True)
        of_term, docs_of = np.divmod(keys, max(1, len(ids)))
        terms, dfs = np.unique(of_term, return_counts=True)
        values = [ids, lengths, terms, dfs, docs_of, counts]
        return _row({name: (v, kind) for (name, kind), v in zip(_POSTINGS, values, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        ids, found, lengths, total = [], [], [], 0
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                if ids and (len(ids) >= SHARD_DOCS or total + len(words) > SHARD_TERMS):
                    yield shard(ids, found, lengths)
                    ids, found, lengths, total = [], [], [], 0
                known = [t for t in map(get, words) if t is not None]
                ids.append(number)
                found.append(np.array(known, np.int64))
                lengths.append(len(words))
                total += len(words)
        if ids:
            yield shard(ids, found, lengths)

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, _INDEX_SCHEMA)


def totals(index: DataFrame) -> tuple[int, int, dict[int, int]]:
    """(N, L, df by term): summed in Spark; the driver gets one number per term of the vocabulary."""
    sums = index.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    each = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy("t.terms").agg(F.sum("t.dfs").alias("df"))
    return int(sums[0] or 0), int(sums[1] or 0), {r.terms: r.df for r in each.collect()}


# --- weights and pairs -----------------------------------------------------------------------------------------------


def side_by_side(items: list[list[int]], weights: np.ndarray) -> list[list[tuple[int, int]]]:
    """The pairs of each item: its terms by falling weight, two by two; the last of an odd number is paired with -1."""
    paired = []
    for terms in items:
        order = sorted(terms, key=lambda t: (-weights[t], t))
        paired.append([(order[k], order[k + 1] if k + 1 < len(order) else -1) for k in range(0, len(order), 2)])
    return paired


class Shard:
    """The weighed postings of a shard."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, dfs: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        self.ids, self.n, self.docs, self.impacts = ids, len(ids), docs, impacts
        ends = np.cumsum(dfs)
        self.of = {t: slice(e - n, e) for t, n, e in zip(terms.tolist(), dfs.tolist(), ends.tolist(), strict=True)}
        tops = np.maximum.reduceat(impacts, ends - dfs) if len(terms) else np.zeros(0, np.int64)
        self.top = dict(zip(terms.tolist(), tops.tolist(), strict=True))

    def shared(self, a: int, b: int) -> tuple[np.ndarray, int]:
        """(documents that hold both terms, their greatest joint impact)."""
        if a not in self.of or b not in self.of:
            return self.docs[:0], 0
        x, y = self.of[a], self.of[b]
        if x.stop - x.start > y.stop - y.start:
            x, y = y, x
        short, long = self.docs[x], self.docs[y]
        place = np.minimum(np.searchsorted(long, short), len(long) - 1)
        both = long[place] == short
        if not both.any():
            return short[:0], 0
        return short[both], int((self.impacts[x][both] + self.impacts[y][place[both]]).max())

    def add(self, scores: np.ndarray, places: np.ndarray, term: int) -> None:
        """Add the term's impacts to the scores of the documents at the given places, which ascend."""
        own = self.of.get(term)
        if own is None or not len(places):
            return
        docs, impacts = self.docs[own], self.impacts[own]
        place = np.minimum(np.searchsorted(docs, places), len(docs) - 1)
        scores += np.where(docs[place] == places, impacts[place], 0)


def weigh(index: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int, pairs: list[tuple[int, int]]) -> DataFrame:
    """The index with impacts for occurrences, and the pair lists of each shard."""
    sent = index.sparkSession.sparkContext.broadcast((weights, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, pairs = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                lengths, terms, dfs = (_column(batch, name, row) for name in ("lengths", "terms", "dfs"))
                docs, tf = _column(batch, "docs", row), _column(batch, "values", row)
                distinct, of = np.unique(lengths, return_inverse=True)
                m = np.array([length_factor(n, n_docs, n_terms) for n in distinct.tolist()], np.int64)[of]
                impacts = np.repeat(weights[terms], dfs) * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
                shard = Shard(lengths, terms, dfs, docs, impacts)
                known, joint, sizes, members = [], [], [], [np.zeros(0, np.int32)]
                for k, (a, b) in enumerate(pairs):
                    both, most = shard.shared(a, b)
                    if most:
                        few = len(both) <= max(TOP, shard.n * LIST_SHARE)
                        known.append(k)
                        joint.append(most)
                        sizes.append(len(both) if few else 0)
                        if few:
                            members.append(both)
                made = {name: (batch.column(batch.schema.get_field_index(name))[row].values, kind) for name, kind in _POSTINGS}
                made["values"] = (impacts, pa.list_(pa.int64()))
                ints = pa.list_(pa.int32())
                made |= {"pairs": (known, ints), "joint": (joint, pa.list_(pa.int64())), "sizes": (sizes, ints), "members": (np.concatenate(members), ints)}
                yield _row(made)

    return index.mapInArrow(run, _WEIGHED_SCHEMA)


# --- search ----------------------------------------------------------------------------------------------------------


class Best:
    """The best k (score, id) so far; `threshold` is the score that a further document must reach."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.missing = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def threshold(self) -> int:
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def take(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        enough = scores >= self.threshold
        scores, ids, missing = (np.concatenate([a, b[enough]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.missing, missing)))
        order = np.lexsort([ids, missing, -scores])[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th greatest number; 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_shard(shard: Shard, pairs: list[tuple[int, int]], lists: list[tuple[int, np.ndarray | None]], floor: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, looked at): the documents that may be among the best k with a score of `floor` or more.

    pairs are those of one item, lists the joint maximum and the stored documents of each.
    """
    none = np.zeros(0, np.int64)
    bounds, seeds = [], []
    for (a, b), (joint, members) in zip(pairs, lists, strict=True):
        bounds.append(max(joint, shard.top.get(a, 0), shard.top.get(b, 0)))
        if members is not None and len(members):
            seeds.append(members)
    order = sorted(range(len(pairs)), key=lambda j: bounds[j])
    if seeds:
        first = np.unique(np.concatenate(seeds))
        scores = np.zeros(len(first), np.int64)
        for pair in pairs:
            for term in pair:
                shard.add(scores, first, term)
        floor = max(floor, kth(scores, k))
    open_bounds, left_out = 0, 0
    while left_out < len(order) and open_bounds + bounds[order[left_out]] < floor:
        open_bounds += bounds[order[left_out]]
        left_out += 1
    essential = [t for j in order[left_out:] for t in pairs[j] if t in shard.of]
    if not essential:
        return none, none, 0
    total = np.zeros(shard.n, np.int64)
    for term in essential:
        own = shard.of[term]
        total[shard.docs[own]] += shard.impacts[own]
    places = np.flatnonzero(total)
    looked_at = len(places)
    scores = total[places]
    for j in reversed(order[:left_out]):
        floor = max(floor, kth(scores, k))
        reach = scores + open_bounds >= floor
        places, scores = places[reach], scores[reach]
        for term in pairs[j]:
            shard.add(scores, places, term)
        open_bounds -= bounds[j]
    floor = max(floor, kth(scores, k))
    reach = (scores >= floor) & (scores > 0)
    return places[reach], scores[reach], looked_at


def _searched(index: DataFrame, items: list[list[tuple[int, int]]], number: dict[tuple[int, int], int], k: int) -> DataFrame:
    """(item, doc_id, score): the best k of each task."""
    sent = index.sparkSession.sparkContext.broadcast((items, number))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, number = sent.value
        best = [Best(k) for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].values
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                shard = Shard(ids, *(_column(batch, name, row) for name in ("terms", "dfs", "docs", "values")))
                sizes, members = _column(batch, "sizes", row), _column(batch, "members", row)
                ends = np.cumsum(sizes)
                known = _column(batch, "pairs", row).tolist()
                joint = _column(batch, "joint", row).tolist()
                lists = {p: (j, members[e - n : e] if n else None) for p, j, n, e in zip(known, joint, sizes.tolist(), ends.tolist(), strict=True)}
                for pairs, top in zip(items, best, strict=True):
                    of_pairs = [lists.get(number.get(p, -1), (0, None)) for p in pairs]
                    places, scores, _ = search_shard(shard, pairs, of_pairs, top.threshold, k)
                    if len(places):
                        top.take(scores, ids[places], missing[places])
        for place, top in enumerate(best):
            if len(top.scores):
                doc_ids = pa.array(top.ids, pa.int64(), mask=top.missing)
                yield pa.RecordBatch.from_arrays([pa.array([place] * len(top.scores), pa.int32()), doc_ids, pa.array(top.scores)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id bigint, score bigint")


def _search_block(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    ids, of_items = [], []
    for row in items.collect():
        terms = dict.fromkeys(terms_of(row["text"]))
        if terms:
            ids.append(row["item_id"])
            of_items.append([vocabulary.setdefault(t, len(vocabulary)) for t in terms])
    index = stored(spark, build_index(docs, vocabulary, id_col, text_col))
    n_docs, n_terms, dfs = totals(index)
    weights = np.array([weight(n_docs, dfs.get(t, 0)) for t in range(len(vocabulary))], np.int64)
    pairs = side_by_side(of_items, weights)
    every = sorted({p for of_item in pairs for p in of_item if p[1] >= 0})
    weighed = stored(spark, weigh(index, weights, n_docs, n_terms, every))
    found = _searched(weighed, pairs, {p: j for j, p in enumerate(every)}, k)
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    names = spark.createDataFrame(list(enumerate(ids)), f"place int, item_id {items.schema['item_id'].dataType.simpleString()}")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.join(names, F.col("item") == F.col("place")).select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = TOP,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest scores above 0 for each item.

    Items are taken in blocks; every block is one pass over the documents.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    size = asked.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-int(size[1] or 0) // BLOCK_BYTES))
    part = free_name(asked, "part")
    asked = asked.withColumn(part, F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    result = None
    for block in range(blocks):
        found = _search_block(docs, asked.where(F.col(part) == block).drop(part), id_col, text_col, k)
        if blocks > 1:
            found = stored(spark, found)
        result = found if result is None else result.unionByName(found)
    return result


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH words AS (SELECT doc_id, row_number() OVER () AS row_id, {_WORDS_SQL} AS terms FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM words WHERE len(terms) > 0),
postings AS (
  SELECT row_id, doc_id, term, n, count(*) AS tf
  FROM (SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM words)
  GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, total GROUP BY term, n_docs
),
item_terms AS (SELECT DISTINCT item_id, text, unnest({_WORDS_SQL}) AS term FROM benchmark),
scores AS (
  SELECT item_id, i.text, row_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item_terms i JOIN postings USING (term) JOIN weights USING (term), total
  GROUP BY ALL
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
