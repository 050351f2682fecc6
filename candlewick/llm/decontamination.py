"""Benchmark decontamination by latent semantic retrieval.

1. The words of all documents become numbers (a hash, FEATURES of them), written once. Their document frequencies
   over all documents give the weights (TF-IDF).
2. The benchmark's passages (PASSAGE words, every STEP words) are the rows of a sparse matrix A. A randomised SVD
   of it is computed by Spark: Y = A W with a random W, the Gram matrix of Y for an orthonormal Q = Y R^-1, and
   B = Q' A, summed by feature. The right singular vectors V of the small B span the latent space: as many of them,
   RANK at most, as it takes to keep KEPT_SHARE of the length of every passage.
3. Each passage of each document is mapped to it. With P the projection, x a passage and q one of the benchmark,
   the cosine is estimated by <P x, P q> / (|x| |q|), divided by the share |P q|^2 / |q|^2 of q that the space keeps,
   so that a copy scores alike for any rank. A passage is a candidate if this reaches COSINE, or if the share of
   |q|^2 that x covers, <P x, P q> / |P q|^2, reaches COVERED: the share does not depend on the words around a copy.
   Of a whole copy some x covers half of each q, wherever the steps fall. The product is a sum over the words of x,
   and each word adds at most what it adds for the q that suits it best: passages below both thresholds even so are
   settled without a vector, first with the best of all q and then with the best of each of GROUPS groups of items.
   The rest meet all q of a block in one matrix product.
4. A candidate's words around the passage are checked by the longest common subsequence with the item, over windows
   a quarter longer than the item: a share of COPIED or more is a copy; a share of REWORDED or more is a paraphrase
   if the item's answer is there too. The answer is a column, where the benchmark has one, else the last sentence.

Benchmark items go through the search in blocks of ITEM_BLOCK, so what is broadcast has a fixed bound.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import ODD_SPACE, coded_stretches, ship, slices, stored, table

FEATURES = 1 << 18
STEP = 16
PASSAGE = 2 * STEP
RANK = 512
KEPT_SHARE = 0.7
COSINE = 0.3
COVERED = 0.25
COPIED = 0.8
REWORDED = 0.6
ANSWER = 0.75
SHORT_WORDS = 8  # shorter items count only if they are there word for word
ITEM_BLOCK = 256
GROUPS = 16
_SLACK = 1e-5  # a sum of 32 positive single-precision numbers is nearer than that to the true one

_MARKS = r"[^\p{L}\p{N}]+"
_SENTENCE = regex.compile(r"[^.!?\n]*[\p{L}\p{N}][^.!?\n]*")
_STRETCH = 64


_CRC = np.array([zlib.crc32(bytes([k]), 0xFFFFFFFF) ^ 0xFFFFFFFF for k in range(256)], np.uint32)
_LONG = 32


def checksums(words: pa.Array) -> np.ndarray:
    """The CRC-32 of each word, for all words at once byte by byte; longer ones than _LONG bytes one by one."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
    out = np.empty(len(words), np.int64)
    for k in np.flatnonzero(sizes > _LONG).tolist():
        out[k] = zlib.crc32(words[k].as_py())
    offsets = np.frombuffer(words.buffers()[1], "<i4")[words.offset : words.offset + len(words)]
    order = np.argsort(-sizes, kind="stable")
    order = order[np.searchsorted(-sizes[order], -_LONG) :]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    at, left, crc = offsets[order], sizes[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k))  # so many words have a byte k
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def words_of(texts: pa.Array) -> pa.Array:
    """The words of each text as numbers below FEATURES, little-endian and 32 bits wide. A word is a stretch between
    white space without its marks, in lower case; one of marks alone is none. Lower case and marks are Arrow's."""
    texts = pc.fill_null(texts, "")
    if pc.any(pc.match_substring_regex(texts, ODD_SPACE)).as_py():
        texts = pc.replace_substring_regex(texts, ODD_SPACE, " ")
    distinct, codes, edges = coded_stretches(texts)
    plain = pc.replace_substring_regex(pc.utf8_lower(distinct), _MARKS, "").cast(pa.binary())
    numbers = np.where(pc.binary_length(plain).to_numpy(zero_copy_only=False) > 0, checksums(plain) % FEATURES, -1)
    numbers = numbers.astype("<i4")[codes]
    some = numbers >= 0
    ends = 4 * np.concatenate([[0], np.cumsum(some)])[edges].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(numbers[some].tobytes())])


class Features:
    """The words of single texts as numbers."""

    @staticmethod
    def of(text: str | None) -> np.ndarray:
        return np.frombuffer(words_of(pa.array([text], pa.string()))[0].as_py(), "<i4").astype(np.int64)


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, words): the words of each row as numbers, little-endian and 32 bits wide; none for a null text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), words_of(part.column(1))], ["id", "words"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string")).mapInArrow(
        run, "id long, words binary"
    )


def document_frequencies(rows: DataFrame) -> DataFrame:
    """(feature, df) over all rows of (id, words); -1 stands for the number of rows."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for words in batch.column(0).to_pylist():
                total[np.unique(np.frombuffer(words, "<i4"))] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(total[used], n), pa.int64())],
            ["feature", "df"],
        )

    found = rows.select("words").mapInArrow(run, "feature long, df long")
    return found.groupBy("feature").agg(F.sum("df").alias("df"))


def weights(rows: DataFrame) -> np.ndarray:
    """The inverse document frequency of each of the FEATURES features, from rows of (id, words)."""
    df, n = np.zeros(FEATURES), 0
    for feature, count in document_frequencies(rows).collect():  # FEATURES + 1 rows at most
        if feature < 0:
            n = count
        else:
            df[feature] = count
    return np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(1e-3)


def _steps(n: int, width: int, step: int) -> list[tuple[int, int]]:
    return [(0, n)] if n <= width else [(s, min(s + width, n)) for s in range(0, n - width + step, step)]


@dataclass
class Item:
    number: int | None
    words: list[int]
    answer: list[int]

    def __post_init__(self):
        self.known, self.counts = np.unique(np.array(self.words, np.int64), return_counts=True)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Of each word its place among the item's distinct words; their number for other words."""
        at = np.searchsorted(self.known, words)
        inside = np.append(self.known, -1)[at] == words
        return np.where(inside, at, len(self.known))


@dataclass
class Space:
    """The latent space of a block of benchmark passages."""

    items: list[Item]
    owner: np.ndarray  # passage -> place in items
    row: np.ndarray  # feature -> row of vectors; 0 is the zero row
    vectors: np.ndarray  # right singular vectors by weight, a column for each row number
    passages: np.ndarray  # P q |q| / |P q|^2
    lengths: np.ndarray  # |q|
    most: np.ndarray  # by row number: the most that a word can add to the product with any passage
    most_covered: np.ndarray  # by row number: the most that a word can add to the share of any passage
    bounds: np.ndarray  # both for the passages of each group of items alone, a column for each row number


def _sparse(items: list[Item], weight: np.ndarray) -> tuple[list[int], list[tuple[list[int], list[float]]]]:
    owner, rows = [], []
    for at, item in enumerate(items):
        found = np.array(item.words, np.int64)
        for a, b in _steps(len(found), PASSAGE, STEP) if len(found) else ():
            used, count = np.unique(found[a:b], return_counts=True)
            owner.append(at)
            rows.append((used.tolist(), (count * weight[used]).tolist()))
    return owner, rows


def randomised_svd(spark: SparkSession, rows: list[tuple[list[int], list[float]]], rank: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(features in use, right singular vectors) of sparse rows, each (features, values).

    The rows go through Spark in two passes; the driver holds rank x rank and rank x features numbers.
    """
    used = np.unique(np.concatenate([np.array(r[0], np.int64) for r in rows]))
    width = min(rank + 16, len(rows), len(used))
    random = np.random.default_rng(seed).standard_normal((len(used), width))
    matrix = spark.createDataFrame(rows, "features array<long>, vals array<double>").repartition(
        max(1, min(64, len(rows) // 64))
    )
    sent = spark.sparkContext.broadcast((used, random))

    def sketch(batch: pa.RecordBatch) -> np.ndarray:
        known, omega = sent.value
        out = np.zeros((batch.num_rows, omega.shape[1]))
        for k, (f, v) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            out[k] = np.array(v) @ omega[np.searchsorted(known, f)]
        return out

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            y = sketch(batch)
            total = total + y.T @ y
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "v"]
            )

    sums = np.zeros((width, width))
    added = F.aggregate(F.collect_list("v"), F.array_repeat(F.lit(0.0), width), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    for i, v in matrix.mapInArrow(gram, "i long, v array<double>").groupBy("i").agg(added.alias("v")).collect():
        sums[i] = v
    values, vectors = np.linalg.eigh(sums)
    good = values > 1e-10 * max(values.max(), 1e-300)
    whiten = vectors[:, good] / np.sqrt(values[good])  # Q = Y whiten

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = sent.value
        total = np.zeros((len(known), whiten.shape[1]))
        for batch in batches:
            q = sketch(batch) @ whiten
            for k, (f, v) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                total[np.searchsorted(known, f)] += np.array(v)[:, None] * q[k][None, :]
        at = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(total[at].tolist(), pa.list_(pa.float64()))], ["i", "v"]
        )

    added = F.aggregate(F.collect_list("v"), F.array_repeat(F.lit(0.0), whiten.shape[1]), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    small = np.zeros((len(used), whiten.shape[1]))
    for i, v in matrix.mapInArrow(project, "i long, v array<double>").groupBy("i").agg(added.alias("v")).collect():
        small[i] = v
    right, _, _ = np.linalg.svd(small, full_matrices=False)
    return used, right[:, :rank]


def latent_space(spark: SparkSession, items: list[Item], weight: np.ndarray, rank: int = RANK) -> Space | None:
    """None if no item has a word."""
    owner, rows = _sparse(items, weight)
    if not rows:
        return None
    used, right = randomised_svd(spark, rows, rank)
    row = np.zeros(FEATURES, np.int32)
    row[used] = np.arange(1, len(used) + 1)
    projected = np.array([np.array(v) @ right[np.searchsorted(used, f)] for f, v in rows], np.float32)
    whole = np.sqrt([np.square(v).sum() for _, v in rows])
    least_kept = (np.cumsum(projected.astype(np.float64) ** 2, axis=1) / whole[:, None] ** 2).min(axis=0)
    enough = np.flatnonzero(least_kept >= KEPT_SHARE**2)
    if len(enough):
        projected, right = projected[:, : enough[0] + 1], right[:, : enough[0] + 1]
    scale = (whole / np.maximum(np.square(projected).sum(axis=1), 1e-12)).astype(np.float32)
    vectors = np.concatenate([np.zeros((1, right.shape[1])), right * weight[used][:, None]]).astype(np.float32)
    scaled = projected * scale[:, None]
    lengths = np.maximum(whole, 1e-12).astype(np.float32)
    added = vectors @ scaled.T
    owner = np.array(owner)
    groups = [np.flatnonzero(owner % GROUPS == g) for g in np.unique(owner % GROUPS)]
    bounds = np.array([np.maximum(a[:, g].max(axis=1), 0) for a in (added, added / lengths) for g in groups])
    most, most_covered = (half.max(axis=0) for half in np.split(bounds, 2))
    return Space(items, owner, row, np.ascontiguousarray(vectors.T), scaled, lengths, most, most_covered, bounds)


def common_words(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, one machine operation per word of the region."""
    places: dict[int, int] = {}
    for at, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << at
    full = (1 << len(item)) - 1
    state = full
    for word in region:
        match = state & places.get(word, 0)
        if match:
            state = ((state + match) | (state - match)) & full
    return len(item) - state.bit_count()


def check(item: Item, region: list[int] | np.ndarray) -> tuple[int, bool, bool]:
    """(longest common subsequence, answer found, contaminated) of an item and some words; a subsequence too
    short to matter counts as none."""
    n = len(item.words)
    region = np.asarray(region, np.int64)
    at_word = item.places(region)
    # no window has more of the item's words than the region
    if np.minimum(np.bincount(at_word, minlength=len(item.counts) + 1)[:-1], item.counts).sum() < REWORDED * n:
        return 0, False, False
    width = n if n < SHORT_WORDS else n + -(-n // 4)
    last = max(0, len(region) - width)
    starts = {*range(0, last, 1 if n < SHORT_WORDS else max(1, n // 8)), last}
    # no subsequence is longer than what the window and the item have in common in any order
    seen = np.zeros((len(region) + 1, len(item.counts) + 1), np.int32)
    seen[np.arange(1, len(region) + 1), at_word] = 1
    seen = np.cumsum(seen, axis=0)[:, :-1]
    low_ends = np.array(sorted(starts))
    high_ends = np.minimum(low_ends + width, len(region))
    most = np.minimum(seen[high_ends] - seen[low_ends], item.counts).sum(axis=1)
    best, window = 0, []
    for k in np.flatnonzero(most >= REWORDED * n):
        if most[k] > best:
            words_there = region[low_ends[k] : high_ends[k]].tolist()
            found = common_words(item.words, words_there)
            if found > best:
                best, window = found, words_there
    answer = bool(item.answer) and common_words(item.answer, window) >= ANSWER * len(item.answer)
    if n < SHORT_WORDS:
        return best, answer, best == n
    return best, answer, best >= COPIED * n or (best >= REWORDED * n and answer)


def _sums(columns: np.ndarray, row: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of the columns that the words of each stretch have; row 0 has none."""
    known = np.flatnonzero(row)
    out = np.zeros((columns.shape[0], len(starts)), np.float32)
    first = np.searchsorted(known, starts)
    full = np.flatnonzero(np.diff(np.append(first, len(known))))
    if len(full):
        # along the last axis, one dimension after the other: its few thousand numbers stay in the cache
        out[:, full] = np.add.reduceat(columns[:, row[known]], first[full], axis=1)
    return np.ascontiguousarray(out.T)


def _search(space: Space, weight: np.ndarray, docs: list[tuple[int | None, bytes]], cosine: float) -> list[dict]:
    """Contaminated (document, item) pairs of a few documents of (id, words)."""
    found = [np.frombuffer(words, "<i4") for _, words in docs]
    sizes = np.array([len(f) for f in found])
    if not sizes.sum():
        return []
    joined = np.concatenate(found)
    blocks = -(-sizes // STEP)
    doc_of = np.repeat(np.arange(len(docs)), blocks)
    inside = np.arange(len(doc_of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + STEP * inside
    follows = np.append(doc_of[1:] == doc_of[:-1], False)
    row, squared = space.row[joined], weight[joined].astype(np.float64) ** 2
    widths = np.diff(np.append(starts, len(joined)))

    def passages(blocks_of):
        """From blocks of STEP words to passages: each block and the next of its document."""
        blocks_of[:-1][follows[:-1]] += blocks_of[1:][follows[:-1]]
        return blocks_of

    def sums(columns, which):
        """Of the passages that begin with some blocks, from these blocks and the next ones alone."""
        pairs = which[follows[which]]
        needed = np.zeros(len(starts), bool)
        needed[which] = needed[pairs + 1] = True
        place = np.cumsum(needed) - 1
        of_block = _sums(columns, np.where(np.repeat(needed, widths), row, 0), starts[needed])
        out = of_block[place[which]]
        out[follows[which]] += of_block[place[pairs + 1]]
        return out

    squares = passages(np.add.reduceat(squared, starts))
    # what the words can add at most, each with the passage that suits it best: few passages need a vector
    length = np.sqrt(squares)
    wanted, covered = cosine * length * (1 - _SLACK) - 1e-6, COVERED * (1 - _SLACK) - 1e-6
    inner = passages(np.add.reduceat(space.most[row], starts)) >= wanted
    inner |= passages(np.add.reduceat(space.most_covered[row], starts)) >= covered
    # the last block alone is inside the passage before it
    inner &= follows | (inside == 0)
    inner = np.flatnonzero(inner)
    by_cosine, by_share = np.split(sums(space.bounds, inner), 2, axis=1)
    inner = inner[(by_cosine.max(axis=1) >= wanted[inner]) | (by_share.max(axis=1) >= covered)]
    vectors = sums(space.vectors, inner)
    longest = np.linalg.norm(space.passages, axis=1)
    reach = np.linalg.norm(vectors, axis=1)
    near = (reach * longest.max() >= cosine * length[inner]) | (reach * (longest / space.lengths).max() >= COVERED)
    inner, vectors = inner[near], vectors[near]
    if not len(inner):
        return []
    products = vectors @ space.passages.T
    at, passage = np.nonzero(products >= np.minimum(cosine * length[inner, None], COVERED * space.lengths))
    block, item = inner[at], space.owner[passage]
    candidates = np.unique(np.stack([doc_of[block], item, STEP * inside[block]], axis=1), axis=0)
    rows = {}
    for doc, at, low, high in _regions(candidates.tolist(), space.items):
        item = space.items[at]
        lcs, answer, bad = check(item, found[doc][low:high])
        known = rows.get((doc, at))
        if bad and (known is None or lcs > known["lcs"]):
            rows[doc, at] = {
                "doc_id": docs[doc][0],
                "item_id": item.number,
                "lcs": lcs,
                "n_words": len(item.words),
                "answer": answer,
            }
    return list(rows.values())


def _regions(candidates: list[list[int]], items: list[Item]) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first word, end): the words an item's length around its passages, each looked at once."""
    open_region = None
    for doc, item, low in candidates:
        n = len(items[item].words)
        first, end = max(0, low - n), low + PASSAGE + n
        if open_region and open_region[:2] == (doc, item) and first <= open_region[3]:
            open_region = (doc, item, open_region[2], end)
            continue
        if open_region:
            yield open_region
        open_region = (doc, item, first, end)
    if open_region:
        yield open_region


_PAIR = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("lcs", pa.int64()), ("n_words", pa.int64()), ("answer", pa.bool_())]
)


def item_of(number: int | None, text: str | None, answer: str | None) -> Item:
    if answer is None:
        sentences = _SENTENCE.findall(text or "")
        answer = sentences[-1] if len(sentences) > 1 else ""
    return Item(number, Features.of(text).tolist(), Features.of(answer).tolist())


def contaminated(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    rank: int = RANK,
    cosine: float = COSINE,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """(doc_id, item_id, lcs, n_words, answer): one row per document row and benchmark item found in it.

    Null and empty texts, and items without a word, match nothing; rows without an id are searched like others.
    An empty benchmark or an empty table gives no rows. A repeated item or document gives a row for each.
    """
    ship(spark)
    rows = stored(spark, tokenised(docs, id_col, text_col))
    weight = weights(rows)
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    chosen = benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"), answer.alias("answer")
    )
    out = spark.createDataFrame([], "doc_id long, item_id long, lcs long, n_words long, answer boolean")
    blocks = max(1, -(-chosen.count() // item_block))
    dealt = chosen.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for block in range(blocks):
        items = [item_of(r.item, r.text, r.answer) for r in dealt.where(F.col("block") == block).collect()]
        items.sort(key=lambda i: (i.number is None, i.number, i.words))
        space = latent_space(spark, items, weight, rank)
        if space is None:
            continue
        sent = spark.sparkContext.broadcast((space, weight))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            held, known = sent.value
            for batch in batches:
                for low in range(0, batch.num_rows, _STRETCH):
                    docs = list(zip(*(c.to_pylist() for c in batch.slice(low, _STRETCH).columns), strict=True))
                    yield pa.RecordBatch.from_pylist(_search(held, known, docs, cosine), _PAIR)

        out = out.unionByName(rows.mapInArrow(run, out.schema))
    return out


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
