"""Language identification by unigrams over the pieces of a fixed public vocabulary.

A language is a probability for each piece. A word, with a mark before it, can be cut into pieces in many ways;
its probability is the sum over all of them, got by the forward recursion

    f(0) = 1,  f(j) = sum over pieces x that end at j of f(j - len x) p(x)

for all languages and for many words of one length at a time. Words are independent, so a text's log-probability
is the sum over its words. Piece probabilities are learnt by expectation maximisation with the backward recursion
over word counts of a bounded, hash-chosen sample of labelled documents (sample_docs per language).
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm.common import Recent, held, kept_columns, ship, slices, stored, stretches, table, text_once, tokenizer_file

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_DOCS = 1500
ROUNDS = 3
UNDETERMINED = "und"
MARK = "▁"
LETTERS = regex.compile(r"\p{L}+")
#: A character that no piece covers; it weighs the same in every language.
UNKNOWN = 1e-6
_LONG = 40  # longer words go through the recursion one by one, with scaling
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def load_pieces(path: str) -> list[str]:
    """The pieces of the vocabulary that can occur in lower-cased letters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i)}
    body = regex.compile(rf"{MARK}?\p{{L}}+|{MARK}")
    return sorted(p for p in pieces if body.fullmatch(p) and p == p.lower())


def _code_points(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length).astype(np.uint64)


class Pieces:
    """Vectorised look-up of pieces by a rolling hash of their code points."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        hashes = np.zeros(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            h = np.uint64(0)
            for cp in _code_points([piece], len(piece))[0]:
                h = self._step(h, cp)
            hashes[i] = h
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces share a hash")

    @staticmethod
    def _step(h, cp):
        with np.errstate(over="ignore"):
            return (h + cp + np.uint64(1)) * _MULTIPLIER

    def spans(self, points: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, length, rows, pieces): which rows have which piece there."""
        n, width = points.shape
        for start in range(width):
            h = np.zeros(n, np.uint64)
            for length in range(1, min(self.longest, width - start) + 1):
                h = self._step(h, points[:, start + length - 1])
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                rows = np.flatnonzero(self.hashes[at] == h)
                if len(rows):
                    yield start, length, rows, self.order[at[rows]]


@dataclass
class Model:
    pieces: list[str]
    languages: list[str]
    weights: np.ndarray  # (pieces + 1, languages); the last row is the unknown character
    _pieces: Pieces | None = field(default=None, repr=False)

    def lookup(self) -> Pieces:
        if self._pieces is None:
            self._pieces = Pieces(self.pieces)
        return self._pieces

    def _lattice(self, words: list[str]):
        """Arcs of all words of one length by end: (start, rows, piece numbers), and the forward sums."""
        points = _code_points(words, len(words[0]))
        n, width = points.shape
        arcs = defaultdict(list)
        single = np.zeros((n, width), bool)
        for start, length, rows, found in self.lookup().spans(points):
            arcs[start + length].append((start, rows, found))
            if length == 1:
                single[rows, start] = True
        unknown = len(self.pieces)
        for at in range(width):
            rows = np.flatnonzero(~single[:, at])
            if len(rows):
                arcs[at + 1].append((at, rows, np.full(len(rows), unknown)))
        forward = np.zeros((width + 1, n, len(self.languages)))
        forward[0] = 1
        for end in range(1, width + 1):
            for start, rows, found in arcs[end]:
                forward[end, rows] += forward[start, rows] * self.weights[found]
        return arcs, forward

    def _long(self, word: str) -> np.ndarray:
        """The same recursion for one word of any length, scaled at each step."""
        points = _code_points([word], len(word))[0]
        look, width = self.lookup(), len(word)
        keep = look.longest + 1
        sums = np.zeros((keep, len(self.languages)))  # the last positions, all to one common scale
        sums[0] = 1
        logs, known = 0.0, {int(h): int(i) for h, i in zip(look.hashes, look.order, strict=True)}
        waiting: list[list[tuple[int, int]]] = [[] for _ in range(width + 1)]
        for start in range(width):
            h, single = np.uint64(0), False
            for length in range(1, min(look.longest, width - start) + 1):
                h = look._step(h, points[start + length - 1])
                piece = known.get(int(h))
                if piece is not None:
                    waiting[start + length].append((start, piece))
                    single |= length == 1
            if not single:
                waiting[start + 1].append((start, len(self.pieces)))
            end = start + 1
            sums[end % keep] = sum(sums[s % keep] * self.weights[p] for s, p in waiting[end])
            waiting[end] = []
            top = sums[end % keep].max()
            if top < 1e-100:
                sums /= top
                logs += np.log(top)
        return np.log(np.maximum(sums[width % keep], 1e-300)) + logs

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """(words, languages): the log of the sum over all segmentations of each marked word."""
        out = np.zeros((len(words), len(self.languages)))
        by_length = defaultdict(list)
        for i, word in enumerate(words):
            if len(word) > _LONG:
                out[i] = self._long(MARK + word)
            else:
                by_length[len(word)].append(i)
        for numbers in by_length.values():
            for low in range(0, len(numbers), 8192):
                part = numbers[low : low + 8192]
                _, forward = self._lattice([MARK + words[i] for i in part])
                out[part] = np.log(np.maximum(forward[-1], 1e-300))
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """(pieces + 1, languages): how often each piece is used, weighted over all segmentations. A word of more than
        _LONG letters (scripts without spaces) counts in parts of _LONG letters."""
        total = np.zeros_like(self.weights)
        by_length = defaultdict(list)
        for i, word in enumerate(words):
            marked = MARK + word
            for low in range(0, len(marked), _LONG + 1):
                stretch = marked[low : low + _LONG + 1]
                by_length[len(stretch)].append((i, stretch))
        for numbers in by_length.values():
            for low in range(0, len(numbers), 8192):
                part = [i for i, _ in numbers[low : low + 8192]]
                arcs, forward = self._lattice([stretch for _, stretch in numbers[low : low + 8192]])
                backward = np.zeros_like(forward)
                backward[-1] = counts[part] / np.maximum(forward[-1], 1e-300)
                for end in range(len(forward) - 1, 0, -1):
                    for start, rows, found in arcs[end]:
                        through = self.weights[found] * backward[end, rows]
                        backward[start, rows] += through
                        np.add.at(total, found, through * forward[start, rows])
        return total


def _place():
    """A number below 2**53 by the id."""
    return F.shiftrightunsigned(F.xxhash64("id"), 11)


_CELLS = 4096


def cut_offs(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, int]:
    """Of each language the greatest place that is in the sample: its documents up to there are `sample_docs`, or all.

    Found by counts alone: documents per language; documents per language and cell of places, the cells as narrow as the
    language is large, so that the first _CELLS of them hold some 64 samples at least; then the places in the one cell of
    each language where the sample ends. No id and no text is shuffled, and a language with most documents sends a few
    thousand counts like any other.
    """
    sizes = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    large = {lang: max(1, n // (64 * sample_docs)) for lang, n in sizes.items() if n > sample_docs}
    out = dict.fromkeys(sizes, 1 << 53)
    if not large:
        return out
    narrow = F.create_map(*[F.lit(x) for pair in large.items() for x in pair])[F.col("lang")]
    cell = F.floor(_place() / F.lit(float(1 << 53)) * _CELLS * narrow).cast("long")
    placed = docs.where(F.col("lang").isin(*large)).select("lang", cell.alias("cell"), _place().alias("place"))
    counts = defaultdict(dict)
    for r in placed.where(F.col("cell") < _CELLS).groupBy("lang", "cell").agg(F.count("*").alias("n")).collect():
        counts[r.lang][r.cell] = r.n
    here, wanted = F.lit(False), {}
    for lang, cells in counts.items():
        left = sample_docs
        for at in sorted(cells):
            if cells[at] >= left:
                here, wanted[lang] = here | ((F.col("lang") == lang) & (F.col("cell") == at)), left
                break
            left -= cells[at]
    found = defaultdict(list)
    for r in placed.where(here).groupBy("lang", "place").agg(F.count("*").alias("n")).collect():
        found[r.lang].append((r.place, r.n))
    for lang, left in wanted.items():
        for place, n in sorted(found[lang]):
            out[lang] = place
            left -= n
            if left <= 0:
                break
    return out


def sample_words(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, word, n) over the sample_docs documents of each language that come first by a hash of their id; documents
    that share the last hash (rows of one id) all count."""
    ship(docs.sparkSession)
    within = F.lit(False)
    for lang, place in cut_offs(docs, sample_docs).items():
        within = within | ((F.col("lang") == lang) & (_place() <= place))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                counts: dict[str, Counter] = defaultdict(Counter)
                for lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    counts[lang].update(LETTERS.findall(text.lower()))
                for lang, words in counts.items():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(words), pa.string()),
                            pa.array(list(words), pa.string()),
                            pa.array(list(words.values()), pa.int64()),
                        ],
                        ["lang", "word", "n"],
                    )

    words = docs.where(within).select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return words.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(
    spark: SparkSession,
    labelled: DataFrame,
    vocabulary: str = VOCABULARY,
    sample_docs: int = SAMPLE_DOCS,
    rounds: int = ROUNDS,
    smoothing: float = 0.02,
) -> Model:
    """Learn from (id, text, lang). To the driver come languages x pieces numbers a round, never words or texts."""
    pieces = load_pieces(tokenizer_file(vocabulary))
    words = stored(spark, sample_words(labelled, sample_docs))
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    size = len(pieces) + 1
    weights = np.full((size, len(languages)), 1.0 / size)
    weights[-1] = UNKNOWN
    for _ in range(rounds if languages else 0):
        model = spark.sparkContext.broadcast(Model(pieces, languages, weights))

        def step(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            held, total = model.value, 0
            for batch in batches:
                place = np.array([held.languages.index(x) for x in batch.column(0).to_pylist()])
                counts = np.zeros((batch.num_rows, len(held.languages)))
                counts[np.arange(batch.num_rows), place] = batch.column(2).to_numpy()
                total = total + held.expected(batch.column(1).to_pylist(), counts)
            if isinstance(total, np.ndarray):
                piece, lang = np.nonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(total[piece, lang])],
                    ["piece", "lang", "c"],
                )

        sums = words.mapInArrow(step, "piece long, lang long, c double").groupBy("piece", "lang").agg(F.sum("c"))
        found = np.zeros((size, len(languages)))
        for piece, lang, c in sums.collect():
            found[piece, lang] = c
        found = found[:-1]
        shared = found.sum(axis=1, keepdims=True) / max(found.sum(), 1)
        per_language = np.maximum(found.sum(axis=0, keepdims=True), 1)
        own = (1 - smoothing) * found / per_language + smoothing * (0.5 * shared + 0.5 / size)
        weights = np.vstack([own, np.full((1, len(languages)), UNKNOWN)])
        model.unpersist()
    return Model(pieces, languages, weights)


class Scorer:
    """Scores texts with a model; the scores of stretches are kept for as long as they come back."""

    def __init__(self, model: Model, remembered: int = 200_000):
        self.model, self.seen = model, Recent(remembered)

    def _rows(self, distinct: list[str]) -> np.ndarray:
        """Of each stretch the sum of its words' log-probabilities, and the number of its words with letters."""
        width = len(self.model.languages) + 1
        scores = [self.seen.get(token) for token in distinct]
        missing = [k for k, score in enumerate(scores) if score is None]
        parts = [LETTERS.findall(distinct[k].lower()) for k in missing]
        words = sorted(set(chain.from_iterable(parts)))
        logs = dict(zip(words, self.model.log_probabilities(words), strict=True))
        for k, found in zip(missing, parts, strict=True):
            row = np.zeros(width)
            for word in found:
                row[:-1] += logs[word]
                row[-1] += 1
            scores[k] = row
            self.seen.put(distinct[k], row)
        return np.array(scores).reshape(len(scores), width)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place of the best language or -1, its share among all) of each text."""
        model = self.model
        best, share = np.full(len(texts), -1), np.zeros(len(texts))
        if not model.languages or not len(texts):
            return best, share
        distinct, codes, edges = stretches(texts)
        rows = self._rows(distinct)
        # every text has a stretch, though it may be empty; many rows at a time would be many numbers
        total = np.concatenate(
            [np.add.reduceat(rows[codes[edges[a] : edges[b]]], edges[a:b] - edges[a]) for a, b in _spans(edges, 1 << 18)]
        )
        known = np.flatnonzero(total[:, -1])
        logs = total[known, :-1]
        best[known] = np.argmax(logs, axis=1)
        top = logs[np.arange(len(known)), best[known]]
        share[known] = 1 / np.exp(np.minimum(logs - top[:, None], 0)).sum(axis=1)
        return best, share


def _spans(edges: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most so many stretches, but for a single longer text."""
    low, n = 0, len(edges) - 1
    while low < n:
        high = min(n, max(low + 1, int(np.searchsorted(edges, edges[low] + most, side="right")) - 1))
        yield low, high
        low = high


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs (all of them by default), then lang_pred and score (the share of the best language among all, 0 to 1).

    `und` and 0 if the text is null, empty or without a letter. A tie goes to the language that sorts first.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    names = pa.array([*model.languages, UNDETERMINED], pa.string())
    others = kept_columns(docs, ["lang_pred", "score"], keep)
    columns, text = text_once(docs, others, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = held(key, lambda: Scorer(sent.value))
        for batch in batches:
            for part in slices(batch, text):
                best, share = score(part.column(text))
                languages = names.take(pa.array(np.where(best < 0, len(names) - 1, best)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(others)], languages, pa.array(share)],
                    [*part.schema.names[: len(others)], "lang_pred", "score"],
                )

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    return docs.select(*columns).mapInArrow(run, f"{schema}lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Documents that are never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit_documents(spark: SparkSession, docs: DataFrame, **options) -> Model:
    """Learn from the documents that are not held out and have an id, a text and a language."""
    known = docs.where(~held_out() & F.expr("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL"))
    return train(
        spark,
        known.select(
            F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
        ),
        **options,
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_documents(spark, docs)
    found = predict(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
