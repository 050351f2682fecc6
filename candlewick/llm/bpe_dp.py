"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

Of every prefix of a word one token is the last of its encoding. To find it, all tokens that end there are matched
by an automaton over the vocabulary; a token t that starts at j is the one if it goes together with the last token
of the prefix up to j. Two tokens go together if the merges, taken by rank, never join symbols across their
border. The ids are read off by following the last tokens back from the end of the word.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import LONGEST_REMEMBERED, Remembered, free_name, held, joined, kept_columns, ship, slices, stretches, table, text_once, tokenizer_file

VOCABULARY = "word_bpe_49k.json"
DIGESTS_REMEMBERED = 700_000
WORDS_REMEMBERED = 200_000
#: What is made of a slice of texts takes many times its bytes.
_SLICE_BYTES = 1 << 19
_NEVER = 1 << 60
#: Words of plain ASCII text, by the pattern the vocabulary file states.
_ASCII_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


class PrefixEncoder:
    """Encodes one word, given as the string of its symbols."""

    def __init__(self, vocabulary: dict[str, int], merges: list[list[str]], suffix: str):
        import ahocorasick

        self.suffix = suffix
        self.ids: dict[str, int] = {}
        self.size: dict[str, int] = {}
        tokens = {self._symbols(t): i for t, i in vocabulary.items()}
        self.rank: dict[str, int] = {}  # of the merge that makes a token; none for a symbol
        self.halves: dict[str, tuple[str, str]] = {}
        self.joined: dict[tuple[str, str], int] = {}
        for at, (left, right) in enumerate(merges):
            pair = (self._symbols(left, last=False), self._symbols(right))
            self.joined[pair] = at
            if pair[0] + pair[1] not in self.rank:
                self.rank[pair[0] + pair[1]] = at
                self.halves[pair[0] + pair[1]] = pair
        self.tokens = tokens
        self.automaton = ahocorasick.Automaton()
        for token in tokens:
            if len(token) == 1 or (token in self.halves and self._whole(token)):
                self.automaton.add_word(token, (len(token), token))
        self.automaton.make_automaton()
        self._together = Remembered(200_000, self.stay_apart)

    def _symbols(self, token: str, last: bool = True) -> str:
        """One character a symbol: the one that ends a word is moved to a range of its own."""
        if self.suffix and last and token.endswith(self.suffix) and len(token) > len(self.suffix):
            return token[: -len(self.suffix) - 1] + chr(ord(token[-len(self.suffix) - 1]) + 0x10000)
        return token

    def _whole(self, token: str) -> bool:
        """Whether the merges, taken by rank, make the token of its own symbols."""
        parts = list(token)
        while len(parts) > 1:
            ranks = [self.joined.get(p, _NEVER) for p in zip(parts, parts[1:], strict=False)]
            low = min(ranks)
            if low == _NEVER:
                return False
            at = ranks.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def stay_apart(self, pair: tuple[str, str]) -> bool:
        """Whether two tokens go together: go back through the merges that made them, latest first, and see if the
        two symbols at the border would have been joined before the next of these merges."""
        rank, joined, halves = self.rank, self.joined, self.halves
        x, y = pair
        until_x = until_y = _NEVER  # when x and y were taken up into what they are part of
        while True:
            m = joined.get((x, y))
            # of equal merges the left one comes first
            if m is not None and m < until_x and m <= until_y:
                return False
            rx, ry = rank.get(x, -1), rank.get(y, -1)
            if rx < 0 and ry < 0:
                return True
            if rx > ry:
                until_x, x = rx, halves[x][1]
            else:
                until_y, y = ry, halves[y][0]

    def encode(self, word: str) -> list[int]:
        if not word:
            return []
        symbols = word[:-1] + chr(ord(word[-1]) + 0x10000) if self.suffix else word
        last: list[str | None] = [None] * len(symbols)  # of the prefix that ends with each symbol
        together = self._together
        for end, (size, token) in self.automaton.iter(symbols):
            if last[end] is None:
                if size > end:  # the whole prefix
                    last[end] = token
                else:
                    before = last[end - size]
                    if before is not None and together[before, token]:
                        last[end] = token
        out, at, tokens = [], len(symbols) - 1, self.tokens
        while at >= 0:
            token = last[at]
            out.append(tokens[token])
            at -= len(token)
        out.reverse()
        return out


class WordTokenizer:
    """Texts to ids and back as the vocabulary file states: special tokens, normalisation, words, byte symbols.

    Normalisation and the split into words keep to stretches without white space, so a text is handled as such
    stretches, each remembered for as long as it comes back. Memories hold ids alone; these are decoded by Arrow.
    """

    def __init__(self, file: str, remembered: int = 300_000, longest: int = LONGEST_REMEMBERED):
        from tokenizers import Tokenizer

        stated = json.loads(file)
        self.library = Tokenizer.from_str(file)
        model = stated["model"]
        self.special = {t["content"]: t["id"] for t in stated["added_tokens"]}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in self.special}
        self.text_of = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.special.items()}
        pieces = [b""] * (max(self.text_of) + 1)
        for i, piece in self.text_of.items():
            pieces[i] = piece.encode()
        self.pieces = pa.array(pieces, pa.binary())
        self.encoder = PrefixEncoder(vocabulary, model["merges"], model["end_of_word_suffix"] or "")
        self.split_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.words = Remembered(min(remembered, WORDS_REMEMBERED), self._word, longest)
        self.stretches = Remembered(remembered, self._stretch, longest)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        if len(ids) == 1:
            return ids[0].to_bytes(4, "little")
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        return self._packed(self.encoder.encode(word))

    def _section(self, text: str) -> list[bytes]:
        if text.isascii() and text.isprintable() and " " not in text:
            words = _ASCII_WORDS.findall(text.lower())
        else:
            clean = self.library.normalizer.normalize_str(text)
            words = [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]
        return list(map(self.words.__getitem__, words))

    def _stretch(self, text: str) -> bytes:
        """The ids of a text of any kind."""
        if self.split_special is None or not self.split_special.search(text):
            parts = self._section(text)
        else:
            parts, at = [], 0
            for found in self.split_special.finditer(text):
                parts += self._section(text[at : found.start()])
                parts.append(self._packed([self.special[found.group()]]))
                at = found.end()
            parts += self._section(text[at:])
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def decode(self, ids) -> str:
        """Tokens joined by spaces, as the vocabulary file states no decoder."""
        return " ".join([self.text_of[i] for i in ids])

    def _decoded(self, ids: pa.Array) -> pa.Array:
        """The same of each row of packed ids, in UTF-8."""
        edges = np.frombuffer(ids.buffers()[1], "<i4", len(ids) + 1)
        flat = np.frombuffer(ids.buffers()[2] or b"", "<u4", int(edges[-1]) // 4)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges // 4), self.pieces.take(pa.array(flat))), b" ")

    def __call__(self, text: str) -> tuple[bytes, str]:
        """The ids as little-endian 32-bit numbers and the text they decode to."""
        ids, decoded = self.batch(pa.array([text], pa.string()))
        return ids[0].as_py(), decoded[0].as_py().decode()

    def batch(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of each text the ids as little-endian 32-bit numbers and the text they decode to, in UTF-8.

        Texts are cut at ASCII white space; other white space is inside a stretch, and handled there.
        """
        distinct, codes, edges = stretches(texts)
        ids = joined([self.stretches[stretch] for stretch in distinct], codes, edges)
        return ids, self._decoded(ids)


def _with_tokenizer(docs: DataFrame, vocabulary: str, text_col: str, make, added: str, keep: list[str] | None, **memory: int):
    """Map the text column with make(tokenizer, texts) -> arrays, beside the kept columns. What a worker remembers can be
    stated."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_file(vocabulary), encoding="utf-8") as source:
        sent = spark.sparkContext.broadcast(source.read())
    key = uuid.uuid4().hex
    names = [part.split()[0] for part in added.split(", ")]
    others = kept_columns(docs, names, keep)
    columns, text = text_once(docs, others, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held(key, lambda: WordTokenizer(sent.value, **memory))
        for batch in batches:
            for part in slices(batch, text, _SLICE_BYTES):
                made = make(tokenizer, part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(others)], *made], [*part.schema.names[: len(others)], *names]
                )

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others) + added
    return docs.select(*columns).mapInArrow(run, schema)


def digests(
    docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The kept columns of docs, then n_tokens, ids_sha256 and decoded_sha256. A null text counts as empty."""

    def make(tokenizer: WordTokenizer, texts: pa.Array):
        ids, decoded = tokenizer.batch(texts)
        return (
            pa.array([len(i.as_buffer()) // 4 for i in ids], pa.int64()),
            *[pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string()) for column in (ids, decoded)],
        )

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    # no ids leave the worker, so there is room for more stretches, of shorter ones
    return _with_tokenizer(docs, vocabulary, text_col, make, added, keep, remembered=DIGESTS_REMEMBERED, longest=24)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs, then ids array<int>."""

    def make(tokenizer: WordTokenizer, texts: pa.Array):
        return (pa.array([np.frombuffer(i.as_buffer(), "<i4") for i in tokenizer.batch(texts)[0]], pa.list_(pa.int32())),)

    return _with_tokenizer(docs, vocabulary, text_col, make, "ids array<int>", keep)


def decode(rows: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids") -> DataFrame:
    """All columns of rows, then decoded string. Null ids decode to null."""
    spark = rows.sparkSession
    others = kept_columns(rows, ["decoded"], None)
    ship(spark)
    with open(tokenizer_file(vocabulary), encoding="utf-8") as source:
        sent = spark.sparkContext.broadcast(source.read())
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held(key, lambda: WordTokenizer(sent.value))
        for batch in batches:
            texts = [None if ids is None else tokenizer.decode(ids) for ids in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], "decoded"]
            )

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others) + "decoded string"
    return rows.select(*[F.col(f"`{f.name}`") for f in others], F.col(f"`{ids_col}`").alias(free_name(rows, "__ids"))).mapInArrow(run, schema)


def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), keep=["doc_id"])
