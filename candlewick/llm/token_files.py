"""Token ids in files compressed by a Re-Pair grammar, with random access to every document.

Documents go in id order into shards. A shard's ids are rewritten round by round: the most frequent pairs of
neighbouring symbols become new symbols (nonterminals), never across the end of a document, until no pair is
frequent enough. A shard row holds

  symbols   the rewritten ids, 16-bit little-endian where they fit, else 32-bit (width says which)
  rules     the two symbols of each nonterminal, in the order made (so a rule uses earlier symbols only)
  lengths   how many ids each nonterminal stands for
  offsets   where each document starts among the symbols
  starts    where each document starts among the ids of the shard
  doc_ids   the documents

so any document, or any range of its ids, is expanded from its own symbols and the rules alone.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm.common import LONGEST_REMEMBERED, TWO_SPACES, held, joined, ship, slices, stretches, table, tokenizer_file
from candlewick.session import shared_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SHARD_TOKENS = 2_000_000
MIN_PAIRS = 16  # a pair that occurs less often gets no rule
PAIRS_A_ROUND = 4096
ROUNDS = 8
_SPACE_MARK = "Ġ"  # how byte-level vocabularies write a space
_LONGEST = 24  # characters of a stretch that is remembered
_SLICE_BYTES, _SLICE_ROWS = 4 << 20, 8192
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
# Printable ASCII, the letters of the two Latin blocks after it and single line ends, and the pattern for these.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_COMMON = re.compile(f"(?: [\n!-~{_LETTERS}]+)+")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^ \n{_LETTERS}0-9]+|\n")


class ByteTokenizer:
    """Ids by the tokenizers library, remembered for each stretch between single spaces and each piece of one.

    The vocabulary's pattern joins one space to the word after it and otherwise never takes white space and what
    follows together, so a text in which no two white-space characters meet may be cut before every space. Stretches of
    common letters are cut further into the pattern's pieces, as the library encodes each piece by itself.
    """

    def __init__(self, file: str, remembered: int = 800_000, pieces: int = 400_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(file)
        size = self.library.get_vocab_size()
        self.starts = np.array([(self.library.id_to_token(i) or "").startswith(_SPACE_MARK) for i in range(size)])
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # what was asked for lately, and before that: a stretch not asked for in a while is forgotten
        self.half, self.new, self.old = remembered // 2, {}, {}
        self.half_pieces, self.new_pieces, self.old_pieces = pieces // 2, {}, {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]

    def _spaced(self, stretches: list[str]) -> list[bytes]:
        """The ids of each stretch after a space: all in one text, cut where a token starts with a space."""
        ids = np.array(self.library.encode_batch_fast([f" {' '.join(stretches)}"], add_special_tokens=False)[0].ids, "<u4")
        places = np.flatnonzero(self.starts[ids])
        if len(places) != len(stretches):
            return self._encode([f" {s}" for s in stretches])
        packed, edges = ids.tobytes(), [*(4 * places).tolist(), 4 * len(ids)]
        return [packed[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _common(self, text: str) -> bool:
        return bool(_COMMON.fullmatch(text)) and not (self.special and self.special.search(text))

    def _stretches(self, stretches: list[str]) -> list[bytes]:
        """The ids of each stretch after a space."""
        text = f" {' '.join(stretches)}"
        if not self._common(text):
            common = [self._common(f" {s}") for s in stretches]
            others = iter(self._spaced([s for s, c in zip(stretches, common, strict=True) if not c]))
            known = iter(self._stretches(some) if (some := [s for s, c in zip(stretches, common, strict=True) if c]) else [])
            return [next(known if c else others) for c in common]
        pieces = _PIECES.findall(text)
        if len(self.new_pieces) >= self.half_pieces:
            self.old_pieces, self.new_pieces = self.new_pieces, {}
        new, old = self.new_pieces, self.old_pieces
        missing = []
        for piece in set(pieces):
            if piece not in new:
                if piece in old:
                    new[piece] = old[piece]
                else:
                    missing.append(piece)
        spaced, bare = [p[1:] for p in missing if p[0] == " "], [p for p in missing if p[0] != " "]
        made = dict(zip(bare, self._encode(bare), strict=True)) if bare else {}
        if spaced:
            made.update(zip((f" {s}" for s in spaced), self._spaced(spaced), strict=True))
        new.update((p, ids) for p, ids in made.items() if len(p) <= LONGEST_REMEMBERED)
        found = [new[p] if p in new else made[p] for p in pieces]
        # each stretch begins with the one piece that has its space
        edges = [k for k, p in enumerate(pieces) if p[0] == " "]
        edges.append(len(pieces))
        return [found[a] if b - a == 1 else b"".join(found[a:b]) for a, b in zip(edges, edges[1:], strict=False)]

    def __call__(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        whole = pc.match_substring_regex(texts, TWO_SPACES).to_numpy(zero_copy_only=False)
        out = np.empty(len(texts), object)
        plain, cut = np.flatnonzero(whole), np.flatnonzero(~whole)
        out[plain] = self._encode(texts.take(pa.array(plain)).to_pylist())
        if len(cut):
            out[cut] = self._cut(texts.take(pa.array(cut)))
        return out.tolist()

    def _cut(self, texts: pa.Array) -> list[bytes]:
        """Of texts that may be cut before every space."""
        distinct, codes, edges = stretches(texts, " ")
        first = edges[:-1]
        inner = np.ones(len(codes), bool)
        inner[first] = False
        asked = np.zeros(len(distinct), bool)
        asked[codes[inner]] = True
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        parts = list(map(new.get, distinct))
        missing = []
        for k in np.flatnonzero(asked).tolist():
            if parts[k] is None:
                ids = old.get(distinct[k])
                if ids is None:
                    missing.append(k)
                else:
                    parts[k] = new[distinct[k]] = ids
        if missing:
            for k, ids in zip(missing, self._stretches([distinct[k] for k in missing]), strict=True):
                parts[k] = ids
                if len(distinct[k]) <= _LONGEST:
                    new[distinct[k]] = ids
        # a text's first stretch has no space before it
        parts += self._encode([distinct[k] for k in codes[first].tolist()])
        codes[first] = len(distinct) + np.arange(len(first))
        return joined(parts, codes, edges).to_pylist()


def _pairs(symbols: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """A number for each pair of neighbours, at the place of the left one; only where inner holds."""
    wide = np.uint32 if symbols.dtype == np.uint16 else np.uint64
    shift = wide(16 if wide == np.uint32 else 32)
    return ((symbols[:-1].astype(wide) << shift) | symbols[1:])[inner]


def _places(chosen: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, found) of each key among the distinct, sorted chosen ones: by a hash that keeps these apart, if one is
    met soon, else by bisection."""
    wide, bits = chosen.dtype.type, 8 * chosen.itemsize
    for odd in _ODD if len(chosen) <= PAIRS_A_ROUND else ():
        factor, shift = wide(odd & ((1 << bits) - 1)), wide(bits - 22)
        slots = (chosen * factor) >> shift
        if len(np.unique(slots)) == len(slots):
            place = np.zeros(1 << 22, np.int16)
            place[slots] = np.arange(len(chosen))
            number = place[(keys * factor) >> shift]
            return number, chosen[number] == keys
    number = np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)
    return number, chosen[number] == keys


def compress(ids: np.ndarray, offsets: np.ndarray, base: int, min_pairs: int = MIN_PAIRS, rounds: int = ROUNDS):
    """(symbols, rules, offsets): ids rewritten with nonterminals from base on; documents start at offsets."""
    room = 65_536 - base
    symbols = ids.astype(np.uint16 if len(ids) == 0 or (ids.max() < base and room > 0) else np.uint32)
    limit = room if symbols.dtype == np.uint16 else 2**31 - base
    first = np.zeros(len(symbols) + 1, bool)
    first[offsets] = True
    first = first[:-1]
    rules = np.zeros((0, 2), np.int64)
    least = 0  # a pair can be frequent only if one of its symbols is this or a later one
    for _ in range(rounds):
        if len(symbols) < 2 or len(rules) >= limit:
            break
        inner = ~first[1:]
        if least:
            late = symbols >= least
            inner &= late[1:] | late[:-1]
        pairs = _pairs(symbols, inner)
        keys = np.sort(pairs)
        if not len(keys):
            break
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        counts = np.diff(edge)
        frequent = np.flatnonzero(counts >= min_pairs)
        if not len(frequent):
            break
        take = min(PAIRS_A_ROUND, limit - len(rules), len(frequent))
        best = frequent[np.argsort(-counts[frequent], kind="stable")[:take]]
        chosen = np.sort(keys[edge[best]])
        # where a chosen pair stands; of overlapping ones every second counts
        number, hit = _places(chosen, pairs)
        at, number = np.flatnonzero(inner)[hit], number[hit].astype(np.int64)
        run = np.concatenate([[0], np.flatnonzero(np.diff(at) != 1) + 1, [len(at)]])
        place = np.arange(len(at)) - np.repeat(run[:-1], np.diff(run))
        at, number = at[place % 2 == 0], number[place % 2 == 0]
        if take == len(frequent):  # none of these pairs is left, so frequent ones have a new symbol
            least = base + len(rules)
        symbols = symbols.copy()
        symbols[at] = (base + len(rules) + number).astype(symbols.dtype)
        wide, shift = (np.uint32, 16) if chosen.dtype == np.uint32 else (np.uint64, 32)
        rules = np.concatenate(
            [rules, np.stack([chosen >> wide(shift), chosen & wide((1 << shift) - 1)], axis=1).astype(np.int64)]
        )
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, first = symbols[keep], first[keep]
    return symbols, rules, np.flatnonzero(first)


def _sizes(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(how many ids each nonterminal stands for, how deep its rules are nested)."""
    sizes, depths = [], []
    for left, right in rules.tolist():
        a, b = left - base, right - base
        sizes.append((sizes[a] if a >= 0 else 1) + (sizes[b] if b >= 0 else 1))
        depths.append(1 + max(depths[a] if a >= 0 else 0, depths[b] if b >= 0 else 0))
    return np.array(sizes, np.int64), np.array(depths, np.int64)


def expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(flat, ends): what each nonterminal stands for, one after the other; ends has one number more."""
    sizes, depths = _sizes(rules, base)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    flat = np.zeros(int(ends[-1]), np.uint32)
    for depth in range(1, int(depths.max(initial=0)) + 1):
        made = np.flatnonzero(depths == depth)
        inside = np.arange(int(sizes[made].sum())) - np.repeat(np.cumsum(sizes[made]) - sizes[made], sizes[made])
        flat[np.repeat(ends[made], sizes[made]) + inside] = expand(rules[made].ravel(), flat, ends, base)
    return flat, ends


def expand(symbols: np.ndarray, flat: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    symbols = symbols.astype(np.int64)
    rule = symbols >= base
    if not rule.any():
        return symbols.astype(np.uint32)
    sizes = np.ones(len(symbols), np.int64)
    sizes[rule] = np.diff(ends)[symbols[rule] - base]
    start = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint32)
    out[start[~rule]] = symbols[~rule]
    from_flat = ends[symbols[rule] - base]
    inside = np.arange(int(sizes[rule].sum())) - np.repeat(np.cumsum(sizes[rule]) - sizes[rule], sizes[rule])
    out[np.repeat(start[rule], sizes[rule]) + inside] = flat[np.repeat(from_flat, sizes[rule]) + inside]
    return out


SHARD_SCHEMA = (
    "part int, shard int, first_doc bigint, base int, width int, n_tokens bigint, "
    "symbols binary, rules binary, lengths binary, offsets binary, starts binary, doc_ids array<bigint>"
)


def _shard(part: int, shard: int, docs: list[int | None], ids: list[bytes], base: int) -> dict:
    arrays = [np.frombuffer(b, "<u4") for b in ids]
    starts = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int64)
    symbols, rules, offsets = compress(np.concatenate(arrays), starts[:-1], base)
    return {
        "part": part,
        "shard": shard,
        "first_doc": docs[0],
        "base": base,
        "width": symbols.dtype.itemsize,
        "n_tokens": int(starts[-1]),
        "symbols": symbols.astype(symbols.dtype.newbyteorder("<")).tobytes(),
        "rules": rules.astype("<u4").tobytes(),
        "lengths": _sizes(rules, base)[0].astype("<u4").tobytes(),
        "offsets": offsets.astype("<i8").tobytes(),
        "starts": starts.astype("<i8").tobytes(),
        "doc_ids": docs,
    }


def byte_tokenizer(key: str, file: str) -> ByteTokenizer:
    return held(key, lambda: ByteTokenizer(file))


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD_TOKENS,
    end_id: int = END_ID,
) -> None:
    """Write the ids of all documents, each with end_id after it, in ascending id order.

    Null texts count as empty, null ids come first, and rows with one id follow each other by a hash of their text.
    Rows are dealt by ranges of (id, hash), so no id has to fit into one task. A part is a range, in order; within a part
    shards of about shard_tokens are closed one after the other, which bounds a task's memory.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_file(vocabulary), encoding="utf-8") as source:
        sent = spark.sparkContext.broadcast(source.read())
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tokenizer = byte_tokenizer(key, sent.value)
        base = tokenizer.library.get_vocab_size()
        end = np.array([end_id], "<u4").tobytes()
        schema = pa.schema(
            [("part", pa.int32()), ("shard", pa.int32()), ("first_doc", pa.int64()), ("base", pa.int32())]
            + [("width", pa.int32()), ("n_tokens", pa.int64())]
            + [(n, pa.binary()) for n in ("symbols", "rules", "lengths", "offsets", "starts")]
            + [("doc_ids", pa.list_(pa.int64()))]
        )
        held_docs, held_ids, size, shard = [], [], 0, 0
        for batch in batches:
            for rows in slices(batch, 1, _SLICE_BYTES, _SLICE_ROWS):
                made = tokenizer(rows.column(1))
                for doc, ids in zip(rows.column(0).to_pylist(), made, strict=True):
                    held_docs.append(doc)
                    held_ids.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= shard_tokens:
                        yield pa.RecordBatch.from_pylist([_shard(part, shard, held_docs, held_ids, base)], schema)
                        held_docs, held_ids, size, shard = [], [], 0, shard + 1
        if held_docs:
            yield pa.RecordBatch.from_pylist([_shard(part, shard, held_docs, held_ids, base)], schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.col("hash")]
    ordered = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("id", "text").mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def unpack(row: dict) -> list[np.ndarray]:
    """The ids of each document of a shard row."""
    symbols = np.frombuffer(row["symbols"], f"<u{row['width']}")
    rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    starts = np.frombuffer(row["starts"], "<i8")
    flat, ends = expansions(rules, row["base"])
    ids = expand(symbols, flat, ends, row["base"])
    return [ids[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]


def unpack_range(row: dict, document: int, first: int, count: int) -> np.ndarray:
    """ids first .. first + count of one document of a shard row, from the symbols that cover them alone."""
    symbols = np.frombuffer(row["symbols"], f"<u{row['width']}").astype(np.int64)
    offsets = np.append(np.frombuffer(row["offsets"], "<i8"), len(symbols))
    own = symbols[offsets[document] : offsets[document + 1]]
    sizes = np.ones(len(own), np.int64)
    rule = own >= row["base"]
    sizes[rule] = np.frombuffer(row["lengths"], "<u4")[own[rule] - row["base"]]
    ends = np.cumsum(sizes)
    low = int(np.searchsorted(ends, first, side="right"))
    high = int(np.searchsorted(ends, first + count, side="left")) + 1
    rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    flat, rule_ends = expansions(rules, row["base"])
    ids = expand(own[low:high], flat, rule_ends, row["base"])
    skip = first - int(ends[low - 1] if low else 0)
    return ids[skip : skip + count]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, from the files alone."""
    ship(spark)
    shards = spark.read.parquet(path)
    # one row per shard, numbers only
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select(
        F.col("part").alias("p"),
        F.col("shard").alias("s"),
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                found = unpack(row)
                starts = np.frombuffer(row["starts"], "<i8")[:-1] + row["shard_start"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array([len(f) for f in found], pa.int64()),
                        pa.array([zlib.crc32(f.astype("<u4").tobytes()) for f in found], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    joined = shards.join(places, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s"))).drop("p", "s")
    return joined.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), path)
    return read(spark, path)
