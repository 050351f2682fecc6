"""Documents in blocks of bounded size, for operators that look up what a block holds in all other blocks.

A block gathers documents by a hash of their id. What one block wants to know is first reduced inside the block to
one row per distinct key, so a key that is in every document costs one row per block and no more; the rows of a key
meet in a window, and the answers go back to their blocks. The texts move once: every later visit to the blocks
reads the same exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import ship

BLOCK_BYTES = 8 << 20


def in_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, id, text): texts as UTF-8, null as empty, packed for the exchange; all rows of an id are in one block,
    rows without an id go by their texts."""
    return counted_blocks(docs, id_col, text_col, block_bytes)[0]


def counted_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The same, and how many blocks there may be."""
    ship(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    key = F.col(id_col).cast("long")
    dealt = docs.select(
        F.pmod(F.xxhash64(key, F.when(key.isNull(), F.col(text_col))), F.lit(blocks)).cast("int").alias("block"),
        key.alias("id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = pa.array([compress(t) for t in part.column(2).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], ["block", "id", "text"])

    return dealt.mapInArrow(pack, "block int, id long, text binary"), blocks


def least_ids(keys: list[np.ndarray], ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(distinct keys, least id, whether there are more ids) of key columns as signed 64-bit numbers."""
    if not len(ids):
        return [k[:0] for k in keys], ids, np.zeros(0, bool)
    order = np.lexsort([ids, *keys[::-1]])
    keys, ids = [k[order] for k in keys], ids[order]
    new = np.zeros(len(ids), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    return [k[first] for k in keys], ids[first], ids[first] != ids[last]


def find_in_sorted(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of the wanted numbers among the known ones."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return place, known[place] == wanted


def documents_of(table: pa.Table) -> Iterator[tuple[int | None, bytes]]:
    """(id, text) of the rows of a block, one unpacked at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for number, text in zip(table.column("id").to_pylist(), table.column("text").to_pylist(), strict=True):
        yield number, unpack(text)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of half-open spans; spans that touch are one run."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    first = np.flatnonzero(new)
    return starts[first], ends[np.append(first[1:], len(starts)) - 1]


def without(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The text without the given runs."""
    edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
