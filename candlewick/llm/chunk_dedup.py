"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes: h = 2 h + gear[byte], so it depends on the last 32 bytes alone. A chunk ends at
each byte whose hash is the largest within REACH bytes on both sides (the first of equals). Ends depend on the
bytes nearby only: after an insertion or deletion the chunks fall into step again, and there is no least or most
length to enforce. Chunks are compared by a 128-bit digest. A chunk is a repeat if its digest is also in a document
with a smaller id, or earlier in its own document; neighbouring repeats form a run. Runs of MIN_RUN bytes or more are
removed, and shorter ones if they are the whole document. Other short runs are what ordinary prose has in common by
chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm import blocks
from candlewick.llm.common import table

REACH = 24
MIN_RUN = 64
_SEGMENT = 1 << 20
#: The gear table is made by a rule, so that every executor has the same.
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte, by doubling the width: 32 steps of h = 2 h + gear in five additions."""
    h = GEAR[data]
    for shift in (1, 2, 4, 8, 16):
        if len(h) > shift:
            h = np.concatenate([h[:shift], h[shift:] + (h[:-shift] << np.uint32(shift))])
    return h


def _window_max(h: np.ndarray, width: int) -> np.ndarray:
    """The largest of the width values from each place on."""
    have = 1
    while have < width:
        step = min(have, width - have)
        h = np.maximum(h[: len(h) - step], h[step:])
        have += step
    return h


def chunk_ends(text: bytes, reach: int = REACH) -> np.ndarray:
    """Where chunks end (exclusive), the end of the text last; none for an empty text."""
    ends = []
    margin = reach + 32
    for low in range(0, len(text), _SEGMENT):
        start, stop = max(0, low - margin), min(len(text), low + _SEGMENT + margin)
        h = gear_hash(np.frombuffer(text, np.uint8, stop - start, start)).astype(np.int64)
        padded = np.concatenate([np.full(reach, -1), h, np.full(reach, -1)])
        most = _window_max(padded, reach)
        n = len(h)
        top = (most[:n] < h) & (most[reach + 1 : reach + 1 + n] <= h)
        at = np.flatnonzero(top) + start + 1
        ends.append(at[(at > low) & (at <= low + _SEGMENT)])
    found = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return found if not len(text) or (len(found) and found[-1] == len(text)) else np.append(found, len(text))


def chunk_digests(text: bytes, ends: np.ndarray) -> np.ndarray:
    """(chunks, 2) signed 64-bit halves of the digests."""
    edges = [0, *ends.tolist()]
    digest = b"".join(
        [hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(edges, edges[1:], strict=False)]
    )
    return np.frombuffer(digest, "<i8").reshape(-1, 2)


def _seen_before(digests: np.ndarray) -> np.ndarray:
    """Whether each digest is among those before it."""
    out = np.ones(len(digests), bool)
    out[np.unique(digests, axis=0, return_index=True)[1]] = False
    return out


def _collect(reach: int):
    def run(group: pa.Table) -> pa.Table:
        keys, ids = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
        for doc, text in blocks.documents_of(group):
            if doc is not None and text:
                found = chunk_digests(text, chunk_ends(text, reach))
                keys.append(found)
                ids.append(np.full(len(found), doc, np.int64))
        both = np.concatenate(keys)
        (high, low), least, more = blocks.least_ids([both[:, 0], both[:, 1]], np.concatenate(ids))
        block = np.full(len(least), group.column("block")[0].as_py(), np.int32)
        return pa.table({"high": high, "low": low, "block": block, "least": least, "more": more})

    return run


def _remove(reach: int, min_run: int):
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("low").to_numpy())
        high, low, first = (answers.column(c).to_numpy()[order] for c in ("high", "low", "first"))
        rows = []
        for doc, text in blocks.documents_of(group):
            ends = chunk_ends(text, reach)
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            runs = (ends[:0], ends[:0])
            repeats = 0
            if doc is not None and len(ends):
                wanted = chunk_digests(text, ends)
                place, repeat = blocks.find_in_sorted(low, wanted[:, 1])
                if len(low):
                    repeat &= (high[place] == wanted[:, 0]) & (first[place] < doc)
                repeat |= _seen_before(wanted)
                runs = blocks.merged(starts[repeat], ends[repeat])
                long = runs[1] - runs[0] >= min(min_run, len(text))
                runs = (runs[0][long], runs[1][long])
                repeats = int(repeat.sum())
            rows.append(
                {
                    "id": doc,
                    "n_bytes": len(text),
                    "n_chunks": len(ends),
                    "n_repeats": repeats,
                    "n_removed": int((runs[1] - runs[0]).sum()),
                    "spans": np.stack(runs, axis=1).ravel().tolist(),
                    "kept": blocks.without(text, *runs),
                }
            )
        return pa.Table.from_pylist(rows, _OUT)

    return run


_OUT = pa.schema(
    [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_chunks", pa.int64()), ("n_repeats", pa.int64())]
    + [("n_removed", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept", pa.binary())]
)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    reach: int = REACH,
    min_run: int = MIN_RUN,
    block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """(id, n_bytes, n_chunks, n_repeats, n_removed, spans, kept): one row per input row.

    spans lists the removed runs as start and end bytes by turns; kept is the rest (bytes: a cut may fall inside a
    character). Null texts count as empty. Rows with one id, and rows without an id, are no copies of each other; a
    row without an id stays whole and removes nothing elsewhere. Other columns are not read.
    """
    dealt = blocks.in_blocks(docs, id_col, text_col, block_bytes)
    chunks = dealt.groupBy("block").applyInArrow(
        _collect(reach), "high long, low long, block int, least long, more boolean"
    )
    same = Window.partitionBy("high", "low")
    answers = (
        chunks.withColumn("first", F.min("least").over(same))
        .withColumn("n", F.count("*").over(same))
        .where("n > 1 OR more")
        .select("block", "high", "low", "first")
    )
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _remove(reach, min_run),
            "id long, n_bytes long, n_chunks long, n_repeats long, n_removed long, spans array<long>, kept binary",
        )
    )


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_chunks",
        "n_repeats",
        "n_removed",
        F.expr("size(spans) div 2").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
