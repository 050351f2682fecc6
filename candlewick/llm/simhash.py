"""SimHash near-duplicates: exact comparison of fingerprints in tiles.

A fingerprint falls into a tile by the population counts of its four 16-bit quarters. Two fingerprints within
r differing bits have counts that differ by r or less in sum over the quarters, so only pairs of tiles within
that distance are compared, each by exclusive-or and bit counts in numpy. No link is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import ship, stored, table
from candlewick.llm.components import connected_components, spanning_forest

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
QUARTER = 16
TILE_ROWS = 1024
_STRIPE = 65_536


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text as a signed 64-bit number; zero without words."""
    words = (text or b"").lower().split()  # on bytes: A-Z, and exactly the bytes 20 and 09-0D
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    n = len(words) - width + 1
    for low in range(0, n, _STRIPE):
        high = min(n, low + _STRIPE)
        hashes = np.array(
            [
                digest(joined[a:b], SEED)
                for a, b in zip(starts[low:high], (x - 1 for x in starts[low + width : high + width]), strict=True)
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): one row per input row; a null text counts as empty."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = part.column(1).to_pylist()
                out = pa.array([fingerprint_of(t, shingle) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), out], ["id", "fp"])

    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")
    ).mapInArrow(run, "id long, fp long")


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Zero and one of each two opposite steps between quarter counts within the radius."""
    steps = product(range(-radius, radius + 1), repeat=4)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]


def _tiles(prints: DataFrame, tile_rows: int) -> DataFrame:
    """(q0..q3, block, fps, ids): fingerprints with equal quarter counts, in blocks of about tile_rows."""
    quarters = [
        F.bit_count(F.shiftrightunsigned("fp", QUARTER * i).bitwiseAND(F.lit(0xFFFF))).cast("int").alias(f"q{i}")
        for i in range(4)
    ]
    marked = prints.select("fp", "rep", *quarters)
    keys = ["q0", "q1", "q2", "q3"]
    # at most 17^4 rows, whatever the input: small enough to broadcast
    sizes = marked.groupBy(*keys).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("blocks"))
    dealt = marked.join(F.broadcast(sizes), keys).withColumn(
        "block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    )
    return dealt.groupBy(*keys, "block").agg(F.collect_list(F.struct("fp", "rep")).alias("rows")).select(
        *keys, "block", F.col("rows.fp").alias("fps"), F.col("rows.rep").alias("ids")
    )


def _compare(radius: int):
    def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (left, fa), (_, ia), (right, fb), (_, ib) = (
                lists(batch.column(n)) for n in ("fps", "ids", "other_fps", "other_ids")
            )
            fa, fb = fa.view(np.uint64), fb.view(np.uint64)
            same = batch.column("same").to_numpy(zero_copy_only=False)
            a, b = [], []
            for k in range(batch.num_rows):
                x, y = fa[left[k] : left[k + 1]], fb[right[k] : right[k + 1]]
                hits = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
                if same[k]:
                    hits = np.triu(hits, 1)
                if hits.any():
                    for r, c in spanning_forest(hits):
                        a.append(ia[left[k] + r])
                        b.append(ib[right[k] + c])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints of (fp, rep) to connect all within max_bits."""
    ship(prints.sparkSession)
    keys = ["q0", "q1", "q2", "q3"]
    tiles = _tiles(prints, tile_rows)
    steps = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(s)]) for s in _offsets(max_bits)])
    left = (
        tiles.withColumn("step", F.explode(steps))
        .select(
            *[(F.col(k) + F.col(f"step.d{i}")).alias(k) for i, k in enumerate(keys)],
            F.col("block").alias("own_block"),
            "fps",
            "ids",
            F.expr("step.d0 = 0 AND step.d1 = 0 AND step.d2 = 0 AND step.d3 = 0").alias("here"),
        )
        .where(" AND ".join(f"{k} BETWEEN 0 AND {QUARTER}" for k in keys))
    )
    right = tiles.select(*keys, "block", F.col("fps").alias("other_fps"), F.col("ids").alias("other_ids"))
    pairs = left.join(right, keys).where("NOT here OR own_block <= block")
    return pairs.select(
        "fps", "ids", "other_fps", "other_ids", F.expr("here AND own_block = block").alias("same")
    ).mapInArrow(_compare(max_bits), "a long, b long")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(id, fp, component): one row per input row.

    Rows with equal or linked fingerprints share a component, the least id that can be reached. A row without
    words has fingerprint zero and is linked like any other; a row without an id gets its fingerprint and no
    component, and links nothing. Repeated rows come back as often as they came; other columns are not read.
    """
    prints = stored(spark, fingerprints(docs, id_col, text_col, shingle))
    distinct = prints.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep"))
    distinct = stored(spark, distinct)
    found = connected_components(spark, links(distinct, max_bits, tile_rows))
    named = distinct.join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("component", "rep").alias("component")
    )
    joined = prints.join(named, F.col("fp") == F.col("class_fp"), "left")
    return joined.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
