"""Near-duplicate vectors by randomly rotated binary codes with stored correction factors.

A unit vector o is rotated at random and kept as the signs of its coordinates: the code, a unit vector o' with
coordinates +-1/sqrt(D). With it is stored c = <o', o>. For a query q, s = <o', q> gives the unbiased estimate
s / c of the cosine <o, q>, and two bounds for it:

* for certain, cosine <= c s + sqrt((1 - c^2) (1 - s^2)), by the angles between o, o' and q;
* with confidence, |s / c - cosine| <= eps sqrt((1 - c^2) / (c^2 (D - 1))), the part of o off o' being random.

A pair whose bound stays below the threshold is settled by its code. All others are computed anew in double
precision, so no pair is reported below the threshold. The default eps of 9 leaves about one chance in 10^17 a
pair that the second bound is wrong; eps=None uses the first bound alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import ship, stored, table
from candlewick.llm.components import connected_components, spanning_forest

THRESHOLD = 0.93
EPS = 9.0
TILE_ROWS = 1024
_SLACK = 1e-4  # for the single precision of the estimates
_EXACT_ROWS = 32_768

_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every executor."""
    if (dim, seed) not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
        _ROTATIONS[dim, seed] = q * np.sign(np.diag(r))
    return _ROTATIONS[dim, seed]


def encode(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction factors of the rows."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ rotation(vectors.shape[1], seed)
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def candidates(
    codes: np.ndarray, factors: np.ndarray, queries: np.ndarray, threshold: float, seed: int, eps: float | None = EPS
) -> np.ndarray:
    """Which (query, code) pairs the bounds can't settle."""
    dim = queries.shape[1]
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    turned = (unit @ rotation(dim, seed)).astype(np.float32)
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    s = np.clip((turned @ signs.T) / np.float32(np.sqrt(dim)), -1, 1)
    c = np.clip(factors.astype(np.float32), 1e-6, 1)[None, :]
    off = np.sqrt(1 - c * c)
    open_pairs = c * s + off * np.sqrt(1 - s * s) >= threshold - _SLACK
    if eps is not None and dim > 1:
        open_pairs &= s / c + np.float32(eps / np.sqrt(dim - 1)) * off / c >= threshold - _SLACK
    return open_pairs


def exact_links(a: np.ndarray, b: np.ndarray, open_pairs: np.ndarray, threshold: float) -> np.ndarray:
    """The open pairs whose cosine in double precision reaches the threshold."""
    hits = np.zeros(open_pairs.shape, bool)
    rows, columns = np.nonzero(open_pairs)
    na, nb = np.sqrt(np.einsum("ij,ij->i", a, a)), np.sqrt(np.einsum("ij,ij->i", b, b))
    for low in range(0, len(rows), _EXACT_ROWS):
        r, c = rows[low : low + _EXACT_ROWS], columns[low : low + _EXACT_ROWS]
        hits[r, c] = np.einsum("ij,ij->i", a[r], b[c]) / (na[r] * nb[c]) >= threshold
    return hits


def _usable(vector: str) -> str:
    finite = f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    return f"{vector} IS NOT NULL AND {finite} AND exists({vector}, x -> x != 0)"


def _vectors(values: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _coded(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, factors = [], []
            for k in range(batch.num_rows):
                code, factor = encode(_vectors(batch.column("vectors").slice(k, 1).flatten()), seed)
                codes.append(code.tobytes())
                factors.append(factor)
            columns = [*batch.columns, pa.array(codes, pa.binary()), pa.array(factors, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "codes", "factors"])

    return run


def _compared(threshold: float, seed: int, eps: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, a, b = [], [], []
            for k in range(batch.num_rows):
                cell = lambda name, k=k: batch.column(name).slice(k, 1).flatten()
                x, y = _vectors(cell("vectors")), _vectors(cell("other_vectors"))
                codes = np.frombuffer(batch.column("codes")[k].as_py(), np.uint8).reshape(len(y), -1)
                factors = cell("factors").to_numpy()
                open_pairs = candidates(codes, factors, x, threshold, seed, eps)
                if batch.column("same")[k].as_py():
                    open_pairs = np.triu(open_pairs | open_pairs.T, 1)
                hits = exact_links(x, y, open_pairs, threshold)
                if not hits.any():
                    continue
                ids, others = cell("ids").to_numpy(), cell("other_ids").to_numpy()
                for here, counts in (
                    (ids, hits @ cell("other_copies").to_numpy()),
                    (others, hits.T @ cell("copies").to_numpy()),
                ):
                    linked = np.flatnonzero(counts)
                    kind += [0] * len(linked)
                    a += here[linked].tolist()
                    b += counts[linked].tolist()
                forest = spanning_forest(hits)
                kind += [1] * len(forest)
                a += [int(ids[r]) for r, _ in forest]
                b += [int(others[c]) for _, c in forest]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"]
            )

    return run


def near_duplicates(
    spark: SparkSession,
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    eps: float | None = EPS,
    tile_rows: int = TILE_ROWS,
    seed: int = 7,
) -> DataFrame:
    """(id, n_links, component, kept): one row per input row.

    Rows are compared where labels are equal and lengths agree. A vector that is null, empty, zero or holds a
    null or non-finite value links with nothing, as does a row without a label or an id. Equal rows of a label are
    one class: they are compared once and counted as often as they occur. Rows that repeat an id with another
    vector count as one vector with both links. Within a label all tiles meet, in blocks of tile_rows rows: links
    are counted per tile pair, and of the links themselves only enough to connect the same rows leave a task.
    """
    ship(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).alias("vector"),
        F.col(label_col).alias("label"),
    )
    good = rows.where(f"id IS NOT NULL AND label IS NOT NULL AND {_usable('vector')}")
    # a vector and its negative zeros are one key
    good = good.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0)).otherwise(x)))
    good = good.withColumn("dim", F.size("vector"))
    classes = stored(
        spark, good.groupBy("label", "dim", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    )
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("blocks"))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn(
        "block", F.pmod(F.xxhash64("rep", "vector"), F.col("blocks")).cast("int")
    )
    tiles = dealt.groupBy("label", "dim", "block").agg(F.collect_list(F.struct("rep", "copies", "vector")).alias("r"))
    tiles = tiles.select(
        "label",
        "dim",
        "block",
        F.col("r.rep").alias("ids"),
        F.col("r.copies").alias("copies"),
        F.col("r.vector").cast("array<array<double>>").alias("vectors"),
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tiles.schema)
    coded = stored(spark, tiles.mapInArrow(_coded(seed), f"{schema}, codes binary, factors array<double>"))
    left = coded.select("label", "dim", F.col("block").alias("own_block"), "ids", "copies", "vectors")
    right = coded.select(
        "label",
        "dim",
        "block",
        F.col("ids").alias("other_ids"),
        F.col("copies").alias("other_copies"),
        F.col("vectors").alias("other_vectors"),
        "codes",
        "factors",
    )
    pairs = left.join(right, ["label", "dim"]).where("own_block <= block")
    pairs = pairs.withColumn("same", F.expr("own_block = block")).drop("label", "dim", "block", "own_block")
    # a row holds two tiles: deal the rows evenly, for a hot label has most of them
    found = stored(
        spark,
        pairs.repartition(F.xxhash64(F.element_at("ids", 1), F.element_at("other_ids", 1))).mapInArrow(
            _compared(threshold, seed, eps), "kind int, a long, b long"
        ),
    )
    counts = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    component = connected_components(spark, found.where("kind = 1").select("a", "b"))
    named = (
        classes.withColumnRenamed("rep", "node")
        .join(counts, "node", "left")
        .join(component, "node", "left")
        .select(
            F.col("label").alias("class_label"),
            F.col("vector").alias("class_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    linked = good.join(
        named, (F.col("label") == F.col("class_label")) & (F.col("vector") == F.col("class_vector"))
    ).select("id", F.col("links").cast("long").alias("n_links"), "component")
    alone = rows.where(f"NOT coalesce(id IS NOT NULL AND label IS NOT NULL AND {_usable('vector')}, false)").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("id") == F.col("component"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark, table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept"
    )


# Cosines of all pairs with equal labels; the links are followed from every vector.
OP5_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id != b.vec_id
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.93
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), component AS (SELECT x, min(y) AS least FROM reach GROUP BY x
), degree AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.least AS component_id, e.vec_id = c.least AS kept
FROM embeddings e JOIN component c ON c.x = e.vec_id LEFT JOIN degree d ON d.x = e.vec_id
"""
