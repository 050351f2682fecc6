"""Exact substring deduplication: suffixes in q-gram buckets, refined by bucket identifiers of later offsets.

Asked is, for every byte, whether a string of LENGTH bytes that covers it also starts in a document with a smaller
id. Suffixes need an order to LENGTH bytes only, so bucket-pointer refinement ends there:

1. Initial buckets. A suffix's bucket is its first Q bytes, named by a 64-bit number. Of each LENGTH-byte string
   one suffix is looked up: the one with the least bucket name among the LENGTH - Q + 1 that start in it (the first
   of equals). Equal strings choose alike, so a string whose chosen suffix has a bucket to itself, or shares it with
   no smaller id, is no repeat. Of neighbouring strings most choose the same suffix: about one suffix in
   (LENGTH - Q + 2) / 2 is looked up.
2. Refinement. A bucket that lives is refined by what its suffixes have at the offsets around: the bytes of all
   the strings that chose the suffix. In a repeat only its two ends differ; inside, all these strings are settled
   by one comparison.
3. Recursion. Where a bucket still holds different neighbourhoods, its suffixes are refined by the identifiers of
   step 1 at offsets half of LENGTH - Q to the left and to the right: a string that two suffixes share reaches as far
   on one side or the other, so those that meet no other document on a side list no strings of that side.
4. What is left is named string by string, by the pair of identifiers (bucket at i, bucket at i + LENGTH - Q), which
   covers LENGTH bytes when 2 Q >= LENGTH; further pairs are formed from the new names when it does not.

Buckets meet only once per bucket and block of documents (see blocks.py): in step 1 as one packed row per block and
range of names, of which there are as many as blocks, later as one row per bucket and block in a window; the answers go
back to the blocks that have a use for them, which take the next step. Names are 64-bit hashes, compared
within their bucket's name (48 bits, of which single strings keep 32): two different strings are taken for one with
a chance of 2^-96 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewick.llm import blocks
from candlewick.llm.common import table

LENGTH = 50
Q = 25
_SEGMENT = 1 << 20  # below 2^24, see _choose
_BUCKET = np.uint64(0xFFFFFFFFFFFF)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _MIX
    h ^= h >> np.uint64(29)
    h *= _BASE
    h ^= h >> np.uint64(32)
    return h


def bucket_names(data: np.ndarray, q: int) -> np.ndarray:
    """A number for the q bytes from each place on, by doubling: the name of 2k bytes is made of two of k."""
    with np.errstate(over="ignore"):
        power = {1: _BASE}
        names = {1: data.astype(np.uint64) + np.uint64(1)}
        k = 1
        while 2 * k <= q:
            power[2 * k] = power[k] * power[k]
            a = names[k]
            names[2 * k] = a[: len(a) - k] * power[k] + a[k:]
            k *= 2
        out, have = names[k], k
        rest = q - k
        while rest:
            k = 1 << (rest.bit_length() - 1)
            n = len(out) - k
            out = out[:n] * power[k] + names[k][have : have + n]
            have += k
            rest -= k
        return _mixed(out)


def _choose(names: np.ndarray, width: int) -> np.ndarray:
    """For each run of width neighbouring suffixes, the place of the one with the least name."""
    keyed = (names & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(names), dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        keyed = np.minimum(keyed[: len(keyed) - step], keyed[step:])
        have += step
    return (keyed & np.uint64(0xFFFFFF)).astype(np.int64)


class Suffixes:
    """The chosen suffixes of a stretch of one document: `first`..`last` are the starts of the strings that chose
    it, `bucket` its name; string i covers the bytes i .. i + length."""

    def __init__(self, data: bytes, start: int, length: int, q: int):
        self.data, self.start, self.length, self.q = data, start, length, q
        self.names = bucket_names(np.frombuffer(data, np.uint8), q)
        chosen = _choose(self.names, length - q + 1)
        edge = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1], [True]]))
        self.first, self.last = edge[:-1], edge[1:] - 1
        self.at = chosen[self.first]
        self.bucket = (self.names[self.at] & _BUCKET).view(np.int64)
        self.half = -(-(length - q) // 2)

    def around(self, which: np.ndarray) -> np.ndarray:
        """A name for all bytes that the strings of a suffix cover, with their place to it."""
        digest, data, length = xxhash.xxh3_64_intdigest, self.data, self.length
        spans = zip(self.first[which].tolist(), (self.last[which] + length).tolist(), strict=True)
        return np.array([digest(data[a:b]) for a, b in spans], np.uint64).view(np.int64)

    def named(self, starts: np.ndarray, size: int) -> np.ndarray:
        """A name for the `size` bytes from each start on, from the identifiers at later offsets."""
        with np.errstate(over="ignore"):
            name, covered = self.names[starts], self.q
            while covered < size:  # a name for covered bytes, and the bucket that ends further on
                covered = min(covered + self.q, size)
                name = _mixed(name * _BASE + self.names[starts + covered - self.q])
        return name.view(np.int64)

    def halves(self, which: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For the left and the right side: (suffixes with a string that reaches `half` bytes beyond the bucket on
        that side, name of the bytes up to there). A string that does on both sides counts as left."""
        at = self.at[which]
        left = which[at - self.first[which] >= self.half]
        right = which[at - self.last[which] < self.half]
        size = self.q + self.half
        return [(left, self.named(self.at[left] - self.half, size)), (right, ~self.named(self.at[right], size))]

    def strings(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(suffix, start, name) of each string on the left side of some suffixes and on the right side of others."""
        edge = self.at - self.half  # the last start on the left side
        of = np.concatenate([left, right])
        first = np.concatenate([self.first[left], np.maximum(self.first[right], edge[right] + 1)])
        last = np.concatenate([np.minimum(self.last[left], edge[left]), self.last[right]])
        sizes = last - first + 1
        starts = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        return np.repeat(of, sizes), starts, self.named(starts, self.length)


def suffixes_of(text: bytes, length: int, q: int) -> Iterator[Suffixes]:
    """Stretches that share length - 1 bytes with the next, so that each string is in just one."""
    for low in range(0, max(0, len(text) - length + 1), _SEGMENT):
        yield Suffixes(text[low : low + _SEGMENT + length - 1], low, length, q)


def _rows(group: pa.Table, names: list[str], keys: list[list[np.ndarray]], ids: list[np.ndarray]) -> pa.Table:
    none = np.zeros(0, np.int64)
    joined, least, more = blocks.least_ids(
        [np.concatenate([none, *k]) for k in keys], np.concatenate([none, *ids])
    )
    block = np.full(len(least), group.column("block")[0].as_py(), np.int32)
    return pa.table({"block": block, **dict(zip(names, joined, strict=True)), "least": least, "more": more})


_PACKED = "block int, part int, packed binary"


def _packed(names: np.ndarray, more: np.ndarray) -> bytes:
    """Ascending names of buckets with a flag each: the differences by bytes of equal weight, squeezed."""
    steps = np.diff((names << 1) | more, prepend=0).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.T).tobytes())


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(names, flags) again."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    both = np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).ravel())
    return both >> 1, (both & 1).astype(bool)


def _initial(length: int, q: int, parts: int):
    """Of each block one row per range of bucket names: the names that its suffixes have, and if several ids do."""

    def run(group: pa.Table) -> pa.Table:
        keys, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for doc, text in blocks.documents_of(group):
            for part in suffixes_of(text, length, q) if doc is not None else ():
                keys.append(part.bucket)
                ids.append(np.full(len(part.bucket), doc, np.int64))
        names, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(names)
        names, ids = names[order], ids[order]
        new = np.ones(len(names), bool)
        new[1:] = names[1:] != names[:-1]
        more = np.zeros(int(new.sum()), bool)
        more[np.cumsum(new)[1:][~new[1:] & (ids[1:] != ids[:-1])] - 1] = True
        names = names[new]
        cuts = np.searchsorted(names, _edges(parts)).tolist()
        filled = [k for k in range(parts) if cuts[k] < cuts[k + 1]]
        packed = [_packed(names[cuts[k] : cuts[k + 1]], more[cuts[k] : cuts[k + 1]]) for k in filled]
        block = np.full(len(filled), group.column("block")[0].as_py(), np.int32)
        return pa.table({"block": block, "part": pa.array(filled, pa.int32()), "packed": pa.array(packed, pa.binary())})

    return run


def _edges(parts: int) -> np.ndarray:
    """Where the ranges of bucket names begin, and where the last one ends."""
    return np.array([(k << 48) // parts for k in range(parts + 1)], np.int64)


def _live(group: pa.Table) -> pa.Table:
    """The names in a range that several ids have, for each block that has some."""
    numbers, found = [], []
    for number, packed in enumerate(group.column("packed").to_pylist()):
        found.append(_unpacked(packed))
        numbers.append(np.full(len(found[-1][0]), number, np.int32))
    names, more, of = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), np.concatenate(numbers)
    order = np.argsort(names)
    ordered = names[order]
    same = np.zeros(len(names) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    live = more.copy()
    live[order] |= same[1:] | same[:-1]
    edges = np.cumsum([0, *(len(f[0]) for f in found)]).tolist()
    rows = [(k, names[a:b][live[a:b]]) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if live[a:b].any()]
    taken = pa.array([k for k, _ in rows], pa.int64())
    packed = pa.array([_packed(n, np.zeros(len(n), bool)) for _, n in rows], pa.binary())
    return pa.table({"block": group.column("block").take(taken), "part": group.column("part").take(taken), "packed": packed})


def _refined(length: int, q: int):
    def run(group: pa.Table, live: pa.Table) -> pa.Table:
        found = [_unpacked(packed)[0] for packed in live.sort_by("part").column("packed").to_pylist()]
        known = np.concatenate([np.zeros(0, np.int64), *found])
        buckets, names, ids = [], [], []
        for doc, text in blocks.documents_of(group) if len(known) else ():
            for part in suffixes_of(text, length, q) if doc is not None else ():
                which = np.flatnonzero(blocks.find_in_sorted(known, part.bucket)[1])
                buckets.append(part.bucket[which])
                names.append(part.around(which))
                ids.append(np.full(len(which), doc, np.int64))
        return _rows(group, ["bucket", "name"], [buckets, names], ids)

    return run


def _key(bucket: np.ndarray, name: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(bucket.view(np.uint64) * _BASE + name.view(np.uint64))


class _Answers:
    """(bucket, name) -> least id."""

    def __init__(self, rows: pa.Table):
        self.bucket, self.name, self.least = (rows.column(c).to_numpy() for c in ("bucket", "name", "least"))
        key = _key(self.bucket, self.name)
        self.order = np.argsort(key)
        self.key = key[self.order]
        self.buckets = np.unique(self.bucket)

    def least_of(self, bucket: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, least id)."""
        place, found = blocks.find_in_sorted(self.key, _key(bucket, name))
        if not len(self.key):
            return found, np.zeros(len(bucket), np.int64)
        at = self.order[place]
        return found & (self.bucket[at] == bucket) & (self.name[at] == name), self.least[at]


def _short(bucket: np.ndarray) -> np.ndarray:
    """32 bits of a bucket's name, for the many rows of single strings."""
    return ((bucket ^ (bucket >> 32)) & 0xFFFFFFFF).astype(np.int64)


def _row_name(doc: int, text: bytes) -> int:
    """A name for a row of documents, the same in every step."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(text, seed=doc & (2**64 - 1))).view(np.int64))


def _runs(block: int, found: list[np.ndarray]) -> pa.Table:
    """Rows for runs that whole neighbourhoods settle. bucket: the document's row, name and least: start and end."""
    row, first, last = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
    count = len(row)
    return pa.table(
        {
            "block": np.full(count, block, np.int32),
            "bucket": row,
            "name": first,
            "least": last,
            "more": np.zeros(count, bool),
            "whole": np.ones(count, bool),
        }
    )


def _halved(length: int, q: int):
    """Runs, and the sides of suffixes of mixed buckets: name, and the ids that speak for their neighbourhoods."""

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        known = _Answers(answers)
        mixed = np.unique(known.bucket[answers.column("mixed").to_numpy()])
        names, ids, runs = [none], [none], []
        for doc, text in blocks.documents_of(group) if len(known.buckets) else ():
            starts, ends = [none], [none]
            for part in suffixes_of(text, length, q) if doc is not None else ():
                which = np.flatnonzero(blocks.find_in_sorted(known.buckets, part.bucket)[1])
                found, least = known.least_of(part.bucket[which], part.around(which))
                repeat = which[found & (least < doc)]
                starts.append(part.first[repeat] + part.start)
                ends.append(part.last[repeat] + length + part.start)
                # a neighbourhood that a smaller id has too is settled, and that id speaks for its strings
                which = which[found & (least == doc)]
                which = which[blocks.find_in_sorted(mixed, part.bucket[which])[1]]
                for _, name in part.halves(which) if len(which) else ():
                    names.append(np.unique(name))
                    ids.append(np.full(len(names[-1]), doc, np.int64))
            first, last = blocks.merged(np.concatenate(starts), np.concatenate(ends))
            if len(first):
                runs.append(np.stack([np.full(len(first), _row_name(doc, text), np.int64), first, last]))
        block = (group if len(group) else answers).column("block")[0].as_py()
        settled = _runs(block, runs)
        name, doc = np.concatenate(names), np.concatenate(ids)
        order = np.lexsort([doc, name])
        name, doc = name[order], doc[order]
        fresh = np.ones(len(name), bool)
        fresh[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        name, doc = name[fresh], doc[fresh]
        edge = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1], [True]])) if len(name) else none
        count = max(0, len(edge) - 1)
        sides = pa.table(
            {
                "block": np.full(count, block, np.int32),
                "bucket": np.zeros(count, np.int64),
                "name": name[edge[:-1]],
                "least": np.zeros(count, np.int64),
                "more": np.diff(edge) > 1,
                "whole": np.zeros(count, bool),
            }
        )
        lists = pa.ListArray.from_arrays(pa.array(edge if count else [0], pa.int32()), pa.array(doc))
        nobody = pa.array([[]] * len(settled), pa.list_(pa.int64()))
        return pa.concat_tables([settled.append_column("ids", nobody), sides.append_column("ids", lists)])

    return run


def _recursed(length: int, q: int):
    """The runs again, and the strings on sides that other documents have too."""

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        whole = answers.column("whole")
        settled = answers.filter(whole).select(["block", "bucket", "name", "least", "more", "whole"])
        sides = answers.filter(pa.compute.invert(whole))
        lists = sides.column("ids").combine_chunks()
        name = np.repeat(sides.column("name").to_numpy(), pa.compute.list_value_length(lists).to_numpy(False))
        speaks = np.sort(_key(name, lists.flatten().to_numpy()))
        buckets, names, ids = [], [], []
        for doc, text in blocks.documents_of(group) if len(speaks) else ():
            for part in suffixes_of(text, length, q) if doc is not None else ():
                left, right = (
                    which[blocks.find_in_sorted(speaks, _key(name, np.full(len(name), doc, np.int64)))[1]]
                    for which, name in part.halves(np.arange(len(part.bucket)))
                )
                of, _, name = part.strings(left, right)
                buckets.append(_short(part.bucket[of]))
                names.append(name)
                ids.append(np.full(len(name), doc, np.int64))
        strings = _rows(group if len(group) else answers, ["bucket", "name"], [buckets, names], ids)
        strings = strings.append_column("whole", pa.array(np.zeros(len(strings), bool)))
        return pa.concat_tables([settled.cast(strings.schema), strings.select(settled.column_names)])

    return run


def _removed(length: int, q: int):
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        whole = answers.column("whole").to_numpy()
        runs = answers.filter(pa.array(whole)).sort_by("bucket")
        of_row, first, last = (runs.column(c).to_numpy() for c in ("bucket", "name", "least"))
        strings = _Answers(answers.filter(pa.array(~whole)))
        rows = []
        for doc, text in blocks.documents_of(group):
            starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            if doc is not None and len(answers):
                own = _row_name(doc, text)
                low, high = (int(np.searchsorted(of_row, own, side=side)) for side in ("left", "right"))
                starts.append(first[low:high])
                ends.append(last[low:high])
            for part in suffixes_of(text, length, q) if doc is not None and len(strings.buckets) else ():
                short = _short(part.bucket)
                which = np.flatnonzero(blocks.find_in_sorted(strings.buckets, short)[1])
                if len(which):
                    of, at, name = part.strings(which[part.at[which] - part.first[which] >= part.half],
                                                which[part.at[which] - part.last[which] < part.half])
                    found, least = strings.least_of(short[of], name)
                    at = at[found & (least < doc)] + part.start
                    starts.append(at)
                    ends.append(at + length)
            spans = blocks.merged(np.concatenate(starts), np.concatenate(ends))
            rows.append(
                {
                    "id": doc,
                    "n_bytes": len(text),
                    "n_removed": int((spans[1] - spans[0]).sum()),
                    "spans": np.stack(spans, axis=1).ravel().tolist(),
                    "kept": blocks.without(text, *spans),
                }
            )
        return pa.Table.from_pylist(rows, _OUT)

    return run


_OUT = pa.schema(
    [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64())]
    + [("spans", pa.list_(pa.int64())), ("kept", pa.binary())]
)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    q: int = Q,
    block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): one row per input row.

    spans lists the maximal removed runs as start and end bytes by turns; kept is the rest (bytes: a cut may fall
    inside a character). Null texts count as empty; shorter ones than length have no repeats. Rows with one id, and
    rows without an id, are no copies of each other; a row without an id stays whole and removes nothing elsewhere.
    Other columns are not read.
    """
    if not 0 < q <= length:
        raise ValueError("q must be between 1 and length")
    dealt, count = blocks.counted_blocks(docs, id_col, text_col, block_bytes)
    texts = dealt.groupBy("block")
    row = "block int, bucket long, name long, least long, more boolean"
    bucket, same = Window.partitionBy("bucket"), Window.partitionBy("bucket", "name")
    live = texts.applyInArrow(_initial(length, q, count), _PACKED).groupBy("part").applyInArrow(_live, _PACKED)
    refined = texts.cogroup(live.groupBy("block")).applyInArrow(_refined(length, q), row)
    refined = (
        refined.withColumn("mixed", F.min("name").over(bucket) != F.max("name").over(bucket))
        .withColumn("first", F.min("least").over(same))
        .where("least > first OR more OR mixed")
        .select("block", "bucket", "name", F.col("first").alias("least"), "mixed")
    )
    # what whole neighbourhoods settle passes through as runs, so that no step is computed for two readers
    sides = texts.cogroup(refined.groupBy("block")).applyInArrow(
        _halved(length, q), f"{row}, whole boolean, ids array<long>"
    )
    side = Window.partitionBy("whole", "bucket", "name")
    sides = sides.withColumn("n", F.count("*").over(side)).where("whole OR more OR n > 1").drop("n")
    strings = texts.cogroup(sides.groupBy("block")).applyInArrow(_recursed(length, q), f"{row}, whole boolean")
    same = Window.partitionBy("bucket", "name", "whole")
    answers = (
        strings.withColumn("first", F.min("least").over(same))
        .where("whole OR more OR least > first")
        .select("block", "bucket", "name", F.col("first").alias("least"), "whole")
    )
    return texts.cogroup(answers.groupBy("block")).applyInArrow(
        _removed(length, q), "id long, n_bytes long, n_removed long, spans array<long>, kept binary"
    )


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.expr("size(spans) div 2").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
