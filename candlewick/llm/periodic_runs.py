"""Stretches of words that repeat with a period, by internal pattern matching.

Many texts are worked on at once: their words become one array of numbers in which no number is in two texts, so that
nothing below can cross from one text into another.

1. *Suffix array* by prefix doubling. Only suffixes that share their first words with another one are sorted again, and
   from the second round on ordinary text has few. Of the sorted order are kept the blocks' boundaries per length: the
   suffixes that begin with the same 2**k words are neighbours in it.
2. *Wavelet tree* over the positions in suffix order, without the suffixes that are alone with their first words.
   A range successor query gives the first occurrence of a block at or after a position: the number of smaller
   positions in the block's range, then the next one in order.
3. *Dyadic blocks.* A run of period q with 2**k <= q < 2**(k+1) and three periods holds an aligned block of 2**k words
   and its copy q words on. So each aligned block is looked for in the 2**k places from 2**k words after it on (periods
   below 8 share blocks of 8 words, as a run has MIN_LENGTH words at least).
4. *Progressions.* Occurrences that overlap by half a block or more are a progression, whose difference d is the period
   of the block. If the run's period is not d, the stretch of period d around the block ends inside the run on one side,
   and the stretch around the copy ends in the same way q words on. So a progression of any length gives two candidates
   for q, the distances of the left ends and of the right ends, beside that of its first occurrence; then it is left by
   one jump.
5. Each candidate is extended to both sides by comparing hashes of doubling lengths (two residues of 31 bits), and what
   is found is compared word by word. Of two periods of one stretch the smaller is kept; any two runs that differ are
   different stretches, as a stretch of three periods fixes its least period.

One text is handled in one task, with about 100 bytes of memory a word. Null and empty texts have no words and no runs.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import free_name, kept_columns, ship, table

MIN_LENGTH = 24
MIN_PERIODS = 3
#: Words that are worked on together; a longer text is worked on alone.
WORDS_AT_ONCE = 400_000
_BASE = 3  # blocks of 8 words serve all periods below 8
_MODS = (2147483647, 2147483629)
_FACTORS = (1103515245, 1664525)


class SuffixOrder:
    """Positions in the order of their suffixes, without those whose first 2**_BASE words occur nowhere else.

    ``order``: the positions; ``place``: of each position in it, or -1; ``depth``: at each place the least k for which
    the suffix differs from the one before within 2**k words.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        first = np.argsort(words, kind="stable").astype(np.int64)
        depth = np.full(n, 127, np.int8)
        rank = np.zeros(n, np.int64)
        new = np.ones(n, bool)
        if n:
            new[1:] = words[first[1:]] != words[first[:-1]]
        depth[new] = 0
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[first] = start + 1  # 0 is the rank of what lies behind the end
        order, at = first, np.arange(n)
        k, width = 0, 1
        single = np.append(new[1:], True) & new
        self.alone = None
        while True:
            active = ~single
            order, at = order[active], at[active]  # suffixes that share their first `width` words with another
            if k == _BASE:
                self.alone = len(order)
                kept_places = at
            if not len(order):
                break
            follow = order + width
            after = np.where(follow < n, rank[np.minimum(follow, n - 1)], 0)
            group = rank[order]
            by = np.lexsort([after, group])
            order, after, group = order[by], after[by], group[by]
            new = np.ones(len(order), bool)
            new[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
            old = np.ones(len(order), bool)
            old[1:] = group[1:] != group[:-1]
            k, width = k + 1, width * 2
            depth[at[new & ~old]] = k
            first[at] = order
            rank[order] = at[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] + 1
            single = np.append(new[1:], True) & new
        if self.alone is None:
            kept_places = np.zeros(0, np.int64)
        # Places whose suffixes are not alone at 2**_BASE words; groups of such places stay whole and in order.
        self.order = first[kept_places]
        self.depth = np.minimum(depth[kept_places], 126)
        self.depth[:1] = 0
        self.place = np.full(n, -1, np.int64)
        self.place[self.order] = np.arange(len(self.order))

    def ranges(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) for every place: the range of the suffixes that share its first 2**k words, for k >= _BASE."""
        n = len(self.order)
        new = self.depth <= k
        places = np.arange(n)
        low = np.maximum.accumulate(np.where(new, places, 0))
        ends = np.append(np.flatnonzero(new)[1:], n)
        return low, ends[np.cumsum(new) - 1] if n else places


class WaveletTree:
    """Numbers in a given order, by their bits from the highest on; answers many range queries at once."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), []
        bits = int(values.max()).bit_length() if self.n else 0
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            zeros_before = np.concatenate([[0], np.cumsum(~ones)])
            self.levels.append((bit, zeros_before, int(zeros_before[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many numbers at the places low..high are smaller."""
        count = np.zeros(len(low), np.int64)
        top = self.levels[0][0] + 1 if self.levels else 0
        over = than >= 1 << top
        whole = high - low
        for bit, zeros, all_zeros in self.levels:
            one = (than >> bit & 1).astype(bool)
            a, b = zeros[low], zeros[high]
            count += np.where(one, b - a, 0)
            low, high = np.where(one, all_zeros + low - a, a), np.where(one, all_zeros + high - b, b)
        return np.where(over, whole, count)

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The number with n smaller ones at the places low..high."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros, all_zeros in self.levels:
            a, b = zeros[low], zeros[high]
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, all_zeros + low - a, a), np.where(one, all_zeros + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest number at the places low..high that is not below `least`; -1 if there is none."""
        n = self.smaller(low, high, least)
        there = n < high - low
        found = np.full(len(low), -1, np.int64)
        if there.any():
            found[there] = self.nth(low[there], high[there], n[there])
        return found


class Extender:
    """How far two places of an array agree to the right and to the left."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        self.sums, self.powers = [], []
        for mod, factor in zip(_MODS, _FACTORS, strict=True):
            powers = np.ones(n + 1, np.uint64)
            have, by = 1, factor
            while have < n + 1:  # powers[have:2 * have] = powers[:have] * factor**have
                more = min(have, n + 1 - have)
                powers[have : have + more] = powers[:more] * np.uint64(by) % np.uint64(mod)
                have, by = have + more, by * by % mod
            parts = (words.astype(np.uint64) + np.uint64(1)) % np.uint64(mod) * powers[:n] % np.uint64(mod)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(parts, out=sums[1:])  # below 2**31 each: no overflow before 2**33 words
            self.sums.append(sums)
            self.powers.append(powers)

    def same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the words i..i+length and j..j+length agree, for i < j."""
        equal = np.ones(len(i), bool)
        for mod, sums, powers in zip(_MODS, self.sums, self.powers, strict=True):
            m = np.uint64(mod)
            a, b = (sums[i + length] - sums[i]) % m, (sums[j + length] - sums[j]) % m
            equal &= a * powers[j - i] % m == b
        return equal

    def _most(self, limit: np.ndarray, agree) -> np.ndarray:
        """The greatest length up to limit for which agree(rows, length) holds, as it holds for all shorter ones."""
        done = np.zeros(len(limit), np.int64)
        step, rows = 1, np.flatnonzero(limit > 0)
        while len(rows):  # lengths double while all agrees
            now = np.minimum(step, limit[rows])
            good = agree(rows, now)
            done[rows[good]] = now[good]
            rows = rows[good & (now < limit[rows])]
            step *= 2
        step = 1 << max(0, int(limit.max(initial=0)).bit_length() - 1)
        while step:
            rows = np.flatnonzero((done + step <= limit) & (step <= np.maximum(done, 1)))
            if len(rows):
                good = agree(rows, done[rows] + step)
                done[rows[good]] += step
            step //= 2
        return done

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on agree, for i < j."""
        return self._most(self.n - j, lambda rows, k: self.same(i[rows], j[rows], k))

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j agree, for i < j."""
        return self._most(i, lambda rows, k: self.same(i[rows] - k, j[rows] - k, k))


def _stretch(extend: Extender, i: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the stretch of period q around i, which holds i..i+q."""
    return i - extend.left(i, i + q), i + q + extend.right(i, i + q)


def _candidates(blocks: np.ndarray, size: int, least: int, most: int, low: np.ndarray, high: np.ndarray, tree: WaveletTree, extend: Extender) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block starts, distances): for each block the periods q, least <= q < most, that its copies allow."""
    i, after = blocks, blocks + least
    while len(i):
        p = tree.successor(low, high, after)
        near = (p >= 0) & (p < i + most)
        i, low, high, p = i[near], low[near], high[near], p[near]
        if not len(i):
            return
        yield i, p - i
        after = p + 1
        following = tree.successor(low, high, after)
        close = np.flatnonzero((following >= 0) & (following - p <= size // 2))
        if len(close):
            d = following[close] - p[close]
            start, end = _stretch(extend, p[close], d)
            own_start, own_end = _stretch(extend, i[close], d)
            yield i[close], start - own_start
            yield i[close], end - own_end
            after[close] = p[close] + (end - size - p[close]) // d * d + 1


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period, of an array of numbers.

    A run is a stretch with least period q, of max(min_length, min_periods * q) words or more, that goes on to neither
    side. min_periods is 3 or more and min_length 24 or more, which the blocks rest on.
    """
    if min_length < 3 << _BASE or min_periods < 3:
        raise ValueError("runs need 24 words and three periods at least")
    none = np.zeros(0, np.int64)
    if len(words) < min_length:
        return none, none, none
    suffixes = SuffixOrder(words)
    if not len(suffixes.order):
        return none, none, none
    tree, extend = WaveletTree(suffixes.order), Extender(words)
    found = []
    k = _BASE
    while 3 << k <= len(words):
        size = 1 << k
        blocks = np.arange(0, len(words) - size + 1, size)
        place = suffixes.place[blocks]
        blocks, place = blocks[place >= 0], place[place >= 0]
        low, high = suffixes.ranges(k)
        low, high = low[place], high[place]
        more = high - low > 1
        for least, most in [(1, size), (size, 2 * size)] if k == _BASE else [(size, 2 * size)]:
            for i, q in _candidates(blocks[more], size, least, most, low[more], high[more], tree, extend):
                fit = (q >= least) & (q < most)
                found.append(np.stack([i[fit], q[fit]]))
        k += 1
    i, q = np.unique(np.concatenate(found, axis=1), axis=1) if found else (none, none)
    start, end = _stretch(extend, i, q)
    long = end - start >= np.maximum(min_length, min_periods * q)
    start, end, q = start[long], end[long], q[long]
    order = np.lexsort([q, end, start])
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(q), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    for s, e, p in zip(start.tolist(), end.tolist(), q.tolist(), strict=True):
        if not np.array_equal(words[s : e - p], words[s + p : e]):
            raise RuntimeError("two hashes of 62 bits are equal by chance; choose other factors")
    order = np.lexsort([q, start])
    return start[order], (end - start)[order], q[order]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words as the contract of op13 changes them: one text in ten goes round from some word on."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def _numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, where each text begins): equal for equal words of one text, different for those of two texts."""
    sizes = np.array([len(w) for w in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = pa.array([w for words in texts for w in words], pa.binary())
    distinct = flat.dictionary_encode()
    codes = distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes + np.repeat(np.arange(len(texts)), sizes) * (len(distinct.dictionary) + 1), starts


def _of_texts(texts: list[list[bytes]]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(words, start, length, period) of each text."""
    numbers, starts = _numbers(texts)
    start, length, period = find_runs(numbers)
    edges = np.searchsorted(start, starts)
    for k, words in enumerate(texts):
        own = slice(edges[k], edges[k + 1])
        yield words, start[own] - starts[k], length[own], period[own]


def _kept(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not len(start):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _strongest(start: list[int], length: list[int], period: list[int]) -> int:
    """The run with the greatest length/period; at equal ones the first start, then the least period."""
    best = 0
    for k in range(1, len(start)):
        if length[k] * period[best] > length[best] * period[k]:
            best = k  # runs come by start and period, so the first of equals stays
    return best


RUN = "struct<start:bigint,length:bigint,period:bigint>"
_SCHEMA = f"n_words bigint, runs array<{RUN}>, strongest int, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, plant_col: str | None = None) -> DataFrame:
    """The kept columns of docs, then n_words, runs (by start and period), strongest and collapsed.

    Words are the stretches between ASCII white space. strongest is the place in runs (from 0) of the run with the
    greatest length/period, null without runs; collapsed has the text's words with each run cut to its first period,
    joined by one space. Rows are judged each by itself, with or without an id. With plant_col, an integer column,
    the texts are first changed by `planted`.
    """
    ship(docs.sparkSession)
    others = kept_columns(docs, ["n_words", "runs", "strongest", "collapsed"], keep)
    text, seed = free_name(docs, "__text"), free_name(docs, "__seed")
    planting = F.col(f"`{plant_col}`").cast("long") if plant_col else F.lit(None).cast("long")

    def of_rows(rest: list[pa.RecordBatch], texts: list[list[bytes]]) -> pa.RecordBatch:
        sizes, runs, strongest, collapsed = [], [], [], []
        for words, *found in _of_texts(texts):
            columns = [c.tolist() for c in found]
            sizes.append(len(words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in zip(*columns, strict=True)])
            strongest.append(_strongest(*columns) if columns[0] else None)
            collapsed.append(b" ".join(_kept(words, *found)))
        made = [pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(strongest, pa.int32()), pa.array(collapsed, pa.binary()).cast(pa.string())]
        kept = pa.Table.from_batches(rest).combine_chunks()
        columns = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in kept.columns]
        return pa.RecordBatch.from_arrays([*columns, *made], [*kept.schema.names, "n_words", "runs", "strongest", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select(range(batch.num_columns - 2))
            seeds, column = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            texts, begin, n = [], 0, 0
            for row in range(batch.num_rows):
                words = planted((column[row].as_py() or "").encode().split(), seeds[row].as_py())
                if texts and n + len(words) > WORDS_AT_ONCE:
                    yield of_rows([rest.slice(begin, len(texts))], texts)
                    texts, begin, n = [], row, 0
                texts.append(words)
                n += len(words)
            if texts:
                yield of_rows([rest.slice(begin, len(texts))], texts)

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others) + _SCHEMA
    inputs = [*[F.col(f"`{f.name}`") for f in others], planting.alias(seed), F.col(f"`{text_col}`").cast("string").alias(text)]
    return docs.select(*inputs).mapInArrow(run, schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of its runs, the strongest of them and digests of the runs and of the collapsed
    text. A null text is empty; a row without an id is left as it is before runs are looked for."""
    found = periodic_runs(table(spark, sf_dir, "documents"), keep=["doc_id"], plant_col="doc_id")
    best = F.get("runs", F.col("strongest"))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * get(runs, strongest).length div get(runs, strongest).period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
