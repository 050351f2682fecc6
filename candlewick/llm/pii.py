"""Personal data: spans fixed by patterns, and further ones chosen by boosted trees.

Generators with high recall propose spans that may overlap: e-mail addresses also with the signs written out,
runs of 7 to 15 digits with or without separators, digit groups of the lengths of card numbers, dotted numbers. A candidate that a
pattern below accepts is kept as it is. The others are scored by gradient-boosted trees on their format and on
the words around them; one whose calibrated chance reaches the threshold of its kind is added unless it overlaps a
span that stands already.

The trees learn from all of the corpus' own candidates. A candidate that a pattern accepts is an example of its kind, and so are
copies of it written in other ways (without the plus, with other separators, with the signs in words); so are a few data made
by rule, that no kind is without any. Other candidates are counter-examples, as are copies with a changed digit, a cut and a
version-like form; but one that is accepted once its signs and separators are put right is left out, as nobody knows what it is.
Candidates of one kind and label weigh together as much as BALANCE rows at most, so a kind that is rare among many plain
numbers keeps its say. A third, by a hash of the span, is kept back to calibrate the chances and to set each kind's threshold
for the stated precision; a kind that does not reach it there gets the threshold FALLBACK.

Examples are counted by their features, which are small numbers, in Spark. Cuts, gradients and thresholds are sums over these
counts. The sums are exact, so it is the same whether the driver adds a table of up to HELD_ROWS distinct examples or, beyond
that, the tasks do, in a job per level of a tree.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import boosting
from candlewick.llm.common import free_name, kept_columns, ship, slices, stored, table, text_once

# The kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
BALANCE = 2_500
HELD_ROWS = 100_000
PRECISION = 0.99
CONTEXT = 32
FALLBACK = 0.9

_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# a start inside a run of digits succeeds only if the run's first digit does
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d) * (1 + at % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the patterns accept, by kind and start; in code points, end exclusive."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _only_digits(m.group()) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_only_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


_GENERATORS: dict[str, re.Pattern] = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\bat\b)\s?[A-Za-z0-9-]{1,63}"
        r"(?:\s?(?:\.|\(dot\)|\[dot\]|\bdot\b)\s?[A-Za-z0-9-]{1,63}){1,4}",
        re.IGNORECASE,
    ),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\s?[.·]\s?[0-9]{1,4}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ ._/-]{0,2}[0-9]{2,6}){2,4}(?![0-9])"),
    # 7 to 15 digits however they are grouped; else short groups
    "phone": re.compile(
        r"(?<![0-9A-Za-z])(?:(?:\+ ?)?\(?[0-9](?:[ ./()-]{0,3}[0-9]){6,14}\)?(?![0-9A-Za-z])(?![./-][0-9])"
        r"|(?:\+|00)?[ ]?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){1,4}(?![0-9A-Za-z]))"
    ),
}
# every match of the e-mail generator has one of these
_SPELT = re.compile(r"@|\(at\)|\[at\]|\bat\b", re.IGNORECASE)
# Words that announce a kind, in the languages of common forms.
_CUES = {
    "email": ("mail", "email", "contact", "courriel", "correo"),
    "ip": ("ip", "host", "address", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "telefon", "móvil"),
}
_WORD = re.compile(r"[^\W\d_]+")


def features(kind: str, span: str, before: str, after: str) -> list[float]:
    """Format of the span, then its surroundings."""
    digits = _only_digits(span)
    groups = re.findall("[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    words = [w.lower() for w in _WORD.findall(before)[-4:]]
    octets = len(groups) == 4 and all(int(g) <= 255 for g in groups)
    spelt = span.lower()
    return [
        *[float(kind == k) for k in KINDS],
        float(len(span)),
        float(len(digits)),
        float(letters),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(span.count(".")),
        float(span.count("-")),
        float(span.count(" ")),
        float(span.startswith(("+", "00"))),
        float("(" in span and ")" in span),
        float("@" in span),
        float(bool(re.search(r"\(at\)|\[at\]| at ", spelt))),
        float(bool(re.search(r"\(dot\)|\[dot\]| dot ", spelt))),
        float(16 <= len(digits) <= 19 and luhn(digits)),
        float(octets),
        float(len(set(digits))),
        float(len(groups) > 1 and len(set(map(len, groups))) == 1),
        float(any(w.startswith(_CUES[kind]) for w in words)),
        float(any(w in ("version", "v", "page", "no", "chapter", "section", "license") for w in words)),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(bool(re.match(r"[.,]?[0-9]", after)) or bool(re.search(r"[0-9][.,-]?$", before))),
        float(before[-1:] in ("$", "€", "#", "=", '"', "'")),
        float(bool(re.search(r"\.(?:\s|$)", span))),  # as at the end of a sentence
    ]


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the generators propose; a start may be proposed for several kinds."""
    digit = bool(_DIGIT.search(text))
    out = []
    for kind, pattern in _GENERATORS.items():
        if _SPELT.search(text) if kind == "email" else digit:
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


class _Overlaps:
    """Whether a span overlaps one of some spans, by their starts and the greatest end so far."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _ in spans]
        self.ends = list(accumulate((e for _, e in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def put_right(kind: str, span: str) -> bool:
    """Whether the span is a datum of its kind once its signs and separators are those of the patterns."""
    digits = _only_digits(span)
    if kind == "email":
        plain = re.sub(r"\s?(?:\(dot\)|\[dot\]|\bdot\b|\.)\s?", ".", span, flags=re.IGNORECASE)
        plain = re.sub(r"\s?(?:\(at\)|\[at\]|\bat\b|@)\s?", "@", plain, count=1, flags=re.IGNORECASE)
    elif kind == "ip":
        plain = re.sub(r"\s?[.·]\s?", ".", span)
    elif kind == "card":
        plain = digits
    else:
        plain = "+" + digits.lstrip("0") if span.lstrip("( ").startswith("0") or "(" in span else ""
    return any(k == kind and (s, e) == (0, len(plain)) for k, s, e in base_spans(plain))


def _around(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]


def examples(text: str) -> list[tuple[int, str, str, str, str, bool]]:
    """(start, kind, span, before, after, accepted) of the candidates and base spans of a text."""
    base = base_spans(text)
    rows = [(s, k, text[s:e], *_around(text, s, e), True) for k, s, e in base]
    known = {kind: _Overlaps([(s, e) for k, s, e in base if k == kind]) for kind in KINDS}
    for kind, start, end in candidates(text):
        if not known[kind](start, end) and not put_right(kind, text[start:end]):
            rows.append((start, kind, text[start:end], *_around(text, start, end), False))
    return rows


def _other_forms(kind: str, span: str) -> tuple[list[str], list[str]]:
    """The same datum written otherwise, and look-alikes that are none."""
    dice = zlib.crc32(span.encode())
    digits = _only_digits(span)
    if kind == "email":
        name, _, domain = span.partition("@")
        right = [f"{name} at {domain.replace('.', ' dot ')}", f"{name} at {domain}", f"{name}(at){domain}", f"{name} [at] {domain.replace('.', '[dot]')}"]
        return right, [f"{name}@{domain.split('.')[0]}", f"{name} at {domain.split('.')[0]}."]
    if kind == "ip":
        parts = span.split(".")
        big = [str(int(p) + 256 + dice % 444) if i == 2 else p for i, p in enumerate(parts)]
        return [" . ".join(parts), "·".join(parts)], [".".join(big), ".".join(parts[:3])]
    if kind == "card":
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + dice % 9) % 10)
        return [".".join(four), "  ".join(four), "/".join(four)], [wrong, ".".join([*four[:-1], wrong[-4:]]), digits[:9]]
    bare = span.lstrip("+")
    right = [f"00{bare}", bare if "(" in bare else f"({digits[:3]}) {digits[3:6]}-{digits[6:]}"]
    right += [f"0{digits[2:]}", f"0{digits[2:4]} {digits[4:]}", f"0{digits[2:4]}/{digits[4:]}"]
    return right, [digits[:4], f"{digits[:2]}.{digits[2:4]}", digits]


class Detector:
    """The trained trees with a threshold for each kind."""

    def __init__(self, model: boosting.Boosted | None, thresholds: dict[str, float]):
        self.model, self.thresholds = model, thresholds

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates that the trees select and that overlap nothing selected before, likeliest first."""
        if self.model is None:
            return []
        stands = _Overlaps([(s, e) for _, s, e in base])
        spans = [(k, s, e) for k, s, e in candidates(text) if not stands(s, e)]
        if not spans:
            return []
        x = np.array([features(k, text[s:e], *_around(text, s, e)) for k, s, e in spans])
        chance = self.model.chance(x)
        out, starts, ends = [], [], []  # ends and starts of what is selected, which does not overlap, in order
        for i in sorted(range(len(spans)), key=lambda i: (-chance[i], spans[i])):
            kind, start, end = spans[i]
            at = bisect_left(starts, end)
            if chance[i] >= self.thresholds[kind] and not (at and ends[at - 1] > start):
                out.append((kind, start, end))
                starts.insert(at, start)
                ends.insert(at, end)
        return out

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """(base spans, all spans), by kind and start."""
        base = base_spans(text)
        extra = self.added(text, base)
        return base, sorted([*base, *extra], key=lambda x: (KINDS.index(x[0]), x[1]))


def made_by_rule(seed: int = 7, each: int = 40) -> list[tuple[str, str, str, str, bool]]:
    """Data of each kind that no corpus has, with words around them."""
    pick = np.random.default_rng(seed)
    digits = lambda n: "".join(map(str, pick.integers(0, 10, n)))
    letters = lambda n: "".join(chr(97 + int(x)) for x in pick.integers(0, 26, n))
    word = lambda: letters(int(pick.integers(2, 9)))
    rows = []
    for _ in range(each):
        name = word() if pick.random() < 0.5 else f"{word()}.{word()}"
        domain = f"{word()}.{letters(int(pick.integers(2, 4)))}"
        card = "4" + digits(14)
        card += next(str(d) for d in range(10) if luhn(card + str(d)))
        data = {
            "email": f"{name}@{domain if pick.random() < 0.5 else f'{word()}.{domain}'}",
            "ip": ".".join(str(int(x)) for x in pick.integers(1, 255, 4)),
            "card": card,
            "phone": f"+{pick.integers(1, 99)} {digits(3)} {digits(3)} {digits(4)}",
        }
        rows += [(kind, span, f"{word()} {word()} ", f" {word()} {word()}", True) for kind, span in data.items()]
    return rows


# the greatest value of a feature that is told apart
_TOP = 255
_FEATURES = len(features("email", "", "", ""))
# margins are told apart by a 64th, between -MARGIN and MARGIN
_MARGIN, _STEPS = 30, 64
_PLACES = 2 * _MARGIN * _STEPS + 1


def _lessons(kind: str, span: str, before: str, after: str, accepted: bool) -> Iterator[tuple[str, str, bool]]:
    """(kind, span, label) of a candidate and of its copies."""
    yield kind, span, accepted
    if accepted:
        right, wrong = _other_forms(kind, span)
        yield from ((kind, s, True) for s in right)
        yield from ((kind, s, False) for s in wrong)
        # what another kind's generator would make of these forms is none of that kind
        for form in (*right, *wrong):
            yield from ((other, form, False) for other in KINDS if other != kind and _GENERATORS[other].fullmatch(form))


def _counted(rows: Iterable[tuple[str, str, str, str, bool]], made: bool = False) -> list[tuple[int, int, bool, bytes, int, int]]:
    """(group, label, kept back, features, times, candidates among these) of (kind, span, before, after, accepted). A group is
    a kind and label of candidates; what is made by rule is in group -1."""
    counts: dict[tuple[int, int, bool, bytes], list[int]] = {}
    for kind, span, before, after, accepted in rows:
        group = -1 if made else 2 * KINDS.index(kind) + accepted
        for nth, (k, s, label) in enumerate(_lessons(kind, span, before, after, accepted)):
            back = int(hashlib.md5(s.encode()).hexdigest(), 16) % 3 == 0
            small = bytes(int(min(f, _TOP)) for f in features(k, s, before, after))
            n = counts.setdefault((group, int(label), back, small), [0, 0])
            n[0] += 1
            n[1] += nth == 0
    return [(*key, *n) for key, n in counts.items()]


def _rows_of(group: np.ndarray, label: np.ndarray, small: list[bytes], times: np.ndarray, weights: dict[int, float]) -> boosting.Rows:
    x = np.frombuffer(b"".join(small), np.uint8).reshape(-1, _FEATURES).astype(float)
    return boosting.Rows(x, label.astype(float), np.array([weights[g] for g in group.tolist()]), times.astype(float))


def _of_table(batch: pa.Table | pa.RecordBatch, weights: dict[int, float]) -> boosting.Rows:
    group, label, small, times = (batch.column(c) for c in ("group", "label", "features", "times"))
    return _rows_of(group.to_numpy(), label.to_numpy(), small.to_pylist(), times.to_numpy(), weights)


def _value_sums(rows: boosting.Rows) -> np.ndarray:
    """The weight of each value of each feature, then of the rows with label 1."""
    weight = boosting.exact(np.ones(len(rows.y)), rows.weight, rows.times)
    places = rows.x.astype(np.int64) + np.arange(_FEATURES) * (_TOP + 1)
    sums = np.bincount(places.ravel(), np.repeat(weight, _FEATURES), _FEATURES * (_TOP + 1))
    return np.append(sums, (weight * rows.y).sum())


def _margin_sums(rows: boosting.Rows, model: boosting.Boosted) -> np.ndarray:
    """The weight by kind, label and place of the margin."""
    margin = np.clip(rows.margin_of(model), -_MARGIN, _MARGIN)
    place = np.floor((margin + _MARGIN) * _STEPS).astype(np.int64)
    kind = rows.x[:, : len(KINDS)].argmax(axis=1)
    weight = boosting.exact(np.ones(len(rows.y)), rows.weight, rows.times)
    at = (kind * 2 + rows.y.astype(np.int64)) * _PLACES + place
    return np.bincount(at, weight, 2 * len(KINDS) * _PLACES).reshape(len(KINDS), 2, _PLACES)


def _learn(added: Callable, precision: float) -> Detector:
    """A detector from sums alone: added(back, make) adds make(rows) over the rows that are kept back or over the others."""
    sums = added(False, _value_sums)
    values, right = sums[:-1].reshape(_FEATURES, _TOP + 1), sums[-1]
    whole = values[0].sum()
    share = right / whole if whole else 0.5
    model = boosting.Boosted([], boosting.base_of(share))
    if 0 < right < whole:
        cuts = [boosting.cuts_of(np.flatnonzero(v).astype(float), v[v > 0]) for v in values]
        model = boosting.grow(lambda *at: added(False, partial(_level_sums, at=at, cuts=cuts)), cuts, model.base)
    found = added(True, partial(_margin_sums, model=model))
    edge = np.broadcast_to(np.arange(_PLACES) / _STEPS - _MARGIN, found.shape)
    label = np.broadcast_to(np.array([[0.0], [1.0]]), found.shape)
    here = found > 0
    model = boosting.calibrate_margins(model, edge[here], label[here], found[here])
    limits = {}
    for at, kind in enumerate(KINDS):
        some = here[at]
        # the lower end of a place: what is selected there is all that was counted there
        chance = model.chance_of(edge[at][some])
        limits[kind] = boosting.threshold_for(chance, label[at][some], precision, weight=found[at][some], halfway=True)
    return Detector(model, {k: limit if limit <= 1 else FALLBACK for k, limit in limits.items()})


def _level_sums(rows: boosting.Rows, at: tuple, cuts: list[np.ndarray]) -> np.ndarray:
    return boosting.level_sums(rows, *at, cuts)


def _weights(own: dict[int, int], balance: int) -> dict[int, float]:
    return {-1: 1.0, **{group: min(1.0, balance / n) for group, n in own.items() if n}}


_NOTHING = dict.fromkeys(KINDS, 1.1)


def _learn_held(counts: pa.Table, balance: int, precision: float) -> Detector:
    """Learn from the counts of _counted, here."""
    own = counts.group_by("group").aggregate([("own", "sum")]).to_pydict()
    weights = _weights({g: n for g, n in zip(own["group"], own["own_sum"], strict=True) if g >= 0}, balance)
    rows = {back: _of_table(counts.filter(pc.equal(counts["back"], back)), weights) for back in (False, True)}
    return _learn(lambda back, make: make(rows[back]), precision)


def _learn_spread(counts: DataFrame, balance: int, precision: float) -> Detector:
    """The same with the counts left where they are: a job adds the sums of its tasks, place by place."""
    own = counts.where("group >= 0").groupBy("group").agg(F.sum("own").alias("own"))
    weights = _weights({r.group: r.own for r in own.collect()}, balance)

    def added(back: bool, make: Callable) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = sum(make(_of_table(batch, weights)).ravel() for batch in batches)
            at = np.flatnonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(np.atleast_1d(whole)[at], pa.float64())], ["at", "sum"])

        out = np.zeros(make(_of_table(_EMPTY, weights)).shape)
        parts = counts.where(F.col("back") == back).mapInArrow(run, "at bigint, sum double")
        found = parts.groupBy("at").agg(F.sum("sum").alias("sum")).toArrow()
        np.put(out, found["at"].to_numpy(), found["sum"].to_numpy())
        return out

    return _learn(added, precision)


_COUNTS = "group int, label int, back boolean, features binary, times bigint, own bigint"
_TYPES = [pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.int64()]


def _count_table(rows: list[tuple]) -> pa.Table:
    parts = list(zip(*rows, strict=True)) if rows else [()] * len(_TYPES)
    names = [c.split()[0] for c in _COUNTS.split(", ")]
    return pa.table([pa.array(p, t) for p, t in zip(parts, _TYPES, strict=True)], names)


_EMPTY = _count_table([])


def fit_detector(rows: list[tuple[str, str, str, str, bool]], precision: float = PRECISION, balance: int = BALANCE) -> Detector:
    """Learn from (kind, span, before, after, accepted)."""
    if not rows:
        return Detector(None, _NOTHING)
    return _learn_held(_count_table(_counted(rows) + _counted(made_by_rule(), made=True)), balance, precision)


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_candidates: int | None = None, held_rows: int = HELD_ROWS
) -> Detector:
    """Learn from all candidates of a corpus. ``sample_candidates`` is what they weigh together at most (a kind and label
    BALANCE without it); none is left out. The driver gets sums, and the counts of distinct examples if there are
    ``held_rows`` at most. ``id_col`` is not read."""
    ship(docs.sparkSession)
    balance = BALANCE if sample_candidates is None else max(1, sample_candidates // (2 * len(KINDS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                rows = (e[1:] for text in part.column(0).to_pylist() if text for e in examples(text))
                yield from _count_table(_counted(rows)).to_batches()

    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, _COUNTS)
    key = ["group", "label", "back", "features"]
    counts = stored(docs.sparkSession, found.groupBy(*key).agg(F.sum("times").alias("times"), F.sum("own").alias("own")))
    made = _counted(made_by_rule(), made=True)
    distinct = counts.count()
    if not distinct:
        return Detector(None, _NOTHING)
    if distinct <= held_rows:
        return _learn_held(pa.concat_tables([counts.toArrow().cast(_EMPTY.schema), _count_table(made)]), balance, PRECISION)
    return _learn_spread(counts.unionByName(docs.sparkSession.createDataFrame(made, _COUNTS)), balance, PRECISION)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _mapped(docs: DataFrame, detector: Detector, make: Callable, added: str, types: list, text_col: str, others: list) -> DataFrame:
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(detector)
    names = [part.split()[0] for part in added.split(", ")]
    columns, text = text_once(docs, others, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in slices(batch, text):
                made = [make(known, t) for t in part.column(text).to_pylist()]
                arrays = [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(others)], *arrays], [*part.schema.names[: len(others)], *names])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others) + added
    return docs.select(*columns).mapInArrow(run, schema)


def find(docs: DataFrame, detector: Detector, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs, then n_email, n_ip, n_card, n_phone (base spans), base_spans and spans.

    Spans read kind:start:end in code points, joined by commas, by kind and start. A null text counts as empty.
    """

    def make(known: Detector, text: str | None):
        base, spans = known.spans(text or "")
        return (*[sum(k == kind for k, _, _ in base) for kind in KINDS], _joined(base), _joined(spans))

    added = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, spans string"
    types = [pa.int64()] * 4 + [pa.string()] * 2
    others = kept_columns(docs, [part.split()[0] for part in added.split(", ")], keep)
    return _mapped(docs, detector, make, added, types, text_col, others)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; spans that overlap become one, named by the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, detector: Detector, text_col: str = "text") -> DataFrame:
    """docs with the spans of the text column replaced; a null text stays null."""

    def make(known: Detector, text: str | None):
        return (None if text is None else redacted(text, known.spans(text)[1]),)

    clean = free_name(docs, "__clean")
    others = kept_columns(docs, [clean, text_col], None)  # the old text does not come back
    out = _mapped(docs, detector, make, f"{clean} string", [pa.string()], text_col, others)
    return out.select(*[F.col(clean if c == text_col else f"`{c}`").alias(c) for c in docs.columns])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(docs), keep=["doc_id"])
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )
