"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write a table once into the folder that all executors share and read it back.

    It cuts the lineage: a lost executor costs the tasks that ran on it, not the steps before.
    """
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_candlewick_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="candlewick-"), "candlewick.zip")
    with open(path, "wb") as out:
        out.write(buffer.getvalue())
    context.addPyFile(path)
    context._candlewick_shipped = True


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file; a path is taken as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not have, however it is written."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def kept_columns(df: DataFrame, added: list[str], keep: list[str] | None) -> list[T.StructField]:
    """The fields of df that stay beside added ones; a column with the name of an added one gives way."""
    names = {n.lower() for n in added}
    return [f for f in df.schema if f.name.lower() not in names and (keep is None or f.name in keep)]


def text_once(df: DataFrame, others: list[T.StructField], text_col: str) -> tuple[list, int]:
    """(the kept columns, with the text as a string among them or else behind them; the place of the text), so that a
    text that is kept goes to Python once."""
    columns = [F.col(f"`{f.name}`") for f in others]
    for place, f in enumerate(others):
        if f.name.lower() == text_col.lower() and isinstance(f.dataType, T.StringType):
            return columns, place
    return [*columns, F.col(f"`{text_col}`").cast("string").alias(free_name(df, "__text"))], len(columns)


# White space as Python's split and pattern s take it, in the notation of Arrow's patterns.
_BEYOND_ASCII = r"\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD_SPACE = f"[{_BEYOND_ASCII}]"
TWO_SPACES = f"[\\t-\\r {_BEYOND_ASCII}]{{2}}"

SLICE_BYTES = 2 << 20
SLICE_ROWS = 2048


def slices(batch: pa.RecordBatch, text: int, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most so many rows, and so many bytes of text but for a single longer one."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    low = 0
    while low < batch.num_rows:
        before = int(ends[low - 1]) if low else 0
        high = int(np.searchsorted(ends, before + most_bytes, side="right"))
        high = min(max(high, low + 1), low + most_rows, batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def coded_stretches(texts: pa.Array, separator: str | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct stretches, codes, edges): texts cut at ASCII white space, or at each separator. Text k has the stretches
    numbered codes[edges[k]:edges[k + 1]]; at the ends and between separators they may be empty. Null counts as empty.

    Cutting and numbering are done by Arrow.
    """
    texts = pc.fill_null(texts, "")
    cut = pc.ascii_split_whitespace(texts) if separator is None else pc.split_pattern(texts, separator)
    edges = cut.offsets.to_numpy().astype(np.int64)
    coded = cut.values.slice(int(edges[0]), int(edges[-1] - edges[0])).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), edges - edges[0]


def stretches(texts: pa.Array, separator: str | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The same, so that Python sees each distinct stretch once."""
    distinct, codes, edges = coded_stretches(texts, separator)
    return distinct.to_pylist(), codes, edges


def joined(parts: list[bytes], codes: np.ndarray, edges: np.ndarray, separator: bytes = b"") -> pa.Array:
    """Of each text the parts that its codes name, one after the other."""
    taken = pa.array(parts, pa.binary()).take(pa.array(codes))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), taken), separator)


_HELD: dict[str, object] = {}


def held(key: str, make: Callable[[], object]):
    """What a Python worker keeps from task to task of a stage. A worker serves other stages later: what it kept for
    another one goes first, and its memory back to the system."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass
        _HELD[key] = make()
    return _HELD[key]


#: Longer keys are not remembered: a memory bounded in entries is bounded in bytes as well.
LONGEST_REMEMBERED = 64


class Recent:
    """A dict of bounded size that forgets what was not asked for in a while (two generations)."""

    def __init__(self, size: int):
        self.half, self.new, self.old = max(1, size // 2), {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) > LONGEST_REMEMBERED:
            return
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Remembered(dict):
    """key -> make(key), made when first asked for; bounded like Recent. Look-ups of known keys stay in C."""

    def __init__(self, size: int, make, longest: int = LONGEST_REMEMBERED):
        super().__init__()
        self.half, self.make, self.longest, self.old = max(1, size // 2), make, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > self.longest:
            return value
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
