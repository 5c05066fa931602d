"""What the operators of this subpackage share: texts as flat byte arrays, words, keys of columns."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.session import staged

__all__ = ["SLICE_BYTES", "WORD", "drop_folder", "fresh", "hash_share", "hashed_words", "key128", "map_arrow", "mix64", "read_table", "staged", "texts", "with_library", "words"]

#: Texts are worked on in runs of whole rows of about this many bytes, which keeps the arrays small.
SLICE_BYTES = 1 << 19
#: Bytes of a batch that goes to a Python worker; Spark's default is eight times as much.
BATCH_BYTES = 8 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

#: True for bytes of a word; white space is 0x20 and 0x09 to 0x0D.
WORD = np.ones(256, bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_folder(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a staged frame that nothing reads any more."""
    jvm = spark._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def with_library(df: DataFrame) -> DataFrame:
    """The frame as it is; this library gets on the path of the Python workers where it is not installed."""
    context = df.sparkSession.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return df


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` over small batches, with this library on the path of the Python workers.

    The bound of a batch is a setting of the session; it is only ever lowered here.
    """
    conf = df.sparkSession.conf
    number, unit = re.match(r"(\d+)([kmg]?)", conf.get(_BATCH_KEY).lower()).groups()
    if int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        conf.set(_BATCH_KEY, f"{BATCH_BYTES}b")
    return with_library(df).mapInArrow(function, schema)


def texts(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: first row, end row, their bytes, and the bounds of each row in these (null: empty)."""
    flat = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    n = len(flat)
    if not n:
        return
    _, offsets, data = flat.buffers()
    bounds = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        end = min(end, n)
        yield at, end, raw[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


def words(raw: np.ndarray, bounds: np.ndarray, inside: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of ``inside`` bytes that no row bound cuts, and the first word of each row."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    is_in = inside[raw]
    opens = is_in.copy()
    opens[1:] &= ~is_in[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    opens[heads] = is_in[heads]
    closes = is_in.copy()
    closes[:-1] &= ~is_in[1:]
    tails = heads[1:] - 1
    closes[tails] = is_in[tails]
    closes[-1] = is_in[-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (public splitmix64 constants), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def hashed_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: a polynomial over random letters, from one running sum for all spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_LETTERS[raw] * _powers(_BASE, len(raw)), dtype=np.uint64, out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


def hash_share(share: float, *columns: Column) -> Column:
    """True for about this share of all values of the columns, the same ones in every run."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(F.lit(0xD1CE), *columns) < F.lit(int((share - 0.5) * (1 << 64)))


def key128(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes; together a key whose chance collisions can be neglected at 10^13 rows."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(0x5EED), *columns)]
