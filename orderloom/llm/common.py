"""Helpers shared by the training-data operators.

Text kernels work on the Arrow buffers of a whole batch with numpy; no
function here holds more than one slice (``SLICE_BYTES`` or one document)
at a time besides the batch itself.
"""

from __future__ import annotations

import ctypes
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import scratch_path

# Rows of one Arrow batch: bounds the text a Python worker holds at once.
BATCH_ROWS = 1000
# Bytes of one Arrow batch; a longer row stands alone.
BATCH_BYTES = 8 << 20
# Bytes of text handled by one round of vector operations.
SLICE_BYTES = 1 << 20

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def ready(spark: SparkSession, batch_bytes: int | None = None) -> SparkSession:
    """Bound the Arrow batches of the Python stages (a session setting), by
    rows and, if asked, by bytes, and let Python workers import this package
    from where the driver found it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if batch_bytes:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    else:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared folder and read it back.

    Cuts lineage with committed files that every executor can read again, so
    a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*cols: str) -> Column:
    """64-bit hash of the given columns, nulls included, as a row identity."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in cols],
                      *[F.col(f"`{c}`").isNull() for c in cols])


def apart(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named by position, and the new name of each, so
    that no column of a caller meets an inner name."""
    names = {c: f"in_{k}" for k, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def with_added(df: DataFrame, names: dict[str, str], added: dict[str, Column]) -> DataFrame:
    """The caller's columns of an ``apart`` table under their own names, then
    ``added``; an added column replaces one of its name."""
    taken = {c.lower() for c in added}
    return df.select(*[F.col(n).alias(c) for c, n in names.items() if c.lower() not in taken],
                     *[v.alias(c) for c, v in added.items()])


# --------------------------------------------------------------- numpy kernels

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(29))
    x = x * U64(0xA0761D6478BD642F)
    return x ^ (x >> U64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xE7037ED1A0B428DB))
_lower = np.arange(256)
_lower[65:91] += 32
LOWER_VALUES = BYTE_VALUES[_lower]


class Powers:
    """Powers of the polynomial base and of its inverse modulo 2**64."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(n, b, U64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))


POWERS = Powers()


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """H with H[i] = sum of values[j] * base**j over j < i (modulo 2**64)."""
    POWERS.grow(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * POWERS.up[:len(values)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end], the same at any position."""
    return (prefix[end] - prefix[start]) * POWERS.down[start]


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    a = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = a.buffers()
    off = np.frombuffer(offsets, np.int64)[a.offset:a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``limit`` bytes; a longer one stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def word_table(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Byte table of word bytes, from inclusive ranges of other bytes."""
    t = np.ones(256, bool)
    for a, b in excluded:
        t[a:b + 1] = False
    return t


# Fixed by the contracts: words are runs of bytes outside these ranges.
SPACE_WORDS = word_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM_WORDS = word_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Start and end byte of every word, and each document's first word.

    ``first`` has one entry more than there are documents.
    """
    w = table[data]
    before = np.zeros(len(w), bool)
    after = np.zeros(len(w), bool)
    if len(w):
        before[1:], after[:-1] = w[:-1], w[1:]
        before[offsets[:-1][offsets[:-1] < len(w)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(w & ~before)
    end = np.flatnonzero(w & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word with A-Z lower-cased."""
    return mix(range_hashes(prefix_hashes(LOWER_VALUES[data]), start, end) + (end - start).astype(U64))


_LONG_WORD = 256
_lower_bytes = np.arange(256, dtype=np.uint8)
_lower_bytes[65:91] += 32
# Masks that keep the first 0 to 8 bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)


def mixed_word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word with A-Z lower-cased, mixed after every eight bytes,
    so that no two texts collide by their structure as they can under a
    polynomial; long words are hashed by BLAKE2."""
    low = np.concatenate([_lower_bytes[data], np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", low, strides=(1,))
    size = end - start
    out = mix(size.astype(U64) + U64(0xD1B54A32D192ED03))
    todo = np.flatnonzero(size <= _LONG_WORD)
    at, left = start[todo], size[todo]
    while len(todo):
        out[todo] = mix((out[todo] ^ (eight[at] & _FIRST_BYTES[np.minimum(left, 8)])) * U64(0x9FB21C651E98DF25))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        digest = hashlib.blake2b(low[start[i]:end[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, "<u8")[0]
    return out


def release_memory() -> None:
    """Give back what a Python worker has freed, so that workers that wait
    for their next task hold little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


# ------------------------------------------------------------ groups in tasks

def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows starts."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, cut anew so that none ends inside a group of
    equal values of the first ``keys`` columns."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        if not len(t):
            continue
        last = int(run_starts(*[np.asarray(t.column(i)) for i in range(keys)])[-1])
        if last:
            yield t.slice(0, last).combine_chunks().to_batches()[0]
        rest = t.slice(last)
    if rest is not None and len(rest):
        yield rest.combine_chunks().to_batches()[0]
