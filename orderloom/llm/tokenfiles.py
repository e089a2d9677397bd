"""Token ids in wavelet-matrix files (operator 9).

Documents are range-partitioned and sorted by id, encoded in Python tasks
and written as shards of about ``SHARD_TOKENS`` ids, each shard one
compressed wavelet-matrix file (``wavelet``).  The files are the rows of a
Parquet table under the shared folder: Spark's commit makes a retried task
replace its own files, and any store that Spark writes to will do.

The encoder gives the ids of the tokenizers library.  A text is cut where
the byte-level pre-tokenizer always ends a piece (before a white space that
follows a word, before the last space of a run, before punctuation after an
ASCII letter), and each distinct piece, told from others by its bytes, is
encoded once by a worker.  Texts with other white space than ASCII's are encoded whole.

Defined cases: null and empty texts are the end id alone; null ids come
first; rows with equal ids are in order of a hash of their text, equal rows
are each written; an empty table has no shards.  Ids must be integers.  Other
columns are not written.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm import common as C
from orderloom.llm.wavelet import WaveletMatrix
from orderloom.session import scratch_path

SHARD_TOKENS = 1 << 20
# Bytes of text encoded at once.
ENCODE_BYTES = 4 << 20
# A worker forgets its pieces beyond this many ids; they are encoded again.
CACHE_IDS = 8 << 20
END_ID = 0  # fixed by the contract
TOKENIZER = "byte_bpe_50k.json"

_SPACE = ~C.SPACE_WORDS
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b",.;:!?")] = True
# First bytes of white space outside ASCII, and separators that some count.
_ODD = np.zeros(256, bool)
_ODD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_OTHER_SPACE = re.compile("[%s]" % "".join(map(chr, (
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))))


class Encoder:
    """Ids of whole texts, with a cache of pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.bits = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.first = self.size = np.zeros(0, np.int64)
        self.used = 0

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces that are not known yet and keep their ids."""
        encoded = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        ids = [e.ids for e in encoded]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
        first = len(self.flat) + np.cumsum(size) - size
        self.known.update(zip(pieces, range(len(self.first), len(self.first) + len(pieces)), strict=True))
        self.flat, self.first, self.size = (np.concatenate(x) for x in (
            (self.flat, flat), (self.first, first), (self.size, size)))
        self.used = len(self.flat)

    def _starts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each byte."""
        n = len(data)
        space = _SPACE[data]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        heads = off[:-1][np.diff(off) > 0]
        after[heads[1:] - 1] = True
        start = (space & ~before) | ((data == 32) & ~after)
        start[1:] |= _PUNCTUATION[data[1:]] & _LETTER[data[:-1]]
        odd = np.flatnonzero(_ODD[data])
        for d in np.unique(np.searchsorted(off, odd, "right") - 1).tolist():
            if _OTHER_SPACE.search(data[off[d]:off[d + 1]].tobytes().decode()):
                start[off[d]:off[d + 1]] = False
        start[heads] = True
        return start

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, each with the end id, and their counts."""
        if self.used > CACHE_IDS:
            self.forget()
        at = np.flatnonzero(self._starts(data, off)) if len(data) else np.zeros(0, np.int64)
        edges = pa.py_buffer(np.append(at, len(data)).astype(np.int64))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, edges, pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        _, edges, raw = coded.dictionary.buffers()
        edges, raw = np.frombuffer(edges, np.int64)[:len(coded.dictionary) + 1].tolist(), (raw or b"") and raw.to_pybytes()
        listed = [raw[a:z] for a, z in zip(edges[:-1], edges[1:], strict=True)]
        known = self.known
        new = [p for p in listed if p not in known]
        if new:
            self._learn(new)
        index = np.array(list(map(known.__getitem__, listed)), np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        size = self.size[index]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.first[index] - upto[:-1], size) + np.arange(upto[-1])]
        doc_end = upto[np.searchsorted(at, off)]
        return np.insert(ids, doc_end[1:], END_ID), np.diff(doc_end) + 1


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(TOKENIZER))


def write_shards(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, forget: bool = False) -> str:
    """Write all documents in ascending id order; returns the table's path.

    ``forget``: workers, which may serve other stages next, drop their pieces
    at the end of each task (less memory, more time).

    Columns: part, shard (in part), n_ids, file.  (part, shard) is the order
    of the shards.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # Repeated rows are spread over ranges by a drawn number.
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("drawn", F.monotonically_increasing_id())
    arranged = (rows.repartitionByRange("doc_id", "tie", "drawn").sortWithinPartitions("doc_id", "tie")
                .select(F.spark_partition_id().alias("part"), "doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        held = shard = part = 0

        def flush() -> pa.RecordBatch:
            ids, counts, docs_, nulls = (np.concatenate(x) for x in zip(*kept, strict=True))
            file = WaveletMatrix.of(ids, enc.bits, docs_, nulls, counts).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([file], pa.binary())], names=["part", "shard", "n_ids", "file"])

        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(0)[0].as_py()
            nulls = np.asarray(b.column(1).is_null()).astype(np.uint8)
            doc_ids = np.asarray(b.column(1).fill_null(0))
            data, off = C.text_buffers(b.column(2))
            for i, j in C.slices(off, ENCODE_BYTES):
                ids, counts = enc.encode(data[off[i]:off[j]], off[i:j + 1] - off[i])
                kept.append((ids, counts, doc_ids[i:j], nulls[i:j]))
                held += len(ids)
                if held >= SHARD_TOKENS:
                    yield flush()
                    kept, held, shard = [], 0, shard + 1
        if kept:
            yield flush()
        kept = []
        if forget:
            enc.forget()
        C.release_memory()

    # Few shards a file: a reader holds the files of one split at once.
    (arranged.mapInArrow(run, "part int, shard int, n_ids long, file binary")
     .write.option("maxRecordsPerFile", 4).option("compression", "none").parquet(path))
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    table = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, shard, raw in zip(*(b.column(i) for i in range(3)), strict=True):
                w = WaveletMatrix.from_bytes(raw.as_py())
                upto = np.concatenate([[0], np.cumsum(w.counts)])
                ids = memoryview(w.decode().astype("<u4")).cast("B")
                crc = [zlib.crc32(ids[4 * a:4 * z]) for a, z in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
                k = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * k, pa.int32()), pa.array([shard.as_py()] * k, pa.int32()),
                     pa.array(w.doc_ids, pa.int64(), mask=w.doc_nulls.astype(bool)), pa.array(upto[:-1], pa.int64()),
                     pa.array(w.counts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["part", "shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"])
        C.release_memory()

    docs = table.select("part", "shard", "file").mapInArrow(
        run, "part int, shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long")
    # Prefix sums of the parts, then of the shards in each part.
    sizes = table.select("part", "shard", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("shard_start", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
    return docs.join(starts.drop("n_ids"), ["part", "shard"]).select(
        "doc_id", (F.col("part_start") + F.col("shard_start") + F.col("in_shard")).alias("start"),
        "n_tokens", "ids_crc32")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark, C.BATCH_BYTES)
    docs = C.read_table(spark, sf_dir, "documents")
    return read_shards(spark, write_shards(docs, default_tokenizer()))


QUERIES = {"op9_token_files": op9_token_files}
ORACLES: dict[str, str] = {}  # a tokenizer has no SQL form: checked by an exact round trip
