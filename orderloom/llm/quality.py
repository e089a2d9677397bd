"""Quality classifier from compressed sizes (operator 3).

Two zstandard dictionaries are trained, one on good and one on bad labelled
text.  A text is cut into pieces of ``PIECE_BYTES`` and every piece is
compressed on its own with either dictionary.  The normalised difference of
the two sizes, summed over the whole text, is calibrated into a probability
by a logistic curve fitted on labelled rows.  The curve also sees how far the
text compresses at all and how short it is, since the same difference says
less of a few words or of one word repeated.

Fitting reads a bounded sample of labelled rows: ``SAMPLE_ROWS`` of each
label, those with the smallest hash of their id, of which at most
``SAMPLE_BYTES`` of text, evenly spread pieces, are used for each document.
Of documents that share a sampled id the text of least hash is learnt from.
Scoring covers every byte of every text.

Defined cases: a null text counts as empty; an empty text has difference 0
and shortness 1; rows with a null doc_id are scored, never learnt
from; a label that is null or neither 0 nor 1 is not learnt from; doc_ids
that repeat in the label table count once for each label row; with fewer
than two kinds of labels every score is the share of good labels (0.5
without labels).  Extra columns are kept, also those called score or text_;
the caller names the output columns.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import common as C

PIECE_BYTES = 1024
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 8 * PIECE_BYTES
DICTIONARY_BYTES = 256 * 1024
LEVEL = 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries (bytes) and the curve's weights, the constant last."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float, float]

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of the good label for rows of features."""
        z = features @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


class _Sizes:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.coders = []
        for d in (good, bad):
            zd = zstd.ZstdCompressionDict(d)
            zd.precompute_compress(level=LEVEL)
            self.coders.append(zstd.ZstdCompressor(level=LEVEL, dict_data=zd, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False))

    def features(self, text: bytes) -> tuple[float, float, float]:
        """(bad - good) / (bad + good), (bad + good) / bytes, shortness."""
        good = bad = 0
        for i in range(0, len(text), PIECE_BYTES):
            piece = text[i:i + PIECE_BYTES]
            good += len(self.coders[0].compress(piece))
            bad += len(self.coders[1].compress(piece))
        short = 1.0 / (1.0 + len(text) / 64.0)
        return ((bad - good) / (bad + good), (bad + good) / len(text), short) if text else (0.0, 0.0, short)


def _pieces(text: bytes) -> list[bytes]:
    """Pieces of one document for fitting, evenly spread, within the bound."""
    starts = range(0, len(text), PIECE_BYTES)
    step = max(1, -(-len(starts) * PIECE_BYTES // SAMPLE_BYTES))
    return [text[i:i + PIECE_BYTES] for i in starts[::step]]


def _dictionary(texts: list[list[bytes]]) -> bytes:
    pieces = [p for t in texts for p in t if p]
    random.Random(7).shuffle(pieces)
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, pieces)) // 8))
    try:
        return zstd.train_dictionary(size, pieces, k=64, d=8).as_bytes()
    except zstd.ZstdError:  # too few pieces to train on: their text is the dictionary
        return b"".join(pieces)[:size] or b"no text"


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the features, the constant last, by ridge Newton steps."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + 1e-2 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    w[:-1] /= scale
    w[-1] -= float(w[:-1] @ mean)
    return w


def _sampled_ids(labelled: DataFrame, label: int, n: int) -> DataFrame:
    """Ids of ``SAMPLE_ROWS`` rows of a label, the smallest hashes first.

    A threshold on the hash leaves about twice as many before the sort.
    """
    unit = F.pmod(F.xxhash64(F.lit("quality"), "_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = labelled.where(F.col("_y") == label).withColumn("_u", unit)
    if n > 2 * SAMPLE_ROWS:
        rows = rows.where(F.col("_u") < 2.0 * SAMPLE_ROWS / n)
    return rows.orderBy("_u", "_id").limit(SAMPLE_ROWS).select("_id", "_y")


def _fit_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, text hash and bounded pieces of each sampled document."""
    for b in batches:
        data, off = C.text_buffers(b.column(2))
        out = [_pieces(data[off[i]:off[i + 1]].tobytes()) for i in range(len(off) - 1)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.binary()))],
                                         names=["_id", "_hash", "pieces"])
    C.release_memory()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> QualityModel:
    """Fit on labelled rows (join of ``docs`` and ``labels`` on the id)."""
    known = (labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_y"))
             .where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull()))
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    samples: dict[int, list[list[bytes]]] = {0: [], 1: []}
    if len(counts) == 2:
        ids = _sampled_ids(known, 0, counts[0]).union(_sampled_ids(known, 1, counts[1]))
        texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
        # At most 2 * SAMPLE_ROWS ids: broadcast, so that no text is shuffled.
        rows = texts.join(F.broadcast(ids.select("_id").distinct()), "_id").select(
            "_id", F.xxhash64("_text").alias("_hash"), "_text")
        schema = T.StructType([rows.schema["_id"], rows.schema["_hash"],
                               T.StructField("pieces", T.ArrayType(T.BinaryType()))])
        one = rows.mapInArrow(_fit_texts, schema).groupBy("_id").agg(F.min_by("pieces", "_hash").alias("pieces"))
        rows = one.join(F.broadcast(ids), "_id").select(F.col("_y").alias("y"), "pieces").collect()
        for r in sorted(rows, key=lambda r: b"".join(r["pieces"])):
            samples[r["y"]].append([bytes(p) for p in r["pieces"]])
        for s in samples.values():
            random.Random(11).shuffle(s)
    if not all(any(s) for s in samples.values()):
        p = min(max(share, 1e-6), 1 - 1e-6)
        return QualityModel(b"no text", b"no text", (0.0, 0.0, 0.0, float(np.log(p / (1 - p)))))
    # Half of the sample makes the dictionaries, the other half the curve.
    dicts = {y: _dictionary(s[::2] if len(s) > 1 else s) for y, s in samples.items()}
    sizes = _Sizes(dicts[1], dicts[0])
    x: list[tuple[float, float, float]] = []
    y: list[int] = []
    weight = {}
    for label, texts in samples.items():
        held = texts[1::2] or texts
        weight[label] = counts[label] / len(held)
        for t in held:
            x.append(sizes.features(b"".join(t)))
            y.append(label)
    w = _logistic(np.array(x, float), np.array(y, float))
    # The sample holds the labels in other proportions than the table.
    w[-1] += float(np.log(weight[1] / weight[0]))
    return QualityModel(dicts[1], dicts[0], tuple(map(float, w)))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in ``out_col``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of a fixed size
    schema = T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sizes = _Sizes(m.good, m.bad)
        for b in batches:
            data, off = C.text_buffers(b.column(at))
            x = np.array([sizes.features(data[off[i]:off[i + 1]].tobytes()) for i in range(len(off) - 1)],
                         float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.score(x), pa.float64())],
                                             names=[*b.schema.names, out_col])
        C.release_memory()

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_tables(spark: SparkSession, sf_dir: str) -> QualityModel:
    """The model of a folder's documents and labels, without held-out rows."""
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = C.read_table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out())
    return fit(docs, labels)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark)
    model = fit_tables(spark, sf_dir)
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op3_quality": op3_quality}
ORACLES: dict[str, str] = {}  # compression has no SQL form
