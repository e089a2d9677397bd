"""Removal of repeated passages by suffix sorting (operator 2).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the table.  Whether the window of ``LENGTH`` bytes at a
position repeats is decided in rounds, each of which leaves fewer positions:

1. Every window has an anchor, its ``GRAM`` bytes of least hash; equal
   windows have equal anchors.  Anchors that occur once decide all their
   windows.
2. Windows of an anchor are taken together by ``STEP`` neighbouring
   distances from it.  If the bytes that such windows have in common occur
   once, none repeats; if all bytes of the windows together occur twice
   (compared by two 64-bit hashes), all repeat.
3. What is left is at the borders of repeated passages: the bytes of these
   windows are sent to tasks by their common part, their suffixes are sorted
   by ``suffix.Suffixes`` and neighbours with a common extension of
   ``LENGTH`` bytes are verified on the bytes.

Rows of rounds 1 and 2 are hashes that combine before the shuffle.  Of a
common part with more than ``GROUP`` different surroundings, round 3 counts
the windows by their hashes, combined before the shuffle as well; of each
window that occurs twice the bytes of two places are sorted, split by the
windows' hashes, and what they show holds for all its places.  So no task
holds a whole hot passage.  Texts move only
where they have open windows; ids of such texts are broadcast only below
``BROADCAST_BYTES``.

Defined cases: null counts as empty; texts below ``LENGTH`` bytes keep all;
equal texts (repeated rows too) of ``LENGTH`` bytes or more lose all bytes;
null ids are rows like others; an empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import common as C
from orderloom.llm.suffix import Suffixes

LENGTH = 400  # fixed by the contract
GRAM = 64
STEP = 32
GROUP = 512
BROADCAST_BYTES = 32 << 20
# Suffixes sorted together in a task.
SORTED = 4096

_U = C.U64
_LOW = _U(0xFFFFFFFF)
_CHECK_VALUES = C.mix(C.BYTE_VALUES ^ _U(0x5851F42D4C957F2D))


def window_anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """For the windows that lie in one text of a slice: start, position of
    the anchor, and the hashes of all grams."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    p = C.prefix_hashes(C.BYTE_VALUES[data])
    grams = (p[gram:] - p[:-gram]) * C.POWERS.down[:len(data) - gram + 1]
    grams = C.mix(grams)
    at = np.arange(len(grams), dtype=_U)
    key = (grams & ~_LOW) | at
    width = length - gram + 1
    # Sliding minimum: least of the rest of one block and the start of the next.
    padded = np.concatenate([key, np.full(-len(key) % width, ~_U(0))]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[:n], left[width - 1:width - 1 + n])
    anchor = (least & _LOW).astype(np.int64)
    inside = np.ones(n, bool)
    for e in off[1:].tolist():  # windows that reach into the next text
        inside[max(0, e - length + 1):e] = False
    start = np.flatnonzero(inside)
    return start, anchor[start], grams


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_key, id, text) to row_key, id, n_bytes, sha and anchors."""
    for b in batches:
        data, off = C.text_buffers(b.column(2))
        shas = [hashlib.sha256(data[off[i]:off[i + 1]]).hexdigest() for i in range(len(off) - 1)]
        anchors: list[np.ndarray] = []
        for i, j in C.slices(off):
            o = off[i:j + 1] - off[i]
            start, anchor, grams = window_anchors(data[off[i]:off[j]], o)
            head = C.run_starts(anchor)
            doc = np.searchsorted(start[head], o)
            hashes = grams[anchor[head]].view(np.int64)
            anchors += [hashes[doc[k]:doc[k + 1]] for k in range(j - i)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(np.diff(off), pa.int64()), pa.array(shas, pa.string()),
             pa.array(anchors, pa.list_(pa.int64()))], names=["row_key", "id", "n_bytes", "sha", "anchors"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_key, text, anchors) to a row for each group of windows of a
    repeated anchor: core, two hashes of all bytes, row_key, start, n."""
    for b in batches:
        data, off = C.text_buffers(b.column(1))
        keys = np.asarray(b.column(0))
        for i, j in C.slices(off):
            d, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
            start, anchor, grams = window_anchors(d, o)
            if not len(start):
                continue
            known = pa.concat_arrays([b.column(2)[k].values for k in range(i, j)])
            # An anchor that repeats may be in the set of another text of the slice: no harm.
            open_ = np.isin(grams[anchor].view(np.int64), np.asarray(known))
            start, anchor = start[open_], anchor[open_]
            if not len(start):
                continue
            part = (anchor - start) // STEP
            at = np.arange(len(start))
            head = C.run_starts(anchor, part, start - at)
            tail = np.append(head[1:], len(start))
            lo, hi = start[head], start[tail - 1] + LENGTH
            core = anchor[head] - part[head] * STEP
            p = C.prefix_hashes(C.BYTE_VALUES[d])
            q = C.prefix_hashes(_CHECK_VALUES[d])
            core_hash = C.mix(C.range_hashes(p, core, core + LENGTH - STEP + 1) + part[head].astype(_U))
            size = (hi - lo).astype(_U)
            doc = np.searchsorted(o, lo, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(core_hash.view(np.int64)), pa.array(C.mix(C.range_hashes(p, lo, hi) + size).view(np.int64)),
                 pa.array(C.mix(C.range_hashes(q, lo, hi) + size).view(np.int64)), pa.array(keys[i + doc]),
                 pa.array(lo - o[doc]), pa.array(tail - head)],
                names=["core", "u1", "u2", "row_key", "start", "n"])


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_key, text, open) to a row for each window of the open groups:
    core, parts, two hashes of its bytes, asks, row_key, start."""
    names = ["core", "parts", "u1", "u2", "asks", "row_key", "start"]
    for b in batches:
        data, off = C.text_buffers(b.column(1))
        for k, groups in enumerate(b.column(2).to_pylist()):
            text = data[off[k]:off[k + 1]]
            n = np.array([g["n"] for g in groups])
            u1, u2, start = [], [], []
            for g in groups:
                raw = text[g["start"]:g["start"] + g["n"] - 1 + LENGTH]
                at = np.arange(g["n"])
                for out, values in ((u1, C.BYTE_VALUES), (u2, _CHECK_VALUES)):
                    out.append(C.mix(C.range_hashes(C.prefix_hashes(values[raw]), at, at + LENGTH)))
                start.append(g["start"] + at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([g["core"] for g in groups], np.int64), n)),
                 pa.array(np.repeat(np.array([g["part"] for g in groups], np.int64), n)),
                 pa.array(np.concatenate(u1).view(np.int64)), pa.array(np.concatenate(u2).view(np.int64)),
                 pa.array(np.repeat(np.array([g["asks"] for g in groups], bool), n)),
                 pa.array(np.full(n.sum(), b.column(0)[k].as_py(), np.int64)),
                 pa.array(np.concatenate(start).astype(np.int64))], names=names)


def _border_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_key, text, open) to the bytes of each open group of windows."""
    names = ["core", "part", "asks", "row_key", "start", "mask", "bytes"]
    for b in batches:
        data, off = C.text_buffers(b.column(1))
        out: dict[str, list] = {c: [] for c in names}
        for k, groups in enumerate(b.column(2).to_pylist()):
            text = data[off[k]:off[k + 1]]
            for g in groups:
                lo, n = g["start"], g["n"]
                out["core"].append(g["core"])
                out["part"].append(g["part"])
                out["asks"].append(g["asks"])
                out["row_key"].append(b.column(0)[k].as_py())
                out["start"].append(lo)
                out["mask"].append((1 << n) - 1)
                out["bytes"].append(text[lo:lo + n - 1 + LENGTH].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["core"], pa.int64()), pa.array(out["part"], pa.int64()), pa.array(out["asks"], pa.bool_()),
             pa.array(out["row_key"], pa.int64()), pa.array(out["start"], pa.int64()),
             pa.array(out["mask"], pa.int64()), pa.array(out["bytes"], pa.binary())], names=names)


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (core, part) to (row_key, start, n) of windows that
    asked and repeat."""
    def decide(rows: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
        base = np.cumsum([0] + [len(r[6]) for r in rows[:-1]])
        mask = np.array([r[5] for r in rows], np.int64)
        row, at = np.nonzero(mask[:, None] >> np.arange(STEP) & 1)
        found = Suffixes(data, LENGTH).repeated(base[row] + at)
        found &= np.array([r[2] for r in rows], bool)[row]
        row, at = row[found], at[found]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array([r[3] for r in rows], np.int64)[row]),
             pa.array(np.array([r[4] for r in rows], np.int64)[row] + at),
             pa.array(np.ones(len(row), np.int64))], names=["row_key", "start", "n"])

    for b in C.whole_groups(batches, 2):
        rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
        pending: list[tuple] = []
        suffixes = 0
        for r in rows:
            # A chunk ends where a group ends.
            if suffixes >= SORTED and r[:2] != pending[-1][:2]:
                yield decide(pending)
                pending, suffixes = [], 0
            pending.append(r)
            suffixes += r[5].bit_count()
        yield decide(pending)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sha, text, windows) to sha, n_removed, n_spans, kept_sha256, spans."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        data, off = C.text_buffers(b.column(1))
        removed, count, kept, spans = [], [], [], []
        for k, windows in enumerate(b.column(2).to_pylist()):
            text = data[off[k]:off[k + 1]]
            mark = np.zeros(len(text) + 1, np.int64)
            for w in windows:
                mark[w["start"]] += 1
                mark[w["start"] + w["n"] - 1 + LENGTH] -= 1
            gone = np.cumsum(mark)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).reshape(-1, 2)
            removed.append(int(gone.sum()))
            count.append(len(edge))
            kept.append(hashlib.sha256(text[~gone]).hexdigest())
            spans.append([{"start": int(a), "end": int(z)} for a, z in edge])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.string()),
             pa.array(spans, span)], names=["sha", "n_removed", "n_spans", "kept_sha256", "spans"])


def _with_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns of ``wanted`` (a stored table by row_key) and the text."""
    rows = docs.select(C.row_key(id_col, text_col).alias("row_key"), F.col(f"`{text_col}`").alias("text"))
    listed = [f.name for f in wanted.schema.fields if isinstance(f.dataType, T.ArrayType)]
    size = wanted.agg(F.coalesce(F.sum(F.lit(100) + sum((F.size(c) * 48 for c in listed), F.lit(0))), F.lit(0))).first()[0]
    return rows.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, "row_key")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row;
    spans are the byte ranges to remove."""
    rows = docs.select(C.row_key(id_col, text_col).alias("row_key"), F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_bytes", T.LongType()),
                           T.StructField("sha", T.StringType()), T.StructField("anchors", T.ArrayType(T.LongType()))])
    found = C.stored(rows.mapInArrow(_features, schema), "suffix-features")
    # One row of each text asks; equal texts are decided already.
    texts = C.stored(found.groupBy("sha").agg(F.min("row_key").alias("row_key"), F.count(F.lit(1)).alias("copies")),
                     "suffix-texts")
    anchors = (found.select("row_key", "sha", "anchors").join(texts.select("row_key", "sha"), ["row_key", "sha"])
               .select("row_key", F.explode("anchors").alias("anchor")))
    anchors = C.stored(anchors, "suffix-anchors")
    twice = C.stored(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
                     "suffix-twice")
    wanted = C.stored(anchors.join(twice, "anchor").groupBy("row_key").agg(F.collect_set("anchor").alias("anchors")),
                      "suffix-wanted")
    groups = C.stored(_with_texts(docs, wanted, id_col, text_col).select("row_key", "text", "anchors").mapInArrow(
        _groups, "core long, u1 long, u2 long, row_key long, start long, n long"), "suffix-groups")
    unions = C.stored(groups.groupBy("core", "u1", "u2").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("row_key", "start", "n")).alias("one")), "suffix-unions")
    # Groups whose bytes all repeat.
    whole = groups.join(unions.where("times > 1").select("core", "u1", "u2"), ["core", "u1", "u2"]).select(
        "row_key", "start", "n")
    # Cores in several surroundings, some of which occur once.
    cores = C.stored(unions.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("times").alias("least"))
                     .where("kinds > 1 and least = 1").select(
                         "core", F.ceil(F.col("kinds") / GROUP).cast("int").alias("parts")), "suffix-cores")
    borders = C.stored(unions.join(cores, "core").select(
        "core", F.col("parts").cast("long").alias("part"), (F.col("times") == 1).alias("asks"), "one.*"),
        "suffix-borders")

    def texts_of(groups: DataFrame, name: str) -> DataFrame:
        listed = C.stored(groups.groupBy("row_key").agg(
            F.collect_list(F.struct("core", "part", "asks", "start", "n")).alias("open")), name)
        return _with_texts(docs, listed, id_col, text_col).select("row_key", "text", "open")

    sent = borders.where("part = 1")
    hot = borders.where("part > 1")
    any_hot = not hot.isEmpty()
    if any_hot:
        asking = C.stored(texts_of(hot, "suffix-hot").mapInArrow(
            _window_hashes, "core long, parts long, u1 long, u2 long, asks boolean, row_key long, start long"),
            "suffix-asking")
        # Two places of each window that occurs twice; a row that repeats is one place, with its texts.
        place = F.struct("row_key", "start")
        pairs = C.stored(asking.groupBy("core", "parts", "u1", "u2").agg(
            F.count(F.lit(1)).alias("times"), F.min(place).alias("a"), F.max(place).alias("b")).where("times > 1").select(
                "core", "u1", "u2", F.pmod(F.xxhash64("u1", "u2"), F.col("parts")).alias("part"),
                F.explode(F.array_distinct(F.array("a", "b"))).alias("place")).select(
                    "core", "part", "u1", "u2", "place.*"), "suffix-pairs")
        sent = sent.unionByName(pairs.select("core", "part", F.lit(True).alias("asks"), "row_key", "start",
                                             F.lit(1).cast("long").alias("n")))
    border_bytes = texts_of(sent, "suffix-sent").mapInArrow(
        _border_bytes, "core long, part long, asks boolean, row_key long, start long, mask long, bytes binary")
    edges = (border_bytes.repartition("core", "part").sortWithinPartitions("core", "part")
             .mapInArrow(_sorted_windows, "row_key long, start long, n long"))
    if any_hot:
        edges = C.stored(edges, "suffix-edges")
        same = C.stored(pairs.join(edges, ["row_key", "start"]).select("core", "u1", "u2").distinct(), "suffix-same")
        small = same.count() * 40 <= BROADCAST_BYTES
        edges = edges.union(asking.where("asks").join(F.broadcast(same) if small else same, ["core", "u1", "u2"]).select(
            "row_key", "start", F.lit(1).cast("long").alias("n")))
    windows = C.stored(whole.union(edges).groupBy("row_key").agg(
        F.collect_list(F.struct("start", "n")).alias("windows")), "suffix-windows")
    single = windows.join(texts.where("copies = 1").select("row_key", "sha"), "row_key")
    single = C.stored(single, "suffix-single")
    span = "array<struct<start:long,end:long>>"
    cut = C.stored(_with_texts(docs, single, id_col, text_col).select("sha", "text", "windows").mapInArrow(
        _cut, f"sha string, n_removed long, n_spans long, kept_sha256 string, spans {span}"), "suffix-cut")
    known = C.stored(texts.select("sha", "copies").join(cut, "sha", "left"), "suffix-known")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    out = found.select("id", "n_bytes", "sha").join(known, "sha")
    all_bytes = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return out.select(
        "id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha"))
        .alias("kept_sha256"),
        F.when(gone, all_bytes).otherwise(F.coalesce("spans", F.array().cast(span))).alias("spans"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark)
    return repeated_spans(C.read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLES: dict[str, str] = {}  # byte windows of whole texts are too slow in SQL: checked by brute force
