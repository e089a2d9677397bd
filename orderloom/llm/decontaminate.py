"""Benchmark decontamination by a broadcast set of n-grams (operator 6).

The test items are normalised (A-Z lower-cased, words of letters, digits and
non-ASCII characters) into windows of ``WINDOW`` words; an item of fewer
words is one window.  Their hashes are broadcast; every training text is
scanned once with rolling hashes, each hit is verified on the words
themselves, and hit words are marked, so that spans or documents can go.

The items are the stated query set: parts of about ``PART_BYTES`` of item
text are broadcast one after the other, however many items there are.  The
runs of hit words of all parts are merged by row before byte spans are taken
from them, so the number of parts changes nothing; only row numbers and hits
are shuffled for that, and the texts once.

Defined cases: a null or empty text has no words and no hits; null or empty
items have no windows and count nowhere; repeated items are one item, items of
one id and different texts are one id of the list with the windows of all, a
null item_id hits words but is no id of the list; repeated documents are
scanned each.  Columns of the documents may have any name; of those that
``scan`` keeps, one named like an added column is replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import common as C

WINDOW = 10
PART_BYTES = 8 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _normal(data: bytes, start, end) -> bytes:
    """The words of some ranges, lower-cased, separated by one space."""
    return b" ".join(data[s:e].translate(_LOWER) for s, e in zip(start, end, strict=True))


def _rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    p = C.prefix_hashes(hashes)
    at = np.arange(max(0, len(hashes) - width + 1))
    return C.mix(C.range_hashes(p, at, at + width) + C.U64(width))


@dataclass
class Windows:
    """Windows of some items: by width, sorted hashes and, for each hash, the
    windows with it as (normalised words, item positions)."""

    items: list
    hashes: dict[int, np.ndarray]
    members: dict[int, dict[int, list[tuple[bytes, list[int]]]]]

    @classmethod
    def of(cls, items: list[tuple], window: int) -> Windows:
        found: dict[int, dict[int, dict[bytes, list[int]]]] = {}
        for k, (_, text) in enumerate(items):
            raw = (text or "").encode()
            data = np.frombuffer(raw, np.uint8)
            start, end, _ = C.words(data, np.array([0, len(data)]), C.ALNUM_WORDS)
            if not len(start):
                continue
            width = min(window, len(start))
            rolled = _rolling(C.word_hashes(data, start, end), width)
            for i, h in enumerate(rolled.tolist()):
                words = _normal(raw, start[i:i + width], end[i:i + width])
                owners = found.setdefault(width, {}).setdefault(h, {}).setdefault(words, [])
                if not owners or owners[-1] != k:
                    owners.append(k)
        return cls([i for i, _ in items], {w: np.array(sorted(hs), np.uint64) for w, hs in found.items()},
                   {w: {h: list(m.items()) for h, m in hs.items()} for w, hs in found.items()})

    def scan(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, set]]:
        """For each text of a slice: words, their start and end, which of
        them are hit, and the positions of the items found."""
        start, end, first = C.words(data, off, C.ALNUM_WORDS)
        h = C.word_hashes(data, start, end)
        raw = data.tobytes()
        hit = np.zeros(len(h), bool)
        items: dict[int, set] = {}
        for width, known in self.hashes.items():
            rolled = _rolling(h, width)
            at = np.searchsorted(known, rolled)
            at[at == len(known)] = 0
            for i in np.flatnonzero(known[at] == rolled).tolist():
                doc = int(np.searchsorted(first, i, "right")) - 1
                if i + width > first[doc + 1]:
                    continue  # reaches into the next text
                words = _normal(raw, start[i:i + width], end[i:i + width])
                for own, owners in self.members[width][int(rolled[i])]:
                    if own == words:
                        hit[i:i + width] = True
                        items.setdefault(doc, set()).update(owners)
        for d in range(len(off) - 1):
            a, b = first[d], first[d + 1]
            yield int(b - a), start[a:b] - off[d], end[a:b] - off[d], hit[a:b], items.get(d, set())


def _parts(items: DataFrame) -> int:
    """How many parts of at most about ``PART_BYTES`` the items make."""
    size = items.agg(F.sum(F.coalesce(F.octet_length("t"), F.lit(0)) + 32)).first()[0] or 0
    return max(1, -(-int(size) * 5 // (PART_BYTES * 4)))


def _items(rows: DataFrame, part: int, parts: int) -> list[tuple]:
    if parts > 1:
        rows = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
    return sorted(((r["i"], r["t"]) for r in rows.collect()), key=lambda r: (str(r[0]), r[1] or ""))


# A run of hit words: their positions, and the bytes from the first to the last.
RUN = ("start", "end", "first_byte", "end_byte")
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in RUN]))


def _scan_part(docs: DataFrame, windows: Windows, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` columns with n_words, runs and items (ids as strings)."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)  # of PART_BYTES of items at most
    at = docs.columns.index(text_col)
    keep_at = [docs.columns.index(c) for c in keep]
    schema = T.StructType([*[docs.schema.fields[i] for i in keep_at],
                           T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in RUN]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            data, off = C.text_buffers(b.column(at))
            count, runs, items = [], [], []
            for i, j in C.slices(off):
                for n, start, end, hit, found in w.scan(data[off[i]:off[j]], off[i:j + 1] - off[i]):
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                    count.append(n)
                    runs.append([dict(zip(RUN, (a, z, int(start[a]), int(end[z - 1])), strict=True))
                                 for a, z in edge.reshape(-1, 2).tolist()])
                    items.append(sorted({str(w.items[k]) for k in found if w.items[k] is not None}))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in keep_at], pa.array(count, pa.int64()), pa.array(runs, runs_type),
                 pa.array(items, pa.list_(pa.string()))], names=schema.names)

    return docs.mapInArrow(run, schema)


def _found(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int, text_col: str, item_id: str,
           item_text: str) -> DataFrame:
    """``keep`` columns of ``docs`` (its columns set apart) with n_words, runs
    (merged over all items) and items (sorted ids)."""
    listed = benchmark.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{item_text}`").alias("t")).distinct()
    parts = _parts(listed)
    if parts == 1:
        return _scan_part(docs, Windows.of(_items(listed, 0, 1), window), keep, text_col)
    # One pass over the texts for each part; rows meet by their number.
    rows = C.stored(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    found = None
    for p in range(parts):
        one = _scan_part(rows, Windows.of(_items(listed, p, parts), window), ["row"], text_col)
        found = one if found is None else found.union(one.where(F.size("runs") > 0))
    merged = found.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return rows.select("row", *keep).join(merged.withColumn("runs", _union_runs("runs")), "row").drop("row")


def _union_runs(col: str) -> Column:
    """Sorted runs of a column with overlapping and touching ones merged."""
    return F.expr(f"""aggregate(array_sort({col}), slice({col}, 1, 0),
        (a, x) -> if(size(a) > 0 and element_at(a, -1).end >= x.start,
            concat(slice(a, 1, size(a) - 1), array(named_struct(
                'start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end),
                'first_byte', element_at(a, -1).first_byte,
                'end_byte', greatest(element_at(a, -1).end_byte, x.end_byte)))),
            concat(a, array(x))))""")


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", prefix: str = "") -> DataFrame:
    """``keep`` columns of every row with n_words, n_hit, items (sorted ids),
    and spans (byte ranges of hit runs of words), each named with the prefix."""
    own, names = C.apart(docs)
    kept = {c: names[c] for c in keep}
    found = _found(own, benchmark, list(kept.values()), window, names[text_col], item_id, item_text)
    return C.with_added(found, kept, {
        f"{prefix}n_words": F.col("n_words"),
        f"{prefix}n_hit": F.aggregate("runs", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]),
        f"{prefix}items": F.col("items"),
        f"{prefix}spans": F.transform("runs", lambda x: F.struct(x["first_byte"].alias("start"),
                                                                 x["end_byte"].alias("end")))})


def without_hits(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text",
                 window: int = WINDOW, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without contaminated rows (``remove="documents"``) or with the
    hit spans cut out of their texts (``remove="spans"``)."""
    own, names = C.apart(docs)
    found = _found(own, benchmark, own.columns, window, names[text_col], item_id, item_text)
    if remove == "documents":
        return C.with_added(found.where(F.size("runs") == 0), names, {})
    text = F.col(names[text_col])
    raw = text.cast("binary")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("runs", lambda r: r["end_byte"]))
    starts = F.concat(F.transform("runs", lambda r: r["first_byte"]), F.array(F.octet_length(raw).cast("long")))
    left = F.concat_ws("", F.transform(F.arrays_zip(ends.alias("e"), starts.alias("s")), lambda p: F.substring(
        raw, p["e"].cast("int") + 1, (p["s"] - p["e"]).cast("int")).cast("string")))
    cut = found.withColumn(names[text_col], F.when(F.size("runs") > 0, left).otherwise(text))
    return C.with_added(cut, names, {})


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark)
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, C.read_table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {"op6_decontaminate": op6_decontaminate}

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLES = {"op6_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS width,
         unnest(list_transform(generate_series(1, greatest(1, len(ws) - {WINDOW - 1})),
                               lambda i: array_to_string(ws[i:i + {WINDOW - 1}], ' '))) AS win
  FROM b WHERE len(ws) > 0),
widths AS (SELECT DISTINCT width FROM bw),
pos AS (
  SELECT doc_id, width, ws, unnest(generate_series(1, len(ws) - width + 1)) AS i
  FROM d, widths WHERE len(ws) >= width),
hit AS (
  SELECT p.doc_id, p.i, p.width, bw.item_id
  FROM (SELECT doc_id, width, i, array_to_string(ws[i:i + width - 1], ' ') AS win FROM pos) p
  JOIN bw ON p.win = bw.win AND p.width = bw.width),
hw AS (SELECT doc_id, count(DISTINCT w) AS n FROM (
  SELECT doc_id, unnest(generate_series(i, i + width - 1)) AS w FROM (SELECT DISTINCT doc_id, i, width FROM hit))
  GROUP BY doc_id),
hi AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(hw.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hi.n, 0) AS BIGINT) AS n_items, sha256(coalesce(hi.ids, '')) AS items_sha256,
       coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""}
