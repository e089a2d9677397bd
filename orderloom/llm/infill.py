"""Fill-in-middle transformation over an indexable skip list (operator 11).

A text is a row of units (code points, words or lines).  A document is cut at
two unit ranks into prefix, middle and suffix, and written in the order
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``) between
marker strings, or left as it is (``plain``).  What to do is drawn from the
SHA-256 of a seed and the document's id alone, so any rerun gives the same.

The place of a rank in the text is found in a skip list: its lowest lane is
the text itself, every lane above holds about one in ``2 ** LANE_BITS`` nodes
of the one below, and every link carries two widths, how many units and how
many code points it skips.  A search goes down the lanes, adding widths as
long as their sum stays within the rank, and walks the few units left in the
text.  One list is built for a slice of documents, every document's head
being in all lanes; the searches of a slice go down together.  Express lanes
need about 3 bytes a byte of text; the lowest is never held whole.

Defined cases: null and empty texts are plain and empty; texts that hold a
marker are plain; a null id is drawn from the seed alone; repeated rows come
out alike; an empty table gives no rows.  The caller's columns, the text
aside, are packed in one struct, so their names may be any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import common as C

LANE_BITS = 3
LANES = 18

# Fixed by the contract: markers and shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20

_CODE_POINT = (np.arange(256) & 0xC0) != 0x80

# Whether a unit starts at a byte, by that byte and the one before it.
UNITS: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
    "code_points": lambda before, b: _CODE_POINT[b],
    # A word with the white space after it.
    "words": lambda before, b: C.SPACE_WORDS[b] & ~C.SPACE_WORDS[before],
    "lines": lambda before, b: before == 10,
}


class SkipList:
    """Ranks of units in the texts of a slice (``data``, ``offsets``)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, units: str = "code_points"):
        self.data, self.offsets, self.rule = data, offsets, UNITS[units]
        heads = np.unique(offsets[:-1][np.diff(offsets) > 0])
        kept, rank0, point0 = [], 0, 0
        for a in range(0, len(data), C.SLICE_BYTES):
            z = min(len(data), a + C.SLICE_BYTES)
            head = heads[np.searchsorted(heads, a):np.searchsorted(heads, z)] - a
            starts = self._starts(a, z)
            starts[head] = True
            point = np.cumsum(_CODE_POINT[data[a:z]])
            at = np.flatnonzero(starts)
            rank = rank0 + np.arange(len(at))
            lane = self._lanes(rank)
            lane[np.searchsorted(at, head)] = LANES
            some = lane > 0
            at_some = at[some]
            kept.append((rank[some], a + at_some, point0 + point[at_some] - 1, lane[some]))
            rank0 += len(at)
            point0 += int(point[-1])
        end = np.array([rank0]), np.array([len(data)]), np.array([point0]), np.array([LANES], np.uint8)
        rank, self.byte, point, lane = (np.concatenate(x) for x in zip(*kept, end, strict=True))
        # Lane 1 first; a lane with heads alone is the top.
        self.units, self.points, self.down = [], [], []
        below, chosen, lanes = None, np.arange(len(rank)), 1
        while True:
            self.units.append(np.append(np.diff(rank[chosen]), np.iinfo(np.int64).max))
            self.points.append(np.append(np.diff(point[chosen]), 0))
            self.down.append(None if below is None else np.searchsorted(below, chosen))
            if lane[chosen].min() >= LANES:
                break
            lanes += 1
            below, chosen = chosen, np.flatnonzero(lane >= lanes)
        # The node at which each document starts, and the slice's end.
        first = np.searchsorted(self.byte, offsets)
        self.head = np.searchsorted(chosen, first)
        self.size = np.diff(rank[first])

    def _starts(self, a: int, z: int) -> np.ndarray:
        before = np.empty(z - a, np.uint8)
        before[1:] = self.data[a:z - 1]
        if z > a:
            before[0] = self.data[a - 1] if a else 0
        return self.rule(before, self.data[a:z])

    @staticmethod
    def _lanes(rank: np.ndarray) -> np.ndarray:
        """The highest lane of each unit: drawn by hash, a lane's share of the
        one below is 1 / 2 ** LANE_BITS."""
        x = C.mix(rank.astype(C.U64) + C.U64(0x5851F42D4C957F2D))
        lane = np.zeros(len(rank), np.uint8)
        for i in range(1, LANES):
            lane += (x & C.U64((1 << LANE_BITS * i) - 1)) == 0
        return lane

    def find(self, doc: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte (in the slice) and code point (in the document) at which so
        many units of each document end."""
        node, left, points = self.head[doc], rank.astype(np.int64), np.zeros(len(doc), np.int64)
        for units, widths, down in zip(self.units[::-1], self.points[::-1], self.down[::-1], strict=True):
            while True:
                go = units[node] <= left
                if not go.any():
                    break
                left = np.where(go, left - units[node], left)
                points = np.where(go, points + widths[node], points)
                node = node + go
            if down is not None:
                node = down[node]
        byte = self.byte[node]
        for i in np.flatnonzero(left).tolist():
            end = int(self.offsets[doc[i] + 1])
            byte[i], skipped = self._walk(int(byte[i]), end, int(left[i]))
            points[i] += skipped
        return byte, points

    def _walk(self, byte: int, end: int, units: int) -> tuple[int, int]:
        """Go on by some units in the text itself."""
        size = 16 * units + 16
        while True:
            z = min(end, byte + size)
            starts = self._starts(byte, z)
            starts[0] = True
            at = np.flatnonzero(starts)
            if len(at) > units or z == end:
                stop = int(at[units]) if len(at) > units else z - byte
                return byte + stop, int(_CODE_POINT[self.data[byte:byte + stop]].sum())
            size *= 4


def draws(doc_id: int | str | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from the seed and the id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = hashlib.sha256(key.encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", units: str = "code_points",
                seed: int = 1) -> DataFrame:
    """(doc, n, form, prefix_chars, middle_chars, output) for every row.

    ``doc`` is the row without its text, as a struct; ``n`` is the number of
    units; the two lengths are in code points, null if the form is plain.
    """
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([rows.schema["doc"], *T.StructType.fromDDL(
        "n long, form string, prefix_chars long, middle_chars long, output string").fields])
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = C.text_buffers(b.column(1))
            ids = b.column(0).field(id_col).to_pylist()
            sizes, forms, prefixes, middles, outputs = [], [], [], [], []
            for i, j in C.slices(off):
                part, at = data[off[i]:off[j]], (off[i:j + 1] - off[i])
                found = SkipList(part, at, units)
                raw, edges, size = part.tobytes(), at.tolist(), found.size.tolist()
                drawn = [draws(x, seed) for x in ids[i:j]]
                cuts = np.array([sorted((h[0] % (n + 1), h[1] % (n + 1))) for h, n in zip(drawn, size, strict=True)])
                doc = np.repeat(np.arange(j - i), 2)
                byte, point = found.find(doc, cuts.ravel())
                for d, (h, (x, y), (px, py)) in enumerate(zip(
                        drawn, byte.reshape(-1, 2).tolist(), point.reshape(-1, 2).tolist(), strict=True)):
                    text = raw[edges[d]:edges[d + 1]]
                    if not text or p in text or s in text or m in text or h[2] % 100 >= PLAIN_FROM:
                        row = "plain", None, None, text
                    else:
                        prefix, middle, suffix = raw[edges[d]:x], raw[x:y], raw[y:edges[d + 1]]
                        row = (("spm", px, py - px, s + suffix + p + prefix + m + middle) if h[3] % 100 < SPM_BELOW
                               else ("psm", px, py - px, p + prefix + s + suffix + m + middle))
                    for out, value in zip((forms, prefixes, middles, outputs), row, strict=True):
                        out.append(value)
                sizes += size
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
                 pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``transformed`` got, from its output and form."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark, C.BATCH_BYTES)
    docs = C.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return transformed(docs).select(
        F.col("doc.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {"op11_infill": op11_infill}

ORACLES = {"op11_infill": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h
  FROM documents),
d AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS e
  FROM t),
f AS (
  SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
                 WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form,
         substr(text, 1, least(a, b)) AS p, substr(text, least(a, b) + 1, abs(a - b)) AS m,
         substr(text, greatest(a, b) + 1) AS s
  FROM d)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
"""}
