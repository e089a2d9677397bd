"""Near-duplicate documents by a multi-index Hamming join (operator 5).

Every document's set of word shingles gets a signature of ``CHUNKS`` x
``CHUNK_SYMBOLS`` b-bit minhash symbols (``SYMBOL_BITS`` each).  By the
pigeonhole principle two signatures that differ in at most ``RADIUS``
symbols agree in one chunk but for ``CHUNK_ERRORS`` symbols; each chunk is
therefore indexed once for every choice of symbols left out, and all pairs
within the radius share a key.  (A pair at similarity 0.8 whose signatures
are further apart still shares a key nearly always: it is missed with a
probability of 0.345 ** 8.)  Candidates are confirmed on full shingle sets.

Equal sets are one node, so groups of copies never meet in a bucket.  In a
bucket every node is first compared with the smallest.  Members that are in
different components after that are compared with each other inside a task,
each pair in the first bucket that it shares, if their signatures differ in
at most ``FAR`` symbols (a pair at similarity 0.8 is further apart with a
probability of about one in a million); a task gives back at most as many
links as it has members.

Defined cases: null and empty texts have an empty set, are linked with
nothing and are their own component; a text of fewer words than a shingle
is one shingle; repeated rows are linked as copies; a null doc_id never is
a component's id unless the component has no other.  Other columns, of any
name, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm import common as C
from orderloom.llm.components import connected

CHUNKS = 8
CHUNK_SYMBOLS = 6
CHUNK_ERRORS = 1
SYMBOL_BITS = 16
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
RADIUS = CHUNKS * (CHUNK_ERRORS + 1) - 1
FAR = 24
# Members of a bucket that one task compares with as many others.
GROUP = 512
# Ids of this many bytes at most are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

_U = C.U64
_XOR = C.mix(np.arange(1, SYMBOLS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_MUL = C.mix(_XOR + _U(77)) | _U(1)
_LEFT_OUT = [np.array(x) for x in combinations(range(CHUNK_SYMBOLS), CHUNK_ERRORS)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a slice."""
    start, end, first = C.words(data, offsets, C.SPACE_WORDS)
    h = C.mixed_word_hashes(data, start, end)
    n = max(0, len(h) - width + 1)
    rolled = h[:n].copy()
    for t in range(1, width):
        rolled = C.mix(rolled * _U(0x9FB21C651E98DF25) + h[t:t + n])
    for i in range(len(offsets) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            yield np.unique(rolled[a:b - width + 1])
        elif b > a:
            x = _U(b - a)
            for w in h[a:b]:
                x = C.mix(np.array([x ^ w], _U) * _U(0x9FB21C651E98DF25))[0]
            yield np.array([x], _U)
        else:
            yield h[:0]


def signature(shingles: np.ndarray) -> bytes:
    """``SYMBOLS`` minhash values of which ``SYMBOL_BITS`` bits are kept."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, _U)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, ((shingles[i:i + 4096, None] ^ _XOR) * _MUL).min(axis=0))
    return (C.mix(least) >> _U(64 - SYMBOL_BITS)).astype("<u2").tobytes()


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Index keys of signatures (n x SYMBOLS): one for each chunk and choice
    of symbols left out of it."""
    tagged = C.mix(signatures.astype(_U) + (np.arange(SYMBOLS, dtype=_U) << _U(SYMBOL_BITS)) + _U(1))
    tagged = tagged.reshape(len(signatures), CHUNKS, CHUNK_SYMBOLS)
    whole = tagged.sum(axis=2, dtype=_U)
    keys = [whole - tagged[:, :, out].sum(axis=2, dtype=_U) + _U(j + 1) for j, out in enumerate(_LEFT_OUT)]
    return C.mix(np.concatenate(keys, axis=1) + np.tile(np.arange(CHUNKS, dtype=_U) << _U(56), len(_LEFT_OUT)))


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64), pa.int64())


def features(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(row_key, doc_id, n_shingles, set_a, set_b, sig) of every row."""
    rows = docs.select(C.row_key(id_col, text_col).alias("row_key"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
                           T.StructField("sig", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = C.text_buffers(b.column(2))
            count, ids, sigs = [], [], []
            for i, j in C.slices(off):
                for s in shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], width):
                    count.append(len(s))
                    ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sigs.append(signature(s) if len(s) else None)
            ab = np.frombuffer(b"".join(ids), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(count, pa.int64()), _long(ab[:, 0]), _long(ab[:, 1]),
                 pa.array(sigs, pa.binary())], names=schema.names)
        C.release_memory()

    return rows.mapInArrow(run, schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, slot, node) for every index key of each (node, sig); the slot is
    the key's number of ``chunk_keys``."""
    for b in batches:
        if b.num_rows:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, SYMBOLS)
            keys = chunk_keys(sig)
            node = np.repeat(b.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
            slot = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(sig))
            yield pa.RecordBatch.from_arrays([_long(keys.ravel()), pa.array(slot), pa.array(node, pa.int64())],
                                             names=["key", "slot", "node"])


# For each set of differing symbols of a chunk, the first choice of symbols
# left out that covers it (-1: none).
_COVER = np.array([next((j for j, out in enumerate(_LEFT_OUT) if not m & ~sum(1 << int(k) for k in out)), -1)
                   for m in range(1 << CHUNK_SYMBOLS)], np.int16)


def _first_slots(sig: np.ndarray) -> np.ndarray:
    """The first slot, by chunk, whose key each two signatures share (-1:
    none)."""
    n = len(sig)
    out = np.full((n, n), -1, np.int16)
    for chunk in range(CHUNKS - 1, -1, -1):
        differ = np.zeros((n, n), np.uint8)
        for k in range(CHUNK_SYMBOLS):
            s = sig[:, chunk * CHUNK_SYMBOLS + k]
            differ |= (s[:, None] != s[None, :]).astype(np.uint8) << np.uint8(k)
        cover = _COVER[differ]
        out = np.where(cover >= 0, cover * CHUNKS + chunk, out)
    return out


def _node_sets(docs: DataFrame, nodes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the given nodes, from whole texts."""
    rows = docs.select(C.row_key(id_col, text_col).alias("node"), F.col(f"`{text_col}`").alias("text"))
    small = nodes.count() * 16 <= BROADCAST_BYTES
    rows = rows.join(F.broadcast(nodes) if small else nodes, "node", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = C.text_buffers(b.column(1))
            out = []
            for i, j in C.slices(off):
                out += [s.tobytes() for s in shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], width)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["node", "shingles"])
        C.release_memory()

    return rows.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Pairs (u, v) whose full sets have at least ``percent`` similarity."""
    nodes = C.stored(pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct(),
                     "neardup-nodes")
    sets = C.stored(_node_sets(docs, nodes, width, id_col, text_col), "neardup-sets")
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                p, q = (np.frombuffer(s.as_buffer(), "<u8") for s in (x, y))
                at = np.searchsorted(q, p)
                at[at == len(q)] = 0
                common = int((q[at] == p).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        C.release_memory()

    return both.select("u", "v", "su", "sv").mapInArrow(run, "u long, v long")


def _open_pairs(slot: int, cross: bool, first: int, block: np.ndarray, node: np.ndarray, root: np.ndarray,
                sig: np.ndarray) -> np.ndarray:
    """Which pairs of a bucket's members are to be compared here."""
    n = len(node)
    far = np.zeros((n, n), np.int16)
    for k in range(SYMBOLS):
        far += sig[:, None, k] != sig[None, :, k]
    open_ = np.triu((far <= FAR) & (root[:, None] != root[None, :]), 1)
    open_ &= (node != first)[:, None] & (node != first)[None, :]  # compared already
    if cross:
        open_ &= block[:, None] != block[None, :]
    if open_.any():
        some = np.flatnonzero(open_.any(axis=0) | open_.any(axis=1))
        mine = np.zeros((n, n), bool)
        mine[np.ix_(some, some)] = _first_slots(sig[some]) == slot
        open_ &= mine
    return open_


def _similar(sets: list[np.ndarray], wanted: np.ndarray, percent: int) -> np.ndarray:
    """Which of the wanted pairs of sets have at least ``percent`` similarity;
    intersections are counted over the elements that several sets hold."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[at]
    owner, column = owner[shared[at]], column[shared[at]]
    common = np.zeros(wanted.shape, np.float32)
    for lo in range(0, int(shared.sum()), 4096):
        m = np.zeros((len(sets), 4096), np.float32)
        here = (column >= lo) & (column < lo + 4096)
        m[owner[here], column[here] - lo] = 1
        common += m @ m.T
    common = common.astype(np.int64)
    return wanted & (100 * common >= percent * (size[:, None] + size[None, :] - common))


_BUCKET = ["key", "x", "y", "slot", "first", "block", "node", "root", "sig"]


def _buckets(batches: Iterator[pa.RecordBatch]):
    """Each bucket part of sorted rows with its open pairs."""
    for b in C.whole_groups(batches, 3):
        c = [np.asarray(b.column(i)) for i in range(8)]
        sig = np.frombuffer(b"".join(b.column(8).to_pylist()), "<u2").reshape(-1, SYMBOLS)
        edges = np.append(C.run_starts(*c[:3]), len(sig)).tolist()
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            s = slice(a, z)
            yield b, s, c[6][s], c[7][s], _open_pairs(int(c[3][a]), c[1][a] != c[2][a], int(c[4][a]), c[5][s],
                                                      c[6][s], c[7][s], sig[s])


def _per_node(rows: DataFrame, node: list[str], listed: list[str], more: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``more`` has of each node: a node's rows
    are listed first (one for each bucket part that it is in), so that the
    join meets each node once."""
    lists = rows.groupBy(*node).agg(F.collect_list(F.struct(*listed)).alias("_rows")).join(more, "node")
    return lists.withColumn("_row", F.explode("_rows")).select("*", "_row.*").drop("_rows", "_row")


def _links_apart(members: DataFrame, nodes: DataFrame, roots: DataFrame, docs: DataFrame, width: int, percent: int,
                 id_col: str, text_col: str) -> DataFrame:
    """Links between members of one bucket in different components: enough
    of them to join the components."""
    rooted = members.where("n > 2").join(roots, "node", "left").select(
        "key", "slot", "node", "first", "n", F.coalesce("root", "node").alias("root"))
    open_ = (rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
             .where("a <> b").select("key"))
    # A large bucket is compared in blocks, a task for each two of them.
    blocks = F.ceil(F.col("n") / GROUP).cast("int")
    rooted = _per_node(rooted.join(open_, "key"), ["node", "root"], ["key", "slot", "first", "n"],
                       nodes.select("node", "sig"))
    rooted = (rooted.withColumn("block", F.pmod(F.xxhash64("node", "key"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s, _, _, pairs in _buckets(batches):
            if pairs.any():
                yield b.slice(s.start, s.stop - s.start).filter(pa.array(pairs.any(axis=0) | pairs.any(axis=1)))
        C.release_memory()

    schema = ("key long, x int, y int, slot int, first long, block int, node long, root long, sig binary")
    asks = C.stored(rooted.select(*_BUCKET).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
                    .mapInArrow(asked, schema), "neardup-asks")
    sets = _node_sets(docs, C.stored(asks.select("node").distinct(), "neardup-open"), width, id_col, text_col)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s, node, root, pairs in _buckets(batches):
            found = _similar([np.frombuffer(x.as_buffer(), "<u8") for x in b.column(9)[s]], pairs, percent)
            joined: dict[int, int] = {}

            def top(x: int) -> int:
                while x in joined:
                    x = joined[x]
                return x

            us, vs = [], []
            for i, j in zip(*np.nonzero(found), strict=True):
                p, q = top(int(root[i])), top(int(root[j]))
                if p != q:
                    joined[p] = q
                    us.append(node[i])
                    vs.append(node[j])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
        C.release_memory()

    asks = _per_node(asks, ["node", "root"], [c for c in _BUCKET if c not in ("node", "root", "sig")],
                     sets.join(nodes.select("node", "sig"), "node"))
    return (asks.select(*_BUCKET, "shingles").repartition("key", "x", "y")
            .sortWithinPartitions("key", "x", "y").mapInArrow(compared, "u long, v long"))


def classes(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Features of every row, and (set_a, set_b, root, component_id) of every
    set that is not empty; both are stored tables."""
    found = C.stored(features(docs, width, id_col, text_col), "neardup-features")
    nodes = C.stored(found.where("n_shingles > 0").groupBy("set_a", "set_b").agg(
        F.min("row_key").alias("node"), F.min("doc_id").alias("least_id"), F.first("sig").alias("sig")),
        "neardup-nodes")
    keys = nodes.select("node", "sig").mapInArrow(_keys, "key long, slot int, node long")
    shared = keys.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = C.stored(keys.join(shared, "key"), "neardup-buckets")
    stars = C.stored(members.where("node <> first").select(F.greatest("node", "first").alias("u"), F.least("node", "first").alias("v"))
                     .distinct(), "neardup-stars")
    links = C.stored(confirmed(stars, docs, width, percent, id_col, text_col), "neardup-links")
    roots = C.stored(connected(links), "neardup-roots")
    more = C.stored(_links_apart(members, nodes, roots, docs, width, percent, id_col, text_col), "neardup-more")
    if more.head(1):
        roots = C.stored(connected(links.union(more)), "neardup-roots")
    rooted_nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted_nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return found, C.stored(rooted_nodes.join(least, "root").select("set_a", "set_b", "root", "component_id"),
                           "neardup-classes")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    found, known = classes(docs, width, percent, id_col, text_col)
    out = found.select("doc_id", "n_shingles", "set_a", "set_b").join(known.drop("root"), ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id.

    Rows with an empty set all stay; of rows that are equal in id and text
    one stays.
    """
    found, known = classes(docs, width, percent, id_col, text_col)
    rows = found.join(known, ["set_a", "set_b"], "left")
    chosen = (rows.where("n_shingles > 0").groupBy("root")
              .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("m"))
              .select("m.row_key", F.lit(False).alias("all_stay")))
    empty = found.where("n_shingles = 0").select("row_key", F.lit(True).alias("all_stay"))
    stay = C.stored(chosen.union(empty.distinct()), "neardup-stay")
    # The caller's columns are packed, so that their names may be any.
    packed = docs.select(C.row_key(id_col, text_col).alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    kept = packed.join(stay, "row_key")
    empties, rest = kept.where("all_stay"), kept.where("not all_stay").dropDuplicates(["row_key"])
    return rest.union(empties).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.ready(spark, C.BATCH_BYTES)
    return near_duplicates(C.read_table(spark, sf_dir, "documents"), width=2)


QUERIES = {"op5_near_duplicates": op5_near_duplicates}

# Links on full sets by an inverted index; components by a recursive query.
ORACLES = {"op5_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(regexp_replace(coalesce(text, ''), '[A-Z]+', '\0', 'g'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
low AS (
  SELECT doc_id, list_transform(ws, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws
  FROM w),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws
    ELSE list_sort(list_distinct(list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]))) END AS s
  FROM low),
kinds AS (SELECT min(doc_id) AS k, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
post AS (SELECT k, n, unnest(s) AS x FROM kinds),
inter AS (
  SELECT a.k AS a, b.k AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM post a JOIN post b ON a.x = b.x AND a.k < b.k AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL),
link AS (SELECT a, b FROM inter WHERE 100 * c >= 80 * (na + nb - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT k AS node, k AS seen FROM kinds
  UNION
  SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a),
comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       coalesce(c.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN kinds k ON s.s = k.s LEFT JOIN comp c ON c.node = k.k
"""}
