"""Chat formatting by minimum-cost role repair (operator 4).

A legal conversation is an optional ``system`` turn, then ``user`` and
``assistant`` turns in alternation, ``user`` first and ``assistant`` last.
Every turn of a conversation is kept under its role, relabelled, or merged
into the turn before it, and empty turns are inserted where the alternation
needs them; dynamic programming over the automaton of legal turns finds the
cheapest way.  Ties go to the order of ``ACTIONS``.

The cost of a run of turns is a matrix between automaton states, and
matrices compose.  The turns of all conversations are sorted by ranges of
their whole order, in which equal rows are told apart by a drawn number, and
numbered by position: a conversation's rows in earlier ranges, counted, and
the place in its own.  Conversations are cut into chunks of ``CHUNK``
positions, anew where the turns without a number start.  Each chunk's matrix
is built on its own, matrices compose in a tree of ``FAN`` children a node,
borders are solved from its root to its leaves, and each chunk is then
traced between its border states.  So a conversation of any length is
repaired in bounded tasks, however its turns are numbered.

Defined cases: null conv_ids form one conversation; turns are in order of
their number (null numbers last, as number ``2**62``), then role, then text,
null first; repeated rows are turns of their own; null and empty texts are
empty turns; role names are matched without case and outer spaces, unknown
and null roles may become any role at a small cost; an empty table
gives no conversations.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm import common as C

ROLES = ("system", "user", "assistant")
MERGE, INSERT = 1.0, 3.0
# A known role is changed only where merging and inserting cost more.
RELABEL, NAME_UNKNOWN = 6.0, 1.0
CHUNK = 512
FAN = 64
# The number of turns without one, and the chunk that they start.
LATE, LATE_CHUNK = 1 << 62, 1 << 53
# States: what the last legal turn was.
START, SYSTEM, USER, ASSISTANT = range(4)
STATE_OF = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
TEMPLATE = {"system": "<|system|>\n{}\n", "user": "<|user|>\n{}\n", "assistant": "<|assistant|>\n{}\n"}
_INF = float("inf")


def relabel_cost(role: str, name: str) -> float:
    return 0.0 if role == name else RELABEL if role else NAME_UNKNOWN


def _moves(role: str) -> list[tuple[int, int, float, tuple[str, ...]]]:
    """Every way to take one turn of a role: (from, to, cost, inserted roles);
    a merge has ``("merge",)``."""
    names = {v: k for k, v in STATE_OF.items()}
    out = []
    for a in range(4):
        if a != START:
            out.append((a, a, MERGE + relabel_cost(role, names[a]), ("merge",)))
        for b in _NEXT[a]:
            out.append((a, b, relabel_cost(role, names[b]), ()))
            for c in _NEXT[b]:  # one empty turn of b before it
                if b != SYSTEM:
                    out.append((a, c, INSERT + relabel_cost(role, names[c]), (names[b],)))
    return out


MOVES = {r: _moves(r) for r in (*ROLES, "")}
# Ending: a conversation that ends with the user gets an empty assistant turn,
# one that has only a system turn gets both.
END_COST = {START: 0.0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0.0}


def _matrix(role: str) -> np.ndarray:
    m = np.full((4, 4), _INF)
    for a, b, cost, _ in MOVES[role]:
        m[a, b] = min(m[a, b], cost)
    return m


_MATRICES = {r: _matrix(r) for r in MOVES}


def normal_role(role: str | None) -> str:
    r = (role or "").strip().lower()
    return r if r in STATE_OF else ""


def chunk_matrix(roles: list[str]) -> np.ndarray:
    """Least cost of taking the turns from each state to each state."""
    m = np.full((4, 4), _INF)
    np.fill_diagonal(m, 0.0)
    for r in roles:
        m = (m[:, :, None] + _MATRICES[r][None, :, :]).min(axis=1)
    return m


def trace(roles: list[str], start: int, end: int) -> list[tuple[int, tuple[str, ...]]]:
    """For each turn the state after it and what is inserted or merged."""
    best = [np.full(4, _INF)]
    best[0][start] = 0.0
    back: list[dict[int, tuple[int, tuple[str, ...]]]] = []
    for r in roles:
        cost, via = np.full(4, _INF), {}
        for a, b, c, how in MOVES[r]:
            if best[-1][a] + c < cost[b]:
                cost[b], via[b] = best[-1][a] + c, (a, how)
        best.append(cost)
        back.append(via)
    out = []
    state = end
    for via in reversed(back):
        before, how = via[state]
        out.append((state, how))
        state = before
    return out[::-1]


def _chunk_costs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    roles = [normal_role(r) for r in _ordered(table)["role"].to_pylist()]
    return pa.table({"cid": pa.array([key[0].as_py()], pa.string()), "chunk": pa.array([key[1].as_py()], pa.int64()),
                     "turns": pa.array([len(roles)], pa.int64()),
                     "costs": pa.array([chunk_matrix(roles).ravel().tolist()], pa.list_(pa.float64()))})


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("n")


def _places(new: np.ndarray, goes_on: bool, seen: int) -> np.ndarray:
    """The place of each row in its run; the first run may go on from ``seen``
    earlier rows."""
    head = np.flatnonzero(new)
    sizes = np.diff(np.append(head, len(new)))
    k = np.arange(len(new)) - np.repeat(head, sizes)
    if goes_on:
        k[:sizes[0]] += seen
    return k


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (part, cid, late, role, text) of one range with k and place: the
    places among the rows of the range of equal (cid, late) and of equal cid."""
    before = last_late = None
    seen = [0, 0]
    for b in batches:
        if not len(b):
            continue
        late = np.asarray(b.column(2).to_numpy(zero_copy_only=False), bool)
        cid = np.asarray(b.column(1).dictionary_encode().indices)
        same = before == b.column(1)[0].as_py()
        new_cid, new = np.zeros(len(b), bool), np.zeros(len(b), bool)
        new_cid[C.run_starts(cid)] = new[C.run_starts(cid, late)] = True
        k = _places(new, same and last_late == bool(late[0]), seen[0])
        place = _places(new_cid, same, seen[1])
        before, last_late, seen = b.column(1)[-1].as_py(), bool(late[-1]), [int(k[-1]) + 1, int(place[-1]) + 1]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(k, pa.int64()), pa.array(place, pa.int64())],
                                         names=[*b.schema.names, "k", "place"])


def _positions(rows: DataFrame) -> DataFrame:
    """(cid, chunk, n, place, role, text) of (cid, at, role, text)."""
    order = ["cid", "at", "role", "text", "drawn"]
    late = (F.col("at") >= LATE).alias("late")
    ranged = (rows.withColumn("drawn", F.monotonically_increasing_id()).repartitionByRange(*order)
              .sortWithinPartitions(*order))
    numbered = C.stored(ranged.select(F.spark_partition_id().alias("part"), "cid", late, "role", "text").mapInArrow(
        _numbered, "part int, cid string, late boolean, role string, text string, k long, place long"), "chat-numbered")
    # At most one conversation of a range has rows in earlier ones.
    earlier = Window.partitionBy("cid", "late").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier_parts = Window.partitionBy("cid").orderBy("part").rangeBetween(Window.unboundedPreceding, -1)
    base = (numbered.groupBy("cid", "late", "part").agg(F.count(F.lit(1)).alias("rows"))
            .select("cid", "late", "part", F.sum("rows").over(earlier).alias("base"),
                    F.sum("rows").over(earlier_parts).alias("before")).where("base > 0 or before > 0"))
    at = F.coalesce("base", F.lit(0)) + F.col("k")
    return (numbered.join(F.broadcast(base), ["cid", "late", "part"], "left").withColumn("position", at).select(
        "cid", (F.expr(f"position div {CHUNK}") + F.when(F.col("late"), LATE_CHUNK).otherwise(0)).alias("chunk"),
        (F.col("position") % CHUNK).cast("int").alias("n"),
        (F.coalesce("before", F.lit(0)) + F.col("place")).alias("place"), "role", "text"))


def _composed(ms: str) -> Column:
    """The matrix of a run of matrices."""
    one = ", ".join("0D" if i % 5 == 0 else "double('inf')" for i in range(16))
    return F.expr(f"""aggregate({ms}, array({one}), (a, m) -> transform(sequence(0, 15), x -> array_min(transform(
        sequence(0, 3), i -> element_at(a, x - x % 4 + i + 1) + element_at(m.costs, i * 4 + x % 4 + 1)))))""")


def _nodes(level: DataFrame, up: Column | None = None) -> DataFrame:
    """(cid, up, turns, ms): the children of each node in order, at most
    ``FAN``; without ``up`` the nodes of each conversation."""
    up = F.lit(0).cast("long") if up is None else up
    return level.groupBy("cid", up.alias("up")).agg(
        F.sum("turns").alias("turns"), F.array_sort(F.collect_list(F.struct("chunk", "costs"))).alias("ms"))


def _between(nodes: DataFrame, ends: tuple[float, ...] | None = None) -> DataFrame:
    """(cid, chunk, from, to, closes, total) of the children of ``nodes``
    with from, to, closes and total of their own: the shortest path over the
    children's matrices, forward costs by one aggregate over them, then
    states backwards.  ``ends``: the last state is that of least cost with
    the end's, the smaller state first."""
    first = "transform(sequence(0, 3), s -> if(s = from, 0D, double('inf')))"
    forward = F.expr(f"""aggregate(ms, named_struct('v', {first}, 'out', array({first})),
      (a, m) -> transform(array(transform(sequence(0, 3), j -> array_min(transform(sequence(0, 3),
            i -> element_at(a.v, i + 1) + element_at(m.costs, i * 4 + j + 1))))),
          v -> named_struct('v', v, 'out', concat(a.out, array(v))))[0], a -> a.out)""")
    last = F.col("to") if ends is None else F.expr(f"""array_min(transform(sequence(0, 3), s -> named_struct('c',
        element_at(element_at(fwd, -1), s + 1) + element_at(array({", ".join(f"{e}D" for e in ends)}), s + 1), 's', s))).s""")
    back = F.expr("""aggregate(reverse(sequence(1, size(ms))), named_struct('s', last, 'out', array(last)),
      (a, k) -> transform(array(array_min(transform(sequence(0, 3), i -> named_struct(
            'c', element_at(element_at(fwd, k), i + 1) + element_at(ms[k - 1].costs, i * 4 + a.s + 1), 's', i))).s),
          s -> named_struct('s', s, 'out', concat(array(s), a.out)))[0], a -> a.out)""")
    return (nodes.withColumn("fwd", forward).withColumn("last", last).withColumn("states", back)
            .select("cid", F.posexplode("ms").alias("k", "m"), "states", "total",
                    (F.col("closes") & (F.col("k") == F.size("ms") - 1)).alias("closes"))
            .select("cid", F.col("m.chunk").alias("chunk"), F.element_at("states", F.col("k") + 1).alias("from"),
                    F.element_at("states", F.col("k") + 2).alias("to"), "closes", "total"))


def _borders(costs: DataFrame) -> DataFrame:
    """(cid, chunk, from, to, closes, total) of every chunk: its border
    states, whether it ends its conversation, and that one's turns."""
    levels, up = [costs], F.expr(f"chunk div {FAN}")
    while (levels[-1].groupBy("cid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0) > FAN:
        levels.append(C.stored(_nodes(levels[-1], up).select(
            "cid", F.col("up").alias("chunk"), "turns", _composed("ms").alias("costs")), "chat-level"))
    root = _nodes(levels.pop()).withColumns({"from": F.lit(START), "closes": F.lit(True), "total": F.col("turns")})
    borders = C.stored(_between(root, tuple(END_COST[s] for s in range(4))), "chat-borders")
    while levels:
        solved = borders.withColumnRenamed("chunk", "up")
        borders = C.stored(_between(_nodes(levels.pop(), up).join(solved, ["cid", "up"])), "chat-borders")
    return borders


def repair(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(cid, chunk, n, place, state, how, text, closes, total): every turn with
    its place in its conversation and its legal role.

    ``state`` is the automaton state after the turn, ``how`` what was
    inserted before it or that it merges into the turn before; ``closes``
    marks the last chunk of a conversation, ``total`` counts its turns.
    """
    cid = F.coalesce(F.concat(F.lit("c"), F.col(f"`{id_col}`").cast("string")), F.lit("null"))
    at = F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(LATE))
    rows = _positions(conversations.select(cid.alias("cid"), at.alias("at"), F.col(f"`{role_col}`").alias("role"),
                                           F.col(f"`{text_col}`").alias("text")))
    costs = C.stored(rows.groupBy("cid", "chunk").applyInArrow(
        _chunk_costs, "cid string, chunk long, turns long, costs array<double>"), "chat-costs")
    return rows.join(_borders(costs), ["cid", "chunk"]).groupBy("cid", "chunk").applyInArrow(
        _trace_chunk, "cid string, chunk long, n int, place long, state int, how array<string>, text string, "
        "closes boolean, total long")


def _trace_chunk(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = _ordered(table)
    roles = [normal_role(r) for r in table["role"].to_pylist()]
    steps = trace(roles, table["from"][0].as_py(), table["to"][0].as_py())
    k = len(steps)
    return pa.table({
        "cid": pa.array([key[0].as_py()] * k, pa.string()), "chunk": pa.array([key[1].as_py()] * k, pa.int64()),
        "n": pa.array(range(k), pa.int32()), "place": table["place"], "state": pa.array([s for s, _ in steps], pa.int32()),
        "how": pa.array([list(h) for _, h in steps], pa.list_(pa.string())), "text": table["text"].cast(pa.string()),
        "closes": table["closes"], "total": table["total"]})


def render_chunks(turns: DataFrame) -> DataFrame:
    """(cid, chunk, rendered, state, closes, n_turns, n_merged, n_inserted):
    the text of each chunk; a conversation is its chunks in order, and its
    end turns."""
    name = F.element_at(F.array(F.lit(""), *[F.lit(r) for r in ROLES]), F.col("state") + 1)
    merged = F.array_contains("how", "merge")
    text = F.coalesce("text", F.lit(""))
    empty = F.concat(*[F.when(F.array_contains("how", r), F.lit(TEMPLATE[r].format(""))).otherwise("") for r in ROLES])
    piece = F.when(merged, F.concat(text, F.lit("\n"))).otherwise(
        F.concat(empty, F.lit("<|"), name, F.lit("|>\n"), text, F.lit("\n")))
    return turns.groupBy("cid", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", piece.alias("p")))), lambda x: x["p"]), "")
        .alias("rendered"),
        F.max_by("state", "n").alias("state"), F.max("closes").alias("closes"), F.count(F.lit(1)).alias("n_turns"),
        F.sum(merged.cast("long")).alias("n_merged"),
        F.sum(F.when(merged, 0).otherwise(F.size("how")).cast("long")).alias("n_inserted"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each ``CHUNK`` turns of a conversation, cut by place alone
    (chunk: from 0), so at any length a conversation is its rows in order."""
    C.ready(spark)
    turns = repair(C.read_table(spark, sf_dir, "conversations"))
    turns = turns.withColumns({"chunk": F.expr(f"place div {CHUNK}"), "n": F.expr(f"place % {CHUNK}"),
                               "closes": F.col("place") == F.col("total") - 1})
    end = (F.when(F.col("state") == USER, F.lit(TEMPLATE["assistant"].format("")))
           .when(F.col("state") == SYSTEM, F.lit(TEMPLATE["user"].format("") + TEMPLATE["assistant"].format("")))
           .otherwise(""))
    added = F.when(F.col("state") == USER, 1).when(F.col("state") == SYSTEM, 2).otherwise(0)
    return render_chunks(turns).select(
        F.when(F.col("cid") != "null", F.expr("substring(cid, 2)").cast("long")).alias("conv_id"), "chunk",
        F.concat("rendered", F.when(F.col("closes"), end).otherwise("")).alias("rendered"), "n_turns", "n_merged",
        (F.col("n_inserted") + F.when(F.col("closes"), added).otherwise(0)).cast("long").alias("n_inserted"))


QUERIES = {"op4_chat": op4_chat}
ORACLES: dict[str, str] = {}  # a shortest path over an automaton: checked by brute force
