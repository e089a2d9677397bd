import itertools
import random

import pytest

from orderloom.llm import chat as H


def brute(roles):
    """Least cost over all ways, state by state, of a short conversation."""
    best = {H.START: 0.0}
    for r in roles:
        new = {}
        for a, c in best.items():
            for x, b, cost, _ in H.MOVES[H.normal_role(r)]:
                if x == a:
                    new[b] = min(new.get(b, 1e9), c + cost)
        best = new
    return min(c + H.END_COST[s] for s, c in best.items())


def cost_of(roles, steps):
    """Cost of a repair, checked to be legal."""
    total, state = 0.0, H.START
    for r, (to, how) in zip(roles, steps):
        r = H.normal_role(r)
        name = {v: k for k, v in H.STATE_OF.items()}
        if how == ["merge"]:
            assert to == state != H.START
            total += H.MERGE
        else:
            for x in how:
                assert H.STATE_OF[x] in H._NEXT[state]
                state = H.STATE_OF[x]
                total += H.INSERT
            assert to in H._NEXT[state]
        total += H.relabel_cost(r, name[to])
        state = to
    return total + H.END_COST[state]


def conversations(spark, convs):
    rows = [(c, k, r, f"t{k}", "x") for c, roles in convs for k, r in enumerate(roles)]
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, state string")


def check(spark, convs):
    out = {}
    for r in H.repair(conversations(spark, convs)).collect():
        out.setdefault(r["cid"], []).append((r["chunk"], r["n"], r["state"], r["how"], r["text"]))
    assert len(out) == len(convs)
    for c, roles in convs:
        got = sorted(out["null" if c is None else f"c{c}"])
        assert [g[4] for g in got] == [f"t{k}" for k in range(len(roles))]
        assert cost_of(roles, [(g[2], g[3]) for g in got]) == brute(roles)


@pytest.fixture
def convs():
    rng = random.Random(3)
    names = ["system", "user", "assistant", "User ", "tool", None]
    out = [(i, list(p)) for i, p in enumerate(itertools.product(["system", "user", "assistant"], repeat=3))]
    out += [(100 + i, [rng.choice(names) for _ in range(rng.randrange(1, 40))]) for i in range(40)]
    return [*out, (None, ["assistant", "user"]), (7000, ["user"]), (7001, ["system"])]


def test_repairs_are_cheapest(spark, convs):
    check(spark, convs)


def test_chunks_give_the_same_cost(spark, convs, monkeypatch):
    monkeypatch.setattr(H, "CHUNK", 3)
    check(spark, convs)


def test_least_cost_by_enumeration():
    """The automaton's costs against all sequences of moves written out."""
    for roles in itertools.product(["system", "user", "assistant", "x"], repeat=3):
        m = H.chunk_matrix([H.normal_role(r) for r in roles])
        assert min(m[H.START, s] + H.END_COST[s] for s in range(4)) == brute(roles)


def test_legal_conversations_stay():
    m = H.chunk_matrix(["system", "user", "assistant", "user", "assistant"])
    assert m[H.START, H.ASSISTANT] == 0


def test_rendering(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "Hi"), (1, 1, "user", "there"), (1, 2, "assistant", None), (1, None, "User", "late"),
         (1, None, "User", "late")], "conv_id long, turn int, role string, text string")
    row = H.render_chunks(H.repair(df)).orderBy("chunk").collect()
    assert row[0]["rendered"] == "<|user|>\nHi\nthere\n<|assistant|>\n\n"
    assert row[1]["rendered"] == "<|user|>\nlate\nlate\n" and row[1]["state"] == H.USER
    assert row[0]["n_merged"] == 1 and row[0]["n_turns"] == 3


def test_empty_table(spark):
    assert H.render_chunks(H.repair(conversations(spark, []))).count() == 0


def rendered_alone(rows):
    """One conversation of ordered (role, text), repaired and rendered whole."""
    roles = [H.normal_role(r) for r, _ in rows]
    m = H.chunk_matrix(roles)
    names = {v: k for k, v in H.STATE_OF.items()}
    end = min(range(4), key=lambda s: m[H.START, s] + H.END_COST[s])
    out = ""
    for (_, text), (state, how) in zip(rows, H.trace(roles, H.START, end), strict=True):
        if how == ("merge",):
            out += f"{text or ''}\n"
        else:
            out += "".join(H.TEMPLATE[r].format("") for r in how) + H.TEMPLATE[names[state]].format(text or "")
    return out + {H.USER: H.TEMPLATE["assistant"].format("")}.get(end, "")


def test_chunks_are_bounded_by_position(spark, monkeypatch):
    """Null and repeated turn numbers and null ids: no chunk holds more than
    CHUNK turns, and the tree over many chunks gives the same cost."""
    monkeypatch.setattr(H, "CHUNK", 4)
    monkeypatch.setattr(H, "FAN", 2)
    rng = random.Random(8)
    names = ["system", "user", "assistant", "tool", None]
    rows = [(None, k % 3, rng.choice(names), f"t{k % 7}") for k in range(60)]
    rows += [(1, None, rng.choice(names), "same") for _ in range(50)] + [(1, k, "user", "x") for k in range(9)]
    rows += [(2, 5, "user", "again")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    out = {}
    for r in H.repair(df).collect():
        out.setdefault(r["cid"], {}).setdefault(r["chunk"], []).append(r)
    for c in (None, 1, 2):
        own = sorted(((H.LATE if t is None else t, (r is not None, r or ""), x, r) for i, t, r, x in rows if i == c),
                     key=lambda z: z[:3])
        chunks = out["null" if c is None else f"c{c}"]
        got = [r for k in sorted(chunks) for r in sorted(chunks[k], key=lambda r: r["n"])]
        assert max(map(len, chunks.values())) <= 4
        assert [r["text"] for r in got] == [z[2] for z in own]
        assert {r["closes"] for r in chunks[max(chunks)]} == {True} and {r["total"] for r in got} == {len(own)}
        roles = [z[3] for z in own]
        assert cost_of(roles, [(r["state"], r["how"]) for r in got]) == brute(roles)


def test_short_conversations_are_one_row(spark, tmp_path):
    rows = [(1, 0, "user", "Hi"), (1, 700, "assistant", "yes"), (1, None, "user", "late"), (2, -3, "user", "a"),
            (2, 3, "user", "b"), (None, 0, "user", "c")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r["rendered"] for r in H.op4_chat(spark, str(tmp_path)).collect()}
    assert H.op4_chat(spark, str(tmp_path)).count() == 3
    for c in (1, 2, None):
        assert got[c] == rendered_alone([(r, x) for i, _, r, x in rows if i == c])


def test_one_grain_at_every_length(spark, tmp_path, monkeypatch):
    """Chunks are cut by position alone: a conversation is its rows in order,
    and turns without a number follow the others in the same chunk."""
    monkeypatch.setattr(H, "CHUNK", 4)
    long = [(1, k, ("user", "assistant")[k % 2], f"t{k}") for k in range(9)] + [(1, None, "assistant", "late")]
    short = [(2, 0, "user", "a"), (2, None, "assistant", "b")]
    spark.createDataFrame(long + short, "conv_id long, turn int, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    got = H.op4_chat(spark, str(tmp_path)).orderBy("conv_id", "chunk").collect()
    assert [(r["conv_id"], r["chunk"], r["n_turns"]) for r in got] == [(1, 0, 4), (1, 1, 4), (1, 2, 2), (2, 0, 2)]
    turns = [(r, t) for _, _, r, t in long]
    assert "".join(r["rendered"] for r in got[:3]) == "".join(H.TEMPLATE[r].format(t) for r, t in turns)
