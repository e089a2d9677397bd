import numpy as np
import pytest

from orderloom.llm import vectordup as V


def brute(rows):
    ok = []
    for i, v, k in rows:
        good = v is not None and len(v) > 0 and k is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, np.float64) if good else None)
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = ok[i], ok[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted([(rows[i][0], links[i], least.get(find(i))) for i in range(n)], key=str)


@pytest.fixture
def rows():
    rng = np.random.default_rng(8)
    out = []
    for c in range(30):
        centre = rng.standard_normal(64)
        for _ in range(10):
            noise = rng.choice([0.02, 0.1, 0.15, 0.25])
            out.append([len(out) * 3 + 1, (centre + noise * rng.standard_normal(64)).astype(np.float32).tolist(), c % 4])
    out += [[5000 + i, out[7][1], out[7][2]] for i in range(20)]
    out += [[6000, None, 1], [6001, [0.0] * 64, 1], [6002, [None] + [1.0] * 63, 1], [6003, [float("nan")] * 64, 1],
            [6004, [float("inf")] * 64, 1], [6005, out[0][1], None], [6006, [], 1], [6007, [1.0, 2.0], 1],
            [6008, [2.0, 4.0], 1], [None, out[0][1], out[0][2]], [6009, [-0.0, 1.0], 1], [6010, [0.0, 1.0], 1],
            [6010, [0.0, 1.0], 1]]
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    got = V.near_duplicates(df).collect()
    assert sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in got], key=str) == brute(rows)
    for r in got:
        assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_against_all_pairs(spark, rows):
    check(spark, rows)


def test_hot_filters_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(V, "GROUP", 3)
    check(spark, rows)


def test_empty_table(spark, rows):
    check(spark, [])


def test_list_decoding_is_complete():
    """The best filters of all and no other."""
    code = V.ProductCode(12)
    rng = np.random.default_rng(2)
    for _ in range(3):
        x = rng.standard_normal(12)
        x /= np.sqrt(x @ x)
        parts = (x @ code.turn).reshape(V.BLOCKS, code.width)
        s = np.einsum("bcw,bw->bc", code.codes, parts)
        total = s[0][:, None, None, None] + s[1][:, None, None] + s[2][:, None] + s[3]
        assert code.filters(x).tolist() == sorted(np.argsort(-total.ravel(), kind="stable")[:V.LISTED].tolist())


def test_recall(spark):
    """Pairs near the threshold: nearly all are found."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        a = rng.standard_normal(64)
        a /= np.sqrt(a @ a)
        b = rng.standard_normal(64)
        b -= (a @ b) * a
        b /= np.sqrt(b @ b)
        rows += [[2 * i, a.tolist(), 0], [2 * i + 1, (0.9801 * a + np.sqrt(1 - 0.9801 ** 2) * b).tolist(), 0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = V.near_duplicates(df).where("n_links > 0").count()
    assert found >= 0.99 * 3000
