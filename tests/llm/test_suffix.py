import hashlib
import random
from collections import Counter

import numpy as np

from orderloom.llm import suffixdup
from orderloom.llm.suffix import Suffixes


def brute(rows, length=400):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(rows, raw):
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = suffixdup.repeated_spans(df).collect()
    assert sorted([(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got],
                  key=str) == brute(rows)


def test_against_every_window(spark, monkeypatch):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, edge, exact = text(700), text(399), text(400)
    rows = [(1, text(300) + passage + text(50)), (2, passage + text(900)), (3, text(100) + passage[100:650]),
            (4, edge + text(500)), (5, edge + text(10)), (6, text(20) + exact), (7, exact + text(30)),
            (8, "ab" * 600), (9, "x" * 400), (10, "x" * 401), (11, None), (12, ""), (13, text(2000)),
            (None, text(450)), (15, passage), (15, passage), (16, passage + passage[:-1]), (17, "é" * 300)]
    rows += [(30 + i, text(60) + passage[:420] + text(60)) for i in range(30)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    check(df)
    monkeypatch.setattr(suffixdup, "GROUP", 4)  # hot cores are split
    monkeypatch.setattr(suffixdup, "BROADCAST_BYTES", 0)
    check(df)


def test_hot_passage_is_in_no_single_group(spark, monkeypatch):
    """Windows in the passage but in a border group have the same bytes in
    all surroundings: two of each reach the suffix sort, not all."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = text(430)
    df = spark.createDataFrame([(i, text(60) + passage + text(60)) for i in range(300)], "doc_id long, text string")
    monkeypatch.setattr(suffixdup, "GROUP", 8)

    def bounded(batches):
        from orderloom.llm import suffixdup as unpatched

        def counted():
            held = Counter()
            for b in batches:
                held.update(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
                assert max(held.values(), default=0) <= 2 * unpatched.STEP
                yield b

        return unpatched._sorted_windows(counted())

    monkeypatch.setattr(suffixdup, "_sorted_windows", bounded)
    check(df)


def test_empty_table(docs):
    assert suffixdup.repeated_spans(docs.limit(0)).count() == 0
    check(docs)


def test_sort_is_lexicographic():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 3, 4000).astype(np.uint8)
    data[2000:2600] = data[100:700]
    depth = 60
    starts = rng.choice(4000 - depth, 500, replace=False)
    order = Suffixes(data, depth).sort(starts)
    keys = [data[s:s + depth].tobytes() for s in starts[order]]
    assert keys == sorted(keys)
    seen = Counter(data[s:s + depth].tobytes() for s in starts)
    expect = [seen[data[s:s + depth].tobytes()] > 1 for s in starts]
    assert Suffixes(data, depth).repeated(starts).tolist() == expect
