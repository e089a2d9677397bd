import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import infill

ODD = ["", " ", "é", "a", "\n\n", "日本語 text\nwith  lines\n", "x" * 40, " lead and trail \n", "𝒳𝒴 zé\t\ta\rb\x0bc", "\x00\x01a"]


def units_of(text, units):
    if units == "code_points":
        return list(text)
    if units == "lines":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    return re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|^[\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("units", list(infill.UNITS))
@pytest.mark.parametrize("piece", [64, 1 << 20])
def test_every_rank_is_found(units, piece, monkeypatch):
    monkeypatch.setattr(infill.C, "SLICE_BYTES", piece)
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(["a", "é", " ", "\n", "日", "word ", "𝒳"]) for _ in range(rng.randrange(900)))
                   for _ in range(40)] + ["", ""]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    found = infill.SkipList(np.frombuffer(b"".join(raw), np.uint8), off, units)
    split = [units_of(t, units) for t in texts]
    assert ["".join(u) for u in split] == texts
    assert found.size.tolist() == [len(u) for u in split]
    doc = np.repeat(np.arange(len(texts)), [len(u) + 1 for u in split])
    rank = np.concatenate([np.arange(len(u) + 1) for u in split])
    byte, point = found.find(doc, rank)
    for d, r, b, p in zip(doc.tolist(), rank.tolist(), byte.tolist(), point.tolist(), strict=True):
        head = "".join(split[d][:r])
        assert (b - off[d], p) == (len(head.encode()), len(head))


def test_lanes_carry_widths_and_thin_out():
    text = ("0123456789é" * 20_000).encode()
    found = infill.SkipList(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    sizes = [220_000] + [len(u) for u in found.units]
    assert sizes[-1] == 2 and all(6 * b < a < 10 * b for a, b in zip(sizes, sizes[1:], strict=False) if b > 1000)
    for units, points in zip(found.units, found.points, strict=True):
        assert units[:-1].sum() == points.sum() == 220_000


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    x, y = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:x], text[x:y], text[y:]
    if d % 100 < 20:
        return n, "spm", x, y - x, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", x, y - x, f"<P>{p}<S>{s}<M>{m}"


def test_against_plain_slices(spark, docs):
    rows = [(100 + i, t) for i, t in enumerate(ODD)] + [(200, "a <P> b"), (201, "<M>"), (202, "<"), (203, "<P"), (204, "S><S"),
                                                        (205, "é日" * 300_000)]
    rows += [(300 + i, "<<PSM>>" * (i % 9)) for i in range(40)] + [(i, f"text é {i} more") for i in range(400, 700)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = sorted([(r["doc_id"], *brute(r["doc_id"], r["text"]), r["text"] or "") for r in docs.collect()], key=str)
    out = infill.transformed(docs)
    got = out.select("doc.doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                     infill.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted([tuple(r) for r in got], key=str) == expected
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("units", ["words", "lines"])
def test_other_units_restore_and_cut_between_units(spark, units):
    docs = spark.createDataFrame([(i, f"first {i}\nsecond line é\n\nlast words here " * 3) for i in range(200)],
                                 "doc_id long, text string")
    out = infill.transformed(docs, units=units, seed=9).select(
        "*", infill.restored(F.col("output"), F.col("form")).alias("back")).collect()
    for r in out:
        text = f"first {r['doc']['doc_id']}\nsecond line é\n\nlast words here " * 3
        assert r["back"] == text and r["n"] == len(units_of(text, units))
        if r["form"] != "plain":
            ends = {0, *np.cumsum([len(u) for u in units_of(text, units)]).tolist()}
            assert {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= ends


def test_other_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "ab", 3, "x"), (None, None, None, None)], "doc_id long, text string, n int, output string")
    out = infill.transformed(docs)
    assert out.columns == ["doc", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert {tuple(r["doc"]) for r in out.collect()} == {(1, 3, "x"), (None, None, None)}
    assert infill.transformed(docs.limit(0)).count() == 0
