import re
from collections import Counter

import pytest

from orderloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = []
    for i, t in items:
        w = words_of(t)
        if w:
            n = min(window, len(w))
            wins.append((i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}, n))
    out = []
    for d, t in docs:
        w = words_of(t)
        hit, found = set(), set()
        for i, s, n in wins:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in s:
                    hit.update(range(k, k + n))
                    if i is not None:
                        found.add(str(i))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.fixture
def tables(spark):
    item = "The quick brown Fox jumps over the lazy dog near river banks"
    docs = [(1, f"Intro. {item.upper()}! Outro", "a"), (2, "the quick brown fox jumps", "b"), (3, None, None), (4, "", "a"),
            (5, "short ITEM here and again: short, item.", "a"), (6, "brown fox jumps over the lazy dog near river banks", "a"),
            (7, "quick brown fox jumps over the lazy dog near river", "x"), (None, item + " " + item, "a"),
            (7, "quick brown fox jumps over the lazy dog near river", "x"), (9, "clean words only " * 50, "y")]
    items = [(10, item), (9, "short item"), (3, None), (4, ""), (None, "and again"), (11, "lone"), (10, item)]
    return (spark.createDataFrame(docs, "doc_id long, text string, spans string"),
            spark.createDataFrame(items, "item_id long, text string"), [r[:2] for r in docs], items)


def rows_of(df):
    return sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in df.collect()], key=str)


def test_against_brute_force(tables):
    docs, items, d, i = tables
    assert rows_of(D.scan(docs, items, ["doc_id"])) == brute(d, i)


def test_items_in_parts(tables, monkeypatch):
    docs, items, d, i = tables
    monkeypatch.setattr(D, "PART_BYTES", 100)
    assert rows_of(D.scan(docs, items, ["doc_id"])) == brute(d, i)


def test_parts_change_no_span_and_no_text(tables, monkeypatch):
    docs, items, *_ = tables
    spans = lambda: Counter((r["doc_id"], r["n_hit"], tuple(r["items"]), tuple(r["spans"]))
                            for r in D.scan(docs, items, ["doc_id"]).collect())
    cut = lambda: Counter(D.without_hits(docs, items, "spans").collect())
    kept = lambda: Counter(D.without_hits(docs, items).collect())
    one = spans(), cut(), kept()
    for size in (40, 100):
        monkeypatch.setattr(D, "PART_BYTES", size)
        assert (spans(), cut(), kept()) == one


def test_one_id_of_several_texts(spark):
    docs = spark.createDataFrame([(1, "some alpha beta here"), (2, "gamma delta")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "alpha beta"), (5, "gamma"), (5, "gamma")], "item_id long, text string")
    assert rows_of(D.scan(docs, items, ["doc_id"])) == [(1, 4, 2, ["5"]), (2, 2, 1, ["5"])]


def test_empty_tables(tables):
    docs, items, d, _ = tables
    assert D.scan(docs.limit(0), items, ["doc_id"]).count() == 0
    assert rows_of(D.scan(docs, items.limit(0), ["doc_id"])) == brute(d, [])


def test_removal(tables):
    docs, items, *_ = tables
    left = D.without_hits(docs, items)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == [2, 3, 4, 9]
    cut = {r["doc_id"]: r["text"] for r in D.without_hits(docs, items, "spans").collect()}
    assert cut[1] == "Intro. ! Outro" and cut[2] == "the quick brown fox jumps" and cut[3] is None
    assert cut[5] == " here ."  # hit words side by side are one span
