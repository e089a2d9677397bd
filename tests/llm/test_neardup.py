import itertools
import random

import numpy as np
import pyarrow as pa

from orderloom.llm import common as C
from orderloom.llm import neardup
from orderloom.llm.components import connected


def words_of(text):
    return [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ")
            .replace("\t", " ").split(" ") if w]


def shingles(text, width):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def brute(rows, width):
    """Component of each row by all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = least.setdefault(find(i), [])
        if d is not None:
            ids.append(d)
    return sorted([(d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d)
                   for i, (d, _) in enumerate(rows)], key=str)


def check(df, width):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    out = neardup.near_duplicates(df, width=width).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out], key=str) == brute(rows, width)
    for r in out:
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_against_all_pairs(docs):
    check(docs, 2)


def test_five_words_and_empty_table(docs):
    check(docs, 5)
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_chains_of_near_copies(spark):
    """Texts that are similar only to the next one are one component."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10000)}" for _ in range(120)]
    rows = []
    for step in range(12):
        rows.append((100 - step, " ".join(words)))
        for _ in range(3):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10000)}"
    check(spark.createDataFrame(rows, "doc_id long, text string"), 2)


def test_one_of_each_keeps_clean_rows(docs):
    kept = neardup.one_of_each(docs, width=2)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and 13 not in ids
    assert {4, 5, 12} <= set(ids) and ids.count(9) == 2 and 7 in ids and 8 not in ids


def test_radius_is_guaranteed():
    """Signatures that differ in RADIUS symbols, however spread, share a key."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 1 << neardup.SYMBOL_BITS, neardup.SYMBOLS)
        b = a.copy()
        at = rng.choice(neardup.SYMBOLS, neardup.RADIUS, replace=False)
        b[at] ^= 1 + rng.integers(0, 1000, len(at))
        keys = neardup.chunk_keys(np.stack([a, b]))
        assert set(keys[0]) & set(keys[1])


def test_word_kernel():
    texts = ["A b  c", None, "", "éÀ x\ty", "Ab AB ab"]
    data, off = C.text_buffers(pa.array(texts))
    start, end, first = C.words(data, off, C.SPACE_WORDS)
    got = [[data[s:e].tobytes().decode() for s, e in zip(start[a:b], end[a:b])]
           for a, b in zip(first[:-1], first[1:])]
    assert got == [["A", "b", "c"], [], [], ["éÀ", "x", "y"], ["Ab", "AB", "ab"]]
    assert len(set(C.word_hashes(data, start, end)[-3:].tolist())) == 1


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60) if i % 7] + [(100, 100 + k) for k in range(1, 80)] + [(5, 5)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: root[n] for n in linked}


def doubled(steps=10):
    """Two words that collide under a polynomial hash modulo 2**64."""
    word, other = "a", "b"
    for _ in range(steps):
        word, other = word + other, other + word
    return word, other


def test_words_that_collide_under_polynomials(spark):
    a, b = doubled()
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"x {a} y"), (4, f"x {b} y"), (5, a[:200]), (6, b[:200]), (7, a)],
                                 "doc_id long, text string")
    check(docs, 2)
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()} == {
        1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1}


def test_word_hashes_tell_words_apart():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abAB\xc3") for _ in range(rng.randrange(1, 300))) for _ in range(3000)] + [b"a\0", b"a", b"A"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    end = np.cumsum([len(t) for t in texts])
    h = C.mixed_word_hashes(data, end - [len(t) for t in texts], end)
    lower = [bytes(c + 32 if 65 <= c <= 90 else c for c in t) for t in texts]
    for t, x in zip(lower, h.tolist(), strict=True):
        assert all(y == x for u, y in zip(lower[:50] + lower[-3:], h[:50].tolist() + h[-3:].tolist(), strict=True) if u == t)
    assert len(set(h.tolist())) == len(set(lower))


def test_one_of_each_with_columns_of_any_name(docs):
    named = docs.toDF("doc_id", "text", "row_key", "all_stay")
    out = neardup.one_of_each(named, width=2)
    assert out.columns == named.columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == sorted(
        r["doc_id"] or 0 for r in neardup.one_of_each(docs.toDF("doc_id", "text", "__all", "doc"), width=2).collect())
