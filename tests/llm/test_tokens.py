import zlib

import numpy as np
import pytest

from orderloom.llm import common as C
from orderloom.llm import tokenfiles as T
from orderloom.llm.wavelet import WaveletMatrix

ODD = ["", "a", " ", "  ", "a  b", "a \n b", "a\n\n b", "it's don't", " it's, ok. x", "tab\t\tx \n", "  lead", "trail  ",
       "　a b", "x  y", "a \nb", "3.5, 4", "<|endoftext|> a <|endoftext|>,b", "a\r\n b", "é,è.", "中文 字, x",
       "hello!!! wow?? ...", "x\x1c y", "a\x85b", "'s 't 're", "word's, it'll", "a\x0b \x0cb", "😀 😀,x", None]


def reference(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(T.default_tokenizer())
    return [e.ids + [0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_encoder_gives_the_library_ids():
    import pyarrow as pa
    enc = T.Encoder(T.default_tokenizer())
    texts = ODD + [" ".join(x or "" for x in ODD)]
    for _ in range(2):  # the second time from the cache
        data, off = C.text_buffers(pa.array(texts))
        ids, counts = enc.encode(data, off)
        got = np.split(ids, np.cumsum(counts)[:-1])
        assert [g.tolist() for g in got] == reference(texts)
    enc.used = T.CACHE_IDS + 1  # forgets and learns again
    assert enc.encode(data, off)[0].tolist() == ids.tolist()


@pytest.mark.parametrize("shard", [1, 100, 1 << 20])
def test_round_trip(spark, docs, monkeypatch, shard):
    monkeypatch.setattr(T, "SHARD_TOKENS", shard)
    df = docs.union(spark.createDataFrame([(1000 - i, t, "s", i) for i, t in enumerate(ODD)], docs.schema))
    out = T.read_shards(spark, T.write_shards(df, T.default_tokenizer())).collect()
    rows = df.collect()
    assert len(out) == len(rows)
    want = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, len(i), zlib.crc32(np.array(i, "<u4").tobytes()))
                   for r, i in zip(rows, reference([r["text"] for r in rows]))))
    got = sorted(out, key=lambda r: r["start"])
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in got]
    assert ids == sorted(ids)


def test_empty_table(spark, docs):
    assert T.read_shards(spark, T.write_shards(docs.limit(0), T.default_tokenizer())).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 50, n).astype(np.uint32)
    w = WaveletMatrix.from_bytes(WaveletMatrix.of(ids, 16, [7], [0], [n]).to_bytes())
    assert w.decode().tolist() == ids.tolist() and w.counts.tolist() == [n] and w.doc_ids.tolist() == [7]
    for s in (0, 7, 49, 60, 70000):
        at = np.flatnonzero(ids == s)
        assert w.count(s) == len(at)
        for i in (0, n // 3, n):
            assert w.rank(s, i) == (ids[:i] == s).sum()
        for k in {0, len(at) // 2, len(at) - 1} if len(at) else ():
            assert w.select(s, k) == at[k]
        with pytest.raises(IndexError):
            w.select(s, len(at))
    for i in range(0, n, 97):
        assert w.access(i) == ids[i]
    with pytest.raises(IndexError):
        w.access(n)


def test_wide_ids():
    ids = np.array([0, 70000, 3, 70000, 99999], np.uint32)
    w = WaveletMatrix.from_bytes(WaveletMatrix.of(ids, 17, [1], [0], [5]).to_bytes())
    assert w.decode().tolist() == ids.tolist() and w.count(70000) == 2 and w.select(70000, 1) == 3


def test_pieces_that_collide_under_polynomials():
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    import pyarrow as pa
    texts = [a, b, f"x {a} y", f"x {b} y"]
    ids, counts = T.Encoder(T.default_tokenizer()).encode(*C.text_buffers(pa.array(texts)))
    assert [g.tolist() for g in np.split(ids, np.cumsum(counts)[:-1])] == reference(texts)


def test_an_encoder_forgets_its_pieces():
    """After ``forget`` nothing of the texts is held, and ids are the same."""
    import pyarrow as pa
    enc = T.Encoder(T.default_tokenizer())
    data, off = C.text_buffers(pa.array(["some words, more words", "", "other words"]))
    first = enc.encode(data, off)
    enc.forget()
    assert not enc.known and not len(enc.flat) and enc.used == 0
    again = enc.encode(data, off)
    assert all((a == b).all() for a, b in zip(first, again, strict=True))
