"""The pipeline's stages against plain Python on the smallest tables."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from orderloom.llm import common as C
from orderloom.llm import mixing, quality, tokenfiles
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_mixing_sharding import fill
from tests.llm.test_neardup import brute as groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = C.read_table(spark, SF, "documents")
    out = [docs]
    for name, f in P.STAGES:
        out.append(C.stored(f(spark, out[-1], SF), name))
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination",
                                        "source_mixing", "token_files"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_stage(spark, stages):
    scored = quality.score(stages[0], quality.fit_tables(spark, SF), out_col="p").collect()
    assert sorted(r["doc_id"] for r in stages[1].collect()) == sorted(
        r["doc_id"] for r in scored if r["p"] >= quality.THRESHOLD)


def test_near_dedup_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(d for d, _, c in groups(rows, 5) if d == c)


def test_decontamination_stage(spark, stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    items = [(r["item_id"], r["text"]) for r in C.read_table(spark, SF, "benchmark").collect()]
    assert sorted(r["doc_id"] for r in stages[3].collect()) == sorted(d for d, _, hit, _ in leaks(rows, items) if not hit)


def test_mixing_stage(stages):
    size, taken, times, longest = defaultdict(int), defaultdict(int), Counter(), defaultdict(int)
    whole = {r["doc_id"]: r for r in stages[3].collect()}
    for r in whole.values():
        size[r["source"]] += len(r["text"].split())
        longest[r["source"]] = max(longest[r["source"]], len(r["text"].split()))
    for r in stages[4].collect():
        assert whole[r["doc_id"]] == r
        taken[r["source"]] += len(r["text"].split())
        times[r["doc_id"]] += 1
    assert max(times.values()) <= mixing.MAX_REPEATS
    want = fill(size, mixing.WEIGHTS, mixing.SHARE, mixing.MAX_REPEATS)
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 0.5 for s in want)


def test_token_stage(stages):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenfiles.default_tokenizer())
    want = Counter()
    for r in stages[4].collect():
        ids = t.encode(r["text"], add_special_tokens=False).ids + [0]
        want[(r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    got = stages[5].orderBy("start").collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()


def test_run(spark, stages):
    assert sorted(P.run(spark, SF).collect()) == sorted(stages[5].collect())
