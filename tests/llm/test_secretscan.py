import re

import pytest

from orderloom.llm import secretscan as S
from orderloom.llm.common import stored  # noqa: F401


def brute(text, rules=S.RULES):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or ""):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), k, r.name, m.end()))
    return [(n, a, z) for a, _, n, z in sorted(out)]


TEXTS = ["password=hunter22 and token: 'abcdef' x", "PassWord = ab", "secret=token:abcdefgh", "é😀 api_key==abcdefg é secret:zzzzzz",
         "AKIA" + "A" * 15 + " AKIA" + "B1" * 8 + " AKIAAKIA" + "C" * 12, "deadbeef" * 3 + " " + "deadbeef" * 2 + "g" + "0" * 24,
         "-----BEGIN RSA PRIVATE KEY-----", "Bearer " + "a" * 30 + "==", None, "", "x" * 5000 + "token=abcdef",
         "passwd:\"abcdef\" apikey=1234567", "password=hunter22 and token: 'abcdef' x"]


@pytest.fixture
def paths(spark):
    rows = [(i if i != 3 else None, t, "extra") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, blob string")


def found(df):
    return [(r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in df.collect()]


def test_against_regex(paths):
    got = dict(found(S.scan(paths)))
    for i, t in enumerate(TEXTS):
        assert got[i if i != 3 else None] == brute(t), t
    assert S.scan(paths).columns == ["doc_id", "text", "blob", "spans"]


def test_only_unseen_pairs_are_scanned(spark, paths, tmp_dir):
    ledger = f"{tmp_dir}/ledger"
    first = paths.where("doc_id < 5")
    S.scan(first, ledger, S.BASE).count()
    n = spark.read.schema(S.LEDGER).parquet(ledger).count()
    S.scan(first, ledger, S.BASE).count()
    assert spark.read.schema(S.LEDGER).parquet(ledger).count() == n == 4
    # A new rule is the only one that the known blobs are scanned with.
    newer = S.Rule("hex", 2, r"[0-9a-f]+", 0, 16)
    rules = (*S.BASE[:2], newer)
    got = dict(found(S.scan(paths, ledger, rules)))
    for i, t in enumerate(TEXTS):
        assert got[i if i != 3 else None] == brute(t, rules), t
    rows = spark.read.schema(S.LEDGER).parquet(ledger).collect()
    assert sorted(r["rules"] for r in rows if len(r["rules"]) == 1) == [["hex@2"]] * 4


def test_empty_table(paths):
    assert S.scan(paths.limit(0)).count() == 0
