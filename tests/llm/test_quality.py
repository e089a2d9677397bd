import random

import pytest

from orderloom.llm import quality as Q


@pytest.fixture
def labelled(spark):
    rng = random.Random(1)
    syl = ["ta", "ri", "mo", "ne", "lu", "ka", "so", "vi"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(600):
        w = [word() for _ in range(rng.randrange(30, 200))]
        good = i % 4 != 0
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "$!" for x in w), "x"))
        labels.append((i, int(good)))
    rows += [(1000, None, "x"), (1001, "", None), (None, "ta ri mo", "x"), (1002, "ka so " * 40000, "x"), (5, rows[5][1], "x")]
    labels += [(1, None), (2, 7), (None, 1), (3, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = Q.fit(docs, labels.where(~Q.held_out()))
    rows = Q.score(docs, model, out_col="p").where(Q.held_out()).join(
        labels.where("quality in (0, 1)"), "doc_id").collect()
    assert len(rows) > 100
    assert sum((r["p"] >= Q.THRESHOLD) == (r["quality"] == 1) for r in rows) >= 0.97 * len(rows)


def test_every_row_is_scored(labelled):
    docs, labels = labelled
    scored = Q.score(docs, Q.fit(docs, labels), out_col="p")
    assert scored.columns == ["doc_id", "text", "score", "p"]
    rows = scored.collect()
    assert len(rows) == docs.count() and all(0 <= r["p"] <= 1 for r in rows)
    empty = [r["p"] for r in rows if not r["text"]]
    assert len(set(empty)) == 1
    # Labels, ids and other columns play no part.
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"], r["p"]) == r["p"]


def test_without_both_labels(labelled):
    docs, labels = labelled
    for some, p in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        got = {r["p"] for r in Q.score(docs.limit(5), Q.fit(docs, some), out_col="p").collect()}
        assert len(got) == 1 and abs(got.pop() - p) < 1e-3
    assert Q.score(docs.limit(0), Q.fit(docs, labels), out_col="p").count() == 0


def test_fit_is_repeatable(labelled):
    docs, labels = labelled
    assert Q.fit(docs, labels) == Q.fit(docs.repartition(7), labels.repartition(3))


def test_repeated_ids_fill_no_sample(spark, monkeypatch):
    """Of documents that share a sampled id one text reaches the driver."""
    docs = spark.createDataFrame([(1, f"good words {k} " * 20) for k in range(50)] + [(2, "bad text " * 30)],
                                 "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    held = []
    dictionary = Q._dictionary
    monkeypatch.setattr(Q, "_dictionary", lambda texts: held.append(len(texts)) or dictionary(texts))
    first = Q.fit(docs, labels)
    assert held == [1, 1]
    assert Q.fit(docs.repartition(7), labels) == first
