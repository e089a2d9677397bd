import random

import pytest

from orderloom.llm import common as C

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]


@pytest.fixture(autouse=True)
def small_batches(spark):
    C.ready(spark)


@pytest.fixture
def docs(spark):
    """Documents with nulls, empty texts, copies, near copies and an extra
    column of a clashing name."""
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))
    base = text(200)
    words = base.split()
    words[100] = "changed"
    rows = [(1, base, "a"), (2, base, "b"), (3, " ".join(words), None), (4, None, "a"), (5, "", "b"),
            (None, text(50), "a"), (7, "one", None), (8, "one", "a"), (9, text(3000), "b"), (9, text(30), "b"),
            (1, base, "a"), (12, "  \n\t ", "a"), (13, base.upper(), "c")]
    rows += [(20 + i, text(rng.randrange(1, 80)), f"s{i % 3}") for i in range(40)]
    return spark.createDataFrame([(i, t, s, k) for k, (i, t, s) in enumerate(rows)],
                                 "doc_id long, text string, source string, n_words long")
