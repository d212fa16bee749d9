"""Small tables of odd documents for the tests of this folder."""

import os
import random

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, N_Words string, score string, shard string, kept string, spans string"


def rows(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None, "x", "y", "z", "k", "p") for k, (i, t) in enumerate(zip(ids, texts))]


@pytest.fixture(scope="session")
def frame(spark):
    """A table of documents with extra columns, some named as operators name theirs."""

    def make(texts, ids=None):
        return spark.createDataFrame(rows(texts, ids), SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd():
    """Null, empty, blank, short, long and repeated texts; letters of several scripts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeßéЖ") for _ in range(rng.randint(1, 3)))
    base = [word() for _ in range(400)]
    texts = [None, "", " \n\t ", "one", "Two words.", "!!! ... ???", " ".join(base), " ".join(base[:200] + [word()] + base[201:])]
    texts += [" ".join(base[i : i + 60] + [word() for _ in range(30)]) for i in (0, 50, 100, 333)]
    texts += [" ".join(["same"] * 300), "x" * 5000, " ".join(word() for _ in range(20000)), " ".join(base), "line\n" * 50]
    return texts
