"""Operators on repeated text against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from gridloom.llm import anchors, bwt, components, ngram_join, queries, substring
from gridloom.llm.common import words
from llm_fixtures import SF, frame, odd  # noqa: F401


def covered(seqs, length):
    """Per sequence: which symbols lie in a window that starts anywhere else too."""
    seen = Counter(tuple(s[p : p + length]) for s in seqs for p in range(len(s) - length + 1))
    out = []
    for s in seqs:
        flags = np.zeros(len(s), bool)
        for p in range(len(s) - length + 1):
            if seen[tuple(s[p : p + length])] > 1:
                flags[p : p + length] = True
        out.append(flags)
    return out


def check_words(got, docs, length):
    seqs = [(t or "").encode().split() for _, t in docs]
    want = sorted(
        (-1 if i is None else i, len(s), int(f.sum()), hashlib.sha256(b" ".join(w for w, x in zip(s, f) if not x)).hexdigest())
        for (i, _), s, f in zip(docs, seqs, covered(seqs, length))
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def check_bytes(got, docs, length):
    seqs = [(t or "").encode() for _, t in docs]
    want = sorted(
        (-1 if i is None else i, len(s), int(f.sum()), int((np.diff(np.concatenate([[0], f.view(np.int8)])) == 1).sum()),
         hashlib.sha256(bytes(np.frombuffer(s, np.uint8)[~f])).hexdigest())
        for (i, _), s, f in zip(docs, seqs, covered(seqs, length))
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def patchwork(seed, pieces=12, n=40):
    """Texts sewn from few passages, so that repeats begin and end anywhere."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 2)
    parts = [[word() for _ in range(rng.randint(4, 30))] for _ in range(pieces)]
    cut = lambda p: p[rng.randint(0, 3) : len(p) - rng.randint(0, 3)]
    return [" ".join(w for _ in range(rng.randint(1, 4)) for w in cut(rng.choice(parts))) for _ in range(n)]


@pytest.mark.parametrize("limits", [{}, {"max_contents": 2}])
def test_substring_dedup(frame, odd, limits):
    texts = [*odd, *patchwork(1), None]
    ids = [*range(len(texts) - 1), None]
    docs = list(zip(ids, texts)) + [(3, texts[3]), (6, texts[6])]  # two repeated rows
    got = substring.digest(substring.dedup(frame([t for _, t in docs], [i for i, _ in docs]), length=12, **limits)).collect()
    check_words(got, docs, 12)


@pytest.mark.parametrize("limits", [{}, {"max_contents": 2}])
@pytest.mark.parametrize("length", [23, 40])
def test_bwt_dedup(frame, odd, limits, length):
    texts = [t for t in odd if t is None or len(t) < 9000] + patchwork(2, n=25)
    docs = list(zip(range(len(texts)), texts)) + [(5, texts[5]), (6, texts[6])]
    got = bwt.digest(bwt.dedup(frame([t for _, t in docs], [i for i, _ in docs]), length=length, **limits)).collect()
    check_bytes(got, docs, length)


def test_clean_keeps_characters_whole(frame):
    text = "é" * 150 + "tail one"
    other = "a" + "é" * 150 + "tail two"
    got = bwt.cleaned(frame([text, other, None, ""]), length=200).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["one", "atwo", None, ""]
    assert got[0].kept == "k"
    # A repeat that begins within a character: the two letters share their second byte.
    got = bwt.cleaned(frame(["xé" + "z" * 250, "yĩ" + "z" * 250]), length=200).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["xé", "yĩ"]


def test_empty_tables(frame):
    none = frame([])
    assert substring.dedup(none).count() == 0 and bwt.dedup(none).count() == 0 and ngram_join.join(none).count() == 0
    assert ngram_join.representatives(none).count() == 0 and bwt.cleaned(none).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7), (None, 3)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in parent}


def brute_links(texts, n=5, threshold=0.8):
    sets = []
    for t in texts:
        w = words(t.encode() if t else None)
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    linked = {i: set() for i in range(len(texts))}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                linked[i].add(j)
                linked[j].add(i)
    root = list(range(len(texts)))
    for _ in texts:
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(len(texts))]
    return root, [len(x) for _, x in sorted(linked.items())]


@pytest.mark.parametrize("block", [600_000, 300])
def test_ngram_join(frame, odd, block):
    rng = random.Random(9)
    texts = list(odd)
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(99)}"
            texts.append(" ".join(copy))
    root, links = brute_links(texts)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(frame(texts), block=block).collect()}
    assert got == {i: (root[i], links[i]) for i in range(len(texts))}
    kept = sorted(r.doc_id for r in ngram_join.representatives(frame(texts), block=block).collect())
    assert kept == [i for i in range(len(texts)) if root[i] == i]


def test_ngram_join_repeated_and_null_ids(frame):
    got = ngram_join.join(frame(["a b c d e f"] * 4 + [None, "z"], [1, 1, None, 2, 5, 5])).collect()
    assert sorted((r.n_links, -1 if r.doc_id is None else r.doc_id) for r in got) == [(0, 5), (0, 5), (3, -1), (3, 1), (3, 1), (3, 2)]
    kept = ngram_join.representatives(frame(["a b c d e f"] * 4 + [None, "z"], [1, 1, None, 2, 5, 5])).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == [1, 5, 5]


def test_representatives_tell_texts_of_one_id_apart(frame):
    """Near copies that differ in text under null and shared ids; an id with a text of its own and a near copy of another id."""
    base = [[f"{c}{k}" for k in range(60)] for c in "abcd"]
    near = lambda c: " ".join(base[c][:-1] + ["changed"])
    full = [" ".join(b) for b in base]
    texts = [full[0], near(0), full[1], near(1), full[2], near(2), full[3], full[3], None, "!"]
    ids = [None, None, 7, 7, 3, 5, 5, 5, 5, None]
    kept = ngram_join.representatives(frame(texts, ids)).collect()
    assert len(kept) == 6 and sum(r.text in (full[0], near(0)) for r in kept) == 1 and sum(r.text in (full[1], near(1)) for r in kept) == 1
    assert {(r.doc_id, r.text) for r in kept} > {(3, full[2]), (5, full[3]), (5, None), (None, "!")}
    got = ngram_join.join(frame(texts, ids)).collect()
    assert sorted((r.class_id or -1, r.n_links) for r in got) == [(-1, 0), (-1, 1), (-1, 1), (3, 1), (3, 1), (5, 0), (5, 1), (5, 1), (7, 1), (7, 1)]


def test_banding_reaches_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, per = ngram_join.banding(threshold)
        assert 1 - (1 - threshold**per) ** bands >= 0.999 and bands * per <= ngram_join.MAX_HASHES


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op3_suffix_array_dedup"])
def test_queries_against_brute_force(spark, name):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES[name](spark, SF).collect()
    check_words(got, docs, 35) if name.startswith("op2") else check_bytes(got, docs, 200)


def short_copies(n):
    """Different texts of 20 words; all start alike, the last word changes: 15 of 17 shingles in common."""
    return [" ".join([f"w{k}" for k in range(19)] + [f"end{i}"]) for i in range(n)]


def test_verify_takes_memory_linear_in_sets():
    n, press = 4000, zstandard.ZstdCompressor(level=1)
    frame = pd.DataFrame({
        "cluster": b"c", "i": 0, "j": 1, "set_id": [f"{k:05d}".encode() for k in range(n)], "weight": [1 + k % 3 for k in range(n)],
        "block": [k % 2 for k in range(n)], "z": [press.compress(t.encode()) for t in short_copies(n)]})
    tracemalloc.start()
    got = ngram_join._verify(frame, 5, 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    other = frame.groupby("block")["weight"].sum()
    assert got["links"].tolist() == [other[1 - k % 2] for k in range(n)] and got["root"].nunique() == 1
    assert peak < 180e6


def test_blocks_hold_few_sets(spark):
    members = spark.range(1000).selectExpr("cast('c' as binary) as cluster", "cast(cast(id as string) as binary) as set_id", "16 as size")
    sizes = [r["count"] for r in ngram_join._dealt(members, 600_000, 100).groupBy("block").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 150


def test_large_cluster_of_short_texts(frame):
    texts = short_copies(60)
    got = ngram_join.join(frame(texts), most=20).collect()
    assert [(r.class_id, r.n_links) for r in got] == [(0, 59)] * 60


@pytest.mark.parametrize("unit, length, k", [("byte", 200, 24), ("word", 35, 8)])
def test_anchors_are_counted_without_segments(frame, odd, unit, length, k):
    """The first pass over the texts makes anchors and their numbers only, and those of the segments."""
    docs = anchors.keyed(frame(odd), "text").selectExpr("_d", "_h", "cast(coalesce(text, '') as binary) as _text")
    counted = anchors._anchors(docs, unit, length, k)
    assert counted.columns == ["anchor", "n"]
    segments = anchors._segments(docs, unit, length, k).groupBy("anchor").agg(F.sum(F.size("ats")).alias("n"))
    both = counted.groupBy("anchor").agg(F.sum("n").alias("n")).collect(), segments.collect()
    assert dict(map(tuple, both[0])) == dict(map(tuple, both[1])) and both[1]
