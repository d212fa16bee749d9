"""Spelling variants, centroid clusters and article text: brute force, SQL, hand-made pages, odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import html_blocks, html_samples, orchard, queries, spelling
from llm_fixtures import SF, frame, odd  # noqa: F401
from tools.check import compare, connect


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in vocab.items():
        near = sorted((-vocab[v], v) for v in vocab if _near(w, v))
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        out[w] = [n, len(near), form, vocab[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return out


@pytest.mark.parametrize("limit", [spelling.GROUP, 3])
def test_variants_equal_brute_force(frame, odd, limit):
    rng = random.Random(4)
    base = ["straße" + "".join(rng.choice("aábé") for _ in range(k % 4)) for k in range(8)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ÀÿÖöabcd"]
    words = []
    for k, w in enumerate(base):
        words += [w] * (6 * 5 ** (k % 3) + k)
        for _ in range(6):
            at = rng.randrange(len(w))
            words += [w[:at] + rng.choice(["", "z", w[at] + "z"]) + w[at + 1:]] * rng.choice([1, 4, 5, 6])
    rng.shuffle(words)
    texts = [*odd, *[" ".join(words[i: i + 40]).title() for i in range(0, len(words), 40)], "x" * 3000 + " " + "x" * 2999, *["y" * 70_000] * 5, *["y" * 69_999] * 6]
    ids = [None if i % 7 == 3 else i // 2 for i in range(len(texts))]
    got = {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in spelling.variants(frame(texts, ids), limit=limit).collect()}
    assert got == _variants(list(zip(ids, texts)))
    assert any(v[1] > 2 for v in got.values()) and any(v[4] != w and v[4] != v[2] for w, v in got.items())


def test_pairs_of_a_shard_count_once(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(400)})
    vocab = spark.createDataFrame([(w, rng.randint(5, 9)) for w in words], "word string, n bigint")
    for limit in (10_000, 20):
        got = {r.word: r.n_near for r in spelling.neighbours(vocab, limit).collect()}
        assert got == {w: k for w in words if (k := sum(_near(w, v) for v in words))}


def test_no_words(frame, spark):
    assert spelling.variants(frame([None, "", "short", "lonely"])).count() == 0
    assert spelling.variants(frame([])).count() == 0


def _kmeans(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) < 2**18 for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in start[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        best = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, best) if c == j]
            if mine:
                centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    best = assign()
    inertia = Counter()
    for d, c in best:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, best))


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=64), 1)]) for i in range(150)]
    rows += [(i, rows[i][1]) for i in (3, 4, 5)] + [(500 + i, [0.25] * 64) for i in range(30)] + [(None, rows[9][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63), (905, [float("nan")] * 64), (906, [float("inf")] * 64), (907, [1e30] * 64), (908, [-1000.0] * 64)]
    for some in (rows, rows[:5], rows[-9:-2], rows[-8:-7]):
        df = spark.createDataFrame([(i, v, "x", 7) for i, v in some], "vec_id bigint, embedding array<double>, cluster string, Distance int")
        got = orchard.digest(orchard.cluster(df)).collect()
        assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == _kmeans(some)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 4), st.integers(0, 10**6))
def test_search_finds_the_least_of_all(k, spread, seed):
    """Few different values, so that ties are common."""
    rng = np.random.default_rng(seed)
    centroids, x = rng.integers(-spread, spread + 1, (k, 3)), rng.integers(-spread, spread + 1, (40, 3))
    at, best = orchard.search(x, centroids, *orchard.neighbour_lists(centroids))
    full = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (best == full.min(axis=1)).all() and (at == full.argmin(axis=1)).all()


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_orchard_clusters"])
def test_queries_equal_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = connect(SF).execute(queries.ORACLES[name]).df()
    for c in ("form_n",):
        if c in got:
            got[c], want[c] = got[c].astype("float64"), want[c].astype("float64")
    assert compare(got, want) == ""


@pytest.fixture(scope="module")
def tree(spark):
    return html_blocks.fit(html_samples.samples(spark))


PAGES = [
    (None, ""), ("", ""), ("plain words only", None), ("<p></p>", ""), ("<!-- <p>x</p>", ""), ("<script>var a = '<article><p>x</p></article>'", ""),
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href='/'>Home</a><ul><li><a href=x>A</a></ul></nav>"
     "<article><h1>Title &amp; more</h1><p>One\n two&nbsp;three<p>B.<br>C &lt;d&gt; &#233; &unknown; &am</article><footer>&copy; x</footer>",
     "Title & more\n\nOne two three\n\nB. C <d> é &unknown; &am"),
    ("<body><header><h1>Site</h1></header><main><h2>Head</h2><p>Text <b>bold</b>ly.</p><aside><p>" + "aside " * 40 + "</p></aside><form><label>Name</label><textarea>t</textarea>"
     "<button>Go</button></form><p>End.</p></main><div class='cookie-notice'><p>" + "We use cookies " * 9 + "</p></div>", "Head\n\nText boldly.\n\nEnd."),
    ("<article><p>Body.</p><section class='comments'><h3>2 comments</h3><div class='comment'><p>" + "I agree " * 20 + "</p></div></section></article>", "Body."),
    ("<div id='sidebar'>" + "word " * 50 + "</div><div class='ad'>Buy now.</div><article><p>a < b and 1 <2, <x y='>'>q</x></p></article>", "a < b and 1 <2, q"),
]


def test_article_text_of_pages(tree):
    for page, want in PAGES:
        if want is not None and page:
            assert html_blocks.text_of(page, tree) == want, page


def test_samples_are_learned(spark, tree):
    rows = html_samples.samples(spark).toPandas()
    assert (tree.predict(rows[list(html_blocks.FEATURES)].to_numpy(float)) == rows["kept"].astype(bool)).mean() == 1.0
    assert len(tree.feature) < 40
    few = html_blocks.fit(html_samples.samples(spark), limit=10)
    assert len(few.feature) <= 19
    assert html_blocks.fit(html_samples.samples(spark).where("false")).predict(np.zeros((2, len(html_blocks.FEATURES)))).all()


def test_extract_keeps_columns_and_rows(spark, tree):
    rows = [(i, f"u{i}", p, "old", -1, i) for i, (p, _) in enumerate(PAGES)] * 2 + [(None, None, None, None, None, None)]
    got = html_blocks.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, Text string, N_chars int, other int"), tree)
    assert got.columns == ["page_id", "url", "other", "text", "n_chars"] and got.count() == len(rows)
    for r in got.collect():
        want = "" if r.page_id is None else PAGES[r.page_id][1]
        assert want is None or (r.text, r.n_chars) == (want, len(want))
    assert html_blocks.extract(spark.createDataFrame([], "page_id bigint, html string"), tree).count() == 0


def test_long_and_broken_pages_take_linear_time(tree):
    import time

    for piece in ("<div>", "</div>", "<!-", "<a href='", "<p", "<", "&", "<script>", "<li>x", "\"'>", "<div class=\"a"):
        spent = []
        for n in (20_000, 80_000):
            start = time.perf_counter()
            html_blocks.text_of("<article><p>ok</p>" + piece * n, tree)
            spent.append(time.perf_counter() - start)
        assert spent[1] < 12 * spent[0] + 0.5, piece


def test_given_pages_equal_a_plain_reading(spark, tree):
    """All given pages have one article; its text by regular expressions."""
    import html

    pages = duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r.text for r in queries.op13_article_text(spark, SF).collect()}
    assert len(got) == len(pages)
    for page_id, page in pages:
        body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)>", body))
        assert got[page_id] == "\n\n".join(p for p in parts if p)
