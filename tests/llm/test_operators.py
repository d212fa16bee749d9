"""The other operators: brute force, round trips, held-out accuracy, and odd input."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import decontaminate, kdshard, order_minhash, packing, quality, queries, toxicity, training, warc
from gridloom.llm.common import ordered, words
from gridloom.llm.tokens import Encoder
from llm_fixtures import SF, frame, odd  # noqa: F401


def test_decontaminate(frame, odd, spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["aa", "Bb", "c1", "é"])
    items = [(1, " ".join(word() for _ in range(14))), (10, "Odd, short!"), (2, "odd short"), (None, "nobody's  item"), (3, None), (4, "..."), (10, "Odd, short!")]
    texts = [*odd, "x ODD...short y", "nobody s item", " ".join(word() for _ in range(3000)), "pre " + items[0][1].upper() + " post"]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for limit in (4_000_000, 60):
        got = {r.doc_id: r for r in decontaminate.decontaminate(frame(texts), bench, max_chars=limit).collect()}
        for i, t in enumerate(texts):
            w = words((t or "").encode())
            hit, ids = np.zeros(len(w), bool), set()
            for item, body in items:
                b = words((body or "").encode())
                n = min(10, len(b))
                for k in range(len(b) - n + 1 if b else 0):
                    for p in range(len(w) - n + 1):
                        if w[p : p + n] == b[k : k + n]:
                            hit[p : p + n] = True
                            ids |= {str(item)} if item is not None else set()
            r = got[i]
            assert (r.n_words, r.n_hit, r.hit_items, r.contaminated) == (len(w), hit.sum(), sorted(ids), bool(hit.any()))
            assert sum(len(words(t[s.start : s.end].encode())) for s in r.hit_spans) == r.n_hit
    assert decontaminate.clean(frame(texts), bench).columns == frame(texts).columns
    assert decontaminate.decontaminate(frame(texts), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(frame([]), bench).count() == 0


def test_order_minhash(frame, odd):
    ids = [*range(len(odd)), None, 3]
    texts = [*odd, "null id", odd[3]]
    got = order_minhash.fingerprints(frame(texts, ids)).collect()
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want = defaultdict(list)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 4
        want[i].append((len(t), hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()))
    have = defaultdict(list)
    prints = defaultdict(set)
    for r in got:
        have[r.doc_id].append((r.n_chars, r.edited_sha256))
        prints[texts[ids.index(r.doc_id)] or ""].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    assert all(len(v) == 1 for v in prints.values())
    assert order_minhash.fingerprints(frame([])).count() == 0
    alone = order_minhash.fingerprints(frame(["a b c d e f g h"])).first()
    assert alone.near_next == 1.0


def test_order_minhash_follows_edits(frame):
    base = [f"w{i}" for i in range(600)]
    moved = base[300:] + base[:300]
    rng = random.Random(0)
    shuffled = [w for k in range(0, 600, 3) for w in base[k : k + 3]]
    rng.shuffle(shuffled)
    texts = [" ".join(base), " ".join(base[:540] + ["x"] * 60), " ".join(base[:300] + ["y"] * 300), " ".join(moved), " ".join(shuffled)]
    sketches = frame(texts).select("doc_id", order_minhash.sketch(F.col("text")).alias("f"))
    first = sketches.where("doc_id = 0").select(F.col("f").alias("g"))
    near = [r.n for r in sketches.crossJoin(F.broadcast(first)).select("doc_id", order_minhash.likeness(F.col("f"), F.col("g")).alias("n")).orderBy("doc_id").collect()]
    assert near[0] == 1 and near[1] > near[2] > near[4] and near[3] < 0.9


def test_sketch_numbers_repeats(frame):
    got = frame(["a b c " * 40, "a b c " * 41, "c b a " * 40]).select(order_minhash.sketch(F.col("text")).alias("f")).collect()
    assert len({tuple(r.f) for r in got}) == 3  # equal k-mer sets, other counts or order


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.9), (toxicity, "toxic", 0.9)])
def test_classifiers(spark, frame, odd, module, label, least):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = module.fit(docs, labels)
    got = module.digest(module.score(docs, model)).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got.predicted == got[label]).mean()) >= least and got.score.between(0, 1).all()
    scored = module.score(frame(odd), model)
    rows = scored.collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert "N_Words" in scored.columns and scored.columns.count("score") == 1
    assert module.score(frame([]), model).count() == 0
    # No labels, or one kind only: one score for all.
    few = spark.createDataFrame([(0, None, None), (None, 1, 1), (1, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert len({r.score for r in module.score(frame(odd), module.fit(frame(odd), few)).collect()}) == 1


def test_ranking_uses_every_row(spark, monkeypatch):
    """Sums over all rows: every row has pairs, a rare label in every block; cut as the quantile of all scores."""
    rng = np.random.default_rng(3)
    y = np.array([1] * 150 + [0] * 10)
    x = np.round(rng.normal(size=(160, 3)) + y[:, None], 2)
    x[5] = x[6]
    rows = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)], "_x array<double>, _label int").repartition(3)
    monkeypatch.setattr(quality, "BLOCK_ROWS", 16)
    monkeypatch.setattr(quality, "MIN_RARE", 4)
    made, seen = [], quality._blocks
    monkeypatch.setattr(quality, "_blocks", lambda *a: made.append(seen(*a)) or made[0])
    model = quality.rank(rows, 3)
    width = model.edges.size
    want = {(int(k), bytes(b)) for k, b in zip(y, np.packbits(quality.binned(x, model.edges).astype(bool), axis=1))}
    got = set()
    for r in made[0].collect():
        raw = np.frombuffer(r.bits, np.uint8).reshape(len(r.counts), -1)
        assert 0 < r.good < len(raw) and len(raw) - r.good >= 1
        got |= {(int(i < r.good), bytes(b)) for i, b in enumerate(raw)}
    assert made[0].count() > 5 and got == want
    scores = model.scores(x)
    assert abs(model.cut - np.quantile(scores, 10 / 160)) < 0.01
    # Value and gradient of the loss by hand, over the pairs of each block.
    w, total = rng.normal(size=width), np.zeros(width + 2)
    for r in made[0].collect():
        b = np.unpackbits(np.frombuffer(r.bits, np.uint8).reshape(len(r.counts), -1), axis=1, count=width).astype(float)
        for i in range(r.good):
            for j in range(r.good, len(b)):
                n, d = r.counts[i] * r.counts[j], b[i] - b[j]
                total += np.concatenate([[n, n * np.log1p(np.exp(-d @ w))], -n * d / (1 + np.exp(d @ w))])
    np.testing.assert_allclose(training.totals(made[0], width + 2, quality._pair_loss, w), total, rtol=1e-5, atol=1e-4)


def test_lexicon_weights_from_all_rows(spark, frame):
    """More labelled rows than any bound in the code: counts, and the gradient's zero, by hand."""
    rng = random.Random(8)
    y = [int(rng.random() < 0.3) for _ in range(400)]
    texts = ["".join(rng.choices(["calm ", "day ", "grim "], k=5)) + ("zonk " if rng.random() < (0.8 if k else 0.05) else "") for k in y]
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != training.HELD_OUT][:400]
    labels = spark.createDataFrame(list(zip(ids, y)), "doc_id bigint, toxic int")
    model = toxicity.fit(frame(texts, ids), labels)
    assert list(model.weights) == [" zonk "]
    hit = np.array(["zonk" in t for t in texts])
    scale = np.array([len(t.split()) ** -0.5 for t in texts])
    z = hit * model.weights[" zonk "] * scale + model.curve[1]
    slip = 1 / (1 + np.exp(-z)) - np.array(y)
    assert abs(slip.sum()) < 0.5 and abs((slip * hit * scale).sum()) < 0.5


def test_folding():
    for raw in ("SТUРID", "stυpid", "ѕtupid", "5tup1d", "$tupid", "stúpid", "s​tupid", "stup!d"):
        assert " stupid " in toxicity.folded(f"you {raw}, no"), raw
    assert toxicity.folded("in 2024 at 10") == " in 2024 at 10 "


def test_exceptions_cancel():
    machine = toxicity.automaton({" trash ": 2.0, " chlla": 1.0}, [" trash can "])
    assert [m[1] for m in toxicity.matches(machine, " the trash can of chllado trash ")] == [" chlla", " trash "]


TEXTS = ["It's 12 o'clock, DON'T we'll  café naïve Über", "x<|endoftext|>y", "İstanbul ΣΣ 你好 \U0001f600‍!", "áé  b c", "foo\x1cbar \x1d", "1234 5,6", "''s 's's", "#@$%!? ...", "ǅ ŉ ſ", ""]


def test_encoder_agrees_with_tokenizer():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    own, his = Encoder(path), Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choices("abcdefghiklmnoprstuvwz'!,. \n0123456789éßÄŁ", k=400)) for _ in range(60)]
    for _ in range(2):
        for t, ids in zip(texts, own.encode([t.encode() for t in texts])):
            assert np.frombuffer(ids, "<u4").tolist() == his.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12))
def test_supersteps(counts):
    plan = packing.supersteps(counts, 64)
    used, at = defaultdict(list), []
    for (length, rank, first, per, offset), after in zip(plan.tolist(), [*plan.tolist()[1:], None]):
        last = after[1] if after and after[0] == length else counts[length]
        for r in range(rank, last):
            used[first + (r - rank) // per].append((offset + (r - rank) % per * length, length))
            at.append(length)
    assert sorted(at) == sorted(x for x, n in counts.items() for _ in range(n))
    for own in used.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64
    # As many sequences as best fit decreasing, one piece after the other.
    gaps: list[int] = []
    for length in sorted(at, reverse=True):
        fit = [g for g in gaps if g >= length]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else 64) - length)
    assert len(used) == len(gaps)


def test_packing(spark, frame, odd):
    from tokenizers import Tokenizer

    his = Tokenizer.from_file(packing.tokenizer_path())
    texts, ids = [*odd, odd[6]], [*range(len(odd)), 6]
    got = packing.pack(frame(texts, ids), keep_ids=True).toPandas()
    want = sorted((i, k // 2048, k) for i, t in zip(ids, texts) for k in range(0, len(his.encode(t or "", add_special_tokens=False).ids) + 1, 2048))
    assert sorted(zip(got.doc_id, got.piece, got.start)) == want
    for r in got.itertuples():
        full = np.array(his.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0], "<u4")[r.start : r.start + 2048]
        assert full.tobytes() == r.ids and zlib.crc32(r.ids) == r.ids_crc32 and len(full) == r.length
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.length.cumsum() - s.length).tolist() == s.offset.tolist() and s.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack(frame([])).count() == 0


def test_merkle_audit(spark):
    pages = [(i, f"u{i}", f"page {i}" * (i % 7)) for i in range(700)] + [(None, None, None), (3, "u3", "again")]
    replica = [p for p in pages if p[0] != 50]
    replica[200] = (replica[200][0], "u", "changed")
    replica[699] = (replica[699][0], replica[699][1], "gone")
    replica += [(9000, "new", "page"), (3, "u3", "third")]
    make = lambda rows: spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.id: r for r in warc.audit(make(pages), make(replica), fanout=4).collect()}
    changed = {replica[200][0], replica[699][0], 3}
    assert {i: r.status for i, r in found.items()} == {50: "missing", 9000: "extra", **{i: "changed" for i in changed}}
    assert found[50].offset > 0 and found[9000].offset is None
    assert warc.audit(make(pages), make(pages)).count() == 0
    assert warc.audit(make([]), make([])).count() == 0 and warc.audit(make([]), make(pages[:2])).count() == 2


def test_sharding(spark, frame, odd):
    rng = random.Random(8)
    texts = [*odd, *["copy of a copy"] * 300, *["".join(rng.choices("abc ", k=rng.randint(1, 400))) for _ in range(900)]]
    ids = [*range(len(texts) - 2), None, 5]
    got = kdshard.digest(kdshard.assign(frame(texts, ids), shards=24)).toPandas()
    assert len(got) == len(texts) and set(got.shard) <= set(range(24)) and (got.law == "bytes").all()
    sizes = sorted(len((t or "").encode()) + 8 for t in texts)
    assert sorted(got["size"]) == sizes
    assert sorted(got.text_crc32) == sorted(zlib.crc32((t or "").encode()) for t in texts)
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    total = got.groupby("shard")["size"].sum()
    assert total.drop(total.idxmax()).max() <= 1.1 * sum(sizes) / 24 + max(s for s in sizes if s < 9000)
    assert kdshard.assign(frame([]), shards=24).count() == 0
    assert kdshard.assign(frame(texts[:30]), target_bytes=10**9).select("shard").distinct().count() == 1


def test_sharding_keeps_copies_together(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = kdshard.digest(kdshard.assign(docs, shards=4, share=0.5)).toPandas()
    assert (got.groupby(["text_crc32", "size"]).shard.nunique() == 1).all()
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() <= 1.15 * sizes.min()


def test_ordered(spark):
    df = spark.range(1000).selectExpr("id % 7 as a", "id as b").repartition(5)
    got = ordered(df, [df["a"], df["b"]]).orderBy("row_index").collect()
    assert [(r.a, r.b) for r in got] == sorted((i % 7, i) for i in range(1000)) and [r.row_index for r in got] == list(range(1000))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names
        docs = spark.createDataFrame(out.toPandas(), out.schema)
        assert docs.count() <= before and (name == "repeats") <= (docs.count() == before)
        if name == "quality":
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            right = [(i in kept) == (q == 1) for i, q in labels.items()]
            assert sum(right) >= 0.9 * len(right)
        if name == "repeats":
            assert docs.where("n_chars <> char_length(text)").count() == 0
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.decontaminate(docs, bench).where("contaminated").count() == 0
    packed = corpus_pipeline.packing_stage(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_queries_have_contract_columns(spark):
    want = {
        "op4_order_minhash": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
        "op7_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
        "op10_kd_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    }
    for name, columns in want.items():
        assert columns <= set(queries.QUERIES[name](spark, SF).columns)


def test_sharding_splits_only_groups_larger_than_a_shard(spark):
    rows = [(k, "w%d " % k * 30) for k in range(200)] + [(1000 + k, "middle " * 150) for k in range(12)] + [(2000 + k, "large " * 100) for k in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    text = dict(rows)
    placed = kdshard.assign(docs, 6).collect()
    mean = sum(r.size for r in placed) / 6
    homes, size = {}, {}
    for r in placed:
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
        size[text[r.doc_id]] = size.get(text[r.doc_id], 0) + r.size
    assert sorted(r.doc_id for r in placed) == sorted(text)
    assert size["middle " * 150] < mean < size["large " * 100]
    assert {t for t, h in homes.items() if len(h) > 1} == {"large " * 100}
    assert max(sum(r.size for r in placed if r.shard == k) for k in range(6)) < 1.35 * mean
