import math
import zlib
from collections import Counter

import numpy as np
import pytest

from foliant.llm import lm_score as L


def base_scores(docs):
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    counts = Counter()
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, {i: (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for i, t in docs}


@pytest.mark.parametrize("sent", [200_000, 3])
def test_counts_and_base(spark, sent):
    docs = [(i, " ".join(f"W{(i * k) % 37}" for k in range(i))) for i in range(40)] + [(50, None), (51, ""), (52, "é É\tx y"), (53, "rare " * 3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as c", "'w' as word")
    n, want = base_scores(docs)
    rows = L.lm_score(df, sent_words=sent).collect()
    assert len(rows) == len(docs)
    for r in rows:
        size, known, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (size, known, n, zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    w = L.Weights(rng.normal(size=(L.CLASSES, L.WIDTH)), rng.normal(size=(L.WIDTH, L.WIDTH)), rng.normal(size=(L.WIDTH, L.WIDTH)), rng.normal(size=L.CLASSES))
    t = L.tables(w)
    for far, near in ((0, 0), (3, 50), (63, 17)):
        scores = t.near[near] + t.far[far] + t.b - t.log_z[far, near]
        assert np.exp(scores).sum() == pytest.approx(1)
        q = w.r[near] @ w.one + w.r[far] @ w.two
        assert scores == pytest.approx(np.log(np.exp(q @ w.r.T + w.b) / np.exp(q @ w.r.T + w.b).sum()))


def test_learns_order():
    """After class 1 comes 2, after 2 comes 1: a unigram can't know."""
    text = np.array([1, 2] * 500)
    c = np.concatenate([[0, 0], text])
    codes = (c[:-2] * L.CLASSES + c[1:-1]) * L.CLASSES + c[2:]
    unigram = np.full(L.CLASSES, 0.5 / L.CLASSES)
    unigram[[1, 2]] += 0.25
    trainer, rng = L.ClassTrainer(unigram), np.random.default_rng(0)
    for _ in range(400):
        trainer.step(codes[rng.integers(0, len(codes), 1024)])
    model = L.tables(trainer.result())
    assert model.log_probabilities(text).mean() > np.log(unigram[1]) + 0.4


def test_better_than_unigrams(spark):
    rows = [(i, " ".join(w for _ in range(40) for w in (("the", "cat", "sat") if i % 2 else ("der", "hund", "lief")))) for i in range(200)]
    out = L.lm_score(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 0.8


def test_empty(spark):
    assert L.lm_score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def lexicon_of(words, n=400, sent=None):
    """A corpus of ``words`` with falling counts; only the first ``sent`` have a place."""
    rows = [(b"", 50), *((w, n - k // 2) for k, w in enumerate(words))]
    return L.Lexicon(rows[: sent or len(rows)], sum(c for _, c in rows), len(rows))


@pytest.mark.parametrize("sent", [None, 400])
def test_every_word_has_vectors_and_probabilities_sum_to_one(sent):
    words = [f"w{k:03}".encode() for k in range(600)]
    lex = lexicon_of(words, sent=sent)
    rng = np.random.default_rng(2)
    model = L.Words(lex, L.Weights.of(rng.normal(size=L.start(lex.unigram).flat().shape)))
    assert len(model.u) > len(lex.place) - L.CLASSES and len(model.v) > len(lex.place) - L.CLASSES
    model.u[:-1] = rng.normal(size=model.u[:-1].shape)
    model.v[:] = rng.normal(size=model.v.shape)
    every = np.array([*range(len(lex.place)), -1])
    for far, near in ((0, 0), (3, 300), (350, 17), (390, 399), (-1, -1)):
        p = np.exp([model.log_probabilities(np.array([far, near, w]))[0] for w in every])
        assert p.sum() == pytest.approx(1, abs=1e-5)
    # other contexts of the last class give other probabilities, of its words and of classes
    a, b = (model.log_probabilities(np.array([0, near, 310]))[0] for near in (301, 302))
    c, d = (model.log_probabilities(np.array([0, near, 5]))[0] for near in (301, 302))
    assert a != pytest.approx(b) and c != pytest.approx(d)


def test_starts_at_the_frequencies():
    lex = lexicon_of([f"w{k:03}".encode() for k in range(600)], sent=400)
    model = L.Words(lex, L.start(lex.unigram))
    got = model.log_probabilities(np.array([0, 0, 300])) - model.log_probabilities(np.array([0, 0, 390]))
    assert got == pytest.approx([math.log(10) * (lex.log_c[300] - lex.log_c[390])], abs=1e-4)


def test_learns_order_of_rare_words(spark):
    """Of 600 words each first one has its follower; both are beyond the classes."""
    rng = np.random.default_rng(3)
    pairs = [(f"aa{k:03}", f"zz{(7 * k) % 300:03}") for k in range(300)]
    rows = [(i, " ".join(w for k in rng.integers(0, 300, 200) for w in pairs[k])) for i in range(300)]
    out = L.lm_score(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 0.93


def test_without_training_documents(spark):
    docs = [(i, "some words") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1] + [(2, None)] * (zlib.crc32(b"2") % 5 == 1)
    n, want = base_scores(docs)
    assert n == 0
    for r in L.lm_score(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        assert (r.train_tokens, r.n_known) == (0, 0)
        assert r.base_score == pytest.approx(want[r.doc_id][2]) == pytest.approx(0)
        assert math.isfinite(r.score)


def test_equal_scores_at_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(L, "REPLICA_TOKENS", 100_000)  # three replicas
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = []
    for n in (1, 8, 32):
        rows = L.lm_score(docs.repartition(n)).collect()
        got.append({r.doc_id: r.score for r in rows})
        held = [r for r in rows if r.held_out]
        gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held) * math.log2(10)
        assert gain > 0.4  # bits a token beside unigrams
    for other in got[1:]:
        assert other == pytest.approx(got[0], rel=1e-4)
