import random

import numpy as np
import pytest

from foliant.llm import near_dedup as N
from foliant.llm.components import components


def shingle_set(text, size):
    words = N.lower_words(text)
    size = min(size, len(words))
    return frozenset(zip(*(words[k:] for k in range(size)))) if words else frozenset()


def brute(docs, size, percent=80):
    sets = [(i, shingle_set(t, size)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a < b and s and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed, families, copies):
    rng = random.Random(seed)
    docs = []
    for _ in range(families):
        base = [f"w{rng.randint(0, 900)}" for _ in range(rng.randint(30, 150))]
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 8))):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
            docs.append(" ".join(w))
    docs += ["", "   ", None, "One", "one", "one two", "ONE TWO", "one two three", "a b a b a b", "a b a"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("size", "families", "copies"), [(2, 20, 6), (5, 20, 6), (2, 1, 150)])
def test_against_brute_force(spark, monkeypatch, size, families, copies):
    docs = corpus(size + families, families, copies)
    if copies > 100:  # several blocks of one bucket
        monkeypatch.setattr(N, "BLOCK", 40)
        docs = corpus(9, 1, 1) + [(1000 + i, t) for i, t in corpus(3, 1, 200)]
        docs += [(3000 + i, t) for i, t in corpus(3, 1, 250)]
    df = spark.createDataFrame([*docs, docs[3]], "doc_id long, text string").selectExpr("*", "1 as node", "'k' as key", "2 as component_id")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_dedup(df, size=size).collect()}
    assert got == brute(docs, size)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in N.near_dedup(df).collect() if r.n_shingles) == [(0, 5, False), (5, 5, True)]
    assert N.near_dedup(df.limit(0)).count() == 0


def test_coordinates_are_shifts():
    first, around = N.circle()
    short, long = N.coordinates(N.COORDINATES), N.coordinates(N.LONG)
    assert (short[7] == around[7 : 7 + N.COORDINATES]).all()
    assert (long[N.CIRCLE - 1, 1:5] == around[:4]).all()
    h = N.shingle_hashes(N.lower_words("a b c d e f g"), 2)
    assert (N.signature(h, N.LONG)[: N.COORDINATES] == N.signature(h)).all()


def test_agreement_estimates_similarity():
    rng = random.Random(5)
    w = [f"w{i}" for i in range(400)]
    s, t = (N.shingle_hashes([x.encode() for x in v], 1) for v in (w, [*w[:320], *(f"y{rng.random()}" for _ in range(80))]))
    agree = (N.signature(s, N.LONG) == N.signature(t, N.LONG)).mean()
    assert abs(agree - 320 / 480) < 0.05


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}


def test_family_with_outliers(spark, monkeypatch):
    """A bucket of one large component and many documents that are similar to it, some just enough, some not."""
    monkeypatch.setattr(N, "BLOCK", 50)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for k in range(260):
        w = list(base)
        for _ in range(2 if k < 150 else rng.randint(4, 12)):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        docs.append((k, " ".join(w)))
    rng.shuffle(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(sorted(docs), 2)


def test_equal_sets_of_different_sequences(spark):
    docs = [(3, "a b a b a"), (2, "a b a b a b a"), (9, "A B a b a"), (5, "b a b a"), (7, "a b c")]
    got = {r.doc_id: r.component_id for r in N.near_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {3: 2, 2: 2, 9: 2, 5: 2, 7: 7}


def test_very_long_word_and_blank_rows(spark):
    docs = [(1, "x" * 300_000), (2, "x" * 300_000), (3, " \n "), (4, None), (5, "\u00a0")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (1, 5)}


def test_components_of_null_links(spark):
    assert components(spark.createDataFrame([(None, 1), (1, None), (None, None)], "a long, b long")).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_numbered_shingles_are_the_sets(monkeypatch, size):
    rng = random.Random(size)
    texts = [" ".join(rng.choice("abcdE") * rng.randint(1, 2) for _ in range(rng.choice([0, 1, 2, 4, 9, 30]))) for _ in range(40)]
    numbered = N.Numbered(size)
    for x in texts:
        for y in texts:
            s, t = shingle_set(x, size), shingle_set(y, size)
            assert len(numbered(x)[1]) == len(s)
            assert N.similar(numbered(x), numbered(y), 60) == (100 * len(s & t) >= 60 * len(s | t))
    # new numberings on the way change nothing
    monkeypatch.setattr(N, "MOST_WORDS", 3)
    rows = [(i, j, x, y) for i, x in enumerate(texts) for j, y in enumerate(texts)]
    batch = N.pa.RecordBatch.from_arrays([N.pa.array(c) for c in zip(*rows, strict=True)], ["a", "b", "x", "y"])
    got = {(r["a"], r["b"]) for out in N._verified(iter([batch]), size, 80) for r in out.to_pylist()}
    assert got == {(i, j) for i, j, x, y in rows if 100 * len(shingle_set(x, size) & shingle_set(y, size)) >= 80 * len(shingle_set(x, size) | shingle_set(y, size))}
