import itertools
import random
import time
import zlib

import numpy as np
import pytest

from foliant.llm import toxicity as T


@pytest.fixture(scope="module")
def decoder():
    counts = np.zeros(T._N**4)
    for word, n in {"idiot": 30, "moron": 30, "stupid": 30, "clown": 30, "house": 30, "street": 30, "table": 30}.items():
        for g in T.grams(word):
            counts[g] += n
    return T.Decoder(T.smoothed(counts).tolist())


@pytest.mark.parametrize(("written", "meant"), [("1d10t", "idiot"), ("m0r0n", "moron"), ("$tup1d", "stupid"), ("c.l.o.w.n", "clown"), ("s-t-u-p-i-d", "stupid"), ("idiooooot", "idiot"), ("cl0wn!!", "clown"), ("h0use", "house")])
def test_decoding(decoder, written, meant):
    assert meant in T.readings(written, decoder)


def test_plain_words_stay(decoder):
    assert T.readings("Street,", decoder) == ["street"]
    assert T.readings("***", decoder) == []
    assert T.readings("on-line", decoder)[:2] == ["on", "line"]


def test_model_is_a_distribution():
    p = np.exp(T.smoothed(np.random.default_rng(1).random(T._N**4))).reshape(-1, T._N)
    assert p.sum(axis=1) == pytest.approx(1, abs=1e-3)


def test_held_out(spark):
    rng = np.random.default_rng(4)
    plain = [f"{a}{b}" for a in "bcdfgklm" for b in ("an", "el", "ir", "on")]
    docs, labels = [], []
    for i in range(600):
        w = list(rng.choice(plain, 40))
        if bad := i % 6 == 0:
            w[3], w[20] = ("idiot", "moron") if i % 5 else ("1diot", "m o r o n")
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs += [(1000, None), (1001, ""), (None, "idiot moron"), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as toxic", "'f' as feature")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    rows = T.toxicity(df, marks).collect()
    assert len(rows) == len(docs)
    truth = dict(labels)
    for r in rows:
        if r.doc_id in truth:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.predicted == truth[r.doc_id], r
        assert 0 <= r.score <= 1
    assert {r.predicted for r in rows if r.doc_id in (1000, 1001)} == {0}


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in T.toxicity(docs, marks).collect()] in ([0, 0], [1, 1])
    assert T.toxicity(docs.limit(0), marks).count() == 0


@pytest.mark.parametrize(("written", "meant"), [("+able", "table"), ("(lown", "clown"), ("<lown", "clown"), ("¡diot", "idiot"), ("$tupid!", "stupid"), ("idio+", "idiot"), ("iidiot", "idiot"), ("cclown", "clown"), ("stuppid", "stupid"), ("(moron)", "moron"), ("house!", "house")])
def test_edge_signs_and_doubled_letters(decoder, written, meant):
    assert meant in T.readings(written, decoder)


def test_doubled_words_stay_beside_the_restored(decoder):
    assert T.readings("Street,", decoder)[0] == "street"
    assert T.readings("iidiot", decoder)[0] == "iidiot"


def test_decoding_is_exact(decoder):
    """No reading of the whole lattice costs less."""
    rng = random.Random(3)
    signs = "idotmrnsuplcw10$@|!(+.-_ e3457aa"
    for _ in range(300):
        word = "".join(rng.choice(signs) for _ in range(rng.randint(1, 7)))
        least, best = None, set()
        for arcs in itertools.product(*(decoder._arcs(word, k) for k in range(len(word)))):
            text, cost = "".join(x for x, _ in arcs), sum(c for _, c in arcs)
            cost -= sum(decoder.table[g] for g in T.grams(text))
            if least is None or cost < least - 1e-9:
                least, best = cost, {text}
            elif cost < least + 1e-9:
                best.add(text)
        assert decoder.decode(word) in best, word


def test_very_long_tokens(decoder):
    rng = random.Random(4)
    began = time.time()
    for signs in ("ab1$", "=", "aab", "0123456789@$!|+"):
        word = "".join(rng.choice(signs) for _ in range(20_000))
        assert isinstance(T.readings(word, decoder), list)
    assert time.time() - began < 60


def test_very_long_token_in_a_table(spark):
    docs = spark.createDataFrame([(1, "1" * 50_000), (2, "a b"), (4, "idiot")], "doc_id long, text string")
    marks = spark.createDataFrame([(2, 0), (4, 1)], "doc_id long, toxic int")
    assert {r.doc_id for r in T.toxicity(docs, marks).collect()} == {1, 2, 4}


def test_labelled_documents(spark):
    """Of the held-out fold of a table with some thousand labels, toxic documents are found and clean ones are not."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = T.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)  # some are marked without a word that says so
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.02 * len(rows)


def test_shortcut_loses_no_reading(decoder):
    """Tokens that are passed over have no weighted feature in any reading."""
    rng = random.Random(6)
    weights = {"idiot": 2.0, "stup*": 1.0, "moron": 3.0, "cll*": 1.0, "oo": 1.5}
    scorer = T.Scorer(T.Model(weights, np.array(decoder.table), np.zeros(4)))
    words = ["idiot", "stupid", "moron", "clown", "oo", "house"]
    for _ in range(3000):
        word = "".join(c * rng.choice((1, 1, 1, 2, 3)) for c in rng.choice(words))
        token = rng.choice(("", "(", "'", "*")) + word + rng.choice(("", ",", "!", ")."))
        want = [(w, max(f)) for w in T.readings(token, scorer.decoder) if (f := [weights[x] for x in T.features(w) if x in weights])]
        assert list(scorer._hits(token)) == want
