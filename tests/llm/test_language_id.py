import numpy as np
import pytest

from foliant.llm import language_id as G


def segmentations(word, pieces):
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1) if n == 1 or word[:n] in pieces for rest in segmentations(word[n:], pieces)]


@pytest.fixture(scope="module")
def vocab():
    return G.vocabulary(None)


def test_forward_sums_all_segmentations(vocab):
    rng = np.random.default_rng(2)
    c = rng.random((vocab.size, 3))
    p = G._probabilities(c)
    known = {w: i for i, w in enumerate(vocab.pieces)}
    words = ["the", "haus", "él", "ñandú", "漢字", "straße", "tion"]
    got = G.log_probabilities(words, vocab, p)
    for w, row in zip(words, got, strict=True):
        total = sum(np.prod([p[known.get(s, vocab.size - 1)] for s in parts], axis=0) for parts in segmentations(G.MARK + w, known))
        assert row == pytest.approx(np.log(total))


def test_expected_counts(vocab):
    p = G._probabilities(np.random.default_rng(3).random((vocab.size, 2)))
    known = {w: i for i, w in enumerate(vocab.pieces)}
    words, langs, weights = ["there", "und"], np.array([1, 0]), np.array([2.0, 3.0])
    want = np.zeros((vocab.size, 2))
    for w, lang, n in zip(words, langs, weights, strict=True):
        ways = [[known.get(s, vocab.size - 1) for s in parts] for parts in segmentations(G.MARK + w, known)]
        mass = np.array([np.prod(p[way, lang]) for way in ways])
        for way, share in zip(ways, mass / mass.sum(), strict=True):
            np.add.at(want[:, lang], way, n * share)
    assert G.expected_counts(words, langs, weights, vocab, p) == pytest.approx(want)


def test_long_words_stay_finite(vocab):
    got = G.log_probabilities(["ab" * 4000, "x"], vocab, G._start(vocab, 2))
    assert np.isfinite(got).all()


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = G.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in out)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "the house of the king", "en"), (2, "das haus und der hund", "de"), (3, None, "en"), (4, "", None), (5, "123 !?", "de"), (6, "the king", None), (1, "the house of the king", "en"), (None, "der hund", "de")], "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as word")
    rows = [(r.doc_id, r.lang_pred) for r in G.language_id(docs).collect()]
    assert len(rows) == 8
    assert {(3, "und"), (4, "und"), (5, "und")} <= set(rows)
    empty = docs.limit(0)
    assert G.language_id(empty).count() == 0
    assert {r.lang_pred for r in G.language_id(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


def test_every_piece_is_found(vocab):
    keys = np.array([vocab._hash(p) for p in vocab.pieces], np.uint64)
    assert (vocab.find(keys) == np.arange(len(keys))).all()


def test_only_letters_are_words():
    assert G.words_of("½ ² ① Ⅷ 12 _") == []
    assert G.words_of("x²y Straße½ ÉTÉ 漢字") == ["x", "y", "straße", "été", "漢字"]
    assert [len(w) for w in G.words_of("a " + "b" * 600)] == [1, 256, 256, 88]


def test_texts_without_letters_and_a_very_long_word(spark):
    docs = spark.createDataFrame([(1, "the house of the king", "en"), (2, "der hund und die katze", "de"), (10, "½ ² ①", None), (11, "4711 Ⅷ", "de"), (12, "ab" * 100_000, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in G.language_id(docs).collect()}
    assert got[10] == got[11] == ("und", 0.0)
    assert 0 <= got[12][1] <= 1
