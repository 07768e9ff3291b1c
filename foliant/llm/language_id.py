"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have probabilities in each language. A word's
probability is the sum over all ways to cut it into pieces (the forward algorithm), not
that of one tokenisation; a text's is the product over its words. Probabilities come
from expectation maximisation: expected counts of pieces over all segmentations
(forward and backward), summed over the corpus of each language.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, materialise, only

#: Documents that the piece probabilities are fitted on, chosen by a hash of their ids.
SAMPLE_ROWS = 6_000
ROUNDS = 3
#: Longest piece in characters, with the mark of a word's beginning.
LONGEST = 16
#: Expected count that every piece has beforehand.
PRIOR = 0.05
#: Cached words of a worker, and words that one step handles.
CACHE, STEP = 300_000, 20_000
#: Letters of a word at most; longer runs are no words of a language.
LONG_WORD = 256
#: Texts of so many words or more keep their evidence a word, so that scores stay below one.
TEMPERED = 30

_RUNS = re.compile(r"[^\W\d_]+").findall
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20
MARK = "▁"


def words_of(text: str | None) -> list[str]:
    """Runs of letters (Unicode's L categories) in lower case: fractions, circled and Roman numerals are none.

    Runs of more than ``LONG_WORD`` letters are taken as words of that length, one after the other.
    """
    if not text:
        return []
    runs = _RUNS(text.lower())
    if not text.isascii():
        runs = [w for run in runs for w in ((run,) if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]
    if max(map(len, runs), default=0) > LONG_WORD:
        runs = [w[i : i + LONG_WORD] for w in runs for i in range(0, len(w), LONG_WORD)]
    return runs


class Pieces:
    """The vocabulary as a hash table of substrings."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.pieces = sorted({p.lower() for p in found if 0 < len(p) <= LONGEST and all(c == MARK or c.isalpha() for c in p.lower())})
        #: the last number stands for any single character
        self.size = len(self.pieces) + 1
        self.powers = self._powers()
        keys = np.array([self._hash(p) for p in self.pieces], np.uint64)
        slots = self._slot(keys)
        self.keys = np.append(keys, np.uint64(0))
        #: as many tables as the fullest slot has pieces, so that no piece is lost
        self.tables = [np.full(1 << _SLOTS, -1, np.int32) for _ in range(np.bincount(slots).max(initial=1))]
        for i, s in enumerate(slots.tolist()):
            next(t for t in self.tables if t[s] < 0)[s] = i

    @staticmethod
    def _powers() -> np.ndarray:
        out = np.ones(LONGEST + 2, np.uint64)
        for k in range(1, len(out)):
            out[k] = int(out[k - 1]) * int(_BASE) & 0xFFFFFFFFFFFFFFFF
        return out

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes; -1 for none."""
        slots = self._slot(keys)
        out = np.full(keys.shape, -1, np.int32)
        for k, table in enumerate(self.tables):
            i = table[slots]
            if k == 0:
                out = np.where((i >= 0) & (self.keys[i] == keys), i, out)
            elif len(at := np.flatnonzero(i >= 0)):  # few slots hold more than one piece
                at = at[self.keys[i[at]] == keys[at]]
                out[at] = i[at]
        return out


@functools.cache
def vocabulary(path: str | None) -> Pieces:
    import public_tokenizers

    return Pieces(path or public_tokenizers.path("piece_bpe_32k.model"))


class Lattice(NamedTuple):
    """All pieces in words of one length: number of the piece, or -1, from each place and of each size."""

    n: int
    pieces: dict[tuple[int, int], np.ndarray]


def lattice(words: list[str], vocab: Pieces) -> Lattice:
    """Words of equal length, without their marks."""
    text = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64) + np.uint64(1)
    n = text.shape[1]
    prefix = np.zeros((len(words), n + 1), np.uint64)
    for k in range(n):
        prefix[:, k + 1] = prefix[:, k] * _BASE + text[:, k]
    found = {}
    for size in range(1, min(LONGEST, n) + 1):
        for at in range(n - size + 1):
            got = vocab.find(prefix[:, at + size] - prefix[:, at] * vocab.powers[size])
            if size == 1:
                got = np.where(got < 0, vocab.size - 1, got)
            elif (got < 0).all():
                continue
            found[at, size] = got
    return Lattice(n, found)


def forward(grid: Lattice, p: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Scaled sums over segmentations up to each place [word, language], and logs of their scales.

    ``p``: piece by language, with a last row of zeros for -1.
    """
    rows, langs = next(iter(grid.pieces.values())).shape[0], p.shape[1]
    alpha = [np.ones((rows, langs))]
    scale = np.zeros((grid.n + 1, rows, langs))
    for end in range(1, grid.n + 1):
        total = np.zeros((rows, langs))
        for size in range(1, min(LONGEST, end) + 1):
            if (got := grid.pieces.get((end - size, size))) is not None:
                total += alpha[end - size] * np.exp(scale[end - size] - scale[end - 1]) * p[got]
        norm = np.maximum(total, 1e-300)
        scale[end] = scale[end - 1] + np.log(norm)
        alpha.append(total / norm)
    return alpha, scale


def log_probabilities(words: list[str], vocab: Pieces, p: np.ndarray) -> np.ndarray:
    """log P(word) for each word and language."""
    out = np.empty((len(words), p.shape[1]))
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    for n, at in by_length.items():
        step = max(1, STEP * 8 // (n + 1))
        for i in range(0, len(at), step):
            part = at[i : i + step]
            out[part] = forward(lattice([words[k] for k in part], vocab), p)[1][-1]
    return out


def expected_counts(words: list[str], langs: np.ndarray, weights: np.ndarray, vocab: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected piece counts [piece, language] over all segmentations of weighted words."""
    counts = np.zeros(vocab.size * p.shape[1])
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w), []).append(k)
    for n, at in by_length.items():
        step = max(1, STEP * 8 // (n + 1))
        for i in range(0, len(at), step):
            part = np.array(at[i : i + step])
            lang, weight = langs[part], weights[part]
            grid = lattice([words[k] for k in part], vocab)
            rows = np.arange(len(part))
            own = lambda got: p[got, lang]  # noqa: B023, E731
            # one language a word: plain sums suffice here, a word is short or scaled by its length
            alpha, scale = [np.ones(len(part))], np.zeros((grid.n + 1, len(part)))
            for end in range(1, grid.n + 1):
                total = np.zeros(len(part))
                for size in range(1, min(LONGEST, end) + 1):
                    if (got := grid.pieces.get((end - size, size))) is not None:
                        total += alpha[end - size] * np.exp(scale[end - size] - scale[end - 1]) * own(got)
                norm = np.maximum(total, 1e-300)
                scale[end] = scale[end - 1] + np.log(norm)
                alpha.append(total / norm)
            # beta[k]: log sum over segmentations from k on
            beta = np.full((grid.n + 1, len(part)), -np.inf)
            beta[grid.n] = 0
            for start in range(grid.n - 1, -1, -1):
                for size in range(1, min(LONGEST, grid.n - start) + 1):
                    if (got := grid.pieces.get((start, size))) is not None:
                        with np.errstate(divide="ignore"):
                            beta[start] = np.logaddexp(beta[start], np.log(own(got)) + beta[start + size])
            for (start, size), got in grid.pieces.items():
                with np.errstate(divide="ignore"):
                    share = np.exp(np.log(alpha[start]) + scale[start] + np.log(own(got)) + beta[start + size] - scale[grid.n])
                ok = (got >= 0) & np.isfinite(share)
                counts += np.bincount(got[ok] * p.shape[1] + lang[rows[ok]], share[ok] * weight[ok], len(counts))
    return counts.reshape(vocab.size, p.shape[1])


class Model(NamedTuple):
    langs: list[str]
    p: np.ndarray
    path: str | None


def _probabilities(counts: np.ndarray) -> np.ndarray:
    """By language, with a prior on every piece; the last row is for no piece."""
    c = counts + PRIOR
    return np.vstack([c / c.sum(axis=0), np.zeros(c.shape[1])])


def _start(vocab: Pieces, langs: int) -> np.ndarray:
    """Every piece alike, but for the single characters that are none."""
    c = np.ones((vocab.size, langs))
    c[-1] = 1e-3 * vocab.size
    return _probabilities(c)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, path: str | None = None, rounds: int = ROUNDS) -> Model:
    """Fits on about ``sample_rows`` documents of folds 1 to 4 with a text and a language.

    The driver gets sums by piece and language only; each round is one pass over the
    words of the sample, which stay with the executors.
    """
    spark = docs.sparkSession
    rows = only(docs, doc_id="bigint", text="string", lang="string").filter(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 0))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((1, 0)), path)
    # the same number of documents of each language where there are enough
    each = max(1, sample_rows // len(langs))
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, int(min(1.0, each / sizes[lang]) * (1 << 20)))])
    rows = rows.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 20)) < share[F.col("lang")])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            out = [(lang, w, n) for lang, c in by_lang.items() for w, n in c.items()]
            a, b, c = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.int64())], ["lang", "word", "n"])

    words = rows.select("text", "lang").mapInArrow(counted, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialise(words, "language-words")
    vocab = vocabulary(path)
    p = _start(vocab, len(langs))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(p)

        def expected(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            place, own = {lang: k for k, lang in enumerate(langs)}, vocabulary(path)
            counts = np.zeros((own.size, len(langs)))
            for batch in batches:
                which = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
                counts += expected_counts(batch.column(1).to_pylist(), which, np.array(batch.column(2).to_pylist(), float), own, sent.value)
            flat = counts.ravel()
            at = np.flatnonzero(flat > 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["cell", "n"])

        counts = np.zeros(vocab.size * len(langs))
        for r in words.mapInArrow(expected, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():  # pieces times languages at most
            counts[r.cell] = r.n
        p = _probabilities(counts.reshape(vocab.size, len(langs)))
    return Model(langs, p, path)


class Predictor:
    def __init__(self, model: Model) -> None:
        self.model, self.vocab = model, vocabulary(model.path)
        self.known: dict[str, int] = {}
        self.values = np.empty((0, len(model.langs)))

    def _learn(self, words: list[str]) -> None:
        new = log_probabilities(words, self.vocab, self.model.p)
        start = len(self.values)
        self.values = np.concatenate([self.values, new.astype(np.float32)])
        self.known.update(zip(words, range(start, start + len(words)), strict=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        langs = self.model.langs
        texts = [words_of(t) for t in texts]
        missing = list({w for t in texts for w in t}.difference(self.known))
        if len(self.known) + len(missing) > CACHE:
            self.known, self.values = {}, np.empty((0, len(langs)), np.float32)
            missing = list({w for t in texts for w in t})
        if missing and langs:
            self._learn(missing)
        out = []
        for words in texts:
            if not words or not langs:
                out.append(("und", 0.0))
                continue
            total = self.values[[self.known[w] for w in words]].sum(axis=0, dtype=float)
            best = int(total.argmax())
            z = (total - total[best]) * min(1.0, TEMPERED / len(words))
            out.append((langs[best], float(1 / np.exp(z).sum())))
        return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (0 to 1).

    Only the text is looked at, all of it. Null texts and texts without a letter are
    ``und`` with score 0, as is everything if no language was learned; ties go to the
    first language by name; repeated rows give repeated rows; an empty table gives an
    empty table; other columns are ignored. One narrow pass.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(sent.value)
        for batch in batches:
            got: list[tuple[str, float]] = []
            texts = batch.column(1).to_pylist()
            for i in range(0, len(texts), 500):
                got += predictor.predict(texts[i : i + 500])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = only(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def language_id(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``train`` and ``identify`` over the same documents."""
    return identify(docs, train(docs, sample_rows))
