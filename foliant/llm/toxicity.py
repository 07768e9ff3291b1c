"""Toxicity scores behind noisy-channel deobfuscation.

Tokens with digits and signs for letters, with letters set apart or letters repeated
become character lattices: each sign may stand for itself or for letters, a separator or
a repeated letter may fall away, each at a cost. Viterbi decoding under a character
language model picks the most probable reading. Restored words, and their beginnings,
carry weights learned from labelled documents; a logistic curve over their sum gives the
score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Generations, fold, materialise, only, slices

#: Up to so many labels are sent to every task; more are joined.
SENT_LABELS = 2_000_000
#: A feature is kept if so many toxic documents have it, with so many nats of evidence.
LEAST_TOXIC, LEAST_EVIDENCE, MOST_FEATURES = 4, 9.0, 5_000
PREFIXES = (4, 5, 6)
#: Evidence, and evidence per hundred tokens, beyond these adds nothing, so that the curve
#: is fitted where it decides. FEW tokens are added to a text's length.
ENOUGH, DENSE, FEW = 12.0, 20.0, 20

#: Signs and the letters they are written for (fixed values).
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "¡": "i"}
SEPARATORS = frozenset(".-_*~+|/\\,:;'^#%&=·• ")
#: Costs in nats: a sign for a letter, a sign kept, a separator or repeated letter that falls away.
SWAP, KEPT, DROP, REPEAT = 0.5, 4.0, 0.2, 0.3

#: Symbols of the language model: the edge of a word, a-z, all else.
_SYMBOL = {c: i for i, c in enumerate("^abcdefghijklmnopqrstuvwxyz")}
_OTHER = 27
_N = 28
#: A word of letters, and one that has no doubled letter either: this needs no decoding.
_LETTERS = re.compile(r"[^\W\d_]+")
_PLAIN = re.compile(r"(?!.*(.)\1)[^\W\d_]+")
_RUN = re.compile(r"(.)\1+", re.S)
_EDGES = re.compile(r"^[^\w]+|[^\w]+$")
#: What stays at an edge: signs that are written for letters.
_KEPT_EDGES = re.compile(rf"^[^\w{re.escape(''.join(LOOKS_LIKE))}]+|[^\w{re.escape(''.join(LOOKS_LIKE))}]+$")
_PIECES = re.compile(r"[^\W\d_]+").findall
#: Four or more characters that white space sets apart.
_APART = re.compile(r"(?<!\S)\S(?:\s\S){3,}(?!\S)")


def _collapsed(word: str) -> str:
    """Each run of one character as one."""
    return _RUN.sub(r"\1", word)


class Decoder:
    """Viterbi decoding under a four-gram character model given as log probabilities."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    def _arcs(self, word: str, k: int) -> list[tuple[str, float]]:
        c = word[k]
        looks = LOOKS_LIKE.get(c, "")
        arcs = [(x, SWAP) for x in looks]
        if c in SEPARATORS:
            arcs.append(("", DROP))
        elif not c.isalpha():
            arcs.append((c, KEPT))
        else:
            arcs.append((c, 0.0))
        if k and c == word[k - 1] and c.isalpha():
            arcs.append(("", REPEAT))
        return arcs

    def decode(self, word: str) -> str:
        """The reading with the least cost; exact, as the last three symbols are all that a state needs."""
        table, symbol, done = self.table, _SYMBOL, []
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}  # last three symbols -> cost, letters since the last lone state
        for k in range(len(word)):
            following: dict[int, tuple[float, tuple | None]] = {}
            for x, cost in self._arcs(word, k):
                s = symbol.get(x, _OTHER) if x else -1
                for history, (so_far, letters) in states.items():
                    if s < 0:
                        to, total = history, so_far + cost
                    else:
                        to = (history * _N + s) % (_N**3)
                        total = so_far + cost - table[history * _N + s]
                    if to not in following or total < following[to][0]:
                        following[to] = (total, (letters, x) if x else letters)
            states = following
            if len(states) == 1:  # all readings agree up to here
                ((history, (_, letters)),) = states.items()
                done.append(_spelt(letters))
                states = {history: (0.0, None)}
        return "".join(done) + min((cost - table[history * _N], _spelt(letters)) for history, (cost, letters) in states.items())[1]


def _spelt(letters: tuple | None) -> str:
    out = []
    while letters is not None:
        letters, x = letters
        out.append(x)
    return "".join(reversed(out))


def grams(word: str) -> list[int]:
    """Indices of the four-grams of a word and its end in the model's table."""
    history, out = 0, []
    for c in word:
        s = _SYMBOL.get(c, _OTHER)
        out.append(history * _N + s)
        history = (history * _N + s) % (_N**3)
    out.append(history * _N)
    return out


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Log probabilities: four-grams backed by shorter ones, as a flat table."""
    full = counts.reshape((_N,) * 4).astype(float)
    p = np.full(_N, 1 / _N)
    for n in range(1, 5):
        c = full.sum(axis=tuple(range(4 - n))) if n < 4 else full
        total = c.sum(axis=-1, keepdims=True)
        p = (c + 5 * p) / (total + 5)
    return np.log(p).ravel().astype(np.float32)


def readings(token: str, decoder: Decoder | None) -> list[str]:
    """Words that a token between white space may stand for, in lower case.

    Signs at the edges that look like letters are read both ways: as punctuation that
    falls away and as letters. Words with doubled letters are read as they stand and restored.
    """
    low = token.lower()
    core, whole = _EDGES.sub("", low), _KEPT_EDGES.sub("", low)
    if _LETTERS.fullmatch(core):
        found = [core]
    else:
        found = [p for p in _PIECES(core) if len(p) > 1]
    if decoder:
        # signs before and after the core, each side with and without
        at = whole.find(core) if core else 0
        heads, tails = {0, at}, {len(whole), at + len(core)}
        forms = {whole[i:j] for i in heads for j in tails} if core else set()
        for form in sorted(forms, key=lambda x: (len(x), x)):
            if not _PLAIN.fullmatch(form):
                restored = decoder.decode(form)
                if restored not in found:
                    found.append(restored)
    return found


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


class Model(NamedTuple):
    """weights: of features; table: the character model; curve: slopes and offset."""

    weights: dict[str, float]
    table: np.ndarray
    curve: np.ndarray


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.decoder = model, Decoder(model.table.tolist())
        self.hits = Generations(self._hits, 120_000)
        # features with each run of a letter as one letter: whole words, and beginnings by their lengths
        self.whole = {_collapsed(f) for f in model.weights if not f.endswith("*")}
        self.begins = {_collapsed(f[:-1]) for f in model.weights if f.endswith("*")}
        self.lengths = sorted({len(b) for b in self.begins})

    def _can_hit(self, word: str) -> bool:
        """Can a reading of a word of letters have a weight? All its readings differ in the length of runs only."""
        c = _collapsed(word)
        return c in self.whole or any(c[:n] in self.begins for n in self.lengths)

    def _hits(self, token: str) -> tuple[tuple[str, float], ...]:
        weights, out = self.model.weights, []
        core = _KEPT_EDGES.sub("", token.lower())
        if _LETTERS.fullmatch(core) and not self._can_hit(core):
            return ()
        for word in readings(token, self.decoder):
            found = [weights[f] for f in features(word) if f in weights]
            if found:
                out.append((word, max(found)))
        return tuple(out)

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Of the words that have a weight: the sum over different ones, all occurrences per hundred tokens, the most."""
        if not text:
            return 0.0, 0.0, 0.0
        look, found = self.hits.__getitem__, {}
        total, tokens = 0.0, text.split()
        for hit in map(look, tokens):
            for word, weight in hit:
                found[word] = weight
                total += weight
        for m in _APART.finditer(text):
            for word, weight in self._hits("".join(m[0].split())):
                found[word] = weight
                total += weight
        return min(ENOUGH, sum(found.values())), min(DENSE, 100 * total / (len(tokens) + FEW)), max(found.values(), default=0.0)

    def score(self, text: str | None) -> float:
        *slopes, offset = self.model.curve
        z = offset + sum(a * x for a, x in zip(slopes, self.evidence(text), strict=True))
        return 1 / (1 + np.exp(-min(max(z, -50), 50)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic: in how many toxic and other documents of this task a feature stands."""
    counts: dict[str, list[int]] = {}

    def flush() -> pa.RecordBatch:
        names, pairs = list(counts), list(counts.values())
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([p[1] for p in pairs], pa.int64()), pa.array([p[0] for p in pairs], pa.int64())], ["feature", "toxic", "other"])

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w for t in set((text or "").split()) for w in readings(t, None)}
            for f in {f for w in words for f in features(w)}:
                counts.setdefault(f, [0, 0])[toxic] += 1
            if len(counts) > 500_000:
                yield flush()
    yield flush()


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(_N**4)
    for batch in batches:
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for g in grams(word):
                counts[g] += n**0.5
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["gram", "weight"])


def _newton(batches: Iterator[pa.RecordBatch], w: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of a Newton step at ``w`` over rows (evidence, density, most, toxic, n): the curvature, then the gradient."""
    sums = np.zeros(20)
    for batch in batches:
        *evidence, toxic, n = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
        x = np.column_stack([*evidence, np.ones(len(n))]) / _SCALE
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        sums += np.concatenate([((x * (n * p * (1 - p))[:, None]).T @ x).ravel(), x.T @ (n * (toxic - p))])
    yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])


_SCALE = np.array([ENOUGH, DENSE, ENOUGH, 1.0])


def _curve(found: DataFrame) -> np.ndarray:
    """Slopes (none falls) and offset of a logistic curve, by Newton steps with a weak prior; only sums come to the driver."""
    w = np.zeros(4)
    for _ in range(50):
        parts = found.mapInArrow(lambda b, w=w: _newton(b, w), "sums array<double>").collect()
        sums = np.sum([r.sums for r in parts], axis=0) if parts else np.zeros(20)
        step = np.linalg.solve(sums[:16].reshape(4, 4) + 0.01 * np.eye(4), sums[16:] - 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return np.maximum(w / _SCALE, [0, 0, 0, -50])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on all labelled documents of folds 1 to 4.

    Rows with a null label, id or text teach nothing; a document with several labels is
    toxic if one of them says so. Without toxic documents every score is the base rate.
    """
    spark = docs.sparkSession
    marks = only(labels, doc_id="bigint", toxic="int").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marks = F.broadcast(marks) if marks.count() <= SENT_LABELS else marks
    rows = only(docs, doc_id="bigint", text="string").filter("text is not null").join(marks, "doc_id").select("text", "toxic")
    rows = materialise(rows, "toxicity-labelled")
    n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    counted = materialise(rows.mapInArrow(_counted, "feature string, toxic bigint, other bigint").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "toxicity-features")
    words = counted.filter(~F.col("feature").endswith("*")).select("feature", F.col("toxic") + F.col("other"))
    table = np.zeros(_N**4)
    for r in words.mapInArrow(_grams, "gram bigint, weight double").groupBy("gram").agg(F.sum("weight").alias("weight")).collect():  # 28 ** 4 at most
        table[r.gram] = r.weight
    base = F.lit(toxic / max(1, toxic + other))
    seen = F.col("toxic") + F.col("other")
    rate = F.col("toxic") / seen
    evidence = F.col("toxic") * F.log(rate / base) + F.when(F.col("other") > 0, F.col("other") * F.log((1 - rate) / (1 - base))).otherwise(0.0)
    weight = F.log((F.col("toxic") + 0.1) / (toxic + 1)) - F.log((F.col("other") + 0.1) / (other + 1))
    weights: dict[str, float] = {}
    if toxic and other:
        kept = counted.filter((F.col("toxic") >= LEAST_TOXIC) & (rate > base)).withColumn("evidence", evidence).filter(F.col("evidence") >= LEAST_EVIDENCE).select("feature", weight.alias("weight"), "evidence")
        weights = {r.feature: r.weight for r in kept.orderBy(F.desc("evidence"), "feature").limit(MOST_FEATURES).collect() if r.weight > 1}
    model = Model(weights, smoothed(table), np.zeros(4))
    sent = spark.sparkContext.broadcast(model)

    def evident(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in slices(batches):
            got = [scorer.evidence(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64()), batch.column(1)], ["evidence", "density", "most", "toxic"])

    found = rows.mapInArrow(evident, "evidence double, density double, most double, toxic int")
    # most texts have no evidence, so equal rows are counted first
    found = materialise(found.groupBy("evidence", "density", "most", "toxic").agg(F.count("*").alias("n")), "toxicity-evidence")
    return model._replace(curve=_curve(found))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts have no evidence, so the lowest score. Whole texts are read;
    repeated rows give repeated rows; an empty table gives an empty table; other columns
    are ignored. One narrow pass.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.score(t) for t in batch.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    rows = only(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, score double")
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``train`` and ``score`` over the same documents."""
    return score(docs, train(docs, labels))
