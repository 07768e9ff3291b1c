"""Scores of texts under a log-bilinear neural model trained by noise-contrastive estimation.

Words are counted over the whole training part of the corpus. The most frequent ones are
the model's classes, together with the end of a text and one class for all other words.
Every other word of the lexicon (``SENT_WORDS``) has vectors too, so the parameters grow
with the corpus: one is added to its class's vector where it stands in the context, and
the decisions of a binary tree over the words of the last class, each a logistic function
of the same context, predict it. All words beyond the lexicon share a leaf and follow
with their smoothed relative frequency there. Each part sums to one, so every token has a
normalised probability.

The class model is trained by noise-contrastive estimation on the counts of all triples of
classes, each step over all of them. Training documents are dealt to replicas by a hash of
their ids and texts; the corpus alone says how many there are, so scores don't depend on how
tables are cut or tasks scheduled. In one pass each replica trains the words' vectors over all its tokens beside that class model
(contexts by noise-contrastive estimation of the class and by the tree's decisions); these
are averaged by occurrences. Contexts of two frequent words are a
look into tables of scores and normalisers; the others are reckoned token by token.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fold, materialise, only, slices

#: Classes: 0 is the end of a text, the last one is for all words without their own.
CLASSES = 64
#: Length of a class's vector.
WIDTH = 16
#: Noise samples for a token; steps of the class model, each over all tokens.
NOISE, STEPS = 64, 600
RATE = 0.4
#: Tokens of a replica; of a corpus with more than MOST_REPLICAS of these, each is larger.
REPLICA_TOKENS, MOST_REPLICAS = 8_000_000, 4096
#: Words whose counts are sent to every task; those of rarer words are joined.
SENT_WORDS = 200_000
#: Different words that a task counts before it hands them on.
HELD_WORDS = 400_000
#: Texts that are cut into words together.
TEXTS = 1024
#: Tokens of a step of the words' training and of scoring, and the rate of these steps.
WORD_BATCH, WORD_RATE = 16_384, 0.1
#: Tokens that are held for full steps.
HELD_TOKENS = 8 * WORD_BATCH
#: Rows of a product over all classes or a block of the tree, few enough for a processor's cache.
ROWS = 4096
SEED = 7

END = b""


def arrow_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts behind each other, as ``lower_words`` has them, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten().cast(pa.binary())
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    real = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
    sums = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    n = sums[ends[1:]] - sums[ends[:-1]]
    return words if sums[-1] == len(words) else words.filter(real), n


def _released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same; then what Arrow keeps for later goes back, as the worker lives on."""
    yield from batches
    pa.default_memory_pool().release_unused()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select(["word", "c"])

    for batch in slices(batches, TEXTS):
        words, n = arrow_words(batch.column(0))
        held += [pa.table(words.value_counts().flatten(), ["word", "c"]), pa.table({"word": [END], "c": [len(n)]})]
        if sum(map(len, held)) > 2 * HELD_WORDS:
            held = [summed()]
            if len(held[0]) > HELD_WORDS:
                yield from held.pop().to_batches()
    if held:
        yield from summed().to_batches()


def word_counts(docs: DataFrame) -> DataFrame:
    """word (UTF-8), c over all ``docs``; the empty word is the end of a text.

    Each task sums its own counts, and the shuffle sums those, so no word is hot.
    """
    return only(docs, text="string").mapInArrow(lambda b: _released(_counted(b)), "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


#: Levels of the tree that are decided together, as products of matrices: those of the root, then those of each node below.
BLOCK = 6
#: Nodes of a block stand in columns level by level, from left to right; the last column is for no decision.
WIDE, NO_TURN = 1 << BLOCK, (1 << BLOCK) - 1


def _block_paths() -> tuple[np.ndarray, np.ndarray]:
    """By level and by path (its length times WIDE, and its turns as bits): the columns, and 1 for a turn to the right."""
    columns, turns = np.full((BLOCK, (BLOCK + 1) * WIDE), NO_TURN), np.zeros((BLOCK, (BLOCK + 1) * WIDE), np.float32)
    for length in range(1, BLOCK + 1):
        code = np.arange(1 << length)
        for level in range(length):
            columns[level, length * WIDE + code] = (1 << level) - 1 + (code >> (length - level))
            turns[level, length * WIDE + code] = code >> (length - 1 - level) & 1
    return columns, turns


COLUMNS, TURNS = _block_paths()
#: By path and column: 1 if the path has a decision there.
DECIDES = np.stack([np.isin(np.arange(WIDE), x) & (np.arange(WIDE) != NO_TURN) for x in COLUMNS.T]).astype(float)


class Tree(NamedTuple):
    """Paths of leaves: those of leaf k are ``start[k]`` to ``start[k + 1]`` of node and right.

    place: of leaves in the order of the tree; bias: of nodes, by mass; first, then: of leaves, their
    paths in the root's block and in the one below; nodes: by block and column, 0 where there is none.
    """

    start: np.ndarray
    node: np.ndarray
    right: np.ndarray
    place: np.ndarray
    bias: np.ndarray
    first: np.ndarray
    then: np.ndarray
    nodes: np.ndarray

    def blocks(self, leaves: np.ndarray) -> Iterator[tuple[np.ndarray | slice, list[tuple[int, int, int]], np.ndarray]]:
        """For leaves sorted by place: which of them have decisions in a block, each block with its slice of these, and their paths in it.

        For ROWS leaves at a time, first the root's block, then all blocks below it.
        """
        for start in range(0, len(leaves), ROWS):
            part = leaves[start : start + ROWS]
            first = self.first.take(part)
            yield slice(start, start + len(part)), [(0, 0, len(part))], first
            on = np.flatnonzero(self.then.take(part) >= WIDE)
            if len(on):
                block = first[on] % WIDE + 1
                begins = np.flatnonzero(np.diff(block, prepend=0))
                yield start + on, list(zip(block[begins].tolist(), begins.tolist(), [*begins[1:].tolist(), len(on)], strict=True)), self.then.take(part[on])

    def levels(self, leaves: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Below the blocks: which leaves go on, those of long paths first; and for each level its nodes and turns for the first of these."""
        which = np.flatnonzero(self.then.take(leaves) >= BLOCK * WIDE)
        at, end = self.start.take(leaves[which]) + 2 * BLOCK, self.start.take(leaves[which] + 1)
        more = end - at
        by_length = np.argsort(-more.astype(np.int16), kind="stable")
        which, at = which[by_length], at[by_length]
        sizes = [n for n in (len(more) - np.cumsum(np.bincount(more))).tolist() if n]
        return which, [(self.node[at[:n] + level], self.right[at[:n] + level]) for level, n in enumerate(sizes)]

    def weights(self, v: np.ndarray) -> np.ndarray:
        """By block and column: the vector of the node; without a decision, one that goes left for sure."""
        out = v.take(self.nodes, axis=0)
        out[:, NO_TURN] = 0
        out[:, NO_TURN, -1] = -30
        return out


def tree(mass: np.ndarray, order: np.ndarray) -> Tree:
    """Halves the mass of leaves in ``order`` again and again; a node's number is the place of its cut."""
    sums = np.concatenate([[0.0], np.cumsum(mass[order])])
    size = len(mass)
    low, high, bias, steps = np.zeros(size, np.int64), np.full(size, size), np.zeros(size), []
    while len(live := np.flatnonzero(high - low > 1)):
        a, b = low[live], high[live]
        cut = np.clip(np.searchsorted(sums, (sums[a] + sums[b]) / 2), a + 1, b - 1)
        right = live >= cut
        bias[cut] = np.log((sums[b] - sums[cut]) / (sums[cut] - sums[a]))
        steps.append((order[live], cut, right))
        low[live[right]], high[live[~right]] = cut[right], cut[~right]
    leaf, node, right = (np.concatenate(x) for x in zip(*steps, strict=True)) if steps else (np.empty(0, np.int64),) * 3
    at = np.argsort(leaf, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(leaf, minlength=size))])
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    node, right, paths, nodes = node[at].astype(np.int32), right[at].astype(bool), [], np.zeros((1 + WIDE, WIDE), np.int32)
    for above in (0, BLOCK):
        length, code = np.clip(np.diff(start) - above, 0, BLOCK), np.zeros(size, np.int64)
        for level in range(BLOCK):
            on = np.flatnonzero(length > level)
            code[on] = 2 * code[on] + right[start[on] + above + level]
        paths.append((length * WIDE + code).astype(np.int16))
        for level in range(BLOCK):
            on = np.flatnonzero(length > level)
            nodes[paths[0][on] % WIDE + 1 if above else 0, COLUMNS[level, paths[-1][on]]] = node[start[on] + above + level]
    return Tree(start, node, right, place, bias.astype(np.float32), *paths, nodes)


def _logits(context: np.ndarray, weights: np.ndarray, parts: list[tuple[int, int, int]]) -> np.ndarray:
    """Each row of context (with a one at its end) times all columns of its block."""
    out = np.empty((len(context), WIDE), np.float32)
    for block, i, j in parts:
        np.dot(context[i:j], weights[block].T, out=out[i:j])
    return out


#: So many of the longest slices are summed one by one.
LONG = 8


def _slices(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the slices of equal numbers begin in sorted ids, and their lengths; the longest first."""
    begins = np.flatnonzero(np.diff(ids, prepend=-1))
    counts = np.diff(begins, append=len(ids))
    by_length = np.argsort(-np.minimum(counts, 32_767).astype(np.int16), kind="stable")
    return begins[by_length], counts[by_length]


def _sums(rows: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each slice, the longest first, the sum of its rows: first rows, second rows and so on, as most slices are short."""
    out, n = rows.take(begins, axis=0), 1
    while (more := np.count_nonzero(counts > n)) > LONG:
        counts = counts[:more]
        out[:more] += rows.take(begins[:more] + n, axis=0)
        n += 1
    for k in range(more):
        out[k] += rows[begins[k] + n : begins[k] + counts[k]].sum(axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Lexicon:
    """The frequent words: their classes, log10(c + 0.5), and the tree of those in the last class.

    Words of the last class have numbers from 0; the next one is for all words without a
    place, and the one after it stands for words with a class of their own.
    """

    def __init__(self, rows: list[tuple[bytes, int]], total: int, different: int) -> None:
        rows = sorted(rows, key=lambda r: (r[0] != END, -r[1], r[0]))
        self.place = {word: i for i, (word, _) in enumerate(rows)}
        self.classes = np.minimum(np.arange(len(rows) + 1), CLASSES - 1)
        self.classes[-1] = CLASSES - 1  # for place -1: a word without a place
        self.log_c = np.append(np.log10(np.array([c for _, c in rows], float) + 0.5), 0.0)
        own = [c for _, c in rows[: CLASSES - 1]]
        self.total, self.different = total, different
        inner = rows[CLASSES - 1 :]
        self.inner = len(inner)
        self.numbered = np.concatenate([np.full(len(own), self.inner + 1), np.arange(self.inner + 1)])
        unsent = max(0, total - sum(c for _, c in rows)) + 0.5 * (max(0, different - len(rows)) + 1)
        #: log10 of what the base score and the words without a place divide by
        self.log_all = math.log10(total + 0.5 * (different + 1))
        self.log_unsent = math.log10(unsent)
        # neighbours in the alphabet share beginnings, so nodes part like from unlike words
        order = np.array([*sorted(range(len(inner)), key=lambda k: inner[k][0]), len(inner)], np.int64)
        self.tree = tree(np.array([*(c + 0.5 for _, c in inner), unsent]), order)
        counts = np.zeros(CLASSES)
        counts[: len(own)] = own
        counts[-1] += total - sum(own)
        self.unigram = (counts + 0.5) / (counts + 0.5).sum()

    def places(self, words: list[bytes]) -> np.ndarray:
        """With the end of the text; -1 for words without a place."""
        return np.fromiter(map(self.place.get, chain(words, (END,)), repeat(-1)), np.int32, len(words) + 1)

    def numbers(self, places: np.ndarray) -> np.ndarray:
        """Numbers in the last class, see above."""
        return self.numbered.take(places)


class Weights(NamedTuple):
    """r: class vectors; one, two: context matrices of the last and the last but one token; b: biases."""

    r: np.ndarray
    one: np.ndarray
    two: np.ndarray
    b: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self])

    @staticmethod
    def of(flat: np.ndarray) -> Weights:
        at = np.cumsum([0, CLASSES * WIDTH, WIDTH * WIDTH, WIDTH * WIDTH, CLASSES])
        r, one, two, b = (flat[i:j] for i, j in zip(at[:-1], at[1:], strict=True))
        return Weights(r.reshape(CLASSES, WIDTH), one.reshape(WIDTH, WIDTH), two.reshape(WIDTH, WIDTH), b)


def start(unigram: np.ndarray) -> Weights:
    rng = np.random.default_rng(SEED)
    return Weights(rng.normal(0, 0.3, (CLASSES, WIDTH)), np.zeros((WIDTH, WIDTH)), np.zeros((WIDTH, WIDTH)), np.log(unigram))


def _by_number(numbers: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows by their numbers, column by column."""
    out = np.empty((size, rows.shape[1]))
    for j, x in enumerate(rows.T):
        out[:, j] = np.bincount(numbers, x, size)
    return out


class ClassTrainer:
    """Trains a class model from its start by noise-contrastive steps over counts; the noise enters by its expectation."""

    def __init__(self, unigram: np.ndarray) -> None:
        self.weights = tuple(x.copy() for x in start(unigram))
        self.past = [np.full(x.shape, 1e-2) for x in self.weights]  # sums of squares, for the rate of each parameter
        self.noise = NOISE * unigram

    def step(self, codes: np.ndarray) -> None:
        """Observed tokens as (two before, one before, token)."""
        self.learn(*seen_contexts(np.bincount(codes, minlength=CLASSES**3)), 1)

    def learn(self, contexts: np.ndarray, counts: np.ndarray, steps: int) -> None:
        """contexts: (two before, one before); counts: of the token after each."""
        r, one, two, b = self.weights
        far, near = contexts // CLASSES, contexts % CLASSES
        total = max(1.0, counts.sum())
        seen = (counts / total).astype(np.float32)
        noise = (seen.sum(axis=1, keepdims=True) * self.noise).astype(np.float32)
        both, log_noise = seen + noise, np.log(self.noise)
        for _ in range(steps):
            x, y = r[near], r[far]
            q = x @ one + y @ two
            s = (q @ r.T + (b - log_noise)).astype(np.float32)
            np.clip(s, -60, 60, out=s)
            ds = both / (1 + np.exp(-s)) - seen
            dq = ds @ r
            dr = ds.T @ q + _by_number(near, dq @ one.T, CLASSES) + _by_number(far, dq @ two.T, CLASSES)
            for p, sq, d in zip(self.weights, self.past, (dr, x.T @ dq, y.T @ dq, ds.sum(axis=0)), strict=True):
                sq += d * d
                p -= RATE * d / np.sqrt(sq)

    def result(self) -> Weights:
        return Weights(*self.weights)


def seen_contexts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The contexts that occur, and for each how often every class follows."""
    table = counts.reshape(CLASSES**2, CLASSES)
    held = np.flatnonzero(table.any(axis=1))
    return held, table[held]


class Tables(NamedTuple):
    """Natural log scores by the token one and two before, biases, and log normalisers by both."""

    near: np.ndarray
    far: np.ndarray
    b: np.ndarray
    log_z: np.ndarray

    def log_probabilities(self, classes: np.ndarray) -> np.ndarray:
        """For the classes of a whole text; before it stand two ends of texts."""
        c = np.concatenate([[0, 0], classes])
        far, near, word = c[:-2], c[1:-1], c[2:]
        return self.near[near, word] + self.far[far, word] + self.b[word] - self.log_z[far, near]


def tables(w: Weights) -> Tables:
    near, far = (w.r @ w.one) @ w.r.T, (w.r @ w.two) @ w.r.T
    log_z = np.empty((CLASSES, CLASSES))
    for k in range(CLASSES):
        s = near + far[k] + w.b
        top = s.max(axis=1)
        log_z[k] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
    return Tables(near, far, w.b, log_z)


class Words:
    """The vectors of the words of the last class beside a class model.

    u: what a word adds to its class's vector in a context; v: vectors of the tree's
    nodes, each with its bias at the end. They start at the frequencies.
    """

    def __init__(self, lex: Lexicon, w: Weights, u: np.ndarray | None = None, v: np.ndarray | None = None) -> None:
        self.lex, self.w = lex, Weights(*(x.astype(np.float32) for x in w))
        self.tables = tables(w)
        self.u = np.zeros((lex.inner + 2, WIDTH), np.float32) if u is None else u
        self.v = np.column_stack([np.zeros((lex.inner + 1, WIDTH), np.float32), lex.tree.bias]) if v is None else v

    def context(self, classes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """For tokens after the two before them: what predicts each but the first two."""
        r, one, two, _ = self.w
        x = r.take(classes, axis=0)
        x += self.u.take(numbers, axis=0)
        q = x[1:-1] @ one
        q += x[:-2] @ two
        return q

    def deep(self, q: np.ndarray, rows: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of q that go down the tree and their leaves, by the place of the leaf; and their contexts with a one at the end."""
        by_place = np.argsort(self.lex.tree.place.take(leaves))
        rows, leaves = rows[by_place], leaves[by_place]
        context = np.ones((len(rows), WIDTH + 1), np.float32)
        context[:, :-1] = q.take(rows, axis=0)
        return rows, leaves, context

    def log_probabilities(self, places: np.ndarray) -> np.ndarray:
        """Natural logs for places[2:]; words without a place get what all of them have together."""
        lex, t = self.lex, self.tables
        weights = lex.tree.weights(self.v)
        out = np.empty(len(places) - 2)
        for i in range(0, len(out), WORD_BATCH):
            part = places[i : i + WORD_BATCH + 2]
            c, k = lex.classes.take(part), lex.numbers(part)
            word = c[2:]
            q = self.context(c, k)
            got = np.empty(len(q))
            inner = (k[1:-1] <= lex.inner) | (k[:-2] <= lex.inner)
            known = np.flatnonzero(~inner)
            far, near, known_word = c[known], c[known + 1], word[known]
            got[known] = t.near[near, known_word] + t.far[far, known_word] + t.b[known_word] - t.log_z[far, near]
            more = np.flatnonzero(inner)
            for j in range(0, len(more), ROWS):
                rows = more[j : j + ROWS]
                s = q.take(rows, axis=0) @ self.w.r.T
                s += self.w.b
                chosen = s[np.arange(len(rows)), word[rows]].astype(float)
                top = 0.0
                if max(s.max(), -s.min()) > 60:  # exp would overflow
                    top = s.max(axis=1)
                    s -= top[:, None]
                got[rows] = chosen - top - np.log(np.exp(s, out=s) @ np.ones(CLASSES, np.float32))
            deep = np.flatnonzero(word == CLASSES - 1)
            deep, leaves, context = self.deep(q, deep, k[2:][deep])
            logs = np.zeros(len(deep))
            for rows, parts, paths in lex.tree.blocks(leaves):
                at = COLUMNS.take(paths, axis=1) + np.arange(0, len(paths) * WIDE, WIDE)
                x = _logits(context[rows], weights, parts).ravel().take(at)
                x *= 1 - 2 * TURNS.take(paths, axis=1)
                logs[rows] -= np.log(_one_and_exp(x).prod(axis=0, dtype=float))
            which, levels = lex.tree.levels(leaves)
            rest, p = context.take(which, axis=0), np.ones(len(which))
            for level, (node, right) in enumerate(levels):
                x = np.einsum("ij,ij->i", rest[: len(node)], self.v.take(node, axis=0))
                np.negative(x, out=x, where=right)
                p[: len(node)] *= _one_and_exp(x)
                if level % 8 == 7:  # products of eight stay far from infinity
                    logs[which], p = logs[which] - np.log(p), np.ones(len(p))
            logs[which] -= np.log(p)
            got[deep] += logs
            out[i : i + WORD_BATCH] = got
        return out


def _one_and_exp(x: np.ndarray) -> np.ndarray:
    """In place, for x within bounds."""
    np.clip(x, -30, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return x


class WordTrainer(Words):
    """Trains u and v by steps whose rate falls for each parameter; seen: occurrences of each row."""

    def __init__(self, lex: Lexicon, w: Weights) -> None:
        super().__init__(lex, w)
        self.rng = np.random.default_rng(SEED)
        self.past = [np.ones(x.shape, np.float32) for x in (self.u, self.v)]
        self.seen = [np.zeros(len(x), np.int64) for x in (self.u, self.v)]
        self.noise_share = np.cumsum(lex.unigram)
        self.log_noise = np.log(NOISE * lex.unigram).astype(np.float32)

    def step(self, places: np.ndarray, real: np.ndarray) -> None:
        """places[2:][real] are the tokens to learn."""
        lex, (r, one, two, b) = self.lex, self.w
        c, k = lex.classes.take(places), lex.numbers(places)
        word, q = c[2:], self.context(c, k)
        beside = b - self.log_noise
        noise, drawn = np.unique(np.minimum(np.searchsorted(self.noise_share, self.rng.random(NOISE)), CLASSES - 1), return_counts=True)
        false = q @ r[noise].T
        false += beside[noise]
        _sigmoid(false)
        dq = false @ (r[noise] * drawn[:, None].astype(np.float32))
        rows = r.take(word, axis=0)
        rows *= (_sigmoid(np.einsum("ij,ij->i", q, rows) + beside.take(word)) - 1)[:, None]
        dq += rows
        dq[~real] = 0
        deep = np.flatnonzero((word == CLASSES - 1) & real)
        deep, leaves, context = self.deep(q, deep, k[2:][deep])
        dq[deep] += self._learn_tree(leaves, context)
        # each position counts as the one before the next token and as the last but one of the token after that
        d, uses = np.zeros((len(k) - 1, WIDTH), np.float32), np.zeros(len(k) - 1, np.int64)
        d[1:] = dq @ one.T
        d[:-1] += dq @ two.T
        uses[1:] = real
        uses[:-1] += real
        inner = np.flatnonzero((k[:-1] <= lex.inner) & (uses > 0))
        if len(inner):
            inner = inner[np.argsort(k[inner])]
            ids = k[inner]
            begins, counts = _slices(ids)
            np.add.at(self.seen[0], ids, uses[inner])
            self._slide(self.u, self.past[0], ids[begins], _sums(d.take(inner, axis=0), begins, counts))

    def _learn_tree(self, leaves: np.ndarray, context: np.ndarray) -> np.ndarray:
        """A step of the nodes on the paths; gives the slopes of the contexts."""
        tree, back = self.lex.tree, np.zeros((len(leaves), WIDTH), np.float32)
        weights = tree.weights(self.v)
        slopes, seen = np.zeros(weights.shape, np.float32), np.zeros((len(tree.nodes), len(DECIDES)))
        for rows, parts, paths in tree.blocks(leaves):
            part, at = context[rows], COLUMNS.take(paths, axis=1)
            at += np.arange(0, len(paths) * WIDE, WIDE)
            off = _sigmoid(_logits(part, weights, parts).ravel().take(at))
            off -= TURNS.take(paths, axis=1)
            spread, into = np.zeros((len(paths), WIDE), np.float32), np.empty((len(paths), WIDTH), np.float32)
            spread.ravel()[at] = off
            for block, i, j in parts:
                slopes[block] += spread[i:j].T @ part[i:j]
                np.dot(spread[i:j], weights[block, :, :-1], out=into[i:j])
                seen[block] += np.bincount(paths[i:j], minlength=len(DECIDES))
            back[rows] = back[rows] + into
        times = (seen @ DECIDES).ravel().astype(np.int64)
        held = np.flatnonzero(times)
        nodes, times, slopes = tree.nodes.ravel()[held], times[held], slopes.reshape(-1, WIDTH + 1)[held]
        self._slide_nodes(nodes, times, slopes)
        which, levels = tree.levels(leaves)
        if levels:
            part, into, offs = context.take(which, axis=0), np.zeros((len(which), WIDTH + 1), np.float32), []
            for node, right in levels:
                v = self.v.take(node, axis=0)
                off = _sigmoid(np.einsum("ij,ij->i", part[: len(node)], v))
                off -= right
                offs.append(off)
                v *= off[:, None]
                into[: len(node)] += v
            back[which] += into[:, :-1]
            low, off = np.concatenate([node for node, _ in levels]), np.concatenate(offs)
            order = np.argsort(low)
            low, off, row = low.take(order), off.take(order), np.concatenate([np.arange(len(x)) for x in offs]).take(order)
            cuts = np.searchsorted(low, low[::ROWS]).tolist()  # between nodes
            for i, j in zip(cuts, [*cuts[1:], len(low)], strict=True):
                if i < j:
                    begins, counts = _slices(low[i:j])
                    rows = part.take(row[i:j], axis=0)
                    rows *= off[i:j, None]
                    self._slide_nodes(low[i:j].take(begins), counts, _sums(rows, begins, counts))
        return back

    def _slide_nodes(self, nodes: np.ndarray, times: np.ndarray, slopes: np.ndarray) -> None:
        self.seen[1][nodes] += times
        self._slide(self.v, self.past[1], nodes, slopes)

    @staticmethod
    def _slide(x: np.ndarray, past: np.ndarray, held: np.ndarray, d: np.ndarray) -> None:
        squares = d * d
        squares += past.take(held, axis=0)
        past[held] = squares
        np.sqrt(squares, out=squares)
        np.divide(d, squares, out=squares)
        squares *= -WORD_RATE
        squares += x.take(held, axis=0)
        x[held] = squares


def joined(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of texts behind each other, each after two ends of texts; which places[2:] are tokens."""
    places = np.concatenate([x for t in texts for x in ((end, end), t)]).astype(np.int64)
    real = np.ones(len(places), bool)
    first = np.cumsum([0, *(len(t) + 2 for t in texts[:-1])])
    real[first] = real[first + 1] = False
    return places, real[2:]


def gathered(texts: Iterable[np.ndarray], size: int) -> Iterator[list[np.ndarray]]:
    """Texts by turns, of about ``size`` tokens together."""
    held, n = [], 0
    for x in texts:
        held.append(x)
        n += len(x)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def replicas_for(total: int) -> int:
    return max(1, min(MOST_REPLICAS, -(-total // REPLICA_TOKENS)))


_OTHERS = "array<struct<word:binary,n:int>>"


def encoded(docs: DataFrame, lexicon, replicas: int) -> DataFrame:
    """doc_id, replica, key, places (32 bits each, the end of the text last) and others, its words without a place, of each document of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = lexicon.value
        end, known = lex.place.get(END, -1), pa.array(list(lex.place), pa.binary())
        for batch in slices(batches, TEXTS):
            words, n = arrow_words(batch.column(2))
            found = pc.index_in(words, value_set=known)
            ends = np.concatenate([[0], np.cumsum(n + 1)])
            places, is_word = np.full(ends[-1], end, np.int32), np.ones(ends[-1], bool)
            is_word[ends[1:] - 1] = False
            places[is_word] = pc.fill_null(found, -1).to_numpy()
            doc, away = np.repeat(np.arange(len(n)), n)[found.is_null().to_numpy(zero_copy_only=False)], words.filter(found.is_null())
            if end < 0:
                doc, away = np.concatenate([doc, np.arange(len(n))]), pa.concat_arrays([away, pa.array([END] * len(n), pa.binary())])
            others = pa.table({"doc": doc, "word": away}).group_by(["doc", "word"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc")
            first = np.concatenate([[0], np.cumsum(np.bincount(others.column("doc").to_numpy(), minlength=len(n)))])
            pairs = pa.StructArray.from_arrays([others.column("word").combine_chunks(), others.column("count_all").combine_chunks().cast(pa.int32())], ["word", "n"])
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pairs)
            tokens = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(places)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens, lists], ["doc_id", "key", "places", "others"])

    rows = only(docs, doc_id="bigint", text="string").select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text").mapInArrow(lambda b: _released(run(b)), f"doc_id bigint, key bigint, places binary, others {_OTHERS}")
    return rows.select("doc_id", F.pmod(F.col("key"), F.lit(replicas)).cast("int").alias("replica"), "key", "places", "others")


def dealt(tokens: DataFrame, replicas: int) -> DataFrame:
    """Each replica in one task, in an order that only its documents decide."""
    return tokens.repartitionByRange(replicas, "replica").sortWithinPartitions("replica", "key").select("replica", "places")


def _by_replica(batches: Iterator[pa.RecordBatch], begin) -> Iterator[pa.RecordBatch]:
    """Feeds ``begin()`` of each replica its texts by ``add``; gives what its ``finish`` gives."""
    number, trainer = None, None
    for batch in batches:
        for replica, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if replica != number:
                if trainer:
                    yield from trainer.finish()
                number, trainer = replica, begin()
            trainer.add(np.frombuffer(places, np.int32).astype(np.int64))
    if trainer:
        yield from trainer.finish()


class WordReplica:
    """Trains the words' vectors text by text."""

    def __init__(self, lex: Lexicon, w: Weights) -> None:
        self.lex, self.trainer, self.held, self.n = lex, WordTrainer(lex, w), [], 0

    def add(self, places: np.ndarray) -> None:
        self.held.append(places)
        self.n += len(places)
        if self.n >= HELD_TOKENS:
            self._learn()

    def _learn(self) -> None:
        places, real = joined(self.held, self.lex.place.get(END, -1))
        for i in range(0, len(real), WORD_BATCH):
            if real[i : i + WORD_BATCH].any():
                self.trainer.step(places[i : i + WORD_BATCH + 2], real[i : i + WORD_BATCH])
        self.held, self.n = [], 0

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._learn()
        trainer = self.trainer
        for which, x in enumerate((trainer.u, trainer.v)):
            ids = np.flatnonzero(trainer.seen[which])
            for i in range(0, len(ids), 10_000):
                part = ids[i : i + 10_000]
                seen = trainer.seen[which][part].astype(float)
                columns = [pa.array((x[part, j] * seen).astype(np.float32)) for j in range(x.shape[1])] + [pa.nulls(len(part), pa.float32())] * (WIDTH + 1 - x.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), which, np.int32)), pa.array(part.astype(np.int32)), pa.array(seen.astype(np.float32)), *columns], ["kind", "k", "w", *_COLUMNS])


_COLUMNS = [f"x{j}" for j in range(WIDTH + 1)]


def class_counts(tokens: DataFrame, lexicon) -> np.ndarray:
    """How often each class follows each two, over all ``tokens``: sums over a fixed table, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, classes = np.zeros(CLASSES**3, np.int64), lexicon.value.classes
        for batch in slices(batches, TEXTS):
            for texts in gathered((np.frombuffer(x, np.int32) for x in batch.column(0).to_pylist()), CLASSES**3):
                places, real = joined(texts, 0)  # the first place is of the first class
                c = classes.take(places)
                counts += np.bincount(((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:])[real], minlength=CLASSES**3)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["code", "n"])

    rows = tokens.select("places").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES**3, np.int64)
    counts[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return counts


def train(tokens: DataFrame, lexicon) -> Weights:
    """Trains the class model on the counts of all ``tokens``."""
    trainer = ClassTrainer(lexicon.value.unigram)
    trainer.learn(*seen_contexts(class_counts(tokens, lexicon)), STEPS)
    return trainer.result()


def train_words(tokens: DataFrame, lexicon, weights: Weights) -> Words:
    """Trains the words' vectors on the replicas of ``tokens``; averaged by occurrences."""
    sent = tokens.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_replica(batches, lambda: WordReplica(lexicon.value, sent.value))

    rows = tokens.mapInArrow(run, "kind int, k int, w float, " + ", ".join(f"{c} float" for c in _COLUMNS))
    rows = rows.groupBy("kind", "k").agg(*[(F.sum(c) / F.sum("w")).cast("float").alias(c) for c in _COLUMNS])
    model = Words(lexicon.value, weights)
    got = rows.toArrow()  # two rows a word of the lexicon at most
    kind, k = (got.column(c).to_numpy() for c in ("kind", "k"))
    u, v = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    for j in range(WIDTH + 1):
        x = got.column(f"x{j}").to_numpy()
        model.v[k[v], j] = x[v]
        if j < WIDTH:
            model.u[k[u], j] = x[u]
    return model


def _scored(batches: Iterator[pa.RecordBatch], lex: Lexicon, model: Words) -> Iterator[pa.RecordBatch]:
    """Of batches of doc_id, places, others."""
    for batch in slices(batches, TEXTS):
        columns = [np.empty(batch.num_rows, kind) for kind in (np.int64, np.int64, float, float)]
        row = 0
        for texts in gathered((np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()), HELD_TOKENS):
            places, real = joined(texts, lex.place.get(END, -1))
            logs, own = model.log_probabilities(places), places[2:]
            n = np.array([len(t) for t in texts])

            def sums(x: np.ndarray, begins: np.ndarray = np.cumsum(n + 2) - (n + 2), real: np.ndarray = real) -> np.ndarray:
                return np.add.reduceat(np.append([0, 0], np.where(real, x, 0)), begins)

            known, slot = sums(own >= 0), slice(row, row + len(texts))
            # words without a place get their log_c by the join, over what their leaf divides by
            for column, x in zip(columns, (n, known, sums(lex.log_c.take(own)) - n * lex.log_all, sums(logs) / math.log(10) - (n - known) * lex.log_unsent), strict=True):
                column[slot] = x
            row += len(texts)
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns), batch.column(2)], ["doc_id", "n_tokens", "n_sent", "base", "model", "others"])


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent words of word, c: at most ``most`` rows, cut between steps of frequency.

    Steps are 1/32 of a doubling, so their counts are a small table at any size of corpus;
    a sort with a limit would send that many rows from each partition to the driver.
    """
    step = F.floor(F.log2("c") * 32).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    lowest, held = None, 0
    for r in sorted(sizes, key=lambda r: -r.step):
        held += r.n
        if held > most:
            break
        lowest = r.step
    return counts.filter(F.lit(False) if lowest is None else step >= lowest)


def lm_score(docs: DataFrame, sent_words: int = SENT_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents whose fold is not 1. Null and empty texts are one end of a
    text. Repeated rows count and are scored as often as they stand; without training
    documents all words are unknown and the model is its start, so a base score is 0 a token; an empty table gives an
    empty table; other columns are ignored. Counts of words beyond the ``sent_words``
    most frequent ones never meet in one place: they are joined to the documents' words.
    """
    spark = docs.sparkSession
    rows = only(docs, doc_id="bigint", text="string")
    training = rows.filter(fold(F.col("doc_id")) != 1)
    counts = materialise(word_counts(training), "lm-counts")
    total, different = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).first())
    top = [(bytes(r.word), r.c) for r in frequent(counts, sent_words).collect()]
    if not any(word == END for word, _ in top):
        top += [(END, r.c) for r in counts.filter(F.length("word") == 0).select("c").collect()]
    lexicon = spark.sparkContext.broadcast(Lexicon(top, total, different))
    replicas = replicas_for(total)
    tokens = materialise(encoded(rows, lexicon, replicas), "lm-tokens")
    learnt = tokens.filter(fold(F.col("doc_id")) != 1)
    words = train_words(dealt(learnt, replicas), lexicon, train(learnt, lexicon))
    model = spark.sparkContext.broadcast((words.w, words.u, words.v))
    scored = tokens.select("doc_id", "places", "others").mapInArrow(lambda b: _released(_scored(b, lexicon.value, Words(lexicon.value, *model.value))), f"doc_id bigint, n_tokens bigint, n_sent bigint, base double, model double, others {_OTHERS}")
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")  # written, so the numbers stay
    discard(tokens)
    words = scored.select("row", F.inline("others"))
    log_c = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    joined = words.join(counts.hint("shuffle_hash"), "word", "left").groupBy("row").agg(F.sum(F.col("n") * log_c).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("also"))
    out = scored.drop("others").join(joined, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", (F.col("n_sent") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))
