"""Benchmark decontamination by spaced-seed hashing.

Fixed masks choose some of the tokens of a window and ignore the others. Windows of
benchmark items and of documents with equal mask hashes are hits; around each hit the
item is laid along the document, token by token, and the best stretch decides. So a
passage in which single words were exchanged is still found: of items of eight or more
tokens, every way to exchange up to a fifth of them leaves a window that a mask finds
(all ways for 8 to 20 tokens are tested; a longer item has a part of 15 or fewer of which
that holds).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Generations, materialise, only, slices

#: Which tokens of a window are compared (fixed values).
MASKS = ("1101011", "11100101", "110010011", "1010110001", "11111")
#: Items with fewer tokens say too little inside a text: they match texts that have no other tokens.
LEAST_ITEM = 5
#: Items with fewer tokens must match as a whole.
WHOLE_ITEM = 8
#: So many equal tokens in a stretch, or this share of a shorter item, are a leak.
LEAST_TOKENS, LEAST_SHARE = 13, 0.8
#: A benchmark of up to so many tokens is sent to every task; a larger one is joined.
SENT_TOKENS = 500_000
#: Tokens that one step of a task handles, and tokens that are compared at once.
STEP, CELLS = 200_000, 500_000
#: Joined benchmarks: tokens of a part of a document, and parts that each seed is dealt to.
PART, SALTS = 4096, 8
SCHEMA = "doc_id bigint, item_id bigint, matched bigint, aligned bigint, doc_start bigint, item_start bigint"

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_FILTER_BITS = 22
_TOKENS = re.compile(r"\w+").findall
_HASHES = Generations(xxhash.xxh3_64_intdigest, 100_000)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the runs of letters, digits and underscores, in lower case."""
    words = _TOKENS(text.lower()) if text else []
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mask_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each window of the mask's length."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, len(mask) * 1000003 + int(mask, 2), np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            out = (out ^ h[k : k + n]) * _P
            out ^= out >> np.uint64(32)
    return out * _Q


def stretches(item: np.ndarray, tokens: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The best stretch of the item along each diagonal: where it begins at ``at`` of ``tokens``, a text being low to high.

    found, matched, aligned, start (place in the item) for each diagonal. The whole of the
    item counts if enough of its tokens are equal, wherever the others stand; else the
    stretch with the highest sum, where equal tokens add one and others take off two.
    """
    n = len(item)
    if not len(tokens) or not len(at):
        return (np.zeros(len(at), bool), *(np.zeros(len(at), np.int64),) * 3)
    whole, share = (n, n) if n < WHOLE_ITEM else (LEAST_SHARE * n, min(LEAST_TOKENS, int(np.ceil(LEAST_SHARE * n))))
    parts = []
    step = max(1, CELLS // n)
    for i in range(0, len(at), step):
        x, lo, hi = at[i : i + step], low[i : i + step], high[i : i + step]
        places = x[:, None] + np.arange(n)
        within = (places >= lo[:, None]) & (places < hi[:, None])
        same = within & (tokens[np.clip(places, 0, max(0, len(tokens) - 1))] == item)
        equal = same.sum(axis=1)
        total = np.zeros((len(x), n + 1), np.int32)
        np.cumsum(np.where(same, 1, -2), axis=1, out=total[:, 1:])
        least = np.minimum.accumulate(total, axis=1)
        end = (total - least).argmax(axis=1)
        rows = np.arange(len(x))
        start = np.maximum.accumulate(np.where(total == least, np.arange(n + 1), 0), axis=1)[rows, end]
        aligned = end - start
        matched = (total[rows, end] - total[rows, start] + 2 * aligned) // 3  # equal ones add 1, others -2
        full = equal >= whole
        first = np.maximum(0, lo - x)
        found = full | (matched >= share) & (matched >= LEAST_SHARE * aligned)
        parts.append((found, np.where(full, equal, matched), np.where(full, within.sum(axis=1), aligned), np.where(full, first, start)))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


class Index(NamedTuple):
    """A benchmark as arrays: items one behind the other, and their sorted seeds."""

    ids: list[int]
    starts: np.ndarray
    hashes: np.ndarray
    short: dict[tuple[int, ...], list[int]]
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    filter: np.ndarray

    def item(self, k: int) -> np.ndarray:
        return self.hashes[self.starts[k] : self.starts[k + 1]]


def build_index(items: list[tuple[int, str | None]]) -> Index:
    every = [(i, tokens(t)) for i, t in items]
    rows = [(i, h) for i, h in every if len(h) >= LEAST_ITEM]
    short: dict[tuple[int, ...], list[int]] = {}
    for i, h in every:
        if 0 < len(h) < LEAST_ITEM:
            short.setdefault(tuple(h.tolist()), []).append(i)
    seeds, owner, at = [], [], []
    for k, (_, h) in enumerate(rows):
        for mask in MASKS:
            got = mask_hashes(h, mask)
            seeds.append(got)
            owner.append(np.full(len(got), k, np.int32))
            at.append(np.arange(len(got), dtype=np.int32))
    cat = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    seeds, owner, at = cat(seeds, np.uint64), cat(owner, np.int32), cat(at, np.int32)
    order = np.argsort(seeds, kind="stable")
    present = np.zeros(1 << _FILTER_BITS, bool)
    present[(seeds >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    starts = np.concatenate([[0], np.cumsum([len(h) for _, h in rows])]).astype(np.int64)
    return Index([i for i, _ in rows], starts, cat([h for _, h in rows], np.uint64), short, seeds[order], owner[order], at[order], present)


def _found_by_seeds(index: Index, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Different (place in docs, item, place in ``flat`` where the item would begin), one a row, sorted."""
    found = [np.empty((0, 3), np.int64)]
    for mask in MASKS:
        got = mask_hashes(flat, mask)
        at = np.flatnonzero(index.filter[(got >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        low, high = np.searchsorted(index.seeds, got[at], "left"), np.searchsorted(index.seeds, got[at], "right")
        doc = np.searchsorted(starts, at, "right") - 1
        n = np.where(at + len(mask) <= starts[doc + 1], high - low, 0)  # windows across two documents are none
        for i, j in _steps(n):  # a hit may have very many seeds
            seed = np.repeat(low[i:j] - (np.cumsum(n[i:j]) - n[i:j]), n[i:j]) + np.arange(n[i:j].sum())
            rows = np.column_stack([np.repeat(doc[i:j], n[i:j]), index.seed_item[seed], np.repeat(at[i:j], n[i:j]) - index.seed_at[seed]])
            found.append(np.unique(rows, axis=0))
    return np.unique(np.concatenate(found), axis=0)


def _steps(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``CELLS`` entries together."""
    ends = np.cumsum(n)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CELLS, "right")))
        if ends[j - 1] - (ends[i - 1] if i else 0):
            yield i, j
        i = j


def leaks(index: Index, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(place in docs, item_id, and the best stretch) for each document and item that overlap."""
    for d, h in enumerate(docs):
        if index.short and 0 < len(h) < LEAST_ITEM:
            for item_id in index.short.get(tuple(h.tolist()), ()):
                yield d, item_id, len(h), len(h), 0, 0
    if not docs or not index.ids:
        return
    starts = np.concatenate([[0], np.cumsum([len(h) for h in docs])])
    flat = np.concatenate(docs)
    hits = _found_by_seeds(index, flat, starts)
    hits = hits[np.argsort(hits[:, 1], kind="stable")]
    cuts = np.flatnonzero(np.diff(hits[:, 1], prepend=-1, append=-1)) if len(hits) else np.empty(0, np.int64)
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        k = int(hits[i, 1])
        d, at = hits[i:j, 0], hits[i:j, 2]
        found, matched, aligned, start = stretches(index.item(k), flat, starts[d], starts[d + 1], at)
        got = np.column_stack([d, matched, aligned, at - starts[d] + start, start])[found]
        for row in best_of(got, 1):
            yield row[0], index.ids[k], *row[1:]


def best_of(rows: np.ndarray, key: int) -> list[list[int]]:
    """Of rows with the same first ``key`` columns, the one with the highest others."""
    if not len(rows):
        return []
    rows = rows[np.lexsort(rows.T[::-1])]
    last = np.append((rows[1:, :key] != rows[:-1, :key]).any(axis=1), True)
    return rows[last].tolist()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * 6
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in SCHEMA.split(", ")])


def _sent(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids, docs, held = [], [], 0
        texts = batch.column(1).to_pylist()
        for k, (i, text) in enumerate(zip(batch.column(0).to_pylist(), texts, strict=True)):
            h = tokens(text)
            ids.append(i)
            docs.append(h)
            held += len(h)
            if held > STEP or k + 1 == len(texts):
                yield _batch([(ids[d], *rest) for d, *rest in leaks(index, docs)])
                ids, docs, held = [], [], 0


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of texts; a text below LEAST_ITEM tokens has one of its whole."""
    ids, seeds, places, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (ids, seeds, places)]
        for c in (ids, seeds, places):
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["id", "seed", "at"])

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            h = tokens(text)
            for mask in MASKS if len(h) >= LEAST_ITEM else ("1" * len(h),) * bool(len(h)):
                got = mask_hashes(h, mask)
                ids.append(np.full(len(got), i, np.int64))
                seeds.append(got)
                places.append(np.arange(len(got)))
                held += len(got)
            if held > STEP:
                yield flush()
                held = 0
    yield flush()


def _parts(batches: Iterator[pa.RecordBatch], margin: int) -> Iterator[pa.RecordBatch]:
    """id, part, n (tokens of the whole text), hashes of the part's tokens and ``margin`` more on both sides."""
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            h = tokens(text)
            parts = range(-margin // PART, len(h) // PART + 1) if len(h) else ()
            got = [h[max(0, k * PART - margin) : max(0, (k + 1) * PART + margin)].tobytes() for k in parts]
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(got), pa.int64()), pa.array(list(parts), pa.int64()), pa.array([len(h)] * len(got), pa.int64()), pa.array(got, pa.binary())], ["id", "part", "n", "hashes"])


def _pairs(batches: Iterator[pa.RecordBatch], margin: int) -> Iterator[pa.RecordBatch]:
    """doc_id, item_id, item text, part, n, hashes, diagonals of the part: the best stretch of each row."""
    for batch in batches:
        rows = []
        for i, k, item, part, n, hashes, diagonals in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            t, h = tokens(item), np.frombuffer(hashes, np.uint64)
            if len(t) < LEAST_ITEM:
                if len(h) == n == len(t) and (h == t).all():
                    rows.append((i, k, n, n, 0, 0))
                continue
            base = max(0, part * PART - margin)  # place of the first of the hashes
            at = np.array(diagonals, np.int64) - base
            found, matched, aligned, start = stretches(t, h, np.full(len(at), -base), np.full(len(at), n - base), at)
            got = np.column_stack([np.zeros(len(at), np.int64), matched, aligned, at + base + start, start])[found]
            rows += [(i, k, *row[1:]) for row in best_of(got, 1)]
        yield _batch(rows)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(tokens(t)) for t in batch.column(0).to_pylist()], pa.int64())], ["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, sent_tokens: int = SENT_TOKENS) -> DataFrame:
    """One row for each document and benchmark item that overlap.

    doc_id, item_id, matched (equal tokens), aligned (tokens of the stretch), doc_start,
    item_start (tokens). Whole texts are read. Null and empty texts, texts without tokens
    and rows with a null id give no rows; items of fewer than LEAST_ITEM tokens are found
    in texts that have just these tokens. Repeated rows of ``docs`` or ``benchmark`` give
    the same rows as one of them; different texts of one id count as one document or
    item, whose best stretch is given. An empty table on either side gives an empty
    table; other columns are ignored. A benchmark of more than ``sent_tokens`` tokens
    isn't sent to the tasks: its seeds are joined with those of the documents.
    """
    rows = only(docs, doc_id="bigint", text="string").filter("doc_id is not null and text is not null")
    items = only(benchmark, item_id="bigint", text="string").filter("item_id is not null and text is not null").dropDuplicates()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= 2 * sent_tokens:  # a token and its end take two characters at least, so this bounds the tokens
        index = build_index([(r.item_id, r.text) for r in items.collect()])
        sent = docs.sparkSession.sparkContext.broadcast(index)
        found = rows.mapInArrow(lambda b: _sent(b, sent.value), SCHEMA)
        return _best(found)
    margin = items.select("text").mapInArrow(_lengths, "n bigint").agg(F.max("n")).first()[0] or 0
    seeds = "id bigint, seed bigint, at bigint"
    named = items.select(F.xxhash64("item_id", "text").alias("key"), "item_id", F.col("text").alias("item"))
    keyed = rows.select(F.xxhash64("doc_id", "text").alias("doc_key"), "doc_id", "text")
    # every seed of an item stands SALTS times, so that documents with a frequent one are dealt to as many tasks
    of_items = named.select("key", "item").mapInArrow(_seeds, seeds).select(F.col("id").alias("key"), "seed", F.col("at").alias("item_at"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    of_docs = keyed.select("doc_key", "text").mapInArrow(_seeds, seeds).select(F.col("id").alias("doc_key"), "seed", "at", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    hits = of_docs.join(of_items, ["seed", "salt"]).select("doc_key", "key", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    # PART diagonals of a document and an item at most, so no list grows with a text
    pairs = materialise(hits.groupBy("doc_key", "key", F.floor(F.col("diagonal") / PART).alias("part")).agg(F.collect_list("diagonal").alias("diagonals")), "leak-candidates")
    parts = keyed.join(pairs.select("doc_key").distinct(), "doc_key", "left_semi").select("doc_key", "text").mapInArrow(lambda b: _parts(b, margin), "id bigint, part bigint, n bigint, hashes binary").withColumnRenamed("id", "doc_key")
    both = pairs.join(named, "key").join(parts, ["doc_key", "part"]).join(keyed.select("doc_key", "doc_id").distinct(), "doc_key")
    found = both.select("doc_id", "item_id", "item", "part", "n", "hashes", "diagonals").mapInArrow(lambda b: _pairs(b, margin), SCHEMA)
    return _best(found)


def _best(found: DataFrame) -> DataFrame:
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "aligned", "doc_start", "item_start")).alias("best"))
    return best.select("doc_id", "item_id", "best.*")
