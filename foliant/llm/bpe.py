"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte ranges. Each merge rank that some neighbours could
use has a bucket of list positions, and a bit in a bitmap of three levels of 64-bit
words; find-first-set on the three levels gives the lowest rank in constant time.
Entries that later merges made stale are skipped when they are taken. So a pre-token of
n bytes costs O(n log n) for the order within buckets, at any length.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import sys
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Generations, only, slices

#: Entries of a worker's cache of pre-tokens.
CACHE = 700_000
#: Longer pre-tokens aren't kept in the cache.
CACHED_CHARS = 64


class Merger:
    """Merges pre-tokens by a table of ranks.

    ``low`` and ``mid`` are the lower levels of the bitmap (a bit for each rank, a bit for
    each word of ``low``); the top level is a number. A pre-token leaves them empty, so
    they serve the next one. Buckets hold positions; of a rank's the leftmost goes first.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        most = max(ranks.values(), default=0)
        self.ranks, self.low, self.mid = ranks, [0] * ((most >> 6) + 1), [0] * ((most >> 12) + 1)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token. Written out in one piece: it runs for every new one."""
        find = self.ranks.get
        if (whole := find(piece)) is not None:
            return [whole]
        n, low, mid, top = len(piece), self.low, self.mid, 0
        follow = list(range(1, n + 1))  # where the part at i ends, and the next begins
        before = list(range(-1, n - 1))
        wanted = [-1] * n  # the rank of the part at i with its neighbour; entries of another rank are stale
        buckets: dict[int, list[int]] = {}
        for i in range(n - 1):
            if (rank := find(piece[i : i + 2])) is not None:
                wanted[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)  # in order, which is a heap
                else:
                    buckets[rank] = [i]
                    low[rank >> 6] |= 1 << (rank & 63)
                    mid[rank >> 12] |= 1 << (rank >> 6 & 63)
                    top |= 1 << (rank >> 12)
        while top:
            # find first set, level by level
            c = (top & -top).bit_length() - 1
            word = mid[c]
            b = c << 6 | (word & -word).bit_length() - 1
            word = low[b]
            rank = b << 6 | (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[b] = word = word & word - 1
                if not word:
                    mid[c] = word = mid[c] & mid[c] - 1
                    if not word:
                        top &= top - 1
            if wanted[i] != rank:
                continue  # stale: i was merged away, or a neighbour has grown
            j = follow[i]
            end = follow[i] = follow[j]
            wanted[i] = wanted[j] = -1
            changed = [(before[i], end)] if before[i] >= 0 else []
            if end < n:
                before[end] = i
                changed.append((i, follow[end]))
            for at, to in changed:
                if (rank := find(piece[at:to])) is None:
                    wanted[at] = -1
                    continue
                wanted[at] = rank
                if rank in buckets:
                    heappush(buckets[rank], at)
                else:
                    buckets[rank] = [at]
                    low[rank >> 6] |= 1 << (rank & 63)
                    mid[rank >> 12] |= 1 << (rank >> 6 & 63)
                    top |= 1 << (rank >> 12)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : follow[i]]])
            i = follow[i]
        return out


class Tokenizer:
    """Encodes and decodes by a rank file; single bytes must all have ranks."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.merge = Merger(self.ranks).merge
        self.split = regex.compile(pattern).findall
        self.cache = Generations(self._packed, CACHE)

    def _packed(self, piece: str) -> bytes:
        ids = array("I", self.merge(piece.encode("utf-8", "surrogatepass")))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        look = self.cache.__getitem__
        return b"".join([look(piece) if len(piece) <= CACHED_CHARS else self._packed(piece) for piece in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One for each Python worker."""
    return Tokenizer(path, pattern)


def _default(path: str | None, pattern: str | None) -> tuple[str, str]:
    """The rank file is read from the tokenizer package of the machine that runs the task."""
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids array<int>: the token ids of each whole text, one narrow pass.

    Null and empty texts have no ids; repeated rows give repeated rows; an empty table
    gives an empty table; other columns are ignored. ``path``: a rank file that every
    executor can open; by default that of the installed tokenizer package.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(*_default(path, pattern))
        for batch in slices(batches):
            ids = [np.frombuffer(tok.encode(t), "<i4") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return only(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, bytes: what the ids of ``encode_documents`` stand for; null ids as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(*_default(path, None))
        for batch in slices(batches):
            texts = [tok.decode(np.array(ids or (), "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "bytes"])

    return only(tokens, doc_id="bigint", ids="array<int>").mapInArrow(run, "doc_id bigint, bytes binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encodes every whole text and decodes the ids again, in one pass.

    doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256,
    n_bytes. Rules for nulls, empty texts and tables as in ``encode_documents``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(*_default(path, pattern))
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                ids = tok.encode(text)
                back = tok.decode(ids)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), len(back)))
            n, a, b, size = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(size, pa.int64())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])

    return only(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint")
