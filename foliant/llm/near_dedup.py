"""Near-duplicate groups by circulant MinHash, banding and exact verification.

*Signatures.* One permutation places the shingles of a text on a circle; a second one,
shifted by k places, gives coordinate k. All coordinates of a shingle are therefore
neighbours in one table, and a signature is the minimum over such rows.

*Links.* Texts of one word sequence form a class (a SHA-256 of the whole sequence), and
only the class's first document goes on. Documents that share a band fall in a bucket. Each
bucket's smallest document is tested against the others, small buckets are tested in full,
and what is similar is joined. Documents of larger buckets that still hold several
components go on with long signatures: documents outside a bucket's largest component are
tested against the most similar of other components, and in the last round against all
that can be similar. So a group of n copies of one page costs
some n tests, and yet no link that joins two components is left out. All tests are exact,
over the shingles of both whole texts.

*Hot buckets.* Joins by bucket are dealt out by a further hash of the document. The members
of an open bucket lie in blocks, each in one task; only documents outside the largest
component, not all, are copied to every block.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_HASHES, discard, lower_words, materialise, only, slices
from .components import components

#: Places on the circle, coordinates, bands. At 0.8 a pair shares no band of four
#: coordinates with a probability of (1 - 0.8**4)**24, or 5 in a million.
CIRCLE, COORDINATES, BANDS = 1 << 20, 96, 24
#: Coordinates of a long signature; the first ones are those of the short one.
LONG = 1536
#: Pairs that agree in fewer coordinates than these shares of a short and a long signature
#: go untested: 4.4 standard deviations below a similarity of 0.8.
LEAST_SHORT, LEAST_LONG = 0.62, 0.755
#: Most similar signatures of a block that a document is tested against in a round; 0 is all of them.
ROUNDS = (16, 0)
#: Up to so many ids are sent to every task; more are joined.
SENT_IDS = 1_000_000
#: Buckets up to SMALL documents are paired by a join; members of an open bucket's block.
SMALL, BLOCK = 16, 1024
#: Words that a numbering for exact tests holds before another one begins.
MOST_WORDS = 200_000
#: Parts that a bucket's documents are dealt to in joins.
PARTS = 16
SEED = 20240607

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _Q
    return x ^ (x >> np.uint64(29))


@functools.cache
def circle() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second one with its beginning again at its end."""
    rng = np.random.default_rng(SEED)
    first = rng.permutation(CIRCLE).astype(np.uint32)
    second = rng.permutation(CIRCLE).astype(np.uint32)
    return first, np.concatenate([second, second[: LONG - 1]])


@functools.cache
def coordinates(n: int) -> np.ndarray:
    """For each place on the circle, the values of ``n`` coordinates."""
    return np.lib.stride_tricks.sliding_window_view(circle()[1], n)[:CIRCLE]


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles; of all words if fewer."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(h))
    n = len(h) - size + 1
    out = h[:n] * _P
    for k in range(1, size):
        out = _mixed(out) + h[k : k + n] * _P
    return np.unique(_mixed(out))


def signature(hashes: np.ndarray, n: int = COORDINATES) -> np.ndarray:
    rows = coordinates(n)
    at = circle()[0][(hashes & np.uint64(CIRCLE - 1)).astype(np.int64)]
    return np.min([rows[at[i : i + 2048]].min(axis=0) for i in range(0, len(at), 2048)], axis=0)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature; bands differ in their keys."""
    parts = signatures.astype(np.uint64).reshape(len(signatures), BANDS, COORDINATES // BANDS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _P, parts.shape[:2])
    for k in range(parts.shape[2]):
        out = _mixed(out + parts[:, :, k] * _P)
    return out.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        counts, texts, sigs = [], [], []
        for text in batch.column(1).to_pylist():
            words = lower_words(text)
            hashes = shingle_hashes(words, size)
            counts.append(len(hashes))
            texts.append(hashlib.sha256(b" ".join(words)).digest())
            sigs.append(signature(hashes) if len(hashes) else np.zeros(COORDINATES, np.uint32))
        sigs = np.array(sigs, np.uint32).reshape(-1, COORDINATES)
        keys = band_keys(sigs)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
        low = [bytes(x) for x in sigs.astype(np.uint8)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(texts, pa.binary()), pa.array(low, pa.binary()), lists], ["doc_id", "n_shingles", "words", "sig", "bands"])


def signatures(docs: DataFrame, size: int = 2) -> DataFrame:
    """doc_id, n_shingles, words (SHA-256 of the word sequence), sig (low bytes), bands (keys)."""
    rows = only(docs, doc_id="bigint", text="string")
    return rows.mapInArrow(lambda b: _signed(b, size), "doc_id bigint, n_shingles bigint, words binary, sig binary, bands array<bigint>")


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs a, b with sig_a, sig_b: those that agree in enough coordinates."""
    for batch in batches:
        if batch.num_rows:
            sides = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, COORDINATES) for k in (2, 3)]
            keep = (sides[0] == sides[1]).mean(axis=1) >= LEAST_SHORT
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))


def _long(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            sigs, short, counts = np.zeros((part.num_rows, LONG), np.uint8), np.zeros((part.num_rows, COORDINATES), np.uint32), []
            for k, text in enumerate(part.column(1).to_pylist()):
                hashes = shingle_hashes(lower_words(text), size)
                counts.append(len(hashes))
                if len(hashes):
                    whole = signature(hashes, LONG)
                    sigs[k], short[k] = whole.astype(np.uint8), whole[:COORDINATES]
            columns = [pa.array([x.tobytes() for x in rows], pa.binary()) for rows in (sigs, band_keys(short))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), *columns], ["node", "n_shingles", "sig", "keys"])


class Numbered:
    """Shingles as sorted arrays over one numbering of words: exact, and a few bytes a word however long a text is.

    ``tidy``, between two tests, begins a new numbering when ``MOST_WORDS`` are given; sets of the old one are void then.
    """

    def __init__(self, size: int) -> None:
        self.size, self.numbers, self.age = size, {}, 0

    def tidy(self) -> None:
        if len(self.numbers) > MOST_WORDS:
            self.numbers, self.age = {}, self.age + 1

    def __call__(self, text: str | None) -> tuple[int, np.ndarray]:
        """Words of a shingle (all, if there are fewer) and the different shingles."""
        numbers = self.numbers
        words = lower_words(text)
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
        width = min(self.size, len(ids))
        if not width:
            return 0, np.empty(0, np.int64)
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ids, width))
        kind = np.dtype(np.int32 if width == 1 else np.int64 if width == 2 else f"V{4 * width}")
        return width, np.unique(rows.view(kind).ravel())


def similar(x: tuple[int, np.ndarray], y: tuple[int, np.ndarray], percent: int) -> bool:
    """Are two sets of one numbering similar enough?"""
    both = len(np.intersect1d(x[1], y[1], assume_unique=True)) if x[0] == y[0] else 0
    return 100 * both >= percent * (len(x[1]) + len(y[1]) - both)


def _verified(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of pairs a, b with both texts: those whose shingle sets are similar enough."""
    numbered = Numbered(size)
    last: list[tuple] = [(None, None, None), (None, None, None)]

    def known(side: int, node: int, text: str) -> tuple[int, np.ndarray]:
        if last[side][:2] != (node, numbered.age):
            last[side] = node, numbered.age, numbered(text)
        return last[side][2]

    for batch in batches:
        keep = []
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            for a, b, x, y in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                numbered.tidy()
                keep.append(similar(known(0, a, x), known(1, b, y), percent))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _blocks(batches: Iterator[pa.RecordBatch], percent: int, most: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a bucket's outliers with members of a block, if both are in different components.

    Columns key, block, outlier, node, component, main, n_shingles, sig, keys, sorted by the first
    three: the members of a block come first, then the outliers of its bucket. Two outliers
    meet in the block of the larger one, and each pair only in the bucket of its first common band.
    """
    block, members, kept = None, [], None

    def arrays(rows: list[tuple]) -> tuple:
        node, part, main, n, sig, keys = zip(*(r[3:] for r in rows), strict=True)
        sig, keys = np.frombuffer(b"".join(sig), np.uint8).reshape(-1, LONG), np.frombuffer(b"".join(keys), np.int64).reshape(-1, BANDS)
        return np.array(node), np.array(part), np.array(main), np.array(n), sig, np.ascontiguousarray(sig[:, :COORDINATES]), keys

    for batch in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
        rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        outliers = []
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def compare(outliers=outliers, found=found) -> None:
            if not outliers:
                return
            node, part, main, n, sig, short, keys = kept
            for x, x_part, _, x_n, x_sig, x_short, x_keys in zip(*arrays(outliers), strict=True):
                other = np.flatnonzero((part != x_part) & ((part == main) | (node > x)) & (np.minimum(n, x_n) * 100 >= percent * np.maximum(n, x_n)))
                other = other[(short[other] == x_short).mean(axis=1) >= LEAST_SHORT]
                first = (keys[other] == x_keys).argmax(axis=1)
                other = other[x_keys[first] == block[0]]
                agreement = (sig[other] == x_sig).mean(axis=1)
                other, agreement = other[agreement >= LEAST_LONG], agreement[agreement >= LEAST_LONG]
                if most:
                    other = other[np.argsort(-agreement, kind="stable")[:most]]
                if len(other):
                    found.append((np.minimum(node[other], x), np.maximum(node[other], x)))
            outliers.clear()

        for row in rows:
            if row[:2] != block:
                compare()
                block, members, kept = row[:2], [], None
            if row[2]:
                if kept is None:
                    kept = arrays(members) if members else None
                if kept is not None:
                    outliers.append(row)
            else:
                members.append(row)
        compare()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["a", "b"])


def _dealt(bucket: DataFrame) -> DataFrame:
    """Rows of buckets once for each part of their documents."""
    return bucket.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def _part(node: str) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(PARTS)).cast("int").alias("part")


def _similar(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among pairs a, b: both whole texts are fetched and compared."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(lambda x: _verified(x, size, percent), "a bigint, b bigint")


def near_dedup(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their sets of
    ``size``-word shingles (fewer words: the whole sequence is the one shingle); a
    component is what links connect, and its smallest doc_id is its id and stays. Null,
    empty and blank texts have no shingles and link with nothing. Rows that repeat a
    doc_id share its component. Rows with a null doc_id join a class but never stand
    for it, and aren't kept. An empty table gives an empty table. Other columns are
    ignored. ``percent`` below 80 would need other bands. ``n_shingles`` counts different
    64-bit hashes of shingles; links are tested on the shingles themselves.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the bands are made for a similarity of 80 percent or more")
    passing: list[DataFrame] = []

    def written(df: DataFrame, label: str) -> DataFrame:
        """A table that the result doesn't read."""
        passing.append(materialise(df, label))
        return passing[-1]

    signed = materialise(signatures(docs, size).withColumn("row", F.monotonically_increasing_id()), "signatures")  # written, so the numbers stay
    groups = signed.filter("n_shingles > 0").groupBy("words").agg(F.min("doc_id").alias("node"), F.min("row").alias("row"), F.max("n_shingles").alias("n_shingles"))
    classes = materialise(groups.filter("node is not null").join(signed.select("row", "sig", "bands"), "row").select("node", "words", "n_shingles", "sig", "bands"), "classes")
    nodes = classes.select("node", "n_shingles", "sig")

    postings = classes.select("node", F.explode("bands").alias("key"))
    buckets = postings.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("members")).filter("members > 1")
    live = written(postings.withColumn("part", _part("node")).join(_dealt(buckets), ["key", "part"]).drop("part"), "postings")

    # pairs of the first round: stars of all buckets, all pairs of small ones
    few = live.filter(F.col("members") <= SMALL)
    pairs = live.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).unionByName(few.join(few.select("key", F.col("node").alias("b")), "key").filter("node < b and node <> leader").select(F.col("node").alias("a"), "b")).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("sig_b"))
    sized = pairs.join(left, "a").join(right, "b").filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    tested = written(sized.select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing, "a bigint, b bigint"), "tested")

    # only documents of these pairs and of large buckets can have links: their texts are set apart
    large = live.filter(F.col("members") > SMALL)
    wanted = written(tested.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(large.select(F.col("node").alias("doc_id"))).distinct(), "candidates")
    wanted = F.broadcast(wanted) if wanted.count() <= SENT_IDS else wanted
    texts = written(only(docs, doc_id="bigint", text="string").join(wanted, "doc_id", "left_semi"), "texts")
    parts = components(written(_similar(tested, texts, size, percent), "links"))

    long = None
    for most in ROUNDS:
        placed = large.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        sizes = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
        open_keys = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("members"), F.count("*").alias("components")).filter("components > 1")
        open_keys = open_keys.select("key", "main", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
        rest = placed.withColumn("part", _part("node")).join(_dealt(open_keys), ["key", "part"]).select("key", "node", "component", "main", "blocks")
        rest = written(rest, "open-buckets")
        if rest.isEmpty():
            break
        if long is None:
            members = texts.join(rest.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
            long = written(members.mapInArrow(lambda b: _long(b, size), "node bigint, n_shingles bigint, sig binary, keys binary"), "long-signatures")
        own = rest.select("*", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), F.lit(False).alias("outlier"))
        away = rest.filter("component <> main").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("outlier"))
        rows = own.unionByName(away).join(long, "node").select("key", "block", "outlier", "node", "component", "main", "n_shingles", "sig", "keys")
        found = rows.repartition("key", "block").sortWithinPartitions("key", "block", "outlier").mapInArrow(lambda b, most=most: _blocks(b, percent, most), "a bigint, b bigint")
        todo = written(found.distinct().join(tested, ["a", "b"], "left_anti"), "tested")
        more = written(_similar(todo, texts, size, percent), "links")
        tested = tested.unionByName(todo)
        parts = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    for t in passing:
        discard(t)
    ids = classes.select("words", "node").join(parts, "node", "left").select(F.col("words").alias("sequence"), F.coalesce("component", "node").alias("component"))
    out = signed.select("doc_id", "n_shingles", "words").join(ids, F.col("words") == F.col("sequence"), "left")
    found = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", found.alias("component_id"), F.coalesce(F.col("doc_id") == found, F.lit(False)).alias("kept"))
