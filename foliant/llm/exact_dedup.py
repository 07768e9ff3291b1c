"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

Every text is cut where its own content says so, and becomes a *recipe*: the ordered
list of identifiers of its chunks. The corpus-wide chunk dictionary (one row per
different chunk, combined before the shuffle) verifies the identifiers against the
chunks' whole contents; two texts are equal exactly if their recipes are. The text of
a chunk crosses the network once, for the dictionary; all later steps compare and move
eight bytes a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, only

#: A chunk ends after a space behind a character that is no vowel and before one of b-p,
#: the first such place after MIN characters; without one, after MAX characters.
MIN_CHUNK, MAX_CHUNK = 256, 4096


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty. Single spaces aren't touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    return rf"(?s).{{{least},{most}}}?[^aeiou]\x20(?=[b-p])|.{{1,{most}}}"


def _identifier(chunk: Column, bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else F.shiftrightunsigned(h, 64 - bits)


def recipes(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK, hash_bits: int = 64) -> DataFrame:
    """doc_id, text_sha256, n_chars, ids array<bigint>, fixes array<struct<pos,ord>>.

    ``ids`` are hashes of chunks. Where the dictionary shows that a hash stands for
    several contents, ``fixes`` holds the rank of the content for each such position
    that isn't the first content; it is empty otherwise.
    """
    base = only(docs, doc_id="bigint", text="string").select("doc_id", normalised(F.col("text")).alias("norm"))
    cut = base.select("doc_id", F.sha2(F.col("norm"), 256).alias("text_sha256"), F.length("norm").cast("bigint").alias("n_chars"), F.regexp_extract_all("norm", F.lit(chunk_pattern(least, most)), F.lit(0)).alias("chunks"))
    lists = materialise(cut.select("doc_id", "text_sha256", "n_chars", F.transform("chunks", lambda c: _identifier(c, hash_bits)).alias("ids")), "recipes")
    dictionary = cut.select(F.explode("chunks").alias("chunk")).select(_identifier(F.col("chunk"), hash_bits).alias("id"), "chunk").distinct()
    shared = materialise(dictionary.groupBy("id").agg(F.count("*").alias("contents")).filter("contents > 1").select("id"), "shared-ids")
    empty = F.array().cast("array<struct<pos:int,ord:bigint>>")
    if shared.isEmpty():  # every hash stands for one content: the hashes are verified identifiers
        return lists.withColumn("fixes", empty)
    spread = cut.select(F.xxhash64("doc_id", "text_sha256").alias("row"), "doc_id", "text_sha256", F.posexplode("chunks").alias("pos", "chunk")).withColumn("id", _identifier(F.col("chunk"), hash_bits)).join(shared, "id", "left_semi")
    contents = spread.select("id", "chunk").distinct()
    # rank of a content among those of its hash: how many of them sort before it
    other = contents.select("id", F.col("chunk").alias("before"))
    ranks = contents.join(other, "id").filter("before < chunk").groupBy("id", "chunk").agg(F.count("*").alias("ord"))
    fixes = spread.join(ranks, ["id", "chunk"]).groupBy("doc_id", "text_sha256").agg(F.array_sort(F.collect_set(F.struct("pos", "ord"))).alias("fixes"))
    fixes = fixes.withColumnRenamed("doc_id", "fix_doc").withColumnRenamed("text_sha256", "fix_sha")
    return lists.join(fixes, lists.doc_id.eqNullSafe(fixes.fix_doc) & (lists.text_sha256 == fixes.fix_sha), "left").select("doc_id", "text_sha256", "n_chars", "ids", F.coalesce("fixes", empty).alias("fixes"))


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars, n_chunks.

    Null and empty texts are equal. Of equal texts the smallest doc_id stays; rows with
    a null doc_id never stay if another row does, and rows that repeat a doc_id are all
    kept if that id stays. An empty table gives an empty table. Other columns of
    ``docs`` are ignored. ``options`` are those of ``recipes``.
    """
    rows = recipes(docs, **options)
    groups = rows.groupBy("ids", "fixes").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # combined before the shuffle; the join meets a large group with one row, and
    # adaptive execution splits the large side
    return rows.join(groups, ["ids", "fixes"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_chars", F.size("ids").cast("bigint").alias("n_chunks"))


#: The same rows in DuckDB.
ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g ON n.norm = g.norm
"""
