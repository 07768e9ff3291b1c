"""Provenance and completeness: dispositions, page and token coverage, anchors, samples, status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions import units as U

THRESHOLD, SAMPLE_THRESHOLD = 0.92, 0.85


def hard_floor(threshold: float) -> float:
    return max(0.5, threshold - 0.15)


def dispositions(units: DataFrame, output: DataFrame) -> DataFrame:
    """doc_id, unit_id, granularity, disposition: what became of each unit; the last block that cites it decides, else 'escalated'."""
    cited = output.select("doc_id", F.explode("source_refs").alias("unit_id"), "disposition", F.struct("phase", "seq").alias("at")).groupBy("doc_id", "unit_id").agg(F.max_by("disposition", "at").alias("found"))
    return units.select("doc_id", "unit_id", "granularity").join(cited, ["doc_id", "unit_id"], "left").select("doc_id", "unit_id", "granularity", F.coalesce("found", F.lit("escalated")).alias("disposition"))


def live_units(units: DataFrame, disposed: DataFrame) -> DataFrame:
    """Units that weren't discarded."""
    gone = disposed.filter("disposition = 'discarded'").select("doc_id", "unit_id")
    return units.join(gone, ["doc_id", "unit_id"], "left_anti")


def live_blocks(output: DataFrame) -> DataFrame:
    return output.filter("disposition <> 'discarded'")


def source_pages(units: DataFrame) -> DataFrame:
    """doc_id, page, text: blocks of a page in inventory order."""
    return _pages(units.filter("granularity = 'block'").withColumn("page", F.coalesce("page", F.lit(0))), "ord")


def output_pages(output: DataFrame) -> DataFrame:
    """doc_id, page, text: output blocks of a page in their order."""
    return _pages(live_blocks(output).filter("page is not null"), "phase", "seq")


def _pages(rows: DataFrame, *order: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(*order, U.content().alias("text"))))
    return rows.groupBy("doc_id", "page").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))


def missing_pages(units: DataFrame, output: DataFrame) -> DataFrame:
    """G1: doc_id, page of source pages with text whose output page is blank."""
    full = units.filter((F.col("granularity") == "block") & (T.stripped(U.content()) != "")).select("doc_id", F.coalesce("page", F.lit(0)).alias("page")).distinct()
    there = live_blocks(output).filter(F.col("page").isNotNull() & (T.stripped(U.content()) != "")).select("doc_id", "page")
    return full.join(there, ["doc_id", "page"], "left_anti")


def token_counts(rows: DataFrame, keys: tuple[str, ...], decode: bool = True) -> DataFrame:
    """keys, token, n of a column ``text``."""
    return rows.select(*keys, F.explode(T.canonical_tokens(F.col("text"), decode)).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("n"))


def coverage(source: DataFrame, output: DataFrame, keys: tuple[str, ...], decode: bool = True) -> DataFrame:
    """keys, tokens, covered, ratio: the share of source tokens that the output has, as multisets.

    ``source`` and ``output`` have keys and ``text``, any number of rows for a key. Keys
    without source tokens aren't listed; they are covered.
    """
    def counted(df: DataFrame, side: str) -> DataFrame:
        one = [F.lit(int(side == x)).cast("bigint").alias(x) for x in ("n", "m")]
        return df.select(*keys, F.explode(T.canonical_tokens(F.col("text"), decode)).alias("token"), *one)

    # one sum over both sides instead of a join of two
    both = counted(source, "n").unionByName(counted(output, "m")).groupBy(*keys, "token").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).filter("n > 0")
    sums = both.groupBy(*keys).agg(F.sum("n").alias("tokens"), F.sum(F.least("n", "m")).alias("covered"))
    return sums.withColumn("ratio", F.col("covered") / F.col("tokens"))


def page_coverage(units: DataFrame, output: DataFrame, threshold: float = THRESHOLD, decode: bool = True) -> DataFrame:
    """doc_id, page, tokens, covered, ratio, band ('loss', 'review' or 'pass').

    Tokens are counted per block, as a line end parts words anyway; pages whose
    characters give no token are covered.
    """
    source = units.filter("granularity = 'block'").select("doc_id", F.coalesce("page", F.lit(0)).alias("page"), U.content().alias("text"))
    there = live_blocks(output).filter("page is not null").select("doc_id", "page", U.content().alias("text"))
    return coverage(source, there, ("doc_id", "page"), decode).withColumn("band", _band(F.col("ratio"), threshold))


def page_findings(units: DataFrame, output: DataFrame, threshold: float = THRESHOLD, decode: bool = True) -> DataFrame:
    """G1 and G2 in one sum: doc_id, page, full, missing, tokens, covered, ratio, band of every source page.

    A block counts its tokens and, as an empty one, whether it is blank: so one table of
    counts holds both audits, and texts are cut once for each side. Pages without source
    tokens have no ratio and no band.
    """

    def counted(df: DataFrame, side: str) -> DataFrame:
        full = (T.stripped(U.content()) != "").cast("bigint")
        marks = F.explode(F.concat(F.array(F.struct(F.lit("").alias("token"), full.alias("k"))), F.transform(T.canonical_tokens(U.content(), decode), lambda t: F.struct(t.alias("token"), F.lit(1).cast("bigint").alias("k")))))
        here = F.lit(side == "n")
        return df.select("doc_id", "page", marks.alias("mark"), here.alias("source")).select("doc_id", "page", "mark.token", F.when(here, F.col("mark.k")).otherwise(0).alias("n"), F.when(here, 0).otherwise(F.col("mark.k")).alias("m"), "source")

    source = units.filter("granularity = 'block'").withColumn("page", F.coalesce("page", F.lit(0)))
    there = live_blocks(output).filter("page is not null")
    counts = counted(source, "n").unionByName(counted(there, "m")).groupBy("doc_id", "page", "token").agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.max("source").alias("source"))
    token = F.col("token") != ""
    pages = counts.groupBy("doc_id", "page").agg(
        F.max("source").alias("source"),
        (F.sum(F.when(~token, F.col("n"))) > 0).alias("full"),
        (F.sum(F.when(~token, F.col("m"))) > 0).alias("there"),
        F.sum(F.when(token, F.col("n")).otherwise(0)).alias("tokens"),
        F.sum(F.when(token, F.least("n", "m")).otherwise(0)).alias("covered"),
    )
    ratio = F.when(F.col("tokens") > 0, F.col("covered") / F.col("tokens"))
    return pages.filter("source").select("doc_id", "page", "full", (F.col("full") & ~F.col("there")).alias("missing"), "tokens", "covered", ratio.alias("ratio"), _band(ratio, threshold).alias("band"))


def page_status(findings: DataFrame) -> DataFrame:
    """doc_id, n_loss, n_review, status by the pages of ``page_findings``."""
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("bigint"))
    band = F.col("band")
    sums = findings.groupBy("doc_id").agg((count(F.col("missing")) + count(band == "loss")).alias("n_loss"), count(band == "review").alias("n_review"))
    return sums.withColumn("status", status_of(F.col("n_loss"), F.col("n_review")))


def _band(ratio: Column, threshold: float) -> Column:
    return F.when(ratio < hard_floor(threshold), "loss").when(ratio < threshold, "review").when(ratio.isNotNull(), "pass")


def document_anchors(rows: DataFrame, pattern: str) -> DataFrame:
    """doc_id, anchor: different anchors of a column ``text``."""
    return rows.select("doc_id", F.explode(T.anchors(F.col("text"), pattern)).alias("anchor")).distinct()


def source_text(units: DataFrame, pages: bool = True) -> DataFrame:
    """doc_id, text of blocks and, unless turned off, of whole pages."""
    kinds = ("block", "page") if pages else ("block",)
    return units.filter(F.col("granularity").isin(*kinds)).select("doc_id", U.content().alias("text"))


def missing_anchors(source: DataFrame, output: DataFrame, pattern: str = P.REQUIRED_ANCHOR) -> DataFrame:
    """doc_id, anchor of ``source`` (doc_id, anchor) that no text of ``output`` (doc_id, text) shows as a whole token.

    A whole token begins a run of word signs and points. Anchors that the output has as
    such, and anchors that are one of its runs, fall away in an anti join. The few of
    several runs that are left are joined to the texts by their first run, and only these
    texts are searched.
    """
    text = F.coalesce("text", F.lit(""))
    runs = T.word_runs(T.normalize_anchor(text))
    shown = output.select("doc_id", F.explode(F.array_union(T.anchors(text, pattern), runs)).alias("anchor")).distinct()
    left = source.join(shown, ["doc_id", "anchor"], "left_anti")
    first = F.get(T.word_runs(T.normalize_anchor(F.col("anchor"))), F.lit(0))
    several = left.select("doc_id", "anchor", first.alias("run")).filter(F.col("run") != F.col("anchor"))
    begins = F.filter(F.array_distinct(runs), lambda r: F.rlike(r, F.lit(P.ANCHOR_BEGINS)))
    found = several.join(output.select("doc_id", "text", F.explode(begins).alias("run")), ["doc_id", "run"])
    found = found.filter(T.anchor_present(F.col("anchor"), F.col("text"))).select("doc_id", "anchor").distinct()
    return left.join(found, ["doc_id", "anchor"], "left_anti")


def anchor_loss(units: DataFrame, output: DataFrame, pages: bool = True) -> DataFrame:
    """Required anchors of the source that the output lost."""
    return missing_anchors(document_anchors(source_text(units, pages), P.REQUIRED_ANCHOR), live_blocks(output).select("doc_id", U.content().alias("text")))


def candidate_loss(units: DataFrame, output: DataFrame, pages: bool = True) -> DataFrame:
    """G3C: candidate anchors that the output lost, without bare standard numbers."""
    found = document_anchors(source_text(units, pages), P.CANDIDATE_ANCHOR).filter(~F.rlike("anchor", F.lit(P.BARE_STANDARD)))
    return missing_anchors(found, live_blocks(output).select("doc_id", U.content().alias("text")), P.CANDIDATE_ANCHOR)


def figure_table_difference(units: DataFrame, output: DataFrame) -> DataFrame:
    """Figure and table anchors of the source that aren't in the output; for the audit only."""
    there = document_anchors(live_blocks(output).select("doc_id", U.content().alias("text")), P.FIGURE_TABLE_ANCHOR)
    return document_anchors(source_text(units), P.FIGURE_TABLE_ANCHOR).join(there, ["doc_id", "anchor"], "left_anti")


def audit_counts(units: DataFrame, output: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """What each audit looked at and missed, one row a document.

    doc_id, g1_pages, g1_missing, g2_low, g3_anchors, g3_missing, g3c_anchors, g3c_missing,
    g4_anchors, g4_missing, g5_blocks, g5_failed.
    """
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("bigint"))
    pages = page_findings(units, output, threshold)
    out = pages.groupBy("doc_id").agg(count(F.col("full")).alias("g1_pages"), count(F.col("missing")).alias("g1_missing"), count(F.col("band").isin("loss", "review")).alias("g2_low"))
    samples = sample_coverage(units, output)
    candidates = document_anchors(source_text(units), P.CANDIDATE_ANCHOR).filter(~F.rlike("anchor", F.lit(P.BARE_STANDARD)))
    parts = [
        (document_anchors(source_text(units), P.REQUIRED_ANCHOR), "g3_anchors"), (anchor_loss(units, output), "g3_missing"),
        (candidates, "g3c_anchors"), (candidate_loss(units, output), "g3c_missing"),
        (document_anchors(source_text(units), P.FIGURE_TABLE_ANCHOR), "g4_anchors"), (figure_table_difference(units, output), "g4_missing"),
        (samples, "g5_blocks"), (samples.filter("failed"), "g5_failed"),
    ]
    names = [name for _, name in parts]
    marks = [df.select("doc_id", *[F.lit(int(n == name)).cast("bigint").alias(n) for n in names]) for df, name in parts]
    sums = reduce(DataFrame.unionByName, marks).groupBy("doc_id").agg(*[F.sum(n).alias(n) for n in names])
    return out.join(sums, "doc_id", "left").na.fill(0, names)


def unmapped_blocks(disposed: DataFrame) -> DataFrame:
    """H2: blocks that stand in no output block."""
    return disposed.filter("granularity = 'block' and disposition = 'escalated'").select("doc_id", "unit_id")


def systematic_sample(units: DataFrame, decode: bool = True) -> DataFrame:
    """Up to eight evenly spread blocks of each document with eight tokens or more (column ``tokens``)."""
    review = F.coalesce(F.col("recovery")["requires_review"], F.lit(False))
    rows = units.filter((F.col("granularity") == "block") & ~review).withColumn("tokens", F.size(T.canonical_tokens(U.content(), decode)).cast("bigint")).filter("tokens >= 8")
    w = Window.partitionBy("doc_id")
    rows = rows.select("*", (F.row_number().over(w.orderBy("ord")) - 1).alias("i"), F.count("*").over(w).alias("n"))
    stride = F.greatest(F.lit(1), F.floor(F.col("n") / 5))
    chosen = rows.filter((F.col("n") <= 8) | (F.col("i") == F.col("n") - 1) | (F.col("i") == F.floor(F.col("n") / 2)) | (F.col("i") % stride == 0))
    return chosen.withColumn("nth", F.row_number().over(w.orderBy("i"))).filter("nth <= 8").drop("i", "n", "nth")


def sample_coverage(units: DataFrame, output: DataFrame, decode: bool = True) -> DataFrame:
    """doc_id, unit_id, page, tokens, covered, ratio, failed of each sampled block against the output blocks that cite it."""
    samples = systematic_sample(units, decode)
    cited = live_blocks(output).select("doc_id", F.explode("source_refs").alias("unit_id"), U.content().alias("text"))
    source = samples.select("doc_id", "unit_id", U.content().alias("text"))
    out = coverage(source, cited.join(source.select("doc_id", "unit_id"), ["doc_id", "unit_id"], "left_semi"), ("doc_id", "unit_id"), decode)
    return samples.select("doc_id", "unit_id", "page").join(out, ["doc_id", "unit_id"]).withColumn("failed", F.col("ratio") < SAMPLE_THRESHOLD)


def without_samples(units: DataFrame, samples: DataFrame) -> DataFrame:
    """doc_id of documents with text but no block to sample."""
    full = units.filter((F.col("granularity") == "block") & (T.stripped(U.content()) != "")).select("doc_id").distinct()
    return full.join(samples.select("doc_id"), "doc_id", "left_anti")


def recovered_units(units: DataFrame) -> DataFrame:
    """G3R: recovered units that a person must look at."""
    return units.filter("recovery.requires_review").select("doc_id", "unit_id", "page", F.col("recovery.anchor").alias("anchor"), F.col("recovery.kind").alias("kind"), "dtype", F.substring("raw_text", 1, 240).alias("sample"))


def status_of(losses: Column, reviews: Column) -> Column:
    """'review' with losses, 'draft' with open review items, else 'final'."""
    return F.when(losses > 0, "review").when(reviews > 0, "draft").otherwise("final")


def document_status(units: DataFrame, losses: list[DataFrame], reviews: list[DataFrame], bands: DataFrame | None = None) -> DataFrame:
    """doc_id, n_loss, n_review, status for every document.

    The frames have a doc_id for each finding; ``bands`` has doc_id and band ('loss' and
    'review' count, others don't). All is summed at once.
    """
    marks = lambda df, loss, review: df.select("doc_id", loss.cast("bigint").alias("n_loss"), review.cast("bigint").alias("n_review"))
    zero, one = F.lit(0), F.lit(1)
    parts = [marks(units, zero, zero), *[marks(f, one, zero) for f in losses], *[marks(f, zero, one) for f in reviews]]
    if bands is not None:
        parts.append(marks(bands, F.col("band") == "loss", F.col("band") == "review"))
    sums = reduce(DataFrame.unionByName, parts).groupBy("doc_id").agg(F.sum("n_loss").alias("n_loss"), F.sum("n_review").alias("n_review"))
    return sums.withColumn("status", status_of(F.col("n_loss"), F.col("n_review")))
