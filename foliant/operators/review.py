"""Review decisions: ids of items, binding to artifacts, matching one decision to one item."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def with_item_ids(items: DataFrame) -> DataFrame:
    """review_item_id beside an item's columns (rule_id, reason, source_refs; anchors and pages_json where there are any)."""
    none = {"anchors": F.lit(None).cast("array<string>"), "pages_json": F.lit(None).cast("string")}
    have = {n: F.col(n) if n in items.columns else c for n, c in none.items()}
    return items.withColumn("review_item_id", T.review_item_id("rule_id", "reason", "source_refs", have["anchors"], have["pages_json"]))


def decision_status(decision_docs: DataFrame, expected: DataFrame) -> DataFrame:
    """doc_id, status, reason: 'invalid' without a reviewer or time, or where a hash differs, else 'applied'.

    ``expected``: doc_id, artifacts map of hashes that must be supplied; null ones don't bind.
    """
    both = decision_docs.join(expected.select("doc_id", F.col("artifacts").alias("expected")), "doc_id", "left")
    need = F.filter(F.map_entries(F.coalesce("expected", F.create_map().cast("map<string,string>"))), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    differs = F.exists(need, lambda e: ~F.coalesce(F.try_element_at("artifacts", e["key"]), F.lit("")).eqNullSafe(e["value"]))
    unsigned = (F.coalesce("reviewer", F.lit("")) == "") | (F.coalesce("reviewed_at", F.lit("")) == "")
    reason = F.when(unsigned, "missing_reviewer_or_reviewed_at").when(differs, "artifact_hash_mismatch")
    return both.select("doc_id", F.when(reason.isNotNull(), "invalid").otherwise("applied").alias("status"), reason.alias("reason"))


def match_decisions(items: DataFrame, decisions: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """``items`` with ``decision_idx``: the decision that resolves the item, else null.

    ``items``: doc_id, item_ord, review_item_id, rule_id, reason, source_refs. A decision
    accepts an item of the same id and rule whose references are exactly its own; without
    references its match_reason must be the item's reason. The k-th such item of a
    document takes the k-th such decision. ``status``: see ``decision_status``; decisions of
    invalid documents are none.
    """
    refs = F.array_sort(F.array_distinct(F.filter(F.concat(F.coalesce("source_refs", F.array().cast("array<string>")), F.coalesce("unit_ids", F.array().cast("array<string>"))), lambda r: r != "")))
    valid = decisions.filter("action = 'accept_review' and coalesce(reason, '') <> ''")
    if status is not None:
        valid = valid.join(status.filter("status = 'applied'").select("doc_id"), "doc_id", "left_semi")
    ruled = valid.select("doc_id", "idx", "review_item_id", "rule_id", F.array_join(refs, "\x1f").alias("refs"), "match_reason")
    keyed = items.withColumn("refs", F.array_join(F.array_sort(F.array_distinct(F.filter(F.coalesce("source_refs", F.array().cast("array<string>")), lambda r: r != ""))), "\x1f"))
    key = ["doc_id", "review_item_id", "rule_id"]

    def ranked(df: DataFrame, by: list[str], order: str) -> DataFrame:
        return df.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(order)))

    exact = ranked(keyed, [*key, "refs"], "item_ord").join(ranked(ruled.filter("refs <> ''"), [*key, "refs"], "idx").select(*key, "refs", "k", "idx"), [*key, "refs", "k"])
    exact = exact.select("doc_id", "item_ord", "idx")
    rest = keyed.join(exact.select("doc_id", "item_ord"), ["doc_id", "item_ord"], "left_anti")
    by_reason = ranked(rest, [*key, "reason"], "item_ord").join(ranked(ruled.filter("refs = '' and match_reason is not null").withColumnRenamed("match_reason", "reason"), [*key, "reason"], "idx").select(*key, "reason", "k", "idx"), [*key, "reason", "k"])
    found = exact.unionByName(by_reason.select("doc_id", "item_ord", "idx")).withColumnRenamed("idx", "decision_idx")
    return items.join(found, ["doc_id", "item_ord"], "left")


def rejected_decisions(decisions: DataFrame, matched: DataFrame) -> DataFrame:
    """Decisions that resolved nothing."""
    return decisions.join(matched.filter("decision_idx is not null").select("doc_id", F.col("decision_idx").alias("idx")), ["doc_id", "idx"], "left_anti")


def artifact_hashes(units: DataFrame, output: DataFrame, hits: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """doc_id, artifacts: hashes of a document's units and output blocks in a fixed order and form.

    Decisions bind to these; files of any layout give the same hash. ``hits``: evidence, which
    is bound in the same way; ``files``: doc_id, sha256 of the source files' bytes.
    """

    def hashed(df: DataFrame, order: list[str], columns: list[str], name: str) -> DataFrame:
        row = F.struct(*order, F.to_json(F.struct(*columns)).alias("row"))
        return df.groupBy("doc_id").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["row"]), "\n"), 256).alias(name))

    parts = [hashed(units, ["ord", "unit_id"], ["unit_id", "granularity", "page", "dtype", "raw_text"], "source_inventory_sha256"), hashed(output, ["phase", "seq"], ["output_id", "raw_text", "source_refs", "disposition"], "repair_manifest_sha256")]
    if hits is not None:
        parts.append(hashed(hits, ["anchor", "hit_ord"], ["anchor", "page", "snippet", "line_text", "x0", "y0", "x1", "y1", "heading_like"], "source_pdf_audit_sha256"))
    if files is not None:
        parts.append(files.groupBy("doc_id").agg(F.min("sha256").alias("source_pdf_sha256")))
    both = reduce(lambda a, b: a.join(b, "doc_id", "full"), parts)
    return both.select("doc_id", F.create_map(*[x for name in both.columns[1:] for x in (F.lit(name), F.col(name))]).alias("artifacts"))
