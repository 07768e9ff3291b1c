"""The whole plan: units to repaired blocks, review items, losses and a status for each document."""

from __future__ import annotations

import gc
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import units as U
from ..operators import completeness as C
from ..operators import detectors, evidence, render, repairs, review
from ..ship import ship
from ..sources.readers import rendered_text


@dataclass
class Audit:
    """Frames over all documents; nothing runs until one is read."""

    units: DataFrame
    output: DataFrame
    dispositions: DataFrame
    findings: DataFrame
    items: DataFrame
    losses: DataFrame
    status: DataFrame
    threshold: float = C.THRESHOLD
    rejected: DataFrame | None = None
    live: DataFrame | None = None

    def counts(self) -> DataFrame:
        """What each audit looked at and missed (``completeness.audit_counts``)."""
        return C.audit_counts(self.live, self.output, self.threshold)

    def release(self) -> None:
        for frame in (self.units, self.output, self.dispositions, self.live, self.items, self.losses):
            if frame is not None:
                frame.unpersist()


def _labelled(df: DataFrame, rule: str, reason: str, refs: bool = False) -> DataFrame:
    return df.select("doc_id", F.lit(rule).alias("rule_id"), F.lit(reason).alias("reason"), (F.array("unit_id") if refs else F.array().cast("array<string>")).alias("source_refs")).distinct()


def run_audit(units: DataFrame, hits: DataFrame | None = None, pages: DataFrame | None = None, decisions: tuple[DataFrame, DataFrame] | None = None, threshold: float = C.THRESHOLD, persist: bool = True, recover: bool = True, terms: list[str] = P.ITALIAN_TERMS, files: DataFrame | None = None, not_implemented: tuple[str, ...] = ()) -> Audit:
    """Repairs, detects, audits and gates every document of ``units``.

    ``hits``, ``pages``: evidence from the source files. ``decisions``: decision documents
    and decisions; they resolve review items only, never losses. ``persist`` keeps units,
    output blocks, dispositions, items and losses, which many audits and sinks read; ``release`` lets go.
    ``recover``: are lines of the evidence taken in as units? ``terms``: the foreign lexicon.
    ``files``: doc_id, sha256 of source files, which decisions then bind to as well.
    ``not_implemented``: rules that the caller's parser or repairs leave out; each is a review item of every document.
    """
    ship(units.sparkSession)
    if hits is not None and recover:
        units = evidence.recover(units, hits)
    if persist:
        units = units.persist()
    output = repairs.apply_repairs(units)
    if persist:
        output = output.persist()
    disposed = C.dispositions(units, output)
    live = C.live_units(units, disposed)
    if persist:
        disposed, live = disposed.persist(), live.persist()
    covered = C.page_coverage(live, output, threshold)
    losses = [
        _labelled(C.missing_pages(live, output), "G1", "source_page_has_no_output_content"),
        _labelled(covered.filter("band = 'loss'"), "G2", "page_text_coverage_below_threshold"),
        _labelled(C.anchor_loss(live, output), "G3", "required_anchor_missing"),
        _labelled(C.unmapped_blocks(disposed), "H2", "unmapped_source_blocks"),
    ]
    samples = C.sample_coverage(live, output)
    items = detectors.review_items(units, terms).select("doc_id", "rule_id", "reason", "source_refs", "previous", "current")
    reviews = [
        _labelled(covered.filter("band = 'review'"), "G2", "page_text_coverage_in_review_band"),
        _labelled(C.candidate_loss(live, output), "G3C", "candidate_anchor_missing"),
        _labelled(C.recovered_units(units), "G3R", "source_pdf_recovered_content_requires_review"),
        _labelled(samples.filter("failed").unionByName(C.without_samples(live, samples).select("doc_id"), allowMissingColumns=True), "G5", "local_semantic_sampling_below_threshold"),
    ]
    if hits is not None:
        losses.append(_labelled(evidence.evidence_anchor_loss(hits, output), "G3P", "independent_source_pdf_required_anchor_missing"))
        items = evidence.suppress_gaps(items, hits, pages if pages is not None else hits).filter("not suppressed")
    if pages is not None:
        reviews.append(_labelled(evidence.pages_without_inventory(pages, units), "G1P", "source_pdf_page_has_no_inventory_evidence"))
        reviews.append(_labelled(evidence.media_without_output(pages, units, output), "G4M", "source_pdf_media_has_no_emitted_media_evidence"))
    for rule in not_implemented:
        reviews.append(_labelled(units, rule, "not_implemented_if_applicable"))
    columns = ["doc_id", "rule_id", "reason", "source_refs"]
    rejected = None
    open_items = reduce(DataFrame.unionByName, [items.select(*columns), *reviews])
    if decisions is not None:
        docs, ruled = decisions
        ranked = review.with_item_ids(open_items).withColumn("item_ord", F.xxhash64("rule_id", "reason", "source_refs"))
        matched = review.match_decisions(ranked, ruled, review.decision_status(docs, review.artifact_hashes(units, output, hits, files)))
        rejected = review.rejected_decisions(ruled, matched)
        open_items = matched.filter("decision_idx is null").select(*columns)
    loss = reduce(DataFrame.unionByName, losses)
    if persist:
        open_items, loss = open_items.persist(), loss.persist()
    return Audit(units, output, disposed, repairs.findings(output), open_items, loss, C.document_status(units, [loss], [open_items]), threshold, rejected, live)


def kept(df: DataFrame) -> DataFrame:
    """``df`` reckoned once: in the session's checkpoint folder where there is one."""
    reliable = df.sparkSession.sparkContext.getCheckpointDir() is not None
    return df.checkpoint() if reliable else df.localCheckpoint()


def status_in_parts(units_of: Callable[[int], DataFrame], parts: int) -> DataFrame:
    """``run_audit(...).status`` of all documents, part by part: ``units_of(k)`` has all units of the documents of part k.

    A document's status depends on that document only. What a part keeps and shuffles is let
    go before the next one begins, so the disk in use is that of one part at any size; only
    the statuses stay, in the session's checkpoint folder where there is one.
    """
    done: list[DataFrame] = []
    for k in range(parts):
        audit = run_audit(units_of(k))
        spark = audit.status.sparkSession
        done.append(kept(audit.status))
        audit.release()
        del audit
        gc.collect()
        spark._jvm.System.gc()  # shuffle files go with the plans that they belong to
    return reduce(DataFrame.unionByName, done)


def rendered_losses(audit: Audit, rendered: DataFrame | None = None, boxes: DataFrame | None = None) -> DataFrame:
    """doc_id, rule_id, reason, n: what is lost in rendered texts (doc_id, text) and drawn boxes; without texts in the HTML made here."""
    if rendered is None:
        rendered = render.document_html(audit.output).select("doc_id", rendered_text("html").alias("text"))
    expected = C.document_anchors(C.live_blocks(audit.output).select("doc_id", U.content().alias("text")), P.REQUIRED_ANCHOR)
    return render.post_losses(expected, rendered, boxes)


def post_render(audit: Audit, rendered: DataFrame | None = None, boxes: DataFrame | None = None) -> DataFrame:
    """doc_id, status, render_status after rendering the audited blocks and reading them back."""
    return render.post_status(audit.status, rendered_losses(audit, rendered, boxes))
