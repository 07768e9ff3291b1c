"""Sinks: tables, reports as JSON, pages as HTML, PDF by a local browser."""

from __future__ import annotations

import hashlib
import os
import shutil
import subprocess
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import evidence, render
from ..plans.audit import Audit, rendered_losses
from .readers import classify_page

#: Most entries of a list in a report; the tables hold all.
SHOWN = 100


def completeness_report(audit: Audit, counts: DataFrame | None = None) -> DataFrame:
    """doc_id, report: status, counts of the audits, losses, review items and repairs of each document as JSON."""

    def listed(df: DataFrame, name: str, *columns: str) -> DataFrame:
        # numbered before they are gathered, so that no list is longer than what is shown
        nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(*columns))
        return df.withColumn("nth", nth).filter(F.col("nth") <= SHOWN).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))

    counts = audit.counts() if counts is None else counts
    out = audit.status.join(counts.select("doc_id", F.struct(*[c for c in counts.columns if c != "doc_id"]).alias("audits")), "doc_id", "left")
    for df, name, columns in ((audit.losses, "content_loss", ("rule_id", "reason", "source_refs")), (audit.items, "needs_review", ("rule_id", "reason", "source_refs")), (audit.findings, "auto_fixed", ("rule_id", "source_refs", "fixed"))):
        out = out.join(listed(df, name, *columns), "doc_id", "left")
    empty: Column = F.array()
    body = F.struct(F.lit("0.2").alias("schema_version"), F.col("status").alias("document_status"), "audits", *[F.coalesce(c, empty).alias(c) for c in ("content_loss", "needs_review", "auto_fixed")])
    return out.select("doc_id", F.to_json(body).alias("report"))


def summary(audit: Audit, post: DataFrame, delivered: DataFrame | None = None) -> DataFrame:
    """doc_id, statuses after the audit, after rendering and of delivery, and the delivered file.

    ``delivered``: doc_id, delivery_status, artifact of documents for which a PDF was wanted.
    No language model takes part; ``llm_status`` says so.
    """
    out = audit.status.select("doc_id", F.col("status").alias("document_status")).join(post.select("doc_id", F.col("status").alias("post_render_status"), "render_status"), "doc_id", "left")
    if delivered is None:
        out = out.withColumns({"delivery_status": F.lit("html_only"), "artifact": F.lit(None).cast("string")})
    else:
        out = out.join(delivered, "doc_id", "left").withColumn("delivery_status", F.coalesce("delivery_status", F.lit("failed")))
    return out.withColumn("llm_status", F.lit("not_configured"))


def write_audit(audit: Audit, target: str, title: str = "Repaired document", hits: DataFrame | None = None, pages: DataFrame | None = None, pdf: bool = False, browsers: tuple[str, ...] | None = None) -> DataFrame:
    """All tables as Parquet, reports and rendered pages beside them; safe to run again. Gives the summary.

    ``hits``, ``pages``: evidence, written as it was used. ``pdf``: rendered pages are
    printed by a browser of the driver, document by document.
    """
    spark = audit.units.sparkSession

    def put(name: str, frame: DataFrame) -> DataFrame:
        """Writes a table; what comes later reads it instead of reckoning it again."""
        frame.write.mode("overwrite").parquet(f"{target}/{name}")
        return spark.read.parquet(f"{target}/{name}")

    put("units", audit.units)
    put("output_blocks", audit.output)
    put("dispositions", audit.dispositions)
    known = replace(audit, findings=put("findings", audit.findings), items=put("review_items", audit.items), losses=put("losses", audit.losses), status=put("status", audit.status))
    both = known.items.withColumn("severity", F.lit("needs_review")).unionByName(known.losses.withColumn("severity", F.lit("content_loss")))
    put("findings_by_rule", render.findings_by_rule(both))
    counts = put("audit_counts", audit.counts())
    lost = put("post_render_losses", rendered_losses(audit))
    post = put("post_render", render.post_status(known.status, lost))
    put("reports", completeness_report(known, counts))
    rendered = put("pages", render.document_html(audit.output, title))
    put("markdown", render.report(known.status, post, both, known.findings, lost, counts))
    if hits is not None:
        put("source_anchors", evidence.grouped_locations(hits))
        put("source_page_anchors", evidence.page_anchors(hits))
    if pages is not None:
        put("source_pages", pages.withColumn("profile", classify_page(F.col("text_chars"), F.col("image_count"), F.col("drawing_count"))))
    if audit.rejected is not None:
        put("rejected_decisions", audit.rejected)
    return put("summary", summary(known, post, deliver(rendered, target, browsers) if pdf else None))


def deliver(pages: DataFrame, target: str, browsers: tuple[str, ...] | None = None) -> DataFrame:
    """doc_id, delivery_status, artifact: prints each of ``pages`` (doc_id, html) below a local ``target``, one after the other."""
    place = os.path.join(target, "files")
    os.makedirs(place, exist_ok=True)
    rows = []
    for r in pages.toLocalIterator():  # one page at a time
        name = os.path.join(place, hashlib.sha256(r.doc_id.encode()).hexdigest()[:32])
        with open(f"{name}.html", "w", encoding="utf-8") as f:
            f.write(r.html)
        made = html_to_pdf(f"{name}.html", f"{name}.pdf", browsers or BROWSERS)
        there = made["status"] == "created" and os.path.exists(f"{name}.pdf")
        rows.append((r.doc_id, made["status"] == "created", there, f"{name}.pdf" if there else f"{name}.html"))
    out = pages.sparkSession.createDataFrame(rows, "doc_id string, created boolean, present boolean, artifact string")
    return out.select("doc_id", render.delivery_status(F.lit(True), F.col("created"), F.col("present")).alias("delivery_status"), "artifact")


#: Browsers that can print, by the names of their programs.
BROWSERS = ("chrome", "google-chrome", "chromium", "msedge")


def html_to_pdf(page: str, pdf: str, browsers: tuple[str, ...] = BROWSERS) -> dict[str, str | None]:
    """Prints a local HTML file by the first browser that is there."""
    found = next((p for b in browsers if (p := b if os.path.isabs(b) and os.path.exists(b) else shutil.which(b))), None)
    if not found:
        return {"status": "failed", "reason": "no browser found", "artifact": None}
    subprocess.run([found, "--headless=new", "--disable-gpu", f"--print-to-pdf={pdf}", page], check=True, capture_output=True)
    return {"status": "created", "artifact": pdf}


def exit_code(delivery: str) -> int:
    """2 where a wanted PDF is missing, else 0."""
    return 2 if delivery == "failed" else 0
