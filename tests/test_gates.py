"""Gates: bands of coverage, decisions that lead to final, evidence that closes or opens gaps."""

from pyspark.sql import functions as F

from foliant.operators import completeness as C
from foliant.operators import detectors as D
from foliant.operators import evidence as E
from foliant.operators import repairs, review
from foliant.plans import fixtures as X
from foliant.plans.audit import run_audit
from foliant.schemas import HITS


def output_of(spark, rows):
    return spark.createDataFrame([(d, 4, n, f"out:{n}", t, None, [r], "emit", "emitted", p) for n, (d, p, t, r) in enumerate(rows)], "doc_id string, phase int, seq int, output_id string, raw_text string, audit_text string, source_refs array<string>, operation string, disposition string, page int")


def test_bands(spark):
    """Eight of ten tokens are for review, seven a loss, the same number of other tokens too."""
    ten = "a b c d e f g h i j"
    units = X.units(spark, [X._unit(d, 0, 0, "text", ten, 40, 60) for d in ("all", "eight", "seven", "other", "none")])
    texts = {"all": ten, "eight": "a b c d e f g h x y", "seven": "a b c d e f g", "other": "q r s t u v w x y z"}
    out = output_of(spark, [(d, 0, t, f"{d}:u0") for d, t in texts.items()])
    got = {r.doc_id: (r.band, r.ratio) for r in C.page_coverage(units, out).collect()}
    assert got == {"all": ("pass", 1.0), "eight": ("review", 0.8), "seven": ("loss", 0.7), "other": ("loss", 0.0), "none": ("loss", 0.0)}
    assert [r.doc_id for r in C.missing_pages(units, out).collect()] == ["none"]
    assert {r.doc_id for r in C.page_coverage(units, out, threshold=1.01).filter("band = 'review'").collect()} == {"all"}


def test_decisions_lead_to_final(spark):
    units = X.units(spark, None, "columns")
    first = run_audit(units)
    assert [r.status for r in first.status.collect()] == ["draft"]
    items = review.with_item_ids(first.items).collect()
    ruled = [(r.doc_id, k, "accept_review", r.review_item_id, r.rule_id, list(r.source_refs), [], "looked at", r.reason) for k, r in enumerate(items)]
    decisions = spark.createDataFrame(ruled, "doc_id string, idx int, action string, review_item_id string, rule_id string, source_refs array<string>, unit_ids array<string>, reason string, match_reason string")
    docs = review.artifact_hashes(first.units, first.output).select("doc_id", F.lit("me").alias("reviewer"), F.lit("now").alias("reviewed_at"), "artifacts")
    assert [r.status for r in run_audit(units, decisions=(docs, decisions)).status.collect()] == ["final"]
    stale = docs.withColumn("artifacts", F.map_concat(F.map_filter("artifacts", lambda k, v: k != "repair_manifest_sha256"), F.create_map(F.lit("repair_manifest_sha256"), F.lit("old"))))
    assert [r.status for r in run_audit(units, decisions=(stale, decisions)).status.collect()] == ["draft"]
    first.release()


def hits(spark, rows):
    return spark.createDataFrame([(d, a, n, p, t, t, 40.0, 60.0, 200.0, 72.0, like) for d, a, n, p, t, like in rows], HITS)


def test_recovery_closes_a_gap(spark):
    units = X.units(spark, [X._unit("d", 0, 0, "title", "1.1 First", 40, 60), X._unit("d", 1, 0, "text", "Body text.", 40, 90), X._unit("d", 2, 2, "title", "1.3 Third", 40, 60)])
    assert {r.rule_id for r in D.section_gaps(units).collect()} == {"A2", "F1"}
    more = E.recover(units, hits(spark, [("d", "1.2", 0, 1, "1.2 Second part", True)]))
    assert D.section_gaps(more).count() == 0
    assert C.recovered_units(more).count() == 1
    mention = hits(spark, [("d", "1.2", 0, 1, "1.2 .......... 9", True), ("d", "1.2", 1, 1, "1.2 bar of it", True)])
    assert E.recover(units, mention).count() == units.count()
    assert [r.anchor for r in E.recovery(units, mention)[1].collect()] == ["1.2"]


def test_gaps_are_kept_without_evidence(spark):
    units = X.units(spark, None, "captions")
    items = D.caption_gaps(units)
    none = hits(spark, [("captions", "table 2", 0, 0, "Table 2 Known", False)])
    kept = {r.reason: r.suppressed for r in E.suppress_gaps(items, none, none).collect()}
    assert kept == {"table_number_sequence_gap": False, "figure_number_sequence_gap": True}
    assert not any(r.suppressed for r in E.suppress_gaps(items, none.limit(0), none.limit(0)).collect())


def test_anchor_kept_in_other_words_is_no_loss(spark):
    units = X.units(spark, [X._unit("d", 0, 0, "text", "See Table 3 and 4.2 here", 40, 60), X._unit("d", 1, 0, "text", "Appendix B too", 40, 80)])
    out = output_of(spark, [("d", 0, "see table 3 and", "d:u0")])
    assert {r.anchor for r in C.anchor_loss(units, out).collect()} == {"4.2", "appendix b"}
    same = repairs.apply_repairs(units)
    assert C.anchor_loss(units, same).count() == 0
    assert {r.ratio for r in C.sample_coverage(X.units(spark), repairs.apply_repairs(X.units(spark))).collect()} == {1.0}
