"""The plan over fixtures: repairs, provenance, review, rendering, streaming."""

import hashlib
import json

from pyspark.sql import functions as F

from foliant.operators import completeness as C
from foliant.operators import detectors as D
from foliant.operators import evidence as E
from foliant.operators import render as R
from foliant.operators import repairs, review
from foliant.plans import fixtures as X
from foliant.plans.audit import post_render, run_audit
from foliant.sources import readers as S
from foliant.streaming.audit_stream import audit_stream


def test_every_block_once(spark):
    units = X.units(spark)
    out = repairs.apply_repairs(units)
    cited = out.select("doc_id", F.explode("source_refs").alias("unit_id"))
    assert cited.count() == units.count() == cited.distinct().count()
    assert C.dispositions(units, out).filter("disposition = 'escalated'").count() == 0
    first = [r.source_refs for r in out.filter("doc_id = 'merge'").orderBy("phase", "seq").collect()]
    again = [r.source_refs for r in repairs.apply_repairs(units.orderBy(F.rand(3))).filter("doc_id = 'merge'").orderBy("phase", "seq").collect()]
    assert first == again


def test_fragments_join_in_pairs(spark):
    rows = [X._unit("d", i, 0, "text", t, 40, 60 + 16 * i) for i, t in enumerate(["one goes", "on and", "on here", "to end.", "New one"])]
    got = {(r.lead, r.unit_id) for r in repairs.fragment_pairs(X.units(spark, rows)).collect()}
    assert got == {("d:u0", "d:u1"), ("d:u2", "d:u3")}


def test_greedy_rows_take_units_once(spark):
    rows = [X._unit("d", 0, 0, "text", "1", 40, 60, 50), X._unit("d", 1, 0, "text", "2", 40, 62, 50), X._unit("d", 2, 0, "text", "Only one", 100, 61)]
    out = repairs.apply_repairs(X.units(spark, rows)).filter("rule_id = 'A1'").collect()
    assert [r.source_refs for r in out] == [["d:u0", "d:u2"]]


def test_table_numbers(spark):
    table = "<table><tr><th>Term</th><th>Definition</th></tr><tr><td>3.1</td><td>gateway</td></tr><tr><td> 3.2 </td><td>meter</td></tr></table>"
    cell = lambda n, k: (n, f"#embedded-section-{k}:{n}")
    plain = lambda n, s, k: (n, f"#embedded-section-text-{s}-{k}:{n}")
    cases = {
        table: [cell("3.1", 0), cell("3.2", 1)],
        table.replace("Term", "Status").replace("Definition", "Code"): [],
        "x 4.1 Scope of it; version 2.0 alpha; 5.5 bar max": [plain("4.1", 0, 0)],
        # one row of two that count, a cell that is a sentence, a state and a number
        table.replace("meter", "It runs."): [],
        table.replace("<td>meter", "<td>closed"): [],
        table.replace("<td>meter", "<td>12"): [],
        table.replace("</table>", "<tr><td>a</td><td>b</td></tr></table>"): [cell("3.1", 0), cell("3.2", 1)],  # half of four rows
        table.replace("</table>", "<tr><td>a</td><td>b</td></tr>" * 2 + "</table>"): [],
        # words of other tables anywhere
        table.replace("Term", "Name").replace("Definition", "Text").replace("gateway", "alarm"): [],
        # numbers beside the table: known ones and repeated ones aren't given again
        f"2.1 Before it {table} 3.2 meter again, 03.1 gateway; 4.7 After it. See 4.7 after": [cell("3.1", 0), cell("3.2", 1), plain("2.1", 0, 0), plain("4.7", 1, 1)],
        "<TABLE><tr><td>9.9</td></tr></TABLE>1.1 one two": [plain("1.1", 1, 0)],
        # a value is one by the word before it, also where the last match took that word
        "1.2 declared 3.4 Thing": [plain("1.2", 0, 0)],
        "1.2 maximum. 3.4 Thing; pressure\n\t5.6 Thing": [plain("1.2", 0, 0), plain("3.4", 0, 1)],
        "1.2 And so; 1.3 orbit; 1.4 or bit; 1.5 ab": [plain("1.3", 0, 1)],
        "": [],
        None: [],
        "v1.2 Abc 1.3.Abc .1.4 Abc": [],
    }
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "k int, t string").select("k", D.embedded_numbers(F.col("t")).alias("found")).collect()
    got = {r.k: [tuple(e) for e in r.found] for r in rows}
    assert [got[k] for k in range(len(cases))] == list(cases.values())


def test_table_numbers_against_a_scan(spark):
    """The last 32 characters before a match, found by its place."""
    import random
    import re

    rng = random.Random(5)
    parts = ["1.2 ", "2.10 ", "3.4.5 ", "Abc", "declared ", "version\n", "bar", ", ", "; ", "and so on ", "x", " Zeta (b)", "value 7 "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    section, mention, value = (re.compile(p.replace("(?iU)", "(?i)").replace("(?U)", "")) for p in (D.P.TEXT_SECTION, D.P.NON_HEADING, D.P.VALUE_BEFORE))
    want = []
    for t in texts:
        out = []
        for k, m in enumerate(section.finditer(t)):
            if not mention.match(m[2].strip()) and not value.search(t[: m.start()][-32:]) and m[1] not in [n for n, _ in out]:
                out.append((m[1], f"#embedded-section-text-0-{k}:{m[1]}"))
        want.append(out)
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", D.embedded_numbers(F.col("t")).alias("found")).collect()
    assert [[tuple(e) for e in r.found] for r in sorted(rows)] == want
    assert sum(map(len, want)) > 100


def test_full_recovery_is_for_review(spark):
    units = X.units(spark, X.EVIDENCE_UNITS)
    rows = [("doc", "1.2", 0, 2, "1.2 Scope of work", "1.2 Scope of work", 40.0, 60.0, 200.0, 72.0, True)]
    hits = spark.createDataFrame(rows, "doc_id string, anchor string, hit_ord int, page int, snippet string, line_text string, x0 double, y0 double, x1 double, y1 double, heading_like boolean")
    more = E.recover(units, hits)
    assert more.filter("recovery is not null").count() == 1
    assert [r.anchor for r in C.recovered_units(more).collect()] == ["1.2"]
    assert E.recover(more, hits).count() == more.count()


def test_item_ids(spark):
    items = spark.createDataFrame([("F2", "gap", ["b", "a"], ["table 2"], None)], "rule_id string, reason string, source_refs array<string>, anchors array<string>, pages_json string")
    payload = {"rule_id": "F2", "reason": "gap", "refs": ["a", "b"], "anchors": ["table 2"], "pages": []}
    want = hashlib.sha256(json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:20]
    assert review.with_item_ids(items).first().review_item_id == f"review:F2:{want}"


def test_decisions_bind_to_hashes(spark):
    docs = spark.createDataFrame([("a", "me", "now", {"k": "1"}), ("b", "me", "now", {"k": "2"}), ("c", "", "now", {"k": "1"})], "doc_id string, reviewer string, reviewed_at string, artifacts map<string,string>")
    want = spark.createDataFrame([(d, {"k": "1", "none": None}) for d in "abc"], "doc_id string, artifacts map<string,string>")
    got = {r.doc_id: (r.status, r.reason) for r in review.decision_status(docs, want).collect()}
    assert got == {"a": ("applied", None), "b": ("invalid", "artifact_hash_mismatch"), "c": ("invalid", "missing_reviewer_or_reviewed_at")}


def test_rendering(spark):
    rows = [("2.1 Head & more", "emit", "emitted"), ("- item", "emit", "emitted"), ("<table><tr><td onclick=\"x()\">1</td></tr></table>", "emit", "emitted"), ("4.2 Services 7", "TOC_three_column_repair", "merged"), ("gone", "emit", "discarded"), ("a < b", "emit", "emitted")]
    got = [r.h for r in spark.createDataFrame(rows, "raw_text string, operation string, disposition string").select(R.block_html().alias("h")).collect()]
    assert got == ["<h2>2.1 Head &amp; more</h2>", "<li>item</li>", "<table><tr><td>1</td></tr></table>", '<div class="toc-row"><span>4.2 Services</span><span>7</span></div>', "", "<p>a &lt; b</p>"]


def test_audit_and_render_agree(spark):
    audit = run_audit(X.units(spark, None, "repairs", "sections"))
    status = {r.doc_id: r.status for r in audit.status.collect()}
    assert status["sections"] == "draft"
    post = {r.doc_id: (r.status, r.render_status) for r in post_render(audit).collect()}
    assert post["sections"] == ("draft", "pass")
    text = {r.doc_id: r.markdown for r in R.report(audit.status, post_render(audit), audit.items.withColumn("severity", F.lit("needs_review")), audit.findings).collect()}
    assert "`A2` section_number_jump" in text["sections"]


def test_parser_files(spark, tmp_path):
    from foliant.plans.suite import PARSER_JSON

    (tmp_path / "x.json").write_text(PARSER_JSON, encoding="utf-8-sig")
    units = S.read_parser_json(spark, str(tmp_path))
    assert units.count() == 8
    assert S.with_ids(units).filter("dedupe_group_id like 'dg:%'").count() == 8


def test_stream(spark, tmp_path):
    X.units(spark, None, "repairs").write.json(str(tmp_path / "in"))
    audit_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert [r.doc_id for r in spark.read.parquet(str(tmp_path / "out/status")).collect()] == ["repairs"]


def test_empty_tables(spark):
    units = X.units(spark).filter("false")
    assert repairs.apply_repairs(units).count() == 0
    assert D.review_items(units).count() == 0
    assert C.page_coverage(units, repairs.apply_repairs(units)).count() == 0


def test_audit_counts(spark):
    units = X.units(spark, None, "captions", "sections")
    out = repairs.apply_repairs(units)
    full = {r.doc_id: r.asDict() for r in C.audit_counts(units, out).collect()}
    assert all(r["g1_missing"] == r["g2_low"] == r["g3_missing"] == r["g4_missing"] == r["g5_failed"] == 0 for r in full.values())
    assert full["captions"]["g4_anchors"] > 0
    some = C.audit_counts(units, out.filter("raw_text not like '%Table 4%'")).filter("doc_id = 'captions'").first()
    assert (some.g3_missing, some.g4_missing, some.g3_anchors) == (1, 1, full["captions"]["g3_anchors"])


def test_page_findings_agree_with_the_single_audits(spark):
    units = X.units(spark)
    out = repairs.apply_repairs(units).filter("seq % 3 <> 1")
    found = C.page_findings(units, out)
    assert {(r.doc_id, r.page) for r in found.filter("missing").collect()} == {(r.doc_id, r.page) for r in C.missing_pages(units, out).collect()}
    key = lambda df: {(r.doc_id, r.page, r.tokens, r.covered, r.band) for r in df.collect()}
    assert key(found.filter("tokens > 0")) == key(C.page_coverage(units, out))


def test_lost_anchors_against_a_search(spark):
    """Every anchor of the source searched for in every text."""
    import random
    import re

    rng = random.Random(3)
    parts = ["Table 9", "table  9.5", "4.2", "4.2.1", "x4.2", "Figure 3", "figure 33", "Appendix B", "10 bar", "10,5 bar", "ISO 9001", "and", ".", "see", "(4.2)", "UNI/TS 11", "92%"]
    texts = [[" ".join(rng.choice(parts) for _ in range(rng.randint(1, 5))) for _ in range(3)] for _ in range(60)]
    source = spark.createDataFrame([(str(d), t) for d, t in enumerate(x for a, _, _ in [tuple(v) for v in texts] for x in [a])], "doc_id string, text string")
    output = spark.createDataFrame([(str(d), t) for d, (_, b, c) in enumerate(texts) for t in (b, c)], "doc_id string, text string")
    for pattern in (C.P.REQUIRED_ANCHOR, C.P.CANDIDATE_ANCHOR):
        wanted = C.document_anchors(source, pattern)
        have = {d: [" " + " ".join(t.lower().split()) + " " for t in v[1:]] for d, v in enumerate(texts)}
        keep = {(r.doc_id, r.anchor) for r in wanted.collect() if not any(re.search(rf"(?<![\w.]){re.escape(r.anchor)}(?![\w.])", t) for t in have[int(r.doc_id)])}
        also = {(r.doc_id, r.anchor) for r in C.document_anchors(output, pattern).collect()}
        assert {(r.doc_id, r.anchor) for r in C.missing_anchors(wanted, output, pattern).collect()} == keep - also


def test_foreign_lexicon(spark):
    units = X.units(spark, [X._unit("d", 0, 0, "text", "The meter shall zork frob before commissioning and after data checks of all parts here too", 40, 60)])
    assert D.row_items(units, ("C3",)).count() == 0
    assert D.row_items(units, ("C3",), S.lexicon("zork, frob")).count() in (0, 1)
    mixed = X.units(spark, [X._unit("d", n, 0, "text", t, 40, 60 + 20 * n) for n, t in enumerate(["The meter shall zork frob before commissioning", *["plain words of the system stand here in a row"] * 6])])
    assert D.row_items(mixed, ("C3",), S.lexicon("zork, frob")).count() == 1


def test_corpus_audit_agrees_with_its_parts(spark, sf_dir):
    from foliant.plans import suite

    audit = run_audit(X.structured(suite.frag(spark, sf_dir), True))
    lost = {r.doc_id for r in audit.losses.select("doc_id").collect()}
    review_ = {r.doc_id for r in audit.items.select("doc_id").collect()}
    status = {r.doc_id: r.status for r in audit.status.collect()}
    assert status == {d: "review" if d in lost else "draft" if d in review_ else "final" for d in status}
    audit.release()
    items = suite.QUERIES["corpus_review_items"](spark, sf_dir).collect()
    by_rule = {r.rule_id: (r.n, r.docs) for r in suite.QUERIES["corpus_findings_by_rule"](spark, sf_dir).collect()}
    assert by_rule == {rule: (sum(r.n for r in items if r.rule_id == rule), sum(r.rule_id == rule for r in items)) for rule in {r.rule_id for r in items}}
