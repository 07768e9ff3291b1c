"""Connector, sinks, command line, case library."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from foliant import cli
from foliant.operators import evidence, render, repairs, review
from foliant.plans import fixtures as X
from foliant.plans.cases import case_errors
from foliant.plans.suite import PARSER_JSON
from foliant.schemas import BOXES, HITS, SPANS
from foliant.sources import readers, sinks
from foliant.sources.connector import RemoteError, RemoteParser


def packed() -> bytes:
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a/layout.json", PARSER_JSON)
    return raw.getvalue()


class Service:
    def __init__(self, states):
        self.states, self.calls = list(states), []

    def __call__(self, method, url, headers, body, timeout):
        self.calls.append((method, url))
        if method == "POST" and url.endswith("/file-urls/batch"):
            return 200, json.dumps({"code": 0, "data": {"batch_id": "b", "file_urls": ["http://up/x"]}}).encode()
        if method == "PUT":
            return 200, b""
        if "extract-results" in url:
            return 200, json.dumps({"code": 0, "data": {"extract_result": [{"state": self.states.pop(0), "full_zip_url": "http://z/1.zip"}]}}).encode()
        if url.endswith(".zip"):
            return 200, packed()
        return 500, b"no"


def test_connector(tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    assert RemoteParser("http://s", "t").signed_upload(str(tmp_path / "x.pdf"))["status"] == "blocked"
    assert RemoteParser("http://s", "", allow_upload=True).gate() == "no token"
    service = Service(["running", "running", "done"])
    client = RemoteParser("http://s/", "t", allow_upload=True, send=service, sleep=lambda s: None)
    got = client.signed_upload(str(tmp_path / "x.pdf"))
    assert (got["status"], got["polls"]) == ("completed", 3)
    assert client.fetch_results(got["payload"], str(tmp_path / "out"))[0]["layout_json"].endswith("layout.json")
    slow = RemoteParser("http://s", "t", allow_upload=True, max_polls=2, send=Service(["running"] * 2), sleep=lambda s: None)
    assert slow.signed_upload(str(tmp_path / "x.pdf"))["status"] == "timeout"
    with pytest.raises(RemoteError):
        client.multipart("http://s/post", str(tmp_path / "x.pdf"), {"a": "b"})


def test_command_line(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.json").write_text(PARSER_JSON)
    assert cli.main([str(tmp_path / "in"), "-o", str(tmp_path / "out")]) == 0
    report = json.loads(spark.read.parquet(str(tmp_path / "out/reports")).first().report)
    assert report["document_status"] == spark.read.parquet(str(tmp_path / "out/status")).first().status
    assert spark.read.parquet(str(tmp_path / "out/summary")).first().delivery_status == "html_only"
    assert "# Repair report" in spark.read.parquet(str(tmp_path / "out/markdown")).first().markdown


def test_whole_chain(spark, tmp_path, monkeypatch):
    """A file goes to the remote parser; its spans give evidence, an anchor is recovered, pages are printed."""
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    spans = [("layout.json", 0, 0, 0, "1.2 Meters in use", 16.0, 16, 40.0, 300.0, 200.0, 314.0), ("layout.json", 0, 1, 0, "Body of it", 10.0, 0, 40.0, 320.0, 200.0, 330.0), ("layout.json", 0, 2, 0, "and more of it", 10.0, 0, 40.0, 340.0, 200.0, 350.0)]
    names = [c.split()[0] for c in SPANS.split(", ")]
    (tmp_path / "spans.json").write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in spans))
    browser = tmp_path / "browser"
    browser.write_text('#!/bin/sh\nfor a in "$@"; do case $a in --print-to-pdf=*) echo "%PDF" > "${a#--print-to-pdf=}";; esac; done\n')
    browser.chmod(0o755)
    monkeypatch.setattr(sinks, "BROWSERS", (str(browser),))
    monkeypatch.setenv("PARSER_TOKEN", "t")
    base = [str(tmp_path / "x.pdf"), "-o", str(tmp_path / "out"), "--input-kind", "remote", "--base-url", "http://s"]
    assert cli.main(base) == 2  # nothing is sent unless that is allowed
    assert cli.main([*base, "--allow-upload"], send=Service(["running"] * 60), sleep=lambda s: None) == 3
    with pytest.raises(SystemExit):
        cli.main([*base, "--allow-upload", "--recover-anchors"], send=Service(["done"]))
    chain = [*base, "--allow-upload", "--options", "model=x", "--spans", str(tmp_path / "spans.json"), "--heading-ratio", "1.2", "--recover-anchors", "--extra-lexicon", "meters", "--not-implemented", "Z1", "--pdf"]
    assert cli.main(chain, send=Service(["done"])) == 0
    table = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    assert [r.raw_text for r in table("units").filter("recovery is not null").collect()] == ["1.2 Meters in use"]
    assert {"G3R", "Z1"} <= {r.rule_id for r in table("review_items").collect()}
    done = table("summary").first()
    assert (done.delivery_status, done.llm_status) == ("delivered", "not_configured")
    assert open(done.artifact).read().startswith("%PDF")
    assert [(r.anchor, r.places, r.locations[0].page) for r in table("source_anchors").collect()] == [("1.2", 1, 0)]
    counts = table("audit_counts").first()
    assert (counts.g1_missing, counts.g3_missing) == (0, 0)
    assert "## Audit summary" in table("markdown").first().markdown


def test_rendered_artifacts(spark, tmp_path):
    (tmp_path / "a.html").write_text("<title>x</title><p>See 1.2 &amp; Table 3</p>")
    (tmp_path / "b.txt").write_text("\ufeffplain 4.5")
    got = {r.doc_id: r.text.strip() for r in readers.rendered_files(spark, str(tmp_path)).collect()}
    assert got == {"a": "See 1.2 & Table 3", "b": "plain 4.5"}
    expected = spark.createDataFrame([("a", "1.2"), ("a", "table 4"), ("b", "4.5")], "doc_id string, anchor string")
    boxes = spark.createDataFrame([("b", 0, "drawing", -9.0, 0.0, 10.0, 10.0, 0.0, 0.0, 595.0, 842.0)], BOXES)
    rendered = readers.rendered_files(spark, str(tmp_path)).unionByName(spark.createDataFrame([("c", " ")], "doc_id string, text string"))
    lost = {(r.doc_id, r.rule_id, r.n) for r in render.post_losses(expected, rendered, boxes).collect()}
    assert lost == {("a", "I2", 1), ("b", "I3", 1), ("c", "I1", 1)}
    assert readers.file_hashes(spark, str(tmp_path / "b.txt")).first().doc_id == "b.txt"


def test_grouped_locations(spark):
    rows = [("d", "1.2", k, k // 2, f"1.2 at {k}", None, None, None, None, None, False) for k in range(5)]
    hits = spark.createDataFrame(rows, HITS)
    r = evidence.grouped_locations(hits, most=3).first()
    assert (r.places, [x.hit_ord for x in r.locations]) == (5, [0, 1, 2])
    assert {x.page: x.anchor_count for x in evidence.page_anchors(hits).collect()} == {0: 1, 1: 1, 2: 1}


def test_anchors_outside_lines(spark):
    text = "x" * 100 + " see  Table 3\nand 1.2 here " + "y" * 100
    texts = spark.createDataFrame([("d", 0, text), ("d", 1, "1.2 again"), ("d", 2, None)], "doc_id string, page int, text string")
    hits = spark.createDataFrame([("d", "1.2", 0, 0, "1.2 here", "1.2 here", 1.0, 2.0, 3.0, 4.0, True)], HITS)
    got = {(r.anchor, r.hit_ord): (r.page, r.snippet, r.line_text) for r in readers.page_hits(texts, hits).collect()}
    around = " ".join(text[max(0, text.index("Table") - 80) : text.index("Table") + 7 + 80].split())
    assert got == {("1.2", 0): (0, "1.2 here", "1.2 here"), ("1.2", 1): (1, "1.2 again", None), ("table 3", 0): (0, around, None)}
    assert {r.page: r.text_chars for r in readers.text_pages(texts).collect()} == {0: len("".join(text.split())), 1: 8, 2: 0}


def test_decisions_bind_to_evidence_and_files(spark):
    units = X.units(spark, None, "columns")
    out = repairs.apply_repairs(units)
    hits = spark.createDataFrame([("columns", "1.2", 0, 0, "1.2 x", "1.2 x", None, None, None, None, False)], HITS)
    files = spark.createDataFrame([("columns", "ab")], "doc_id string, sha256 string")
    plain, bound = (review.artifact_hashes(units, out, *more).first().artifacts for more in ((), (hits, files)))
    assert set(bound) - set(plain) == {"source_pdf_audit_sha256", "source_pdf_sha256"}
    assert bound["source_pdf_sha256"] == "ab"
    other = review.artifact_hashes(units, out, hits.withColumn("page", F.lit(3)), files).first().artifacts
    assert {k for k in bound if bound[k] != other[k]} == {"source_pdf_audit_sha256"}


def test_pdf_without_browser(tmp_path):
    assert sinks.html_to_pdf("a.html", str(tmp_path / "a.pdf"), ("no-such-browser",))["status"] == "failed"
    assert (sinks.exit_code("failed"), sinks.exit_code("html_only")) == (2, 0)


def test_case_library(spark):
    rows = [(0, "a", "x", "s", "e", "t::test_one"), (1, "a", "x", "s", "e", "t::test_none"), (2, None, None, "s", "e", "m")]
    cases = spark.createDataFrame(rows, "ord int, id string, defect_class string, source string, expected string, covered_by string")
    got = sorted(r.error for r in case_errors(cases, spark.createDataFrame([("test_one",)], "name string")).collect())
    assert got == sorted(["duplicate case id: a", "a references missing test test_none", "case[2] missing id", "case[2] missing defect_class"])
