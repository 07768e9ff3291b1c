"""Repairs and audits documents from the command line: ``python -m foliant.cli INPUT -o TARGET``.

INPUT is parser output, units, or a file for a remote parser; the source file's own evidence,
review decisions and a lexicon are optional. The exit code is 2 where a PDF was wanted and
couldn't be made, or where a file may not be sent, and 3 where the remote parser took too long.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.audit import run_audit
from .schemas import HITS, PAGES, SPANS
from .ship import ship
from .sources import pdf, readers, sinks
from .sources.connector import RemoteParser


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", help="parser JSON files, units as JSON lines, or a file for the remote parser")
    parser.add_argument("-o", "--output", required=True)
    parser.add_argument("--input-kind", choices=["parser", "units", "remote"], default="parser")
    parser.add_argument("--title", default="Repaired document")
    parser.add_argument("--text-threshold", type=float, default=0.92)
    source = parser.add_argument_group("evidence of the source files")
    source.add_argument("--source-pdf", help="the PDF files themselves; needs the optional PDF library")
    source.add_argument("--hits", help="JSON lines of anchors' places")
    source.add_argument("--spans", help="JSON lines of text spans, from which places are made")
    source.add_argument("--page-texts", help="JSON lines of pages' texts (doc_id, page, text), for anchors that no span shows")
    source.add_argument("--heading-ratio", type=float, help="a line with a font so many times the page's counts as a heading")
    source.add_argument("--pages", help="JSON lines of pages")
    source.add_argument("--recover-anchors", action="store_true", help="take lines of missing anchors in as units for review")
    parser.add_argument("--decisions", help="JSON lines of review decisions")
    parser.add_argument("--lexicon", default="", help="foreign terms in place of the fixed list, apart by commas")
    parser.add_argument("--extra-lexicon", default="", help="foreign terms beside the list")
    parser.add_argument("--not-implemented", default="", help="rules that the parser leaves out, apart by commas")
    parser.add_argument("--pdf", action="store_true", help="print the rendered pages by a local browser")
    remote = parser.add_argument_group("remote parser")
    remote.add_argument("--base-url", default="")
    remote.add_argument("--allow-upload", action="store_true", help="without it nothing is sent")
    remote.add_argument("--token-variable", default="PARSER_TOKEN", help="name of the environment variable with the token")
    remote.add_argument("--options", default="", help="KEY=VALUE settings, one a line")
    return parser.parse_args(argv)


def parsed_remotely(args: argparse.Namespace, send=None, sleep=None) -> tuple[str | None, str]:
    """Folder of parser files that the service made of the input, or None and why."""
    more = ({"send": send} if send else {}) | ({"sleep": sleep} if sleep else {})
    client = RemoteParser(args.base_url, os.environ.get(args.token_variable, ""), args.allow_upload, **more)
    got = client.signed_upload(args.input, readers.key_values(args.options))
    if got["status"] != "completed":
        return None, got.get("reason", got["status"])
    found = client.fetch_results(got["payload"], os.path.join(args.output, "remote"))
    layouts = [r["layout_json"] for r in found if r["layout_json"]]
    return (os.path.dirname(layouts[0]), "") if layouts else (None, "no layout in the results")


def evidence_of(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """Anchors' places, pages and file hashes, as far as they are given."""
    hits = spark.read.schema(HITS).json(args.hits) if args.hits else None
    pages = spark.read.schema(PAGES).json(args.pages) if args.pages else None
    spans = spark.read.schema(SPANS).json(args.spans) if args.spans else None
    texts = spark.read.schema("doc_id string, page int, text string").json(args.page_texts) if args.page_texts else None
    files = None
    if args.source_pdf:
        files = readers.file_hashes(spark, args.source_pdf).select("doc_id", "sha256")
        pages = pdf.read_pages(spark, args.source_pdf) if pages is None else pages
        texts = pdf.read_page_texts(spark, args.source_pdf) if texts is None else texts
        spans = pdf.read_spans(spark, args.source_pdf) if spans is None and hits is None else spans
    if hits is None and spans is not None:
        hits = readers.anchor_hits(readers.span_lines(spans), args.heading_ratio)
    if texts is not None:
        pages = readers.text_pages(texts) if pages is None else pages
        hits = readers.page_hits(texts, hits if hits is not None else spark.createDataFrame([], HITS))
    return hits, pages, files


def main(argv: list[str] | None = None, send=None, sleep=None) -> int:
    args = arguments(argv)
    if args.input_kind == "remote":
        place, why = parsed_remotely(args, send, sleep)
        if place is None:
            print(f"no result: {why}")
            return 3 if why == "timeout" else 2
        args.input = place
    spark = SparkSession.builder.appName("foliant").config("spark.sql.ui.retainedExecutions", "20").config("spark.sql.maxPlanStringLength", "20000").getOrCreate()  # the plans are long
    ship(spark)
    units = readers.read_units(spark, args.input) if args.input_kind == "units" else readers.read_parser_json(spark, args.input)
    hits, pages, files = evidence_of(spark, args)
    if args.recover_anchors and hits is None:
        raise SystemExit("--recover-anchors needs evidence: --source-pdf, --spans or --hits")
    decisions = readers.read_decisions(spark, args.decisions) if args.decisions else None
    rules = tuple(r.strip() for r in args.not_implemented.split(",") if r.strip())
    audit = run_audit(units, hits, pages, decisions, args.text_threshold, recover=args.recover_anchors, terms=readers.lexicon(args.lexicon, args.extra_lexicon), files=files, not_implemented=rules)
    done = sinks.write_audit(audit, args.output, args.title, hits, pages, args.pdf)
    for row in done.groupBy("document_status").agg(F.count("*").alias("n")).orderBy("document_status").collect():
        print(f"{row.document_status}: {row.n}")
    return max([sinks.exit_code(r.delivery_status) for r in done.select("delivery_status").distinct().collect()], default=0)


if __name__ == "__main__":
    raise SystemExit(main())
