"""Evidence from PDF files, where the optional PDF library is installed.

Elsewhere tables of pages and spans that were extracted before (schemas.PAGES, SPANS) serve.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BOXES, PAGES, SPANS
from ..ship import ship

#: A picture or drawing is significant from this share of its page on.
SIGNIFICANT = 0.02


def _library():
    try:
        import fitz
    except ImportError as e:
        raise ImportError("reading PDF files needs PyMuPDF; give tables of pages and spans instead") from e
    return fitz


def _files(spark: SparkSession, path: str) -> DataFrame:
    ship(spark)
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("doc_id"), "content")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, page, text_chars and counts of images and drawings, all and significant (schemas.PAGES)."""
    _library()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitz = _library()
        for batch in batches:
            rows = []
            for doc_id, content in zip(batch.doc_id, batch.content, strict=True):
                for n, page in enumerate(fitz.open(stream=content, filetype="pdf")):
                    area = max(page.rect.width * page.rect.height, 1)
                    images = [r for i in page.get_images(full=True) for r in page.get_image_rects(i[0])]
                    drawings = [d["rect"] for d in page.get_drawings() if d.get("rect")]
                    large = [sum(r.width * r.height >= SIGNIFICANT * area for r in rects) for rects in (images, drawings)]
                    rows.append((doc_id, n, len("".join((page.get_text("text") or "").split())), len(page.get_images(full=True)), len(drawings), *large))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGES.split(", ")])

    return _files(spark, path).mapInPandas(run, PAGES)


def read_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, page, text of every page."""
    _library()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitz = _library()
        for batch in batches:
            rows = [(doc_id, n, page.get_text("text") or "") for doc_id, content in zip(batch.doc_id, batch.content, strict=True) for n, page in enumerate(fitz.open(stream=content, filetype="pdf"))]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "text"])

    return _files(spark, path).mapInPandas(run, "doc_id string, page int, text string")


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    """Spans of text with font and box (schemas.SPANS); see ``readers.span_lines``."""
    _library()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitz = _library()
        for batch in batches:
            rows = []
            for doc_id, content in zip(batch.doc_id, batch.content, strict=True):
                for n, page in enumerate(fitz.open(stream=content, filetype="pdf")):
                    lines = [x for b in page.get_text("dict").get("blocks", []) if b.get("type") == 0 for x in b.get("lines", [])]
                    rows += [(doc_id, n, k, s, span.get("text", ""), float(span.get("size", 0)), int(span.get("flags", 0)), *map(float, line["bbox"])) for k, line in enumerate(lines) for s, span in enumerate(line.get("spans", []))]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SPANS.split(", ")])

    return _files(spark, path).mapInPandas(run, SPANS)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the file's name without its ending), text of rendered PDF files."""
    _library()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitz = _library()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id.str.replace(r"\.[^.]*$", "", regex=True), "text": ["\n".join(page.get_text("text") or "" for page in fitz.open(stream=c, filetype="pdf")) for c in batch.content]})

    return _files(spark, path).mapInPandas(run, "doc_id string, text string")


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Boxes of text blocks and drawings of rendered PDF files with those of their pages (schemas.BOXES), for I3."""
    _library()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitz = _library()
        for batch in batches:
            rows = []
            for doc_id, content in zip(batch.doc_id.str.replace(r"\.[^.]*$", "", regex=True), batch.content, strict=True):
                for n, page in enumerate(fitz.open(stream=content, filetype="pdf")):
                    drawn = [("text_block", b[:4]) for b in page.get_text("blocks") or []] + [("drawing", tuple(d["rect"])) for d in page.get_drawings() if d.get("rect")]
                    rows += [(doc_id, n, kind, *map(float, box), *map(float, page.rect)) for kind, box in drawn]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in BOXES.split(", ")])

    return _files(spark, path).mapInPandas(run, BOXES)
