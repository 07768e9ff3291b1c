"""Schemas of the tables; all optional columns are nullable."""

RECOVERY = "struct<rule_id:string,anchor:string,kind:string,source:string,requires_review:boolean>"
#: A source unit; x0, y0, x1, y1 are its box in PDF points.
UNITS = f"doc_id string, ord int, unit_id string, granularity string, page int, dtype string, raw_text string, audit_text string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double, recovery {RECOVERY}"
OUTPUT_BLOCKS = "doc_id string, phase int, seq int, output_id string, raw_text string, audit_text string, source_refs array<string>, operation string, confidence double, disposition string, page int"
PAGES = "doc_id string, page int, text_chars bigint, image_count int, drawing_count int, significant_image_count int, significant_drawing_count int"
HITS = "doc_id string, anchor string, hit_ord int, page int, snippet string, line_text string, x0 double, y0 double, x1 double, y1 double, heading_like boolean"
SPANS = "doc_id string, page int, line int, span int, text string, size double, flags int, x0 double, y0 double, x1 double, y1 double"
BOXES = "doc_id string, page int, kind string, x0 double, y0 double, x1 double, y1 double, px0 double, py0 double, px1 double, py1 double"
DECISIONS = "doc_id string, idx int, action string, review_item_id string, rule_id string, source_refs array<string>, unit_ids array<string>, reason string, match_reason string"
DECISION_DOCS = "doc_id string, reviewer string, reviewed_at string, artifacts map<string,string>"
