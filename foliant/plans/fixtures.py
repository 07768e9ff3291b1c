"""Small relations for rules that no corpus table triggers; the same rows for Spark and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import UNITS

_COLUMNS = "doc_id, ord, unit_id, granularity, page, dtype, raw_text, x0, y0, x1, y1"


def _unit(doc: str, n: int, page: int, dtype: str, text: str, x0: float, y0: float, x1: float | None = None) -> tuple:
    return (doc, n, f"{doc}:u{n}", "block", page, dtype, text, float(x0), float(y0), float(x1 if x1 is not None else x0 + 200), float(y0 + 12))


def _document(doc: str, rows: list[tuple]) -> list[tuple]:
    return [_unit(doc, n, *row) for n, row in enumerate(rows)]


#: Documents named by the rules they are about; page, dtype, text, x0, y0[, x1].
UNIT_ROWS = [
    *_document("merge", [(0, "text", "3.3", 40, 100, 60), (0, "text", "Application layer", 110, 102), (0, "text", "4", 42, 200, 55), (0, "text", "Far away", 110, 240), (0, "text", "B.2", 45, 300, 62), (0, "text", "Annex tests", 100, 304), (0, "text", "Right side note", 320, 301), (0, "text", "5.1", 200, 400, 220), (0, "text", "Not isolated", 320, 400)]),
    *_document("toc", [(1, "toc_number", "4.2", 40, 90, 60), (1, "toc_title", "Services", 120, 91), (1, "toc_page", "7", 500, 90), (1, "text", "5", 45, 120, 55), (1, "text", "Remote data", 150, 122), (1, "text", "12", 510, 121), (1, "text", "6", 45, 160, 55), (1, "text", "No page here", 150, 162), (2, "text", "7.1", 44, 90, 60), (2, "text", "Alarms", 150, 95), (2, "text", "19", 470, 94)]),
    *_document("sections", [(0, "title", "1 Scope", 40, 60), (0, "text", "It covers meters.", 40, 90), (0, "title", "1.1 General", 40, 120), (0, "text", "Some text.", 40, 150), (0, "title", "1.4 Late part", 40, 180), (0, "text", "12 pages follow.", 40, 200), (1, "title", "2 Terms", 40, 60), (1, "text", "Text.", 40, 90), (1, "title", "5 Jump", 40, 120), (1, "text", "88 is no section", 40, 150), (1, "text", "6% of all", 40, 170), (1, "title", "5.2 First", 40, 200), (1, "text", "7) a footnote", 40, 230), (1, "title", "5.3 Next", 40, 260)]),
    *_document("captions", [(0, "caption", "Table 1 Values", 40, 60), (0, "text", "See Table 9 for more. Then go on.", 40, 90), (0, "caption", "Table 4 Limits", 40, 120), (1, "caption", "Figure 1 Layout", 40, 60), (1, "caption", "Figure 2 Wiring", 40, 90), (1, "image", "Figure 5", 40, 720), (1, "caption", "Table 5 Late", 40, 710)]),
    *_document("headings", [(0, "title", "Overview", 40, 60), (0, "title", "Details", 40, 90), (0, "text", "Body.", 40, 120), (0, "title", "2 Parent", 40, 150), (0, "title", "2.1 Child", 40, 180), (0, "text", " ", 40, 200), (0, "title", "2.2 The value shall be set", 40, 220), (0, "text", "Text between.", 40, 240), (1, "title", "3 Broken head-", 40, 60), (1, "title", "4 Following", 40, 90), (1, "text", "End.", 40, 120)]),
    *_document("short", [(0, "text", "one", 40, 60), (0, "text", "two words", 40, 80), (0, "text", "three", 40, 100), (0, "text", "four", 40, 120), (0, "text", "A full sentence ends it.", 40, 140), (0, "text", "five", 40, 160), (0, "text", "six.", 40, 180), (0, "text", "key: value", 40, 200), (0, "text", "seven", 40, 220)]),
    *_document("columns", [(0, "text", "left part", 40, 60, 200), (0, "text", "right part", 320, 61), (0, "text", "next line", 40, 100, 200), (0, "text", "close by", 250, 101), (0, "text", "name:", 40, 140, 100), (0, "text", "octet string", 320, 141), (0, "list", "other type", 40, 180, 100), (0, "text", "beside it", 320, 181)]),
    *_document("terms", [(0, "text", "The gateway is the device. A gateway is defined here.", 40, 60), (0, "text", "A meter is read when defined by rules.", 40, 90), (0, "text", "The value of a meter as defined there", 40, 120), (0, "text", "An endpoint as defined later", 40, 150), (0, "text", "endpoint is a node", 40, 180), (0, "text", "Some endpoint defined again", 40, 210)]),
    *_document("foreign", [(0, "text", "The meter shall essere configurato before commissioning and after data checks of all parts of system", 40, 60), (0, "text", "The meter shall be set before commissioning and after that a person reads every line of the long page again so that many plain words stand here and the share of others stays low", 40, 90)]),
    *_document("numbers", [(0, "text", "Set 10 xyz and 5 bar", 40, 60), (0, "text", "On 3 March at 20 m3/h", 40, 80), (0, "text", "Version 2.5 abc of 1500 abc", 40, 100), (0, "text", "Keep 7 qq, then 8 rr", 40, 120), (0, "text", "The 4 Items and 6 ABC", 40, 140)]),
    *_document("italian", [(0, "text", "il contatore deve essere configurato per la lettura remota del valore ogni giorno della settimana e del mese in caso locale", 40, 60), (0, "text", "The meter shall essere configurato before commissioning and after data checks of all parts of system", 40, 90)]),
    *_document("edges", [(0, "header", "UNI/TS 11291 page head", 40, 20), (0, "text", "Copyright of someone", 40, 30), (0, "discarded_blocks", "anything at the foot", 40, 790), (0, "text", "Page 3", 40, 800), (0, "text", "A text in the middle Page 3", 40, 400), (0, "footer", "plain foot", 40, 780)]),
    *_document("footnotes", [(0, "text", "Ends here. 2) A note inside", 40, 100), (0, "text", "3) A note at the left", 40, 740), (0, "page_footnote", "4) A real one", 95, 760), (0, "text", "5) Short at the bottom", 95, 780), (0, "text", "Nothing here", 40, 300)]),
    *_document("signs", [(0, "text", "Value ??? lost", 40, 60), (0, "text", "Use <<NAME>> here", 40, 80), (0, "text", "Broken << text", 40, 100), (0, "table", "a □ b", 40, 120), (0, "text", "bad □ sign", 40, 140)]),
    *_document("lists", [(0, "list", "- first", 40, 60), (0, "list", "second without", 40, 80), (0, "list", "3) third", 40, 100), (0, "list", "c. fourth", 40, 120), (0, "text", "no list", 40, 140)]),
    *_document("repairs", [(0, "text", "• communication status", 40, 60), (0, "text", "Pressure ŷ 16 bar", 40, 100), (0, "text", "Flow ≤ 3 and ≥ 1", 40, 140), (0, "text", "range 3–5", 40, 180), (0, "text", "  two  spaces ", 40, 220), (0, "text", "Unchanged text.", 40, 260)]),
]

PAGE_ROWS = [("doc", 0, 900, 0, 0, 0, 0), ("doc", 1, 0, 1, 0, None, 0), ("doc", 2, 0, 0, 0, None, 0), ("doc", 3, 120, 2, 4, 1, 0), ("doc", 4, 50, 0, 90, 0, 2), ("doc", 5, 300, 1, 0, None, None), ("other", 0, 10, 0, 0, 0, 0)]
EVIDENCE_UNITS = [_unit("doc", 0, 0, "text", "1.1 Intro", 40, 60), _unit("doc", 1, 1, "image", "picture", 40, 60), _unit("doc", 2, 3, "text", "only text", 40, 60), _unit("doc", 3, 4, "table", "Table 2 Sizes", 40, 60), _unit("other", 0, 0, "text", "2.1 Alone", 40, 60)]
#: doc_id, anchor, hit_ord, page, text, boxed, heading_like
HIT_ROWS = [
    ("doc", "1.1", 0, 0, "1.1 Intro", True, True), ("doc", "1.2", 0, 1, "see 1.2 Scope of work", True, True), ("doc", "1.2", 1, 2, "1.2 Scope of work", True, True), ("doc", "1.3", 0, 2, "1.3 Contents ........ 9", True, True),
    ("doc", "table 3", 0, 2, "Table 3 Results", True, False), ("doc", "figure 1", 0, 3, "Figure 1 Layout", False, False), ("doc", "1.5", 0, 3, "1.5 bar of pressure", True, True), ("doc", "1.6", 0, 3, "1.6 Late heading", True, False), ("doc", "appendix b", 0, 4, "Appendix B Forms", True, False),
]
#: doc_id, item_ord, rule_id, previous, current, reason
GAP_ROWS = [("doc", 0, "A2", "1.1", "1.3", "section_number_jump"), ("doc", 1, "F1", "1.3", "1.5", "section_sequence_gap"), ("doc", 2, "F2", "2", "4", "table_number_sequence_gap"), ("doc", 3, "F2", "1", "3", "figure_number_sequence_gap"), ("other", 4, "A2", "2.1", "2.4", "section_number_jump"), ("doc", 5, "A5", None, None, "consecutive_headings_without_body_between")]
#: doc_id, item_ord, review_item_id, rule_id, reason, refs
ITEM_ROWS = [("d", 0, "i1", "B2", "short", "a,b"), ("d", 1, "i1", "B2", "short", "a,b"), ("d", 2, "i2", "G2", "band", ""), ("d", 3, "i3", "A5", "heads", "c"), ("e", 0, "i1", "B2", "short", "a,b"), ("f", 0, "i9", "C4", "cols", "x,y")]
#: doc_id, idx, action, review_item_id, rule_id, refs, reason, match_reason
DECISION_ROWS = [("d", 0, "accept_review", "i1", "B2", "b,a", "seen", None), ("d", 1, "accept_review", "i1", "B2", "a,b", "", None), ("d", 2, "accept_review", "i2", "G2", "", "seen", "band"), ("d", 3, "accept_review", "i3", "A5", "c,d", "seen", None), ("e", 0, "reject", "i1", "B2", "a,b", "seen", None), ("f", 0, "accept_review", "i9", "C4", "x,y", "seen", None)]


def units(spark: SparkSession, rows: list[tuple] | None = None, *docs: str) -> DataFrame:
    rows = UNIT_ROWS if rows is None else rows
    schema = "doc_id string, ord int, unit_id string, granularity string, page int, dtype string, raw_text string, x0 double, y0 double, x1 double, y1 double"
    df = spark.createDataFrame([r for r in rows if not docs or r[0] in docs], schema)
    have = set(df.columns)
    return df.select(*[F.col(c.split()[0]) if c.split()[0] in have else F.lit(None).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in _split(UNITS)])


def _split(schema: str) -> list[str]:
    """Columns of a schema; commas inside angle brackets part nothing."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


def sql_value(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    return str(x)


def sql_rows(rows: list[tuple], columns: str, name: str) -> str:
    """``name AS (SELECT ...)`` for a WITH clause."""
    values = ",\n".join("(" + ", ".join(map(sql_value, r)) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {values}) AS t({columns}))"


def sql_units(rows: list[tuple] | None = None, *docs: str, name: str = "u") -> str:
    rows = UNIT_ROWS if rows is None else rows
    return sql_rows([r for r in rows if not docs or r[0] in docs], _COLUMNS, name)


#: What stands at the places of a page (40 blocks) of a structured corpus: place, dtype, text, and
#: other columns. Expressions that Spark and DuckDB read alike, over n (the document's number), page
#: and text; what differs from document to document makes rules hold in some and not in others.
STRUCTURE = [
    (0, "title", "(page + 1) || '.1 Scope of work'", {}),
    (3, "title", "(page + 1) || '.' || (2 + n % 3) || ' General'", {}),
    (5, "caption", "'Table ' || (2 * page + 1) || ' Values'", {}),
    (6, "caption", "'Table ' || (2 * page + 2 + n % 2) || ' Limits'", {}),
    (8, "title", "'Overview'", {}),
    (9, "title", "CASE WHEN n % 2 = 0 THEN 'Details of it' ELSE 'More of it' END", {}),
    (11, "text", "'one'", {}),
    (12, "text", "CASE WHEN n % 2 = 0 THEN 'two words' ELSE 'It ends here.' END", {}),
    (13, "text", "'three'", {}),
    (14, "text", "'four'", {}),
    (16, "list", "CASE WHEN n % 2 = 0 THEN '- first' ELSE 'second without' END", {}),
    (17, "text", "CASE WHEN n % 3 = 0 THEN 'Use <<NAME>> here' ELSE 'Value ??? lost' END", {}),
    (18, "text", "'Set 10 xyz and 5 bar'", {}),
    (19, "text", "CASE WHEN n % 2 = 0 THEN 'The gateway as defined here' ELSE 'A gateway is a device' END", {}),
    (20, "text", "CASE WHEN n % 2 = 0 THEN 'A gateway is a device' ELSE 'The gateway as defined here' END", {}),
    (22, "text", "'left part'", {"x1": "200.0"}),
    (23, "text", "'right part'", {"x0": "CASE WHEN n % 2 = 0 THEN 320.0 ELSE 250.0 END", "x1": "500.0", "y0": "456.0"}),
    (27, "title", "(page + 1) || '.7 The system shall start'", {}),
    (29, "title", "(page + 1) || '.8 Broken head-'", {}),
    (33, "text", "'See ISO 9001 at 10 bar, 92% of Table 9'", {}),
    (36, "caption", "'Figure ' || (page + 1) || ' Layout'", {}),
    (38, "text", "CASE WHEN n % 2 = 0 THEN '3) A note at the left' ELSE text END", {}),
    (39, "text", "CASE WHEN n % 3 = 0 THEN 'Page 3' WHEN n % 3 = 1 THEN 'Copyright of someone' ELSE text END", {}),
]
#: A table in place of the block at 31.
TABLE = (31, "table", "text || '<table><tr><th>' || CASE WHEN n % 3 = 0 THEN 'Name</th><th>Code' ELSE 'Term</th><th>Definition' END || '</th></tr><tr><td>' || (page + 1) || '.11</td><td>gateway</td></tr><tr><td> ' || (page + 1) || '.12 </td><td>meter</td></tr></table>'", {})


def _placed(column: str, rows: list[tuple], otherwise: str) -> str:
    """A CASE over the places that give the column."""
    given = [(k, dtype if column == "dtype" else text if column == "text" else more.get(column)) for k, dtype, text, more in rows]
    cases = " ".join(f"WHEN {k} THEN " + (sql_value(v) if column == "dtype" else v) for k, v in given if v is not None)
    return f"CASE ord % 40 {cases} ELSE {otherwise} END"


def structured_columns(table: bool = False) -> dict[str, str]:
    rows = [*STRUCTURE, TABLE] if table else STRUCTURE
    return {"dtype": _placed("dtype", rows, "'text'"), "raw_text": _placed("text", rows, "text"), **{c: _placed(c, rows, other) for c, other in (("x0", "40.0"), ("x1", "x1"), ("y0", "y0"))}}


def structured(units: DataFrame, table: bool = False) -> DataFrame:
    """Units of documents with headings, captions, lists and the like at fixed places."""
    from ..functions import text as T

    rows = units.withColumns({"n": F.col("doc_id").cast("bigint"), "text": F.col("raw_text")})
    made = {name: F.expr(sql).cast("double" if name in ("x0", "x1", "y0") else "string") for name, sql in structured_columns(table).items()}
    # by inline, so that the long cases are reckoned once and not wherever a rule reads them
    kept = [F.col(c) for c in units.columns if c not in (*made, "doc_id", "audit_text", "y1")]
    rows = rows.select("doc_id", F.inline(F.array(F.struct(*kept, *[c.alias(name) for name, c in made.items()]))))
    return rows.withColumns({"audit_text": T.normalize_audit(F.col("raw_text")), "y1": F.col("y0") + 14})


def sql_structured(raw: str, table: bool = False) -> str:
    """The same as a table ``u`` over one of documents' units, whose definition ends with a table ``u``."""
    named = ", ".join(f"{sql} AS {name}" for name, sql in structured_columns(table).items())
    head, tail = raw.rsplit("u AS (", 1)
    return f"{head}plain AS ({tail}, u AS (SELECT doc_id, ord, unit_id, 'block' AS granularity, page, {named}, y0 + 14 AS y1 FROM (SELECT *, CAST(doc_id AS BIGINT) AS n FROM plain))"
