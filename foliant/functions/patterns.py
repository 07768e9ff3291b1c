"""Patterns and word lists.

Java patterns carry ``(?U)`` so that ``\\s``, ``\\d``, ``\\w`` and ``\\b`` know Unicode.
"""

import re

# --- Fixed values that results depend on -------------------------------------------------
TEXT_TYPES = ("text", "para", "paragraph", "para_blocks")
TITLE_TYPES = ("title", "heading")
TABLE_TYPES = ("table", "table_body")
MEDIA_TYPES = ("image", "figure", "caption", "table", "table_body")
STRUCTURAL_TYPES = ("title", "heading", "caption", "image", "figure")
EDGE_TYPES = ("header", "footer", "page_number")
FOOTNOTE_TYPES = ("page_footnote", "footnote", "aside_text")

DASHES_AND_BULLETS = "−‐‑‒–—•"
AUDIT_BULLETS = "•●▪■−‐‑–—"
UNIT_NAMES = ("bar", "m3", "m³", "l/h", "%", "s", "ms", "V", "Hz")
ITALIAN_TERMS = (
    "il la lo gli dei delle del della di ed che nel nella per un una contatore deve essere configurato funzioni introduzione scopo "
    "riferimenti normativi termini definizioni sigle abbreviazioni generalita spiegazione tabella oggetti giorno settimana valore "
    "descrizione ogni inizio mese mesi espresso locale caso campi elemento devono dato diagnostica relativa utilizzare remoto"
).split()
ENGLISH_CONTEXT = "before after shall should must commissioning system data remote meter".split()
KNOWN_UNITS = "bar m3/h m³/h m3 m³ l/h % s ms v hz m mc mc/h min hour hours byte bytes bit bits mm dm dbm d sec kbps ora".split()
MONTHS = (
    "january february march april may june july august september october november december "
    "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre"
).split()
NON_UNIT_WORDS = MONTHS + (
    "of to and or the a an in on for from with anni anno year years day days min "
    "e si is o pf will must by are also ends most null we full time can so use am che come deve del dell di ed fa feb ha il la long max "
    "mese mesi non ore pm per plan push sia sono"
).split()
SUBHEADINGS = ("definition", "definition:", "definitions", "functional requirements", "general information", "generality", "generalita", "generalità", "measure", "regulations", "(regulations)")
ORDERED_TERMS = ("gateway", "meter", "endpoint", "application software")
DEFINED_ELSEWHERE = ("associated with a meter", "defined in compliance", "defined in appendix", "defined in annex", "defined by")

REQUIRED_ANCHOR = r"(?iU)\b(?:\d+(?:\.\d+)+|Table\s+\d+|Figure\s+\d+|Appendix\s+[A-Z])\b"
#: After a unit that ends in a sign the pattern wants a word's beginning, after m³ its end.
CANDIDATE_ANCHOR = r"(?iU)\b(?:UNI(?:/[A-Z]+)?\s+\d+(?::\d+)?\b|EN\s+\d+(?::\d+)?\b|ISO\s+\d+(?::\d+)?\b|\d+(?:[.,]\d+)?\s*(?:bar\b|m3\b|m³(?![\w³])|l/h\b|%\b|s\b|ms\b|V\b|Hz\b))"
FIGURE_TABLE_ANCHOR = r"(?iU)\b(?:Table|Figure)\s+\d+\b"
CAPTION_START = r"(?iU)^\s*(?:Table|Figure)\s+\d+\b"
SOURCE_ANCHOR = r"(?iU)\b(?:\d+(?:\.\d+)+|Table\s+\d+|Figure\s+\d+|Appendix\s+[A-Z]|UNI(?:/[A-Z]+)?\s+\d+|ISO\s+\d+)\b"
#: What an anchor of several words begins with.
ANCHOR_BEGINS = r"(?iU)^(?:table|figure|appendix|uni|en|iso|\d[\w.]*)$"
BARE_STANDARD = r"(?iU)^(?:uni|en|iso)\s+\d{1,2}$"
SECTION_ANCHOR = r"(?U)^\d+(?:\.\d+)+$"
ISOLATED_SECTION = r"(?U)^(?:\d+(?:\.\d+)*|[A-Z](?:\.\d+)*)$"
TOC_NUMBER = r"(?U)^\d+(?:\.\d+)*$"
FOOTNOTE_START = r"(?U)^\s*\d+\)"
HEADER_FOOTER = r"(?iU)(?:\b(?:UNI/TS|UNI EN|ISO|Page\s+\d+|Pagina\s+\d+|Copyright)\b|©)"
RIGHTS = r"(?iU)\b(?:copyright|all rights reserved|riproduzione vietata)\b"
DEFINITION = r"(?iU)\b([a-z][a-z -]{3,30})\s+(?:is|means|refers to|defined as)\b"
BODY_VERBS = r"(?iU)\b(?:shall|must|should|is|are|the following)\b"
BULLET_START = r"(?U)^\s*(?:[-*•−]|\d+[.)]|[a-zA-Z][.)])\s+"
CORRUPTION = r"\?\?\?|<<|>>|�|□"
PLACEHOLDER = r"(?U)<<\s*[A-Za-z][A-Za-z0-9_]{0,12}\s*>>"
PROTOCOL_WORDS = r"(?iU)\b(?:preamble|payload|access address|crc|idvar|obj\d|tr_cf|cf_\d|tot|lenght|length|value)\b"
SCHEMA_WORDS = r"(?iU)\b(?:array|unsigned|long|string|octet|structure)\b"
NUMBER_AND_UNIT = r"(?U)\b(\d+(?:[.,]\d+)?)\s+([A-Za-zµ³/%]+)(?:(?<=[\w³])(?![\w³])|(?<![\w³])(?=[\w³]))"
AFTER_SECTION = r"^[A-Za-zÀ-ɏ][A-Za-zÀ-ɏ0-9 /(),'-]{2,}"
UNIT_AFTER_SECTION = r"(?iU)^(?:u\d+|r\b|w\b|litre|liter|m3|mc|bar|bytes?|string|specific)\b"
REFERRED = r"(?U)\b(?:see|refer to|referring to|paragraph|clause|section)\s+"

TABLE = r"(?is)<table\b.*?</table>"
TABLE_ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"
TABLE_TAG = r"<[^>]+>"
NUMBER_CELL = r"(?iU)<td[^>]*>\s*(\d+(?:\.\d+)+)\s*</td>"
DOTTED_NUMBER = r"(?U)^\d+(?:\.\d+)+\z"
TEXT_SECTION = r"(?U)(?<![\w.])(\d+(?:\.\d+)+)\s+([A-Za-zÀ-ɏ][A-Za-zÀ-ɏ0-9 /(),'-]{2,})"
NON_HEADING = r"(?iU)^(?:or|and|superior|inferior|greater|less|test|value|values?|u\d+|r|w|litre|liter|m3|mc|bar|bytes?|string|specific)\b"
VALUE_BEFORE = r"(?iU)\b(?:bluetooth|temperature|pressure|profile|declared|minimum|maximum|object|code|version)\s+$"
OTHER_TABLE = r"(?iU)\b(?:point|diagnostics?|activation|anomal(?:y|ies)|rif|reference|clause|status|code|value|field|object|obis|type|length|bytes?|bit|flag|error|alarm)\b"
DEFINITION_TABLE = r"(?iU)\b(?:term|terms|definition|definitions|abbreviation|abbreviations)\b"
STATE_WORD = r"(?iU)^(?:no|not|when|if|after|before|immediate|delayed|open|closed|active|inactive)\b"
# --- End of fixed values -----------------------------------------------------------------


_SQL_WORD = "0-9A-Za-z_"
_SQL_CLASSES = {r"\d": "0-9", r"\s": r"\t\n\f\r ", r"\w": _SQL_WORD}
#: Signs beyond ASCII that (?i) of DuckDB takes for a letter.
_SQL_FOLDED = {"s": "ſ", "k": "\u212a"}


def as_sql(pattern: str) -> str:
    """A pattern of DuckDB for Java: there ``\\s``, ``\\d``, ``\\w`` and ``\\b`` know ASCII only, and ``(?i)`` simple folding."""
    folds = pattern.startswith("(?i)")

    def part(m: re.Match) -> str:
        x = m[0]
        if x == r"\b":
            return f"(?:(?<=[{_SQL_WORD}])(?![{_SQL_WORD}])|(?<![{_SQL_WORD}])(?=[{_SQL_WORD}]))"
        if x == "$":
            return r"\z"
        if x[0] == "[":
            for name, signs in _SQL_CLASSES.items():
                x = x.replace(name, signs)
            return x.replace("A-Z", "A-Za-z" + "".join(_SQL_FOLDED.values())) if folds else x
        if x[0] == "\\":
            return f"[{_SQL_CLASSES[x]}]" if x in _SQL_CLASSES else x
        return f"[{x.upper()}{x.lower()}{_SQL_FOLDED.get(x.lower(), '')}]" if folds else x

    return re.sub(r"\\.|\[[^\]]*\]|\$|[A-Za-z]", part, pattern.removeprefix("(?i)"))
