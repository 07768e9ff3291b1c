"""Text functions against plain Python."""

import html
import re
import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from foliant.functions import patterns as P
from foliant.functions import text as T
from foliant.operators import completeness as C


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).first().x


def test_normal_forms(spark):
    raw = "Ｆull &amp; half-\nline • item\r\nnext   end ﬁ"
    t = unicodedata.normalize("NFKC", html.unescape(raw)).replace("\r\n", "\n")
    t = re.sub(r"([A-Za-z])-\n([A-Za-z])", r"\1\2", t).replace("\n", " ").replace("•", "-")
    assert one(spark, raw, T.normalize_for_audit(F.col("t"))) == re.sub(r"\s+", " ", t).strip().lower()
    assert one(spark, None, T.normalize_audit(F.col("t"))) == ""
    assert one(spark, " A B\t", T.normalize_audit(F.col("t"))) == "a b"


def test_section_numbers(spark):
    cases = {"1.2 Scope": "1.2", "3 Head": "3", "51 pages": None, "6% of": None, "7: label": None, "4) note": None, "1.2abc": "1", "": None, "no": None, "1.2% x": None, " 2.1.3 x": "2.1.3"}
    got = {r.t: r.n for r in spark.createDataFrame([(k,) for k in cases], "t string").select("t", T.section_number(F.col("t")).alias("n")).collect()}
    assert got == cases


def test_anchors(spark):
    text = "See Table  9 and 4.2, Figure 3; Appendix B. 10 bar, 92% of, 92%x, 5 m³ left, UNI 5, ISO 9001"
    assert set(one(spark, text, T.anchors(F.col("t")))) == {"table 9", "4.2", "figure 3", "appendix b"}
    found = set(one(spark, text, T.kept_candidates(T.anchors(F.col("t"), P.CANDIDATE_ANCHOR))))
    assert found == {"10 bar", "92%", "5 m³", "iso 9001"}


def test_whole_token(spark):
    df = spark.createDataFrame([("4.2", "4.2 ok"), ("4.2", "4.2.1"), ("4.2", "x4.2"), ("a+b", "see a+b now"), ("", "x")], "a string, t string")
    assert [r.x for r in df.select(T.anchor_present(F.col("a"), F.col("t")).alias("x")).collect()] == [True, False, False, True, False]


def test_symbols_and_bullets(spark):
    assert one(spark, "Pressure ŷ 16 bar", T.repair_symbols(F.col("t"))) == "Pressure <= 16 bar"
    assert one(spark, "3 ŷ 4", T.repair_symbols(F.col("t"))) == "3 <= 4"
    assert one(spark, " •  x – y", T.normalize_bullets(F.col("t"))) == "- x - y"


def test_units(spark):
    cases = {"Set 10 xyz": "10 xyz", "10 bar": None, "2.5 abc": None, "1500 abc": None, "4 Items": None, "3 may": None, "7 toolong": None, "8 m3x": None}
    got = {r.t: r.n for r in spark.createDataFrame([(k,) for k in cases], "t string").select("t", T.first_suspicious(F.col("t")).alias("n")).collect()}
    assert got == cases


def test_credible(spark):
    df = spark.createDataFrame([("1.2 Scope of work", "1.2"), ("see 1.2 Scope", "1.2"), ("1.2 ......... 9", "1.2"), ("1.5 bar of", "1.5"), ("Table 3 Results", "table 3"), ("21.1 Too high", "21.1"), ("1.123 Coded text", "1.123"), ("", "1.2")], "s string, a string")
    assert [r.x for r in df.select(T.credible_location(F.col("s"), F.col("a")).alias("x")).collect()] == [True, False, False, False, True, False, False, False]


def test_coverage_is_a_multiset(spark):
    a, b = "a b b c-d 1/2 <b>x</b> 0<x<16", "b a b b d 2 x"
    tokens = lambda s: re.findall(r"[0-9a-zÀ-ɏ]+", re.sub(r"</?\s*[A-Za-z][A-Za-z0-9:-]*(?:\s+[^<>]*?)?>", " ", s).replace("-", " ").replace("/", " ").lower())
    want = sum((Counter(tokens(a)) & Counter(tokens(b))).values())
    frame = lambda s: spark.createDataFrame([(1, s)], "k int, text string")
    r = C.coverage(frame(a), frame(b), ("k",)).first()
    assert (r.tokens, r.covered) == (len(tokens(a)), want)
    assert C.coverage(frame(a), frame(a), ("k",)).first().ratio == 1.0
    assert C.coverage(frame(""), frame(a), ("k",)).count() == 0


def test_pseudo_boxes(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], 7.0, 9), (None, 7.0, 9), ([1.0], None, 9), (None, None, None)], "b array<double>, y double, n int")
    got = [r.x for r in df.select(T.pseudo_box(F.col("b"), F.col("y"), F.col("n")).alias("x")).collect()]
    assert got == [[1.0, 2.0, 3.0, 4.0], [0.0, 7.0, 0.0, 7.0], [0.0, 9.0, 0.0, 9.0], [0.0, 0.0, 0.0, 0.0]]


def test_table_with_caption_is_structural(spark):
    from foliant.operators import evidence as E
    from foliant.plans import fixtures as X

    rows = [X._unit("d", 0, 0, "text", "1.1 no heading", 40, 60), X._unit("d", 1, 0, "table", "Table 4 of <td> 2.5 </td>", 40, 90), X._unit("d", 2, 0, "figure", "A picture", 40, 120)]
    assert E.structural_text(X.units(spark, rows)).first().text.split("\n") == ["2.5", "Table 4 of <td> 2.5 </td>", "A picture"]
