"""Statuses in one pass: those of the whole plan on odd texts too, with few jobs."""

import pytest
from pyspark.sql import functions as F

from foliant.plans import fixtures as X
from foliant.plans import status, suite
from foliant.plans.audit import run_audit

PLAIN = "words of the system stand here in a row and then go on".split()


def _text(*odd, units=30, at=24):
    """A text of ``units`` units of twelve words, with ``odd`` ones from the unit ``at`` on."""
    rows = [" ".join(PLAIN[k % 12 :] + PLAIN[: k % 12]) for k in range(units)]
    for k, o in enumerate(odd):
        rows[at + k] = o
    return " ".join(rows)


TEXTS = [
    _text(), _text("alpha beta & gamma R&D AT&T one two three four five six seven"), _text("a &lt;b one two three four five six seven eight nine x&gt; end"),
    _text("one two three four five six seven eight nine ten the UNI", "12 bar of the one two three four five six seven eight nine"),
    _text("one two three four five six seven eight nine ten eleven <b", "of one> two three four five six seven eight nine ten eleven"),
    _text("a 1ŷ2 b 3ŷ4 c 5ŷ6 d 7ŷ8 e 9ŷ1 f 2ŷ3"), _text("ŷ1 ŷ2 ŷ3 ŷ4 ŷ5 ŷ6 ŷ7 ŷ8 ŷ9 ŷ1 2ŷ2 3ŷ3", units=26), "A", "5", "a &amp; b &copy; c", "", " \t ", None,
    _text("il contatore deve essere before after data della system one two three"), " ".join(["il contatore deve essere before after data della system remote one two"] * 30),
    _text("section 4.2 at 7 m³ and 12 m3 of appendix B with UNI/TS 11 EN", "13:5 bar a 3.4 is here and one two three four five six"),
    _text(*["• one ≤ two − three | four | five | six and seven eight nine ten"] * 5, units=90, at=41), " ".join(PLAIN) + " A", _text(units=24) + " A", _text(units=23) + " 7", "one two three four five six seven",
    _text("Page 3 © of ISO 9001 one two three: and four five six seven", "( lower after : one ::= two gateway means the meter as defined here"), " one two　 three\x1cfour " * 40, "STRASSE ΣΟΦΟΣ İI ıſ K Å " * 90,
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Odd texts, each under some numbers, as texts of documents differ by them; ids that stand twice and none at all."""
    top = str(tmp_path_factory.mktemp("odd"))
    rows = [(100 * n + k, t) for k, t in enumerate(TEXTS) for n in (1, 2, 3)] + [(100, TEXTS[0]), (100, TEXTS[3]), (None, TEXTS[1])]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2).write.parquet(f"{top}/documents.parquet")
    return top


def test_statuses_are_those_of_the_whole_plan(spark, odd):
    units = X.structured(suite.frag(spark, odd), True)
    found = {r.doc_id: tuple(r) for r in status.statuses(units).collect()}
    audit = run_audit(units)
    want = {r.doc_id: tuple(r) for r in audit.status.collect()}
    audit.release()
    assert found.keys() == want.keys()
    sure = {d: r[:4] for d, r in found.items() if not r[4]}
    assert sure == {d: want[d] for d in sure}
    assert len(sure) > len(want) // 2 and len({r[3] for r in want.values()}) > 1
    # repeated and missing ids, and where only decoding tells, are for the whole plan
    assert {None, "100", "102"} <= found.keys() - sure.keys()
    assert {tuple(r) for r in suite.QUERIES["corpus_audit"](spark, odd).collect()} == set(want.values())


def test_few_jobs(spark, sf_dir):
    context = spark.sparkContext
    context.setJobGroup("corpus_audit", "")
    suite.QUERIES["corpus_audit"](spark, sf_dir).collect()
    jobs = len(context.statusTracker().getJobIdsForGroup("corpus_audit"))
    context.setJobGroup("others", "")
    assert jobs < 20


def test_eight_tokens(spark):
    from foliant.functions import text as T

    texts = [" ".join(TEXTS[k].lower().split()[i : i + n]) for k in (1, 2, 3, 5, 9, 15, 21) for i in range(0, 40) for n in (7, 8, 9)] + ["a-b/c d e f g&h", "a b c d e f g &amp", "a b c d e f g h &lt", "a b c d e f g &"]
    rows = spark.createDataFrame([(t,) for t in texts], "low string").select(status._eight(F.col("low")).alias("got"), (F.size(T.canonical_tokens(F.col("low"))) >= 8).alias("want")).collect()
    assert all(r.got in (None, r.want) for r in rows) and sum(r.got is not None for r in rows) > len(rows) // 2
