import hashlib
import re

import pytest

from foliant.llm.exact_dedup import exact_dedup


def rows_of(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def brute(docs):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in docs]
    out = []
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = min([j for j in same if j is not None], default=None)
        out.append((i is None, i or 0, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


LONG = " ".join(f"word{i} text{i % 97}" for i in range(6000))
DOCS = [(1, "a  b"), (2, "a b"), (3, None), (4, ""), (5, "a b"), (5, "a b"), (6, LONG), (7, LONG.replace(" ", "\n")), (8, LONG + "x"), (9, " a b"), (None, "a b"), (None, "alone"), (10, "é x"), (11, "é x")]


@pytest.mark.parametrize("bits", [64, 3])
def test_against_brute_force(spark, bits):
    """Three-bit hashes collide all over, so contents decide."""
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("doc_id", "text", "1 as keep_id", "'x' as ids")
    assert rows_of(exact_dedup(df, hash_bits=bits, least=16, most=64)) == brute(DOCS)


def test_empty(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sql(spark, duck, sf_dir):
    from foliant.llm import queries

    got = queries.QUERIES["op1_exact_dedup"](spark, sf_dir)
    want = duck.sql(queries.ORACLES["op1_exact_dedup"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
