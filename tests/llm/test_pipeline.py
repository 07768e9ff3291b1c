import hashlib
import re

import pytest
from test_near_dedup import brute

import corpus_pipeline
from foliant.llm import bpe, common, pipeline


def test_each_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = stage(spark, kept, sf_dir).cache()
        after = {r.doc_id for r in kept.collect()}
        assert kept.columns == columns
        assert after <= set(before)
        gone = set(before) - after
        if name == "exact_dedup":
            first = {}
            for i, t in sorted(before.items()):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
            assert after == set(first.values())
        elif name == "near_dedup":
            assert after == {i for i, (_, c) in brute(sorted(before.items()), pipeline.SHINGLE).items() if c == i}
        elif name == "decontamination":
            items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            flat = {i: " ".join(re.findall(r"\w+", t.lower())) for i, t in before.items()}
            assert gone >= {i for i, t in flat.items() if any(f" {x} " in f" {t} " for x in items)}
            assert len(gone) < len(before) / 4
        else:
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            assert not any(labels.get(i) == 0 for i in gone)
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).collect()
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in last} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


def test_odd_rows(spark, sf_dir):
    rows = [(1, "some text here", "en"), (1, "some text here", "en"), (None, "no id", None), (2, None, None), (3, "", "de"), (4, "x" * 50_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' as source", "1L as n_chars", "1 as node", "2 as _gone_")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert {r.doc_id for r in out.collect()} >= {None, 1, 2, 4}
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert bpe.round_trip(docs).count() == 6


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
    want = {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in kept.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, sf_dir).collect()} == want


def test_shared_folder():
    class Session:  # a cluster without a shared folder
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)


def test_tables_can_be_deleted(spark):
    one, two = (common.materialise(spark.range(3), "test") for _ in range(2))
    common.discard(one)
    assert two.count() == 3
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(one.written_to)


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
    with pytest.raises(ValueError, match="80 percent"):
        from foliant.llm.near_dedup import near_dedup

        near_dedup(None, percent=50)
