"""Stages of the corpus pipeline.

Every stage takes ``(spark, docs, sf_dir)`` and reads all that the one before kept. All
but the last return the columns they got. Rows with a null doc_id can't be named by a
stage's decision and go on; a doc_id that stands in several rows is decided on as one.
Empty input gives empty output at every stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import discard, materialise, ship, slices, table
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .near_dedup import near_dedup
from .toxicity import Scorer, train

#: Words of a shingle and percentage of the near-duplicate stage: those of op6_near_dedup, which it calls.
SHINGLE, PERCENT = 2, 80


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    gone = ids.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts with a toxicity score of 0.5 or more; each row is scored by itself."""
    ship(spark)
    model = spark.sparkContext.broadcast(train(docs, table(spark, sf_dir, "labels")))

    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in slices(batches):
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return _without(docs, exact_dedup(docs).filter("not kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (two-word shingles, 0.8) the smallest doc_id stays."""
    return _without(docs, near_dedup(docs, size=SHINGLE, percent=PERCENT).filter("not kept"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that overlap an item of the benchmark."""
    return _without(docs, contamination(docs, table(spark, sf_dir, "benchmark")))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes of every text that is left."""
    return bpe.round_trip(docs)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("decontamination", decontaminate_stage), ("byte_bpe", bpe_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one leaves is written and read again for the next."""
    docs = source = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        old, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if old is not source:
            discard(old)
    return STAGES[-1][1](spark, docs, sf_dir)
