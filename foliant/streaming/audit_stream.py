"""Audits of parser files as they arrive. Documents don't depend on each other, so a batch needs no state of another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.audit import run_audit
from ..schemas import UNITS


def audit_stream(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = UNITS) -> StreamingQuery:
    """Reads new unit files (JSON lines, whole documents) under ``source`` until none is left, and writes status, blocks and items under ``target``.

    A batch that is run again after a failure replaces what it wrote before.
    """

    def each(batch: DataFrame, number: int) -> None:
        audit = run_audit(batch)
        for name, frame in (("status", audit.status), ("blocks", audit.output), ("items", audit.items), ("losses", audit.losses)):
            frame.write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")
        audit.release()

    units = spark.readStream.schema(schema).json(source)
    return units.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
