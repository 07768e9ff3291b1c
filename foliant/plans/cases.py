"""Checks of a library of regression cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIELDS = ("defect_class", "source", "expected", "covered_by")


def case_errors(cases: DataFrame, tests: DataFrame) -> DataFrame:
    """ord, error: missing or repeated ids, missing fields, tests that aren't there.

    ``cases``: ord, id and the FIELDS as strings; ``tests``: name.
    """
    known = F.coalesce(F.col("id"), F.concat(F.lit("case["), "ord", F.lit("]")))
    nth = F.row_number().over(Window.partitionBy("id").orderBy("ord"))
    named = cases.withColumn("label", known).withColumn("nth", nth)
    test = F.regexp_extract(F.coalesce("covered_by", F.lit("")), "::([^:]+)$", 1)
    found = named.join(tests.select(F.col("name").alias("test_name")).distinct(), F.col("test_name") == test, "left")
    errors = [F.when(F.coalesce("id", F.lit("")) == "", F.concat("label", F.lit(" missing id"))), F.when((F.coalesce("id", F.lit("")) != "") & (F.col("nth") > 1), F.concat(F.lit("duplicate case id: "), "id"))]
    errors += [F.when(F.coalesce(f, F.lit("")) == "", F.concat("label", F.lit(f" missing {f}"))) for f in FIELDS]
    errors += [F.when((test != "") & F.col("test_name").isNull(), F.concat("label", F.lit(" references missing test "), test))]
    return found.select("ord", F.explode(F.array_compact(F.array(*errors))).alias("error"))
