"""Deterministic repairs: contents rows (D0), section numbers (A1), fragments (B1), edges (C2), bullets and symbols.

Everything depends on one document only. D0 and A1 take units away from each other, so
they are decided page by page in a grouped function, over the pages that have a number
to place and only the columns it needs. All else is columns and windows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions import units as U
from ..ship import ship

D0, A1, B1, REST = 1, 2, 3, 4
MATCHES = "doc_id string, phase int, lead string, unit_id string, role int"


def blocks_of(units: DataFrame) -> DataFrame:
    return units.filter(F.col("granularity") == "block")


def match_page(rows: pd.DataFrame) -> pd.DataFrame:
    """D0, then A1, on the blocks of one page.

    Columns: ord, unit_id, place (rank in reading order), cy, x0, x0_or_none, x1, width, toc_number,
    toc_title, toc_page, isolated. Numbers come in reading order; a unit serves once.
    """
    units = sorted(rows.to_dict("records"), key=lambda u: u["ord"])
    free = {u["unit_id"]: u for u in units}
    out = []

    def row(number: dict) -> list[dict]:
        return [u for u in free.values() if u["unit_id"] != number["unit_id"] and abs(u["cy"] - number["cy"]) <= 8]

    def take(phase: int, *found: dict) -> None:
        for role, u in enumerate(found):
            out.append((rows["doc_id"].iloc[0], phase, found[0]["unit_id"], u["unit_id"], role))
            free.pop(u["unit_id"], None)

    numbers = sorted(units, key=lambda u: u["place"])
    for n in numbers:
        if n["toc_number"] and n["unit_id"] in free:
            near = row(n)
            titles = [u for u in near if u["toc_title"] or n["width"] * 0.16 < u["x0"] < n["width"] * 0.75 and not u["toc_page"]]
            pages = [u for u in near if u["toc_page"]]
            if titles and pages:  # the leftmost title; of pages furthest right the last
                take(D0, n, min(titles, key=lambda u: u["x0"]), max(reversed(pages), key=lambda u: u["x0"]))
    for n in numbers:
        if n["isolated"] and n["unit_id"] in free:
            right = [u for u in row(n) if u["x0"] > n["x1"] + 20]
            if right:
                take(A1, n, min(right, key=lambda u: u["x0"]))
    return pd.DataFrame(out, columns=["doc_id", "phase", "lead", "unit_id", "role"])


def placed_numbers(units: DataFrame) -> DataFrame:
    """doc_id, phase, lead, unit_id, role: the units that D0 (number, title, page) and A1 (number, heading) bring together."""
    ship(units.sparkSession)
    blocks = blocks_of(units)
    place = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(*U.order()))
    needed = blocks.select("doc_id", F.coalesce("page", F.lit(0)).alias("page"), "ord", "unit_id", place.alias("place"), U.middle().alias("cy"), U.edge("x0").alias("x0"), U.edge("x1").alias("x1"), U.width().alias("width"), U.toc_number().alias("toc_number"), U.is_type(("toc_title",)).alias("toc_title"), U.toc_page().alias("toc_page"), U.left_isolated_section().alias("isolated"))
    pages = blocks.filter(U.toc_number() | U.left_isolated_section()).select("doc_id", F.coalesce("page", F.lit(0)).alias("page")).distinct()
    return needed.join(pages, ["doc_id", "page"], "left_semi").groupBy("doc_id", "page").applyInPandas(match_page, MATCHES)


def fragment_pairs(units: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """doc_id, lead, unit_id: B1, fragments and the next unit in reading order that continues them.

    ``used``: doc_id, unit_id of units that earlier repairs took. In a run of joinable
    neighbours the first, third, ... pairs are joined.
    """
    blocks = blocks_of(units)
    if used is not None:
        blocks = blocks.join(used.select("doc_id", "unit_id", F.lit(True).alias("used")), ["doc_id", "unit_id"], "left")
    else:
        blocks = blocks.withColumn("used", F.lit(None).cast("boolean"))
    w = Window.partitionBy("doc_id").orderBy(*U.order())
    names = ["unit_id", "page", "dtype", "raw_text", "x0", "y0", "used"]
    ahead = blocks.select("*", *[F.lead(n).over(w).alias(f"next_{n}") for n in names], F.row_number().over(w).alias("place"))
    gap = U.edge("next_y0") - U.edge("y1")
    eligible = (
        F.col("next_unit_id").isNotNull()
        & F.col("used").isNull()
        & F.col("next_used").isNull()
        & F.col("page").eqNullSafe(F.col("next_page"))
        & (U.is_type(P.TEXT_TYPES) | F.coalesce(F.col("next_dtype").isin(*P.TEXT_TYPES), F.lit(False)))
        & gap.between(0, 12)
        & (F.abs(U.edge("x0") - U.edge("next_x0")) <= 12)
        & ~T.sentence_terminal(F.col("raw_text"))
        & T.continuation(F.col("next_raw_text"))
    )
    runs = ahead.filter(eligible).select("doc_id", "unit_id", "next_unit_id", "place", *[c for c in ("page", "y0", "x0", "ord")])
    island = F.col("place") - F.row_number().over(Window.partitionBy("doc_id").orderBy("place"))
    numbered = runs.withColumn("island", island)
    numbered = numbered.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "island").orderBy("place")))
    return numbered.filter(F.col("nth") % 2 == 1).select("doc_id", F.col("unit_id").alias("lead"), F.col("next_unit_id").alias("unit_id"))


def single_blocks(df: DataFrame, raw: str) -> DataFrame:
    """``df`` with fixed (the text of column ``raw`` after bullets and symbols) and rule (that changed it, or null).

    Step by step, so that each text is reckoned once.
    """
    df = df.withColumn("fixed", T.repair_symbols(T.normalize_bullets(F.col(raw)))).withColumn("symbols", T.repair_symbols(F.col(raw)))
    given = F.coalesce(raw, F.lit(""))
    rule = F.when(F.col("fixed") == given, F.lit(None)).when(F.col("symbols") != given, "E1").otherwise("D1")
    return df.withColumn("rule", rule).drop("symbols")


def apply_repairs(units: DataFrame) -> DataFrame:
    """Output blocks: every block of ``units`` stands in exactly one of them.

    doc_id, phase, seq, output_id, raw_text, audit_text, source_refs, operation,
    confidence, disposition, page, rule_id (null where nothing was changed), dtype.
    """
    blocks = blocks_of(units)
    placed = placed_numbers(units)
    joined = fragment_pairs(units, placed.select("doc_id", "unit_id"))
    both = joined.select("doc_id", F.lit(B1).alias("phase"), "lead", F.explode(F.array(F.struct(F.col("lead").alias("unit_id"), F.lit(0).alias("role")), F.struct(F.col("unit_id"), F.lit(1).alias("role")))).alias("part")).select("doc_id", "phase", "lead", "part.*")
    roles = placed.unionByName(both)
    # one row a block: what it belongs to, or itself
    marked = blocks.join(roles, ["doc_id", "unit_id"], "left").withColumn("phase", F.coalesce("phase", F.lit(REST))).withColumn("lead", F.coalesce("lead", "unit_id")).withColumn("role", F.coalesce("role", F.lit(0)))
    part = F.struct("role", "unit_id", F.coalesce("raw_text", F.lit("")).alias("raw"), "page", F.struct(*[c.alias(n) for n, c in zip(("page", "y0", "x0", "ord"), U.order(), strict=True)]).alias("at"), "dtype", F.when(F.col("phase") == REST, U.safe_discard()).otherwise(False).alias("discard"))
    grouped = marked.groupBy("doc_id", "phase", "lead").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    grouped = single_blocks(grouped.withColumn("raw", F.col("parts")[0]["raw"]), "raw")
    first = F.col("parts")[0]
    merged = F.array_join(F.transform("parts", lambda p: T.stripped(p["raw"])), " ")
    fixed, rule = F.col("fixed"), F.col("rule")
    rest, discard = F.col("phase") == REST, first["discard"]
    text = F.when(~rest, merged).when(discard, first["raw"]).when(rule.isNull(), first["raw"]).otherwise(fixed)
    rule_id = F.when(F.col("phase") == D0, "D0").when(F.col("phase") == A1, "A1").when(F.col("phase") == B1, "B1").when(discard, "C2").otherwise(rule)
    operation = F.when(F.col("phase") == D0, "TOC_three_column_repair").when(F.col("phase") == A1, "A1_merge_section_number").when(F.col("phase") == B1, "B1_join_paragraph_fragment").when(discard, "C2_discard_header_footer").when(rule == "E1", "E1_repair_symbol_corruption").when(rule == "D1", "D1_normalize_bullet").otherwise("emit")
    confidence = F.when(F.col("phase").isin(D0, A1), 0.9).when(F.col("phase") == B1, 0.86).when(discard, 0.95).when(rule.isNotNull(), 0.88).otherwise(1.0)
    disposition = F.when(~rest, "merged").when(discard, "discarded").otherwise("emitted")
    output_id = F.concat(F.lit("out:"), F.when(F.col("phase") == A1, F.element_at("parts", -1)["unit_id"]).otherwise(F.col("lead")), F.when(F.col("phase") == D0, ":toc").when(F.col("phase") == B1, ":join").when(rest & discard, ":discard").otherwise(""))
    grouped = grouped.withColumn("text", text)
    out = grouped.select("doc_id", "phase", first["at"].alias("at"), output_id.alias("output_id"), F.col("text").alias("raw_text"), T.normalize_audit(F.col("text")).alias("audit_text"), F.transform("parts", lambda p: p["unit_id"]).alias("source_refs"), operation.alias("operation"), confidence.alias("confidence"), disposition.alias("disposition"), first["page"].alias("page"), rule_id.alias("rule_id"))
    seq = F.row_number().over(Window.partitionBy("doc_id").orderBy("phase", "at")) - 1
    return out.withColumn("seq", seq).drop("at")


def findings(output: DataFrame) -> DataFrame:
    """doc_id, rule_id, severity, source_refs, fixed: what was repaired."""
    return output.filter("rule_id is not null").select("doc_id", "rule_id", F.lit("auto_fixed").alias("severity"), "source_refs", F.col("raw_text").alias("fixed"))
