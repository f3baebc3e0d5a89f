"""X9 — lineage: the audit rows replayed over the raw table must give the cleaned one.

``replay`` folds the changes of each cell, in the order of the cleaning steps, over the raw
rows and leaves out the dropped ones; ``restore`` goes back from the cleaned rows to their
raw values.  ``unexplained`` names every cell whose cleaned value is not what the audit
leads to, and every cell whose changes do not follow from each other, so a change made
without an audit row shows up.

A cell has at most one change per step; changes are gathered per row and joined on the row
number, one shuffle of the audit and one of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cleaning steps that change cells, in order.
STEPS = ["phone_format", "date_format", "name_case", "fill_missing", "negative_income", "extreme_age"]
CHANGES = ["change", "null", "fill"]
ROW = "row_num"


def marks(audit: DataFrame) -> DataFrame:
    """Per row of the audit: ``cells`` (column -> its changes (order, old_value, new_value) in
    order) and whether the row was ``dropped``.  One pass over the audit, one shuffle."""
    order = F.array_position(F.array(*[F.lit(s) for s in STEPS]), F.col("step")).alias("order")
    change, drop = F.col("action").isin(*CHANGES), F.col("action") == "drop"
    each = audit.where(change | drop).repartition(ROW).groupBy(ROW, "column").agg(
        F.array_sort(F.collect_list(F.when(change, F.struct(order, "old_value", "new_value")))).alias("steps"), F.max(drop).alias("dropped"))
    cell = F.when(F.size("steps") > 0, F.struct("column", "steps"))
    return each.groupBy(ROW).agg(F.map_from_entries(F.collect_list(cell)).alias("cells"), F.max("dropped").alias("dropped"))


def chains(audit: DataFrame) -> DataFrame:
    """row_num and ``cells`` of the changed rows."""
    return marks(audit).where(F.size("cells") > 0).select(ROW, "cells")


def dropped(audit: DataFrame) -> DataFrame:
    return audit.where("action = 'drop'").select(ROW).distinct()


def _steps(c: str) -> Column:
    return F.col("__cells")[F.lit(c)]


def _broken(c: str) -> Column:
    """Whether the changes of a cell do not start at its raw value or do not follow from each
    other."""
    s = _steps(c)
    starts = F.get(s, F.lit(0))["old_value"].eqNullSafe(F.col(c).cast("string"))
    pairs = F.transform(s, lambda x, i: (i == 0) | x["old_value"].eqNullSafe(F.get(s, i - 1)["new_value"]))
    return s.isNotNull() & ~(starts & F.forall(pairs, lambda ok: ok))


def _joined(rows: DataFrame, audit: DataFrame) -> DataFrame:
    return rows.join(marks(audit).withColumnsRenamed({"cells": "__cells", "dropped": "__dropped"}), ROW, "left")


def _kept(raw: DataFrame, audit: DataFrame) -> DataFrame:
    return _joined(raw, audit).where(~F.coalesce(F.col("__dropped"), F.lit(False)))


def _values(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW]


def replay(raw: DataFrame, audit: DataFrame) -> DataFrame:
    """The rows of ``raw`` with the changes of the audit, without the dropped ones."""
    got = _kept(raw, audit)
    value = lambda c: F.when(_steps(c).isNull(), F.col(c)).otherwise(F.element_at(_steps(c), -1)["new_value"].cast(raw.schema[c].dataType))
    return got.select(ROW, *[value(c).alias(c) for c in _values(raw)]).select(*raw.columns)


def restore(cleaned: DataFrame, audit: DataFrame) -> DataFrame:
    """The raw values of the rows of ``cleaned``."""
    got = _joined(cleaned, audit)
    value = lambda c: F.when(_steps(c).isNull(), F.col(c)).otherwise(F.get(_steps(c), F.lit(0))["old_value"].cast(cleaned.schema[c].dataType))
    return got.select(ROW, *[value(c).alias(c) for c in _values(cleaned)]).select(*cleaned.columns)


def _compared(raw: DataFrame, cleaned: DataFrame, audit: DataFrame) -> DataFrame:
    """One row per cell: row_num, column, raw, replayed, cleaned, audited, reason (null if the
    audit explains it)."""
    cols = _values(raw)
    kept = _kept(raw, audit)
    last = lambda c: F.when(_steps(c).isNull(), F.col(c).cast("string")).otherwise(F.element_at(_steps(c), -1)["new_value"])
    cells = F.struct(*[F.struct(F.col(c).cast("string").alias("raw"), last(c).alias("replayed"), _steps(c).isNotNull().alias("audited"), _broken(c).alias("broken")).alias(c) for c in cols])
    mine = kept.select(ROW, cells.alias("__m"))
    other = cleaned.select(ROW, F.struct(*[F.col(c).cast("string").alias(c) for c in cols]).alias("__c"))
    both = mine.join(other, ROW, "full")

    def cell(c: str) -> Column:
        m, v = F.col("__m")[c], F.col("__c")[c]
        reason = (
            F.when(F.col("__c").isNull(), "row is not in the cleaned table").when(F.col("__m").isNull(), "row is not explained")
            .when(m["broken"], "changes do not follow").when(~m["replayed"].eqNullSafe(v), "value is not explained")
        )
        return F.struct(F.lit(c).alias("column"), m["raw"].alias("raw"), m["replayed"].alias("replayed"), v.alias("cleaned"), F.coalesce(m["audited"], F.lit(False)).alias("audited"), reason.alias("reason"))

    return both.select(ROW, F.inline(F.array(*[cell(c) for c in cols])))


def unexplained(raw: DataFrame, cleaned: DataFrame, audit: DataFrame) -> DataFrame:
    """row_num, column, raw, replayed, cleaned, reason of every cell that the audit does not
    explain."""
    return _compared(raw, cleaned, audit).where("reason is not null").drop("audited")


def report(raw: DataFrame, cleaned: DataFrame, audit: DataFrame) -> DataFrame:
    """Per column: cells, cells that differ from the raw value, cells with audit rows, and
    cells that these do not explain."""
    changed = ~F.col("raw").eqNullSafe(F.col("cleaned"))
    return _compared(raw, cleaned, audit).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_if(changed).alias("n_changed"),
        F.count_if("audited").alias("n_audited"), F.count_if(F.col("reason").isNotNull()).alias("n_unexplained"))
