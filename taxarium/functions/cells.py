"""Cells of metadata tables: normal forms for comparison, casts for loading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns whose missing count is zero, rounded columns, the date column.
COUNTS = ("ncbi_ncrna_count", "ncbi_cds_count", "ncbi_trna_count")
ROUNDED = ("coding_density", "gc_percentage")
DATES = ("ncbi_date",)


def normal_cell(name: str, c: Column) -> Column:
    """A text cell in the form in which releases are compared."""
    out = F.when(c.isin("n/a", "na"), "n/a").otherwise(c)
    if name in COUNTS:
        out = F.when(c == "none", "0").otherwise(out)
    if name in ROUNDED:
        out = F.bround(c.try_cast("double"), 5).cast("string")
    if name in DATES:
        out = F.when(c != "none", F.date_format(F.try_to_timestamp(c, F.lit("yyyy-M-d")), "yyyy-MM-dd")).otherwise(out)
    return out


def load_cell(c: Column, kind: str) -> Column:
    """Text to store under a declared type: numbers other than zero lose their fraction for integers; blank cells are null."""
    number = c.try_cast("double")
    whole = F.when((number != 0) & ~F.isnan(number), number.cast("long").cast("string")).otherwise(c) if kind.upper() in ("INT", "INTEGER") else c
    return F.when(F.trim(c) != "", F.coalesce(whole, c))


def is_date(c: Column) -> Column:
    return c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & F.try_to_timestamp(c, F.lit("yyyy-M-d")).isNotNull()
