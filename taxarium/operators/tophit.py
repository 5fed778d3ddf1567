"""Top-hit reductions; all are partial aggregates, so no window sorts a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_hit(hits: DataFrame, keys: list[str], score: Column, order: Column, values: list[str]) -> DataFrame:
    """The row of greatest score per key; the first in order among equals."""
    best = hits.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(score, -order)).alias("_b"))
    return best.select(*keys, *(F.col(f"_b.{v}").alias(v) for v in values))


def first_by(rows: DataFrame, keys: list[str], order: Column, values: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias("_b")).select(*keys, *(F.col(f"_b.{v}").alias(v) for v in values))


def last_by(rows: DataFrame, keys: list[str], order: Column, values: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_b")).select(*keys, *(F.col(f"_b.{v}").alias(v) for v in values))


def hit_lists(hits: DataFrame, gene: str, family: str, score: Column, order: Column, values: list[str]) -> DataFrame:
    """gene, hits: the best hit of each family, as ``family,value,…`` joined by ``;`` in order of the families."""
    best = top_hit(hits, [gene, family], score, order, values)
    cell = F.concat_ws(",", family, *values)
    rows = best.groupBy(gene).agg(F.array_sort(F.collect_list(F.struct(F.col(family).alias("f"), cell.alias("c")))).alias("_l"))
    return rows.select(gene, F.concat_ws(";", F.transform("_l", lambda x: x["c"])).alias("hits"))


def domain_vote(genomes: DataFrame, markers: DataFrame, key: str, sizes: tuple[int, int], least: float = 10.0) -> DataFrame:
    """key, domain: domains to set for genomes (key, known, domain) whose domain is null or ``d__``.

    markers (key, marker, bacterial, evalue): aligned markers of the bacterial or the archaeal set;
    those without an e-value do not count.  sizes: markers of both sets.  A set with ``least``
    percent or more of its markers wins (ties: Bacteria); without one the known domain is set.
    Votes that agree with the known domain give no row; a known domain without its prefix is an error.
    """
    counts = markers.filter("evalue <> ''").groupBy(key).agg(F.count_if("bacterial").alias("_b"), F.count_if(~F.col("bacterial")).alias("_a"))
    open_ = genomes.filter("(domain is null or domain = 'd__') and known is not null").select(key, "known").join(counts, key, "left")
    bacteria, archaea = (100.0 * F.coalesce(c, F.lit(0)) / n for c, n in zip(("_b", "_a"), sizes))
    voted = F.when((bacteria < least) & (archaea < least), None).when(bacteria >= archaea, "d__Bacteria").otherwise("d__Archaea")
    known = F.when(F.col("known").startswith("d__"), F.col("known")).otherwise(F.raise_error(F.concat(F.lit("no domain: "), F.col("known"))))
    rows = open_.select(key, voted.alias("_v"), known.alias("_k"))
    return rows.filter("_v is null or _v <> _k").select(key, F.coalesce("_v", "_k").alias("domain"))
