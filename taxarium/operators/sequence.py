"""Intervals and sequence statistics."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_length(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, coding_bases: bases in the union of closed intervals, less one a sequence (the mask's last base)."""
    w = Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    new = F.when(F.col(start) > F.coalesce(F.max(end).over(w), F.lit(-1)), 1).otherwise(0)
    marked = intervals.select(key, start, end, new.alias("_new"))
    island = F.sum("_new").over(Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, 0))
    merged = marked.withColumn("_i", island).groupBy(key, "_i").agg((F.max(end) - F.min(start) + 1).alias("_n"))
    return merged.groupBy(key).agg((F.sum("_n") - 1).alias("coding_bases"))


def n50(lengths: DataFrame, key: str, length: str) -> DataFrame:
    """key, total, n50, l50: half of all bases lie in pieces of at least n50; l50 counts them.  Equal lengths are summed first."""
    sizes = lengths.groupBy(key, length).agg(F.count("*").alias("_c"))
    run = F.sum(F.col(length) * F.col("_c")).over(Window.partitionBy(key).orderBy(F.desc(length)))
    total = F.sum(F.col(length) * F.col("_c")).over(Window.partitionBy(key))
    many = F.sum("_c").over(Window.partitionBy(key).orderBy(F.desc(length)))
    out = sizes.select(key, length, run.alias("_run"), total.alias("total"), many.alias("_many")).filter(F.col("_run") * 2 >= F.col("total"))
    return out.groupBy(key).agg(F.max("total").alias("total"), F.max(length).alias("n50"), F.min("_many").alias("l50"))


def contigs(scaffolds: DataFrame, key: str, seq: str, gap: int = 10) -> DataFrame:
    """key, contig: the pieces of each sequence between runs of ``gap`` or more N."""
    return scaffolds.select(key, F.explode(F.split(seq, f"[Nn]{{{gap},}}")).alias("contig")).filter("contig <> ''")


def nucleotide_statistics(scaffolds: DataFrame, key: str, seq: str, gap: int = 10) -> DataFrame:
    """One row per genome: counts, size, GC, N50, L50, mean (cut to whole bases) and longest of scaffolds and contigs, ambiguous bases, gaps.

    GC percent is of the unambiguous bases.  Ambiguous bases are all letters but A, C, G, T and U.
    """
    base, split = scaffolds.select(key, F.upper(seq).alias("_s")), contigs(scaffolds, key, seq, gap)
    count = lambda c, letters: F.length(c) - F.length(F.regexp_replace(c, f"[{letters}]", ""))
    n = F.length("_s")
    whole = base.groupBy(key).agg(
        F.count("*").alias("scaffold_count"), F.sum(count("_s", "GC")).alias("gc_count"), F.sum(n).alias("genome_size"), F.max(n).alias("longest_scaffold"),
        F.sum(n - count("_s", "ACGTU")).alias("_odd"), F.floor(F.avg(n)).alias("mean_scaffold_length"),
    )
    c = F.upper("contig")
    parts = split.groupBy(key).agg(
        F.count("*").alias("contig_count"), F.sum(F.length("contig") - count(c, "ACGTU")).alias("ambiguous_bases"), F.floor(F.avg(F.length("contig"))).alias("mean_contig_length"), F.max(F.length("contig")).alias("longest_contig"),
    )
    of = lambda df, name: n50(df, key, "_n").select(key, F.col("n50").alias(f"n50_{name}"), F.col("l50").alias(f"l50_{name}"))
    out = whole.join(parts, key, "left").join(of(base.select(key, n.alias("_n")), "scaffolds"), key, "left").join(of(split.select(key, F.length("contig").alias("_n")), "contigs"), key, "left")
    out = out.withColumn("ambiguous_bases", F.coalesce("ambiguous_bases", F.lit(0)))
    plain = F.col("genome_size") - F.col("_odd")
    return out.withColumn("gc_percentage", F.when(plain > 0, 100.0 * F.col("gc_count") / plain)).withColumn("total_gap_length", F.col("_odd") - F.col("ambiguous_bases")).drop("_odd")


def gene_statistics(genes: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """key, protein_count, coding_bases, coding_density of genes (key, seq, start, end) and genome sizes (key, genome_size)."""
    spans = union_length(genes.select(F.struct(key, "seq").alias("_k"), "start", "end"), "_k", "start", "end")
    bases = spans.groupBy(F.col(f"_k.{key}").alias(key)).agg(F.sum("coding_bases").alias("coding_bases"))
    counts = genes.groupBy(key).agg(F.count("*").alias("protein_count"))
    return counts.join(bases, key).join(sizes, key).select(key, "protein_count", "coding_bases", (100.0 * F.col("coding_bases") / F.col("genome_size")).alias("coding_density"))


def feature_counts(features: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """key, counts of features (key, type, attributes) by type for the wanted genomes; blanks without any feature row."""
    of = lambda t: F.count_if(F.col("type") == t).cast("string")
    ssu = F.count_if((F.col("type") == "rRNA") & F.col("attributes").contains("product=16S ribosomal RNA")).cast("string")
    counts = features.groupBy(key).agg(of("CDS").alias("cds_count"), of("tRNA").alias("trna_count"), of("ncRNA").alias("ncrna_count"), of("rRNA").alias("rrna_count"), ssu.alias("ssu_count"))
    return wanted.select(key).distinct().join(counts, key, "left").select(key, *(F.coalesce(c, F.lit("")).alias(c) for c in counts.columns if c != key))


def longest_hits(hits: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """key, query, length, contig_length, hits: the longest hit (key, query, length, ord) of each genome, the first among equals, with its contig's length (key, query, contig_length) and the number of summary rows."""
    best = hits.filter("length > 0").groupBy(key).agg(F.max_by(F.struct("query", "length"), F.struct("length", -F.col("ord"))).alias("b"))
    counts = summary.groupBy(key).agg(F.count("*").alias("hits"))
    found = best.select(key, "b.query", "b.length").join(summary.select(key, "query", "contig_length"), [key, "query"], "left")
    return found.join(counts, key, "left").select(key, "query", "length", "contig_length", F.coalesce("hits", F.lit(0)).alias("hits"))


def classified_hits(hits: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The first hit of each query (query, subject, identity, ord) with its subject's taxonomy (subject, taxonomy)."""
    first = hits.groupBy("query").agg(F.min_by(F.struct("subject", "identity"), "ord").alias("b")).select("query", "b.*")
    return first.join(taxonomy, "subject")


def concatenate_hits(hits: DataFrame, near: int = 300) -> DataFrame:
    """seq, slot, start, end, reverse of one model's hits joined when on one strand and less than ``near`` apart.

    Order matters (hits by ord): a merged hit keeps the slot of the first it joined, goes on to
    absorb later slots, and absorbed slots leave gaps that end later scans.  One sequence's hits
    are one group: a model has a handful on a contig.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        slots = _joined(rows.sort_values("ord")[["start", "end", "reverse"]].itertuples(index=False), near)
        return pd.DataFrame([(rows["seq"].iloc[0], s, *v) for s, v in slots.items()], columns=["seq", "slot", "start", "end", "reverse"])

    return hits.groupBy("seq").applyInPandas(one, "seq long, slot int, start long, end long, reverse boolean")


def _joined(rows: Iterator[tuple], near: int) -> dict[int, tuple]:
    slots: dict[int, tuple] = {}
    for start, end, reverse in rows:
        home, i = None, 1
        while i in slots:
            a, b, r = slots[i]
            if r == reverse and abs(a - end) < near:
                end = b
            elif r == reverse and abs(start - b) < near:
                start = a
            else:
                i += 1
                continue
            del slots[i]
            home = home or i
            slots[home] = (start, end, reverse)
            i += 1
        if home is None:
            slots[i] = (start, end, reverse)
    return slots


def best_hits(hits: DataFrame, order: tuple[str, ...], least: int, near: int = 300) -> DataFrame:
    """seq, name, model, start, end: hits (seq, model, ord, start, end, reverse) joined within each model, then the longest of overlapping ones over the models in order.

    Ties keep the earlier model's hit; the first hit of a sequence has its name, further ones
    ``-#2`` and so on.  Hits shorter than ``least`` go.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        seq, slots = rows["seq"].iloc[0], {}
        for model in order:
            part = rows[rows["model"] == model].sort_values("ord")[["start", "end", "reverse"]]
            for start, end, _ in _joined(part.itertuples(index=False), near).values():
                home, i = None, 1
                while i in slots:
                    a, b, m = slots[i]
                    if start <= b and a <= end:
                        longer = (start, end, model) if end - start > b - a else (a, b, m)
                        if home is not None:
                            del slots[i]
                        home = home or i
                        slots[home] = longer
                    i += 1
                if home is None:
                    slots[i] = (start, end, model)
        kept = [(seq, str(seq) + (f"-#{i}" if i > 1 else ""), m, a, b) for i, (a, b, m) in slots.items() if b - a + 1 >= least]
        return pd.DataFrame(kept, columns=["seq", "name", "model", "start", "end"])

    return hits.groupBy("seq").applyInPandas(one, "seq long, name string, model string, start long, end long")
