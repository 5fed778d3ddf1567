"""Taxonomy arrays and trees."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import canonical_species, species_validity
from ..scratch import Scratch

#: Canonical rank prefixes, root first.
PREFIXES = ("d__", "p__", "c__", "o__", "f__", "g__", "s__")
#: Ranks of the prefixes, prefixes with sub-ranks, names of the roots that end a walk, domains whose lineages are kept.
RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species")
SUB_PREFIXES = ("d__", "sd__", "p__", "sp__", "c__", "sc__", "o__", "so__", "f__", "sf__", "g__", "sg__", "s__")
ROOTS = ("cellular organisms", "other sequences", "unclassified sequences", "Viruses", "Viroids")
DOMAINS = ("d__Bacteria", "d__Archaea", "d__Eukaryota", "d__Fungi")


def prefixes() -> Column:
    return F.array(*map(F.lit, PREFIXES))


def parse(c: Column) -> Column:
    """Trimmed taxa of a lineage text; a trailing separator is dropped."""
    return F.transform(F.split(F.regexp_replace(c, r";\s*$", ""), ";"), lambda t: F.trim(t))


def fill_trailing(taxa: Column) -> Column:
    return F.concat(taxa, F.slice(prefixes(), F.size(taxa) + 1, F.greatest(F.lit(len(PREFIXES)) - F.size(taxa), F.lit(0))))


def fill_missing(taxa: Column) -> Column:
    """One place per rank: its last taxon, or the bare prefix."""
    return F.transform(prefixes(), lambda p: F.coalesce(F.try_element_at(F.filter(taxa, lambda t: t.startswith(p)), F.lit(-1)), p))


def _starts(prefix: str, t: Column) -> Column:
    return t.startswith(prefix)


def is_full(taxa: Column) -> Column:
    """Seven taxa with the prefixes of their ranks."""
    return (F.size(taxa) == len(PREFIXES)) & F.forall(F.arrays_zip(taxa.alias("t"), prefixes().alias("p")), lambda x: x["t"].startswith(x["p"]))


def ranked(taxa: Column, keep_subranks: bool = False) -> Column:
    """Taxa of recognised ranks: without ``x__`` and ``sb__`` ones, families in other ranks, and sub-ranks unless kept."""
    prefix = lambda t: F.substring_index(t, "__", 1)
    kept = lambda t: ~t.startswith("x__") & ~F.lower(t).contains(" family") & (prefix(t) != "sb")
    return F.filter(taxa, kept if keep_subranks else lambda t: kept(t) & (F.length(prefix(t)) != 2))


def standardise(df: DataFrame, taxa: str, keep_subranks: bool = False) -> DataFrame:
    """df with the lineage ``taxa`` as one place per rank; lineages of other domains and those without a domain go.

    Ranks are filled from the last valid taxon of each; a gap above a filled rank is a bare prefix,
    and what follows the first gap of two ranks or the last filled one is bare prefixes too.
    """
    order = SUB_PREFIXES if keep_subranks else PREFIXES
    named = df.filter(F.arrays_overlap(F.col(taxa), F.array(*map(F.lit, DOMAINS)))).withColumn("_kept", ranked(F.col(taxa), keep_subranks))
    for i, p in enumerate(order[:-1]):
        named = named.withColumn(f"_r{i}", F.try_element_at(F.filter("_kept", partial(_starts, p)), F.lit(-1)))
    named = named.withColumn("_s", F.filter("_kept", lambda t: t.startswith("s__"))).withColumn("_last", F.try_element_at("_s", F.lit(-1)))
    # Lineages with several species are rare, so only they are tested taxon by taxon.
    valid = F.when(species_validity(F.col("_last")).isNull(), F.col("_last")).otherwise(F.when(F.size("_s") > 1, F.try_element_at(F.filter("_s", lambda t: species_validity(t).isNull()), F.lit(-1))))
    named = named.withColumn("_last", valid).withColumn(f"_r{len(order) - 1}", F.when(F.col("_last") == "s__", "s__").otherwise(canonical_species(F.col("_last"))))
    top = F.greatest(*(F.when(F.col(f"_r{i}").isNotNull(), F.lit(i)).otherwise(F.lit(-1)) for i in range(len(order))))
    named = named.withColumn("_top", top)
    for i in range(1, len(order)):  # a gap under a filled rank, above the lowest filled one; what was filled so counts on
        named = named.withColumn(f"_r{i}", F.coalesce(f"_r{i}", F.when((F.col("_top") >= i) & F.col(f"_r{i - 1}").isNotNull(), F.lit(order[i]))))
    run = F.lit(True)
    places = []
    for i, p in enumerate(order):
        run = run & F.col(f"_r{i}").isNotNull()
        places.append(F.when(run, F.col(f"_r{i}")).otherwise(p))
    return named.filter("_r0 is not null").withColumn(taxa, F.array(*places)).drop("_kept", "_top", "_s", "_last", *(f"_r{i}" for i in range(len(order))))


def several_parents(pairs: DataFrame, child: str, parent: str) -> DataFrame:
    return pairs.groupBy(child).agg(F.count_distinct(parent).alias("n_parents")).filter("n_parents > 1")


def walk(nodes: DataFrame, node: str, parent: str, leaves: DataFrame | None = None) -> DataFrame:
    """node, ancestor, depth for every node (or leaf) and each of its ancestors, itself included.

    A root is its own parent or has none; a parent that is no node is an ancestor.  Pointers double
    each round, and rounds are written tables, so a walk of depth d takes log2(d) of them.  A cycle
    is an error.
    """
    scratch = Scratch(nodes.sparkSession, "walk")
    jump = scratch.save(nodes.select(F.col(node).alias("ancestor"), F.col(parent).alias("_to")).filter("_to is not null and _to <> ancestor"))
    start = (nodes if leaves is None else leaves).select(F.col(node).alias("node")).distinct()
    known = scratch.save(start.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth")))
    step, most = 1, 2 * max(jump.count(), 1)
    while not jump.isEmpty():
        if step > most:
            raise ValueError("the parents of the tree form a cycle")
        far = known.join(jump, "ancestor").select("node", F.col("_to").alias("ancestor"), (F.col("depth") + step).alias("depth"))
        known = scratch.save(known.unionByName(far))
        jump = scratch.save(jump.join(jump.toDF("_to", "_next"), "_to").select("ancestor", F.col("_next").alias("_to")))
        step *= 2
    scratch.keep_only(known)
    return known


def nearest(nodes: DataFrame, node: str, parent: str, rank: str, wanted: str) -> DataFrame:
    """node, ancestor: the nearest ancestor of the wanted rank, the node itself included; nodes without one give no row.

    Pointers double and stop at the first node of that rank, so a round moves one row per node.
    """
    scratch = Scratch(nodes.sparkSession, "nearest")
    found = F.col(rank).eqNullSafe(F.lit(wanted))
    up = F.when(F.col(parent) != F.col(node), F.col(parent))
    now = scratch.save(nodes.select(F.col(node).alias("node"), F.when(found, F.col(node)).otherwise(up).alias("ancestor"), found.alias("found")).filter("ancestor is not null"))
    step, most = 1, 2 * max(now.count(), 1)
    while not (still := now.filter(~F.col("found"))).isEmpty():
        if step > most:
            raise ValueError("the parents of the tree form a cycle")
        moved = still.join(now.toDF("_n", "_to", "_f"), F.col("ancestor") == F.col("_n")).select("node", F.col("_to").alias("ancestor"), F.col("_f").alias("found"))
        now = scratch.save(now.filter("found").unionByName(moved))
        step *= 2
    scratch.keep_only(now)
    return now.select("node", "ancestor")
