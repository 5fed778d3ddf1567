"""Taxonomies as tables (id, taxa): members, children, parents, checks, lineages from a tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import species_validity_lax
from ..scratch import Scratch
from .lineage import PREFIXES, RANKS, ROOTS, prefixes, walk


def places(df: DataFrame, id_: str, taxa: str) -> DataFrame:
    """id, rank (from 0), taxon, parent (null at rank 0) of every place of every lineage."""
    rows = df.select(F.col(id_).alias("id"), F.posexplode(taxa).alias("rank", "taxon"), F.col(taxa).alias("_t"))
    return rows.select("id", "rank", "taxon", F.when(F.col("rank") > 0, F.get("_t", F.col("rank") - 1)).alias("parent"))


def is_named(taxon: Column | str) -> Column:
    return F.length(taxon) > 3


def children(df: DataFrame, id_: str, taxa: str) -> DataFrame:
    """parent, child: named children of named taxa; the children of a species are its ids.  One row a pair, so that no taxon is gathered."""
    rows = places(df, id_, taxa)
    pairs = rows.filter(is_named("taxon") & is_named("parent")).select("parent", F.col("taxon").alias("child"))
    extant = rows.filter((F.col("rank") == len(PREFIXES) - 1) & (F.col("taxon") != "s__")).select(F.col("taxon").alias("parent"), F.col("id").cast("string").alias("child"))
    return pairs.unionByName(extant).distinct()


def below(df: DataFrame, id_: str, taxa: str, taxon: str) -> DataFrame:
    """child: all named taxa below a taxon, or the ids of a species."""
    if taxon.startswith("s__"):
        return df.filter(F.array_contains(taxa, taxon)).select(F.col(id_).cast("string").alias("child")).distinct()
    at = F.array_position(taxa, taxon).cast("int")
    rest = F.slice(F.col(taxa), at + 1, F.greatest(F.size(taxa) - at, F.lit(0)))
    return df.filter(at > 0).select(F.explode(rest).alias("child")).filter(is_named("child")).distinct()


def members(df: DataFrame, id_: str, taxa: str, named: bool = True) -> DataFrame:
    """taxon, id: every taxon with the ids that it holds; bare prefixes only on request."""
    rows = df.select(F.col(id_).alias("id"), F.explode(taxa).alias("taxon")).distinct()
    return (rows.filter(is_named("taxon")) if named else rows).select("taxon", "id")


def named_at_rank(df: DataFrame, taxa: str) -> DataFrame:
    """rank, taxon: the taxa at each rank but bare prefixes of it."""
    return places(df.withColumn("_i", F.lit(0)), "_i", taxa).filter(F.col("taxon") != F.get(prefixes(), F.col("rank"))).select("rank", "taxon").distinct()


def parent_lineages(df: DataFrame, id_: str, taxa: str) -> DataFrame:
    """taxon, parents: the taxa above each taxon, root first, of the least id that holds it; and all taxa of each id."""
    rows = df.select(F.col(id_).alias("id"), F.posexplode(taxa).alias("rank", "taxon"), F.col(taxa).alias("_t")).filter("rank > 0")
    above = rows.groupBy("taxon").agg(F.min_by(F.slice("_t", F.lit(1), F.col("rank")), "id").alias("parents"))
    return above.unionByName(df.select(F.col(id_).cast("string").alias("taxon"), F.col(taxa).alias("parents")))


def expected_parents(df: DataFrame, id_: str, taxa: str) -> DataFrame:
    """taxon, parent, conflicts: the parent by the last id, and how many other parents there are.  A lineage ends at its first bare prefix; viruses are left out."""
    usable = df.filter((F.get(taxa, F.lit(0)) != "d__Viruses") & ~F.get(taxa, F.lit(0)).contains("[P]"))
    first = F.array_position(F.transform(F.slice(F.col(taxa), F.lit(2), F.size(taxa)), lambda t: F.length(t) == 3), True).cast("int")
    rows = places(usable.withColumn(taxa, F.when(first > 0, F.slice(F.col(taxa), F.lit(1), first)).otherwise(F.col(taxa))), id_, taxa).filter("rank > 0")
    return rows.groupBy("taxon").agg(F.max_by("parent", "id").alias("parent"), (F.count_distinct("parent") - 1).alias("conflicts"))


def duplicates(df: DataFrame, taxa: str, check_species: bool = True) -> DataFrame:
    """taxon, n_lineages: names that stand in two lineages or more."""
    rows = df.select(F.posexplode(taxa).alias("rank", "taxon"), F.col(taxa).alias("_t")).filter(is_named("taxon"))
    found = rows.groupBy("taxon").agg(F.count_distinct(F.concat_ws(";", F.slice("_t", F.lit(1), F.col("rank") + 1))).alias("n_lineages")).filter("n_lineages > 1")
    return found if check_species else found.filter(~F.col("taxon").startswith("s__"))


def validate(df: DataFrame, id_: str, taxa: str) -> DataFrame:
    """id (text; null for checks of taxa), check, detail: everything that is wrong with a taxonomy.

    A lineage without seven ranks gets no other check of its own.
    """
    t = F.col(taxa)
    base = df.select(F.col(id_).cast("string").alias("id"), t.alias("_t"), F.concat_ws(";", t).alias("_line"))
    ranks = base.filter(F.size("_t") != len(PREFIXES)).select("id", F.lit("ranks").alias("check"), F.col("_line").alias("detail"))
    whole = base.filter(F.size("_t") == len(PREFIXES))
    wrong = F.filter(F.arrays_zip(F.col("_t").alias("t"), prefixes().alias("p")), lambda x: ~x["t"].startswith(x["p"]))
    prefix = whole.filter(F.size(wrong) > 0).select("id", F.lit("prefix").alias("check"), F.get(wrong, F.lit(0))["t"].alias("detail"))
    letters = lambda x: F.trim(F.regexp_replace(F.substring(x, F.lit(4), F.length(x)), "_[A-Z]+(?= |$)", " "))
    odd = F.filter("_t", lambda x: (letters(x) != "") & ~letters(x).rlike("^[a-zA-Z0-9 -]+$"))
    group = whole.filter(F.size(odd) > 0).select("id", F.lit("characters").alias("check"), F.element_at(odd, -1).alias("detail"))
    species, genus = F.get("_t", F.lit(6)), F.get("_t", F.lit(5))
    rest = lambda x: F.substring(x, F.lit(4), F.length(x))
    reason = F.when((species != "s__") & (rest(F.substring_index(species, " ", 1)) != rest(genus)), "genus and generic name differ").otherwise(species_validity_lax(species))
    named = whole.select("id", F.lit("species").alias("check"), reason.alias("detail")).filter("detail is not null")
    low = base.select(F.explode("_t").alias("detail")).filter(F.substring("detail", 4, 1).rlike(r"\p{Ll}")).distinct().select(F.lit(None).cast("string").alias("id"), F.lit("capitals").alias("check"), "detail")
    twice = duplicates(df, taxa).select(F.lit(None).cast("string").alias("id"), F.lit("duplicate").alias("check"), F.col("taxon").alias("detail"))
    parents = expected_parents(df, id_, taxa).filter("conflicts > 0").select(F.lit(None).cast("string").alias("id"), F.lit("hierarchy").alias("check"), F.col("taxon").alias("detail"))
    return reduce(DataFrame.unionByName, (ranks, prefix, group, named, low, twice, parents))


def sort_taxa(df: DataFrame, taxon: str, reverse: bool = False) -> DataFrame:
    """Rows by rank, then by name."""
    rank = F.array_position(prefixes(), F.substring(taxon, 1, 3))
    return df.orderBy(*(x.desc() if reverse else x.asc() for x in (rank, F.col(taxon))))


def truncate(taxa: Column) -> Column:
    """The domain, bare prefixes below."""
    return F.concat(F.slice(taxa, 1, 1), F.array(*map(F.lit, PREFIXES[1:])))


def rank_columns(df: DataFrame, key: str, taxa: str) -> DataFrame:
    """key and one column per rank."""
    return df.select(key, *(F.get(taxa, F.lit(i)).alias(r) for i, r in enumerate(RANKS)))


def node_prefix(rank: Column, keep_subranks: bool = False, dump: bool = False) -> Column:
    """The prefix of a node's rank; ``dump`` gives that of the name dump, which knows super- but no subkingdoms."""
    out = F.when(rank == "subspecies", "sb__")
    for r, p in zip(RANKS, PREFIXES):
        out = out.when(rank == r, p)
    out = out.when(rank == "superkingdom", "d__") if dump else out.when(rank == "subkingdom", "sd__" if keep_subranks else "d__").when(rank == "kingdom", "d__")
    if keep_subranks:
        for r, p in zip(RANKS, PREFIXES):
            out = out.when(rank == f"sub{r}", f"s{p}")
    return out.otherwise("x__")


def tree_lineages(leaves: DataFrame, tax_id: str, nodes: DataFrame, names: DataFrame, keep_subranks: bool = False) -> DataFrame:
    """tax_id, lineage: prefixed names from below the named root to the node, joined by ``;``.

    nodes: tax_id, parent, rank; names: tax_id, name.  Unknown ids give no row.  A walk that ends
    at the tree's own root, ``1``, instead of a named root is an error.
    """
    scratch = Scratch(nodes.sparkSession, "lineages")
    known = nodes.select("tax_id", "parent", "rank").join(names.select("tax_id", "name"), "tax_id")
    known = scratch.save(known.withColumn("root", F.col("name").isin(*ROOTS)))
    wanted = leaves.select(F.col(tax_id).alias("tax_id")).distinct().join(known.select("tax_id"), "tax_id", "left_semi")
    steps = walk(known.select("tax_id", F.when(~F.col("root"), F.col("parent")).alias("parent")), "tax_id", "parent", wanted)
    taxa = steps.join(known.withColumnRenamed("tax_id", "ancestor").drop("parent"), "ancestor").filter(~F.col("root"))
    taxon = F.when(F.col("ancestor").cast("string") == "1", F.raise_error(F.lit("a walk reached the root of the tree"))).otherwise(F.concat(node_prefix(F.col("rank"), keep_subranks), "name"))
    rows = taxa.groupBy("node").agg(F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("up"), taxon.alias("taxon")))).alias("t"))
    return rows.select(F.col("node").alias("tax_id"), F.concat_ws(";", F.transform("t", lambda x: x["taxon"])).alias("lineage"))


def name_maps(lineages: DataFrame, key: str, steps: DataFrame) -> DataFrame:
    """key, json: for each key the map of its taxa (key, taxon, tax_id) as a JSON text, keys sorted."""
    pairs = steps.select(key, "taxon", F.col("tax_id").cast("string").alias("tax_id")).distinct()
    held = pairs.join(lineages.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("taxon", "tax_id"))).alias("e"))
    return held.select(key, F.to_json(F.map_from_entries("e")).alias("json"))
