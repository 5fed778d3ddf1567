"""Lists for curators: new, polyphyletic and rogue representatives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, names


def new_representatives(current: DataFrame, previous: DataFrame, domain: DataFrame, key: str) -> DataFrame:
    """Current representatives of the domain's genomes that were none before, by canonical id."""
    canonical = lambda t: t.select(ids.canonical_id(F.col(key)).alias(key)).distinct()
    return canonical(current).join(canonical(domain), key, "left_semi").join(canonical(previous), key, "left_anti")


def polyphyletic(table: DataFrame, members: DataFrame) -> DataFrame:
    """id: genomes of taxa (taxon, f_measure) below an f-measure of one; members: taxon, id."""
    return members.join(table.filter("f_measure < 1.0").select("taxon").distinct(), "taxon", "left_semi").select("id").distinct()


def rogues(table: DataFrame) -> DataFrame:
    """id: canonical ids of the comma-separated rogue lists of polyphyletic taxa, but those that start with ``D-``."""
    lists = F.concat(*(F.split(F.coalesce(c, F.lit("")), ",") for c in ("rogue_in", "rogue_out")))
    each = table.filter("f_measure < 1.0").select(F.explode(lists).alias("g")).filter("trim(g) <> ''")
    return each.select(ids.canonical_id(F.trim("g")).alias("id")).filter(~F.col("id").startswith("D-")).distinct()


#: Category texts in order of precedence.
CATEGORIES = (("MAG", "derived from metagenome"), ("SAG", "derived from single cell"), ("ENV", "derived from environmental sample"))


def genome_categories(genomes: DataFrame, notes: DataFrame, lines: DataFrame) -> DataFrame:
    """gid, category, source: user genomes are metagenomic; else the last assembly report's class (gid, note, ord) counts, else the lines of the flat file (gid, line).

    Of several classes in a flat file a metagenome goes before a single cell before an environment.
    Genomes without any class give no row.
    """
    noted = notes.select("gid", "ord", names.assembly_category(F.col("note")).alias("_n")).filter("_n is not null").groupBy("gid").agg(F.max_by("_n", "ord").alias("_n"))
    read = lines.select("gid", names.line_category(F.col("line")).alias("_c")).filter("_c is not null")
    rank = F.when(F.col("_c") == "MAG", 0).when(F.col("_c") == "SAG", 1).otherwise(2)
    found = genomes.select("gid").join(noted, "gid", "left").join(read.groupBy("gid").agg(F.min_by("_c", rank).alias("_l")), "gid", "left")
    user = ids.is_user(F.col("gid"))
    kind = F.when(user, "MAG").otherwise(F.coalesce("_n", "_l"))
    text = F.when(kind == "MAG", CATEGORIES[0][1]).when(kind == "SAG", CATEGORIES[1][1]).when(kind == "ENV", CATEGORIES[2][1])
    source = F.when(user, "user genome").when(F.col("_n").isNotNull(), "assembly report").otherwise("GBFF file")
    return found.select("gid", text.alias("category"), source.alias("source")).filter("category is not null")
