"""Pages of a paginated JSON interface, read as one JSON text per page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import strain_variants
from ..functions.names import without_accents

GENERA = "struct<count: bigint, next: string, results: array<struct<label: string, type_species: string, authors: string, taxon: string>>>"
SPECIES = "struct<count: bigint, next: string, results: array<struct<label: string, species: string, authors: string, taxon: string, type_strain: array<string>>>>"


def results(pages: DataFrame, column: str, schema: str) -> DataFrame:
    """The result rows of all pages; a page's ``next`` only says that there is another."""
    return pages.select(F.explode(F.from_json(column, schema)["results"]).alias("r")).select("r.*")


def genera(pages: DataFrame, column: str) -> DataFrame:
    """genus, type_species of genera that name one."""
    return results(pages, column, GENERA).filter("type_species is not null").select(F.col("label").alias("genus"), "type_species")


def species(pages: DataFrame, column: str, genus_types: DataFrame) -> DataFrame:
    """label, type, authority of each species: its prefixed name, the prefixed genus it is the type of, authors and taxon without accents."""
    rows = results(pages, column, SPECIES).join(genus_types.select(F.col("type_species").alias("label"), "genus"), "label", "left")
    return rows.select(F.concat(F.lit("s__"), F.coalesce("label", F.lit(""))).alias("label"), F.coalesce(F.concat(F.lit("g__"), "genus"), F.lit("")).alias("type"), F.coalesce(without_accents(F.concat(F.col("authors"), F.lit(","), F.col("taxon"))), F.lit("")).alias("authority"))


def type_strains(pages: DataFrame, column: str) -> DataFrame:
    """species, strains: all forms of its type strains, joined by ``=``."""
    rows = results(pages, column, SPECIES).filter("type_strain is not null")
    return rows.select("species", F.concat_ws("=", strain_variants(F.col("type_strain"))).alias("strains"))
