"""Loading text tables into typed database tables by a catalogue of columns (field, description, type, table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.cells import load_cell

#: The Spark type of each declared type; quality columns with their field and type.
TYPES = {"TEXT": "string", "INT": "bigint", "INTEGER": "bigint", "FLOAT": "double", "BOOLEAN": "boolean"}
QUALITY = {
    "Completeness": ("checkm_completeness", "FLOAT"), "Contamination": ("checkm_contamination", "FLOAT"), "Strain heterogeneity": ("checkm_strain_heterogeneity", "FLOAT"),
    "Marker lineage": ("checkm_marker_lineage", "TEXT"), "# genomes": ("checkm_genome_count", "INT"), "# markers": ("checkm_marker_count", "INT"), "# marker sets": ("checkm_marker_set_count", "INT"),
}


def describe(df: DataFrame, descriptions: dict[str, str], table: str) -> list[tuple[str, str, str, str]]:
    """Catalogue rows of a table's columns."""
    names = {"bigint": "INT", "int": "INT", "double": "FLOAT", "float": "FLOAT", "boolean": "BOOLEAN"}
    return [(c, descriptions.get(c, ""), names.get(t, "TEXT"), table) for c, t in df.dtypes]


def long_form(table: DataFrame, key: str, catalogue: DataFrame) -> DataFrame:
    """key (with its archive's prefix), table, field, type, value: the cells to store of a text table; blank ones and columns outside the catalogue go."""
    cells = [c for c in table.columns if c != key]
    if not cells:
        return table.limit(0).select(key, *(F.lit("").alias(c) for c in ("table", "field", "type", "value")))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("cell")) for c in cells)))
    rows = table.select(F.col(key).alias("_original"), pairs.alias("p")).select("_original", "p.*").join(F.broadcast(catalogue.select("field", "type", "table")), "field")
    value = F.when(F.col("type").isin("INT", "INTEGER"), load_cell(F.col("cell"), "INT")).otherwise(load_cell(F.col("cell"), "TEXT"))
    out = rows.select(ids.source_prefixed(F.col("_original")).alias(key), "_original", "table", "field", "type", value.alias("value"))
    return out.filter("value is not null")


def listed(rows: DataFrame, key: str, wanted: DataFrame | None, empty_is_all: bool = True, original: str | None = None) -> DataFrame:
    """Rows whose id, or original id, is wanted (column id).  Without a list, and with an empty one if so told, all rows."""
    if wanted is None:
        return rows
    names = wanted.select(F.col("id").alias("_w")).distinct()
    if empty_is_all and names.isEmpty():
        return rows
    by_key = rows.join(names, F.col(key) == F.col("_w"), "left_semi")
    if original is None:
        return by_key
    return by_key.unionByName(rows.join(names, F.col(key) == F.col("_w"), "left_anti").join(names, F.col(original) == F.col("_w"), "left_semi"))


def typed(value: Column, kind: str) -> Column:
    """Text as a declared type; what cannot be read is null."""
    return value.try_cast(TYPES[kind.upper()])


def store(target: DataFrame, cells: DataFrame, key: str, reset: bool = False) -> DataFrame:
    """The next snapshot of one table: its cells (key, field, type, value) over the old values, or over nulls after a reset of the loaded fields."""
    fields = {r["field"]: r["type"] for r in cells.select("field", "type").distinct().collect()}  # columns of one table
    wide = cells.groupBy(key).agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"_new_{f}") for f in fields)) if fields else cells.select(key).distinct()
    joined = target.join(wide, key, "full_outer")
    column = lambda c: typed(F.col(f"_new_{c}"), fields[c]) if reset else F.coalesce(typed(F.col(f"_new_{c}"), fields[c]), F.col(c))
    return joined.select(key, *((column(c) if c in fields else F.col(c)).alias(c) for c in target.columns if c != key))


def nulled(target: DataFrame, columns: list[str]) -> DataFrame:
    """Columns set to null before a load."""
    return target.select(*(F.lit(None).cast(t).alias(c) if c in columns else F.col(c) for c, t in target.dtypes))


def quality_cells(profile: DataFrame, bin_id: str, wanted: DataFrame) -> DataFrame:
    """key, field, type, value of a quality profile for listed genomes; an empty list gives none.  A bin id ends behind its second underscore-separated part."""
    gid = ids.source_prefixed(F.substring_index(bin_id, "_", 2))
    present = {c: v for c, v in QUALITY.items() if c in profile.columns}
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.lit(t).alias("type"), F.col(f"`{c}`").cast("string").alias("value")) for c, (f, t) in present.items())))
    rows = profile.select(gid.alias("gid"), pairs.alias("p")).select("gid", "p.*")
    return listed(rows, "gid", wanted, empty_is_all=False)


def taxonomy_cells(lineages: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """gid, lineage text of (id, taxa) with the archive's prefix, for listed genomes."""
    return listed(lineages.select(ids.source_prefixed(F.col("id")).alias("gid"), F.concat_ws(";", "taxa").alias("lineage")), "gid", wanted)


def cluster_members(clusters: DataFrame, genomes: DataFrame, rep: str, members: str) -> DataFrame:
    """accession, representative of clusters (rep, comma-separated members), by canonical id; an id that no genome has is an error.

    The representative belongs to its own cluster.
    """
    listed_ids = F.array_union(F.array(F.trim(rep)), F.filter(F.transform(F.split(F.coalesce(members, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))
    rows = clusters.select(F.trim(rep).alias("_rep"), F.explode(listed_ids).alias("_id"))
    known = genomes.select(ids.canonical_id(F.col("accession")).alias("_c"), "accession")
    named = rows.join(known, F.col("_id") == F.col("_c"), "left").drop("_c").withColumnRenamed("accession", "_a")
    named = named.join(known.toDF("_rc", "_ra"), F.col("_rep") == F.col("_rc"), "left")
    known_or_error = lambda c, i: F.coalesce(c, F.raise_error(F.concat(F.lit("unknown genome: "), i)))
    return named.select(known_or_error("_a", F.col("_id")).alias("accession"), known_or_error("_ra", F.col("_rep")).alias("representative"))


def representative_flags(assigned: DataFrame, genomes: DataFrame) -> DataFrame:
    """accession, representative (null outside clusters), is_representative of all genomes."""
    return genomes.select("accession").join(assigned, "accession", "left").select("accession", "representative", F.coalesce(F.col("representative") == F.col("accession"), F.lit(False)).alias("is_representative"))
