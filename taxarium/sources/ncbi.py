"""Tables of the sequence archives: assembly summaries, name dumps, header lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from .readers import dump

#: Columns of an assembly summary that are kept, and their names.
SUMMARY = {
    "bioproject": "ncbi_bioproject", "wgs_master": "ncbi_wgs_master", "refseq_category": "ncbi_refseq_category", "species_taxid": "ncbi_species_taxid", "isolate": "ncbi_isolate",
    "version_status": "ncbi_version_status", "seq_rel_date": "ncbi_seq_rel_date", "asm_name": "ncbi_asm_name", "gbrs_paired_asm": "ncbi_gbrs_paired_asm",
    "paired_asm_comp": "ncbi_paired_asm_comp", "relation_to_type_material": "ncbi_type_material_designation", "excluded_from_refseq": "ncbi_untrustworthy_as_type",
}


def cells(lines: DataFrame, header: list[str], line: str = "value") -> DataFrame:
    """Lines of a TAB-separated table as its columns; comments and the header go."""
    parts = F.split(line, "\t", -1)
    rows = lines.filter(~F.col(line).startswith("#") & (F.get(parts, F.lit(0)) != header[0]))
    return rows.select(*(F.get(parts, F.lit(i)).alias(h) for i, h in enumerate(header)))


def summary_table(spark: SparkSession, path: str, column: str = "taxid") -> DataFrame:
    """An assembly summary.  Its header is the first or the second line, the one that names the column."""
    first = [r[0] for r in spark.read.text(path).limit(2).collect()]
    header = next((h for h in ([c.strip("# ") for c in f.split("\t")] for f in first) if column in h), None)
    if header is None:
        raise ValueError(f"no header with {column} in {path}")
    return cells(spark.read.text(path), header)


def unique_or_error(df: DataFrame, key: str) -> DataFrame:
    """One row per key; a repeated key is an error."""
    rest = [c for c in df.columns if c != key]
    held = df.groupBy(key).agg(F.any_value(F.struct(*rest)).alias("_r"), F.count("*").alias("_n"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate accession: "), F.col(key)))).otherwise(F.col(key))
    return held.select(checked.alias(key), "_r.*")


def tax_ids(tables: list[DataFrame]) -> DataFrame:
    """accession, taxid over all summaries; an accession in two rows is an error."""
    rows = reduce(DataFrame.unionByName, (t.select(F.col("assembly_accession").alias("accession"), "taxid") for t in tables))
    return unique_or_error(rows, "accession")


def organism_names(tables: list[DataFrame]) -> DataFrame:
    """gid (with its archive's prefix), organism_name over all summaries."""
    gid = F.when(F.col("assembly_accession").startswith("GCA_"), F.concat(F.lit("GB_"), "assembly_accession")).otherwise(F.concat(F.lit("RS_"), "assembly_accession"))
    return reduce(DataFrame.unionByName, (t.select(gid.alias("gid"), "organism_name") for t in tables))


def assembly_metadata(tables: list[DataFrame], wanted: DataFrame) -> DataFrame:
    """genome_id and the kept columns of listed genomes (id), with the formatted project id and whether the type status is in doubt."""
    def one(t: DataFrame) -> DataFrame:
        columns: list[Column] = []
        for old, new in SUMMARY.items():
            c = F.col(old) if old in t.columns else F.lit(None).cast("string")
            columns.append((F.coalesce(c, F.lit("")).contains("untrustworthy as type").cast("string") if old == "excluded_from_refseq" else c).alias(new))
            if old == "wgs_master":
                columns.append(F.when(F.coalesce(c, F.lit("")) != "", ids.wgs_id(c)).otherwise("").alias("ncbi_wgs_formatted"))
        return t.select(ids.source_prefixed(F.col("assembly_accession")).alias("genome_id"), *columns)

    listed = wanted.select(ids.source_prefixed(F.col("id")).alias("genome_id")).distinct()
    return reduce(DataFrame.unionByName, map(one, tables)).join(listed, "genome_id", "left_semi")


def scientific_names(spark: SparkSession, path: str) -> DataFrame:
    """tax_id, name of a name dump; the last row of an id wins."""
    rows = dump(spark, path, {"tax_id": 0, "name": 1, "class": 3}).withColumn("ord", F.monotonically_increasing_id())
    return last_scientific(rows)


def last_scientific(names: DataFrame) -> DataFrame:
    """tax_id, name of (tax_id, name, class, ord): the last scientific name of each id."""
    return names.filter("class = 'scientific name'").groupBy("tax_id").agg(F.max_by("name", "ord").alias("name"))


def header_taxonomies(lines: DataFrame, line: str = "value") -> DataFrame:
    """seq_id, taxonomy of the header lines of a reference file: the first word and the rest."""
    head = F.split(F.substring(F.col(line), F.lit(2), F.length(line)), " ", 2)
    return lines.filter(F.col(line).startswith(">")).select(F.get(head, F.lit(0)).alias("seq_id"), F.coalesce(F.get(head, F.lit(1)), F.lit("")).alias("taxonomy"))
