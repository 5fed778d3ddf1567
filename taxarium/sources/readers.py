"""Readers of the text formats, as DataFrames of strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import accession_of_path, formatted_id


def separator(spark: SparkSession, path: str) -> str:
    """TAB if the first line has at least as many TABs as commas, else a comma."""
    first = spark.read.text(path).limit(1).first()
    line = first[0] if first else ""
    return "\t" if line.count("\t") >= line.count(",") else ","


def table(spark: SparkSession, path: str) -> DataFrame:
    """A delimited table with a header; every cell is text."""
    return spark.read.csv(path, sep=separator(spark, path), header=True, quote='"', maxCharsPerColumn=-1)


def dump(spark: SparkSession, path: str, columns: dict[str, int]) -> DataFrame:
    """Pipe-separated taxonomy dump: the named fields, trimmed."""
    parts = F.transform(F.split("value", r"\|"), lambda x: F.trim(F.regexp_replace(x, r"[\t\r]", "")))
    return spark.read.text(path).select(*(F.get(parts, F.lit(i)).alias(n) for n, i in columns.items()))


def lineages(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.lineage import parse

    parts = F.split("value", "\t", 2)
    return spark.read.text(path).filter("trim(value) <> ''").select(F.get(parts, F.lit(0)).alias("id"), parse(F.get(parts, F.lit(1))).alias("taxa"))


def id_list(spark: SparkSession, path: str, comments: bool = True) -> DataFrame:
    """Distinct first cells; a line is cut at TABs if it has as many as commas at least, else at commas."""
    line = F.col("value")
    count = lambda mark: F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))
    first = F.when(count("\t") >= count(","), F.substring_index(line, "\t", 1)).otherwise(F.substring_index(line, ",", 1))
    rows = spark.read.text(path).filter(F.trim("value") != "")
    return (rows.filter(~line.startswith("#")) if comments else rows).select(F.trim(first).alias("id")).distinct()


def genome_paths(spark: SparkSession, path: str) -> DataFrame:
    """id, path, formatted id (null where the file has two columns)."""
    parts = F.split("value", "\t")
    return spark.read.text(path).filter("trim(value) <> ''").select(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(("id", "path", "formatted_id"))))


def folders(spark: SparkSession, path: str, pattern: str = "*_assembly_report.txt") -> DataFrame:
    """accession, path, formatted id of the genome folders under a sharded tree, by one file that each holds.  File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.select(accession_of_path(folder).alias("accession"), folder.alias("path")).distinct().withColumn("formatted_id", formatted_id(F.col("accession")))


def gff(spark: SparkSession, path: str) -> DataFrame:
    names = "seq string, source string, type string, start long, end long, score string, strand string, phase string, attributes string"
    return spark.read.csv(path, sep="\t", comment="#", schema=names)


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """seq_id (first word of the header) and seq of every record; a ``>`` within a line opens none."""
    records = spark.read.option("lineSep", "\n>").text(path).filter("trim(value) <> ''").select(F.regexp_replace("value", "^>", "").alias("value"))
    parts = F.split("value", r"\r?\n", 2)
    return records.select(F.get(F.split(F.get(parts, F.lit(0)), r"\s"), F.lit(0)).alias("seq_id"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "").alias("seq"))


def hmm_table(spark: SparkSession, path: str, columns: dict[str, int]) -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(~F.col("value").rlike(r"^[#\[]") & (F.trim("value") != "")).select(*(F.get(parts, F.lit(i)).alias(n) for n, i in columns.items()))


def key_values(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its field/value lines pivoted."""
    parts = F.split("value", "\t", 2)
    rows = spark.read.text(path).select(F.input_file_name().alias("file"), F.get(parts, F.lit(0)).alias("field"), F.get(parts, F.lit(1)).alias("value"))
    return rows.groupBy("file").pivot("field").agg(F.first("value"))
