"""Parsers of line-oriented reports, one row per file, as window states and aggregates over numbered lines."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lineage import PREFIXES


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, line of every line.  A report is one file and small; files are the unit of work."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line"))


def _state(mark: Column) -> Column:
    """The last mark at or before each line of its file."""
    return F.last(mark, ignorenulls=True).over(Window.partitionBy("file").orderBy("pos"))


def assembly_report(lines: DataFrame, fields: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """file, one column per field of the header part, one per statistic of the whole assembly; the last line wins.

    Names may hold blanks; columns keep them.  What a report lacks is an empty text.
    """
    line = F.col("line")
    part = F.when(line.contains("Assembly Statistics Report"), "header").when(line.contains("Statistic Types"), "types").when(line.contains("Sequence-type Description"), "values")
    rows = lines.withColumn("part", _state(part))
    colon = F.instr(line, ":")
    key = F.when((F.col("part") == "header") & (colon > 0), F.substring(line, F.lit(3), F.greatest(colon - 3, F.lit(0))))
    text = F.trim(F.substring(line, colon + 1, F.length(line)))
    cells = F.split(line, "\t")
    cell = lambda i: F.get(cells, F.lit(i))
    total = (F.col("part") == "values") & (F.size(cells) == 6) & cell(0).isin("all", "Primary Assembly") & (cell(1) == "all") & (cell(3) == "all")
    rows = rows.select("file", "pos", key.alias("key"), F.when(key == "Organism name", F.trim(F.substring_index(text, "(", 1))).otherwise(text).alias("text"), F.when(total, cell(4)).alias("stat"), F.trim(cell(5)).alias("number"))
    pick = lambda value, name, of: F.coalesce(F.max_by(F.when(F.col(name) == of, F.col(value)), F.when(F.col(name) == of, F.col("pos"))), F.lit("")).alias(of)
    return rows.groupBy("file").agg(*(pick("text", "key", f) for f in fields), *(pick("number", "stat", s) for s in stats))


def nucleotide_hits(lines: DataFrame, domain: str, threshold: float = 1e-6) -> DataFrame:
    """file, seq_id, domain, evalue, start, end, length, reverse of the profile hits within the threshold.

    A block begins with ``>>``, its hits with its third line; a blank line ends it.
    """
    mark = F.when(F.col("line").startswith(">>"), F.struct(F.get(F.split("line", r"\s+"), F.lit(1)).alias("seq_id"), F.col("pos").alias("first"))).when(F.trim("line") == "", F.struct(F.lit(None).cast("string").alias("seq_id"), F.col("pos").alias("first")))
    rows = lines.withColumn("block", _state(mark)).filter("block.seq_id is not null and pos - block.first >= 3")
    cells = F.split(F.trim("line"), r"\s+")
    a, b = (F.get(cells, F.lit(i)).try_cast("long") for i in (7, 8))
    evalue = F.get(cells, F.lit(3))
    hits = rows.select("file", "pos", F.col("block.seq_id").alias("seq_id"), F.lit(domain).alias("domain"), evalue.alias("evalue"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), (F.abs(a - b) + 1).alias("length"), (a > b).alias("reverse"))
    return hits.filter(F.col("evalue").try_cast("double") <= threshold)


def transfer_rna_counts(lines: DataFrame) -> DataFrame:
    """file, trna_count, trna_aa_count, trna_selenocysteine_count."""
    line = F.col("line")
    number = F.trim(F.get(F.split(line, ":"), F.lit(1))).try_cast("long")
    pair = F.split(F.get(F.split(line, "\t"), F.lit(0)), ":")
    inside = _state(F.when(line.startswith("Isotype / Anticodon Counts:"), True))
    amino = inside & line.contains(" : ") & (F.length(F.trim(F.get(pair, F.lit(0)))) == 3) & (F.trim(F.get(pair, F.lit(1))).try_cast("long") > 0)
    rows = lines.select("file", F.when(line.startswith("tRNAs decoding Standard 20 AA"), number).alias("standard"), F.when(line.startswith("Selenocysteine tRNAs (TCA)"), number).alias("sec"), F.coalesce(amino, F.lit(False)).alias("amino"))
    standard, sec = F.coalesce(F.max("standard"), F.lit(0)), F.coalesce(F.max("sec"), F.lit(0))
    return rows.groupBy("file").agg((standard + sec).alias("trna_count"), F.count_if("amino").alias("trna_aa_count"), sec.alias("trna_selenocysteine_count"))


def translation_table(lines: DataFrame) -> DataFrame:
    """file, translation_table of the first line of a flat file that names one."""
    found = F.when(F.col("line").contains("transl_table="), F.col("pos"))
    return lines.groupBy("file").agg(F.trim(F.substring_index(F.min_by("line", found), "=", -1)).alias("translation_table"))


def line_categories(lines: DataFrame, key: str) -> DataFrame:
    """key, category of genomes from flat-file lines: metagenome before single cell before environment; others give no row."""
    line = F.col("line")
    meta = line.contains("/metagenome_source") | line.rlike("(?i)derived from(\\w|\\s)*metagenome")
    kind = F.when(line.contains("metagenome"), F.when(meta, 1)).when(line.contains("single cell"), 2).when(line.contains("/environmental_sample") | line.contains("derived from environmental source"), 3)
    names = F.create_map(*(F.lit(x) for x in (1, "derived from metagenome", 2, "derived from single cell", 3, "derived from environmental sample")))
    return lines.select(key, kind.alias("kind")).filter("kind is not null").groupBy(key).agg(F.min("kind").alias("kind")).select(key, names[F.col("kind")].alias("category"))


def genome_folders(spark: SparkSession, root: str) -> DataFrame:
    """accession, path of every genome folder of a sharded tree (code/three/three/three/folder); contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    folder = F.regexp_extract("path", r"^(.*/GC[AF]/[^/]+/[^/]+/[^/]+/[^/]+)/.+$", 1)
    return files.select(folder.alias("path")).filter("path <> ''").distinct().select(F.regexp_extract(F.substring_index("path", "/", -1), r"^(.{4}[^_]*)", 1).alias("accession"), "path")


def file_hashes(spark: SparkSession, root: str) -> DataFrame:
    """path, name, kind (fasta, protein, extra_fasta or other), sha256 of all files."""
    name = F.substring_index("path", "/", -1)
    extra = name.endswith("_cds_from_genomic.fna") | name.endswith("_rna_from_genomic.fna")
    kind = F.when(extra, "extra_fasta").when(name.endswith("_genomic.fna"), "fasta").when(name.endswith("_protein.faa"), "protein").otherwise("other")
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", name.alias("name"), kind.alias("kind"), F.sha2("content", 256).alias("sha256"))


def newick_paths(text: str) -> list[tuple[str, list[str]]]:
    """Leaves of a Newick tree with the labels of their ancestors, root first."""
    leaves, above, fresh, at = [], [[]], True, 0
    while at < len(text):
        c = text[at]
        if c == "(":
            above.append([])
            fresh, at = True, at + 1
        elif c in ",; \t\r\n":
            fresh, at = c == "," or fresh, at + 1
        elif c == ")":
            inner = above.pop()
            label, at = _label(text, at + 1)
            for i in inner:
                leaves[i][1].append(label)
            above[-1] += inner
            fresh = False
        else:
            label, at = _label(text, at)
            if fresh:
                above[-1].append(len(leaves))
                leaves.append((label, []))
            fresh = False
    return [(name, labels[::-1]) for name, labels in leaves]


def _label(text: str, at: int) -> tuple[str, int]:
    """A quoted or plain label and the place behind it and its branch length."""
    label = ""
    if text[at : at + 1] == "'":
        stop = text.index("'", at + 1)
        while text[stop : stop + 2] == "''":
            stop = text.index("'", stop + 2)
        label, at = text[at + 1 : stop].replace("''", "'"), stop + 1
    stop = at
    while stop < len(text) and text[stop] not in "(),;":
        stop += 1
    return label or text[at:stop].split(":")[0].strip(), stop


def tree_lineages(spark: SparkSession, path: str) -> DataFrame:
    """leaf, taxa (seven ranks) of Newick files from the labels of inner nodes; pure support values do not count."""

    def read(batches):
        for batch in batches:
            for text in batch["value"]:
                paths = newick_paths(text)
                yield pd.DataFrame({"leaf": [p[0] for p in paths], "labels": [p[1] for p in paths]})

    rows = spark.read.text(path, wholetext=True).mapInPandas(read, "leaf string, labels array<string>")
    name = lambda x: F.when(x.contains(":"), F.get(F.split(x, ":"), F.lit(1))).otherwise(x)
    named = F.filter(F.transform("labels", name), lambda x: (x != "") & x.try_cast("double").isNull())
    parts = F.flatten(F.transform(named, lambda x: F.split(F.regexp_replace(F.regexp_replace(x, ";$", ""), "__([dpcofgs]__)", ";$1"), ";")))
    taxa = F.transform(parts, lambda t: F.trim(t))
    genus, species = F.substring(F.get("taxa", F.lit(5)), 4, 10000), F.substring(F.get("taxa", F.lit(6)), 4, 10000)
    joined = F.when((F.size("taxa") == 7) & ~species.contains(genus) & (F.size(F.split(species, r"\s+")) == 1) & (species != ""), F.concat(F.slice("taxa", 1, 6), F.array(F.concat(F.lit("s__"), genus, F.lit(" "), species)))).otherwise(F.col("taxa"))
    padding = F.slice(F.array(*map(F.lit, PREFIXES)), F.size("taxa") + 1, F.greatest(F.lit(7) - F.size("taxa"), F.lit(0)))
    return rows.select("leaf", taxa.alias("taxa")).select("leaf", F.concat(joined, padding).alias("taxa"))


def json_rows(spark: SparkSession, path: str, first: str = "label") -> DataFrame:
    """JSON objects with any keys as one wide table of text: the named column first, lists joined by ``||``."""
    df = spark.read.json(path, multiLine=True)
    order = [c for c in (first,) if c in df.columns] + [c for c in df.columns if c != first]
    types = dict(df.dtypes)
    return df.select(*(F.concat_ws("||", F.col(f"`{c}`").cast("array<string>")).alias(c) if types[c].startswith("array") else F.col(f"`{c}`").cast("string").alias(c) for c in order))


def json_pages(spark: SparkSession, path: str) -> DataFrame:
    """The results of saved pages of a paginated interface, one row each."""
    return spark.read.json(path, multiLine=True).select(F.explode("results").alias("result")).select("result.*")
