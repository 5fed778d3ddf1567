"""Nomenclature pages: index links, type genera, genus, species and subspecies pages, tables; expressions over whole pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.names import strip_tags

#: Marks of the lines that hold the name, the proposal and the type strains; texts for strains that do not exist.
NAME, PROPOSAL = "glossary#citation-of-names-and-authors", "glossary#abbreviations-in-proposals"
NO_STRAIN = ("no culture isolated", "no culture available", "no pure culture")


def quoted(page: Column) -> Column:
    return F.replace(page, F.lit("'"), F.lit('"'))


def lines(page: Column) -> Column:
    return F.split(quoted(page), "\n")


def links(pages: DataFrame, key: str, page: str, folder: str, css: str, base: str) -> DataFrame:
    """key, name, url: one row per index line of the class that links to the folder."""
    each = pages.select(key, F.explode(lines(F.col(page))).alias("_l")).filter(F.col("_l").contains(f'class="{css}"'))
    url = F.regexp_extract("_l", rf'href="(/{folder}/[^"]+)"', 1)
    name = strip_tags(F.regexp_extract("_l", rf'class="{css}">(.*)</a>', 1))
    return each.select(key, name.alias("name"), url.alias("_u")).filter("_u <> ''").select(key, "name", F.concat(F.lit(base), "_u").alias("url"))


def without_quoted_twins(names: DataFrame, name: str) -> DataFrame:
    """Names but quoted ones whose unquoted form is there too."""
    quoted_ = F.col(name).startswith('"')
    bare = F.replace(F.replace(F.col(name), F.lit('"'), F.lit("")), F.lit("Candidatus "), F.lit(""))
    plain = names.select(F.col(name).alias("_p")).distinct()
    return names.filter(~quoted_).unionByName(names.filter(quoted_).join(plain, bare == F.col("_p"), "left_anti"))


def section(page: Column, mark: str) -> Column:
    """The lines between the first line that has the mark (a pattern) and the next one that opens a paragraph."""
    rest = F.regexp_extract(quoted(page), rf"(?s){mark}[^\n]*\n(.*)", 1)
    return F.split(F.regexp_replace(rest, r"(?s)(^|\n)[^\n]*<p.*", ""), "\n")


def type_genera(page: Column) -> Column:
    """Type genera of a family page."""
    return F.flatten(F.transform(section(page, "<b>Type genus:</b>"), lambda x: F.slice(F.regexp_extract_all(x, F.lit('color-genus">"?<I>([a-zA-Z]+)</I>'), 1), 1, 1)))


def type_species(page: Column) -> Column:
    """Type species of a genus page."""
    first = lambda x, i: F.regexp_extract(x, '"?<I>([a-zA-Z]+)</I> <I>([a-zA-Z]+)</I>', i)
    found = F.transform(section(page, "<b>Type species:</b>"), lambda x: F.concat_ws(" ", first(x, 1), first(x, 2)))
    return F.filter(found, lambda x: x != " ")


def _name_line(page: Column) -> Column:
    return F.get(F.filter(lines(page), lambda x: x.contains(NAME)), F.lit(0))


def _first_of(line: Column, *patterns: str) -> Column:
    return F.coalesce(*(F.when(line.rlike(p), F.regexp_extract(line, p, 1)) for p in patterns))


def authority(page: Column, name: Column) -> Column:
    """What follows the name in its line, and the proposal, joined by a comma."""
    text = strip_tags(_name_line(page))
    at = F.instr(text, name)
    after = F.when((at > 0) & (name != ""), F.trim(F.regexp_replace(F.substring(text, at + F.length(name), F.length(text)), '[\\]"]', "")))
    proposal = F.get(F.filter(lines(page), lambda x: x.contains(PROPOSAL)), F.lit(0))
    proposed = F.regexp_extract(F.coalesce(proposal, F.lit("")), "<b>Proposed as:</b>(.*)</p>", 1)
    return F.trim(F.concat_ws(",", F.nullif(after, F.lit("")), F.nullif(proposed, F.lit(""))))


def genus_page(page: Column) -> Column:
    """name, authority, type_species of a genus page; three forms of the name are tried in order."""
    line = _name_line(page)
    plain = F.when(F.regexp_extract(line, r'<b>Name:</b> "?\s?<I>([a-zA-Z]+)</I>', 1) != "Candidatus", _first_of(line, r'<b>Name:</b> "?\s?<I>([a-zA-Z]+)</I>'))
    name = F.coalesce(plain, _first_of(line, r"<b>Name:</b>\s?\[([a-zA-Z]+)", r'<b>Name:</b> "?<I>Candidatus</I> ([a-zA-Z]+)'), F.lit(""))
    return F.struct(name.alias("name"), authority(page, name).alias("authority"), type_species(page).alias("type_species"))


def strains(page: Column) -> Column:
    """Type strains of a page, co-identical ones in the page's order: without the word strain, both names of renamed collections."""
    cells = F.flatten(F.transform(F.filter(section(page, "<b>Type strains?:</b>"), lambda x: F.trim(x) != ""), lambda x: F.split(strip_tags(x), ";")))
    bare = F.transform(cells, lambda x: F.trim(F.regexp_replace(x, "[sS]train", "")))
    return F.filter(ids.renamed_collections(F.filter(bare, lambda x: ~x.isin(*NO_STRAIN))), lambda x: ids.is_strain_id(ids.canonical_strain(x)))


def species_page(page: Column) -> Column:
    """name, authority, strains (joined by ``=``) of a species page."""
    line = _name_line(page)
    candidatus = line.contains('"<I>Candidatus</I>')
    two = lambda pattern: F.when(line.rlike(pattern), F.concat_ws(" ", F.regexp_extract(line, pattern, 1), F.regexp_extract(line, pattern, 2)))
    name = F.coalesce(F.when(candidatus, two(r'<b>Name:</b> "?<I>Candidatus</I> ([a-zA-Z]+) ([a-zA-Z]+)"')).otherwise(two(r'<b>Name:</b> "?<I>([a-zA-Z]+)</I> <I>([a-zA-Z]+)</I>')), F.lit(""))
    return F.struct(name.alias("name"), authority(page, name).alias("authority"), F.concat_ws("=", strains(page)).alias("strains"))


def subspecies_page(file: Column, page: Column) -> Column:
    """name, authority, strains of a subspecies page, whose name its file gives; null for the subspecies of the species' own epithet."""
    parts = F.split(file, "-")
    word = lambda i: F.get(parts, F.lit(i))
    name = F.concat_ws(" ", F.initcap(word(0)), word(1), F.lit("subsp."), word(2))
    return F.when(word(1) != word(2), F.struct(name.alias("name"), authority(page, name).alias("authority"), F.concat_ws("=", strains(page)).alias("strains")))


def nomenclature(families: DataFrame, genera: DataFrame, species: DataFrame, subspecies: DataFrame) -> DataFrame:
    """kind, is_type, name, authority, strains over tables of pages (file, page)."""
    types = families.select(F.explode(type_genera(F.col("page"))).alias("name")).distinct().withColumn("is_type", F.lit(True))
    g = genera.select(genus_page(F.col("page")).alias("x")).select("x.*")
    of_genus = g.select(F.explode("type_species").alias("name")).distinct().withColumn("is_type", F.lit(True))
    flag = lambda rows, known: rows.join(known, "name", "left").withColumn("is_type", F.coalesce("is_type", F.lit(False)))
    s = species.select(species_page(F.col("page")).alias("x")).select("x.*").filter("name like '% %'")
    sub = subspecies.select(subspecies_page(F.col("file"), F.col("page")).alias("x")).filter("x is not null").select("x.*", F.lit(False).alias("is_type"))
    out = flag(g.select("name", "authority", F.lit("").alias("strains")), types).select(F.lit("genus").alias("kind"), "is_type", "name", "authority", "strains")
    for rows in (flag(s, of_genus), sub):
        out = out.unionByName(rows.select(F.lit("species").alias("kind"), "is_type", "name", "authority", "strains"))
    return out


def table_cells(pages: DataFrame, key: str, page: str) -> DataFrame:
    """key, row, column, cell of the rows of all HTML tables of a page."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(page, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("row", "_r"))
    return rows.select(key, "row", F.posexplode(F.regexp_extract_all("_r", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1)).alias("column", "cell")).withColumn("cell", strip_tags(F.col("cell")))
