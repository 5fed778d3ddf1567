"""Type material: strain ids, repository matches, designations, years of priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, names
from .compare import expand_if_shared

#: Designations, the best first.
PRIORITY = ("type strain of species", "type strain of neotype", "type strain of subspecies", "type strain of heterotypic synonym", "not type material")
NOT_TYPE = PRIORITY[-1]


def designation_rank(c: Column) -> Column:
    out = F.lit(len(PRIORITY))
    for i, p in reversed(list(enumerate(PRIORITY))):
        out = F.when(c == p, i).otherwise(out)
    return out


def expand(genomes: DataFrame, material: DataFrame, species: DataFrame) -> DataFrame:
    """Genomes (gid, taxid, ids) with the co-identical strain ids of their tax id and of its species (taxid, species_taxid), where they share one.

    material: taxid, ids.  The second test sees the first one's result.  Audit columns say what was
    shared and joined; same_collection is always false, as in the reports to match.
    """
    own = material.select("taxid", F.col("ids").alias("_m"))
    of_species = species.select("taxid", "species_taxid").join(material.select(F.col("taxid").alias("species_taxid"), F.col("ids").alias("_s")), "species_taxid").select("taxid", "_s")
    rows = genomes.select("gid", "taxid", F.array_sort("ids").alias("ids")).join(own, "taxid", "left").join(of_species, "taxid", "left")
    rows = rows.withColumn("_a", F.coalesce(expand_if_shared(F.col("ids"), F.col("_m")), "ids"))
    rows = rows.withColumn("expanded_ids", F.coalesce(expand_if_shared(F.col("_a"), F.col("_s")), "_a"))
    shared = lambda a, b: F.coalesce(F.arrays_overlap(a, b), F.lit(False))
    text = lambda flag, c: F.when(flag, F.concat_ws("=", F.array_sort(c))).otherwise("")
    one, two = shared("ids", "_m"), shared("_a", "_s")
    return rows.select(
        "gid", "taxid", "ids", "expanded_ids", (F.size("ids") != F.size("expanded_ids")).alias("expanded"),
        one.alias("coidentical"), text(one, F.array_intersect("ids", "_m")).alias("coidentical_intersection"), text(one, F.col("_a")).alias("coidentical_union"),
        two.alias("of_species"), text(two, F.array_intersect("_a", "_s")).alias("species_intersection"), text(two, F.col("expanded_ids")).alias("species_union"),
        F.lit(False).alias("same_collection"),
    )


def commonest_collection(ids_: Column) -> Column:
    """The commonest text that is left of the ids without their digits (ties: the least) and how often it stands."""
    bare = F.transform(ids_, lambda x: F.regexp_replace(x, "[0-9]", ""))
    counted = F.transform(F.array_distinct(bare), lambda b: F.struct((-F.size(F.filter(bare, lambda x: x == b))).alias("n"), b.alias("name")))
    least = F.array_min(counted)
    return F.struct(least["name"].alias("name"), (-least["n"]).alias("n"))


def first_match(listed: Column, own: Column, raw_names: Column) -> Column:
    """The first repository id that the genome has, or that stands in a raw name between a blank and a word's end."""
    collapsed = lambda r: F.upper(F.regexp_replace(r, r"(?U)[\W_]+", ""))
    spaced = lambda r: F.lower(F.concat(F.regexp_replace(r, r"\s", " "), F.lit(" ")))
    edge = lambda i: F.lower(F.substring(i, 1, 1)), lambda i: F.lower(F.substring(i, -1, 1))
    stands = lambda i, r: collapsed(r).contains(i) & spaced(r).contains(F.concat(F.lit(" "), edge[0](i))) & spaced(r).contains(F.concat(edge[1](i), F.lit(" ")))
    matches = lambda i: F.array_contains(own, i) | ((F.length(i) > 1) & F.exists(raw_names, lambda r: stands(i, r)))
    return F.get(F.filter(listed, matches), F.lit(0))


def repository_matches(candidates: DataFrame, repository: DataFrame, years: DataFrame | None = None) -> DataFrame:
    """gid, name, matched_id, match_type, designation, priority_year: each genome's best match in a repository (name, strains, neotypes).

    candidates: gid, name, official, raw_names, ids, species_name, officials, synonyms, equivalents,
    misspellings.  Names meet by equality, so ids are compared within a name only.  An official name
    goes before all others; two official matches of different designations are an error.  Of the
    others the best designation counts, then the least name.
    """
    joined = candidates.join(repository, "name")
    found = joined.withColumn("_t", first_match(F.col("strains"), F.col("ids"), F.col("raw_names")))
    found = found.withColumn("_n", F.when(F.col("_t").isNull(), first_match(F.col("neotypes"), F.col("ids"), F.col("raw_names"))))
    found = found.filter("_t is not null or (_n is not null and official)")
    status = names.type_rank(F.col("species_name"))
    status = F.when(~F.col("official") & names.is_heterotypic(F.col("name"), F.col("officials")), PRIORITY[3]).when(F.col("_n").isNotNull() & (status == PRIORITY[0]), PRIORITY[1]).otherwise(status)
    kind = F.when(F.col("official"), "official_name").otherwise(names.name_kind(F.col("name"), F.col("synonyms"), F.col("equivalents"), F.col("misspellings")))
    rows = found.select("gid", "name", "official", F.coalesce("_t", "_n").alias("matched_id"), kind.alias("match_type"), status.alias("designation"))
    rows = rows.join(years.select("name", F.col("year").alias("priority_year")), "name", "left") if years is not None else rows.withColumn("priority_year", F.lit(None).cast("int"))
    value = F.struct("name", "matched_id", "match_type", "designation", "priority_year")
    order = F.struct((~F.col("official")).alias("o"), F.when(F.col("official"), 0).otherwise(designation_rank(F.col("designation"))).alias("r"), F.col("name"))
    best = rows.groupBy("gid").agg(F.min_by(value, order).alias("b"), F.count_distinct(F.when(F.col("official"), F.col("designation"))).alias("_n"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("official names of different status: "), F.col("gid").cast("string")))).otherwise(F.col("b.designation"))
    return best.select("gid", "b.name", "b.matched_id", "b.match_type", checked.alias("designation"), "b.priority_year")


def genus_types(species: DataFrame) -> DataFrame:
    """genus, species: type species (species, genus; others have an empty genus) of genera that have one only."""
    rows = species.filter("genus is not null and genus <> ''").select("genus", F.regexp_replace("species", "^s__", "").alias("species"))
    one = rows.groupBy("genus").agg(F.min("species").alias("species"), F.max("species").alias("_m"))
    return one.filter("species = _m").drop("_m")


def prefer(first: DataFrame, second: DataFrame, key: str, column: str) -> DataFrame:
    """key and column of both tables; where both have the key, of the first."""
    both = first.select(key, F.col(column).alias("_a"), F.lit(True).alias("_f")).join(second.select(key, F.col(column).alias("_b")), key, "full_outer")
    return both.select(key, F.when(F.col("_f"), F.col("_a")).otherwise(F.col("_b")).alias(column))


def merged_strains(listed: DataFrame, scraped: DataFrame) -> DataFrame:
    """name, strains, neotypes: strains of the listed table (name, strains) where it has the name, else of the scraped one, which alone has neotypes."""
    none = F.array().cast("array<string>")
    both = listed.select("name", F.col("strains").alias("_l"), F.lit(True).alias("_in")).join(scraped.select("name", F.col("strains").alias("_s"), "neotypes"), "name", "full_outer")
    return both.select("name", F.when(F.col("_in"), F.col("_l")).otherwise(F.col("_s")).alias("strains"), F.coalesce("neotypes", none).alias("neotypes"))


def designations(genomes: DataFrame, sources: dict[str, DataFrame], type_species: DataFrame) -> DataFrame:
    """gid, designation, sources, is_type_species: the best designation over sources (gid, designation) in order, and which of them agree.

    genomes: gid, species_name; type_species: species.  A species or its binomial of that table
    makes a type strain of a species a type species of its genus.
    """
    rows = genomes.select("gid", "species_name")
    for name, table in sources.items():
        rows = rows.join(table.select("gid", F.col("designation").alias(f"_{name}")), "gid", "left")
    given = [F.coalesce(F.col(f"_{n}"), F.lit(NOT_TYPE)) for n in sources]
    best = F.least(*(designation_rank(g) for g in given)) if len(given) > 1 else designation_rank(given[0])
    rows = rows.withColumn("designation", F.get(F.array(*map(F.lit, PRIORITY)), best))
    agree = F.concat_ws("; ", *(F.when(F.col(f"_{n}") == F.col("designation"), n) for n in sources))
    names_ = F.array_distinct(F.array(F.col("species_name"), F.concat_ws(" ", F.slice(names.tokens(F.col("species_name")), 1, 2))))
    known = type_species.select("species").distinct()
    typical = rows.filter(F.col("designation") == PRIORITY[0]).select("gid", F.explode(names_).alias("species")).join(known, "species", "left_semi").select("gid", F.lit(True).alias("_t")).distinct()
    return rows.withColumn("sources", agree).join(typical, "gid", "left").select("gid", "designation", "sources", F.coalesce("_t", F.lit(False)).alias("is_type_species"))


def agreement(summary: DataFrame) -> DataFrame:
    """One row of counts over (given, designation, species_name): types the archive lacks, types only it has, agreed species and subspecies."""
    t = names.tokens(F.col("species_name"))
    word = lambda i: F.get(t, F.lit(i))
    other = (word(2) == "subsp.") & (word(1) != word(3))
    given, found = F.col("given"), F.col("designation")
    return summary.agg(
        F.count_if((given == "none") & (found == PRIORITY[0])).alias("missing_there"),
        F.count_if((given == "assembly from type material") & (found == NOT_TYPE)).alias("missing_here"),
        F.count_if((given == "assembly from type material") & (found == PRIORITY[0])).alias("agreed_species"),
        F.count_if(given.isin("assembly from type material", "assembly from synonym type material") & (found == PRIORITY[2]) & other).alias("agreed_subspecies"),
    )


def years(c: Column, this_year: int = 2026, fall_back: bool = False) -> Column:
    """The first year of a citation without ``emend.`` and ``ex`` years; of the whole citation if that leaves none and it may fall back."""
    bare = F.regexp_replace(c, "[()]", "")
    stripped = F.regexp_replace(F.regexp_replace(bare, r"emend\.[^\d]*\d{4}", ""), r"ex [^\d]*\d{4}", " ")
    first = lambda x: F.get(F.filter(F.transform(F.regexp_extract_all(x, F.lit("([1-3][0-9]{3})"), 1), lambda y: y.cast("int")), lambda y: y <= this_year), F.lit(0))
    return F.coalesce(first(stripped), first(bare)) if fall_back else first(stripped)


def harmonised_years(priorities: DataFrame) -> DataFrame:
    """name, year: a species and the subspecies of its epithet share the earlier year."""
    t = F.split("name", " ")
    word = lambda i: F.get(t, F.lit(i))
    species = F.when((F.size(t) == 4) & (word(1) == word(3)), F.concat_ws(" ", word(0), word(1))).when(F.size(t) == 2, F.col("name"))
    rows = priorities.select("name", "year", species.alias("_s"))
    least = rows.filter("_s is not null").groupBy("_s").agg(F.min("year").alias("_y"))
    return rows.join(least, "_s", "left").select("name", F.coalesce("_y", "year").alias("year"))


def nomenclature(rows: DataFrame) -> DataFrame:
    """taxon, illegitimate, year, strains of a nomenclature dump (genus_name, sp_epithet, subsp_epithet, status, authors, nomenclatural_type); genus rows are left out."""
    clean = lambda c: F.replace(F.trim(F.coalesce(c, F.lit(""))), F.lit('"'), F.lit(""))
    genus, species, subspecies = clean("genus_name"), clean("sp_epithet"), clean("subsp_epithet")
    taxon = F.when(subspecies != "", F.concat(genus, F.lit(" "), species, F.lit(" subsp. "), subspecies)).when(species != "", F.concat(genus, F.lit(" "), species))
    status = F.transform(F.split(clean("status"), "[;,]"), lambda s: F.trim(s))
    strains = F.filter(F.transform(F.split(F.coalesce("nomenclatural_type", F.lit("")), ";"), ids.canonical_strain), ids.is_strain_id)
    return rows.select(taxon.alias("taxon"), F.array_contains(status, "illegitimate name").alias("illegitimate"), years(F.col("authors")).alias("year"), strains.alias("strains")).filter("taxon is not null")


def date_table(scraped: DataFrame, listed: DataFrame) -> DataFrame:
    """name, year by name: of the listed table (name, year) where it has the name, else harmonised scraped ones."""
    return prefer(listed, harmonised_years(scraped), "name", "year").orderBy("name")


def rank_counts(taxids: DataFrame) -> DataFrame:
    """rank, taxids, genomes of (taxid, rank, genomes)."""
    return taxids.groupBy("rank").agg(F.count_distinct("taxid").alias("taxids"), F.sum("genomes").alias("genomes"))


def disjoint_classes(names_: DataFrame) -> DataFrame:
    """(taxid, class, name) as it is; a name that is a synonym and also the scientific or an equivalent name of a tax id is an error."""
    clash = F.count_if(F.col("class") == "synonym").over(_same_name()) > 0
    other = F.col("class").isin("scientific name", "equivalent name")
    return names_.withColumn("name", F.when(clash & other, F.raise_error(F.concat(F.lit("ambiguous name: "), "name"))).otherwise(F.col("name")))


def _same_name():
    from pyspark.sql import Window

    return Window.partitionBy("taxid", "name")


def type_table(genomes: DataFrame, name_classes: DataFrame, repositories: dict[str, DataFrame], year_table: DataFrame, type_species: dict[str, DataFrame]) -> DataFrame:
    """The type summary of genomes (gid, lineage, taxid, ids, given): designations by source, their best, year and type species.

    name_classes: taxid, class, name; repositories by source: name, strains, neotypes; type_species
    by source: genus, species, where the first source is preferred.
    """
    base = genomes.withColumn("species_name", names.species_of_lineage(F.col("lineage"))).filter("species_name is not null")
    own = base.select("gid", "species_name", "ids", F.lit(True).alias("official"), F.col("species_name").alias("raw"))
    kinds = name_classes.filter(F.col("class").isin("synonym", "equivalent name", "misspelling"))
    other = base.join(kinds, "taxid").select("gid", "species_name", "ids", F.lit(False).alias("official"), F.col("name").alias("raw"), "class")
    each = own.withColumn("class", F.lit(None).cast("string")).unionByName(other).withColumn("name", F.explode(names.standard_names(F.col("raw"))))
    grouped = each.groupBy("gid", "name", "official").agg(F.collect_set("raw").alias("raw_names"), F.first("ids").alias("ids"), F.first("species_name").alias("species_name"))
    held = lambda kind: F.collect_set(F.when(F.col("class") == kind, F.col("name")))
    by_genome = each.groupBy("gid").agg(F.collect_set(F.when(F.col("official"), F.col("name"))).alias("officials"), held("synonym").alias("synonyms"), held("equivalent name").alias("equivalents"), held("misspelling").alias("misspellings"))
    candidates = grouped.join(by_genome, "gid")
    found = {s: repository_matches(candidates, r, year_table if i == 0 else None) for i, (s, r) in enumerate(repositories.items())}
    one, *others = type_species.values()
    for o in others:
        one = one.unionByName(o.join(one.select("genus"), "genus", "left_anti"))
    summary = designations(base.select("gid", "species_name"), {s: m.select("gid", "designation") for s, m in found.items()}, one)
    first = next(iter(found.values()))
    out = base.select("gid", "species_name", "given").join(summary, "gid").join(first.select("gid", "priority_year"), "gid", "left")
    for s, m in found.items():
        out = out.join(m.select("gid", F.col("designation").alias(f"{s}_designation")), "gid", "left").withColumn(f"{s}_designation", F.coalesce(f"{s}_designation", F.lit(NOT_TYPE)))
    return out
