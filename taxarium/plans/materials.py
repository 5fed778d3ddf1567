"""Registered queries over strains, type material, nomenclature pages and texts, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells, ids, names
from ..operators import curation, strains
from ..sources import api, pages
from .registry import _t, query
from .taxa import pick, sql_list, sql_pick


def _texts(values):
    """A query of one function over fixed texts: every supplier takes one of them."""
    return lambda spark, d, *columns: _t(spark, d, "part").select("p_partkey", pick(values, F.col("p_partkey")).alias("x")).select("p_partkey", *columns)


def _sql_texts(values, columns: str, more: str = "") -> str:
    return f"WITH t AS (SELECT p_partkey, {sql_pick(values, 'p_partkey')} AS x FROM part){more} SELECT p_partkey, {columns} FROM t"


_STRAINS = ("ATCC 1 (now DSM 1) 77", "ABC (now XYZ) 12", "ABC (formerly XYZ) 9", "K-12", "DSM 30083", "JCM 1 (type)", "type strain: CIP 1", "DSM 1 (=JCM 2) x", "A/B;C,D", "K 1-2", "none", "T", "strain K T", "AT-CC 1 2")


@query(_sql_texts(_STRAINS, r"""array_to_string(list_concat(CASE WHEN contains(y, '/') THEN regexp_split_to_array(y, '[;,=]') ELSE [] END, flatten(list_transform(string_split(y, '/'), lambda p: regexp_split_to_array(p, '[;,=]')))), '|') AS parts""",
                  ", u AS (SELECT p_partkey, replace(x, 'type strain:', '') AS b FROM t), v AS (SELECT p_partkey, CASE WHEN contains(b, '(=') AND contains(b, ')') THEN replace(replace(b, '(=', '='), ')', '=') ELSE b END AS y FROM u)").replace("FROM t", "FROM v") .replace("AS b FROM v", "AS b FROM t"))
def split_strain_cells(spark, d):
    return _texts(_STRAINS)(spark, d, F.concat_ws("|", ids.split_strains(F.col("x"))).alias("parts"))


_NOW, _FORMERLY = r"(\w+) \(now (\w+)\) (\d+)", r"(\w+) \(formerly (\w+)\) (\d+)"


@query(_sql_texts(_STRAINS, f"""CASE WHEN NOT contains(x, '(') THEN trim(x) WHEN regexp_matches(x, '{_NOW}') THEN regexp_extract(x, '{_NOW}', 1) || ' ' || regexp_extract(x, '{_NOW}', 3) || '|' || regexp_extract(x, '{_NOW}', 2) || ' ' || regexp_extract(x, '{_NOW}', 3)
 WHEN regexp_matches(x, '{_FORMERLY}') THEN regexp_extract(x, '{_FORMERLY}', 1) || ' ' || regexp_extract(x, '{_FORMERLY}', 3) || '|' || regexp_extract(x, '{_FORMERLY}', 2) || ' ' || regexp_extract(x, '{_FORMERLY}', 3) ELSE trim(regexp_replace(x, '\\([^)]*\\)', '', 'g')) END AS names,
 length(x) - length(replace(x, ' ', '')) = 2 AND len(list_filter(string_split(x, ' '), lambda w: regexp_matches(w, '^[0-9]+$'))) > 0 AND len(list_filter(string_split(x, ' '), lambda w: regexp_matches(w, '^[A-Z]+$'))) > 0 AND len(list_filter(string_split(x, ' '), lambda w: NOT regexp_matches(w, '^([0-9]+|[A-Z]+)$'))) = 0 AS three_terms"""))
def renamed_collections(spark, d):
    return _texts(_STRAINS)(spark, d, F.concat_ws("|", ids.renamed_collections(F.array("x"))).alias("names"), ids.three_term_strain(F.col("x")).alias("three_terms"))


@query(_sql_texts(_STRAINS[3:5] + _STRAINS[9:10] + _STRAINS[13:], """array_to_string(list_sort(list_distinct([x, replace(x, ' ', ''), replace(x, '-', ''), replace(x, '-', ' '), replace(replace(x, '-', ''), ' ', ''), replace(replace(x, ' ', ''), '-', ' ')])), '|') AS variants"""))
def strain_variants(spark, d):
    return _texts(_STRAINS[3:5] + _STRAINS[9:10] + _STRAINS[13:])(spark, d, F.concat_ws("|", ids.strain_variants(F.array("x"))).alias("variants"))


_RAW_NAMES = ("Aa bb", "Candidatus Aa bb", "Aa bb subsp. bb", "Aa bb subsp. cc", "Aa bb subsp. cc str. 1", "Aa bb subsp. bb str. 1", "[Aa] bb", "Aa bb serotype 3", "Aa bb ser. 4", "Aa", "\"Aa bb\" K-12", "Aa bb cc dd")
_STANDARD = ("Aa bb|Aa bb subsp. bb", "Aa bb|Aa bb subsp. bb", "Aa bb|Aa bb subsp. bb", "Aa bb subsp. cc", "Aa bb subsp. cc", "Aa bb|Aa bb subsp. bb", "Aa bb|Aa bb subsp. bb", "Aa bb|Aa bb subsp. bb", "Aa bb|Aa bb subsp. bb", "", "Aa bb|Aa bb subsp. bb", "Aa bb|Aa bb subsp. bb")
_TYPES = ("type strain of species",) * 3 + ("type strain of subspecies",) * 2 + ("type strain of species",) * 7


@query(f"SELECT p_partkey, {sql_pick(_STANDARD, 'p_partkey')} AS names, {sql_pick(_TYPES, 'p_partkey')} AS status FROM part")
def standard_names(spark, d):
    """The right names and status of each raw name are written out in the SQL."""
    return _texts(_RAW_NAMES)(spark, d, F.concat_ws("|", names.standard_names(F.col("x"))).alias("names"), names.type_rank(F.col("x")).alias("status"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'Aa bb subsp. ' || c_mktsegment WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment || ' bb' END AS name FROM customer""")
def species_of_lineages(spark, d):
    k = F.col("c_custkey")
    line = F.concat_ws("; ", F.lit("d__A"), F.when(k % 3 != 0, F.concat(F.lit("s__["), "c_mktsegment", F.lit("] bb"))).otherwise("s__"), F.when(k % 5 == 0, F.concat(F.lit("sb__Aa bb pv. "), "c_mktsegment")))
    return _t(spark, d, "customer").select("c_custkey", names.species_of_lineage(line).alias("name"))


_EPITHETS = ("albus", "alba", "album", "acris", "acer", "acre", "brevis", "breve", "nigra", "terrae")
_SAME = "(a = b OR " + " OR ".join(f"(a LIKE '%{x}' AND substr(a, 1, length(a) - {len(x)}) || '{y}' = b)" for x, y in (p for e in names.ENDINGS for p in (e, e[::-1]))) + ")"


@query(f"""WITH t AS (SELECT p_partkey, {sql_pick(_EPITHETS, 'p_partkey')} AS a, {sql_pick(_EPITHETS, 'p_size')} AS b FROM part) SELECT p_partkey, NOT {_SAME} AS heterotypic,
 CASE WHEN p_partkey % 2 = 0 THEN 'synonyms' WHEN p_partkey % 3 = 0 THEN 'equivalent name' WHEN p_partkey % 5 = 0 THEN 'misspelling name' END AS kind FROM t""")
def heterotypic_names(spark, d):
    k = F.col("p_partkey")
    name, official = (F.concat(F.lit("Aa "), pick(_EPITHETS, c)) for c in (k, F.col("p_size")))
    lists = [F.array(F.when(k % n == 0, name)) for n in (2, 3, 5)]
    return _t(spark, d, "part").select("p_partkey", names.is_heterotypic(name, F.array(official)).alias("heterotypic"), names.name_kind(name, *lists).alias("kind"))


_NOTES = ("derived from single cell", "derived from metagenome; x", "derived from metagenome; derived from single cell", "derived from environmental source", "derived from surveillance project", "partial", "")
_LINES = ("  /metagenome_source=\"x\"", "derived from Human gut METAGENOME", "derived from a metagenome", "the metagenome of a single cell", "a single cell", "/environmental_sample", "derived from environmental source", "x")


@query(f"""WITH t AS (SELECT p_partkey, {sql_pick(_NOTES, 'p_partkey')} AS n, {sql_pick(_LINES, 'p_partkey')} AS l FROM part) SELECT p_partkey,
 CASE WHEN contains(n, 'derived from single cell') THEN 'SAG' WHEN contains(n, 'derived from metagenome') THEN 'MAG' WHEN contains(n, 'derived from environmental source') THEN 'ENV' END AS by_note,
 CASE WHEN contains(l, 'metagenome') THEN CASE WHEN contains(l, '/metagenome_source') OR regexp_matches(l, '(?i)derived from(\\w|\\s)*metagenome') THEN 'MAG' END WHEN contains(l, 'single cell') THEN 'SAG'
  WHEN contains(l, '/environmental_sample') OR contains(l, 'derived from environmental source') THEN 'ENV' END AS by_line FROM t""".replace("\\\\", "\\"))
def genome_categories(spark, d):
    t = _t(spark, d, "part")
    return t.select("p_partkey", names.assembly_category(pick(_NOTES, F.col("p_partkey"))).alias("by_note"), names.line_category(pick(_LINES, F.col("p_partkey"))).alias("by_line"))


@query(f"""WITH t AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'U_' ELSE 'G' END || p_partkey AS gid, p_partkey % 3 = 0 AS noted, {sql_pick(_NOTES, 'p_partkey')} AS n, {sql_pick(_LINES, 'p_partkey')} AS l, {sql_pick(_LINES, 'p_size')} AS k FROM part),
a AS (SELECT *, CASE WHEN NOT noted THEN NULL WHEN contains(n, 'single cell') THEN 'SAG' WHEN contains(n, 'metagenome') THEN 'MAG' WHEN contains(n, 'environmental') THEN 'ENV' END AS by_note FROM t),
b AS (SELECT gid, x, min(CASE x WHEN 0 THEN 0 WHEN 2 THEN 0 WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 2 END) OVER (PARTITION BY gid) AS r FROM (SELECT gid, list_position({sql_list(_LINES)}, unnest([l, k])) - 1 AS x FROM a)),
c AS (SELECT DISTINCT gid, r FROM b), d AS (SELECT a.gid, CASE WHEN starts_with(a.gid, 'U_') THEN 'MAG' ELSE coalesce(by_note, ['MAG', 'SAG', 'ENV'][CAST(r + 1 AS INT)]) END AS kind, by_note FROM a JOIN c USING (gid))
SELECT gid, CASE kind WHEN 'MAG' THEN 'derived from metagenome' WHEN 'SAG' THEN 'derived from single cell' ELSE 'derived from environmental sample' END AS category,
 CASE WHEN starts_with(gid, 'U_') THEN 'user genome' WHEN by_note IS NOT NULL THEN 'assembly report' ELSE 'GBFF file' END AS source FROM d WHERE kind IS NOT NULL""")
def category_ladder(spark, d):
    k = F.col("p_partkey")
    t = _t(spark, d, "part").withColumn("gid", F.concat(F.when(k % 10 == 0, "U_").otherwise("G"), k.cast("string")))
    notes = t.filter("p_partkey % 3 = 0").select("gid", pick(_NOTES, k).alias("note"), F.lit(1).alias("ord"))
    return curation.genome_categories(t, notes, t.select("gid", F.explode(F.array(pick(_LINES, k), pick(_LINES, F.col("p_size")))).alias("line")))


_MESSY = ("<b>Aa</b> <i>bb</i> ", "Aa (see Smith (1999) bb", "M&uuml;ller &amp; Söhne", "Ångström é ñ &lt;x&gt;", "plain", "/a/b/GCF_000001.1_ASM1v1/", "/a/b/file.tar.gz", "noext", "2020-1-5", "2020-13-05", "say \"x\"")
_PLAIN = ("<b>Aa</b> <i>bb</i> ", "Aa (see Smith (1999) bb", "M&uuml;ller & Sohne", "Angstrom e n <x>", "plain", "/a/b/GCF_000001.1_ASM1v1/", "/a/b/file.tar.gz", "noext", "2020-1-5", "2020-13-05", "say \"x\"")


@query(f"""WITH t AS (SELECT p_partkey, {sql_pick(_MESSY, 'p_partkey')} AS x, {sql_pick(_PLAIN, 'p_partkey')} AS without_accents FROM part), u AS (SELECT *, regexp_extract(regexp_replace(x, '/+$', ''), '([^/]*)$', 1) AS base FROM t)
SELECT p_partkey, trim(regexp_replace(x, '<.*?>', '', 'g')) AS without_tags, regexp_replace(x, '\\(see[^)]+\\)', '', 'g') AS without_see, without_accents, base, regexp_extract(base, '^.+(\\.[^.]*)$', 1) AS extension, CASE WHEN length(base) - length(replace(base, '_', '')) < 2 THEN base ELSE regexp_extract(base, '^([^_]*_[^_]*)', 1) END AS accession,
 regexp_matches(x, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') AND try_strptime(x, '%Y-%m-%d') IS NOT NULL AS is_date, replace(x, '"', '~') AS authority FROM u""".replace("\\\\", "\\"))
def cleaned_texts(spark, d):
    x = F.col("x")
    return _texts(_MESSY)(
        spark, d, names.strip_tags(x).alias("without_tags"), names.without_see(x).alias("without_see"), names.without_accents(x).alias("without_accents"), ids.base_name(x).alias("base"), ids.extension(x).alias("extension"),
        ids.accession_of_path(x).alias("accession"), cells.is_date(x).alias("is_date"), F.translate(x, '"', "~").alias("authority"),
    )


@query("SELECT doc_id, reverse(translate(substr(replace(upper(replace(text, 'ß', 'SS')), 'ẞ', 'SS'), 3), 'ACGT', 'TGCA')) AS piece FROM documents")
def revcomp_subseq(spark, d):
    text = F.upper(F.replace("text", F.lit("ß"), F.lit("SS")))
    return _t(spark, d, "documents").select("doc_id", names.reverse_complement(F.substring(F.replace(text, F.lit("ẞ"), F.lit("SS")), F.lit(3), F.length(text))).alias("piece"))


_SETS = """g AS (SELECT p_partkey AS gid, p_size AS taxid, list_sort(list_distinct(['A' || p_size, 'B' || p_partkey % 7])) AS x FROM part), m AS (SELECT p_size AS taxid, list_sort(list_distinct(list('B' || p_partkey % 3 || ''))) AS s FROM part GROUP BY 1),
n AS (SELECT taxid, taxid % 10 AS sp FROM m)"""


@query(f"""WITH {_SETS}, a AS (SELECT g.gid, g.taxid, x, m.s AS m, o.s AS s FROM g LEFT JOIN m USING (taxid) LEFT JOIN n USING (taxid) LEFT JOIN m o ON o.taxid = n.sp), b AS (SELECT *, CASE WHEN list_has_any(x, m) THEN list_sort(list_distinct(list_concat(x, m))) ELSE x END AS y FROM a),
c AS (SELECT *, CASE WHEN list_has_any(y, s) THEN list_sort(list_distinct(list_concat(y, s))) ELSE y END AS z FROM b)
SELECT gid, taxid, array_to_string(x, '=') AS ids, array_to_string(z, '=') AS expanded_ids, len(x) <> len(z) AS expanded, coalesce(list_has_any(x, m), false) AS coidentical, CASE WHEN list_has_any(x, m) THEN array_to_string(list_sort(list_intersect(x, m)), '=') ELSE '' END AS coidentical_intersection,
 CASE WHEN list_has_any(x, m) THEN array_to_string(y, '=') ELSE '' END AS coidentical_union, coalesce(list_has_any(y, s), false) AS of_species, CASE WHEN list_has_any(y, s) THEN array_to_string(list_sort(list_intersect(y, s)), '=') ELSE '' END AS species_intersection,
 CASE WHEN list_has_any(y, s) THEN array_to_string(z, '=') ELSE '' END AS species_union, false AS same_collection FROM c""")
def strain_expansion(spark, d):
    part, text = _t(spark, d, "part"), lambda p, c: F.concat(F.lit(p), c.cast("string"))
    genomes = part.select(F.col("p_partkey").alias("gid"), F.col("p_size").alias("taxid"), F.array_distinct(F.array(text("A", F.col("p_size")), text("B", F.col("p_partkey") % 7))).alias("ids"))
    material = part.groupBy(F.col("p_size").alias("taxid")).agg(F.array_sort(F.collect_set(text("B", F.col("p_partkey") % 3))).alias("ids"))
    out = strains.expand(genomes, material, material.select("taxid", (F.col("taxid") % 10).alias("species_taxid")))
    return out.withColumn("ids", F.concat_ws("=", "ids")).withColumn("expanded_ids", F.concat_ws("=", "expanded_ids"))


@query("""WITH t AS (SELECT p_brand, regexp_replace(['DSM ', 'JCM ', 'K'][CAST(p_partkey % 3 + 1 AS INT)] || p_partkey, '[0-9]', '', 'g') AS c FROM part), n AS (SELECT p_brand, c, count(*) AS n FROM t GROUP BY ALL)
SELECT p_brand, c AS name, n FROM n QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, c) = 1""")
def commonest_collections(spark, d):
    each = F.concat(pick(("DSM ", "JCM ", "K"), F.col("p_partkey")), F.col("p_partkey").cast("string"))
    lists = _t(spark, d, "part").groupBy("p_brand").agg(F.collect_list(each).alias("s"))
    return lists.select("p_brand", strains.commonest_collection(F.col("s")).alias("x")).select("p_brand", "x.name", F.col("x.n").cast("long").alias("n"))


_MATCH = f"""cand AS (SELECT p_partkey AS gid, 'Aa ' || {sql_pick(_EPITHETS, 'p_partkey')} AS name, p_partkey % 3 <> 0 AS official, ['DSM' || p_size, 'X' || p_partkey] AS x, 'Aa ' || {sql_pick(_EPITHETS, 'p_partkey')} || CASE WHEN p_partkey % 5 = 0 THEN ' ATCC 7' ELSE '' END AS raw FROM part),
repo AS (SELECT 'Aa ' || e AS name, ['DSM' || i, 'ATCC7', 'JCM' || i] AS s, ['X' || i] AS n FROM (SELECT unnest({sql_list(_EPITHETS)}) AS e, unnest(range(1, 11)) AS i) WHERE i <> 4),
hit AS (SELECT cand.*, list_filter(s, lambda i: list_contains(x, i) OR (i = 'ATCC7' AND contains(raw, ' ATCC 7')))[1] AS t, list_filter(n, lambda i: list_contains(x, i))[1] AS neo FROM cand JOIN repo USING (name))"""


@query(f"""WITH {_MATCH} SELECT gid, name, coalesce(t, neo) AS matched_id, CASE WHEN official THEN 'official_name' ELSE 'synonyms' END AS match_type,
 CASE WHEN NOT official THEN 'type strain of heterotypic synonym' WHEN t IS NULL THEN 'type strain of neotype' ELSE 'type strain of species' END AS designation, CAST(1900 + length(name) AS INT) AS priority_year FROM hit WHERE t IS NOT NULL OR (neo IS NOT NULL AND official)""")
def repository_matches(spark, d):
    k = F.col("p_partkey")
    name = F.concat(F.lit("Aa "), pick(_EPITHETS, k))
    raw = F.concat(name, F.when(k % 5 == 0, " ATCC 7").otherwise(""))
    own = F.array(F.concat(F.lit("DSM"), F.col("p_size").cast("string")), F.concat(F.lit("X"), k.cast("string")))
    cand = _t(spark, d, "part").select(
        k.alias("gid"), name.alias("name"), (k % 3 != 0).alias("official"), F.array(raw).alias("raw_names"), own.alias("ids"), F.lit("Aa other").alias("species_name"), F.array(F.lit("Aa other")).alias("officials"), F.array(name).alias("synonyms"),
        F.array().cast("array<string>").alias("equivalents"), F.array().cast("array<string>").alias("misspellings"),
    )
    rows = [(f"Aa {e}", [f"DSM{i}", "ATCC7", f"JCM{i}"], [f"X{i}"]) for i, e in enumerate(_EPITHETS, 1) if i != 4]
    repo = spark.createDataFrame(rows, "name string, strains array<string>, neotypes array<string>")
    return strains.repository_matches(cand, repo, repo.select("name", (1900 + F.length("name")).alias("year")))


_GENERA = "t AS (SELECT 's__Sp' || p_partkey % 300 AS species, CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN 'H' || p_partkey % 300 ELSE 'G' || p_partkey % 100 END AS genus FROM part)"


@query(f"WITH {_GENERA} SELECT genus, substr(min(species), 4) AS species FROM t WHERE genus <> '' GROUP BY 1 HAVING count(DISTINCT species) = 1")
def genus_types(spark, d):
    k = F.col("p_partkey")
    t = _t(spark, d, "part").select(F.concat(F.lit("s__Sp"), (k % 300).cast("string")).alias("species"), F.when(k % 4 == 0, "").when(k % 5 == 0, F.concat(F.lit("H"), (k % 300).cast("string"))).otherwise(F.concat(F.lit("G"), (k % 100).cast("string"))).alias("genus"))
    return strains.genus_types(t)


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NOT NULL THEN a.v ELSE b.v END AS v FROM (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 2 = 0) a FULL JOIN (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_custkey % 3 = 0) b ON a.k = b.k")
def preferred_source(spark, d):
    c = _t(spark, d, "customer")
    one, two = c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v")), c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return strains.prefer(one, two, "k", "v")


@query("SELECT 'n' || c_custkey AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS strains, CASE WHEN c_custkey % 3 = 0 THEN 'neo' ELSE '' END AS neotypes FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def merged_strains(spark, d):
    c = _t(spark, d, "customer").withColumn("name", F.concat(F.lit("n"), F.col("c_custkey").cast("string")))
    listed, scraped = c.filter("c_custkey % 2 = 0").select("name", F.array("c_mktsegment").alias("strains")), c.filter("c_custkey % 3 = 0").select("name", F.array("c_name").alias("strains"), F.array(F.lit("neo")).alias("neotypes"))
    return strains.merged_strains(listed, scraped).withColumn("strains", F.concat_ws("=", "strains")).withColumn("neotypes", F.concat_ws("=", "neotypes"))


_P = strains.PRIORITY
_DESIGNATED = f"""g AS (SELECT p_partkey AS gid, 'Aa s' || p_size || CASE WHEN p_partkey % 6 = 0 THEN ' subsp. x' ELSE '' END AS species_name, CASE WHEN p_partkey % 2 = 0 THEN {sql_pick(_P, 'p_size')} END AS a, CASE WHEN p_partkey % 3 = 0 THEN {sql_pick(_P, 'p_partkey')} END AS b FROM part),
d AS (SELECT *, {sql_list(_P)}[least(list_position({sql_list(_P)}, coalesce(a, '{_P[-1]}')), list_position({sql_list(_P)}, coalesce(b, '{_P[-1]}')))] AS designation FROM g)"""


def _designated(spark, d):
    part, k = _t(spark, d, "part"), F.col("p_partkey")
    g = part.select(k.alias("gid"), F.concat(F.lit("Aa s"), F.col("p_size").cast("string"), F.when(k % 6 == 0, " subsp. x").otherwise("")).alias("species_name"))
    a, b = part.filter("p_partkey % 2 = 0").select(k.alias("gid"), pick(_P, F.col("p_size")).alias("designation")), part.filter("p_partkey % 3 = 0").select(k.alias("gid"), pick(_P, k).alias("designation"))
    types = spark.createDataFrame([("Aa s5",), ("Aa s10",), ("Aa s20 subsp. x",)], "species string")
    return g, strains.designations(g, {"LPSN": a, "DSMZ": b}, types)


@query(f"""WITH {_DESIGNATED} SELECT gid, designation, concat_ws('; ', CASE WHEN a = designation THEN 'LPSN' END, CASE WHEN b = designation THEN 'DSMZ' END) AS sources,
 designation = '{_P[0]}' AND (species_name IN ('Aa s5', 'Aa s10', 'Aa s20 subsp. x') OR array_to_string(string_split(species_name, ' ')[1:2], ' ') IN ('Aa s5', 'Aa s10', 'Aa s20 subsp. x')) AS is_type_species FROM d""")
def type_priority(spark, d):
    return _designated(spark, d)[1]


_GIVEN = ("none", "assembly from type material", "assembly from synonym type material", "other")


@query(f"""WITH {_DESIGNATED}, s AS (SELECT *, {sql_pick(_GIVEN, 'gid')} AS given FROM d) SELECT count(*) FILTER (given = 'none' AND designation = '{_P[0]}') AS missing_there, count(*) FILTER (given = '{_GIVEN[1]}' AND designation = '{_P[-1]}') AS missing_here,
 count(*) FILTER (given = '{_GIVEN[1]}' AND designation = '{_P[0]}') AS agreed_species, count(*) FILTER (given IN ('{_GIVEN[1]}', '{_GIVEN[2]}') AND designation = '{_P[2]}' AND contains(species_name, 'subsp.')) AS agreed_subspecies FROM s""")
def type_agreement(spark, d):
    g, summary = _designated(spark, d)
    return strains.agreement(summary.join(g, "gid").withColumn("given", pick(_GIVEN, F.col("gid"))))


_YEARS = "y AS (SELECT 'Aa s' || p_size || CASE WHEN p_partkey % 3 = 0 THEN ' subsp. s' || p_size WHEN p_partkey % 3 = 1 THEN ' subsp. x' ELSE '' END AS name, CAST(min(1800 + p_partkey % 200) AS INT) AS year FROM part GROUP BY 1)"
_HARMONIC = "h AS (SELECT name, year, CASE WHEN NOT contains(name, 'subsp.') THEN name WHEN split_part(name, ' ', 2) = split_part(name, ' ', 4) THEN array_to_string(string_split(name, ' ')[1:2], ' ') END AS s FROM y), w AS (SELECT name, CASE WHEN s IS NULL THEN year ELSE min(year) OVER (PARTITION BY s) END AS year FROM h)"


def _years(spark, d):
    k, s = F.col("p_partkey"), F.concat(F.lit("s"), F.col("p_size").cast("string"))
    name = F.concat(F.lit("Aa "), s, F.when(k % 3 == 0, F.concat(F.lit(" subsp. "), s)).when(k % 3 == 1, " subsp. x").otherwise(""))
    return _t(spark, d, "part").groupBy(name.alias("name")).agg(F.min(1800 + k % 200).cast("int").alias("year"))


@query(f"WITH {_YEARS}, {_HARMONIC} SELECT * FROM w")
def harmonised_years(spark, d):
    return strains.harmonised_years(_years(spark, d))


@query(f"WITH {_YEARS}, {_HARMONIC}, l AS (SELECT DISTINCT 'Aa s' || p_size AS name, CAST(1700 + p_size AS INT) AS year FROM part WHERE p_size % 2 = 0) SELECT name, year FROM l UNION ALL SELECT name, year FROM w WHERE name NOT IN (SELECT name FROM l)")
def date_table(spark, d):
    listed = _t(spark, d, "part").filter("p_size % 2 = 0").select(F.concat(F.lit("Aa s"), F.col("p_size").cast("string")).alias("name"), (1700 + F.col("p_size")).cast("int").alias("year")).distinct()
    return strains.date_table(_years(spark, d), listed)


_AUTHORS = ("Smith 1999", "(ex Hafkine 1890) Gromov and Ossipov 1981", "Jones 1990 emend. Smith 2001", "Nobody", "Far 2999 and 2001")
_AUTHOR_YEARS = (1999, 1981, 1990, None, 2001)


@query(f"""WITH t AS (SELECT *, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'sp' || p_size END AS sp, CASE WHEN p_partkey % 3 = 0 THEN 'su' ELSE '' END AS su FROM part)
SELECT CASE WHEN su <> '' THEN p_brand || ' ' || sp || ' subsp. ' || su ELSE p_brand || ' ' || sp END AS taxon, p_partkey % 4 = 0 AS illegitimate, {str([y if y else 'NULL' for y in _AUTHOR_YEARS]).replace("'", "")}[CAST(p_partkey % 5 + 1 AS INT)] AS year, 'DSM' || p_partkey AS strains FROM t WHERE sp <> '' OR su <> ''""")
def nomenclature_dump(spark, d):
    k = F.col("p_partkey")
    rows = _t(spark, d, "part").select(
        F.concat(F.lit('"'), "p_brand", F.lit('" ')).alias("genus_name"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("sp"), F.col("p_size").cast("string"))).alias("sp_epithet"), F.when(k % 3 == 0, "su").otherwise("").alias("subsp_epithet"),
        F.when(k % 4 == 0, "correct name; x, illegitimate name").otherwise("correct name").alias("status"), pick(_AUTHORS, k).alias("authors"), F.concat(F.lit("strain DSM "), k.cast("string"), F.lit("; none")).alias("nomenclatural_type"),
    )
    return strains.nomenclature(rows).withColumn("strains", F.concat_ws("=", "strains"))


_MARK = f"<p id='x'><a href='/{pages.NAME}'>?</a> <b>Name:</b> "


@query("""SELECT 'genus' AS kind, n_nationkey % 2 = 0 AS is_type, 'G' || translate(lower(n_name), '_0123456789 ', 'xabcdefghij') AS name, 'Auth ' || n_nationkey || ',Prop' AS authority, '' AS strains FROM nation
UNION ALL SELECT 'species', true, 'G' || translate(lower(n_name), '_0123456789 ', 'xabcdefghij') || ' alba', 'Aut', 'DSM ' || n_nationkey || '=JCM 1=ATCC 5=CIP 5' FROM nation
UNION ALL SELECT 'species', false, 'G' || translate(lower(n_name), '_0123456789 ', 'xabcdefghij') || ' alba subsp. minor', 'Sub', 'K12' FROM nation""")
def nomenclature_pages(spark, d):
    n, key = _t(spark, d, "nation"), F.col("n_nationkey").cast("string")
    g = F.concat(F.lit("G"), F.translate(F.lower("n_name"), "_0123456789 ", "xabcdefghij"))
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    family = n.filter("n_nationkey % 2 = 0").select(text("<b>Type genus:</b>\n<a class='color-genus'><I>", g, "</I></a>\n<p>\n<a class='color-genus'><I>Other</I>").alias("page"))
    genus = n.select(text(_MARK, "<I>", g, "</I> Auth ", key, "</p>\n<a href='", pages.PROPOSAL, "'></a><b>Proposed as:</b>Prop</p>\n<b>Type species:</b>\n<I>", g, "</I> <I>alba</I>\n<p>").alias("page"))
    species = n.select(text(_MARK, "<I>", g, "</I> <I>alba</I> Aut</p>\n<b>Type strain:</b>\n<i>strain DSM ", key, "; JCM 1; ATCC (now CIP) 5; no culture isolated</i>\n<p>end").alias("page"))
    sub = n.select(F.explode(F.array(text(g, "-alba-alba"), text(g, "-alba-minor"))).alias("file"), g.alias("g"))
    sub = sub.select("file", text(_MARK, F.initcap("g"), " alba subsp. minor Sub</p>\n<b>Type strains:</b>\nK12\n<p>").alias("page"))
    return pages.nomenclature(family, genus, species, sub)


@query("""SELECT n_nationkey, n_name AS name, 'https://x.org/family/' || n_nationkey AS url FROM nation WHERE n_nationkey % 4 <> 0""")
def index_links(spark, d):
    key = F.col("n_nationkey").cast("string")
    line = F.concat(F.lit("<ul>\n<li><a href='/family/"), key, F.lit("' class='last-child color-family'><I>"), "n_name", F.lit("</I></a>\n<a href='/genus/1' class='last-child color-genus'>x</a>"))
    p = _t(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 4 == 0, "<p>").otherwise(line).alias("page"))
    return pages.links(p, "n_nationkey", "page", "family", "last-child color-family", "https://x.org")


@query("SELECT n_name AS name FROM nation UNION ALL SELECT '\"Candidatus New ' || n_nationkey || '\"' FROM nation WHERE n_nationkey % 3 = 0")
def unquoted_names(spark, d):
    n = _t(spark, d, "nation")
    new = n.select(F.concat(F.lit('"Candidatus New '), F.col("n_nationkey").cast("string"), F.lit('"')).alias("name"), "n_nationkey").filter("n_nationkey % 3 = 0").select("name")
    return pages.without_quoted_twins(n.select(F.col("n_name").alias("name")).union(n.select(F.concat(F.lit('"'), "n_name", F.lit('"')))).union(new), "name")


@query("SELECT n_nationkey, CAST(r AS INT) AS row, CAST(c AS INT) AS \"column\", CASE WHEN r = 0 THEN 'h' || c WHEN c = 0 THEN n_name ELSE CAST(n_regionkey AS VARCHAR) END AS cell FROM nation, (SELECT unnest([0, 0, 1, 1]) AS r, unnest([0, 1, 0, 1]) AS c)")
def html_table_cells(spark, d):
    page = F.concat(F.lit("<TABLE><tr><th>h0</th><th class='x'>h1</th></tr>\n<tr><td><b>"), "n_name", F.lit("</b></td>\n<td>"), F.col("n_regionkey").cast("string"), F.lit("</td></tr></TABLE>"))
    return pages.table_cells(_t(spark, d, "nation").select("n_nationkey", page.alias("page")), "n_nationkey", "page")


def _api(spark, d):
    """Pages of ten species in JSON."""
    c, k = _t(spark, d, "customer"), F.col("c_custkey")
    one = F.struct(F.concat(F.lit("Sp "), k.cast("string")).alias("label"), F.concat(F.lit("Sp "), k.cast("string")).alias("species"), F.concat(F.lit("Müller "), k.cast("string")).alias("authors"), F.when(k % 7 != 0, "taxon").alias("taxon"), F.when(k % 3 == 0, F.array(F.concat(F.lit("DSM-"), k.cast("string")))).alias("type_strain"))
    body = F.struct(F.lit(10).alias("count"), F.lit("?page=2").alias("next"), F.collect_list(one).alias("results"))
    return c.groupBy(F.floor(k / 10)).agg(F.to_json(body).alias("page"))


@query("SELECT 's__Sp ' || c_custkey AS label, CASE WHEN c_custkey % 11 = 0 THEN 'g__G' || c_custkey ELSE '' END AS type, CASE WHEN c_custkey % 7 <> 0 THEN 'Muller ' || c_custkey || ',taxon' ELSE '' END AS authority FROM customer")
def api_species(spark, d):
    c = _t(spark, d, "customer").filter("c_custkey % 11 = 0")
    one = F.struct(F.concat(F.lit("G"), F.col("c_custkey").cast("string")).alias("label"), F.concat(F.lit("Sp "), F.col("c_custkey").cast("string")).alias("type_species"))
    genus_pages = c.groupBy(F.floor(F.col("c_custkey") / 50)).agg(F.to_json(F.struct(F.collect_list(one).alias("results"))).alias("page"))
    return api.species(_api(spark, d), "page", api.genera(genus_pages, "page"))


@query("SELECT 'Sp ' || c_custkey AS species, 'DSM ' || c_custkey || '=DSM-' || c_custkey || '=DSM' || c_custkey AS strains FROM customer WHERE c_custkey % 3 = 0")
def api_type_strains(spark, d):
    return api.type_strains(_api(spark, d), "page")


@query()
def type_table(spark, d):
    """The composed type summary; the tests compare it with a plain version on a few genomes."""
    part, k = _t(spark, d, "part"), F.col("p_partkey")
    name = F.concat(F.lit("Aa "), pick(_EPITHETS, k))
    genomes = part.select(k.alias("gid"), F.concat(F.lit("d__A;s__"), name).alias("lineage"), F.col("p_size").alias("taxid"), F.array(F.concat(F.lit("DSM"), (k % 12).cast("string"))).alias("ids"), pick(_GIVEN, k).alias("given"))
    classes = part.select(F.col("p_size").alias("taxid"), F.lit("synonym").alias("class"), F.concat(F.lit("Bb "), pick(_EPITHETS, F.col("p_size"))).alias("name")).distinct()
    rows = [(f"{g} {e}", [f"DSM{i}"], []) for i, e in enumerate(_EPITHETS, 1) for g in ("Aa", "Bb")]
    repo = spark.createDataFrame(rows, "name string, strains array<string>, neotypes array<string>")
    types = spark.createDataFrame([("Aa", "Aa albus")], "genus string, species string")
    return strains.type_table(genomes, classes, {"LPSN": repo, "DSMZ": repo.filter("name like 'Aa%'")}, repo.select("name", F.lit(1990).alias("year")), {"LPSN": types, "DSMZ": types})
