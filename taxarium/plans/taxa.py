"""Registered queries over names and taxonomies, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import names
from ..operators import lineage, strains, taxonomy
from .registry import _t, query

#: Labels that meet every rule of the ladder of species names.
LABELS = (
    "s__", "s__Aa bb", "s__Aa  bb", "s__'Aa' bb", "Aa bb", "s__Aa", "s__Candidatus Aa", "s__Candidatus Aa bb", "s__aa bb", "s__Aa BB", "s__Aa bacterium", "s__Aa bacteirum", "s__Aa bacteria x", "s__Aa archaea", "s__Aa archaeon",
    "s__Aa archeaon", "s__Aa archaeum", "s__Aa cyanobacterium", "s__Aa group 1", "s__Aa subdivision", "s__Aa taxon", "s__Aa cluster", "s__Aa clade", "s__Candidatus of bb", "s__Aa sp. 1", "s__Aa cf. bb", "s__Aa endosymbiont",
    "s__Aa symbiont of x", "s__Aa mycovirus", "s__Aa Oral", "s__Candidatus Aa oral", "s__Aa bb-like", "s__Aa bb endosymbiont", "s__Aa bb symbiont", "s__Aa bb mycovirus", "s__Aa bb phytoplasma", "s__Aa b1", "s__[Aa] bb",
    "s__Aa bb cc dd", "s__Candidatus Aa bb cc", "s__Aa-x bb",
)


def pick(values: tuple[str, ...], k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_pick(values: tuple[str, ...], k: str) -> str:
    return f"{sql_list(values)}[CAST({k} % {len(values)} + 1 AS INT)]"


_PHRASES = "".join(f" WHEN contains(low, '{p}') THEN '{r}'" for p, r in names.PHRASES)
_LATER = "".join(f" WHEN contains(low, '{p}') THEN '{p.strip()}'" for p in names.LATER)


def validity_sql(source: str) -> str:
    """CTEs from ``source`` (with a column label) to ``valid``: all its columns, name and reason."""
    return rf"""v1 AS (SELECT *, regexp_replace(replace(label, '''', ''), '^s__', '') AS test FROM {source}),
v2 AS (SELECT *, CASE WHEN contains(lower(test), 'candidatus') THEN 3 ELSE 2 END AS k, list_filter(regexp_split_to_array(test, '\s+'), lambda x: x <> '') AS w FROM v1),
v3 AS (SELECT *, array_to_string(w[1:k], ' ') AS name, w[least(k, len(w))] AS tail FROM v2), v4 AS (SELECT *, lower(name) AS low FROM v3),
valid AS (SELECT *, CASE WHEN label = 's__' THEN NULL WHEN NOT starts_with(replace(label, '''', ''), 's__') THEN 'missing the species prefix'
 WHEN len(string_split(test, ' ')) < k OR len(w) < k THEN 'missing the generic name' WHEN regexp_matches(name, '^\p{{Ll}}') THEN 'lower-case genus'
 WHEN regexp_matches(tail, '\p{{Lu}}') AND NOT regexp_matches(tail, '\p{{Ll}}') THEN 'upper-case epithet'{_PHRASES}
 WHEN contains(lower(tail), 'cyanobacterium') THEN 'cyanobacterium'{_LATER}
 WHEN lower(w[2]) = 'oral' OR (contains(low, 'candidatus') AND lower(w[3]) = 'oral') THEN 'oral' WHEN contains(lower(test), '-like') THEN '-like'
 WHEN list_contains(list_transform(w, lambda x: lower(x)), 'endosymbiont') THEN 'endosymbiont' WHEN list_contains(list_transform(w, lambda x: lower(x)), 'symbiont') THEN 'symbiont'
 WHEN list_contains(list_transform(w, lambda x: lower(x)), 'mycovirus') THEN 'mycovirus' WHEN list_contains(w, 'phytoplasma') THEN 'phytoplasma'
 WHEN regexp_matches(name, '[^\p{{L}} \[\]]') THEN 'character' END AS reason FROM v4)"""


@query(f"WITH s AS (SELECT p_partkey, {sql_pick(LABELS, 'p_partkey')} AS label FROM part), {validity_sql('s')} SELECT p_partkey, 's__' || name AS name, reason FROM valid")
def species_name_validity(spark, d):
    label = pick(LABELS, F.col("p_partkey"))
    return _t(spark, d, "part").select("p_partkey", names.canonical_species(label).alias("name"), names.species_validity(label).alias("reason"))


@query(f"""WITH s AS (SELECT p_partkey, {sql_pick(LABELS, 'p_partkey')} AS label FROM part), b AS (SELECT *, regexp_replace(replace(label, 's__', ''), '[Cc]andidatus', '', 'g') AS bare FROM s)
SELECT p_partkey, CASE WHEN NOT contains(lower(label), ' bacterium') AND NOT contains(lower(label), 'sp.') AND bare <> '' AND NOT regexp_matches(bare, '^\\p{{Ll}}') AND len(string_split(bare, ' ')) >= 2
 THEN 's__' || array_to_string(string_split(bare, ' ')[1:2], ' ') END AS name FROM b""".replace("\\\\", "\\"))
def extracted_species(spark, d):
    return _t(spark, d, "part").select("p_partkey", names.extract_species(pick(LABELS, F.col("p_partkey"))).alias("name"))


_DOMAINS = ("d__Bacteria", "d__Archaea", "d__Eukaryota", "d__Viruses", "d__Fungi", "k__None")
_RAW = f"""raw AS (SELECT c_custkey, concat_ws(';', 'x__cellular', {sql_pick(_DOMAINS, 'c_custkey')}, CASE WHEN c_custkey % 7 <> 0 THEN 'p__P' || c_custkey % 13 END, 'sp__Sub' || c_custkey % 3, 'c__C' || c_custkey % 17,
 CASE WHEN c_custkey % 11 = 0 THEN 'o__Some Family x' ELSE 'o__O' || c_custkey % 19 END, CASE WHEN c_custkey % 5 <> 0 THEN 'f__F' || c_custkey % 23 END, CASE WHEN c_custkey % 9 = 0 THEN 'f__Last' END,
 CASE WHEN c_custkey % 8 <> 0 THEN {sql_pick(LABELS[1:], 'c_custkey')} END, 'sb__Aa bb subsp. cc') AS line FROM customer)"""


def _raw(spark, d):
    k = F.col("c_custkey")
    each = lambda p, n: F.concat(F.lit(p), (k % n).cast("string"))
    line = F.concat_ws(
        ";", F.lit("x__cellular"), pick(_DOMAINS, k), F.when(k % 7 != 0, each("p__P", 13)), each("sp__Sub", 3), each("c__C", 17), F.when(k % 11 == 0, "o__Some Family x").otherwise(each("o__O", 19)),
        F.when(k % 5 != 0, each("f__F", 23)), F.when(k % 9 == 0, "f__Last"), F.when(k % 8 != 0, pick(LABELS[1:], k)), F.lit("sb__Aa bb subsp. cc"),
    )
    return _t(spark, d, "customer").select("c_custkey", lineage.parse(line).alias("taxa"))


def _standard_sql(order: tuple[str, ...], subranks: bool) -> str:
    sub = "" if subranks else " AND length(split_part(x, '__', 1)) <> 2"
    of = lambda p: f"list_filter(kept, lambda x: starts_with(x, '{p}'))[-1]"
    picks = ", ".join(f"{of(p)} AS r{i}" for i, p in enumerate(order[:-1]))
    last = len(order) - 1
    top = f"CASE {' '.join(f'WHEN r{i} IS NOT NULL THEN {i}' for i in range(last, -1, -1))} END AS top"
    # Below a filled rank every rank to the lowest filled one is filled, so the first filled rank decides.
    cells = " || ';' || ".join(f"coalesce(r{i}, '{p}')" for i, p in enumerate(order))
    return f"""{_RAW}, k AS (SELECT c_custkey, list_filter(string_split(line, ';'), lambda x: NOT starts_with(x, 'x__') AND NOT contains(lower(x), ' family') AND split_part(x, '__', 1) <> 'sb'{sub}) AS kept FROM raw
 WHERE list_has_any(string_split(line, ';'), {sql_list(lineage.DOMAINS)})), g AS (SELECT *, list_filter(kept, lambda x: starts_with(x, 's__'))[-1] AS label FROM k), {validity_sql('g')},
p AS (SELECT c_custkey, {picks}, CASE WHEN reason IS NULL AND label IS NOT NULL THEN 's__' || name END AS r{last} FROM valid), t AS (SELECT *, {top} FROM p WHERE r0 IS NOT NULL)
SELECT c_custkey, {cells} AS standard FROM t"""


@query(f"WITH {_standard_sql(lineage.PREFIXES, False)}")
def standardise_lineage(spark, d):
    return lineage.standardise(_raw(spark, d), "taxa").select("c_custkey", F.concat_ws(";", "taxa").alias("standard"))


@query(f"WITH {_standard_sql(lineage.SUB_PREFIXES, True)}")
def standardise_with_subranks(spark, d):
    return lineage.standardise(_raw(spark, d), "taxa", keep_subranks=True).select("c_custkey", F.concat_ws(";", "taxa").alias("standard"))


_RANK = ("species", "subspecies", "strain", "subgenus")
_HIGH = ("domain", "kingdom", "subkingdom", "superkingdom")


def _tree(spark, d):
    """Nodes and names: the tree's root, a named root, regions, nations, customers."""
    c, n, r = (_t(spark, d, t) for t in ("customer", "nation", "region"))
    top = spark.createDataFrame([("1", "1", "no rank", "root"), ("2", "1", "no rank", "cellular organisms")], "tax_id string, parent string, rank string, name string")
    at = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    regions = r.select(at("r", "r_regionkey"), F.lit("2"), pick(_HIGH, F.col("r_regionkey")), "r_name")
    nations = n.select(at("n", "n_nationkey"), at("r", "n_regionkey"), F.lit("phylum"), "n_name")
    return top.union(regions).union(nations).union(c.select(at("c", "c_custkey"), at("n", "c_nationkey"), pick(_RANK, F.col("c_custkey")), "c_name"))


_PATH = f"""SELECT 'c' || c_custkey AS tax_id, CASE {sql_pick(_HIGH, 'r_regionkey')} WHEN 'superkingdom' THEN 'x__' ELSE 'd__' END || r_name || ';p__' || n_name || ';' ||
 CASE {sql_pick(_RANK, 'c_custkey')} WHEN 'species' THEN 's__' WHEN 'subspecies' THEN 'sb__' ELSE 'x__' END || c_name AS lineage FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query(_PATH)
def lineages_of_tree(spark, d):
    t = _tree(spark, d)
    leaves = t.filter(F.col("tax_id").startswith("c")).select("tax_id").union(spark.createDataFrame([("unknown",)], "tax_id string"))
    return taxonomy.tree_lineages(leaves, "tax_id", t.select("tax_id", "parent", "rank"), t.select("tax_id", "name"))


@query("""SELECT 'c' || c_custkey AS gid, '{"' || c_name || '":"c' || c_custkey || '","' || n_name || '":"n' || n_nationkey || '"}' AS json FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def taxon_id_maps(spark, d):
    t = _tree(spark, d)
    leaves = t.filter(F.col("tax_id").startswith("c")).select("tax_id")
    steps = lineage.walk(t, "tax_id", "parent", leaves).join(t.select(F.col("tax_id").alias("ancestor"), F.col("name").alias("taxon")), "ancestor")
    steps = steps.filter("depth <= 1").select(F.col("node").alias("gid"), "taxon", F.col("ancestor").alias("tax_id"))
    return taxonomy.name_maps(leaves.select(F.col("tax_id").alias("gid")), "gid", steps)


_LIN = """lin AS (SELECT c_custkey AS id, ['d__' || r_name, 'p__' || n_name, CASE WHEN c_custkey % 31 = 0 THEN 'x__Odd' ELSE 'c__' || c_mktsegment END, CASE WHEN c_custkey % 37 = 0 THEN 'o__Or(d)' ELSE 'o__O' || c_custkey % 50 END,
 CASE WHEN c_custkey % 43 = 0 THEN 'f__fam' WHEN c_custkey % 3 = 0 THEN 'f__' ELSE 'f__Fam' || c_custkey % 70 END, 'g__Genus' || c_custkey % 40, 's__Genus' || CASE WHEN c_custkey % 41 = 0 THEN 0 ELSE c_custkey % 40 END || ' epi' || c_custkey % 90][1:CASE WHEN c_custkey % 29 = 0 THEN 6 ELSE 7 END] AS t
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _lin(spark, d):
    j = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("c_custkey")
    text = lambda *p: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in p))
    taxa = F.array(
        text("d__", F.col("r_name")), text("p__", F.col("n_name")), F.when(k % 31 == 0, "x__Odd").otherwise(text("c__", F.col("c_mktsegment"))), F.when(k % 37 == 0, "o__Or(d)").otherwise(text("o__O", k % 50)),
        F.when(k % 43 == 0, "f__fam").when(k % 3 == 0, "f__").otherwise(text("f__Fam", k % 70)), text("g__Genus", k % 40), text("s__Genus", F.when(k % 41 == 0, 0).otherwise(k % 40), " epi", k % 90),
    )
    return j.select(k.alias("id"), F.slice(taxa, F.lit(1), F.when(k % 29 == 0, 6).otherwise(7)).alias("t"))


_PLACES = "px AS (SELECT id, t, unnest(range(0, len(t))) AS rank FROM lin), pl AS (SELECT id, t, rank, t[CAST(rank + 1 AS INT)] AS taxon, CASE WHEN rank > 0 THEN t[CAST(rank AS INT)] END AS parent FROM px)"


@query(f"WITH {_LIN}, {_PLACES} SELECT DISTINCT parent, taxon AS child FROM pl WHERE length(taxon) > 3 AND length(parent) > 3 UNION SELECT DISTINCT taxon, CAST(id AS VARCHAR) FROM pl WHERE rank = 6 AND taxon <> 's__'")
def taxon_children(spark, d):
    return taxonomy.children(_lin(spark, d), "id", "t")


@query(f"WITH {_LIN}, {_PLACES} SELECT DISTINCT taxon AS child FROM pl WHERE list_contains(t, 'd__ASIA') AND rank > 0 AND length(taxon) > 3")
def taxa_below(spark, d):
    return taxonomy.below(_lin(spark, d), "id", "t", "d__ASIA")


@query(f"WITH {_LIN}, {_PLACES} SELECT DISTINCT taxon, id FROM pl WHERE length(taxon) > 3")
def extant_taxa(spark, d):
    return taxonomy.members(_lin(spark, d), "id", "t")


@query(f"WITH {_LIN}, {_PLACES} SELECT DISTINCT CAST(rank AS INT) AS rank, taxon FROM pl WHERE taxon <> {sql_list(lineage.PREFIXES)}[CAST(rank + 1 AS INT)]")
def named_lineages(spark, d):
    return taxonomy.named_at_rank(_lin(spark, d), "t")


@query(f"WITH {_LIN}, {_PLACES} SELECT taxon, array_to_string(arg_min(t[1:rank], id), ';') AS parents FROM pl WHERE rank > 0 GROUP BY taxon UNION ALL SELECT CAST(id AS VARCHAR), array_to_string(t, ';') FROM lin")
def parent_lineages(spark, d):
    return taxonomy.parent_lineages(_lin(spark, d), "id", "t").withColumn("parents", F.concat_ws(";", "parents"))


_EXPECTED = "ex AS (SELECT taxon, arg_max(parent, id) AS parent, count(DISTINCT parent) - 1 AS conflicts FROM pl WHERE rank > 0 AND NOT list_has_any(list_transform(t[2:rank + 1], lambda x: length(x) = 3), [true]) GROUP BY taxon)"


@query(f"WITH {_LIN}, {_PLACES}, {_EXPECTED} SELECT * FROM ex")
def expected_parents(spark, d):
    return taxonomy.expected_parents(_lin(spark, d), "id", "t")


@query(rf"""WITH {_LIN}, {_PLACES}, {_EXPECTED}, w AS (SELECT id, t, list_filter(range(1, 8), lambda i: NOT starts_with(t[i], {sql_list(lineage.PREFIXES)}[i])) AS wrong,
 list_filter(t, lambda x: trim(regexp_replace(substr(x, 4), '_[A-Z]+( |$)', ' ', 'g')) <> '' AND NOT regexp_matches(trim(regexp_replace(substr(x, 4), '_[A-Z]+( |$)', ' ', 'g')), '^[a-zA-Z0-9 -]+$')) AS odd FROM lin WHERE len(t) = 7)
SELECT CAST(id AS VARCHAR) AS id, 'ranks' AS "check", array_to_string(t, ';') AS detail FROM lin WHERE len(t) <> 7
UNION ALL SELECT CAST(id AS VARCHAR), 'prefix', t[wrong[1]] FROM w WHERE len(wrong) > 0 UNION ALL SELECT CAST(id AS VARCHAR), 'characters', odd[-1] FROM w WHERE len(odd) > 0
UNION ALL SELECT CAST(id AS VARCHAR), 'species', 'genus and generic name differ' FROM w WHERE substr(split_part(t[7], ' ', 1), 4) <> substr(t[6], 4)
UNION ALL SELECT DISTINCT CAST(NULL AS VARCHAR), 'capitals', taxon FROM pl WHERE regexp_matches(substr(taxon, 4, 1), '\p{{Ll}}')
UNION ALL SELECT NULL, 'duplicate', taxon FROM (SELECT taxon, count(DISTINCT array_to_string(t[1:rank + 1], ';')) AS n FROM pl WHERE length(taxon) > 3 GROUP BY taxon) WHERE n > 1
UNION ALL SELECT NULL, 'hierarchy', taxon FROM ex WHERE conflicts > 0""")
def validate_taxonomy(spark, d):
    return taxonomy.validate(_lin(spark, d), "id", "t")


@query(f"WITH {_LIN} SELECT id, t[1] || ';p__;c__;o__;f__;g__;s__' AS truncated, len(t) = 7 AND t[3] <> 'x__Odd' AS is_full FROM lin")
def truncated_lineages(spark, d):
    return _lin(spark, d).select("id", F.concat_ws(";", taxonomy.truncate(F.col("t"))).alias("truncated"), lineage.is_full(F.col("t")).alias("is_full"))


@query(f"WITH {_LIN}, u AS (SELECT DISTINCT unnest(t) AS taxon FROM lin) SELECT taxon, coalesce(list_position({sql_list(lineage.PREFIXES)}, substr(taxon, 1, 3)), 0) AS rank FROM u ORDER BY rank, taxon")
def sorted_taxa(spark, d):
    taxa = _lin(spark, d).select(F.explode("t").alias("taxon")).distinct()
    return taxonomy.sort_taxa(taxa, "taxon").withColumn("rank", F.array_position(lineage.prefixes(), F.substring("taxon", 1, 3)).cast("int"))


@query(f"SELECT {sql_pick(_RANK, 'c_nationkey')} AS rank, count(DISTINCT c_nationkey) AS taxids, CAST(sum(c_custkey % 4) AS BIGINT) AS genomes FROM customer GROUP BY 1")
def rank_counts(spark, d):
    return strains.rank_counts(_t(spark, d, "customer").select(pick(_RANK, F.col("c_nationkey")).alias("rank"), F.col("c_nationkey").alias("taxid"), (F.col("c_custkey") % 4).alias("genomes")))
