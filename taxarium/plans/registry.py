"""Registered queries over the reference operators, bound to the driver's tables, with their SQL.

Genome ids are made of order keys; two releases are subsets of ``orders`` with changed columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, names
from ..operators import compare, lineage, sequence, tophit
from ..sources.sinks import star_tree

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _gid(version: Column | None = None) -> Column:
    source = F.when(F.col("o_custkey") % 2 == 0, "RS_GCF_").otherwise("GB_GCA_")
    return F.concat(source, F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit("."), (F.lit(1) + F.col("o_orderkey") % 3 if version is None else version).cast("string"))


_GID = "(CASE WHEN o_custkey % 2 = 0 THEN 'RS_GCF_' ELSE 'GB_GCA_' END || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.' || CAST(1 + o_orderkey % 3 AS VARCHAR))"
_PREV = f"prev AS (SELECT {_GID} AS gid, o_orderstatus AS status, o_orderpriority AS priority, round(o_totalprice, 2) AS price, o_clerk_ AS path FROM (SELECT *, CAST(o_custkey % 97 AS VARCHAR) AS o_clerk_ FROM orders) WHERE o_orderkey % 10 <> 0)"
_CUR = f"""cur AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN replace({_GID}, 'GB_GCA', 'RS_GCF') WHEN o_orderkey % 13 = 0 THEN regexp_replace({_GID}, '[.][0-9]+$', '.4') ELSE {_GID} END AS gid,
  CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS status, o_orderpriority AS priority, CASE WHEN o_orderkey % 8 = 0 THEN 0.0::DOUBLE ELSE round(o_totalprice, 2) END AS price,
  CASE WHEN o_orderkey % 17 = 0 THEN 'moved' ELSE CAST(o_custkey % 97 AS VARCHAR) END AS path FROM orders WHERE o_orderkey % 7 <> 0)"""


def _prev(spark, d) -> DataFrame:
    o = _t(spark, d, "orders").filter("o_orderkey % 10 <> 0")
    return o.select(_gid().alias("gid"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.round("o_totalprice", 2).alias("price"), (F.col("o_custkey") % 97).cast("string").alias("path"))


def _cur(spark, d) -> DataFrame:
    o = _t(spark, d, "orders").filter("o_orderkey % 7 <> 0")
    k = F.col("o_orderkey")
    gid = F.when(k % 11 == 0, F.replace(_gid(), F.lit("GB_GCA"), F.lit("RS_GCF"))).when(k % 13 == 0, F.regexp_replace(_gid(), r"\.[0-9]+$", ".4")).otherwise(_gid())
    return o.select(
        gid.alias("gid"), F.when(k % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"),
        F.when(k % 8 == 0, 0.0).otherwise(F.round("o_totalprice", 2)).alias("price"), F.when(k % 17 == 0, "moved").otherwise((F.col("o_custkey") % 97).cast("string")).alias("path"),
    )


@query(f"""WITH {_PREV}, {_CUR}, j AS (SELECT c.status <> p.status AS status, c.priority <> p.priority AS priority, c.price <> p.price AS price FROM cur c JOIN prev p USING (gid)),
l AS (SELECT 'status' AS "column", status AS ch FROM j UNION ALL SELECT 'priority', priority FROM j UNION ALL SELECT 'price', price FROM j)
SELECT "column", round_even(100.0::DOUBLE * sum(CAST(ch AS INT)) / count(*), 2) AS percent_changed, count(*) AS compared FROM l GROUP BY 1""")
def release_diff_overview(spark, d):
    return compare.field_changes(_prev(spark, d), _cur(spark, d), "gid", ["status", "priority", "price"]).orderBy("percent_changed", "column")


@query(f"WITH {_PREV}, {_CUR} SELECT gid, p.status AS old_value, c.status AS new_value, CASE WHEN p.status = c.status THEN 'Identical' ELSE 'Different' END AS similarity FROM prev p JOIN cur c USING (gid)")
def compare_field(spark, d):
    return compare.compare_field(_prev(spark, d), _cur(spark, d), "gid", "status")


@query("""WITH l AS (SELECT l_orderkey, 100.0::DOUBLE * count(*) FILTER (l_returnflag = 'A') / count(*) AS a, 100.0::DOUBLE * count(*) FILTER (l_returnflag = 'R') / count(*) AS r FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus AS old_domain, CASE WHEN a > r THEN 'F' ELSE 'O' END AS new_domain, o_orderstatus = CASE WHEN a > r THEN 'F' ELSE 'O' END AS same_domain, abs(a - r) AS diff_percent FROM orders JOIN l ON o_orderkey = l_orderkey""")
def compare_reports(spark, d):
    share = lambda f: 100.0 * F.count_if(F.col("l_returnflag") == f) / F.count("*")
    new = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(share("A").alias("a"), share("R").alias("r"))
    domain = F.when(F.col("a") > F.col("r"), "F").otherwise("O")
    return _t(spark, d, "orders").join(new, "o_orderkey").select("o_orderkey", F.col("o_orderstatus").alias("old_domain"), domain.alias("new_domain"), (F.col("o_orderstatus") == domain).alias("same_domain"), F.abs(F.col("a") - F.col("r")).alias("diff_percent"))


@query(f"""WITH {_PREV}, {_CUR}, a AS (SELECT DISTINCT gid FROM prev), b AS (SELECT DISTINCT gid FROM cur)
SELECT gid, CASE WHEN a.gid IS NULL THEN 'added' WHEN b.gid IS NULL THEN 'removed' ELSE 'common' END AS status FROM a FULL JOIN b USING (gid)""")
def release_added_removed_common(spark, d):
    return compare.membership(_prev(spark, d), _cur(spark, d), "gid")


_PROPAGATE = f"""{_PREV}, {_CUR}, kept AS (SELECT gid, status, 'retained' AS move FROM prev WHERE gid IN (SELECT gid FROM cur)),
lost AS (SELECT gid AS candidate, status FROM prev WHERE gid NOT IN (SELECT gid FROM cur)),
v AS (SELECT gid, split_part(gid, '.', 1) AS base, unnest(range(1, CAST(split_part(gid, '.', 2) AS INT) + 5)) AS n FROM cur),
o AS (SELECT gid, n, 0 AS r, base || '.' || n AS candidate, 'same' AS move FROM v UNION ALL SELECT gid, n, 1, replace(base, 'RS_GCF', 'GB_GCA') || '.' || n, 'moved_to_refseq' FROM v UNION ALL SELECT gid, n, 2, replace(base, 'GB_GCA', 'RS_GCF') || '.' || n, 'moved_to_genbank' FROM v),
m AS (SELECT gid, status, move FROM (SELECT *, row_number() OVER (PARTITION BY gid, n ORDER BY r) AS k FROM o JOIN lost USING (candidate)) WHERE k = 1),
p AS (SELECT * FROM kept UNION ALL SELECT * FROM m)"""


@query(f"WITH {_PROPAGATE} SELECT * FROM p")
def propagate_labels(spark, d):
    return compare.propagate_labels(_prev(spark, d), _cur(spark, d), "gid", "status")


@query(f"WITH {_PROPAGATE} SELECT move, count(*) AS genomes, count(DISTINCT status) AS labels FROM p GROUP BY 1")
def propagation_summary(spark, d):
    return propagate_labels(spark, d).groupBy("move").agg(F.count("*").alias("genomes"), F.count_distinct("status").alias("labels"))


@query(f"""SELECT {_GID} AS gid, 'G' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS canonical, substr({_GID}, 4) AS db_key, split_part({_GID}, '.', 1) AS base, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN 2 ELSE 3 END AS version FROM orders""")
def canonical_ids(spark, d):
    g = F.col("gid")
    return _t(spark, d, "orders").select(_gid().alias("gid")).select("gid", ids.canonical_id(g).alias("canonical"), ids.database_key(g).alias("db_key"), ids.version_base(g).alias("base"), ids.version_number(g).alias("version"))


_HIT = "row_number() OVER (PARTITION BY {k} ORDER BY {o}) AS k"


@query(f"SELECT gene, family, bitscore, evalue FROM (SELECT l_orderkey AS gene, l_suppkey % 20 AS family, l_extendedprice AS bitscore, l_discount AS evalue, {_HIT.format(k='l_orderkey, l_suppkey % 20', o='l_extendedprice DESC, l_linenumber, l_partkey')} FROM lineitem) WHERE k = 1")
def top_hit_per_pair(spark, d):
    return tophit.top_hit(_hits(spark, d), ["gene", "family"], F.col("bitscore"), F.col("ord"), ["bitscore", "evalue"])


def _hits(spark, d) -> DataFrame:
    ord_ = F.col("l_linenumber").cast("long") * 100_000_000 + F.col("l_partkey")
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("gene"), (F.col("l_suppkey") % 20).alias("family"), F.col("l_extendedprice").alias("bitscore"), F.col("l_discount").alias("evalue"), ord_.alias("ord"))


@query(f"SELECT gene, family, bitscore FROM (SELECT l_orderkey AS gene, l_suppkey % 20 AS family, l_extendedprice AS bitscore, {_HIT.format(k='l_orderkey', o='l_extendedprice DESC, l_linenumber, l_partkey')} FROM lineitem) WHERE k = 1")
def top_hit_per_gene(spark, d):
    return tophit.top_hit(_hits(spark, d), ["gene"], F.col("bitscore"), F.col("ord"), ["family", "bitscore"])


@query(f"SELECT gene, family, bitscore FROM (SELECT l_orderkey AS gene, l_suppkey % 20 AS family, l_extendedprice AS bitscore, {_HIT.format(k='l_orderkey', o='l_linenumber, l_partkey, l_extendedprice, l_suppkey % 20')} FROM lineitem) WHERE k = 1")
def first_hit_per_query(spark, d):
    return tophit.first_by(_hits(spark, d), ["gene"], F.struct("ord", "bitscore", "family"), ["family", "bitscore"])


@query(f"SELECT source, doc_id, length FROM (SELECT source, doc_id, length(text) AS length, {_HIT.format(k='source', o='length(text) DESC, doc_id')} FROM documents WHERE length(text) > 0) WHERE k = 1")
def longest_hit(spark, d):
    docs = _t(spark, d, "documents").select("source", "doc_id", F.length("text").cast("long").alias("length")).filter("length > 0")
    return tophit.top_hit(docs, ["source"], F.col("length"), F.col("doc_id"), ["doc_id", "length"])


@query(f"WITH {_PREV}, {_CUR}, a AS (SELECT gid, status, price, 0 AS o FROM prev UNION ALL SELECT gid, status, price, 1 FROM (SELECT gid, max(status) AS status, max(price) AS price FROM cur GROUP BY gid)) SELECT gid, arg_max(status, o) AS status, arg_max(price, o) AS price FROM a GROUP BY gid")
def multi_release_last_wins(spark, d):
    new = _cur(spark, d).groupBy("gid").agg(F.max("status").alias("status"), F.max("price").alias("price"))
    both = _prev(spark, d).select("gid", "status", "price", F.lit(0).alias("o")).unionByName(new.withColumn("o", F.lit(1)))
    return tophit.last_by(both, ["gid"], F.col("o"), ["status", "price"])


_LINEAGE = "SELECT c_custkey, 'd__' || r_name || ';p__' || n_name || ';c__' || c_mktsegment || ';o__;f__;g__;s__' || c_name AS lineage FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _lineages(spark, d) -> DataFrame:
    j = _t(spark, d, "customer").join(_t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(_t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    text = F.concat(F.lit("d__"), "r_name", F.lit(";p__"), "n_name", F.lit(";c__"), "c_mktsegment", F.lit(";o__;f__;g__;s__"), "c_name")
    return j.select("c_custkey", lineage.parse(text).alias("taxa"))


@query(f"SELECT c_custkey, {', '.join(f'split_part(lineage, chr(59), {i + 1}) AS {r}' for i, r in enumerate(('domain', 'phylum', 'class', 'ord', 'family', 'genus', 'species')))} FROM ({_LINEAGE})")
def lineage_explode_ranks(spark, d):
    return _lineages(spark, d).select("c_custkey", *(F.get("taxa", F.lit(i)).alias(r) for i, r in enumerate(("domain", "phylum", "class", "ord", "family", "genus", "species"))))


@query(f"SELECT c_custkey, split_part(lineage, ';', 1) || ';' || split_part(lineage, ';', 2) || ';c__;o__;f__;g__;s__' AS filled FROM ({_LINEAGE})")
def lineage_fill_trailing(spark, d):
    return _lineages(spark, d).select("c_custkey", F.concat_ws(";", lineage.fill_trailing(F.slice("taxa", 1, 2))).alias("filled"))


@query("SELECT p_brand, count(DISTINCT p_type) AS n_parents FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def inconsistent_parents(spark, d):
    return lineage.several_parents(_t(spark, d, "part"), "p_brand", "p_type")


_TREE = "nodes AS (SELECT 'r' || r_regionkey AS node, NULL AS parent, 'region' AS rank FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'nation' FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'customer' FROM customer)"


def _nodes(spark, d) -> DataFrame:
    at = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = _t(spark, d, "region").select(at("r", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit("region").alias("rank"))
    n = _t(spark, d, "nation").select(at("n", "n_nationkey"), at("r", "n_regionkey"), F.lit("nation"))
    return r.union(n).union(_t(spark, d, "customer").select(at("c", "c_custkey"), at("n", "c_nationkey"), F.lit("customer")))


@query(f"WITH RECURSIVE {_TREE}, up(node, ancestor, depth) AS (SELECT node, node, 0 FROM nodes UNION ALL SELECT up.node, t.parent, up.depth + 1 FROM up JOIN nodes t ON t.node = up.ancestor WHERE t.parent IS NOT NULL) SELECT node, string_agg(ancestor, ';' ORDER BY depth DESC) AS lineage FROM up GROUP BY 1")
def tree_lineage(spark, d):
    walked = lineage.walk(_nodes(spark, d), "node", "parent")
    return walked.groupBy("node").agg(F.concat_ws(";", F.transform(F.sort_array(F.collect_list(F.struct("depth", "ancestor")), asc=False), lambda x: x["ancestor"])).alias("lineage"))


@query(f"WITH RECURSIVE {_TREE}, up(node, ancestor, depth) AS (SELECT node, node, 0 FROM nodes UNION ALL SELECT up.node, t.parent, up.depth + 1 FROM up JOIN nodes t ON t.node = up.ancestor WHERE t.parent IS NOT NULL) SELECT up.node, arg_min(ancestor, depth) AS ancestor FROM up JOIN nodes n ON n.node = up.ancestor AND n.rank = 'nation' GROUP BY 1")
def nearest_ancestor(spark, d):
    return lineage.nearest(_nodes(spark, d), "node", "parent", "rank", "nation")


@query("""WITH i AS (SELECT l_suppkey AS seq, l_partkey AS s, CAST(l_partkey + l_quantity AS BIGINT) AS e FROM lineitem),
a AS (SELECT *, CASE WHEN s > coalesce(max(e) OVER (PARTITION BY seq ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS nw FROM i),
b AS (SELECT *, sum(nw) OVER (PARTITION BY seq ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM a), c AS (SELECT seq, g, max(e) - min(s) + 1 AS n FROM b GROUP BY 1, 2)
SELECT seq, CAST(sum(n) - 1 AS BIGINT) AS coding_bases FROM c GROUP BY 1""")
def coding_bases(spark, d):
    i = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("seq"), F.col("l_partkey").cast("long").alias("s"), (F.col("l_partkey") + F.col("l_quantity")).cast("long").alias("e"))
    return sequence.union_length(i, "seq", "s", "e")


@query("""WITH l AS (SELECT source, length(text) AS n FROM documents), w AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY n DESC) AS run, sum(n) OVER (PARTITION BY source) AS total, count(*) OVER (PARTITION BY source ORDER BY n DESC) AS many FROM l)
SELECT source, CAST(max(total) AS BIGINT) AS total, max(n) AS n50, min(many) AS l50 FROM w WHERE run * 2 >= total GROUP BY 1""")
def n50_l50(spark, d):
    return sequence.n50(_t(spark, d, "documents").select("source", F.length("text").cast("long").alias("n")), "source", "n")


@query("SELECT doc_id, length(text) AS size, length(text) - length(replace(replace(lower(text), 'g', ''), 'c', '')) AS gc_count, len(regexp_extract_all(text, '[A-Za-z]+')) AS pieces FROM documents")
def gc_like_counts(spark, d):
    t = F.lower("text")
    return _t(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("size"), (F.length("text") - F.length(F.replace(F.replace(t, F.lit("g"), F.lit("")), F.lit("c"), F.lit("")))).cast("long").alias("gc_count"), F.regexp_count("text", F.lit("[A-Za-z]+")).cast("long").alias("pieces"))


@query(r"""SELECT p_partkey, replace(upper(regexp_replace(replace('strain ' || p_name || ' ' || p_brand || '(=x)', 'strain', ''), '[^\p{L}\p{N}]+', '', 'g')), 'ẞ', 'SS') AS standard,
upper(regexp_replace(regexp_replace(p_name || ' ' || p_brand || ' (=' || p_type || ')', '\(.+\)', ' '), '[^\p{L}\p{N}]+', '', 'g')) AS canonical, regexp_matches(p_brand, '[0-9]') AND (p_brand NOT LIKE '% %' OR regexp_matches(regexp_replace(p_brand, '[-. ]', '', 'g'), '^[0-9A-Z]+$')) AS is_id FROM part""")
def strain_canonical(spark, d):
    a = F.concat(F.lit("strain "), "p_name", F.lit(" "), "p_brand", F.lit("(=x)"))
    b = F.concat(F.lit("strain "), "p_name", F.lit(" "), "p_brand", F.lit(" (="), "p_type", F.lit(")"))
    return _t(spark, d, "part").select("p_partkey", ids.standard_strain(a).alias("standard"), ids.canonical_strain(b).alias("canonical"), ids.is_strain_id(F.col("p_brand")).alias("is_id"))


@query("""WITH a AS (SELECT p_size AS k, list_sort(list_distinct(list(p_brand || '-' || p_partkey % 5))) AS x FROM part GROUP BY 1), b AS (SELECT p_size AS k, list_sort(list_distinct(list(p_brand || '-' || p_partkey % 7))) AS y FROM part GROUP BY 1)
SELECT a.k AS k, array_to_string(CASE WHEN list_has_any(x, y) THEN list_sort(list_distinct(list_concat(x, y))) ELSE x END, ';') AS expanded FROM a LEFT JOIN b USING (k)""")
def strain_overlap_expand(spark, d):
    part = _t(spark, d, "part")
    strain = lambda m: F.concat("p_brand", F.lit("-"), (F.col("p_partkey") % m).cast("string"))
    sets = lambda m, c: part.groupBy(F.col("p_size").alias("k")).agg(F.array_sort(F.collect_set(strain(m))).alias(c))
    return sets(5, "x").join(sets(7, "y"), "k", "left").select("k", F.concat_ws(";", compare.expand_if_shared(F.col("x"), F.col("y"))).alias("expanded"))


@query("""SELECT doc_id, CAST(list_filter(list_transform(regexp_extract_all(regexp_replace(regexp_replace(text, 'emend\\.[^\\d]*\\d{4}', '', 'g'), 'ex [^\\d]*\\d{4}', '', 'g'), '[1-3]\\d{3}'), lambda y: CAST(y AS INT)), lambda y: y <= 2026)[1] AS INT) AS priority_year FROM documents""".replace("\\\\", "\\"))
def priority_years(spark, d):
    return _t(spark, d, "documents").select("doc_id", names.priority_year(F.col("text")).alias("priority_year"))


@query(f"""WITH {_PREV}, {_CUR}, n AS (SELECT gid, max(path) AS path FROM cur GROUP BY 1), b AS (SELECT split_part(gid, '.', 1) AS base, min(gid) AS previous FROM prev WHERE gid NOT IN (SELECT gid FROM n) GROUP BY 1),
j AS (SELECT coalesce(p.gid, n.gid) AS gid, p.gid IS NOT NULL AS e, n.gid IS NOT NULL AS w, p.path AS a, n.path AS z FROM prev p FULL JOIN n ON p.gid = n.gid),
k AS (SELECT j.gid, CASE WHEN e AND w THEN CASE WHEN a = z THEN 'unchanged' ELSE 'update' END WHEN w THEN CASE WHEN previous IS NOT NULL THEN 'version' ELSE 'add' END ELSE 'removed' END AS action, previous FROM j LEFT JOIN b ON split_part(j.gid, '.', 1) = base)
SELECT gid, action, CASE WHEN action = 'version' THEN previous END AS previous FROM k""")
def genome_merge_actions(spark, d):
    new = _cur(spark, d).groupBy("gid").agg(F.max("path").alias("path"))
    return compare.merge_actions(_prev(spark, d), new, "gid", "path")


@query(f"WITH {_PREV}, {_CUR} SELECT '(' || string_agg(gid, ',' ORDER BY gid) || ');' AS tree, count(*) AS leaves FROM (SELECT DISTINCT gid FROM cur WHERE status = 'F' EXCEPT SELECT gid FROM prev)")
def pseudo_tree(spark, d):
    new = _cur(spark, d).filter("status = 'F'").select("gid").distinct().join(_prev(spark, d).select("gid"), "gid", "left_anti")
    return new.agg(star_tree(F.col("gid")).alias("tree"), F.count("*").alias("leaves"))


@query("SELECT source, count(*) AS n, count(DISTINCT sha256(text)) AS files, min(sha256(text)) AS first_hash FROM documents GROUP BY 1")
def file_hash_diff(spark, d):
    h = F.sha2("text", 256)
    return _t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_distinct(h).alias("files"), F.min(h).alias("first_hash"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(spark, d):
    return _t(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("""SELECT page_id, len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS links, regexp_extract(html, 'href="([^"]*)"', 1) AS first_link, length(regexp_replace(html, '<.*?>', '', 'g')) AS text_length FROM pages""")
def html_links(spark, d):
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return _t(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("links"), F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("first_link"), F.length(F.regexp_replace("html", "<.*?>", "")).cast("long").alias("text_length"))


@query("SELECT o_orderkey, regexp_extract(x, '^([^0-9]*)', 1) || lpad(split_part(x, '.', 2), 2, '0') AS wgs FROM (SELECT o_orderkey, 'ABCD' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '.' || CAST(1 + o_orderkey % 3 AS VARCHAR) AS x FROM orders)")
def wgs_format(spark, d):
    x = F.concat(F.lit("ABCD"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit("."), (1 + F.col("o_orderkey") % 3).cast("string"))
    return _t(spark, d, "orders").select("o_orderkey", ids.wgs_id(x).alias("wgs"))


@query()
def rrna_merge(spark, d):
    hits = _t(spark, d, "lineitem").select(F.col("l_suppkey").cast("long").alias("seq"), F.col("l_partkey").cast("long").alias("start"), (F.col("l_partkey") + F.col("l_quantity")).cast("long").alias("end"), (F.col("l_linenumber") % 2 == 0).alias("reverse"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return sequence.concatenate_hits(hits)


@query("SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS price, TRY_CAST(o_orderpriority AS DOUBLE) IS NOT NULL AS is_float FROM orders WHERE o_totalprice <> 0")
def catalog_cast_load(spark, d):
    number = F.col("o_totalprice").cast("string").try_cast("double")
    return _t(spark, d, "orders").filter(number != 0).select("o_orderkey", number.cast("bigint").alias("price"), F.col("o_orderpriority").try_cast("double").isNotNull().alias("is_float"))


@query("SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1")
def marker_pivot(spark, d):
    p = _t(spark, d, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).count()
    return p.select("l_suppkey", *(F.coalesce(F.col(c), F.lit(0)).alias(c.lower()) for c in ("A", "N", "R")))


@query("SELECT user_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS status, bool_or(event_type IN ('click', 'view')) AND NOT bool_or(event_type = 'error') AS work FROM events GROUP BY 1")
def status_worklist(spark, d):
    s = _t(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("s"))
    return s.select("user_id", F.concat_ws(";", "s").alias("status"), (F.arrays_overlap("s", F.array(F.lit("click"), F.lit("view"))) & ~F.array_contains("s", "error")).alias("work"))


@query("""WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 's__' WHEN p_partkey % 7 = 1 THEN p_name WHEN p_partkey % 7 = 2 THEN 's__' || split_part(p_name, ' ', 1) WHEN p_partkey % 7 = 3 THEN 's__Aa taxon ' || p_name WHEN p_partkey % 7 = 4 THEN 's__Aa sp. ' || p_brand WHEN p_partkey % 7 = 5 THEN 's__aa bb' ELSE 's__Candidatus Aa bb' END AS name FROM part)
SELECT p_partkey, CASE WHEN name = 's__' THEN NULL WHEN NOT starts_with(name, 's__') THEN 'missing the species prefix' WHEN len(string_split(name, ' ')) <= CASE WHEN contains(lower(name), 'candidatus') THEN 2 ELSE 1 END THEN 'missing the generic name'
WHEN contains(lower(name), ' taxon') THEN 'taxon' WHEN contains(lower(name), ' of ') THEN 'of' WHEN regexp_matches(substr(name, 4), '^[a-z]') THEN 'lower-case genus' WHEN contains(lower(name), 'sp.') THEN 'sp.' END AS reason FROM n""")
def species_validity_lax(spark, d):
    k, name = F.col("p_partkey") % 7, F.col("p_name")
    label = F.when(k == 0, "s__").when(k == 1, name).when(k == 2, F.concat(F.lit("s__"), F.substring_index(name, " ", 1))).when(k == 3, F.concat(F.lit("s__Aa taxon "), name))
    label = label.when(k == 4, F.concat(F.lit("s__Aa sp. "), "p_brand")).when(k == 5, "s__aa bb").otherwise("s__Candidatus Aa bb")
    return _t(spark, d, "part").select("p_partkey", names.species_validity_lax(label).alias("reason"))


_FILES = "SELECT DISTINCT l_orderkey AS gid, CASE l_linenumber % 4 WHEN 0 THEN 'extra_fasta' WHEN 1 THEN 'fasta' WHEN 2 THEN 'protein' ELSE 'other' END AS kind, CAST(l_linenumber AS VARCHAR) AS name, max(CAST(l_partkey AS VARCHAR)) OVER (PARTITION BY l_orderkey, l_linenumber) AS hash FROM lineitem"


@query("""WITH known AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'n' ELSE 'm' END || s_nationkey AS name, min(s_suppkey) AS s FROM supplier GROUP BY 1)
SELECT c_custkey, coalesce(a.s, b.s) AS s_suppkey FROM customer LEFT JOIN known a ON a.name = 'n' || c_nationkey LEFT JOIN known b ON b.name = 'n' || (c_nationkey + 1) % 25 WHERE coalesce(a.s, b.s) IS NOT NULL""")
def candidate_lookup(spark, d):
    name = F.concat(F.when(F.col("s_suppkey") % 3 == 0, "n").otherwise("m"), F.col("s_nationkey").cast("string"))
    known = _t(spark, d, "supplier").select(name.alias("name"), "s_suppkey")
    tried = F.array(*(F.concat(F.lit("n"), n.cast("string")) for n in (F.col("c_nationkey"), (F.col("c_nationkey") + 1) % 25)))
    return compare.candidate_lookup(_t(spark, d, "customer").select("c_custkey", tried.alias("names")), "c_custkey", "names", known, "name", "s_suppkey")


@query(f"SELECT split_part(lineage, ';', 3) AS taxon, count(DISTINCT split_part(lineage, ';', 2)) AS n_parents FROM ({_LINEAGE}) GROUP BY 1 HAVING count(DISTINCT split_part(lineage, ';', 2)) > 1")
def duplicate_taxa(spark, d):
    pairs = _lineages(spark, d).select(F.get("taxa", F.lit(2)).alias("taxon"), F.get("taxa", F.lit(1)).alias("parent"))
    return lineage.several_parents(pairs, "taxon", "parent")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5")
def most_common_names(spark, d):
    return _t(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(5)
