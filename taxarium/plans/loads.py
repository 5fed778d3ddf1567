"""Registered queries over archive tables, database loads and genome statistics, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, sequence
from ..sources import ncbi
from .registry import _t, query

#: Tells the rows of an order apart.
_ORD = "l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey"
_ACC = "CASE WHEN o_custkey % 2 = 0 THEN 'GCF_' ELSE 'GCA_' END || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.1'"
_WGS = "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'ABCD' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '.' || CAST(1 + o_orderkey % 3 AS VARCHAR) END"
_HEADER = ["assembly_accession", "taxid", "organism_name", "wgs_master", "version_status", "excluded_from_refseq"]


def _summary(spark, d):
    """Assembly summaries as lines of text, a comment and the header among them."""
    k = F.col("o_orderkey")
    acc = F.concat(F.when(F.col("o_custkey") % 2 == 0, "GCF_").otherwise("GCA_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".1"))
    wgs = F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("ABCD"), F.lpad(k.cast("string"), 8, "0"), F.lit("."), (1 + k % 3).cast("string")))
    note = F.when(k % 6 == 0, "many frameshifted proteins; untrustworthy as type").otherwise("")
    line = F.concat_ws("\t", acc, F.col("o_custkey").cast("string"), "o_clerk_", wgs, F.when(k % 5 == 0, "replaced").otherwise("latest"), note)
    rows = _t(spark, d, "orders").withColumn("o_clerk_", F.concat(F.lit("Genus sp"), (k % 97).cast("string"))).select(line.alias("value"))
    head = spark.createDataFrame([("# a comment",), ("\t".join(_HEADER),)], "value string")
    return ncbi.cells(head.union(rows), _HEADER)


@query(f"SELECT {_ACC} AS accession, CAST(o_custkey AS VARCHAR) AS taxid FROM orders")
def accession_tax_ids(spark, d):
    s = _summary(spark, d)
    return ncbi.tax_ids([s.filter("assembly_accession like 'GCF%'"), s.filter("assembly_accession like 'GCA%'")])


@query(f"SELECT CASE WHEN o_custkey % 2 = 0 THEN 'RS_' ELSE 'GB_' END || {_ACC} AS gid, 'Genus sp' || o_orderkey % 97 AS organism_name FROM orders")
def organism_names(spark, d):
    return ncbi.organism_names([_summary(spark, d)])


@query(f"""SELECT CASE WHEN o_custkey % 2 = 0 THEN 'RS_' ELSE 'GB_' END || {_ACC} AS genome_id, {_WGS} AS ncbi_wgs_master, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'ABCD0' || CAST(1 + o_orderkey % 3 AS VARCHAR) END AS ncbi_wgs_formatted,
 CASE WHEN o_orderkey % 5 = 0 THEN 'replaced' ELSE 'latest' END AS ncbi_version_status, CASE WHEN o_orderkey % 6 = 0 THEN 'true' ELSE 'false' END AS ncbi_untrustworthy_as_type FROM orders WHERE o_orderstatus = 'F'""")
def assembly_metadata(spark, d):
    wanted = _t(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.concat(F.when(F.col("o_custkey") % 2 == 0, "GCF_").otherwise("GCA_"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit(".1")).alias("id"))
    out = ncbi.assembly_metadata([_summary(spark, d)], wanted)
    return out.select("genome_id", "ncbi_wgs_master", "ncbi_wgs_formatted", "ncbi_version_status", "ncbi_untrustworthy_as_type")


@query("SELECT l_orderkey AS tax_id, arg_max(l_shipmode_, l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey) AS name FROM (SELECT *, 'name' || l_partkey AS l_shipmode_ FROM lineitem) WHERE l_returnflag <> 'N' GROUP BY 1")
def last_scientific_names(spark, d):
    kind = F.when(F.col("l_returnflag") == "N", "synonym").otherwise("scientific name")
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("tax_id"), F.concat(F.lit("name"), F.col("l_partkey").cast("string")).alias("name"), kind.alias("class"), F.expr(_ORD).alias("ord"))
    return ncbi.last_scientific(rows)


@query("SELECT 'seq' || c_custkey AS seq_id, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment || ';' || c_name || ' x' END AS taxonomy FROM customer")
def header_taxonomies(spark, d):
    head = F.concat(F.lit(">seq"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(";"), "c_name", F.lit(" x"))))
    return ncbi.header_taxonomies(_t(spark, d, "customer").select(F.explode(F.array(head, F.lit("ACGT"))).alias("value")))


_CATALOGUE = (("o_totalprice", "price", "INT", "metadata_nt"), ("o_orderstatus", "status", "TEXT", "metadata_ncbi"), ("blank", "often blank", "FLOAT", "metadata_nt"), ("absent", "not in the table", "TEXT", "metadata_ncbi"))
_CELLS = f"""t AS (SELECT {_ACC} AS original, CASE WHEN o_custkey % 2 = 0 THEN 'RS_' ELSE 'GB_' END || {_ACC} AS gid, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE '0.5' END AS blank, o_orderkey, o_custkey FROM orders),
l AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN gid ELSE original END AS id FROM t WHERE o_custkey % 5 <> 0), w AS (SELECT * FROM t WHERE gid IN (SELECT id FROM l) OR original IN (SELECT id FROM l)),
c AS (SELECT gid, 'metadata_nt' AS "table", 'o_totalprice' AS field, 'INT' AS type, CAST(CAST(trunc(CAST(o_totalprice AS DOUBLE)) AS BIGINT) AS VARCHAR) AS value FROM w UNION ALL SELECT gid, 'metadata_ncbi', 'o_orderstatus', 'TEXT', o_orderstatus FROM w UNION ALL SELECT gid, 'metadata_nt', 'blank', 'FLOAT', blank FROM w WHERE trim(blank) <> '')"""


def _cells(spark, d):
    k = F.col("o_orderkey")
    acc = F.concat(F.when(F.col("o_custkey") % 2 == 0, "GCF_").otherwise("GCA_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".1"))
    o = _t(spark, d, "orders").withColumn("gid", acc)
    table = o.select("gid", F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_orderstatus", F.when(k % 3 == 0, " ").otherwise("0.5").alias("blank"), F.lit("x").alias("unlisted"))
    catalogue = spark.createDataFrame(list(_CATALOGUE), "field string, description string, type string, `table` string")
    wanted = o.filter("o_custkey % 5 <> 0").select(F.when(k % 2 == 0, F.concat(F.when(F.col("o_custkey") % 2 == 0, "RS_").otherwise("GB_"), "gid")).otherwise(F.col("gid")).alias("id"))
    return catalog.listed(catalog.long_form(table, "gid", catalogue), "gid", wanted, original="_original").drop("_original")


@query(f"WITH {_CELLS} SELECT * FROM c")
def metadata_cells(spark, d):
    return _cells(spark, d)


@query(f"""WITH {_CELLS}, n AS (SELECT gid, max(CASE WHEN field = 'o_totalprice' THEN CAST(value AS BIGINT) END) AS p, max(CASE WHEN field = 'blank' THEN CAST(value AS DOUBLE) END) AS b FROM c WHERE "table" = 'metadata_nt' GROUP BY 1),
o AS (SELECT gid, CAST(-1 AS BIGINT) AS o_totalprice, CAST(9 AS DOUBLE) AS blank, o_orderkey AS kept FROM t WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.gid, n.gid) AS gid, coalesce(p, o_totalprice) AS o_totalprice, coalesce(b, blank) AS blank, kept FROM o FULL JOIN n USING (gid)""")
def stored_snapshot(spark, d):
    return catalog.store(_stored(spark, d), _cells(spark, d).filter("`table` = 'metadata_nt'"), "gid")


@query(f"""WITH {_CELLS}, n AS (SELECT gid, max(CASE WHEN field = 'o_totalprice' THEN CAST(value AS BIGINT) END) AS p, max(CASE WHEN field = 'blank' THEN CAST(value AS DOUBLE) END) AS b FROM c WHERE "table" = 'metadata_nt' GROUP BY 1), o AS (SELECT gid, o_orderkey AS kept FROM t WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.gid, n.gid) AS gid, p AS o_totalprice, b AS blank, kept FROM o FULL JOIN n USING (gid)""")
def reset_snapshot(spark, d):
    return catalog.store(_stored(spark, d), _cells(spark, d).filter("`table` = 'metadata_nt'"), "gid", reset=True)


def _stored(spark, d):
    k = F.col("o_orderkey")
    gid = F.concat(F.when(F.col("o_custkey") % 2 == 0, "RS_GCF_").otherwise("GB_GCA_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".1"))
    return _t(spark, d, "orders").filter(k % 2 == 0).select(gid.alias("gid"), F.lit(-1).cast("long").alias("o_totalprice"), F.lit(9.0).alias("blank"), k.alias("kept"))


@query("SELECT o_orderkey, CAST(NULL AS DOUBLE) AS o_totalprice, o_orderstatus FROM orders")
def nulled_columns(spark, d):
    return catalog.nulled(_t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_totalprice"])


@query("SELECT * FROM (VALUES ('o_orderkey', 'the key', 'INT', 'orders'), ('o_totalprice', '', 'FLOAT', 'orders'), ('o_orderstatus', '', 'TEXT', 'orders')) t(field, description, type, \"table\")")
def table_catalogue(spark, d):
    rows = catalog.describe(_t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), {"o_orderkey": "the key"}, "orders")
    return spark.createDataFrame(rows, "field string, description string, type string, `table` string")


@query(f"""WITH p AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'RS_' ELSE 'GB_' END || {_ACC} AS gid, CAST(o_totalprice AS VARCHAR) AS a, o_orderstatus AS b, o_custkey FROM orders)
SELECT gid, 'checkm_completeness' AS field, 'FLOAT' AS type, a AS value FROM p WHERE o_custkey % 5 <> 0 UNION ALL SELECT gid, 'checkm_marker_lineage', 'TEXT', b FROM p WHERE o_custkey % 5 <> 0""")
def quality_cells(spark, d):
    acc = F.concat(F.when(F.col("o_custkey") % 2 == 0, "GCF_").otherwise("GCA_"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit(".1"))
    o = _t(spark, d, "orders")
    profile = o.select(F.concat(acc, F.lit("_ASM1v2_protein")).alias("Bin Id"), F.col("o_totalprice").cast("string").alias("Completeness"), F.col("o_orderstatus").alias("Marker lineage"), F.lit("x").alias("Other"))
    wanted = o.filter("o_custkey % 5 <> 0").select(F.concat(F.when(F.col("o_custkey") % 2 == 0, "RS_").otherwise("GB_"), acc).alias("id"))
    return catalog.quality_cells(profile, "Bin Id", wanted)


@query("SELECT 'GB_GCA_' || c_custkey AS gid, 'd__A;p__' || c_mktsegment AS lineage FROM customer WHERE c_custkey % 3 = 0")
def taxonomy_cells(spark, d):
    c = _t(spark, d, "customer").select(F.concat(F.lit("GCA_"), F.col("c_custkey").cast("string")).alias("id"), F.array(F.lit("d__A"), F.concat(F.lit("p__"), "c_mktsegment")).alias("taxa"), "c_custkey")
    wanted = c.filter("c_custkey % 3 = 0").select(F.concat(F.lit("GB_"), "id").alias("id"))
    return catalog.taxonomy_cells(c.select("id", "taxa"), wanted)


@query("""WITH g AS (SELECT 'GB_GCA_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.1' AS accession, o_orderkey, o_custkey FROM orders), r AS (SELECT o_custkey, min(o_orderkey) AS rep FROM orders WHERE o_orderkey % 11 <> 0 GROUP BY 1)
SELECT accession, CASE WHEN o_orderkey % 11 <> 0 THEN 'GB_GCA_' || lpad(CAST(rep AS VARCHAR), 9, '0') || '.1' END AS representative, o_orderkey % 11 <> 0 AND rep = o_orderkey AS is_representative FROM g LEFT JOIN r USING (o_custkey)""")
def representatives(spark, d):
    o = _t(spark, d, "orders")
    canonical = lambda c: F.concat(F.lit("G"), F.lpad(c.cast("string"), 9, "0"))
    genomes = o.select(F.concat(F.lit("GB_GCA_"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit(".1")).alias("accession"))
    listed = F.concat_ws(", ", F.collect_list(canonical(F.col("o_orderkey"))))
    clusters = o.filter("o_orderkey % 11 <> 0").groupBy("o_custkey").agg(canonical(F.min("o_orderkey")).alias("rep"), listed.alias("members"))
    return catalog.representative_flags(catalog.cluster_members(clusters, genomes, "rep", "members"), genomes)


_FEATURES = ("CDS", "tRNA", "rRNA", "ncRNA", "gene")


@query("""WITH f AS (SELECT l_orderkey AS gid, ['CDS', 'tRNA', 'rRNA', 'ncRNA', 'gene'][CAST(l_suppkey % 5 + 1 AS INT)] AS type, l_linenumber % 2 = 0 AS ssu FROM lineitem WHERE l_orderkey % 4 <> 0)
SELECT o_orderkey AS gid, CASE WHEN count(f.gid) = 0 THEN '' ELSE CAST(count(*) FILTER (type = 'CDS') AS VARCHAR) END AS cds_count, CASE WHEN count(f.gid) = 0 THEN '' ELSE CAST(count(*) FILTER (type = 'tRNA') AS VARCHAR) END AS trna_count,
 CASE WHEN count(f.gid) = 0 THEN '' ELSE CAST(count(*) FILTER (type = 'ncRNA') AS VARCHAR) END AS ncrna_count, CASE WHEN count(f.gid) = 0 THEN '' ELSE CAST(count(*) FILTER (type = 'rRNA') AS VARCHAR) END AS rrna_count,
 CASE WHEN count(f.gid) = 0 THEN '' ELSE CAST(count(*) FILTER (type = 'rRNA' AND ssu) AS VARCHAR) END AS ssu_count FROM orders LEFT JOIN f ON f.gid = o_orderkey GROUP BY 1""")
def feature_counts(spark, d):
    kind = F.element_at(F.array(*map(F.lit, _FEATURES)), (F.col("l_suppkey") % 5 + 1).cast("int"))
    attributes = F.when(F.col("l_linenumber") % 2 == 0, "ID=x;product=16S ribosomal RNA").otherwise("ID=x")
    f = _t(spark, d, "lineitem").filter("l_orderkey % 4 <> 0").select(F.col("l_orderkey").alias("gid"), kind.alias("type"), attributes.alias("attributes"))
    return sequence.feature_counts(f, "gid", _t(spark, d, "orders").select(F.col("o_orderkey").alias("gid")))


@query("""WITH i AS (SELECT l_suppkey % 20 AS gid, l_suppkey AS seq, l_partkey AS s, CAST(l_partkey + l_quantity AS BIGINT) AS e FROM lineitem),
a AS (SELECT *, CASE WHEN s > coalesce(max(e) OVER (PARTITION BY seq ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS nw FROM i), b AS (SELECT *, sum(nw) OVER (PARTITION BY seq ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM a),
c AS (SELECT gid, seq, g, max(e) - min(s) + 1 AS n FROM b GROUP BY 1, 2, 3), u AS (SELECT gid, seq, sum(n) - 1 AS n FROM c GROUP BY 1, 2), t AS (SELECT gid, CAST(sum(n) AS BIGINT) AS coding_bases FROM u GROUP BY 1)
SELECT gid, (SELECT count(*) FROM i WHERE i.gid = t.gid) AS protein_count, coding_bases, 100.0::DOUBLE * coding_bases / (1000000 + gid) AS coding_density FROM t""")
def gene_statistics(spark, d):
    g = _t(spark, d, "lineitem").select((F.col("l_suppkey") % 20).alias("gid"), F.col("l_suppkey").alias("seq"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_quantity")).cast("long").alias("end"))
    return sequence.gene_statistics(g, spark.range(20).select(F.col("id").alias("gid"), (F.col("id") + 1000000).alias("genome_size")), "gid")


_GAPPED = r"regexp_replace(upper(replace(coalesce(text, ''), 'ß', 'x')), '\s', 'NNNNN', 'g')"
_SCAFFOLDS = f"sc AS (SELECT coalesce(source, '') AS gid, {_GAPPED} AS s FROM documents WHERE length({_GAPPED}) > 0), ct AS (SELECT gid, unnest(list_filter(regexp_split_to_array(s, 'N{{5,}}'), lambda x: x <> '')) AS c FROM sc)"


def _scaffolds(spark, d):
    s = F.regexp_replace(F.upper(F.replace(F.coalesce("text", F.lit("")), F.lit("ß"), F.lit("x"))), r"[\t\n\f\r ]", "NNNNN")
    return _t(spark, d, "documents").select(F.coalesce("source", F.lit("")).alias("gid"), s.alias("s")).filter("length(s) > 0")


@query(f"WITH {_SCAFFOLDS} SELECT gid, count(*) AS contigs, CAST(sum(length(c)) AS BIGINT) AS bases, min(c) AS first, max(c) AS last FROM ct GROUP BY 1")
def contig_split(spark, d):
    return sequence.contigs(_scaffolds(spark, d), "gid", "s", 5).groupBy("gid").agg(F.count("*").alias("contigs"), F.sum(F.length("contig")).alias("bases"), F.min("contig").alias("first"), F.max("contig").alias("last"))


def _n50_sql(source: str, size: str, name: str) -> str:
    return f"""{name} AS (SELECT gid, max(n) AS n50, min(many) AS l50 FROM (SELECT gid, {size} AS n, sum({size}) OVER (PARTITION BY gid ORDER BY {size} DESC) AS run, sum({size}) OVER (PARTITION BY gid) AS total, count(*) OVER (PARTITION BY gid ORDER BY {size} DESC) AS many FROM {source}) WHERE run * 2 >= total GROUP BY 1)"""


@query(rf"""WITH {_SCAFFOLDS}, {_n50_sql('sc', 'length(s)', 'ns')}, {_n50_sql('ct', 'length(c)', 'nc')},
a AS (SELECT gid, count(*) AS scaffold_count, CAST(sum(length(s) - length(regexp_replace(s, '[GC]', '', 'g'))) AS BIGINT) AS gc_count, CAST(sum(length(s)) AS BIGINT) AS genome_size, max(length(s)) AS longest_scaffold, CAST(sum(length(regexp_replace(s, '[ACGTU]', '', 'g'))) AS BIGINT) AS odd, CAST(floor(avg(length(s))) AS BIGINT) AS mean_scaffold_length FROM sc GROUP BY 1),
b AS (SELECT gid, count(*) AS contig_count, CAST(sum(length(regexp_replace(c, '[ACGTU]', '', 'g'))) AS BIGINT) AS ambiguous_bases, CAST(floor(avg(length(c))) AS BIGINT) AS mean_contig_length, max(length(c)) AS longest_contig FROM ct GROUP BY 1)
SELECT a.gid, scaffold_count, gc_count, genome_size, longest_scaffold, mean_scaffold_length, contig_count, coalesce(ambiguous_bases, 0) AS ambiguous_bases, mean_contig_length, longest_contig, ns.n50 AS n50_scaffolds, ns.l50 AS l50_scaffolds, nc.n50 AS n50_contigs, nc.l50 AS l50_contigs,
 CASE WHEN genome_size > odd THEN 100.0::DOUBLE * gc_count / (genome_size - odd) END AS gc_percentage, odd - coalesce(ambiguous_bases, 0) AS total_gap_length FROM a LEFT JOIN b USING (gid) LEFT JOIN ns USING (gid) LEFT JOIN nc USING (gid)""")
def nucleotide_statistics(spark, d):
    return sequence.nucleotide_statistics(_scaffolds(spark, d), "gid", "s", 5)


@query("""WITH h AS (SELECT l_orderkey AS gid, l_suppkey AS query, CASE WHEN l_suppkey % 9 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS length, l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey AS ord FROM lineitem), b AS (SELECT * FROM h WHERE length > 0 QUALIFY row_number() OVER (PARTITION BY gid ORDER BY length DESC, ord) = 1),
s AS (SELECT DISTINCT l_orderkey AS gid, l_suppkey AS query, l_suppkey * 10 AS contig_length FROM lineitem WHERE l_suppkey % 7 <> 0) SELECT b.gid, b.query, length, contig_length, (SELECT count(*) FROM s WHERE s.gid = b.gid) AS hits FROM b LEFT JOIN s ON s.gid = b.gid AND s.query = b.query""")
def longest_hits(spark, d):
    l = _t(spark, d, "lineitem")  # noqa: E741
    hits = l.select(F.col("l_orderkey").alias("gid"), F.col("l_suppkey").alias("query"), F.when(F.col("l_suppkey") % 9 == 0, 0).otherwise(F.col("l_quantity").cast("long")).alias("length"), F.expr(_ORD).alias("ord"))
    summary = l.filter("l_suppkey % 7 <> 0").select(F.col("l_orderkey").alias("gid"), F.col("l_suppkey").alias("query"), (F.col("l_suppkey") * 10).alias("contig_length")).distinct()
    return sequence.longest_hits(hits, summary, "gid")


@query("SELECT l_orderkey AS query, l_suppkey AS subject, l_discount AS identity, s_name AS taxonomy FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey) = 1) JOIN supplier ON s_suppkey = l_suppkey")
def classified_hits(spark, d):
    hits = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("query"), F.col("l_suppkey").alias("subject"), F.col("l_discount").alias("identity"), F.expr(_ORD).alias("ord"))
    return sequence.classified_hits(hits, _t(spark, d, "supplier").select(F.col("s_suppkey").alias("subject"), F.col("s_name").alias("taxonomy")))


@query()
def rrna_best_hits(spark, d):
    """Order-dependent folds have no SQL; the tests compare them with a plain version."""
    l = _t(spark, d, "lineitem")  # noqa: E741
    model = F.element_at(F.array(*map(F.lit, ("ar", "bac", "euk"))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    hits = l.select(F.col("l_suppkey").alias("seq"), model.alias("model"), (F.col("l_orderkey") * 100 + F.expr(_ORD) % 97).alias("ord"), (F.col("l_partkey") * 3).alias("start"), (F.col("l_partkey") * 3 + F.col("l_quantity") * 9).cast("long").alias("end"), (F.col("l_suppkey") % 2 == 0).alias("reverse"))
    return sequence.best_hits(hits, ("ar", "bac", "euk"), 80)
