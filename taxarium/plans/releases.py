"""Registered queries over releases, mirrors and representatives, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compare, curation, tophit
from .registry import _CUR, _PREV, _cur, _prev, _t, query

_OLD = """old AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'U_' || o_orderkey ELSE 'RS_' || o_orderkey END AS gid, CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE CAST(o_custkey % 5 AS VARCHAR) END AS ncbi_cds_count, CAST(o_totalprice AS VARCHAR) AS gc_percentage,
 CASE WHEN o_orderkey % 6 = 0 THEN 'none' ELSE CAST(2000 + o_custkey % 20 AS VARCHAR) || '-' || CAST(1 + o_orderkey % 12 AS VARCHAR) || '-07' END AS ncbi_date, CASE WHEN o_orderkey % 4 = 0 THEN 'na' ELSE o_orderstatus END AS note, 'x' AS gone FROM orders)"""
_NEW = """new AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'U_' || o_orderkey ELSE 'RS_' || o_orderkey END AS gid, CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE CAST(o_custkey % 4 AS VARCHAR) END AS ncbi_cds_count, CAST(o_totalprice + 0.0000001 AS VARCHAR) AS gc_percentage,
 CASE WHEN o_orderkey % 6 = 0 THEN 'none' ELSE CAST(2000 + o_custkey % 20 AS VARCHAR) || '-' || lpad(CAST(1 + o_orderkey % 12 AS VARCHAR), 2, '0') || '-' || CASE WHEN o_orderkey % 5 = 0 THEN '08' ELSE '7' END END AS ncbi_date, CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' WHEN o_orderkey % 9 = 0 THEN 'Z' ELSE o_orderstatus END AS note, 'y' AS fresh FROM orders WHERE o_orderkey % 7 <> 0)"""


def _old_new(spark, d):
    o, k = _t(spark, d, "orders"), F.col("o_orderkey")
    gid = F.concat(F.when(k % 13 == 0, "U_").otherwise("RS_"), k.cast("string"))
    year, month = (2000 + F.col("o_custkey") % 20).cast("string"), (1 + k % 12).cast("string")
    count = lambda zero, n: F.when(k % 3 == 0, zero).otherwise((F.col("o_custkey") % n).cast("string"))
    old = o.select(
        gid.alias("gid"), count("none", 5).alias("ncbi_cds_count"), F.col("o_totalprice").cast("string").alias("gc_percentage"), F.when(k % 6 == 0, "none").otherwise(F.concat_ws("-", year, month, F.lit("07"))).alias("ncbi_date"),
        F.when(k % 4 == 0, "na").otherwise(F.col("o_orderstatus")).alias("note"), F.lit("x").alias("gone"),
    )
    new = o.filter(k % 7 != 0).select(
        gid.alias("gid"), count("0", 4).alias("ncbi_cds_count"), (F.col("o_totalprice") + 0.0000001).cast("string").alias("gc_percentage"),
        F.when(k % 6 == 0, "none").otherwise(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.when(k % 5 == 0, "08").otherwise("7"))).alias("ncbi_date"),
        F.when(k % 4 == 0, "n/a").when(k % 9 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("note"), F.lit("y").alias("fresh"),
    )
    return old, new


_NORMAL = """SELECT gid, CASE WHEN ncbi_cds_count = 'none' THEN '0' ELSE ncbi_cds_count END AS ncbi_cds_count, round_even(CAST(gc_percentage AS DOUBLE), 5) AS gc_percentage,
 CASE WHEN ncbi_date = 'none' THEN 'none' ELSE strftime(strptime(ncbi_date, '%Y-%m-%d'), '%Y-%m-%d') END AS ncbi_date, CASE WHEN note IN ('na', 'n/a') THEN 'n/a' ELSE note END AS note"""


@query(f"""WITH {_OLD}, {_NEW}, a AS ({_NORMAL} FROM old WHERE NOT starts_with(gid, 'U_')), b AS ({_NORMAL} FROM new),
j AS (SELECT a.ncbi_cds_count <> b.ncbi_cds_count AS c1, a.gc_percentage <> b.gc_percentage AS c2, a.ncbi_date <> b.ncbi_date AS c3, a.note <> b.note AS c4 FROM a JOIN b USING (gid)),
u AS (SELECT unnest(['ncbi_cds_count', 'gc_percentage', 'ncbi_date', 'note']) AS "column", unnest([c1, c2, c3, c4]) AS c FROM j)
SELECT "column", round_even(100.0::DOUBLE * count(*) FILTER (c) / count(*), 2) AS percent_changed, count(*) AS compared FROM u GROUP BY 1""")
def release_overview(spark, d):
    return compare.release_overview(*_old_new(spark, d), "gid")


@query("SELECT * FROM (VALUES ('gone', 'deprecated'), ('fresh', 'new')) t(\"column\", change)")
def column_changes(spark, d):
    return compare.column_changes(*_old_new(spark, d))


@query("SELECT k, coalesce(c.name, '') AS c_only, coalesce(s_name, '') AS name FROM (SELECT c_custkey AS k, c_name AS name FROM customer) c FULL JOIN (SELECT s_suppkey * 3 AS k, s_name FROM supplier) s USING (k)")
def full_outer_tables(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("c_only"), F.lit("lost").alias("name"))
    return compare.outer_tables([c, _t(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("k"), F.col("s_name").alias("name"))], "k")


@query(f"""WITH {_PREV}, {_CUR}, a AS (SELECT DISTINCT gid FROM prev), b AS (SELECT DISTINCT gid FROM cur), s AS (SELECT gid, min(status) AS species FROM cur WHERE status <> 'P' GROUP BY 1)
SELECT gid, 'deleted' AS status, NULL AS species FROM a WHERE gid NOT IN (SELECT gid FROM b) UNION ALL SELECT b.gid, 'added', coalesce(species, 'N/A') FROM b LEFT JOIN s USING (gid) WHERE gid NOT IN (SELECT gid FROM a)""")
def release_clean_up(spark, d):
    cur = _cur(spark, d)
    species = cur.filter("status <> 'P'").groupBy("gid").agg(F.min("status").alias("species"))
    return compare.clean_up(_prev(spark, d), cur, "gid", species)


_ACC = "CASE WHEN o_custkey % 2 = 0 THEN 'GCF_' ELSE 'GCA_' END || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.1'"
_MIRROR = f"""o AS (SELECT {_ACC} AS acc, CASE WHEN o_orderkey % 5 = 0 THEN 'replaced' ELSE 'latest' END AS version_status, CASE WHEN o_orderkey % 8 = 0 THEN 'from a surveillance project' END AS note, '/new/' || o_orderkey AS path,
 o_orderkey % 10 <> 0 AS held, o_orderkey % 7 <> 0 AS listed, o_orderkey % 4 = 0 AS paired FROM orders)"""


def _mirror(spark, d):
    k = F.col("o_orderkey")
    acc = F.concat(F.when(F.col("o_custkey") % 2 == 0, "GCF_").otherwise("GCA_"), F.lpad(k.cast("string"), 9, "0"), F.lit(".1"))
    return _t(spark, d, "orders").select(
        acc.alias("acc"), F.when(k % 5 == 0, "replaced").otherwise("latest").alias("version_status"), F.when(k % 8 == 0, "from a surveillance project").alias("note"), F.concat(F.lit("/new/"), k.cast("string")).alias("path"),
        (k % 10 != 0).alias("held"), (k % 7 != 0).alias("listed"), (k % 4 == 0).alias("paired"),
    )


@query(f"""WITH {_MIRROR}, e AS (SELECT acc, replace(path, 'new', 'old') AS path FROM o WHERE held AND starts_with(acc, 'GCF')), n AS (SELECT acc, path FROM o WHERE listed AND starts_with(acc, 'GCF') AND version_status = 'latest')
SELECT acc, coalesce(n.path, e.path) AS path, CASE WHEN e.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' ELSE 'compare' END AS status FROM e FULL JOIN n USING (acc)""")
def mirror_update(spark, d):
    o = _mirror(spark, d)
    held = o.filter("held and acc like 'GCF%'").select("acc", F.replace("path", F.lit("new"), F.lit("old")).alias("path"))
    return compare.mirror_update(held, o.select("acc", "version_status"), o.filter("listed").select("acc", "path"), "acc")


@query(f"WITH {_MIRROR} SELECT acc, version_status, note FROM o WHERE version_status = 'latest' AND NOT contains(coalesce(note, ''), 'surveillance') AND 'G' || substr(acc, 5, 9) NOT IN (SELECT 'G' || substr(acc, 5, 9) FROM o WHERE paired)")
def unpaired_assemblies(spark, d):
    o = _mirror(spark, d)
    held = o.filter("paired").select(F.concat(F.lit("G"), F.substring("acc", 5, 9)).alias("gid"))
    return compare.unpaired(o.select("acc", "version_status", "note"), "acc", held, "gid")


@query("SELECT o_orderkey, md5(o_orderstatus) AS checksum FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0")
def stale_results(spark, d):
    rows = _t(spark, d, "orders").select("o_orderkey", F.md5(F.col("o_orderstatus").cast("binary")).alias("checksum"))
    stored = rows.filter("o_orderkey % 3 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "other").otherwise(F.col("checksum")).alias("checksum"))
    return compare.stale(rows, "o_orderkey", "checksum", stored)


@query("SELECT o_orderkey, o_custkey % 3 AS value_a, o_orderkey % 3 AS value_b FROM orders WHERE o_custkey % 4 <> 0 AND o_custkey % 3 <> o_orderkey % 3")
def table_disagreements(spark, d):
    o = _t(spark, d, "orders")
    a = o.select("o_orderkey", F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey") % 3).alias("v"))
    return compare.disagreements(a, o.select("o_orderkey", (F.col("o_orderkey") % 3).alias("v")), "o_orderkey", "v")


@query("SELECT c_custkey AS k, coalesce(s_name, 'N/A') AS name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def lookup_with_default(spark, d):
    return compare.lookup(_t(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k", _t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), "name", "N/A")


_MOVED = """b AS (SELECT DISTINCT gid FROM cur), l AS (SELECT gid AS f, regexp_replace(split_part(gid, '.', 1), '^(RS_GCF|GB_GCA)', '') AS base, CAST(split_part(gid, '.', 2) AS INT) AS n FROM prev WHERE gid NOT IN (SELECT gid FROM b)),
c AS (SELECT gid, regexp_replace(split_part(gid, '.', 1), '^(RS_GCF|GB_GCA)', '') AS base, CAST(split_part(gid, '.', 2) AS INT) AS v FROM b),
m AS (SELECT gid, n, f, CASE WHEN split_part(gid, '.', 1) = split_part(f, '.', 1) THEN 'same' WHEN starts_with(gid, 'RS') THEN 'moved_to_refseq' ELSE 'moved_to_genbank' END AS move FROM c JOIN l USING (base) WHERE n BETWEEN 1 AND v + 4
 QUALIFY row_number() OVER (PARTITION BY gid, n ORDER BY CASE WHEN split_part(gid, '.', 1) = split_part(f, '.', 1) THEN 0 ELSE 1 END) = 1)"""


@query(f"WITH {_PREV}, {_CUR}, {_MOVED} SELECT gid, priority FROM prev WHERE gid IN (SELECT gid FROM b) UNION ALL SELECT m.gid, p.priority FROM m JOIN prev p ON p.gid = f")
def propagated_lineages(spark, d):
    return compare.propagate(_prev(spark, d), _cur(spark, d), "gid", "priority")


@query(f"WITH {_PREV}, {_CUR}, {_MOVED}, r AS (SELECT gid FROM prev WHERE status = 'F'), k AS (SELECT gid FROM r UNION SELECT m.gid FROM m JOIN r ON r.gid = f) SELECT gid, gid IN (SELECT gid FROM k) AS is_rep FROM b")
def propagated_representatives(spark, d):
    return compare.representatives(_prev(spark, d).withColumn("is_rep", F.col("status") == "F"), _cur(spark, d), "gid", "is_rep")


@query(f"""WITH {_PREV}, {_CUR}, {_MOVED}, w AS (SELECT f, arg_min(move, CASE WHEN move = 'same' THEN 0 ELSE 1 END) AS move FROM m GROUP BY 1),
x AS (SELECT CASE WHEN p.gid IN (SELECT gid FROM b) THEN 'retained' WHEN move = 'same' THEN 'new version' ELSE coalesce(move, 'absent') END AS fate, status = 'F' AS rep FROM prev p LEFT JOIN w ON f = p.gid)
SELECT fate, count(*) AS genomes, round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percent, count(*) FILTER (rep) AS representatives FROM x GROUP BY 1""")
def propagation_report(spark, d):
    return compare.propagation_report(_prev(spark, d).withColumn("is_rep", F.col("status") == "F"), _cur(spark, d), "gid", "is_rep")


_KINDS = "['fasta', 'protein', 'extra_fasta', 'other', 'report', 'report', 'report']"
_FILES = f"""f AS (SELECT DISTINCT l_orderkey AS gid, {_KINDS}[CAST(l_linenumber AS INT)] AS kind, CASE WHEN l_linenumber = 7 THEN 'hashes' ELSE CAST(l_linenumber AS VARCHAR) END AS name, l_linenumber AS n FROM lineitem),
a AS (SELECT gid, kind, name, CAST(n AS VARCHAR) AS hash FROM f WHERE gid % 13 <> 0 AND NOT (gid % 11 = 0 AND n = 7) AND NOT (gid % 17 = 0 AND n = 5)),
z AS (SELECT gid, kind, name, CASE WHEN (gid + n) % 9 = 0 THEN 'changed' ELSE CAST(n AS VARCHAR) END AS hash FROM f WHERE (gid + 2 * n) % 19 <> 0 AND NOT (gid % 23 = 0 AND n = 7))"""


def _files(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("fasta", "protein", "extra_fasta", "other", "report", "report", "report"))), F.col("n").cast("int"))
    f = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("gid"), F.col("l_linenumber").alias("n")).distinct()
    f = f.select("gid", "n", kind.alias("kind"), F.when(F.col("n") == 7, "hashes").otherwise(F.col("n").cast("string")).alias("name"))
    a = f.filter("gid % 13 <> 0 and not (gid % 11 = 0 and n = 7) and not (gid % 17 = 0 and n = 5)").select("gid", "kind", "name", F.col("n").cast("string").alias("hash"))
    z = f.filter("(gid + 2 * n) % 19 <> 0 and not (gid % 23 = 0 and n = 7)").select("gid", "kind", "name", F.when((F.col("gid") + F.col("n")) % 9 == 0, "changed").otherwise(F.col("n").cast("string")).alias("hash"))
    return a, z


@query(f"""WITH {_FILES}, j AS (SELECT gid, kind, name, a.hash AS x, z.hash AS y FROM a FULL JOIN z USING (gid, kind, name)), w AS (SELECT gid FROM a INTERSECT SELECT gid FROM z),
c AS (SELECT gid, coalesce(bool_or(kind = 'fasta' AND (x IS NULL OR y IS NULL)), false) AS inc, coalesce(bool_or(kind = 'fasta' AND y IS DISTINCT FROM x AND y IS NOT NULL), false) AS mo,
 coalesce(bool_or(kind = 'protein' AND y IS NOT NULL AND y IS DISTINCT FROM x), false) AS pr, coalesce(bool_or(kind = 'extra_fasta' AND y IS NOT NULL AND y IS DISTINCT FROM x), false) AS ex,
 coalesce(bool_or((kind = 'other' AND y IS NOT NULL AND y IS DISTINCT FROM x) OR (kind = 'report' AND x <> y)), false) AS me, coalesce(bool_or(kind = 'report'), false) AND NOT coalesce(bool_or(kind = 'report' AND name = 'hashes'), false) AS od,
 coalesce(bool_or(kind = 'report' AND name = 'hashes' AND x IS NULL), false) AS nh, coalesce(bool_or(kind = 'report' AND (x IS NULL OR y IS NULL) AND NOT (name = 'hashes' AND x IS NULL)), false) AS cu FROM j WHERE gid IN (SELECT gid FROM w) GROUP BY 1)
SELECT gid, CASE WHEN inc THEN 'incomplete' WHEN mo THEN 'modified' ELSE array_to_string(list_sort(list_filter([CASE WHEN gid % 5 <> 0 THEN 'unmodified' END, CASE WHEN pr THEN 'new_protein' END, CASE WHEN ex THEN 'new_cds_rna' END, CASE WHEN me THEN 'new_metadata' END,
 CASE WHEN od THEN 'old_folder_dir' END, CASE WHEN nh THEN 'new_hashes' END, CASE WHEN cu THEN 'to_curate' END], lambda s: s IS NOT NULL)), ';') END AS status FROM c""")
def folder_status(spark, d):
    a, z = _files(spark, d)
    called = _t(spark, d, "orders").filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("gid"))
    return compare.folder_status(a, z, "gid", called).withColumn("status", F.concat_ws(";", "status"))


_MARKERS = "m AS (SELECT DISTINCT l_orderkey AS gid, l_suppkey % 10 AS marker, l_returnflag = 'A' AS bacterial, CASE WHEN l_linenumber % 5 = 0 THEN '' ELSE '1e-5' END AS evalue FROM lineitem WHERE l_returnflag <> 'N')"


@query(f"""WITH {_MARKERS}, c AS (SELECT gid, count(*) FILTER (bacterial) AS b, count(*) FILTER (NOT bacterial) AS a FROM m WHERE evalue <> '' GROUP BY 1),
g AS (SELECT o_orderkey AS gid, CASE o_custkey % 3 WHEN 0 THEN 'd__Bacteria' WHEN 1 THEN 'd__Archaea' END AS known, CASE o_orderkey % 4 WHEN 0 THEN 'd__Bacteria' WHEN 1 THEN 'd__' END AS domain FROM orders),
p AS (SELECT gid, known, 100.0::DOUBLE * coalesce(b, 0) / 9 AS b, 100.0::DOUBLE * coalesce(a, 0) / 8 AS a FROM g LEFT JOIN c USING (gid) WHERE (domain IS NULL OR domain = 'd__') AND known IS NOT NULL),
v AS (SELECT gid, known, CASE WHEN a < 13 AND b < 13 THEN NULL WHEN b >= a THEN 'd__Bacteria' ELSE 'd__Archaea' END AS vote FROM p)
SELECT gid, coalesce(vote, known) AS domain FROM v WHERE vote IS NULL OR vote <> known""")
def domain_vote(spark, d):
    line = _t(spark, d, "lineitem").filter("l_returnflag <> 'N'")
    m = line.select(F.col("l_orderkey").alias("gid"), (F.col("l_suppkey") % 10).alias("marker"), (F.col("l_returnflag") == "A").alias("bacterial"), F.when(F.col("l_linenumber") % 5 == 0, "").otherwise("1e-5").alias("evalue")).distinct()
    c, k = F.col("o_custkey") % 3, F.col("o_orderkey") % 4
    g = _t(spark, d, "orders").select(F.col("o_orderkey").alias("gid"), F.when(c == 0, "d__Bacteria").when(c == 1, "d__Archaea").alias("known"), F.when(k == 0, "d__Bacteria").when(k == 1, "d__").alias("domain"))
    return tophit.domain_vote(g, m, "gid", (9, 8), least=13.0)


@query("""WITH h AS (SELECT l_orderkey AS gene, l_suppkey % 20 AS family, l_extendedprice AS score, l_linenumber AS ord FROM lineitem), b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY gene, family ORDER BY score DESC, ord) = 1)
SELECT gene, string_agg(family || ',' || ord, ';' ORDER BY family) AS hits FROM b GROUP BY 1""")
def hit_lists(spark, d):
    h = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("gene"), (F.col("l_suppkey") % 20).alias("family"), F.col("l_extendedprice").alias("score"), F.col("l_linenumber").alias("ord"))
    return tophit.hit_lists(h, "gene", "family", F.col("score"), F.col("ord"), ["ord"])


_CANON = "'G' || substr(split_part(gid, '.', 1), 8)"


@query(f"WITH {_PREV}, {_CUR} SELECT DISTINCT {_CANON} AS gid FROM cur WHERE status = 'F' INTERSECT SELECT {_CANON} FROM cur WHERE path <> '7' EXCEPT SELECT {_CANON} FROM prev WHERE status = 'F' AND path NOT IN ('9', '11')")
def curation_new_reps(spark, d):
    return curation.new_representatives(_cur(spark, d).filter("status = 'F'"), _prev(spark, d).filter("status = 'F' and path not in ('9', '11')"), _cur(spark, d).filter("path <> '7'"), "gid")


@query("SELECT DISTINCT c_custkey AS id FROM customer WHERE 'n' || c_nationkey IN (SELECT 'n' || n_nationkey FROM nation WHERE n_nationkey % 3 = 0) OR 'm' || c_mktsegment = 'mBUILDING'")
def curation_poly(spark, d):
    c = _t(spark, d, "customer")
    members = c.select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("taxon"), F.col("c_custkey").alias("id")).union(c.select(F.concat(F.lit("m"), "c_mktsegment"), "c_custkey"))
    table = _t(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("taxon"), F.when(F.col("n_nationkey") % 3 == 0, 0.5).otherwise(1.0).alias("f_measure"))
    return curation.polyphyletic(table.union(spark.createDataFrame([("mBUILDING", 0.99), ("mMACHINERY", 1.0)], "taxon string, f_measure double")), members)


@query("""WITH t AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE 0.5 END AS f, 'GB_GCA_' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '.1' AS a, CASE WHEN o_orderkey % 4 = 0 THEN 'D-' || o_custkey ELSE 'U_' || o_custkey END AS b FROM orders)
SELECT DISTINCT 'G' || substr(a, 8, 9) AS id FROM t WHERE f < 1 UNION SELECT DISTINCT b FROM t WHERE f < 1 AND NOT starts_with(b, 'D-')""")
def curation_rogues(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    a, b = F.concat(F.lit("GB_GCA_"), F.lpad(c, 9, "0"), F.lit(".1")), F.concat(F.when(k % 4 == 0, "D-").otherwise("U_"), c)
    table = _t(spark, d, "orders").select(F.when(k % 3 == 0, 1.0).otherwise(0.5).alias("f_measure"), F.concat(a, F.lit(", "), b).alias("rogue_in"), F.lit("").alias("rogue_out"))
    return curation.rogues(table)
