"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Within a source every document is expected ``target / source_size`` times.  Documents are ordered
by size class, a spread of their ids, size and id; the prefix sum of expected copies plus one
offset per source crosses an integer once per copy.  Prefix sums run in three steps: over the
size classes of a source, over the cells (source, size class, spread) of a class, then within a
cell, so that a hot source is spread out.  The cells are a written table, from which the sizes of
the sources come as well; the texts are read twice, for the cells and for the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, packed

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SPREAD = 256
_WORD = r"[^\x20\x09-\x0D]+"


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("__size")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source key (_source): source_size, target, rate, offset.

    Sources by code point, null last, weigh 3, 1, 2, repeating.  A target stops at CAP times its
    source; the excess is reshared by weight, which is water-filling: by ascending cap per weight,
    a source is full when its cap is at most its share of what remains.
    """
    totals = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc())
    weights = F.array(*map(F.lit, WEIGHTS))
    s = totals.withColumn("w", F.get(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS)).cast("long")).withColumn("cap", F.col("source_size") * CAP)
    filling = Window.orderBy(F.col("cap") / F.col("w"), "_source")
    before, everything = filling.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    s = s.select("*", F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"), F.sum("w").over(everything).alias("w_all"), (F.sum("source_size").over(everything) * F.lit(SHARE)).alias("total"))
    s = s.withColumn("full", F.col("cap") * (F.col("w_all") - F.col("w_before")) <= F.col("w") * (F.col("total") - F.col("cap_before")))
    s = s.select("*", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0)).alias("cap_full"), F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(everything), F.lit(0)).alias("w_full"))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * ((F.col("total") - F.col("cap_full")) / F.nullif(F.col("w_all") - F.col("w_full"), F.lit(0))))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit("mix-42-"), F.col("_source"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    s = s.withColumn("target", target)
    return s.select("_source", "source_size", "target", F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0)).alias("rate"), offset.alias("offset"))


def _ranked(docs: DataFrame) -> DataFrame:
    """row (docs as a struct), __size, __source_size, __target, __copies."""
    source = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    bits = F.length(F.bin("__size"))
    spread = F.pmod(F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(1000003)) * 7919, F.lit(SPREAD))
    rows = packed(docs, source.alias("_source"), "doc_id", _size())
    rows = rows.withColumn("_class", bits * 16 + F.expr("shiftright(__size, cast(greatest(length(bin(__size)) - 5, 0) as int)) & 15")).withColumn("_spread", spread)
    cell = ["_source", "_class", "_spread"]
    # At most classes x SPREAD cells a source, whatever the number of documents.
    cells = Scratch(docs.sparkSession, "mix").save(rows.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("__size").alias("size")))
    targets = source_targets(cells)
    earlier = lambda group, order: Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda group, order: F.coalesce(F.sum("n").over(earlier(group, order)), F.lit(0))
    classes = cells.groupBy("_source", "_class").agg(F.sum("n").alias("n"))
    classes = classes.select("_source", "_class", before(["_source"], "_class").alias("in_classes"))
    cells = cells.select(*cell, before(["_source", "_class"], "_spread").alias("in_class")).join(classes, ["_source", "_class"])
    cells = cells.select(*cell, (F.col("in_classes") + F.col("in_class")).alias("__before"))
    cells = cells.join(targets.toDF("_source", "__source_size", "__target", "__rate", "__offset"), "_source")
    within = Window.partitionBy(*cell).orderBy("__size", "doc_id")
    ranked = rows.withColumn("__rank", F.row_number().over(within)).join(cells, cell)
    last = (F.col("__before") + F.col("__rank")).cast("double")
    crossed = F.floor(F.col("__offset") + F.col("__rate") * last) - F.floor(F.col("__offset") + F.col("__rate") * (last - 1))
    return ranked.withColumn("__copies", crossed.cast("int"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents with size, source_size, target, copies: how often the mix holds each row.

    Null texts have size 0, null sources form one source, null ids count as 0 in the order.
    Columns of docs with these four names are replaced.
    """
    new = ("size", "source_size", "target", "copies")
    kept = docs.select([c for c in docs.columns if c not in new])
    return _ranked(kept).select("row.*", *(F.col(f"__{c}").alias(c) for c in new))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: each document once per copy, with the columns of docs, whatever their names.

    Repeated rows are documents of their own; an empty table gives an empty one.
    """
    return _ranked(docs).filter("__copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
t AS (SELECT sk, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY sk),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY sk) - 1) % 3] AS w, 2 * source_size AS cap FROM t),
f AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before, sum(w) OVER () AS w_all,
             CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total
      FROM w WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / w, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, cap * (w_all - w_before) <= w * (total - cap_before) AS full_up FROM f),
h AS (SELECT *, coalesce(sum(CASE WHEN full_up THEN cap END) OVER (), 0) AS cap_full, coalesce(sum(CASE WHEN full_up THEN w END) OVER (), 0) AS w_full FROM g),
s AS (SELECT sk, source_size, CASE WHEN full_up THEN CAST(cap AS DOUBLE) ELSE w * ((total - cap_full) / CAST(w_all - w_full AS DOUBLE)) END AS target,
             CAST(('0x' || substr(md5('mix-42-' || sk), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM h),
r AS (SELECT d.*, source_size, target, u, coalesce(target / nullif(CAST(source_size AS DOUBLE), 0), 0) AS rate,
             CAST(row_number() OVER (PARTITION BY d.sk ORDER BY length(bin(size)) * 16 + ((size >> greatest(length(bin(size)) - 5, 0)) & 15),
               ((((coalesce(doc_id, 0) % 1000003 + 1000003) % 1000003) * 7919) % 256), size, doc_id NULLS FIRST) AS DOUBLE) AS k
      FROM d JOIN s ON d.sk = s.sk)
SELECT doc_id, size, source_size, target, CAST(size * (floor(u + rate * k) - floor(u + rate * (k - 1))) AS BIGINT) AS taken FROM r
"""
