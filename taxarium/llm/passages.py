"""Windows of documents that share shingles with a reference table, in DataFrame operations only.

Shared by benchmark decontamination and license scans.  A window of a document without one
shingle of the reference has similarity zero with all of it, so only windows that hold a reference
shingle go on; they are found by an equi-join of shingle hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_key, words

#: Words of a shingle, and reference rows up to which their table is broadcast.
SHINGLE, BROADCAST_ROWS = 5, 200_000


def text_words(df: DataFrame, *keep: Column) -> DataFrame:
    """The kept columns and ``w``, the lower-case words of the whole text (null: none)."""
    return df.select(*keep, words(F.lower(F.coalesce("text", F.lit("")))).alias("w"))


def once(value: Column, use) -> Column:
    """use(value) with the value computed once a row: Catalyst would else copy it into every lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles(w: str, size: int) -> Column:
    """Hashes of each run of ``size`` words."""
    none = F.array().cast("array<long>")
    each = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(size))))
    return once(F.col(w), lambda w: F.when(F.size(w) >= size, each(w)).otherwise(none))


def numbered(sh: Column) -> Column:
    """The shingles as a set: repeats are told apart by how many equal ones stand before them."""
    apart = lambda s: F.transform(s, lambda x, i: F.xxhash64(x, F.size(F.filter(F.slice(s, F.lit(1), i), lambda y: y == x))))
    return once(sh, lambda s: F.when(F.size(F.array_distinct(s)) == F.size(s), s).otherwise(apart(s)))


def reference(table: DataFrame, key: str) -> DataFrame:
    """key, n (words), k (words of a shingle: SHINGLE, or all of a shorter text), sh.  Rows without words or key are left out: nothing can match them."""
    base = text_words(table.filter(F.col(key).isNotNull()), F.col(key)).withColumn("n", F.size("w")).filter("n > 0").withColumn("k", F.least("n", F.lit(SHINGLE)))
    by_size = F.when(F.col("k") == SHINGLE, shingles("w", SHINGLE))
    for size in range(1, SHINGLE):
        by_size = by_size.when(F.col("k") == size, shingles("w", size))
    return base.select(key, "n", "k", by_size.alias("sh"))


def document_key() -> list[Column]:
    """_id and a hash of the text: rows that repeat both give one result."""
    return [id_key().alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_x")]


def hits(docs: DataFrame, ref: DataFrame) -> DataFrame:
    """_id, _x, m, at, n, k, off: places of documents of m words with a reference shingle, and its offset in texts of n words."""
    marks = ref.select("n", "k", F.posexplode("sh").alias("off", "h")).distinct()
    small = marks.count() <= BROADCAST_ROWS
    sizes = sorted(r["k"] for r in ref.select("k").distinct().collect())  # one to SHINGLE at most
    tokens = text_words(docs, *document_key())
    out = None
    for k in sizes:
        here = tokens.select("_id", "_x", F.size("w").alias("m"), shingles("w", k).alias("sh")).select("_id", "_x", "m", F.posexplode("sh").alias("at", "h"))
        own = marks.filter(F.col("k") == k)
        found = here.join(F.broadcast(own) if small else own, "h").drop("h")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "_id long, _x long, m int, at int, n int, k int, off int")


def marked_places(docs: DataFrame, ref: DataFrame) -> DataFrame:
    """_id, _x, m, n, k, p: for documents of m words, the ascending places of shingles that some text of n words holds.

    The list is as long as the document at most.
    """
    marks = ref.select("n", "k", F.explode("sh").alias("h")).distinct()
    small = marks.count() <= BROADCAST_ROWS
    sizes = sorted(r["k"] for r in ref.select("k").distinct().collect())  # one to SHINGLE at most
    tokens = text_words(docs, *document_key())
    out = None
    for k in sizes:
        here = tokens.select("_id", "_x", F.size("w").alias("m"), shingles("w", k).alias("sh")).select("_id", "_x", "m", F.posexplode("sh").alias("at", "h"))
        own = marks.filter(F.col("k") == k)
        found = here.join(F.broadcast(own) if small else own, "h").drop("h")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "_id long, _x long, m int, n int, k int, p array<int>")
    return out.groupBy("_id", "_x", "m", "n", "k").agg(F.array_sort(F.collect_set("at")).alias("p"))


def window_shingles(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """windows (_id, _x, start, n, k, span) that lie in their document, with ``sh``: hashes of the shingles of words start to start + span.

    Only texts of documents with windows are shuffled; their keys are broadcast up to BROADCAST_ROWS.
    """
    lists = windows.groupBy("_id", "_x").agg(F.collect_set(F.struct("start", "n", "k", "span")).alias("v"))
    held = windows.select("_id", "_x").distinct()
    small = held.count() <= BROADCAST_ROWS
    rows = docs.select(*document_key(), "text").join(F.broadcast(held) if small else held, ["_id", "_x"], "left_semi").dropDuplicates(["_id", "_x"])
    rows = text_words(rows, F.col("_id"), F.col("_x")).join(lists, ["_id", "_x"])
    used = F.transform("v", lambda v: v["k"])
    hashed = rows.select("_id", "_x", "v", F.size("w").alias("m"), *(F.when(F.array_contains(used, k), shingles("w", k)).alias(f"s{k}") for k in range(1, SHINGLE + 1)))
    one = hashed.select("*", F.explode("v").alias("x")).select("_id", "_x", "m", "x.*", *(f"s{k}" for k in range(1, SHINGLE + 1)))
    cut = F.when(F.col("k") == SHINGLE, _slice(f"s{SHINGLE}", SHINGLE))
    for k in range(1, SHINGLE):
        cut = cut.when(F.col("k") == k, _slice(f"s{k}", k))
    return one.select("_id", "_x", "start", "n", "k", "span", cut.alias("sh")).filter(F.size("sh") > 0)


def _slice(column: str, k: int) -> Column:
    return F.slice(F.col(column), F.col("start") + 1, F.greatest(F.least(F.col("span"), F.col("m") - F.col("start")) - (k - 1), F.lit(0)))
