"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame operations only.

Windows as long as a benchmark item get a 64-bit SimHash of their shingles.  A multi-index over
the items' fingerprints holds every block value within RADIUS // BLOCKS flipped bits, so by the
pigeonhole principle each fingerprint within RADIUS bits shares an entry; weighted Jaccard
similarity of shingle counts then verifies candidates exactly.

Every window of a document counts, wherever it starts; a document shorter than the item is one
window.  A window of similarity 0.8 holds eight ninths of the item's shingles (see ``needed``), so
windows with fewer shingles of items of that length get no fingerprint, and of the others those that begin
with such a shingle, and the last of the document, suffice: moving any other window on by a word
only adds shingles.  At a similarity of 0.8 two fingerprints differ in 10 bits of 64, with a
deviation of 3; windows beyond RADIUS are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_back, packed
from .passages import document_key, marked_places, numbered, once, reference, window_shingles

RADIUS, BLOCKS, THRESHOLD = 19, 4, 0.8
WIDTH = 64 // BLOCKS


def simhash(sh: Column) -> Column:
    """A bit is 1 if set in over half of the shingle hashes, repeats included."""
    zero = F.lit(0).cast("long")
    bit = lambda s, b: F.size(F.filter(s, lambda h: F.call_function("shiftright", h, b).bitwiseAND(1) == 1)) * 2 > F.size(s)
    mark = lambda s, b: F.when(bit(s, b), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(zero)
    return once(sh, lambda s: F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, lambda acc, b: acc.bitwiseOR(mark(s, b))))


def blocks(fp: str) -> Column:
    """Array of (block number, value)."""
    return F.array(*(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, WIDTH * i).bitwiseAND((1 << WIDTH) - 1).alias("value")) for i in range(BLOCKS)))


def needed(a: Column, b: Column, threshold: float) -> Column:
    """The shingles that sets of a and b shingles share at least at that Jaccard similarity."""
    # Rounding may only ask for less.
    return F.ceil((a + b) * threshold / (1 + threshold) - 1e-6).cast("int")


def starts(p: Column, threshold: float) -> Column:
    """Where the windows of n words begin that hold enough of the places p of a document of m words, one at least for each best window."""
    n, m, k = F.col("n"), F.col("m"), F.col("k")
    least = needed(n - k + 1, n - k + 1, threshold)
    begins = lambda p: F.transform(F.filter(F.sequence(F.lit(0), F.size(p) - least), lambda i: F.get(p, i + least - 1) - F.get(p, i) <= n - k), lambda i: F.least(F.get(p, i), m - n))
    whole = F.when(F.size(p) >= needed(m - k + 1, n - k + 1, threshold), F.array(F.lit(0)))
    return F.when(m <= n, whole).when(F.size(p) >= least, F.array_distinct(once(p, begins)))


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """_id, _x, item_id, start, n_words, similarity, hamming: each document's best window for each item it repeats.

    Among equally similar windows the last counts.  Null texts and texts without words match
    nothing; repeated rows (one id, one text) give one result; very long texts are word lists of
    their row; an empty table on either side gives no result.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    items = scratch.save(reference(benchmark, "item_id").select("item_id", "n", "k", simhash(F.col("sh")).alias("item_fp"), numbered(F.col("sh")).alias("item_set"), "sh"))
    found = marked_places(docs, items.select("n", "k", "sh")).select("_id", "_x", F.explode(starts(F.col("p"), threshold)).alias("start"), "n", "k", F.least("n", "m").alias("span"))
    windows = window_shingles(docs, scratch.save(found))
    windows = scratch.save(windows.select("_id", "_x", "start", "n", "span", simhash(F.col("sh")).alias("fp"), numbered(F.col("sh")).alias("set")))
    items = items.repartition("item_id")  # each becomes some ten thousand entries
    flips = F.expr(f"filter(sequence(0L, {(1 << WIDTH) - 1}L), f -> bit_count(f) <= {RADIUS // BLOCKS})")
    index = items.select("item_id", "n", "item_fp", F.explode(blocks("item_fp")).alias("b")).select("item_id", "n", "item_fp", "b.block", F.col("b.value").alias("v0"))
    probe = windows.select("n", "fp", F.explode(blocks("fp")).alias("b")).select("n", "fp", "b.block", "b.value").distinct()
    # An entry for each value within the block's share of the radius.  The index grows with the
    # benchmark by some ten thousand entries an item, which its small source hides from the
    # planner, so it is shuffled, never broadcast.
    index = index.select("item_id", "n", "item_fp", "block", F.explode(F.transform(flips, lambda f: F.col("v0").bitwiseXOR(f))).alias("value"))
    near = probe.join(index.hint("merge"), ["n", "block", "value"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS).select("n", "fp", "item_id", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("hamming")).distinct()
    pairs = windows.join(near, ["n", "fp"]).join(items.select("item_id", "item_set"), "item_id")
    both = F.size(F.array_intersect("set", "item_set"))
    pairs = pairs.withColumn("similarity", both / (F.size("set") + F.size("item_set") - both)).filter(F.col("similarity") >= threshold)
    best = pairs.groupBy("_id", "_x", "item_id").agg(F.max_by(F.struct("start", "span", "similarity", "hamming"), F.struct("similarity", "start")).alias("b"))
    best = scratch.save(best.select("_id", "_x", "item_id", "b.start", F.col("b.span").alias("n_words"), "b.similarity", "b.hamming"))
    scratch.keep_only(best)
    return best


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that repeat no benchmark item; columns as in the input, whatever their names.

    Null texts stay, repeated rows go or stay together, an empty table gives an empty one.
    """
    found = leaks(docs, benchmark).select("_id", "_x").distinct()
    return packed(docs, *document_key()).join(found, ["_id", "_x"], "left_anti").select("row.*")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).select(id_back("_id").alias("doc_id"), "item_id", F.col("start").cast("long").alias("start_word"), F.col("n_words").cast("long").alias("n_words"), "similarity")


#: All windows of all documents that share a shingle with an item, wherever they start (others have similarity zero).
SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents),
iw AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS k FROM (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM iw),
ds AS (SELECT doc_id, len(w) AS m, k, unnest(range(0, len(w) - k + 1)) AS p, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM dw, ks WHERE len(w) >= k),
i AS (SELECT item_id, n, k, unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM iw),
ic AS (SELECT item_id, n, k, s, count(*) AS c FROM i GROUP BY ALL),
hit AS (SELECT doc_id, m, item_id, n, k, p, s, c FROM ds JOIN ic USING (k, s)),
win AS (SELECT *, unnest(range(greatest(0, least(p, greatest(m - n, 0)) - (least(n, m) - k)), least(p, greatest(m - n, 0)) + 1)) AS st FROM hit),
wc AS (SELECT doc_id, m, item_id, n, k, st, s, least(count(*), max(c)) AS shared FROM win WHERE p BETWEEN st AND st + least(n, m) - k GROUP BY ALL),
sim AS (SELECT doc_id, m, item_id, n, k, st, sum(shared) AS shared FROM wc GROUP BY ALL),
r AS (SELECT doc_id, item_id, st, least(n, m) AS span, CAST(shared AS DOUBLE) / CAST(n - k + 1 + least(n, m) - k + 1 - shared AS DOUBLE) AS sim FROM sim)
SELECT doc_id, item_id, CAST(st AS BIGINT) AS start_word, CAST(span AS BIGINT) AS n_words, sim AS similarity
FROM r WHERE sim >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY sim DESC, st DESC) = 1
"""
