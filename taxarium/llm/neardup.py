"""Near duplicates of five-word shingles: SimHash with Golay keys and MinHash bands propose, exact Jaccard similarity decides.

Fingerprints of the shingle sets that differ in at most three bits meet by their Golay keys, as in
``simhash``.  At a similarity of 0.8 about ten of 64 bits differ, which no Golay key survives, so
BANDS bands of ROWS minimum hashes propose pairs too: a pair of similarity 0.8 shares none of them
with a probability of (1 - 0.8**ROWS)**BANDS, 3 in 100,000, and more similar pairs are lost more
rarely.  Every proposed pair is verified by the intersection of its shingle sets, so documents
that are less similar are never linked directly.

Each bucket first links its members to one of them.  In buckets whose members are then still in
different components the sets meet once more, in blocks of bounded size, and are compared until
they are joined or every pair has been; only links that join components leave a block.
Sets and shingles stand for themselves by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_key, packed, ship_package
from .passages import document_key
from .simhash import _LOWER, components, fingerprint_links, majority

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 4
#: Bits that fingerprints of similar large sets may differ in (their expectation is 10 of 64, the deviation 3), the size from
#: which that is checked, and documents up to which the list of candidates is broadcast.
FAR, LARGE, BROADCAST_ROWS = 26, 64, 200_000
#: Bytes of the shingle sets of a block.
BLOCK_BYTES = 8 << 20
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_DRAW = np.random.default_rng(42)
_FLIPS, _FACTORS = (_DRAW.integers(0, 2**64, BANDS * ROWS, np.uint64) for _ in range(2))
_FACTORS |= np.uint64(1)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles (fewer words: the whole sequence)."""
    words = text.translate(_LOWER).split()
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64).view(np.int64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(w) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    for i, p in enumerate(_PRIMES):
        h = (h ^ w[i : i + n]) * p
        h ^= h >> np.uint64(29)
    return np.unique(h.view(np.int64))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of minimum hashes."""
    u = shingles.view(np.uint64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for low in range(0, len(u), 2048):
        np.minimum(least, ((u[low : low + 2048, None] ^ _FLIPS) * _FACTORS).min(axis=0), out=least)
    least = least.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = (key ^ least[:, i]) * _PRIMES[i]
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """_id, _x, set_key, size, fp, bands of every row (null text: empty)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 256):
                part = b.slice(low, 256)
                keys, sizes, fps, bands = [], [], [], []
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    s = shingle_set(text or b"")
                    keys.append(xxhash.xxh64_intdigest(s.tobytes()) - 2**63)
                    sizes.append(len(s))
                    fps.append(majority(s.view(np.uint64)))
                    bands.append(band_keys(s))
                every = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(bands) + 1, BANDS, dtype=np.int32)), pa.array(np.concatenate(bands)))
                columns = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)), every]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=["_id", "_x", "set_key", "size", "fp", "bands"])

    return docs.select(*document_key(), "text").mapInArrow(run, "_id long, _x long, set_key long, size long, fp long, bands array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_key, sh of the wanted documents (set_key, _id, _x), each shingle set once."""
    few = wanted.count() <= BROADCAST_ROWS
    rows = docs.select(*document_key(), "text").join(F.broadcast(wanted) if few else wanted, ["_id", "_x"]).select("set_key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 256):
                part = b.slice(low, 256)
                sets = [shingle_set(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["set_key", "sh"])

    return rows.mapInArrow(run, "set_key long, sh array<long>")


def _similar_sizes(a: Column | str, b: Column | str) -> Column:
    """Sets of similarity 0.8 differ in size by a fifth at most."""
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def _star(keyed: DataFrame) -> DataFrame:
    """(a, b): each bucket's least set with its other members.  An aggregate and a join, so that a hot bucket is split."""
    first = keyed.groupBy("key").agg(F.min(F.struct("set_key", "size")).alias("f"), F.count("*").alias("n")).filter("n > 1").select("key", F.col("f.set_key").alias("_k"), F.col("f.size").alias("_s"))
    pairs = keyed.join(first, "key").filter((F.col("set_key") != F.col("_k")) & _similar_sizes("size", "_s"))
    return pairs.select(F.least("set_key", "_k").alias("a"), F.greatest("set_key", "_k").alias("b")).distinct()


def _golay(nodes: DataFrame) -> DataFrame:
    """(a, b): sets whose fingerprints are equal, or linked by Golay keys, each fingerprint by its least set."""
    least = nodes.groupBy("fp").agg(F.min("set_key").alias("_k"))
    equal = nodes.join(least, "fp").filter("set_key <> _k").select(F.col("_k").alias("a"), F.col("set_key").alias("b"))
    links = fingerprint_links(least.select("fp")).toDF("_a", "_b")
    one, two = least.toDF("_a", "a"), least.toDF("_b", "b")
    return equal.unionByName(links.join(one, "_a").join(two, "_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _blocks(labelled: DataFrame) -> DataFrame:
    """The members of buckets whose pairs are not all tried yet: several labels, more than two members.

    Buckets of over BLOCK_BYTES of shingles are split into blocks, and each two blocks (i, j) meet in a group of their own.
    """
    stats = labelled.groupBy("key").agg(F.count("*").alias("_n"), F.min("label").alias("_l"), F.max("label").alias("_m"), F.sum("size").alias("_s"))
    stats = stats.filter("_n > 2 and _l <> _m").select("key", F.ceil(8 * F.col("_s") / BLOCK_BYTES).cast("int").alias("_g"))
    rows = labelled.join(stats, "key").withColumn("side", F.pmod(F.xxhash64("set_key"), "_g").cast("int"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
    return rows.select("key", F.least("side", "_o").alias("i"), F.greatest("side", "_o").alias("j"), "side", "band", "set_key", "fp", "label", "bands")


def _rest(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links of similarity THRESHOLD between different labels within each group, as many as join its labels.

    A pair is compared in the first band that both share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            heads = [c.to_numpy() for c in batch.columns[:8]]
            bands = batch.column(8).flatten().to_numpy().reshape(-1, BANDS)
            offsets, values = batch.column(9).offsets.to_numpy(), batch.column(9).values.to_numpy()
            edge = np.flatnonzero(np.r_[True, np.any([h[1:] != h[:-1] for h in heads[:3]], axis=0)]) if batch.num_rows else []
            for low, high in zip(edge, [*edge[1:], batch.num_rows]):
                part = ([h[low:high] for h in heads], bands[low:high], np.diff(offsets[low : high + 1]), values[offsets[low] : offsets[high]])
                if held and any(x[0] != y[-1] for x, y in zip(part[0][:3], held[-1][0][:3])):
                    yield from close(held)
                    held = []
                held.append(part)
        if held:
            yield from close(held)

    def close(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        heads = [np.concatenate([h[0][k] for h in held]) for k in range(8)]
        links = _join_labels(*(h for h in heads[1:]), *(np.concatenate([h[k] for h in held]) for k in (1, 2, 3)))
        if len(links):
            yield pa.RecordBatch.from_arrays([pa.array(links.min(axis=1)), pa.array(links.max(axis=1))], names=["a", "b"])

    rows = blocks.join(sets, "set_key").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "set_key")
    return rows.select("key", "i", "j", "side", "band", "set_key", "fp", "label", "bands", "sh").mapInArrow(run, "a long, b long").distinct()


def _join_labels(i: np.ndarray, j: np.ndarray, side: np.ndarray, band: np.ndarray, node: np.ndarray, fp: np.ndarray, label: np.ndarray, bands: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Links between members of one group of which each joins two sets of labels."""
    across, first = i[0] != j[0], int(band[0])
    shingle = np.unique(values, return_inverse=True)[1]
    start = np.cumsum(size) - size
    marked = np.zeros(int(shingle.max()) + 1, bool)
    label = np.unique(label, return_inverse=True)[1]
    links = []
    for x in range(len(node) - 1):
        if (label == label[x]).all():
            break
        y = np.arange(x + 1, len(node))
        small, large = np.minimum(size[x], size[y]), np.maximum(size[x], size[y])
        fits = (label[y] != label[x]) & (5 * small >= 4 * large)
        if across:
            fits &= side[y] != side[x]
        fits &= (small < LARGE) | (np.bitwise_count((fp[x] ^ fp[y]).view(np.uint64)) <= FAR)
        y = y[fits]
        if first:
            y = y[~(bands[y, :first] == bands[x, :first]).any(axis=1)]
        if not len(y):
            continue
        own = shingle[start[x] : start[x] + size[x]]
        marked[own] = True
        stops = np.cumsum(size[y])
        places = np.arange(stops[-1]) + np.repeat(start[y] - stops + size[y], size[y])
        shared = np.add.reduceat(marked[shingle[places]], stops - size[y], dtype=np.int64)
        marked[own] = False
        for z in y[9 * shared >= 4 * (size[x] + size[y])].tolist():
            if label[z] != label[x]:
                links.append((node[x], node[z]))
                label[label == label[z]] = label[x]
    return np.array(links, np.int64).reshape(-1, 2)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of THRESHOLD or more."""
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    shared: Column = F.size(F.array_intersect("x", "y"))
    # shared / (x + y - shared) >= 4 / 5
    return both.filter(9 * shared >= 4 * (F.size("x") + F.size("y"))).select("a", "b")


def _sets_of(docs: DataFrame, nodes: DataFrame, used: DataFrame, scratch: Scratch) -> DataFrame:
    """set_key, sh of the used sets."""
    wanted = scratch.save(nodes.join(used.distinct(), "set_key", "left_semi").select("set_key", "first._id", "first._x"))
    return scratch.save(shingle_sets(docs, wanted).dropDuplicates(["set_key"]))


def first_rows(docs: DataFrame) -> DataFrame:
    """_id, _x (see document_key): the first row of every group that links of similarity THRESHOLD connect."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    rows = scratch.save(sketches(docs))
    nodes = scratch.save(rows.groupBy("set_key").agg(F.min(F.struct("_id", "_x")).alias("first"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands")))
    scratch.drop(rows)
    keyed = nodes.select(F.posexplode("bands").alias("band", "key"), "set_key", "size", "fp", "bands")
    tried = scratch.save(_star(keyed).unionByName(_golay(nodes)).distinct())
    own = _sets_of(docs, nodes, tried.select(F.explode(F.array("a", "b")).alias("set_key")), scratch)
    links = scratch.save(_verified(tried, own))
    labels = components(spark, links).toDF("set_key", "label")
    labelled = keyed.join(labels, "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    blocks = scratch.save(_blocks(labelled))
    if not blocks.isEmpty():
        more = _sets_of(docs, nodes, blocks.select("set_key"), scratch)
        labels = components(spark, scratch.save(links.unionByName(_rest(blocks, more)))).toDF("set_key", "label")
    groups = nodes.select("set_key", "first").join(labels, "set_key", "left").groupBy(F.coalesce("label", "set_key").alias("label"))
    out = scratch.save(groups.agg(F.min("first").alias("first")).select("first.*"))
    scratch.keep_only(out)
    return out


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates: that of smallest id, and of least text hash among rows that share it.

    Columns are those of the input, whatever their names.  Rows without a doc_id sort before all
    others; null texts are empty; of repeated rows one stays.  Very long texts are whole sets of
    64-bit hashes in the row's task.  An empty table gives an empty one.
    """
    first = first_rows(docs)
    id_, x = document_key()
    kept = packed(docs, id_, x).join(first, ["_id", "_x"], "left_semi")
    repeated = not docs.select(id_, x).groupBy("_id", "_x").count().filter("count > 1").isEmpty()
    return (kept.dropDuplicates(["_id", "_x"]) if repeated else kept).select("row.*")
