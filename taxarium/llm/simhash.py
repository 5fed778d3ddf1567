"""SimHash near-duplicate detection with Golay-code fuzzy hashing.

A 64-bit fingerprint has four 16-bit blocks.  If two fingerprints differ in at most three bits,
some pair of blocks differs in at most one (three pairs hold each bit, six pairs share at most
nine).  The 32 bits of a pair are a 23-bit Golay segment and a rest of nine.  Either the segment
is equal, or the rest is equal and the segments differ in one bit; then the codeword index that
one of the two decodes to is a key of both, because a segment's keys are the indices that it and
its 23 neighbours decode to: one index within distance two of a codeword, else six.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, id_back, id_key, map_rows, packed, whole_text

#: Fixed value: a generator polynomial of the binary (23, 12, 7) Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0xC75
BLOCK_PAIRS = list(combinations(range(4), 2))
RADIUS = 3
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def _remainder(x: int) -> int:
    for bit in range(22, 10, -1):
        if x >> bit & 1:
            x ^= GENERATOR << (bit - 11)
    return x


_HIGH = np.array([_remainder(i << 11) for i in range(4096)], np.int64)
_ERROR = np.zeros(2048, np.int64)
for _n in range(4):
    for _bits in combinations(range(23), _n):
        _pattern = sum(1 << b for b in _bits)
        _ERROR[_HIGH[_pattern >> 11] ^ (_pattern & 2047)] = _pattern


def golay_index(x: np.ndarray) -> np.ndarray:
    """The 12 data bits of the codeword nearest to each 23-bit word (always within three bits)."""
    return (x ^ _ERROR[_HIGH[x >> 11] ^ (x & 2047)]) >> 11


def golay_keys(x: np.ndarray) -> np.ndarray:
    """(n, 24) codeword indices of each word and its neighbours; -1 where one repeats within its row."""
    near = np.concatenate([x[:, None], x[:, None] ^ (1 << np.arange(23))], axis=1)
    keys = np.sort(golay_index(near), axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def fingerprint_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned 64-bit fingerprints: (row numbers, keys).  Fingerprints within RADIUS share a key."""
    rows, keys = [], []
    every = np.arange(len(fp))
    for p, (a, b) in enumerate(BLOCK_PAIRS):
        pair = ((fp >> np.uint64(16 * a) & np.uint64(0xFFFF)) << np.uint64(16) | fp >> np.uint64(16 * b) & np.uint64(0xFFFF)).astype(np.int64)
        segment, rest = pair >> 9, pair & 511
        near = golay_keys(segment)
        r, c = np.nonzero(near >= 0)
        rows += [r, every]
        keys += [(2 * p) << 32 | near[r, c] << 9 | rest[r], (2 * p + 1) << 32 | segment]
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: bytes) -> int:
    """Unsigned SimHash of the three-word shingles (fewer words: the whole sequence; none: zero)."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= 3:
        return _hash(b" ".join(words))
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(stops[:-3] + 1).tolist()]
    n = len(words) - 2
    return majority(np.fromiter((_hash(joined[i:j]) for i, j in zip(starts, stops[2:].tolist())), np.uint64, n))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the unsigned 64-bit hashes."""
    ones = np.zeros(64, np.int64)
    for low in range(0, len(h), 16384):
        ones += np.unpackbits(h[low : low + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id (null: NULL_ID) and fp, the fingerprint as a signed long, of every whole text (null: empty)."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            fp = fingerprint(text or b"")
            yield doc_id, fp - 2**64 if fp >= 2**63 else fp

    return map_rows(docs.select(id_key().alias("doc_id"), "text"), run, "doc_id long, fp long")


def _bucket_links(fp: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what RADIUS connects among the fingerprints of one bucket.

    A found fingerprint leaves the rest, so a dense bucket takes near-linear work and gives fewer
    links than it has members.  Buckets of many far fingerprints are split once more: the 64 bits
    hold eight bytes, of which at least five are equal in linked ones.
    """
    if len(fp) <= 2048:
        return _walk(fp)
    links = []
    for pair in combinations(range(8), 2):
        part = fp >> np.uint64(8 * pair[0]) & np.uint64(255) | (fp >> np.uint64(8 * pair[1]) & np.uint64(255)) << np.uint64(8)
        order = np.argsort(part, kind="stable")
        for group in np.split(fp[order], np.flatnonzero(np.diff(part[order])) + 1):
            if len(group) > 1:
                links += _walk(group)
    return links


def _walk(fp: np.ndarray) -> list[tuple[int, int]]:
    links, rest = [], fp
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.bitwise_count(rest ^ here) <= RADIUS
            if near.any():
                found = rest[near]
                links += [(int(here), int(x)) for x in found]
                queue += list(found)
                rest = rest[~near]
    return links


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """(a, b) links among distinct fingerprints (column fp): a spanning set of all within RADIUS."""

    def keyed(rows: Iterator[tuple]) -> Iterator[tuple]:
        def emit(held: list[int]) -> Iterator[tuple]:
            fp = np.array(held, np.int64).view(np.uint64)
            row, key = fingerprint_keys(fp)
            yield from zip(key.tolist(), fp[row].view(np.int64).tolist())

        held: list[int] = []
        for (fp,) in rows:
            held.append(fp)
            if len(held) == 4096:
                yield from emit(held)
                held = []
        if held:
            yield from emit(held)

    # Every fingerprint becomes some forty keys, so the few files of a small table are dealt out first.
    keys = map_rows(distinct.select("fp").repartition("fp"), keyed, "key long, fp long")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_key, tail_fp = np.empty(0, np.int64), np.empty(0, np.int64)

        def close(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            same = np.flatnonzero(key[1:] == key[:-1])
            if not len(same):
                return
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            stops = np.r_[starts[1:], len(key)]
            out: list[tuple[int, int]] = []
            size = stops - starts
            two = starts[size == 2]
            a, b = fp[two].view(np.uint64), fp[two + 1].view(np.uint64)
            near = np.bitwise_count(a ^ b) <= RADIUS
            for i, j in zip(starts[size > 2], stops[size > 2]):
                out += _bucket_links(fp[i:j].view(np.uint64))
            many = np.array(out, np.uint64).reshape(-1, 2)
            a, b = np.r_[a[near], many[:, 0]].view(np.int64), np.r_[b[near], many[:, 1]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            key = np.r_[tail_key, batch.column(0).to_numpy()]
            fp = np.r_[tail_fp, batch.column(1).to_numpy()]
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if cut:
                yield from close(key[:cut], fp[:cut])
            tail_key, tail_fp = key[cut:], fp[cut:]
        if len(tail_key):
            yield from close(tail_key, tail_fp)

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(linked, "a long, b long").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b): the smallest node of its connected component.

    Alternates large-star and small-star steps, each two aggregations and a join, until the set of
    links stands still.  Each step is a written table, so that joins can split hot nodes.
    """
    scratch = Scratch(spark, "components")
    now = scratch.save(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.save(large.filter("u <> v"))
        least = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.save(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        mark = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            scratch.keep_only(new)
            return new.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(new.select("v", "v").distinct().toDF("node", "label"))
        scratch.keep_only(new)
        now, seen = new, mark


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id that links of RADIUS bits reach.

    Null texts count as empty.  Rows without a doc_id are kept; they sort before all others, so a
    component that holds one has a null component_id.  Repeated rows keep their number.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    rows = scratch.save(with_fingerprint(docs))
    nodes = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(spark, scratch.save(fingerprint_links(nodes)))
    known = scratch.save(nodes.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label")))
    smallest = scratch.save(known.groupBy("label").agg(F.min("first_id").alias("component_id")))
    member = scratch.save(known.join(smallest, "label").select("fp", "component_id"))
    scratch.keep_only(rows, member)
    return rows.join(member, "fp").select(id_back("doc_id").alias("doc_id"), hex16(F.col("fp")).alias("fingerprint"), id_back("component_id").alias("component_id"))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that open their component: one stays of each group (of repeated rows of it, one too).

    Columns are those of the input, whatever their names.  Of rows that share an id, one of least
    text hash stays.
    """
    groups = near_duplicates(docs)
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(id_key().alias("_id")).distinct()
    kept = packed(docs, id_key().alias("_id"), F.xxhash64(whole_text()).alias("_x")).join(Scratch(docs.sparkSession, "first").save(first), "_id", "left_semi")
    if docs.select(id_key().alias("_id")).groupBy("_id").count().filter("count > 1").isEmpty():
        return kept.select("row.*")
    least = kept.groupBy("_id").agg(F.min("_x").alias("_x"))
    return kept.join(least, ["_id", "_x"], "left_semi").dropDuplicates(["_id", "_x"]).select("row.*")
