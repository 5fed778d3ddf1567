"""Exact repeats of fixed-length windows: the frame that both substring deduplications share.

1. Exact copies of whole texts are set aside; their windows all repeat those of the first text.
2. Every window is assigned to an anchor (see ``anchors``).  A context is the stretch of text
   that covers the windows of one anchor.  An anchor that occurs once ends here.
3. Equal contexts of equal anchors collapse to the first of them (pre-aggregation by the anchor's
   64-bit hash and a 64-bit hash of the context: among n contexts two different ones meet with a
   probability of n**2 / 2**129 at most); the windows of all later ones repeat it.
4. Different contexts of one anchor may still share windows.  They go to memory-sized groups, where
   a suffix structure (a suffix array or suffix trees, given by the caller) finds windows that
   occur more than once.  Hot anchors are split:
   * Words: by longer prefixes.  The anchor's words begin all suffixes that are read from it on.
     Of a hot anchor the windows are cut into PARTS by their distance from it; the windows of one
     part share more than the anchor, all but a few words, and this longer string, the prefix of
     the suffixes that start at it, is their group.  Windows of a group that is still too large
     are grouped by their whole length, where nothing is left for a tree to find.  Equal windows
     always share their group.
   * Bytes: contexts are dealt to shards by their hash.  The windows that a shard leaves as first
     stand in its suffix array in order; these sorted runs are merged across the anchor's shards,
     two by two, by binary search of the suffixes of one run in the other.  Equal windows stand
     side by side in the merged order.  A merge takes the windows of one lot (a hash of the
     window), of which an anchor has as many as shards, so a lot is about as large as a shard.
5. All removed stretches of a document meet at its text.

Step 4 compares true contexts; windows of other anchors cannot be equal to them.  All steps are
aggregations and equi-joins by anchor or document, with written tables in between, and none
gathers an anchor's occurrences in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import anchors, byte_units, prefix_hash, slice_hash, word_units
from .common import Scratch, id_key, map_rows, ship_package

#: Contexts of a shard of a hot anchor, bytes of a shard's structure, rows of the copies that may be broadcast.
HOT, SHARD_BYTES, BROADCAST_ROWS = 512, 1 << 20, 200_000
#: Parts of a hot anchor's windows, and contexts of a group of one longer prefix that a tree takes.
PARTS, MOST = 4, 20_000


@dataclass(frozen=True)
class Kind:
    """What repeats: windows of ``span`` words or bytes; ``within`` if an earlier place in the same document counts."""

    by_words: bool
    span: int
    k: int
    within: bool


#: From a shard's concatenated contexts: group numbers of the windows (equal windows, equal numbers; of bytes, ascending as the windows do).
#: Arguments: kind, contexts, window counts.
Structure = Callable[[Kind, list[bytes], np.ndarray], np.ndarray]


def _units(kind: Kind, text: bytes) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    if kind.by_words:
        starts, stops, units = word_units(text)
        return units, starts, stops
    return byte_units(text), None, None


def _slices(kind: Kind, text: bytes, starts, stops, low: np.ndarray, high: np.ndarray) -> list[bytes]:
    """The bytes of units low to high (exclusive); words joined by one blank."""
    if kind.by_words:
        if not len(starts):
            return []
        plain = b" ".join(text.split())
        length = stops - starts
        stop = np.cumsum(length + 1) - 1
        low, high = (stop - length)[low], stop[high - 1]
        text = plain
    return [text[i:j] for i, j in zip(low.tolist(), high.tolist())]


def removed_spans(docs: DataFrame, kind: Kind, structure: Structure) -> tuple[DataFrame, bool]:
    """(_id, _x, spans, copy) of the documents that lose anything, and whether ids repeat.

    spans are packed (first unit << 24 | units).  ``copy`` marks texts that a smaller id holds too.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    ship_package(spark)
    ids = docs.select(id_key().alias("_id"))
    repeated_ids = not ids.groupBy("_id").count().filter("count > 1").isEmpty()
    keyed = docs.select(id_key().alias("_id"), text_key(repeated_ids).alias("_x"), "text").filter(F.length("text") > 0)

    # 1. Copies.
    whole = scratch.save(keyed.select("_id", "_x", F.unhex(F.md5("text")).alias("m"), F.xxhash64("text").alias("w")))
    first = scratch.save(whole.groupBy("m", "w").agg(F.min("_id").alias("first_id")))
    copies = scratch.save(whole.join(first, ["m", "w"]).filter("_id > first_id").select("_id", "_x").distinct())
    few = copies.count() <= BROADCAST_ROWS
    own = keyed.join(F.broadcast(copies) if few else copies, ["_id", "_x"], "left_anti")
    if repeated_ids:
        own = own.dropDuplicates(["_id", "_x"])

    # 2. Anchors that occur more than once.
    def find(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, x, text in rows:
            units, starts, stops = _units(kind, text)
            h, _, low, high = anchors(units, kind.span, kind.k)
            if not len(h):
                continue
            key = np.fromiter(map(xxhash.xxh3_64_intdigest, _slices(kind, text, starts, stops, low, high + kind.span)), np.uint64, len(h))
            later = np.zeros(len(h), np.int64)
            if kind.within:
                order = np.lexsort((low, key, h))
                later[order[1:]] = (h[order][1:] == h[order][:-1]) & (key[order][1:] == key[order][:-1])
            place = low << 20 | (high - low + 1) << 1 | later
            yield from zip(h.view(np.int64).tolist(), key.view(np.int64).tolist(), [doc_id] * len(h), [x] * len(h), place.tolist())

    found = scratch.save(map_rows(own, find, "h long, c long, _id long, _x long, p long"))
    several = scratch.save(found.groupBy("h").count().filter("count > 1").select("h"))
    occurs = scratch.save(found.join(several.hint("shuffle_hash"), "h"))
    scratch.drop(found)

    # 3. The first of equal contexts.
    leads = occurs.filter("p & 1 = 0").groupBy("h", "c")
    leads = leads.agg(F.min(F.struct("_id", "_x")).alias("f")).select("h", "c", "f._id", "f._x") if repeated_ids else leads.agg(F.min("_id").alias("_id"), F.lit(0).cast("long").alias("_x"))
    leads = scratch.save(leads.toDF("h", "c", "first_id", "first_x"))

    # 4. Anchors with different contexts.
    mixed = scratch.save(leads.groupBy("h").count().filter("count > 1").select("h", F.ceil(F.col("count") / HOT).cast("long").alias("shards")))
    chosen = leads.join(mixed, "h").select(F.col("h").alias("_h"), F.col("c").alias("_c"), "first_id", "first_x", "shards")
    held = occurs.filter("p & 1 = 0").join(chosen, (F.col("h") == F.col("_h")) & (F.col("c") == F.col("_c")) & (F.col("_id") == F.col("first_id")) & (F.col("_x") == F.col("first_x")))
    held = scratch.save(held.groupBy("h", "c", "_id", "_x", "shards").agg(F.min("p").alias("p")))
    wanted = held.groupBy("_id", "_x").agg(F.collect_list(F.struct("h", "c", "p", "shards")).alias("wanted"))

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, x, text, wanted in rows:
            units, starts, stops = _units(kind, text)
            low = np.array([w["p"] >> 20 for w in wanted], np.int64)
            n = np.array([w["p"] >> 1 & 0x7FFFF for w in wanted], np.int64)
            sums = prefix_hash(units) if kind.by_words and any(w["shards"] > 1 for w in wanted) else None
            keys, first, count = [], [], []
            for w, at, many in zip(wanted, low.tolist(), n.tolist()):
                if kind.by_words and w["shards"] > 1:
                    for g, start, size in _prefixes(kind, sums, w["h"], at, many):
                        keys.append((g, 0, 1, w["h"], w["c"], start - at))
                        first.append(start)
                        count.append(size)
                else:
                    keys.append((w["h"], w["c"] % w["shards"], w["shards"], w["h"], w["c"], 0))
                    first.append(at)
                    count.append(many)
            first, count = np.array(first, np.int64), np.array(count, np.int64)
            for key, at, many, context in zip(keys, first.tolist(), count.tolist(), _slices(kind, text, starts, stops, first, first + count - 1 + kind.span)):
                yield *key, doc_id, x, at, many, context

    contexts = map_rows(own.join(wanted, ["_id", "_x"]), cut, "g long, shard long, shards long, h long, c long, shift int, _id long, _x long, low long, n int, context binary")
    whole_length = None
    if kind.by_words:
        contexts = scratch.save(contexts)
        large = scratch.save(contexts.groupBy("g").count().filter(F.col("count") > MOST).select("g"))
        if not large.isEmpty():
            whole_length = _by_whole_length(kind, contexts.join(large, "g", "left_semi"), scratch)
            contexts = contexts.join(large, "g", "left_anti")
    contexts = contexts.repartition("g", "shard").sortWithinPartitions("g", "shard")

    def build(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        size, last = 0, None
        for row in rows:
            if held and size >= SHARD_BYTES and row[:2] != last:
                yield from _shard(kind, structure, held)
                held, size = [], 0
            held.append(row)
            size += len(row[-1])
            last = row[:2]
        if held:
            yield from _shard(kind, structure, held)

    out = scratch.save(map_rows(contexts, build, "h long, c long, a int, b int, lot int, data binary"))
    if whole_length is not None:
        out = out.unionByName(whole_length.select("*", F.lit(None).cast("int").alias("lot"), F.lit(None).cast("binary").alias("data")))

    # 5. Merge across the shards of hot anchors.
    left = out.filter("lot is not null").select("h", "lot", "data").repartition("h", "lot").sortWithinPartitions("h", "lot")

    def merge(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (h, _), group in groupby(rows, lambda row: row[:2]):
            yield from _merge(kind, h, [np.frombuffer(data, _left(kind)) for _, _, data in group])

    masks = out.filter("lot is null").select("h", "c", "a", "b").unionByName(map_rows(left, merge, "h long, c long, a int, b int"))
    masks = masks.groupBy("h", "c").agg(F.collect_list(F.col("a").cast("long") * (1 << 24) + F.col("b") - F.col("a")).alias("mask"))
    leads = scratch.save(leads.join(masks, ["h", "c"], "left"))

    # 6. Stretches by document.
    first_self = (F.col("_id") == F.col("first_id")) & ((F.col("_x") == F.col("first_x")) & (F.col("p").bitwiseAND(1) == 0) if kind.within else F.lit(True))
    low, n = F.shiftright("p", 20), F.shiftright("p", 1).bitwiseAND(0x7FFFF)
    all_of = F.array(low * (1 << 24) + n - 1 + kind.span)
    part_of = F.transform("mask", lambda m: m + low * (1 << 24))
    gone = occurs.join(leads, ["h", "c"]).select("_id", "_x", F.when(first_self, part_of).otherwise(all_of).alias("s")).filter("s is not null")
    spans = gone.groupBy("_id", "_x").agg(F.flatten(F.collect_list("s")).alias("spans"))
    none = F.array().cast("array<long>")
    spans = spans.select("*", F.lit(False).alias("copy")).unionByName(copies.select("_id", "_x", none.alias("spans"), F.lit(True).alias("copy")))
    return spans, repeated_ids


def _prefixes(kind: Kind, sums: np.ndarray, h: int, low: int, n: int) -> Iterator[tuple[int, int, int]]:
    """(key, first window, windows) of the parts of one hot context: what all windows at their distances from the anchor share is the key."""
    at = np.arange(low + n - 1, low + kind.span - kind.k + 1)
    anchor = int(at[np.flatnonzero(slice_hash(sums, at, at + kind.k).view(np.int64) == h)[-1]])
    edge = np.linspace(0, kind.span - kind.k + 1, PARTS + 1).astype(int).tolist()
    for part, (near, stop) in enumerate(zip(edge, edge[1:])):
        far = stop - 1  # the part's windows begin near to far units before the anchor
        first, last = max(low, anchor - far), min(low + n - 1, anchor - near)
        if first <= last:
            shared = slice_hash(sums, np.array([anchor - near]), np.array([anchor - far + kind.span]))
            yield int((shared + np.uint64(part)).view(np.int64)[0]), first, last - first + 1


def _by_whole_length(kind: Kind, contexts: DataFrame, scratch: Scratch) -> DataFrame:
    """(h, c, a, b): windows of the contexts that a smaller id holds too, by 128-bit digests of the windows."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for h, c, shift, doc_id, n, context in rows:
            for a, piece in enumerate(_windows(kind, [context], np.zeros(n, np.int64), np.arange(n))):
                digest = xxhash.xxh3_128_intdigest(piece)
                yield (digest >> 64) - 2**63, (digest & (2**64 - 1)) - 2**63, h, c, a + shift, doc_id

    windows = scratch.save(map_rows(contexts.select("h", "c", "shift", "_id", "n", "context"), run, "d long, e long, h long, c long, a int, _id long"))
    least = windows.groupBy("d", "e").agg(F.min("_id").alias("least"))
    return scratch.save(windows.join(least, ["d", "e"]).filter("_id > least").select("h", "c", "a", (F.col("a") + kind.span).cast("int").alias("b")))


def text_key(repeated_ids: bool):
    """Tells rows of one id apart; constant where ids do not repeat."""
    return F.coalesce(F.xxhash64("text"), F.lit(0)) if repeated_ids else F.lit(0).cast("long")


def _left(kind: Kind) -> np.dtype:
    """A window that its shard holds as first: its bytes, context, document, place, offset in the context."""
    return np.dtype([("w", f"S{kind.span}"), ("c", "<i8"), ("id", "<i8"), ("x", "<i8"), ("at", "<i8"), ("a", "<i4")])


def _order(ids: np.ndarray, x: np.ndarray, at: np.ndarray, within: bool) -> np.ndarray:
    """Ranks of windows by document and place; equal for one document if places in it do not count."""
    if not within:
        return np.unique(ids, return_inverse=True)[1]
    order = np.lexsort((at, x, ids))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def _runs(row: np.ndarray, offset: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(row, first, last) of runs of consecutive offsets; both ascend."""
    if not len(row):
        return
    edge = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)])
    yield from zip(row[edge].tolist(), offset[edge].tolist(), offset[np.r_[edge[1:], len(row)] - 1].tolist())


def _shard(kind: Kind, structure: Structure, held: list[tuple]) -> Iterator[tuple]:
    h, c, shift, ids, x, low, n = (np.array([r[i] for r in held], np.int64) for i in range(3, 10))
    contexts = [r[10] for r in held]
    group = structure(kind, contexts, n)
    row = np.repeat(np.arange(len(held)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = low[row] + offset
    rank = _order(ids[row], x[row], at, kind.within)
    least = np.full(int(group.max()) + 1, len(row) + 1)
    np.minimum.at(least, group, rank)
    later = rank > least[group]
    for r, a, b in _runs(row[later], offset[later]):
        yield int(h[r]), int(c[r]), int(a + shift[r]), int(b + shift[r]) + kind.span, None, None
    many = np.array([r[2] for r in held], np.int64)
    hot = np.flatnonzero((many[row] > 1) & ~later)
    if len(hot):
        yield from _sorted_runs(kind, contexts, h[row[hot]], many[row[hot]], group[hot], row[hot], offset[hot], c[row[hot]], ids[row[hot]], x[row[hot]], at[hot])


def _sorted_runs(kind: Kind, contexts: list[bytes], h, many, group, row, offset, c, ids, x, at) -> Iterator[tuple]:
    """The windows of each anchor and lot in the order of the suffix array."""
    joined = b"".join(contexts)
    text = np.frombuffer(joined, np.uint8)
    start = (np.cumsum([0] + [len(part) for part in contexts])[:-1])[row] + offset
    lot = (slice_hash(prefix_hash(byte_units(joined)), start, start + kind.span) % many.astype(np.uint64)).astype(np.int64)
    order = np.lexsort((group, lot, h))
    edge = np.flatnonzero(np.r_[True, (h[order][1:] != h[order][:-1]) | (lot[order][1:] != lot[order][:-1]), True])
    every = np.lib.stride_tricks.sliding_window_view(text, kind.span)
    for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
        run = order[i:j]
        left = np.empty(len(run), _left(kind))
        left["w"] = every[start[run]].view(f"S{kind.span}")[:, 0]
        left["c"], left["id"], left["x"], left["at"], left["a"] = c[run], ids[run], x[run], at[run], offset[run]
        yield int(h[run[0]]), None, None, None, int(lot[run[0]]), left.tobytes()


def _windows(kind: Kind, contexts: list[bytes], rows: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
    last, parts = -1, []
    for r, a in zip(rows.tolist(), offsets.tolist()):
        if not kind.by_words:
            yield contexts[r][a : a + kind.span]
            continue
        if r != last:
            last, parts = r, contexts[r].split(b" ")
        yield b" ".join(parts[a : a + kind.span])


def _merge(kind: Kind, h: int, runs: list[np.ndarray]) -> Iterator[tuple]:
    """Windows of one lot that another shard holds earlier."""
    rows = np.concatenate(runs)
    stop = np.cumsum([len(r) for r in runs])
    merged = [(np.ascontiguousarray(r["w"]), np.arange(j - len(r), j)) for r, j in zip(runs, stop.tolist())]
    while len(merged) > 1:
        merged = [_interleave(*pair) for pair in zip(merged[::2], merged[1::2])] + merged[len(merged) & ~1 :]
    windows, order = merged[0]
    rank = _order(rows["id"], rows["x"], rows["at"], kind.within)[order]
    head = np.r_[True, windows[1:] != windows[:-1]]
    least = np.minimum.reduceat(rank, np.flatnonzero(head))[np.cumsum(head) - 1]
    gone = rows[order[rank > least]]
    for c, a in zip(gone["c"].tolist(), gone["a"].tolist()):
        yield h, c, a, a + kind.span


def _interleave(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted runs of (windows, row numbers) as one: the shorter is searched in the longer."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    place = np.searchsorted(a[0], b[0], side="right") + np.arange(len(b[0]))
    rest = np.ones(len(a[0]) + len(b[0]), bool)
    rest[place] = False
    out = tuple(np.empty(len(rest), part.dtype) for part in a)
    for new, x, y in zip(out, a, b):
        new[rest], new[place] = x, y
    return out


def apply_spans(docs: DataFrame, spans: DataFrame, repeated_ids: bool) -> DataFrame:
    """docs with _id, _x, spans and copy; all rows stay."""
    keyed = docs.select(id_key().alias("_id"), text_key(repeated_ids).alias("_x"), "doc_id", "text")
    return keyed.join(spans, ["_id", "_x"], "left").select("doc_id", "text", "spans", F.coalesce("copy", F.lit(False)).alias("copy"))


def removed_mask(n: int, span: int, spans: list[int] | None, copy: bool) -> np.ndarray:
    """Which of n units go."""
    if copy and n >= span:
        return np.ones(n, bool)
    delta = np.zeros(n + 1, np.int64)
    if spans:
        s = np.array(spans, np.int64)
        np.add.at(delta, s >> 24, 1)
        np.add.at(delta, (s >> 24) + (s & 0xFFFFFF), -1)
    return np.cumsum(delta[:n]) > 0
