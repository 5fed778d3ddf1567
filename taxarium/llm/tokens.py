"""Token ids in Simple-8b containers: word-aligned coding with escapes and per-block offsets.

A 64-bit word has a selector in its top four bits.  Selectors 1 to 14 say how many ids of equal
width share the other 60 bits; selector 0 is an escape: the next word is one value of up to 64 bits.
Ids are coded in blocks, and a container lists each block's first word and number of ids, so a
block decodes alone and in numpy.  Container layout (little-endian):
magic, number of documents n and of blocks m (u32), ids in all (u64); n document ids (i64), n id
counts (u64), m first words (u64), m id counts (u32), the words (u64).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, id_back, id_key, map_rows

#: Ids per word, by selector 1 to 14; the width of each is 60 bits shared evenly.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = tuple(60 // n for n in COUNTS)
BLOCK = 16_384
MAGIC = b"TXS8"
#: Ids of a container before it closes, cached pieces of a Python worker (a power of two), text bytes encoded at once.
CONTAINER_IDS, CACHE, BATCH_BYTES = 1 << 18, 1 << 19, 1 << 18


def pack(values: np.ndarray) -> np.ndarray:
    """Simple-8b words of unsigned 64-bit values, greedily the densest selector at each place."""
    n = len(values)
    need = np.full(n + 60, 99, np.uint8)
    need[:n] = 0
    for width in sorted(set(WIDTHS)):
        need[:n] += values >= np.uint64(1) << np.uint64(width) if width < 60 else 0
    levels = sorted(set(WIDTHS))
    wide = values >= np.uint64(1 << 60)
    need[:n][wide] = 90
    choice = np.zeros(n, np.uint8)
    spans, size = {1: need}, 1
    while size * 2 <= 60:
        last = spans[size]
        spans[size * 2] = np.maximum(last[:-size], last[size:])
        size *= 2
    for selector in range(len(COUNTS), 0, -1):
        count, level = COUNTS[selector - 1], levels.index(WIDTHS[selector - 1])
        power = 1 << (count.bit_length() - 1)
        top = np.maximum(spans[power][:n], spans[power][count - power : count - power + n])
        choice[top <= level] = selector
    step = np.r_[1, COUNTS][choice].tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    chosen = choice[starts].astype(np.int64)
    place = np.arange(len(starts)) + np.r_[0, np.cumsum(chosen == 0)[:-1]] if len(starts) else starts
    out = np.zeros(len(starts) + int((chosen == 0).sum()), np.uint64)
    for selector in np.unique(chosen):
        rows = np.flatnonzero(chosen == selector)
        if selector == 0:
            out[place[rows] + 1] = values[starts[rows]]
            continue
        count, width = COUNTS[selector - 1], WIDTHS[selector - 1]
        part = values[starts[rows][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(width))
        out[place[rows]] = np.bitwise_or.reduce(part, axis=1) | np.uint64(selector) << np.uint64(60)
    return out


def unpack(stored: np.ndarray) -> np.ndarray:
    """The values of Simple-8b words."""
    selector = (stored >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(stored), bool)
    if (selector == 0).any() or (selector == 15).any():
        at = 0
        while at < len(stored):
            if selector[at] == 0:
                head[at + 1] = False
                at += 1
            at += 1
    places = np.flatnonzero(head)
    chosen = selector[places]
    counts = np.r_[1, COUNTS, 0][chosen]
    stops = np.cumsum(counts)
    out = np.empty(int(stops[-1]) if len(stops) else 0, np.uint64)
    for s in np.unique(chosen):
        rows = chosen == s
        if s == 0:
            out[stops[rows] - 1] = stored[places[rows] + 1]
            continue
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        part = stored[places[rows]][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width)) & np.uint64((1 << width) - 1)
        out[(stops[rows] - count)[:, None] + np.arange(count)] = part
    return out


def write_container(doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> bytes:
    blocks = [pack(ids[low : low + BLOCK].astype(np.uint64)) for low in range(0, len(ids), BLOCK)]
    first = np.cumsum([0, *map(len, blocks)])[:-1]
    sizes = [min(BLOCK, len(ids) - low) for low in range(0, len(ids), BLOCK)]
    return b"".join([
        MAGIC, np.array([len(doc_ids), len(blocks)], "<u4").tobytes(), np.array([len(ids)], "<u8").tobytes(), np.array(doc_ids, "<i8").tobytes(), np.array(lengths, "<u8").tobytes(),
        np.array(first, "<u8").tobytes(), np.array(sizes, "<u4").tobytes(), *(b.astype("<u8").tobytes() for b in blocks),
    ])


def read_container(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, all ids."""
    if data[:4] != MAGIC:
        raise ValueError("not a token container")
    n, m = np.frombuffer(data, "<u4", 2, 4).tolist()
    at = 20
    doc_ids, lengths = np.frombuffer(data, "<i8", n, at), np.frombuffer(data, "<u8", n, at + 8 * n).astype(np.int64)
    at += 16 * n
    first, sizes = np.frombuffer(data, "<u8", m, at).astype(np.int64), np.frombuffer(data, "<u4", m, at + 8 * m)
    stored = np.frombuffer(data, "<u8", -1, at + 12 * m) if at + 12 * m < len(data) else np.empty(0, np.uint64)
    stops = np.r_[first[1:], len(stored)] if m else first
    parts = [unpack(stored[i:j]) for i, j in zip(first, stops)]
    if any(len(p) != s for p, s in zip(parts, sizes)):
        raise ValueError("broken token block")
    return doc_ids, lengths, np.concatenate(parts) if parts else np.empty(0, np.uint64)


#: Byte-level alphabet: printable Latin-1 stands for itself, the other bytes for code points from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _byte_level(text: str) -> str:
    return text.encode().decode("latin-1").translate(_BYTE_LEVEL)


#: A blank or line break, Latin letters, ASCII marks but the apostrophe: pre-tokens that need no splitting by pattern.
_PLAIN = re.compile("([ \\n]?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Masks that keep the first 0 to 8 bytes of a little-endian word.
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
#: Bytes of a piece that the table holds; longer pieces are looked up in a dictionary.
_SHORT = 16


class PieceEncoder:
    """Encodes texts with a byte-level BPE tokenizer of the tokenizers library, piece by piece with a bounded cache.

    Byte-level pre-tokenization always cuts before a run of ASCII white space, and before the last
    character of a run that other text follows, so pieces cut there encode alone.  Pieces of up to
    16 bytes are found by their bytes in an open-addressing table, all of a batch at once; the
    tokenizer sees each new piece once.  New plain pieces go to its model itself, others through
    its whole pipeline.  A text with a zero byte, or with other white space beside a cut, is
    encoded whole.
    """

    def __init__(self, path: str, end_id: int = 0):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.end_id = end_id
        self.tails: dict[str, list[int]] = {"": []}
        self.reset()

    def reset(self) -> None:
        """Only the end of a text is known: the zero byte, with the end id."""
        self.slots = np.full(4 * CACHE, -1, np.int32)
        self.low, self.high = np.zeros(CACHE, np.uint64), np.zeros(CACHE, np.uint64)
        self.starts, self.lengths = np.zeros(CACHE, np.int32), np.zeros(CACHE, np.int32)
        self.whole, self.again = np.zeros(CACHE, bool), np.zeros(CACHE, bool)
        self.pool = np.empty(1 << 16, np.uint32)
        self.pool[0], self.used, self.size, self.lengths[0] = self.end_id, 1, 1, 1
        self.long: dict[bytes, int] = {}
        self._place(np.zeros(1, np.int64))

    def _shrink(self) -> None:
        """Forget the pieces that no later batch has used again; all, if that leaves over half of them."""
        kept = np.flatnonzero(self.again[: self.size])
        kept = kept[kept > 0]
        low, high, starts, lengths, whole, pool, long = self.low, self.high, self.starts, self.lengths, self.whole, self.pool, self.long
        self.reset()
        if len(kept) > CACHE // 2:
            return
        new = np.arange(1, 1 + len(kept))
        ids = pool[_ranges(starts[kept].astype(np.int64), lengths[kept].astype(np.int64))]
        if 1 + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(len(ids), np.uint32)])
        self.pool[1 : 1 + len(ids)] = ids
        self.low[new], self.high[new], self.lengths[new], self.whole[new] = low[kept], high[kept], lengths[kept], whole[kept]
        self.starts[new] = 1 + np.cumsum(lengths[kept]) - lengths[kept]
        self.used, self.size = 1 + len(ids), 1 + len(kept)
        place = dict(zip(kept.tolist(), new.tolist()))
        self.long = {r: place[i] for r, i in long.items() if i in place}
        is_long = np.zeros(CACHE, bool)
        is_long[list(self.long.values())] = True
        self._place(new[~is_long[new]])

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = low * np.uint64(0x9E3779B97F4A7C15) + high * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _place(self, entries: np.ndarray) -> None:
        at = self._slot(self.low[entries], self.high[entries])
        while len(entries):
            free = self.slots[at] < 0
            self.slots[at[free]] = entries[free]
            left = self.slots[at] != entries
            entries, at = entries[left], at[left] + 1 & len(self.slots) - 1

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entries of short pieces; -1 where unknown."""
        at = self._slot(low, high)
        found = self.slots[at]
        open_ = np.flatnonzero((found >= 0) & ((self.low[found] != low) | (self.high[found] != high)))
        while len(open_):
            at[open_] = at[open_] + 1 & len(self.slots) - 1
            here = self.slots[at[open_]]
            found[open_] = here
            open_ = open_[(here >= 0) & ((self.low[here] != low[open_]) | (self.high[here] != high[open_]))]
        return found

    def _learn(self, pieces: list[bytes]) -> list[int]:
        """Entries of new pieces."""
        plain, got, rest, sick = [], [], [], []
        for raw in pieces:
            p = raw.decode()
            if match := _PLAIN.fullmatch(p):
                plain.append(raw)
                got.append(self._model_ids(*match.groups()))
            elif not raw.isspace() and (p[-1].isspace() or p[raw[:1].isspace()].isspace()):
                sick.append(raw)
            else:
                rest.append(raw)
        if rest:
            got += [e.ids for e in self.tokenizer.encode_batch_fast([r.decode() for r in rest], add_special_tokens=False)]
        order = plain + rest + sick
        lengths = np.fromiter(chain(map(len, got), repeat(0, len(sick))), np.int64, len(order))
        ids = np.fromiter(chain.from_iterable(got), np.uint32, int(lengths.sum()))
        new = np.arange(self.size, self.size + len(order))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.starts[new] = self.used + np.cumsum(lengths) - lengths
        self.lengths[new] = lengths
        self.whole[new[len(order) - len(sick) :]] = True
        self.used, self.size = self.used + len(ids), self.size + len(order)
        short = np.fromiter((len(r) <= _SHORT for r in order), bool, len(order))
        words = np.frombuffer(b"".join(r.ljust(_SHORT, b"\0") for r in order if len(r) <= _SHORT), "<u8").reshape(-1, 2)
        self.low[new[short]], self.high[new[short]] = words[:, 0], words[:, 1]
        self._place(new[short])
        self.long.update((r, i) for r, i in zip(order, new.tolist()) if len(r) > _SHORT)
        entry = dict(zip(order, new.tolist()))
        return [entry[r] for r in pieces]

    def _model_ids(self, before: str, letters: str, marks: str) -> list[int]:
        word = " " + letters if before == " " else letters
        word = word.replace(" ", "\u0120") if word.isascii() else _byte_level(word)
        ids = [t.id for t in self.model.tokenize(word)]
        if before == "\n":
            ids = self._tail(before) + ids
        return ids + self._tail(marks) if marks else ids

    def _tail(self, marks: str) -> list[int]:
        if marks not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[marks] = [t.id for t in self.model.tokenize(_byte_level(marks))]
        return self.tails[marks]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each with the end id, and their numbers."""
        alone = [i for i, t in enumerate(texts) if b"\0" in t]
        joined = b"\0".join(b"" if b"\0" in t else t for t in texts) + bytes(1 + _SHORT)
        raw = np.frombuffer(joined, np.uint8)
        body = raw[:-_SHORT]
        blank, end = _BLANK[body], body == 0
        after = np.r_[True, end[:-1]]
        before = np.r_[False, blank[:-1]]
        cut = after | end | blank & ~before
        cut[:-1] |= blank[:-1] & before[:-1] & ~blank[1:] & ~end[1:]
        at = np.flatnonzero(cut)
        size = np.diff(np.r_[at, len(body)])
        words = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        low = words[at] & _KEEP[np.minimum(size, 8)]
        high = words[at + 8] & _KEEP[np.clip(size - 8, 0, 8)]
        entry = self._find(low, high)
        entry[size > _SHORT] = -1
        self.again[entry[entry > 0]] = True
        new = np.flatnonzero(entry < 0)
        if len(new):
            pieces = [joined[i : i + n] for i, n in zip(at[new].tolist(), size[new].tolist())]
            fresh = [p for p in dict.fromkeys(pieces) if p not in self.long]
            if self.size + len(fresh) > CACHE:
                if len(at) >= CACHE // 2:
                    return self._one_by_one(texts)
                self._shrink()
                return self.encode(texts)
            known = dict(zip(fresh, self._learn(fresh)))
            entry[new] = [known[p] if p in known else self.long[p] for p in pieces]
        lengths = self.lengths[entry]
        ids = self.pool[_ranges(self.starts[entry].astype(np.int64), lengths.astype(np.int64))]
        ends = np.flatnonzero(end)
        first = np.searchsorted(at, ends, side="right")
        counts = np.diff(np.r_[0, np.cumsum(lengths, dtype=np.int64)[first - 1]])
        sick = np.flatnonzero(self.whole[entry])
        if len(sick) or alone:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in {*alone, *np.searchsorted(ends, at[sick]).tolist()}:
                parts[i] = self._whole(texts[i])
            ids, counts = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, counts

    def _one_by_one(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For batches of more new pieces than the cache may hold."""
        parts = [self._whole(t) for t in texts]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array([*self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.end_id], np.uint32)

    def encode_long(self, text: bytes) -> np.ndarray:
        """The ids of one text with the end id, in stretches of about BATCH_BYTES cut before a lone blank."""
        parts, low = [], 0
        while low < len(text):
            high = len(text)
            if high - low > 2 * BATCH_BYTES:
                lone = _LONE.search(text, low + BATCH_BYTES)
                high = lone.start() + 1 if lone else high
            parts.append(self.encode([text[low:high]])[0][:-1])
            low = high
        return np.concatenate([*parts, np.array([self.end_id], np.uint32)])


#: A blank between ASCII characters that are not white space: a cut of every pre-tokenization.
_LONE = re.compile(rb"[!-~](?= [!-~])")


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one after the other."""
    stops = np.cumsum(lengths)
    return np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts - stops + lengths, lengths)


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def encoder(path: str, end_id: int) -> PieceEncoder:
    """The encoder of this Python worker; its cache, some 40 MB at most, outlives a task."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = PieceEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _batches(rows: Iterator[tuple]) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Document ids, different texts, and the text of each document, by about BATCH_BYTES; a longer text comes alone.

    Repeats of a text that follow each other, as in a mix, are one text.
    """
    ids: list[int] = []
    texts: list[bytes] = []
    copies: list[int] = []
    size = 0
    for doc_id, text in rows:
        text = text or b""
        if not texts or text != texts[-1]:
            if texts and size + len(text) > BATCH_BYTES:
                yield ids, texts, copies
                ids, texts, copies, size = [], [], [], 0
            texts.append(text)
            size += len(text)
        ids.append(doc_id)
        copies.append(len(texts) - 1)
    if texts:
        yield ids, texts, copies


def write_tokens(docs: DataFrame, path: str | None = None, end_id: int = 0) -> DataFrame:
    """The written containers in ascending doc_id order: part, first_start (ids of the part before it), n_ids, data.

    Ids come from whole texts (null: empty), each with end_id appended.  Ties of doc_id go by text;
    rows without a doc_id come first.
    """
    path = path or tokenizer_path()
    scratch = Scratch(docs.sparkSession, "tokens")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = encoder(path, end_id)
        part, before = TaskContext.get().partitionId(), 0
        doc_ids: list[int] = []
        held: list[np.ndarray] = []
        lengths: list[int] = []
        size = 0
        for ids_of, texts, copies in _batches(rows):
            ids, counts = (own.encode_long(texts[0]), None) if len(texts) == 1 and len(texts[0]) > BATCH_BYTES else own.encode(texts)
            parts = [ids] if counts is None else np.split(ids, np.cumsum(counts)[:-1])
            for doc_id, copy in zip(ids_of, copies):
                doc_ids.append(doc_id)
                held.append(parts[copy])
                lengths.append(len(parts[copy]))
                size += lengths[-1]
                if size >= CONTAINER_IDS:
                    yield part, before, size, write_container(doc_ids, lengths, np.concatenate(held))
                    before += size
                    doc_ids, held, lengths, size = [], [], [], 0
        if doc_ids:
            yield part, before, size, write_container(doc_ids, lengths, np.concatenate(held))

    ordered = docs.select(id_key().alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return scratch.save(map_rows(ordered, run, "part int, first_start long, n_ids long, data binary"))


def read_tokens(containers: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the written containers."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for part, first, _, data in rows:
            doc_ids, lengths, ids = read_container(data)
            raw = ids.astype("<u4").tobytes()
            stops = np.cumsum(lengths)
            for doc_id, n, stop in zip(doc_ids.tolist(), lengths.tolist(), stops.tolist()):
                yield part, doc_id, first + stop - n, n, zlib.crc32(raw[4 * (stop - n) : 4 * stop])

    read = map_rows(containers, run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row per written part: their number is that of partitions, never that of documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = containers.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return read.join(F.broadcast(parts), "part").select(id_back("doc_id").alias("doc_id"), (F.col("offset") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
