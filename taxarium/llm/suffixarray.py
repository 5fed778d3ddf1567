"""Suffix-array deduplication of bytes: Larsson-Sadakane refinement and Kasai common prefixes in numpy.

Each shard's contexts are one text.  Suffixes end with their context.  ``suffix_array`` sorts by
eight bytes and then doubles the compared depth, re-sorting only groups that are still tied, until
the depth reaches the end of the longest context.  ``common_prefixes`` runs Kasai's scan over all contexts in
step: going one place to the right keeps all but one of the bytes in common.  Windows are equal
where neighbours in the array have at least their length in common.  ``repeats`` makes the shards;
the windows that several shards of a hot anchor leave as first, sorted as in their suffix arrays,
are merged by binary search of the suffixes of one shard in those of another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows
from .repeats import Kind, apply_spans, removed_mask, removed_spans

KIND = Kind(by_words=False, span=100, k=32, within=True)


def suffix_array(text: np.ndarray, stop: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their first ``depth`` bytes at least (ties stay in place), and ranks (equal for ties).

    stop: where each position's context ends; shorter suffixes sort before those they begin.
    """
    n = len(text)
    left = stop - np.arange(n)
    padded = np.r_[text, np.zeros(8, np.uint8)].astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | np.where(left > i, padded[i : i + n], np.uint64(0))
    # Zero bytes of the text and missing ones look alike in the key, so the length decides.
    short = np.minimum(left, 8)
    order = np.argsort(key, kind="stable") if (short == 8).all() else np.lexsort((short, key))
    changed = np.r_[True, (key[order][1:] != key[order][:-1]) | (short[order][1:] != short[order][:-1])]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(changed, np.arange(n), 0))
    h = 8
    while h < depth:
        starts = np.flatnonzero(changed)
        sizes = np.diff(np.r_[starts, n])
        tied = np.repeat(sizes > 1, sizes)
        places = np.flatnonzero(tied)
        if not len(places):
            break
        at = order[places]
        ahead = at + h
        follow = np.where(ahead < stop[at], rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[at]
        joint = group << 32 | follow
        by = np.argsort(joint, kind="stable")
        order[places] = at[by]
        joint = joint[by]
        changed[places] = np.r_[True, joint[1:] != joint[:-1]]
        rank[order] = np.maximum.accumulate(np.where(changed, np.arange(n), 0))
        h *= 2
    return order, rank


def common_prefixes(text: np.ndarray, start: np.ndarray, count: np.ndarray, stop: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """By place in the array: bytes in common with the suffix before, up to ``most``, for the first ``count`` positions of each context."""
    n = len(text)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    common = np.zeros(n, np.int64)
    lane = np.argsort(-count, kind="stable")
    at, ends, left = start[lane].copy(), stop[start[lane]], count[lane]
    have = np.zeros(len(lane), np.int64)
    for step in range(int(count.max()) if len(count) else 0):
        live = int(np.searchsorted(-left, -step, side="left"))
        i = at[:live] + step
        here = place[i]
        j = order[np.maximum(here - 1, 0)]
        limit = np.minimum(np.minimum(ends[:live] - i, stop[j] - j), most)
        limit[here == 0] = 0
        k = np.minimum(have[:live], limit)
        open_ = np.flatnonzero(k < limit)
        while len(open_):
            same = text[i[open_] + k[open_]] == text[j[open_] + k[open_]]
            open_ = open_[same]
            k[open_] += 1
            open_ = open_[k[open_] < limit[open_]]
        common[here] = k
        have[:live] = np.maximum(k - 1, 0)
    return common


def window_groups(kind: Kind, contexts: list[bytes], n: np.ndarray) -> np.ndarray:
    """Group numbers of all windows of the contexts, by suffix array and common prefixes."""
    text = np.frombuffer(b"".join(contexts), np.uint8)
    length = np.fromiter(map(len, contexts), np.int64, len(contexts))
    stops = np.cumsum(length)
    starts = stops - length
    stop = np.repeat(stops, length)
    # Sorted to the end of the contexts: Kasai's scan needs one order at every depth.
    order, _ = suffix_array(text, stop, int(length.max()))
    common = common_prefixes(text, starts, n, stop, order, kind.span)
    row = np.repeat(np.arange(len(contexts)), n)
    window = starts[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    is_window = np.zeros(len(text), bool)
    is_window[window] = True
    # Suffixes tied to the window length stand together; any between two equal windows is as long and equal.
    head = ~is_window[order] | (common < kind.span)
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(head)
    return group[window]


def dedup_bytes(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: each text without bytes that earlier windows cover.

    Earlier is a smaller doc_id, or an earlier start in the same document.  Null texts are empty.
    Rows without a doc_id come before all others.  Rows that share a doc_id go by a hash of their
    text; repeated rows are one document and lose the same bytes.
    """
    spans, repeated = removed_spans(docs, kind, window_groups)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, spans, copy in rows:
            text = text or b""
            gone = removed_mask(len(text), kind.span, spans, copy)
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[:1].sum())
            yield doc_id, len(text), int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()

    return map_rows(apply_spans(docs, spans, repeated), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(result: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
