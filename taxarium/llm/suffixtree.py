"""Substring deduplication of words by prefix-partitioned suffix trees.

Suffixes meet by their prefix: ``repeats`` reads them from sampled places on (the anchors, whose
ten words are the prefix of a group) and lengthens the prefix of a hot group, to some forty words
and at last to the whole window, until a group fits.  Within a group the tree grows top-down, all
nodes of a level at once: the suffixes of a node are split by their next word, and a node with one
suffix is a leaf and stops.  Nodes that still hold several suffixes at the window length are the
deep internal nodes: their suffixes are equal windows, and the runs of such windows are the
maximal repeats.  Words are compared by 64-bit hashes; equal contexts of one anchor are one entry
of the tree, with the first document that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import word_units
from .common import map_rows
from .repeats import Kind, apply_spans, removed_mask, removed_spans

KIND = Kind(by_words=True, span=50, k=10, within=False)


def deep_nodes(words: np.ndarray, suffix: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix start, the number of its node at ``depth``; leaves above it have numbers of their own."""
    node = np.zeros(len(suffix), np.int64)
    live = np.arange(len(suffix))
    closed = 0
    out = np.empty(len(suffix), np.int64)
    for level in range(depth):
        if not len(live):
            break
        # The edges below each node, by next word.
        joint = node << 32 | words[suffix[live] + level]
        order = np.argsort(joint, kind="stable")
        live, joint = live[order], joint[order]
        head = np.r_[True, joint[1:] != joint[:-1]]
        sizes = np.diff(np.r_[np.flatnonzero(head), len(joint)])
        several = np.repeat(sizes > 1, sizes)
        leaves = live[~several]
        out[leaves] = closed + np.arange(len(leaves))
        closed += len(leaves)
        node = (np.cumsum(head) - 1)[several]
        live = live[several]
    if len(live):
        out[live] = closed + node
    return out


def window_groups(kind: Kind, contexts: list[bytes], n: np.ndarray) -> np.ndarray:
    """Group numbers of all windows of the contexts: their nodes at the window length."""
    text = b" ".join(contexts)
    starts, _, hashes = word_units(text)
    words = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
    length = np.fromiter(map(len, contexts), np.int64, len(contexts))
    first = np.searchsorted(starts, np.cumsum(length + 1) - length - 1)
    row = np.repeat(np.arange(len(contexts)), n)
    suffix = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return np.unique(deep_nodes(words, suffix, kind.span), return_inverse=True)[1]


def dedup_words(docs: DataFrame, kind: Kind = KIND) -> DataFrame:
    """doc_id, n_words, n_removed, kept: each text's words without those that windows of smaller doc_ids cover.

    Null texts have no words.  Rows without a doc_id come before all others.  Rows that share a
    doc_id remove nothing from each other.
    """
    spans, repeated = removed_spans(docs, kind, window_groups)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, spans, copy in rows:
            words = (text or b"").split()
            gone = removed_mask(len(words), kind.span, spans, copy)
            kept = words if not gone.any() else [w for w, g in zip(words, gone.tolist()) if not g]
            yield doc_id, len(words), int(gone.sum()), b" ".join(kept).decode()

    return map_rows(apply_spans(docs, spans, repeated), run, "doc_id long, n_words long, n_removed long, kept string")


def digests(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
