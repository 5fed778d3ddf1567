"""Language identification of words by a linear-chain conditional random field.

A text's lines are chains of words.  Emissions sum hashed weights of a word's affixes, character
n-grams, form and the lexicons that hold it; transitions are learned.  Forward-backward gives
every word's label distribution, so code-switched text is labelled word by word, and a document's
language has the largest mean probability over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import give_back, map_rows, packed, ship_package

UNDETERMINED = "und"
#: Hashed weights, lexicon words per language, words of a training chain that joins lines, words scored at once, cached words of a Python worker.
SLOTS, LEXICON, JOINED, BATCH_WORDS, CACHE = 1 << 16, 300, 512, 100_000, 300_000
#: Words of a chain that one pass takes; the messages of longer chains pass from piece to piece.
PIECE = 128
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (SLOTS + languages, languages)
    transitions: np.ndarray
    lexicons: list[frozenset[str]]


_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _slots(*parts: np.ndarray | int) -> np.ndarray:
    """Rows of the weight table for tuples of small numbers."""
    x = sum(np.asarray(p, np.uint64) * f for p, f in zip(parts, _FACTORS))
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    return ((x ^ x >> np.uint64(29)) % np.uint64(SLOTS)).astype(np.int32)


def features(words: list[str], lexicons: list[frozenset[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table, word after word, and where each word's begin: affixes to three letters, bigrams and trigrams, the whole word, lexicons."""
    letters = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(size + 2)
    first, every = stop - size - 2, np.arange(len(words))
    owner = np.repeat(every, size + 2)
    rows, owners = [], []
    letter = lambda at, inside: np.where(inside, letters[np.clip(at, 0, len(letters) - 1)], 0)
    for n in (1, 2, 3):
        head = [letter(first + 1 + i, i < np.minimum(n, size)) for i in range(3)]
        tail = [letter(stop - 2 - i, i < np.minimum(n, size)) for i in range(3)]
        rows += [_slots(*head, n), _slots(*tail, 3 + n)]
        owners += [every, every]
    for n in (2, 3):
        at = np.flatnonzero(np.arange(len(letters)) + n <= stop[owner])
        rows.append(_slots(letters[at], letters[at + 1], letters[at + 2] if n == 3 else 0, 5 + n))
        owners.append(owner[at])
    spread = (letters + np.uint64(1)) * _FACTORS[2] + (np.arange(len(letters)) - first[owner]).astype(np.uint64) * _FACTORS[3]
    spread = (spread ^ spread >> np.uint64(31)) * _FACTORS[0]
    rows.append(_slots(np.add.reduceat(spread ^ spread >> np.uint64(29), first), 0, 0, 9))
    owners.append(every)
    for i, known in enumerate(lexicons):
        held = np.array([k for k, w in enumerate(words) if w in known], np.int64)
        rows.append(np.full(len(held), SLOTS + i, np.int32))
        owners.append(held)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(rows)[order], np.searchsorted(owner[order], every)


def chains(text: str) -> list[list[str]]:
    """Lower-case words of each line, one chain a line whatever its length.  A word has a letter."""
    out = []
    for line in text.lower().split("\n"):
        found = _WORD.findall(line)
        if not line.isascii() and not all(map(str.isalpha, found)):
            found = [w for w in found if any(map(str.isalpha, w))]
        if found:
            out.append(found)
    return out


def forward_backward(emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: np.ndarray, pairs: bool = False, entering: np.ndarray | None = None, leaving: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities of all places of packed chains, and expected label pairs on request.

    emission: positive scores (places, labels); step: positive transition scores; entering and
    leaving: the messages (chains, labels) that come from what stands before and after each chain.
    """
    order = np.argsort(-lengths, kind="stable")
    first, size = starts[order], lengths[order]
    none = np.ones((len(size), emission.shape[1]), emission.dtype)
    entering, leaving = (none if m is None else m[order].astype(emission.dtype) for m in (entering, leaving))
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest), side="left")
    alpha = np.empty_like(emission)
    for t in range(longest):
        at = first[: live[t]] + t
        a = (entering if t == 0 else a[: live[t]] @ step) * emission[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    beta = leaving.copy()
    expected = np.zeros_like(step) if pairs else None
    for t in range(longest - 1, -1, -1):
        if t + 1 < longest:
            n = live[t + 1]
            ahead = emission[first[:n] + t + 1] * beta[:n]
            if pairs:
                joint = alpha[first[:n] + t][:, :, None] * step * ahead[:, None, :]
                expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = ahead @ step.T
            beta[:n] = b / b.sum(axis=1, keepdims=True)
        at = first[: live[t]] + t
        m = alpha[at] * beta[: live[t]]
        alpha[at] = m / m.sum(axis=1, keepdims=True)
    return alpha, expected


def in_pieces(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of pieces of up to ``most`` places that packed chains are cut into, and the chain of each."""
    counts = np.maximum(-(-lengths // most), 1)
    chain = np.repeat(np.arange(len(lengths)), counts)
    place = np.arange(len(chain)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = (np.cumsum(lengths) - lengths)[chain]
    return begin + place * most, np.minimum(most, lengths[chain] - place * most), chain


def messages(emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chain: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages that enter and leave each piece, so that pieces of one chain give what the whole chain gives.

    The transfer matrices of all pieces are multiplied up side by side, then the messages pass from piece to piece.
    """
    n = emission.shape[1]
    opens = np.r_[True, chain[1:] != chain[:-1]]
    closes = np.r_[opens[1:], True]
    entering, leaving = (np.ones((len(starts), n)) for _ in range(2))
    several = np.flatnonzero(~(opens & closes))
    transfer = np.tile(np.eye(n), (len(several), 1, 1))
    for t in range(int(lengths[several].max()) if len(several) else 0):
        live = np.flatnonzero(lengths[several] > t)
        e = emission[starts[several[live]] + t][:, None, :].astype(np.float64)
        moved = transfer[live] if t == 0 else transfer[live] @ step
        if t == 0:
            moved = np.where(opens[several[live]][:, None, None], moved, step)
        moved = moved * e
        transfer[live] = moved / moved.sum(axis=(1, 2), keepdims=True)
    where = dict(zip(several.tolist(), range(len(several))))
    for p in several.tolist():
        here = transfer[where[p]]
        end = here.sum(axis=0) if opens[p] else end @ here  # noqa: F821
        end = end / end.sum()
        if not closes[p]:
            entering[p + 1] = end @ step
    for p in reversed(several.tolist()):
        if closes[p]:
            message = np.ones(n)
        leaving[p] = message
        message = transfer[where[p]] @ message
        message = message / message.sum()
    return entering, leaving


def train(samples: list[tuple[str, str]], rounds: int = 30, seed: int = 7) -> Model:
    """A model of (text, language) pairs by AdaGrad on the regularised log-likelihood.

    Lines of different documents are joined into chains, so that transitions see switches.
    """
    langs = sorted({lang for _, lang in samples})
    if not langs:
        return Model([], np.zeros((SLOTS, 0), np.float32), np.zeros((0, 0), np.float32), [])
    lines = [(c, langs.index(lang)) for text, lang in samples for c in chains(text)]
    counts = [Counter() for _ in langs]
    for c, y in lines:
        counts[y].update(c)
    lexicons = [frozenset(w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]) for c in counts]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(lines))
    number: dict[str, int] = {}
    ids, gold, starts, lengths = [], [], [], []
    at = 0
    while at < len(order):
        size, take = 0, int(rng.integers(1, 4))
        starts.append(len(ids))
        for i in order[at : at + take]:
            c, y = lines[i]
            if size and size + len(c) > JOINED:
                starts.append(len(ids))
                lengths.append(size)
                size = 0
            ids += [number.setdefault(w, len(number)) for w in c]
            gold += [y] * len(c)
            size += len(c)
        lengths.append(size)
        at += take
    ids, gold, starts, lengths = (np.array(v, np.int64) for v in (ids, gold, starts, lengths))
    flat, edge = features(list(number), lexicons) if number else (np.empty(0, np.int32), np.empty(0, np.int64))
    owner = np.repeat(np.arange(len(number), dtype=np.int32), np.diff(np.r_[edge, len(flat)]))
    n = len(langs)
    weights, steps = np.zeros((SLOTS + n, n)), np.zeros((n, n))
    seen_w, seen_s = np.full_like(weights, 1e-6), np.full_like(steps, 1e-6)
    truth = np.eye(n)[gold]
    inside = np.ones(len(ids), bool)
    inside[starts] = False
    pairs = np.flatnonzero(inside)
    gold_pairs = np.zeros((n, n))
    np.add.at(gold_pairs, (gold[pairs - 1], gold[pairs]), 1)
    for _ in range(rounds if len(ids) else 0):
        scores = np.add.reduceat(weights[flat], edge)
        emission = np.exp(scores - scores.max(axis=1, keepdims=True))[ids] + 1e-30
        got, expected = forward_backward(emission, starts, lengths, np.exp(steps), pairs=True)
        missing = np.stack([np.bincount(ids, weights=(truth - got)[:, j], minlength=len(number)) for j in range(n)], axis=1)
        slope = np.stack([np.bincount(flat, weights=missing[owner, j], minlength=SLOTS + n) for j in range(n)], axis=1) / len(ids) - 1e-6 * weights
        seen_w += slope**2
        weights += 0.5 * slope / np.sqrt(seen_w)
        slope = (gold_pairs - expected) / len(ids) - 1e-5 * steps
        seen_s += slope**2
        steps += 0.1 * slope / np.sqrt(seen_s)
    return Model(langs, weights.astype(np.float32), np.exp(steps).astype(np.float32), lexicons)


def held_out(name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0; false without an id."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, per_lang: int = 100) -> Model:
    """A model of a bounded sample: about per_lang labelled documents of each language, outside the held-out fifth.

    Documents are chosen by a hash of their id, the same ones on every run.  Every language that is
    a label of some row is learned; the labels, not the documents, are counted on the driver.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = usable.groupBy("lang").count().select("lang", (per_lang / F.col("count")).alias("_share"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    sample = usable.select("doc_id", "text", "lang").join(F.broadcast(counts), "lang").filter(draw < F.col("_share")).select("doc_id", "text", "lang")
    return train([(r["text"], r["lang"]) for r in sorted(sample.collect(), key=lambda r: (r["doc_id"], r["text"], r["lang"]))])


class Tagger:
    """Scores words and chains with a model.  Emissions of known words are kept, up to CACHE of them."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.empty((1 << 12, len(self.model.langs)), np.float32)

    def _learn(self, words: list[str]) -> None:
        flat, edge = features(words, self.model.lexicons)
        scores = np.add.reduceat(self.model.weights[flat], edge)
        scores = np.exp(scores - scores.max(axis=1, keepdims=True)) + np.float32(1e-30)
        at = len(self.known)
        while at + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[at : at + len(words)] = scores
        self.known.update(zip(words, range(at, at + len(words))))

    def emissions(self, words: list[str]) -> np.ndarray:
        new = {w for w in words if w not in self.known}
        if new:
            if len(self.known) + len(new) > CACHE:
                self._forget()
                new = set(words)
            self._learn(sorted(new))
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def marginals(self, seqs: list[list[str]]) -> np.ndarray:
        """Label probabilities of all words of the chains, in order."""
        words = [w for s in seqs for w in s]
        if not words or not self.model.langs:
            return np.zeros((len(words), len(self.model.langs)), np.float32)
        emission, step = self.emissions(words), self.model.transitions
        starts, lengths, chain = in_pieces(np.fromiter(map(len, seqs), np.int64, len(seqs)), PIECE)
        entering, leaving = messages(emission, starts, lengths, chain, step)
        return forward_backward(emission, starts, lengths, step, entering=entering, leaving=leaving)[0]

    def documents(self, texts: list[bytes | None]) -> list[tuple[str, float, float]]:
        """Language, its mean probability, and the mean probability of each word's own best language, for each text."""
        out: list[tuple[str, float, float]] = []
        held: list[list[list[str]]] = []
        size = 0
        for text in texts:
            seqs = chains((text or b"").decode())
            held.append(seqs)
            size += sum(map(len, seqs))
            if size >= BATCH_WORDS:
                out += self._close(held)
                held, size = [], 0
        return out + self._close(held)

    def _close(self, held: list[list[list[str]]]) -> list[tuple[str, float, float]]:
        found = self.marginals([s for seqs in held for s in seqs])
        counts = np.array([sum(map(len, seqs)) for seqs in held], np.int64)
        out = [(UNDETERMINED, 0.0, 0.0)] * len(held)
        some = np.flatnonzero(counts)
        if len(some) and self.model.langs:
            first = (np.cumsum(counts) - counts)[some]
            mean = np.add.reduceat(found.astype(np.float64), first) / counts[some][:, None]
            sure = np.add.reduceat(found.max(axis=1).astype(np.float64), first) / counts[some]
            for i, m, s in zip(some.tolist(), mean, np.minimum(sure, 1.0).tolist()):
                out[i] = self.model.langs[int(m.argmax())], float(min(1.0, m.max())), s
        return out


def language_column(model: Model, text: Column) -> Column:
    """A struct of lang, score and sure for each text: the language of the document, its mean probability, and the mean
    probability of each word's own best language.  Null texts and texts without letters are ``und`` with zeros."""

    @arrow_udf("struct<lang string, score double, sure double>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Tagger(model)
        for batch in batches:
            got = [g for low in range(0, len(batch), 1024) for g in own.documents(batch.slice(low, 1024).cast(pa.binary()).to_pylist())]
            columns = [pa.array([g[0] for g in got], pa.string()), *(pa.array([g[i] for g in got], pa.float64()) for i in (1, 2))]
            yield pa.StructArray.from_arrays(columns, names=["lang", "score", "sure"])
        del own
        give_back()

    return label(text)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score (columns of these names are replaced).  Only ``text`` is read."""
    ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = packed(docs.select(kept), language_column(model, F.col("text")).alias("_found"))
    return found.select("row.*", F.col("_found.lang").alias("lang_pred"), "_found.score")


def label_words(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, line, place, word, lang, probability: every word of every text with its most probable language.

    Words are lower-case runs of letters, chains are lines.  Null texts and texts without letters give no row.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = Tagger(model)
        for doc_id, text in rows:
            lines = [(i, c) for i, line in enumerate((text or b"").decode().split("\n")) for c in chains(line)]
            found = own.marginals([c for _, c in lines])
            if not len(found) or not model.langs:
                continue
            best, sure = found.argmax(axis=1).tolist(), found.max(axis=1).tolist()
            places = ((i, k, w) for i, c in lines for k, w in enumerate(c))
            for (line, place, word), b, p in zip(places, best, sure):
                yield doc_id, line, place, word, model.langs[b], float(p)

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, line int, place int, word string, lang string, probability double")


def language_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model of the same table."""
    model = fit(docs)
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


def keep_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose words have languages: those with letters whose words' best languages are at least that probable on average.

    A document that mixes languages stays if its words are sure.  Columns are those of the input,
    whatever their names; null texts go; repeated rows go or stay together; an empty table gives an empty one.
    """
    model = fit(docs)
    ship_package(docs.sparkSession)
    found = packed(docs, language_column(model, F.col("text")).alias("_found"))
    return found.filter((F.col("_found.lang") != UNDETERMINED) & (F.col("_found.sure") >= least)).select("row.*")
