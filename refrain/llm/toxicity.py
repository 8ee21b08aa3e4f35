"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are all words of the examples, and those beginnings of ``PREFIX`` letters
whose rates differ between the labels for sure. A term's inverse document frequency is scaled by how surely its rate differs
between the labels, with a floor, so that every term counts and telling ones
count most. The examples make a block-max inverted index: each block has its own
postings, and each term's largest weight in the block. A query visits blocks by
their upper bound and stops once no block can change its nearest ``k``, so the
result is that of a full scan. Votes weighted by distance are calibrated by
isotonic regression on the examples themselves, each voted on by the others, and
come with the neighbours as evidence.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.base import batch, fit_rows, fresh, id_text, join_few, kept, release, utf8

#: Labelled rows that a fit may use, chosen by a hash of their ids; the index holds them all.
FIT_ROWS = 3_000
#: Letters of a word's beginning, examples to a block, neighbours that vote.
PREFIX, BLOCK, NEIGHBOURS = 5, 512, 15
#: A term's scale: FLOOR plus how far its label odds are beyond SURE standard errors.
FLOOR, SURE = 0.1, 3.0
#: New words that a worker remembers, and heaviest terms given as evidence.
REMEMBERED, SHOWN = 1 << 17, 5

_WORD = regex.compile(r"\p{L}+")


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: upper ends of the pools and their smoothed rates."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        if pools and pools[-1][0] == a:
            pools[-1][1] += b
            pools[-1][2] += 1
        else:
            pools.append([float(a), float(b), 1.0])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            top = pools.pop()
            pools[-1] = [top[0], pools[-1][1] + top[1], pools[-1][2] + top[2]]
    return np.array([p[0] for p in pools]), np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])


def _tally(words: list[str]) -> Counter:
    """Counts of all terms; a beginning is told from a word by the mark after it."""
    found = Counter(words)
    for word, n in list(found.items()):
        if len(word) > PREFIX:
            found[word[:PREFIX] + "-"] += n
    return found


class Vocabulary:
    """Numbers of the terms in a list of words."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        # A word's own number and its beginning's, each one more or 0, in one integer.
        self._known: dict[str, int] = {}

    def _look(self, word: str) -> int:
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        start = self.number.get(word[:PREFIX] + "-", -1) if len(word) > PREFIX else -1
        found = self._known[word] = self.number.get(word, -1) + 1 << 32 | start + 1
        return found

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms in a text, in order, and how often each comes."""
        words = _WORD.findall(text.lower())
        found = list(map(self._known.get, words))
        at = -1
        try:
            while True:
                at = found.index(None, at + 1)
                found[at] = self._look(words[at])
        except ValueError:  # all are known
            pass
        both = np.array(found, dtype=np.int64)
        numbers = np.concatenate([both >> 32, both & 0xFFFFFFFF])
        numbers.sort()
        numbers = numbers[np.searchsorted(numbers, 1) :] - 1
        first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])) if len(numbers) else np.zeros(0, np.int64)
        return numbers[first], np.diff(np.append(first, len(numbers)))


@dataclass
class Index:
    """The fitted examples. A term's postings in a block are ``place`` and ``weight`` from
    ``at[term, block]`` to the next entry; ``ceiling[term, block]`` is their largest weight."""

    terms: list[str]
    scale: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    place: np.ndarray
    weight: np.ndarray
    at: np.ndarray
    ceiling: np.ndarray
    prior: float
    bare: float
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(0), np.zeros(0)))

    def vector(self, t: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (1 + np.log(n)) * self.scale[t]
        return w / (np.linalg.norm(w) or 1)

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, but: int = -1) -> list[tuple[float, int]]:
        """The ``k`` nearest as (cosine, place), best first, equal ones by place; ``but`` is left out."""
        if not len(t) or not len(self.place):
            return []
        blocks = self.ceiling.shape[1]
        bound, first = w @ self.ceiling[t], t * blocks
        score, place = np.zeros(0), np.zeros(0, np.int64)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(score) == k and bound[b] + 1e-6 < score[-1]:
                break
            lo = self.at[first + b]
            n = self.at[first + b + 1] - lo
            which = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            mine = np.bincount(self.place[which], weights=np.repeat(w, n) * self.weight[which], minlength=BLOCK)
            at = np.flatnonzero(mine > (0 if len(score) < k else score[-1] - 1e-9))
            at = at[at + b * BLOCK != but]
            score, place = np.concatenate([score, np.round(mine[at], 12)]), np.concatenate([place, at + b * BLOCK])
            best = np.lexsort((place, -score))[:k]
            score, place = score[best], place[best]
        return list(zip(score.tolist(), place.tolist(), strict=True))

    def vote(self, near: list[tuple[float, int]]) -> float:
        weight = np.array([1 / (1.05 - c) for c, _ in near])
        return float(((weight * self.label[[p for _, p in near]]).sum() + self.prior) / (weight.sum() + 1))

    def score(self, near: list[tuple[float, int]]) -> float:
        if not near or not len(self.steps[0]):
            return self.bare
        ends, rates = self.steps
        return float(rates[min(np.searchsorted(ends, self.vote(near)), len(ends) - 1)])


def _alike(rows: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray) -> np.ndarray:
    """An order that puts examples with the same common terms together. It decides about cost alone."""
    common = np.argsort(-df, kind="stable")[:256]
    column = np.full(len(df), -1)
    column[common] = np.arange(len(common))
    dense = np.zeros((len(rows), len(common)))
    for i, (t, w) in enumerate(rows):
        c = column[t]
        dense[i, c[c >= 0]] = w[c >= 0]
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = dense / np.where(norm > 0, norm, 1)
    centre = dense[np.linspace(0, len(rows) - 1, 8).astype(int)]
    for _ in range(12):
        near = np.argmax(dense @ centre.T, axis=1)
        centre = np.stack([dense[near == c].mean(axis=0) if (near == c).any() else centre[c] for c in range(len(centre))])
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    return np.argsort(near, kind="stable")


def build_index(rows: list[tuple[int, int, dict[str, int]]], k: int = NEIGHBOURS) -> Index:
    """``rows``: (id, label 0 or 1, term counts) of the fitted examples, in any order."""
    rows = sorted(rows, key=lambda r: (r[0], r[1], sorted(r[2].items())))
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for _, label, counts in rows:
        seen[label].update(counts.keys())
    terms = sorted(seen[0] | seen[1])
    toxic, clean = (sum(r[1] == label for r in rows) for label in (1, 0))
    a, b = (np.array([seen[label][t] for t in terms], dtype=np.float64) for label in (1, 0))
    odds = np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))
    sure = np.abs(odds) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    keep = (sure > SURE) | np.array([not t.endswith("-") for t in terms], dtype=bool)
    terms, a, b, sure = [t for t, k in zip(terms, keep.tolist(), strict=True) if k], a[keep], b[keep], sure[keep]
    number = {t: i for i, t in enumerate(terms)}
    rows = [(i, label, {t: n for t, n in counts.items() if t in number}) for i, label, counts in rows]
    idf = np.log((len(rows) + 1) / (a + b + 1)) + 1
    with_terms, bare = [r for r in rows if r[2]], [r for r in rows if not r[2]]
    index = Index(
        terms,
        idf * (FLOOR + np.maximum(sure - SURE, 0)),
        *(np.zeros(0) for _ in range(5)),
        np.zeros((len(terms), -(-len(with_terms) // BLOCK)), dtype=np.float32),
        (toxic + 0.5) / (len(rows) + 1),
        (sum(r[1] for r in bare) + 0.5) / (len(bare) + 1) if bare else 0.5 / (len(rows) + 2),
    )
    vectors = []
    for _, _, counts in with_terms:
        t = np.array(sorted(number[x] for x in counts), dtype=np.int64)
        vectors.append((t, index.vector(t, np.array([counts[terms[i]] for i in t], dtype=np.float64))))
    order = _alike(vectors, a + b).tolist() if vectors else []
    with_terms, vectors = [with_terms[i] for i in order], [vectors[i] for i in order]
    index.ids, index.label = np.array([r[0] for r in with_terms], dtype=np.int64), np.array([r[1] for r in with_terms], dtype=np.float64)
    if vectors:
        blocks = index.ceiling.shape[1]
        t, w = (np.concatenate([v[j] for v in vectors]) for j in (0, 1))
        example = np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors])
        cell = t * blocks + example // BLOCK
        order = np.argsort(cell, kind="stable")
        cell, index.place, index.weight = cell[order], (example[order] % BLOCK).astype(np.int16), w[order]
        index.at = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=index.ceiling.size))]).astype(np.int32)
        used = np.flatnonzero(np.diff(index.at))
        index.ceiling.ravel()[used] = np.nextafter(np.maximum.reduceat(index.weight, index.at[used]).astype(np.float32), np.float32(2))
        votes = np.array([index.vote(index.nearest(t, w, k, but=i)) for i, (t, w) in enumerate(vectors)])
        index.steps = isotonic(votes, index.label)
    return index


def _strings(column: pa.Array) -> Iterator[str]:
    data, at = utf8(column)
    for a, b in zip(at, at[1:], strict=False):
        yield data[a:b].tobytes().decode("utf-8", "replace")


_EXAMPLE = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32()))])
_NEAR = pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.list_(_NEAR)), ("terms", pa.list_(pa.string()))])


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, rows: int = FIT_ROWS, k: int = NEIGHBOURS, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index the texts of at most ``rows`` of ``labels`` (doc_id, label).

    Labels other than 0 and 1, nulls among them, are left out. A null text is an
    example without terms. A label given twice, or an id with several texts, makes
    an example each time. With no labelled text every score is 0.25.
    """
    keys = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    texts = join_few(id_text(docs, id_col, text_col), fit_rows(keys, "doc_id", rows), "doc_id").select("doc_id", "text", "label")

    @fresh
    def examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_tally(_WORD.findall(text.lower())) for text in _strings(b.column("text"))]
            yield batch(_EXAMPLE, b.column("doc_id"), b.column("label"), [list(f) for f in found], [list(f.values()) for f in found])

    got = texts.mapInArrow(examples, "doc_id long, label int, terms array<string>, counts array<int>").toArrow()
    columns = [got.column(c).to_pylist() for c in _EXAMPLE.names]
    index = build_index([(i, label, dict(zip(t, n, strict=True))) for i, label, t, n in zip(*columns, strict=True)], k)
    del got, columns
    release()  # the driver may have more stages to run
    return index


def score_toxicity(docs: DataFrame, index: Index, *, k: int = NEIGHBOURS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: doc_id, score in 0..1, evidence (the nearest
    examples with their labels and cosines), terms (the heaviest it shares with the index).

    A text with none of the index's terms, as a null or empty one, gets the
    smoothed rate of toxic examples without terms, and no evidence. Equal texts
    score alike; repeated rows each give a row; extra columns are ignored. The
    index is bounded by the fit's rows. No shuffle.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast(index), str(uuid4())  # a worker loads it once, not for every task

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, index = kept(key, lambda: (Vocabulary(sent.value.terms), sent.value))
        gc.disable()  # the vocabulary has no cycles, and going through it takes long
        try:
            for b in batches:
                scores, found, near, heavy = [], [0], [], []
                for text in _strings(b.column("text")):
                    t, n = vocabulary.counts(text)
                    w = index.vector(t, n)
                    best = index.nearest(t, w, k)
                    scores.append(index.score(best))
                    near += best
                    found.append(len(near))
                    heavy.append([index.terms[i] for i in t[np.lexsort((t, -w))[:SHOWN]].tolist()])
                place = np.array([p for _, p in near], dtype=np.int64)
                evidence = pa.StructArray.from_arrays([pa.array(index.ids[place]), pa.array(index.label[place].astype(np.int32)), pa.array([c for c, _ in near], type=pa.float64())], fields=list(_NEAR))
                yield batch(_SCORES, b.column("doc_id"), scores, pa.ListArray.from_arrays(pa.array(found, type=pa.int32()), evidence), pa.array(heavy, type=_SCORES.field("terms").type))
        finally:
            gc.enable()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id: long, label: int, cosine: double>>, terms array<string>")
