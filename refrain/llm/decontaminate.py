"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive words: hashes of the words at its marked
places are compared, words at the others are free. Test and training texts are
hashed at every place; equal hashes are hits. Around a hit the two texts are
laid side by side and compared word by word, so that an overlap survives single
substituted words wherever a mask leaves them free.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.base import batch, cut, fresh, id_text, utf8

#: Masks over eight to eleven words, seven of them marked; differing words can fall into the gaps.
#: Wherever two of ``OVERLAP`` words differ, the most that ``AGREE`` allows, one of these fits between (tested by enumeration).
MASKS = ("11110111", "1110110011", "11010010111")
#: An overlap's length in words, and the share of its words that must agree.
OVERLAP, AGREE = 13, 0.8
#: Test words whose whole index (about 60 bytes a word) may be held and sent at once.
SENT_WORDS = 1 << 20

_WORD = regex.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    """Runs of letters and digits, A-Z lower-cased."""
    return _WORD.findall(text.lower())


_SEED = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(found: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, found), dtype=np.uint64, count=len(found))


def seed_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each place where the mask fits."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask) * 131 + sum(1 << i for i, m in enumerate(mask) if m == "1"), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i, m in enumerate(mask):
            if m == "1":
                out = (out ^ h[i : i + n]) * _SEED
                out ^= out >> np.uint64(31)
    return out


@dataclass
class TestIndex:
    """Hashed benchmark items: word hashes of all items end to end, and sorted seed hashes with their places."""

    item: np.ndarray
    start: np.ndarray
    hashes: np.ndarray
    seeds: list[tuple[np.ndarray, np.ndarray]]
    short: dict[bytes, list[int]]

    @staticmethod
    def build(items: list[tuple[int, bytes]], masks: tuple[str, ...] = MASKS, overlap: int = OVERLAP) -> TestIndex:
        item, start, hashes, short = [], [0], [], {}
        for i, text in sorted(items):
            found = words(text)
            if not found:
                continue
            if len(found) < overlap:  # too short for an overlap: matched whole
                short.setdefault(b" ".join(found), []).append(i)
                continue
            item.append(i)
            hashes.append(word_hashes(found))
            start.append(start[-1] + len(found))
        seeds = []
        for mask in masks:
            key = [seed_hashes(h, mask) for h in hashes]
            place = [s + np.arange(len(k)) for s, k in zip(start, key, strict=False)]
            key = np.concatenate([*key, np.zeros(0, np.uint64)])
            place = np.concatenate([*place, np.zeros(0, np.int64)])
            order = np.argsort(key, kind="stable")
            seeds.append((key[order], place[order]))
        return TestIndex(np.array(item, dtype=np.int64), np.array(start, dtype=np.int64), np.concatenate([*hashes, np.zeros(0, np.uint64)]), seeds, short)

    def hits(self, h: np.ndarray, masks: tuple[str, ...]) -> np.ndarray:
        """Distinct (diagonal, test word) of all seed hits: columns place - test place, test place."""
        out = []
        for mask, (key, place) in zip(masks, self.seeds, strict=True):
            mine = seed_hashes(h, mask)
            if not len(mine) or not len(key):
                continue
            lo = np.searchsorted(key, mine)
            at = np.flatnonzero(key[np.minimum(lo, len(key) - 1)] == mine)
            if not len(at):
                continue
            n = np.searchsorted(key, mine[at], side="right") - lo[at]
            test = place[np.repeat(lo[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            out.append(np.stack([np.repeat(at, n) - test, test]))
        return np.unique(np.concatenate(out, axis=1), axis=1) if out else np.zeros((2, 0), np.int64)

    def overlaps(self, found: list[bytes], masks: tuple[str, ...] = MASKS, overlap: int = OVERLAP, agree: float = AGREE) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, share of equal words) of every verified overlap of a text."""
        h, out = word_hashes(found), []
        diagonal, test = self.hits(h, masks)
        which = np.searchsorted(self.start, test, side="right") - 1
        seen: set[tuple[int, int]] = set()
        for d, i in zip(diagonal.tolist(), which.tolist(), strict=True):
            if (d, i) in seen:
                continue
            seen.add((d, i))
            # The whole diagonal of this item that lies inside the text.
            a, b = max(int(self.start[i]), -d), min(int(self.start[i + 1]), len(h) - d)
            if b - a < overlap:
                continue
            same = h[a + d : b + d] == self.hashes[a:b]
            total = np.concatenate([[0], np.cumsum(same)])
            share = (total[overlap:] - total[:-overlap]) / overlap
            edge = np.diff(np.concatenate([[0], (share >= agree).view(np.int8), [0]]))
            # Each run of windows that agree is an overlap of its own.
            for first, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                last = end - 1 + overlap
                out.append((int(self.item[i]), a + d + first, last - first, float(same[first:last].mean())))
        return sorted(out)


_ROWS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("agreement", pa.float64())])


def _matches(data: np.ndarray, at: np.ndarray, index: TestIndex, masks: tuple[str, ...], overlap: int, agree: float) -> Iterator[tuple[int, tuple]]:
    """(row, (item, first word, words, agreement)) for the texts of a batch."""
    sizes = sorted({s.count(b" ") + 1 for s in index.short})
    for row, (x, y) in enumerate(zip(at, at[1:], strict=False)):
        found = words(data[x:y].tobytes())
        for match in index.overlaps(found, masks, overlap, agree):
            yield row, match
        for size in sizes:
            for i in range(len(found) - size + 1):
                for item in index.short.get(b" ".join(found[i : i + size]), ()):
                    yield row, (item, i, size, 1.0)


def contamination(docs: DataFrame, benchmark: DataFrame, *, masks: tuple[str, ...] = MASKS, overlap: int = OVERLAP, agree: float = AGREE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Overlaps of training texts with benchmark items (item_id, text).

    Returns doc_id, item_id, first_word, n_words, agreement: one row for each
    run of windows on a diagonal with an item, each of ``overlap`` words of which
    a share of ``agree`` are equal, where a seed hits the diagonal, as one always
    does with the default masks, overlap and share; agreement is that of the whole run. Items shorter than ``overlap`` words
    count where they stand whole. Texts or items that are null, empty or without
    words overlap nothing; repeated documents or items each give their rows;
    extra columns are ignored.

    Test hashes go to the executors in parts of about ``SENT_WORDS`` words at most
    (a longer single item is a part of its own). Several parts are worked off one
    after another, each a pass over the documents whose matches are checkpointed,
    so neither the driver nor an executor holds more than one at a time.
    """
    texts = id_text(docs, id_col, text_col)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    letters = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    parts = -(-letters // (2 * SENT_WORDS)) or 1  # a word takes two letters or more with its gap
    out = None
    for part in range(parts):
        mine = items.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part)
        index = TestIndex.build([(r.item_id, r.text.encode()) for r in mine.collect()], masks, overlap)

        @fresh
        def run(batches: Iterable[pa.RecordBatch], index: TestIndex = index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                data, at = utf8(b.column("text"))
                rows = list(_matches(data, at, index, masks, overlap, agree))
                ids = b.column("doc_id").take(pa.array([r[0] for r in rows], type=pa.int64()))
                yield batch(_ROWS, ids, *([r[1][i] for r in rows] for i in range(4)))

        found = texts.mapInArrow(run, "doc_id long, item_id long, first_word long, n_words long, agreement double")
        if parts > 1:
            found = cut(found)
        out = found if out is None else out.unionByName(found)
    return out

