"""Substring dedup: repeated word sequences found by prefix-partitioned suffix trees.

The word suffixes of a shard are split by prefixes of variable length: a prefix
with more suffixes than a group may hold is prolonged until its parts fit, and
one with a single suffix ends there, as nothing below it repeats. Each group is
sorted into a subtree, whose internal nodes of ``window`` words and deeper are
the strings that repeat. Those preceded by different words are maximal repeats:
going up from the leaves, each leaf ends at the deepest one that an earlier
document shares, and all windows of that string are covered there.

The corpus is dealt to shards by context (``refrain.llm.repeats``), not by prefix:
suffixes dealt by prefix would each carry a window through the shuffle, that is
``window`` times the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from refrain.llm.base import batch, fresh
from refrain.llm.repeats import Units, covered, intervals, keyed

#: Suffixes of one group, and words that sorting one compares at once.
GROUP, CELLS = 1 << 16, 1 << 23


def prefix_groups(words: np.ndarray, suffix: np.ndarray, window: int, most: int = GROUP) -> Iterator[tuple[int, np.ndarray]]:
    """(prefix length, suffixes) of groups of fewer than twice ``most`` suffixes that
    share a prefix; a larger group shares ``window`` words. Single suffixes are left out."""
    work = [(0, suffix)]
    while work:
        length, group = work.pop()
        if length == window or (length and len(group) <= most):
            yield length, group
            continue
        nxt = words[group + length]
        order = np.argsort(nxt, kind="stable")
        group, nxt = group[order], nxt[order]
        at = np.flatnonzero(np.concatenate([[True], nxt[1:] != nxt[:-1]]))
        size = np.diff(np.append(at, len(group)))
        # Small neighbours are prolonged together: they share the length already reached.
        large = size > most
        work += [(length + 1, group[a : a + n]) for a, n in zip(at[large].tolist(), size[large].tolist(), strict=True)]
        small = np.flatnonzero(~large & (size > 1))
        if len(small):
            member = np.repeat(~large & (size > 1), size)
            rest = group[member]
            fill = np.cumsum(size[small]) // most
            for part in np.split(rest, np.cumsum(np.bincount(fill, weights=size[small]).astype(np.int64))[:-1]):
                if len(part):
                    yield length, part


def subtree(words: np.ndarray, group: np.ndarray, length: int = 0, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of a group's suffix tree in order, and the string depth of the node that
    joins each leaf with the one before (0 for the first). All share ``length`` words;
    suffixes must differ in the end, as they do if every context ends in its own mark."""
    leaves, depth = group.copy(), np.zeros(len(group), dtype=np.int64)
    open_, part = np.arange(len(group)), np.zeros(len(group), dtype=np.int64)
    while len(open_):
        step = max(1, min(64, cells // len(open_)))
        at = leaves[open_]
        rows = np.empty((len(open_), step + 1), dtype=">u4")
        rows[:, 0] = part
        rows[:, 1:] = words[np.minimum(at[:, None] + (length + np.arange(step)), len(words) - 1)]
        order = np.argsort(np.ascontiguousarray(rows).view(f"V{4 * (step + 1)}").reshape(-1), kind="stable")
        leaves[open_], rows = at[order], rows[order]
        differ = rows[1:] != rows[:-1]
        parted = differ.any(axis=1)
        # Where suffixes of one part differ first is a node; parts met in an earlier round.
        inner = parted & ~differ[:, 0]
        depth[open_[1:][inner]] = length + differ[inner].argmax(axis=1) - 1
        new = np.concatenate([[True], parted])
        size = np.diff(np.append(np.flatnonzero(new), len(new)))
        still = np.repeat(size > 1, size)
        open_, part = open_[still], (np.cumsum(new) - 1)[still]
        length += step
    return leaves, depth


def covered_depth(owner: list[int], depth: list[int], window: int) -> list[int]:
    """For every leaf the depth of the deepest node, of ``window`` or more, with a leaf of an
    earlier document below it; 0 if there is none.

    Nodes are met from below. One keeps its earliest document and that document's
    leaves; all others are covered by the node's string and done with.
    """
    reach = [0] * len(owner)
    if not owner:
        return reach
    stack: list[tuple[int, int, list[int]]] = []
    least, waiting = -1, []

    def join(node: tuple[int, int, list[int]], least: int, waiting: list[int]) -> tuple[int, int, list[int]]:
        d, first, held = node
        if first == least:
            if len(held) < len(waiting):
                held, waiting = waiting, held
            held += waiting
            return node if held is node[2] else (d, first, held)
        if least < first:
            first, held, waiting = least, waiting, held
        for leaf in waiting:
            reach[leaf] = d
        return d, first, held

    for i, d in enumerate([*depth[1:], 0]):
        least, waiting = owner[i], [i]
        while stack and stack[-1][0] > d:
            _, least, waiting = join(stack.pop(), least, waiting)
        if d < window:
            stack.clear()
        elif stack and stack[-1][0] == d:
            stack[-1] = join(stack[-1], least, waiting)
        else:
            stack.append((d, least, waiting))
    return reach


def later_windows(contexts: list[bytes], counts: list[int], docs: np.ndarray, window: int, most: int = GROUP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(context, first window, windows) of windows whose words start in an earlier document too."""
    number: dict[bytes, int] = {}
    parts = [np.fromiter((number.setdefault(w, len(number)) for w in c.split(b" ")), dtype=np.uint32) for c in contexts]
    size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1
    begin = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), dtype=np.uint32)
    marks = begin + size - 1  # each context ends in a mark of its own
    inside = np.ones(len(words), dtype=bool)
    inside[marks] = False
    words[inside] = np.concatenate([*parts, np.zeros(0, np.uint32)])
    words[marks] = len(number) + np.arange(len(marks), dtype=np.uint32)
    del parts, number, inside
    n = np.asarray(counts, dtype=np.int64)
    suffix = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    owner = np.repeat(docs, size)
    later = np.zeros(len(words) + 1, dtype=np.int32)
    for length, group in prefix_groups(words, suffix, window, most):
        leaves, depth = subtree(words, group, length)
        # Strings of window words and more that repeat: runs of leaves joined that deep.
        node = np.concatenate([[True], depth[1:] < window])
        which = np.cumsum(node) - 1
        first = np.flatnonzero(node)
        # A repeat that the same word precedes everywhere isn't maximal: the one that starts there tells all about it.
        before = words[leaves - 1]  # of the first suffix the last mark
        maximal = np.minimum.reduceat(before, first) < np.maximum.reduceat(before, first)
        keep = maximal[which]
        leaves, depth = leaves[keep], np.where(node, 0, depth)[keep]
        reach = np.array(covered_depth(owner[leaves].tolist(), depth.tolist(), window), dtype=np.int64)
        hit = reach > 0
        np.add.at(later, leaves[hit], 1)
        np.add.at(later, leaves[hit] + reach[hit] - window + 1, -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(later) > 0).view(np.int8)]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    which = np.searchsorted(begin, first, side="right") - 1
    yield which, first - begin[which], end - first


_TEXTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def substring_dedup(docs: DataFrame, *, window: int = 50, digests: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a ``window``-word string of an earlier document.

    Earlier documents have smaller ids; repeats within one document stay.
    Windows are judged on the input. Returns doc_id, n_words, n_removed,
    kept_sha256 and kept (the words left, joined by a space; null with
    ``digests``). Words are runs of bytes other than ASCII white space. Null and
    empty texts have no words; a text shorter than the window loses nothing.
    Rows equal in id and text are one document and all return its result;
    different texts under one id are documents of equal rank that don't remove
    each other's words. Extra columns are ignored.
    """
    units = Units("words", window, max(1, window // 5), False)

    @fresh
    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for text, start, end in intervals(b, units):
                words = text.split()
                kept = words
                if len(start):
                    kept = [w for x, y in zip([0, *end.tolist()], [*start.tolist(), len(words)], strict=True) for w in words[x:y]]
                joined = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), None if digests else joined.decode()))
            yield batch(_TEXTS, b.column("doc_id"), *([r[i] for r in rows] for i in range(4)))

    def judge(contexts: list[bytes], counts: list[int], docs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return later_windows(contexts, counts, docs, window)

    return covered(keyed(docs, id_col, text_col), units, judge).mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
