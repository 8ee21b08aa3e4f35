"""External induced sorting of suffixes, with common-prefix lengths.

Suffixes are ordered by their first ``depth`` symbols. Sorted S* suffixes (an
S-type suffix after an L-type one) are seeds: their substrings are named, and the string
of names is sorted by recursion. Two passes induce the rest. Each pass pops tuples (key, position, common prefix with the one before of that key)
from a monotone priority queue, and pushes the tuple of the position before; its
common prefix is one more than the least one popped since the last push of the
same key. Seeds are sorted by the same two passes, run on them in text order.
The queue keeps its buckets on disk once they outgrow its budget and gives them
back a part at a time, and a level's arrays are mapped files once they do, so
memory follows the budget: a bucket with several keys, of a string of names, is
the most that is held at once. What fits the budget is sorted in memory, seeds by
radix and names by doubling.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

_BLOCK = 1 << 20


def mapped(n: int, dtype, budget: int) -> np.ndarray:
    """An empty array, as a mapped file if it takes more than a quarter of the budget."""
    if n * np.dtype(dtype).itemsize <= budget // 4:
        return np.empty(n, dtype=dtype)
    with tempfile.TemporaryFile() as f:  # the mapping keeps the file until it is dropped
        return np.memmap(f, dtype=dtype, mode="w+", shape=(n,))


class BucketQueue:
    """A monotone priority queue: key ranges are buckets, each a first-in-first-out list of tuples.

    ``take`` gives a bucket's tuples by key, those of equal keys in the order of
    their pushes. Beyond ``budget`` bytes the tuples held move to the buckets' files;
    a bucket of one key comes back in parts, and takes further pushes meanwhile.
    """

    def __init__(self, keys: int, buckets: int, budget: int, dtype=np.int64):
        self.dtype = np.dtype(dtype)
        self.width = max(1, -(-keys // buckets))
        self.count = -(-keys // self.width)
        self.held: dict[int, list[np.ndarray]] = {}
        self.files: dict[int, object] = {}
        self.read: dict[int, int] = {}
        self.bytes, self.budget = 0, budget

    def push(self, key: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        if not len(key):
            return
        bucket = key // self.width
        rows = np.empty((len(key), 3), dtype=self.dtype)
        rows[:, 0], rows[:, 1], rows[:, 2] = key, pos, lcp
        if bucket[0] != bucket[-1] or (bucket != bucket[0]).any():
            order = np.argsort(bucket, kind="stable")
            bucket, rows = bucket[order], rows[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        first = first.tolist()
        for b, x, y in zip(bucket[first].tolist(), first, [*first[1:], len(rows)], strict=True):
            self.held.setdefault(b, []).append(rows[x:y])
        self.bytes += rows.nbytes
        if self.bytes > self.budget:
            for b, parts in self.held.items():
                f = self.files.setdefault(b, None) or tempfile.TemporaryFile()
                self.files[b] = f
                f.seek(0, 2)
                for part in parts:
                    f.write(part.tobytes())
            self.held, self.bytes = {}, 0

    def take(self, bucket: int) -> np.ndarray:
        """What the bucket holds, or its first part; nothing once it is empty."""
        if self.width == 1 and bucket in self.files:
            f, size = self.files[bucket], max(1, self.budget // (4 * 3 * self.dtype.itemsize)) * 3 * self.dtype.itemsize
            at = self.read.get(bucket, 0)
            f.seek(at)
            rows = np.frombuffer(f.read(size), dtype=self.dtype).reshape(-1, 3)
            if len(rows):
                self.read[bucket] = at + rows.nbytes
                return rows
            self.files.pop(bucket).close()
            self.read.pop(bucket, None)
        parts = self.held.pop(bucket, [])
        self.bytes -= sum(p.nbytes for p in parts)
        if f := self.files.pop(bucket, None):
            f.seek(0)
            parts.insert(0, np.frombuffer(f.read(), dtype=self.dtype).reshape(-1, 3))
            f.close()
        rows = np.concatenate(parts) if parts else np.zeros((0, 3), self.dtype)
        return rows if self.width == 1 else rows[np.argsort(rows[:, 0], kind="stable")]


def _types(t: np.ndarray, budget: int) -> np.ndarray:
    """True for S-type positions; the last symbol must be the smallest and the only one of its kind."""
    n = len(t)
    s = mapped(n, bool, budget)
    s[n - 1] = True
    for hi in range(n - 1, 0, -_BLOCK):  # types of lo .. hi - 1, from those of hi
        lo = max(0, hi - _BLOCK)
        a, b = t[lo:hi], t[lo + 1 : hi + 1]
        differ = np.flatnonzero(a != b)
        tail = differ[-1] + 1 if len(differ) else 0
        s[lo + tail : hi] = s[hi]
        s[lo : lo + tail] = np.repeat((a < b)[differ], np.diff(differ, prepend=-1))
    return s


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo .. hi] (ends included) for each pair, by a sparse table."""
    out = np.empty(len(lo), dtype=values.dtype)
    span = hi - lo + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            table = np.minimum(table[: -(1 << k - 1)], table[1 << k - 1 :])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
    return out


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a string of names by their first ``depth`` names, in memory: the
    ranks of prefixes are doubled in length, for suffixes still equal alone."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    new = np.concatenate([[True], names[order][1:] != names[order][:-1]])
    rank = np.empty(n, dtype=np.int64)  # place of the first equal one
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    length, open_ = 1, order[~(new & np.append(new[1:], True))]
    while length < depth and len(open_):
        after = open_ + length
        key = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        sub = np.argsort(rank[open_] * (n + 1) + key + 1, kind="stable")
        open_, key = open_[sub], key[sub]
        r = rank[open_]
        group = np.concatenate([[True], r[1:] != r[:-1]])
        part = group | np.concatenate([[True], key[1:] != key[:-1]])
        start = np.flatnonzero(group)[np.cumsum(group) - 1]
        rank[open_] = r + np.flatnonzero(part)[np.cumsum(part) - 1] - start
        open_ = open_[~(part & np.append(part[1:], True))]
        length *= 2
    return np.argsort(rank, kind="stable")


class _Level:
    def __init__(self, t: np.ndarray, sigma: int, depth: int, budget: int):
        self.t, self.sigma, self.depth, self.budget = t, sigma, depth, budget
        self.n = len(t)
        self.s = _types(t, budget)

    def prefix(self, p: int, q: int) -> int:
        """Common prefix of two suffixes, up to ``depth``."""
        m = min(self.depth, self.n - max(p, q))
        differ = np.flatnonzero(self.t[p : p + m] != self.t[q : q + m])
        return int(differ[0]) if len(differ) else m

    def prefixes(self, pos: np.ndarray) -> np.ndarray:
        """Common prefix of each suffix with the one before it, up to ``depth``; 0 for the first."""
        out = np.zeros(len(pos), dtype=np.int64)
        open_ = np.arange(1, len(pos))
        for d in range(self.depth):
            a, b = pos[open_] + d, pos[open_ - 1] + d
            inside = np.maximum(a, b) < self.n
            open_ = open_[inside]
            open_ = open_[self.t[a[inside]] == self.t[b[inside]]]
            if not len(open_):
                break
            out[open_] = d + 1
        return out

    def _piece(self, pos: np.ndarray, size: np.ndarray, at: int, m: int, bits: int) -> np.ndarray:
        key = np.zeros(len(pos), dtype=np.uint64)
        for i in range(at, at + m):
            p = np.minimum(pos + i, self.n - 1)
            code = self.t[p].astype(np.int64) * 2 + self.s[p] + 1
            key = key << np.uint64(bits) | np.where(i < size, code, 0).astype(np.uint64)
        return key

    def _stars(self) -> Iterator[np.ndarray]:
        """S* positions in text order, block by block."""
        for lo in range(1, self.n, _BLOCK):
            hi = min(self.n, lo + _BLOCK)
            yield np.flatnonzero(self.s[lo:hi] & ~self.s[lo - 1 : hi - 1]) + lo

    def _named_on_disk(self, pos: np.ndarray, bits: int, m: int) -> tuple[np.ndarray, np.ndarray, int]:
        """S* positions in the order of their substrings, the substrings' names in text order, and how many differ."""
        count = len(pos)
        # S* positions never touch, so half of one tells which it is.
        nth = mapped(self.n // 2 + 1, np.int64, self.budget)
        for lo in range(0, count, _BLOCK):
            p = np.asarray(pos[lo : lo + _BLOCK])
            nth[p >> 1] = np.arange(lo, lo + len(p))
        order, end = mapped(count, np.int64, self.budget), count
        for block, _ in self._sweep(((p, np.zeros(len(p), np.int64)) for p in self._stars()), False):
            star = block[(block > 0) & self.s[block] & ~self.s[np.maximum(block - 1, 0)]]
            order[end - len(star) : end] = star[::-1]
            end -= len(star)
        names, last = mapped(count, np.int64, self.budget), 0
        for lo in range(0, count, _BLOCK):
            p = np.asarray(order[lo : lo + _BLOCK])
            before = np.concatenate([p[:1], p[:-1]]) if lo == 0 else np.asarray(order[lo - 1 : lo - 1 + len(p)])
            at, other = nth[p >> 1], nth[before >> 1]
            size, size_before = (np.where(i + 1 < count, pos[np.minimum(i + 1, count - 1)] - pos[i] + 1, 1) for i in (at, other))
            differ = size != size_before
            open_, done = np.flatnonzero(~differ), 0
            while len(open_):
                a, b = (self._piece(x[open_], size[open_], done, m, bits) for x in (p, before))
                differ[open_[a != b]] = True
                done += m
                open_ = open_[(a == b) & (size[open_] > done)]
            if lo == 0:
                differ[0] = False
            name = last + np.cumsum(differ)
            names[at] = name
            last = int(name[-1])
        return order, names, last + 1

    def seeds(self) -> np.ndarray:
        """S* positions in the order of their suffixes."""
        count = sum(len(p) for p in self._stars())
        pos, end = mapped(count, np.int64, self.budget), 0
        for p in self._stars():
            pos[end : end + len(p)] = p
            end += len(p)
        if count < 2:
            return pos
        bits = int(2 * self.sigma + 1).bit_length()
        m = max(1, 64 // bits)
        depth = -(-self.depth // 2)
        if count * 64 > self.budget:
            order, names, distinct = self._named_on_disk(pos, bits, m)
            if distinct == count or depth <= 1:
                return order
            del order
        else:
            names = self._named(pos, bits, m)
            distinct = int(names.max()) + 1
            if distinct == count or depth <= 1:
                return pos[np.argsort(names, kind="stable")]
            return pos[_doubled(names, depth)]
        level = _Level(names, distinct, depth, self.budget)
        inner, end = mapped(count, np.int64, self.budget), count
        for block, _ in level.descend(False):
            inner[end - len(block) : end] = block[::-1]
            end -= len(block)
        for lo in range(0, count, _BLOCK):
            inner[lo : lo + _BLOCK] = pos[inner[lo : lo + _BLOCK]]
        return inner

    def _named(self, pos: np.ndarray, bits: int, m: int) -> np.ndarray:
        """Names of the S* substrings, equal ones alike, in memory."""
        size = np.append(np.diff(pos) + 1, 1)
        key = self._piece(pos, size, 0, m, bits)
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        rank = np.empty(len(pos), dtype=np.int64)  # place of the first equal one
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        at = m
        while True:
            # Longer substrings that are still equal are compared further.
            members = np.bincount(rank, minlength=len(pos))
            open_ = np.flatnonzero((members[rank] > 1) & (size > at))
            if not len(open_):
                break
            key = self._piece(pos[open_], size[open_], at, m, bits)
            sub = np.lexsort((key, rank[open_]))
            r, k = rank[open_][sub], key[sub]
            group = np.concatenate([[True], r[1:] != r[:-1]])
            part = group | np.concatenate([[True], k[1:] != k[:-1]])
            start = np.flatnonzero(group)[np.cumsum(group) - 1]
            rank[open_[sub]] = r + np.flatnonzero(part)[np.cumsum(part) - 1] - start
            at += m
        used = np.zeros(len(pos) + 1, dtype=np.int64)
        used[rank + 1] = 1
        return np.cumsum(used)[rank]

    def _induce(self, queue: BucketQueue, want: bool, lcps: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pop everything in order as (key, position, common prefix), pushing what each item induces."""
        carry = np.zeros(2 * self.sigma if lcps else 0, dtype=np.int64)
        last_key, last_pos = -1, -1
        for bucket in range(queue.count):
            rows, top = queue.take(bucket), (bucket + 1) * queue.width
            while len(rows) or queue.width == 1 and len(rows := queue.take(bucket)):
                key, pos = rows[:, 0], rows[:, 1]
                before = np.maximum(pos - 1, 0)
                symbol = self.t[before].astype(np.int64)
                target = 2 * symbol if not want else 2 * (self.sigma - 1 - symbol)
                takes = (pos > 0) & (self.s[before] == want)
                inside = takes & (target < top)
                m = len(rows)
                if inside.any():
                    m = int(np.searchsorted(key, target[inside].min(), side="right"))
                key, pos, lcp = key[:m], pos[:m].astype(np.int64), rows[:m, 2].astype(np.int64)
                if lcps:
                    for i in np.flatnonzero(key != np.concatenate([[last_key], key[:-1]])).tolist():
                        q = int(pos[i - 1]) if i else last_pos
                        lcp[i] = self.prefix(int(pos[i]), q) if q >= 0 else 0
                last_key, last_pos = int(key[-1]), int(pos[-1])
                yield key, pos, lcp
                j = np.flatnonzero(takes[:m])
                goes = target[j]
                made = np.zeros(len(j), dtype=np.int64)
                if lcps:
                    made = self._carried(lcp, j, goes, carry)
                # Pushes follow the order of pops; those of this bucket join what is left of it.
                near = goes < top if queue.width > 1 else np.zeros(len(j), dtype=bool)
                queue.push(goes[~near], pos[j[~near]] - 1, made[~near])
                rows = rows[m:]
                if near.any():
                    rows = np.concatenate([rows, np.stack([goes[near], pos[j[near]] - 1, made[near]], axis=1).astype(rows.dtype)])
                    rows = rows[np.argsort(rows[:, 0], kind="stable")]

    def _carried(self, lcp: np.ndarray, j: np.ndarray, goes: np.ndarray, carry: np.ndarray) -> np.ndarray:
        """Common prefixes of what the items at ``j`` induce with the one last pushed to the same key."""
        made = np.zeros(len(j), dtype=np.int64)
        everything = int(lcp.min())
        if len(j):
            order = np.argsort(goes, kind="stable")
            g, at = goes[order], j[order]
            first = np.concatenate([[True], g[1:] != g[:-1]])
            since = np.where(first, -1, np.concatenate([[-1], at[:-1]]))
            least = _least(lcp, since + 1, at)
            least[first] = np.minimum(least[first], carry[g[first]])
            made[order] = np.minimum(least + 1, self.depth)
            last = np.flatnonzero(np.concatenate([first[1:], [True]]))
            rest = np.minimum.accumulate(lcp[::-1])[::-1]
            tail = np.where(at[last] + 1 < len(lcp), rest[np.minimum(at[last] + 1, len(lcp) - 1)], self.depth)
        np.minimum(carry, everything, out=carry)
        if len(j):
            carry[g[last]] = tail
        return made

    def descend(self, lcps: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (positions, common prefix of each with the one before), largest suffix first."""
        seeds = self.seeds()

        def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for lo in range(0, len(seeds), _BLOCK):
                p = np.asarray(seeds[max(lo - 1, 0) : lo + _BLOCK])
                yield p[min(lo, 1) :], self.prefixes(p)[min(lo, 1) :] if lcps else np.zeros(len(p) - min(lo, 1), np.int64)

        yield from self._sweep(blocks(), lcps)

    def _sweep(self, seeds: Iterator[tuple[np.ndarray, np.ndarray]], lcps: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The two passes over blocks of (S* position, common prefix with the one before)."""
        keys = 2 * self.sigma
        buckets = min(keys, max(1024, int(self.n**0.5)))
        dtype = np.int32 if max(keys, self.n) < 1 << 31 else np.int64
        queue = BucketQueue(keys, buckets, self.budget, dtype)
        for p, c in seeds:
            queue.push(2 * self.t[p].astype(np.int64) + 1, p, c)
        # The first pass leaves L suffixes in ascending order; the second wants them descending.
        total = int(self.n - np.count_nonzero(self.s))
        l_pos, l_lcp = mapped(total, np.int64, self.budget), mapped(total, np.int16, self.budget)
        end = total
        for key, pos, lcp in self._induce(queue, False, lcps):
            kind = key & 1 == 0
            k, p, c = key[kind], pos[kind], lcp[kind]
            if not len(p):
                continue
            l_pos[end - len(p) : end] = p[::-1]
            # Seen from above, an item's neighbour of the same key is the one after it.
            l_lcp[end - len(p) : end] = c[::-1]
            end -= len(p)
        queue = BucketQueue(keys, buckets, self.budget, dtype)
        for lo in range(0, total, _BLOCK):
            hi = min(total, lo + _BLOCK)
            p = np.asarray(l_pos[lo:hi])
            c = np.concatenate([[0 if lo == 0 else l_lcp[lo - 1]], l_lcp[lo : hi - 1]]).astype(np.int64)
            queue.push(2 * (self.sigma - 1 - self.t[p].astype(np.int64)) + 1, p, c)
        queue.push(np.array([2 * (self.sigma - 1 - int(self.t[self.n - 1]))]), np.array([self.n - 1]), np.zeros(1, np.int64))
        for _, pos, lcp in self._induce(queue, True, lcps):
            yield pos, lcp


def suffixes(t: np.ndarray, sigma: int, depth: int, budget: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of ``t`` by their first ``depth`` symbols, largest first.

    Yields blocks of positions with each one's common prefix, up to ``depth``,
    with the one before it. ``t`` (an array or a mapped file of values below
    ``sigma``) must end in its only smallest symbol.
    """
    return _Level(t, sigma, depth, budget).descend()
