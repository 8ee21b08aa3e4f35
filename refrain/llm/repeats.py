"""Finding and gathering what may repeat: the distributed part of both substring operators.

A text is a row of units (bytes or words); a window is ``w`` consecutive ones.
Every window has a key: the least hash over its k-unit grams. Equal windows have
equal keys, so a window whose key occurs once in the corpus can't repeat, and
all windows of one key can be judged in one place:

1. consecutive windows of one key make a run; runs are dealt out by key, and
   those whose key comes again are candidates;
2. candidates go back to their texts, which cut out each run's *context*, the
   units of its windows; contexts are dealt out by key to shards;
3. a shard judges its contexts by the operator's own method and returns the
   windows that start earlier elsewhere;
4. these go to their texts, which drop the units covered.

Hashes only choose candidates; what is removed is decided on whole contexts.
A key or context that meets its like within an Arrow batch leaves it once, so the
copies of a popular passage don't fill one shard. A popular gram with other
contexts each time would: the windows of a key with over ``HOT`` runs are dealt
out anew, each by a hash of all its units, so that just equal windows meet.
Tables move as packed arrays, a row for each batch and shard.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.llm.base import BROADCAST_ROWS, batch, cut, fresh, id_text, partitions, text_chunks, utf8

#: Windows of one context at most: a longer run is cut, so that no context is long.
LONGEST = 4096
#: Shards for each shuffle partition; several, so that their hashes spread evenly.
SHARDS = 4
#: Runs of one key that may be judged together.
HOT = 1 << 16

_M = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= _M[0]
    h ^= h >> np.uint64(29)
    h *= _M[1]
    h ^= h >> np.uint64(32)
    return h


@dataclass(frozen=True)
class Units:
    """Bytes or words, the window length and the gram length of keys. ``within``:
    a window is also judged against earlier ones of its own document."""

    kind: str
    window: int
    gram: int
    within: bool

    def grams(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash of the gram at each unit, and the texts' offsets in units."""
        with np.errstate(over="ignore"):
            return self._byte_grams(data, at) if self.kind == "bytes" else self._word_grams(data, at)

    def _byte_grams(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, padded = len(data), np.concatenate([data, np.zeros(self.gram + 8, np.uint8)])
        eight = np.ndarray((n + self.gram,), dtype="<u8", buffer=padded, strides=(1,)).copy()
        h = np.zeros(n, dtype=np.uint64)
        for j, i in enumerate(sorted({*range(0, self.gram - 7, 8), self.gram - 8})):
            h += eight[i : i + n] * _M[1 + j % 4]
            h = h << np.uint64(7) | h >> np.uint64(57)
        return _mix(h), at

    def _word_grams(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gap = (data == 0x20) | ((data >= 9) & (data <= 13))
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[at] = True
        begin = np.flatnonzero(~gap & (np.concatenate([[True], gap[:-1]]) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
        end = np.flatnonzero(~gap & (np.concatenate([gap[1:], [True]]) | edge[1:])) + 1 if len(data) else begin
        # A word's hash by prefix sums of a polynomial modulo 2**64, whose odd base can be divided out.
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(data), _M[2])]))
        back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(data), np.uint64(pow(int(_M[2]), -1, 1 << 64)))]))
        total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        word = _mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))
        h = np.zeros(len(word), dtype=np.uint64)
        padded = np.concatenate([word, np.zeros(self.gram, np.uint64)])
        for i in range(self.gram):
            h = (h + padded[i : i + len(word)]) * _M[1 + i % 4]
            h ^= h >> np.uint64(33)
        return _mix(h), np.searchsorted(begin, at)

    def _anchors(self, gram: np.ndarray) -> np.ndarray:
        """The place of the least gram (by 40 bits, then the leftmost) of the window at each unit."""
        span, block = self.window - self.gram + 1, 1 << 18
        parts = []
        for a in range(0, len(gram) - span + 1, block):
            g = gram[a : a + block + span - 1]
            low, width = (g & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(g), dtype=np.uint64), 1
            while width * 2 <= span:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            if span > width:
                low = np.minimum(low[: width - span], low[span - width :])
            parts.append((low & np.uint64(0xFFFFFF)).astype(np.int64) + a)
        return np.concatenate(parts)

    def runs(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, first window, windows, key, repeats) of every run in a chunk of
        texts; ``repeats`` tells that the key's gram comes more than once in the run."""
        gram, first = self.grams(data, at)
        begin, stop = first[:-1], first[1:] - self.window + 1
        full = stop > begin
        none = np.zeros(0, np.int64)
        if not full.any():
            return none, none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
        anchor = self._anchors(gram)
        lowest = gram[anchor]
        step = np.zeros(len(gram) + 1, dtype=np.int8)
        step[begin[full]] += 1
        np.subtract.at(step, stop[full], 1)
        inside = np.cumsum(step, dtype=np.int8)[: len(lowest)].astype(bool)
        new = np.concatenate([[True], lowest[1:] != lowest[:-1]])
        new[begin[full]] = True
        start = np.flatnonzero(new & inside)
        text = np.searchsorted(first, start, side="right") - 1
        count = np.minimum(np.append(start[1:], len(gram)), stop[text]) - start
        moved = np.concatenate([[False], anchor[1:] != anchor[:-1]])
        moved[start] = False
        total = np.concatenate([[0], np.cumsum(moved)])
        repeats = total[start + count] > total[start]
        if count.max() > LONGEST:
            pieces = -(-count // LONGEST)
            which = np.repeat(np.arange(len(start)), pieces)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            key, repeats = lowest[start][which], repeats[which]
            start, text, count = start[which] + nth * LONGEST, text[which], np.minimum(count[which] - nth * LONGEST, LONGEST)
        else:
            key = lowest[start]
        return text, start - first[text], count, key, repeats


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as one value; bytes of like weight stand together, which compresses well."""
    out = [len(arrays[0]).to_bytes(8, "little")]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(a.view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"")
    return b"".join(out)


def unpack(blob: bytes, *dtypes) -> tuple[list[np.ndarray], int]:
    """The arrays of ``pack`` and where they end."""
    n, at, out = int.from_bytes(blob[:8], "little"), 8, []
    for dtype in map(np.dtype, dtypes):
        size = n * dtype.itemsize
        planes = np.frombuffer(blob, dtype=np.uint8, count=size, offset=at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype) if n else np.zeros(0, dtype))
        at += size
    return out, at


_RUN = (np.int64, np.int64, np.uint32, np.uint32, np.uint64, np.uint8)  # doc, twin, start, count, key, whether the key's gram repeats
_SPAN = _RUN[:4]
_SHARD = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_SHARD_DDL = "shard int, kind int, blob binary"
_ROWS_RUN = pa.schema([("doc_id", pa.int64()), ("twin", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("repeats", pa.int64())])
_ROWS_SPAN = pa.schema(list(_ROWS_RUN)[:4])
_JUDGE, _PASS = 0, 1


def _dealt(columns: list[np.ndarray], shard: np.ndarray, kind: int) -> Iterator[tuple[int, int, bytes]]:
    order = np.argsort(shard, kind="stable")
    columns, shard = [c[order] for c in columns], shard[order]
    for a, b in _stretches(shard):
        yield int(shard[a]), kind, pack(*(c[a:b] for c in columns))


def _stretches(shard: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each shard's stretch of sorted numbers begins and ends; none if there are none, as where no key of a batch comes again."""
    edges = np.flatnonzero(shard[1:] != shard[:-1]) + 1
    return itertools.pairwise([0, *edges.tolist(), len(shard)] if len(shard) else [])


def _rows(schema: pa.Schema, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), 1 << 17):
        yield batch(schema, *(c[i : i + (1 << 17)].astype(np.int64, copy=False) if c.dtype != np.uint64 else c[i : i + (1 << 17)].view(np.int64) for c in columns))


def _blobs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for b in batches:
        yield from zip(b.column("kind").to_pylist(), b.column("blob").to_pylist(), strict=True)


def _inside(b: pa.RecordBatch, row: int, end: int, text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows lie in the stretches (columns start, n) of their texts."""
    starts, counts = (b.column(c).slice(row, end - row) for c in ("start", "n"))
    owner = np.repeat(np.arange(end - row), np.diff(starts.offsets.to_numpy()))
    low = owner << 40 | starts.flatten().to_numpy()
    order = np.argsort(low)
    low, high = low[order], (low + counts.flatten().to_numpy())[order]
    at = text << 40 | start
    i = np.searchsorted(low, at, side="right") - 1
    return (i >= 0) & (at < high[i])


def candidates(texts: DataFrame, units: Units) -> DataFrame:
    """doc_id, twin, start, n, key, repeats of each run whose key occurs in another run, or more than once in this one.

    Texts with columns start and n (arrays) take part with the windows named there alone.
    """
    parts = "start" in texts.columns
    tasks = partitions(texts.sparkSession)
    shards = tasks * SHARDS

    @fresh
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, twins, found = b.column("doc_id").to_numpy(), b.column("twin").to_numpy(), []
            for row, end, data, at in text_chunks(b.column("text")):
                text, start, count, key, repeats = units.runs(data, at)
                if parts and len(text):
                    mine = _inside(b, row, end, text, start)
                    text, start, count, key, repeats = (x[mine] for x in (text, start, count, key, repeats))
                if len(text):
                    found.append((ids[row + text], twins[row + text], start.astype(np.uint32), count.astype(np.uint32), key, (repeats & units.within).view(np.uint8)))
            if not found:
                continue
            columns = [np.concatenate([f[i] for f in found]) for i in range(6)]
            key, repeats = columns[4], columns[5].astype(bool)
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
            size = np.diff(np.append(np.flatnonzero(new), len(key)))
            # A key met once is to be judged. One met again makes all its runs candidates, and tells its shard so.
            again = np.zeros(len(key), dtype=bool)
            again[order] = np.repeat((size > 1) | np.logical_or.reduceat(repeats[order], np.flatnonzero(new)), size)
            sent = np.zeros(len(key), dtype=bool)
            sent[order[new]] = True
            known = [c[again] for c in columns]
            # A count of zero marks a key that is a candidate already.
            told = [c[sent] for c in columns]
            told[3] = np.where(again[sent], 0, told[3]).astype(np.uint32)
            out = [*_dealt(told, (told[4] % np.uint64(shards)).astype(np.int64), _JUDGE), *_dealt(known, (_mix(known[4] ^ known[0].view(np.uint64)) % np.uint64(shards)).astype(np.int64), _PASS)]
            yield batch(_SHARD, *([o[i] for o in out] for i in range(3)))

    @fresh
    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = []
        for kind, blob in _blobs(batches):
            columns, _ = unpack(blob, *_RUN)
            if kind == _PASS:
                yield from _rows(_ROWS_RUN, columns)
            else:
                judged.append(columns)
        if not judged:
            return
        columns = [np.concatenate([c[i] for c in judged]) for i in range(6)]
        judged.clear()
        order = np.argsort(columns[4], kind="stable")
        key = columns[4][order]
        same = np.concatenate([[False], key[1:] == key[:-1], [False]])
        # A key sent once but marked was repeated within its task, where its runs were passed on.
        keep = order[(same[1:] | same[:-1]) & (columns[3][order] > 0)]
        yield from _rows(_ROWS_RUN, [c[keep] for c in columns])

    return texts.mapInArrow(find, _SHARD_DDL).repartition(tasks, "shard").mapInArrow(meet, "doc_id long, twin long, start long, n long, key long, repeats long")


#: A shard's judge: contexts in order of their places, their windows and documents; yields (context, first window, windows) that start earlier elsewhere.
Judge = Callable[[list[bytes], list[int], np.ndarray], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _contexts(text: bytes, units: Units, start: np.ndarray, n: np.ndarray) -> list[bytes]:
    more = units.window - 1
    if units.kind == "bytes":
        return [text[a : a + c + more] for a, c in zip(start.tolist(), n.tolist(), strict=True)]
    words = text.split()
    return [b" ".join(words[a : a + c + more]) for a, c in zip(start.tolist(), n.tolist(), strict=True)]


def earlier(texts: DataFrame, units: Units, judge: Judge) -> DataFrame:
    """doc_id, twin, start, n: runs of windows that also start earlier."""
    runs = cut(candidates(texts, units))
    hot = cut(runs.groupBy("key").count().filter(F.col("count") > HOT).select("key"))
    keys = hot.count()
    if not keys:
        return judged(texts, runs, units, judge)
    hot = F.broadcast(hot) if keys <= BROADCAST_ROWS else hot
    stretches = runs.join(hot, "key", "left_semi").groupBy("doc_id", "twin").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    parts = texts.join(stretches, ["doc_id", "twin"]).select("doc_id", "twin", "text", F.col("runs.start").alias("start"), F.col("runs.n").alias("n"))
    whole = replace(units, gram=units.window)
    return judged(texts, runs.join(hot, "key", "left_anti"), units, judge).unionByName(judged(texts, candidates(parts, whole), whole, judge))


def judged(texts: DataFrame, runs: DataFrame, units: Units, judge: Judge) -> DataFrame:
    """Those of the windows in ``runs`` that start earlier, with all that have one key in one place."""
    tasks = partitions(texts.sparkSession)
    shards = tasks * SHARDS
    found = runs.groupBy("doc_id", "twin").agg(F.collect_list(F.struct("start", "n", "key", "repeats")).alias("runs"))
    joined = texts.join(found, ["doc_id", "twin"]).select("doc_id", "twin", "text", *(F.col(f"runs.{c}").alias(c) for c in ("start", "n", "key", "repeats")))

    @fresh
    def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column("text"))
            held: dict[bytes, tuple[int, int, int]] = {}
            told: list[list[np.ndarray]] = []
            bodies: list[bytes] = []
            covered: list[tuple[int, int, int, int]] = []
            ids, twins = b.column("doc_id").to_pylist(), b.column("twin").to_pylist()
            places = [b.column(c) for c in ("start", "n", "key", "repeats")]
            for row in np.lexsort((twins, ids)).tolist():
                start, n, key, repeats = (p[row].values.to_numpy() for p in places)
                _, one = np.unique(start, return_index=True)
                start, n, key, repeats = start[one], n[one], key[one], repeats[one]
                keep = np.zeros(len(start), dtype=bool)
                for i, context in enumerate(_contexts(data[at[row] : at[row + 1]].tobytes(), units, start, n)):
                    place = (ids[row], twins[row], int(start[i]))
                    before = held.setdefault(context, place)
                    if before is place or not units.within and before[0] == place[0] and before != place:
                        keep[i] = True
                        bodies.append(context)
                    elif before != place:
                        covered.append((*place, int(n[i])))
                told.append([np.full(keep.sum(), ids[row]), np.full(keep.sum(), twins[row]), start[keep].astype(np.uint32), n[keep].astype(np.uint32), key[keep].view(np.uint64), repeats[keep].astype(np.uint8)])
            held.clear()
            out: list[tuple[int, int, bytes]] = []
            if told:
                columns = [np.concatenate([t[i] for t in told]) for i in range(6)]
                mark = (columns[4] >> np.uint64(32)).astype(np.uint32)  # enough to tell keys apart within a shard
                size = np.fromiter(map(len, bodies), dtype=np.uint32, count=len(bodies))
                shard = (columns[4] % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                for x, y in _stretches(shard[order]):
                    mine = order[x:y]
                    out.append((int(shard[mine[0]]), _JUDGE, pack(*(c[mine] for c in (*columns[:4], mark, columns[5], size))) + b"".join([bodies[i] for i in mine])))
            if covered:
                columns = [np.array(c, dtype=d) for c, d in zip(zip(*covered, strict=True), _SPAN, strict=True)]
                out += _dealt(columns, columns[0] % shards, _PASS)
            if out:
                yield batch(_SHARD, *([o[i] for o in out] for i in range(3)))

    @fresh
    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for shard, kind, blob in zip(*(b.column(c).to_pylist() for c in ("shard", "kind", "blob")), strict=True):
                if kind == _PASS:
                    yield from _rows(_ROWS_SPAN, unpack(blob, *_SPAN)[0])
                else:
                    held.setdefault(shard, []).append(blob)
        while held:
            yield from settle_shard(held.popitem()[1])

    def settle_shard(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        places, bodies = [], []
        while blobs:
            blob = blobs.pop()
            columns, at = unpack(blob, *_SPAN, np.uint32, np.uint8, np.uint32)
            ends = at + np.cumsum(columns[6], dtype=np.int64)
            bodies += [blob[e - s : e] for s, e in zip(columns[6].tolist(), ends.tolist(), strict=True)]
            places.append(columns[:6])
        doc, twin, start, n, mark, repeats = (np.concatenate([p[i] for p in places]) for i in range(6))
        order = np.lexsort((start, twin, doc))
        # Of equal contexts the first is judged, or all of the first document; others start earlier there.
        held: dict[bytes, int] = {}
        first = np.zeros(len(order), dtype=bool)
        last = None
        again = np.zeros(len(order), dtype=bool)
        for i in order.tolist():
            place = (doc[i], twin[i], start[i])
            if place == last:  # a repeated row
                continue
            last = place
            if held.setdefault(bodies[i], i) == i or not units.within and doc[held[bodies[i]]] == doc[i]:
                first[i] = True
            else:
                again[i] = True
        held.clear()
        yield from _rows(_ROWS_SPAN, [c[again] for c in (doc, twin, start, n)])
        order = order[first[order]]
        # A key with one context left has nothing to be judged against but itself.
        _, group, size = np.unique(mark[order], return_inverse=True, return_counts=True)
        order = order[(size[group] > 1) | (repeats[order] > 0)]
        if not len(order):
            return
        for context, offset, count in judge([bodies[i] for i in order.tolist()], n[order].tolist(), doc[order]):
            at = order[context]
            yield from _rows(_ROWS_SPAN, [doc[at], twin[at], start[at].astype(np.int64) + offset, count])

    return joined.mapInArrow(cut_out, _SHARD_DDL).repartition(tasks, "shard").mapInArrow(settle, "doc_id long, twin long, start long, n long")


_NO_ID = -(1 << 63)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, twin, text. A null id is the least long here, so that joins needn't
    filter it and the shuffled texts serve them all. ``twin`` is 0 unless ids repeat; then it is a hash of the
    text, so that rows of one id and text are one document and other texts under
    the same id are documents that follow each other by it."""
    texts = id_text(docs, id_col, text_col)
    repeats = texts.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    twin: Column = F.xxhash64("text") if repeats else F.lit(0).cast("long")
    return texts.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), twin.alias("twin"), "text")


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals, as sorted disjoint ones that don't touch."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]]) if len(start) else np.zeros(0, bool)
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)] if len(start) else reach


def covered(texts: DataFrame, units: Units, judge: Judge) -> DataFrame:
    """doc_id, text, starts, ends (arrays): every row with the units covered by windows that start earlier elsewhere."""
    spans = earlier(texts, units, judge).groupBy("doc_id", "twin").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return texts.join(spans, ["doc_id", "twin"], "left").select(F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), "text", F.col("spans.start").alias("starts"), F.col("spans.n").alias("counts"))


def intervals(b: pa.RecordBatch, units: Units) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """(text, starts, ends) for each row of ``covered``, in units, merged."""
    data, at = utf8(b.column("text"))
    starts, counts = b.column("starts"), b.column("counts")
    none = np.zeros(0, np.int64)
    for row in range(b.num_rows):
        text = data[at[row] : at[row + 1]].tobytes()
        if starts[row].is_valid:
            start, n = starts[row].values.to_numpy(), counts[row].values.to_numpy()
            yield (text, *merge(start, start + n + units.window - 1))
        else:
            yield text, none, none
