"""Suffix-array dedup: repeated byte strings found by external induced sorting.

Each shard of candidate contexts becomes one text, whose suffixes are sorted by
``refrain.llm.induced``. Neighbours that share ``window`` bytes or more make a
class of equal strings; all but the earliest are covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from refrain.llm.base import batch, fresh
from refrain.llm.induced import mapped, suffixes
from refrain.llm.repeats import Units, covered, intervals, keyed

#: Bytes that a shard's queue may hold before it goes on on disk.
BUDGET = 48 << 20


def later_windows(contexts: list[bytes], counts: list[int], window: int, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(context, first window, windows) of windows whose string starts in an earlier place too.

    ``contexts`` stand in the order of their places; the first ``counts`` bytes
    of each start a window. Symbols: 0 ends the text, 1 a context, bytes follow.
    """
    size = np.fromiter(map(len, contexts), dtype=np.int64, count=len(contexts)) + 1
    begin = np.cumsum(size) - size
    text = mapped(int(size.sum()) + 1, np.uint16, budget)
    for i in range(0, len(contexts), 1 << 16):
        a, part = int(begin[i]), np.frombuffer(b"\x00".join([*contexts[i : i + (1 << 16)], b""]), dtype=np.uint8)
        text[a : a + len(part)] = part.astype(np.uint16) + 2
    text[begin + size - 1] = 1
    text[-1] = 0
    later = mapped(len(text), bool, budget)
    later[:] = False
    least = -1  # earliest place of the class under way
    for pos, lcp in suffixes(text, 258, window, budget):
        if not len(pos):
            continue
        new = lcp < window
        at = np.flatnonzero(np.concatenate([[True], new[1:]]))
        low = np.minimum.reduceat(pos, at)
        later[pos] = True
        if not new[0] and least >= 0:
            later[max(least, low[0])] = True
            low[0] = min(least, low[0])
        later[low] = False
        least = int(low[-1])
    del text
    stop = begin + np.asarray(counts, dtype=np.int64)
    for i in range(0, len(begin), 1 << 16):
        a, z = int(begin[i]), int(begin[min(i + (1 << 16), len(begin)) - 1] + size[min(i + (1 << 16), len(begin)) - 1])
        starts = np.zeros(z - a + 1, dtype=np.int8)
        starts[begin[i : i + (1 << 16)] - a] += 1
        np.subtract.at(starts, stop[i : i + (1 << 16)] - a, 1)
        hit = later[a:z] & np.cumsum(starts[:-1], dtype=np.int8).astype(bool)
        edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
        first, end = np.flatnonzero(edge == 1) + a, np.flatnonzero(edge == -1) + a
        which = np.searchsorted(begin, first, side="right") - 1
        # Windows of one context never reach the next, as a context ends in bytes that start none.
        yield which, first - begin[which], end - first


_TEXTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept binary"


def suffix_dedup(docs: DataFrame, *, window: int = 100, digests: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte covered by a ``window``-byte string that also starts earlier.

    Earlier is in a document with a smaller id or, overlaps included, before in
    the same one. Strings are judged on the input. Returns doc_id, n_bytes,
    n_removed, n_spans, kept_sha256, spans (byte offsets of what is removed) and
    kept (the bytes left, binary, since a cut may split a character); with
    ``digests`` the last two are null. Null and empty texts give zeros; a text
    shorter than the window loses nothing. Rows equal in id and text are one
    document and all return its result; different texts under one id are
    documents ordered by a hash of the text. Extra columns are ignored.
    """
    units = Units("bytes", window, min(32, window // 16 * 8), True)
    if units.gram < 8:
        raise ValueError("a window takes 16 bytes at least")

    def judge(contexts: list[bytes], counts: list[int], _: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return later_windows(contexts, counts, window)

    @fresh
    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for text, start, end in intervals(b, units):
                kept = b"".join(text[x:y] for x, y in zip([0, *end.tolist()], [*start.tolist(), len(text)], strict=True)) if len(start) else text
                spans = None if digests else [{"start": x, "end": y} for x, y in zip(start.tolist(), end.tolist(), strict=True)]
                rows.append((len(text), len(text) - len(kept), len(start), hashlib.sha256(kept).hexdigest(), spans, None if digests else kept))
            yield batch(_TEXTS, b.column("doc_id"), *([r[i] for r in rows] for i in range(6)))

    return covered(keyed(docs, id_col, text_col), units, judge).mapInArrow(finish, _DDL)
