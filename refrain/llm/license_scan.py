"""License scan: short notices found despite small edits.

A notice of ``m`` letters may differ by ``k = m // 10`` edits. Cut into ``k + 1``
pieces it must, by the pigeonhole principle, keep one of them whole, so an
Aho-Corasick automaton over all pieces finds every place where a notice can be.
Around each such seed the ``regex`` library matches the notice with at most
``k`` errors and gives its span, unless the notice's three-letter grams rule that
out: an edit breaks three of them at most. Well-known phrases are matched exactly
beside it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from refrain.llm.base import batch, fresh, id_text, text_chunks

# Phrases matched exactly, by word.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Short notices in normal form (lower case, words joined by a space).
NOTICES = (
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under a creative commons attribution license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "released under the mit license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("public-domain", "released into the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
)

_OTHER, _END = 0x20, 0x0A
#: Lower case; every byte outside words becomes a space.
_FOLD = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else _OTHER for c in range(256))


class Scanner:
    def __init__(self, notices: tuple[tuple[str, str], ...] = NOTICES, phrases: tuple[tuple[str, str], ...] = PHRASES):
        self.notices, self.phrases = notices, phrases
        self.edits = [len(text.encode()) // 10 for _, text in notices]
        self.patterns = [regex.compile(rb"(?b)(?:%s){e<=%d}" % (regex.escape(text).encode(), k), regex.V1) for (_, text), k in zip(notices, self.edits, strict=True)]
        self.texts = [text.encode() for _, text in notices]
        self.grams = [[text[i : i + 3] for i in range(len(text) - 2)] for text in self.texts]
        self.seeds = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, ((_, text), k) in enumerate(zip(notices, self.edits, strict=True)):
            cuts = [len(text) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(text[a:b], []).append((i, a))
        for i, (phrase, _) in enumerate(phrases):
            seeds.setdefault(phrase, []).append((~i, 0))
        for seed, uses in seeds.items():
            self.seeds.add_word(seed, (len(seed), uses))
        self.seeds.make_automaton()

    def _verify(self, i: int, window: bytes) -> tuple[int, int, int] | None:
        whole = window.find(self.texts[i])
        if whole >= 0:
            return whole, whole + len(self.texts[i]), 0
        if sum(map(window.__contains__, self.grams[i])) < len(self.grams[i]) - 3 * self.edits[i]:
            return None
        found = self.patterns[i].search(window)
        return found and (found.start(), found.end(), sum(found.fuzzy_counts))

    def scan(self, data: np.ndarray, at: np.ndarray) -> list[dict]:
        """One result for each of the texts ``data[at[i]:at[i + 1]]``."""
        folded = data.tobytes().translate(_FOLD)
        text = np.frombuffer(b"\n".join([*(folded[a:b] for a, b in zip(at, at[1:], strict=False)), b""]), dtype=np.uint8)
        gap = (text == _OTHER) | (text == _END)
        after = np.concatenate([[True], gap[:-1]])
        text = text[~(after & (text == _OTHER))]  # runs of spaces become one; none after a start
        gap = (text == _OTHER) | (text == _END)
        ends = np.flatnonzero(text == _END)
        begins = np.concatenate([[0], ends[:-1] + 1])
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        first = np.searchsorted(starts, begins)
        rows = [{"n_words": int(n), "places": [], "spans": []} for n in np.searchsorted(starts, ends) - first]
        flat = text.tobytes()
        tried: set[tuple[int, int, int]] = set()
        for end, (size, uses) in self.seeds.iter(flat.decode("latin-1")):
            seed_at = end + 1 - size
            row = int(np.searchsorted(ends, seed_at))
            lo, hi = int(begins[row]), int(ends[row])
            for i, offset in uses:
                if i < 0:
                    if (seed_at == lo or flat[seed_at - 1] == _OTHER) and (end + 1 == hi or flat[end + 1] == _OTHER):
                        rows[row]["places"].append((int(np.searchsorted(starts, seed_at) - first[row]), self.phrases[~i][1]))
                    continue
                k, length = self.edits[i], len(self.notices[i][1])
                a, b = max(lo, seed_at - offset - k), min(hi, seed_at - offset + length + 2 * k)
                if (i, a, b) in tried:
                    continue
                tried.add((i, a, b))
                if found := self._verify(i, flat[a:b]):
                    w = np.searchsorted(starts, [a + found[0], a + found[1]], side="right") - 1 - first[row]
                    rows[row]["spans"].append((self.notices[i][0], int(w[0]), int(w[1]), found[2], 1 - found[2] / length))
        for r in rows:
            if r["spans"]:
                r["spans"] = _best(r["spans"])
        return rows


def _best(spans: list[tuple]) -> list[tuple]:
    """Of overlapping spans the one with fewest edits, then the longest, stays."""
    taken: set[int] = set()
    kept: list[tuple] = []
    for s in sorted(set(spans), key=lambda s: (s[3], s[1] - s[2], s)):
        words = range(s[1], s[2] + 1)
        if taken.isdisjoint(words):
            taken.update(words)
            kept.append(s)
    return sorted(kept, key=lambda s: s[1:3])


_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())])
_SCAN = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))), ("spans", pa.list_(_SPAN))])


def license_scan(docs: DataFrame, *, notices: tuple[tuple[str, str], ...] = NOTICES, phrases: tuple[tuple[str, str], ...] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scan every whole text for license phrases and edited notices.

    Returns doc_id, n_words, places array<struct<word, label>> (exact phrases,
    by the place of their first word) and spans array<struct<label, first_word,
    last_word, edits, similarity>> (notices with at most a tenth of their
    letters edited; of overlapping spans the one with fewest edits). Words are runs of
    letters a-z, digits and non-ASCII characters, A-Z lower-cased. A null or
    empty text gives no words and empty arrays; each repeated row gives its own
    result; extra columns are ignored. No shuffle: texts are read once.
    """
    scanner: list[Scanner] = []

    @fresh
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not scanner:
            scanner.append(Scanner(notices, phrases))
        for b in batches:
            for row, end, data, at in text_chunks(b.column("text")):
                found = scanner[0].scan(data, at)
                spans = [[dict(zip(("label", "first_word", "last_word", "edits", "similarity"), s, strict=True)) for s in r["spans"]] for r in found]
                places = [[{"word": w, "label": label} for w, label in sorted(r["places"])] for r in found]
                yield batch(_SCAN, b.column("doc_id").slice(row, end - row), [r["n_words"] for r in found], pa.array(places, type=_SCAN.field("places").type), pa.array(spans, type=_SCAN.field("spans").type))

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_words long, places array<struct<word: long, label: string>>, spans array<struct<label: string, first_word: long, last_word: long, edits: int, similarity: double>>")
