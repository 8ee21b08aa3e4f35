"""Language identification by rank-order profiles.

A profile is the ranking of the most frequent letter n-grams, one to three
letters long with a mark at word edges. A document's distance to a language is
the sum over its own ranked n-grams of how far out of place each is in the
language's profile; one that the profile lacks counts as the profile's length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.base import batch, fresh, id_text, join_few, utf8

PROFILE = 400
#: Learning texts of each language, about; chosen by a hash of their ids.
FIT_ROWS = 4_000
_PIECE = 1 << 19
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the n-grams of a text; 21 bits a letter, 0 marks a word's edge."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    text = text.lower()
    for i in range(0, len(text), _PIECE):
        # Two letters of the piece before, so that every n-gram ends in just one piece.
        lead = min(i, 2)
        c = np.frombuffer(text[i - lead : i + _PIECE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        c[~_letters()[c]] = 0
        c = np.concatenate([[0] * (not i), c, [0] * (i + _PIECE >= len(text))]).astype(np.int64)
        lead = lead if i else 0
        one, two = c[lead:], c[:-1] << 21 | c[1:]
        two = two[max(0, lead - 1) :]
        three = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
        middle = (c[1:-1] != 0) if len(c) > 2 else np.zeros(0, bool)
        codes = np.concatenate([one[one != 0], two[two != 0], three[middle]])
        codes.sort()
        edge = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
        parts.append((codes[edge], np.diff(np.append(edge, len(codes)))))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    codes, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent codes, equal counts by code."""
    return codes[np.lexsort((codes, -counts))[:most]]


def _strings(column: pa.Array) -> Iterator[str]:
    data, at = utf8(column)
    for a, b in zip(at, at[1:], strict=False):
        yield data[a:b].tobytes().decode("utf-8", "replace")


_COUNTS = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("distance", pa.float64())])


def learn_profiles(docs: DataFrame, learn: Column, *, size: int = PROFILE, rows: int = FIT_ROWS) -> dict[str, np.ndarray]:
    """A ranking of n-gram codes for each language.

    ``docs`` has doc_id, text and lang, ``learn`` tells the rows to learn from.
    A language with more than ``rows`` texts uses each with the probability that
    makes it about ``rows``, by a hash of its id, so that no language is sorted in
    one place; texts of one id are used or left out together. N-grams are counted
    per task, then summed; the ``size`` best of a language are ranked before they
    move. Null texts, and rows without a language or id, teach nothing; an empty
    text adds no n-gram, and a repeated row counts each time. An empty table
    gives no profile.
    """
    keys = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "lang")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    keys = join_few(keys, keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang").filter(share * F.col("n") < rows).select("doc_id", "lang").distinct()
    texts = join_few(id_text(docs.filter(F.col("text").isNotNull())), keys, "doc_id")

    @fresh
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[str, list] = {}
            for lang, text in zip(b.column("lang").to_pylist(), _strings(b.column("text")), strict=True):
                sums.setdefault(lang, []).append(ngrams(text))
            for lang, found in sums.items():
                codes, inverse = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                n = np.bincount(inverse, weights=np.concatenate([f[1] for f in found]), minlength=len(codes)).astype(np.int64)
                yield batch(_COUNTS, [lang] * len(codes), codes, n)

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    sums = texts.select("doc_id", "text", "lang").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = sums.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= size)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "r", "code").collect():
        profiles.setdefault(row.lang, []).append((row.r, row.code))
    return {lang: np.array([code for _, code in sorted(ranks)], dtype=np.int64) for lang, ranks in sorted(profiles.items())}


def identify_language(docs: DataFrame, profiles: dict[str, np.ndarray], *, size: int = PROFILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Predict the language of every whole text.

    Returns doc_id, lang_pred, score (the runner-up's share of the best two
    distances: 0.5 for a tie, 1 for a perfect fit) and distance (mean places out
    of place). A text that is null, or has no letter, is ``und`` with score 0,
    as is every text if no profile was learned. Languages at equal distance: the
    first by name. Repeated rows each give a row; extra columns are ignored.
    """
    langs = list(profiles)
    sorted_profiles = [(np.sort(p), np.argsort(p, kind="stable")) for p in profiles.values()]

    def distance(mine: np.ndarray, codes: np.ndarray, places: np.ndarray) -> float:
        at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
        return float(np.where(codes[at] == mine, np.abs(places[at] - np.arange(len(mine))), size).mean())

    @fresh
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in _strings(b.column("text")):
                mine = ranked(*ngrams(text), size)
                if not len(mine) or not langs:
                    rows.append(("und", 0.0, None))
                    continue
                d = [distance(mine, *p) for p in sorted_profiles]
                best = int(np.argmin(d))
                other = min(d[:best] + d[best + 1 :], default=None)
                rows.append((langs[best], 1.0 if other is None else 0.5 if d[best] + other == 0 else other / (d[best] + other), d[best]))
            yield batch(_OUT, b.column("doc_id"), *([r[i] for r in rows] for i in range(3)))

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, distance double")
