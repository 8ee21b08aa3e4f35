"""Exact deduplication through a minimal perfect hash of historical digests.

A history table is folded into one compact index row per digest bucket: a
minimal perfect hash over the bucket's distinct digests, whose slots hold the
full digest, the locator (id) of the row that wins and the number of rows. New
digests are looked up in their bucket's index and compared byte for byte, since
a perfect hash also maps strangers to a slot. Members extend the historical
group; nonmembers are grouped among themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.llm.base import batch, id_text

#: Stands for a null id among the winners.
_NO_ID = -(1 << 63)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0xA5A5) & 0xFFFFFFFFFFFFFFFF)) * _GOLD
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
    return x


class PerfectHash:
    """Minimal perfect hash by levels of collision-free bit arrays.

    At each level every remaining key claims a bit; keys alone on theirs stay,
    the others move on. A key's slot is the rank of its bit over all levels.
    """

    def __init__(self, keys: np.ndarray, gamma: float = 1.5):
        self.levels: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        self.tail: dict[bytes, int] = {}
        self.size, placed, left = len(keys), 0, keys
        while len(left) and len(self.levels) < 40:
            m = max(64, int(gamma * len(left)) + 63 >> 6 << 6)
            at = self._at(left, len(self.levels), m)
            alone = np.bincount(at, minlength=m) == 1
            self.levels.append(alone)
            self.ranks.append(placed + np.cumsum(alone) - 1)
            placed += int(alone.sum())
            left = left[~alone[at]]
        for key in left:  # keys whose leading 128 bits agree, next to impossible
            self.tail[key.tobytes()] = placed
            placed += 1

    @staticmethod
    def _at(keys: np.ndarray, level: int, m: int) -> np.ndarray:
        head = np.ascontiguousarray(keys).view("<u8").reshape(len(keys), -1)
        return (_mix(head[:, 0] ^ (head[:, 1] << np.uint64(1)), level) % np.uint64(m)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; for a key outside the set any slot, or -1."""
        slot = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._at(keys[open_], level, len(alone))
            hit = alone[at]
            slot[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        if self.tail:
            for i in open_:
                slot[i] = self.tail.get(keys[i].tobytes(), -1)
        return slot


def _digests(column: pa.Array) -> np.ndarray:
    data = b"".join(column.cast(pa.large_binary()).to_pylist())
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, 32)


_GROUPS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _lookup(key: tuple, history: pa.Table, fresh: pa.Table) -> pa.Table:
    """Merge one bucket's fresh groups into its historical index."""
    if not history.num_rows or not fresh.num_rows:
        both = history if history.num_rows else fresh
        return both.select(_GROUPS.names).cast(_GROUPS)
    h, f = (_digests(t["digest"].combine_chunks()) for t in (history, fresh))
    mph = PerfectHash(h)
    at = mph.slots(h)
    slot_digest = np.empty_like(h)
    winner, count = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
    slot_digest[at], winner[at], count[at] = h, history["keep_id"].to_numpy(), history["group_size"].to_numpy()

    slot = mph.slots(f)
    member = slot >= 0
    member[member] = (slot_digest[slot[member]] == f[member]).all(axis=1)
    new_winner, new_count = fresh["keep_id"].to_numpy(), fresh["group_size"].to_numpy()
    s = slot[member]  # distinct, as fresh digests are
    winner[s] = np.maximum(winner[s], new_winner[member])
    count[s] += new_count[member]
    digest = np.concatenate([slot_digest, f[~member]])
    return pa.Table.from_batches([batch(_GROUPS, [d.tobytes() for d in digest], np.concatenate([winner, new_winner[~member]]), np.concatenate([count, new_count[~member]]))])


def exact_dedup(docs: DataFrame, historical: Column, *, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Group equal texts; the row with the largest id of each group stays.

    ``historical`` is a predicate over ``doc_id``: its rows make the index, the
    others are looked up in it. Every row is returned: doc_id, keep_id,
    group_size, kept, text_sha256. A null text counts as empty, texts are equal
    if their UTF-8 bytes are; of equal ids with equal texts each row returns,
    all of them marked kept if the id is the winner's. A null id loses against any
    other; a group of null ids alone has a null keep_id, and all its rows are
    kept. An empty table gives an empty result. Extra columns are ignored.

    Digest groups are counted before the shuffle, so a text that a third of all
    rows share reaches a bucket as one row for each map task; the final join is
    an equi-join of rows to one row a digest, which AQE splits where it is
    skewed. Texts themselves never move.
    """

    def digests() -> DataFrame:  # anew each time: a cogroup confuses columns that both sides inherit
        return id_text(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))

    rows = digests()
    n = buckets or max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def groups(part: DataFrame) -> DataFrame:
        return part.groupBy("digest").agg(F.coalesce(F.max("doc_id"), F.lit(_NO_ID)).alias("keep_id"), F.count(F.lit(1)).alias("group_size")).withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int"))

    history, fresh = groups(digests().filter(historical)), groups(digests().filter(~F.coalesce(historical, F.lit(False))))
    merged = history.groupBy("bucket").cogroup(fresh.groupBy("bucket")).applyInArrow(_lookup, "digest binary, keep_id long, group_size long")
    merged = merged.withColumn("keep_id", F.when(F.col("keep_id") != _NO_ID, F.col("keep_id")))
    return rows.join(merged, "digest").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def halves(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """The default history: the rows with ids up to the middle of the id range."""
    lo, hi = docs.agg(F.min(id_col), F.max(id_col)).first()
    return F.col("doc_id") <= F.lit(((lo or 0) + (hi or 0)) // 2)
