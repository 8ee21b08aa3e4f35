"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are dealt out by the bits of chosen blocks (with ``t`` differing
bits and ``t + a`` blocks, ``a`` blocks agree), so each close pair meets in some
bucket. Within a bucket they are sorted by Gray rank, where neighbours differ in
few bits, and runs of them become the nodes of a tree. A node holds the bits
that all below it share; a child repeats only what its parent lacks. A search
adds up differences on the way down and leaves a whole group once they exceed
``t``; a group already known to be linked with the query is left as well.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.base import batch, cut, drop_ids, fresh, id_text, join_few, partitions, utf8
from refrain.llm.decontaminate import seed_hashes, word_hashes

_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)
_STEP = 1 << 16
#: Children of a node; queries searched at once; frontier entries before a search is halved.
FANOUT, QUERIES, FRONTIER = 8, 1024, 1 << 16
#: Distinct fingerprints expected in a bucket before more blocks must agree.
BUCKET = 1 << 12


def fingerprint(text: bytes, k: int = 4) -> int:
    """The 64-bit fingerprint of a text's k-word shingles; with no word 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - k + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n]
    ends = ends[min(k, len(words)) - 1 :]
    set_bits, digest = np.zeros((8, 8), dtype=np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, _STEP):
        h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[i : i + _STEP].tolist(), ends[i : i + _STEP].tolist(), strict=True)), dtype=np.uint64)
        octets = h.view(np.uint8).reshape(-1, 8)
        set_bits += np.stack([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return int.from_bytes(np.packbits(set_bits.ravel() * 2 > n, bitorder="little").tobytes(), "little")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """A forest of one tree a bucket over fingerprints sorted by bucket and Gray rank."""

    def __init__(self, bucket: np.ndarray, fps: np.ndarray):
        order = np.lexsort((gray_rank(fps), bucket))
        self.fps, bucket = fps[order], bucket[order]
        # Level 0 is the leaves: (bits all ones, bits all zeros, first child, bucket).
        self.ones, self.zeros = [self.fps], [~self.fps]
        self.child: list[np.ndarray] = [np.arange(len(fps) + 1)]
        self.leaf: list[np.ndarray] = [np.arange(len(fps) + 1)]
        while len(bucket) and len(bucket) > len(np.unique(bucket)):
            new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            within = np.arange(len(bucket)) - np.repeat(new, np.diff(np.append(new, len(bucket))))
            at = np.flatnonzero(within % FANOUT == 0)
            self.ones.append(np.bitwise_and.reduceat(self.ones[-1], at))
            self.zeros.append(np.bitwise_and.reduceat(self.zeros[-1], at))
            self.child.append(np.append(at, len(bucket)))
            self.leaf.append(np.append(self.leaf[-1][at], len(fps)))
            bucket = bucket[at]
        self.order = order
        self.root = np.searchsorted(self.leaf[-1], np.arange(len(fps)), side="right") - 1 if len(fps) else np.zeros(0, np.int64)

    def _descend(self, t: int, q: np.ndarray, later: bool, linked: list[np.ndarray] | None, own: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, leaf, differing bits) for the queries at places ``q``; ``later``: leaves after the query alone."""
        stack = [(len(self.ones) - 1, q, self.root[q], np.zeros(len(q), dtype=np.int64))]
        while stack:
            level, q, node, acc = stack.pop()
            if not len(q):
                continue
            if level == 0:
                yield q, node, acc
                continue
            if len(q) > FRONTIER and len(q) > 1:
                half = len(q) // 2
                stack += [(level, q[half:], node[half:], acc[half:]), (level, q[:half], node[:half], acc[:half])]
                continue
            n = self.child[level][node + 1] - self.child[level][node]
            parent = np.repeat(np.arange(len(q)), n)
            below = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.child[level][node], n)
            up, q = node[parent], q[parent]
            level -= 1
            ones, zeros = self.ones[level][below], self.zeros[level][below]
            own_bits = (ones | zeros) & ~(self.ones[level + 1][up] | self.zeros[level + 1][up])
            acc = acc[parent] + np.bitwise_count((self.fps[q] ^ ones) & own_bits)
            keep = acc <= t
            keep &= (self.leaf[level][below + 1] - 1 > q) if later else ~((self.leaf[level][below + 1] - 1 == q) & (self.leaf[level][below] == q))
            if linked is not None and own is not None:
                keep &= linked[level][below] != own[q]
            stack.append((level, q[keep], below[keep], acc[keep]))

    def forest(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Links (as places in the input) that join what pairs within ``t`` bits join, fewer than there are fingerprints."""
        label = np.arange(len(self.fps))
        for i in range(0, len(self.fps), QUERIES):
            linked = []
            for level in range(len(self.ones)):
                at = self.leaf[level][:-1]
                low, high = np.minimum.reduceat(label, at), np.maximum.reduceat(label, at)
                linked.append(np.where(low == high, low, -1))
            for q, leaf, _ in self._descend(t, np.arange(i, min(i + QUERIES, len(self.fps))), True, linked, label.copy()):
                label = _union(label, q, leaf)
        apart = np.flatnonzero(label != np.arange(len(label)))
        return self.order[apart], self.order[label[apart]]


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join classes along links; a label is the smallest place of its class."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        label = label.copy()
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            hop = label[label]
            if (hop == label).all():
                break
            label = hop


def _blocks(m: int) -> list[tuple[int, int]]:
    """(shift, mask) of ``m`` blocks that make up the 64 bits."""
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links(fps: DataFrame, t: int, *, agree: int | None = None) -> DataFrame:
    """Links between distinct fingerprints (column fp, long) within ``t`` bits.

    Each bucket gives links that span its classes, so a dense group costs links in
    proportion to its size.
    """
    if agree is None:
        n, agree = fps.count(), 1
        while agree < 4 and n >> (64 * agree // (t + agree)) > BUCKET:
            agree += 1
    blocks = _blocks(t + agree)
    keys = []
    for number, chosen in enumerate(combinations(range(t + agree), agree)):
        parts = [F.shiftrightunsigned("fp", blocks[i][0]).bitwiseAND(blocks[i][1]) for i in chosen]
        key = functools.reduce(lambda x, y: F.shiftleft(x, 64 // (t + agree) + 1).bitwiseOR(y), parts)
        keys.append(F.shiftleft(key, 10).bitwiseOR(F.lit(number)))  # comb() of 8 over 4 and less fits ten bits
    assert comb(t + agree, agree) <= 1024
    dealt = fps.select("fp", F.explode(F.array(*keys)).alias("key")).repartition(partitions(fps.sparkSession), "key")  # little data, much work: not to be coalesced

    @fresh
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("key").to_numpy(), b.column("fp").to_numpy()) for b in batches]
        if not parts:
            return
        key, fp = (np.concatenate([p[i] for p in parts]) for i in range(2))
        index = GrayIndex(key, fp.view(np.uint64))
        a, b = index.forest(t)
        for i in range(0, len(a), 1 << 18):
            yield batch(_LINK, fp[a[i : i + (1 << 18)]], fp[b[i : i + (1 << 18)]])

    return dealt.mapInArrow(run, "a long, b long").distinct()


#: Links whose components one task finds, 16 MB of them; more are spread over rounds.
GATHERED = 1 << 20

_LABEL = pa.schema([("node", pa.int64()), ("component", pa.int64())])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of the edges (a, b) with the smallest node it can reach.

    Up to ``GATHERED`` distinct edges are joined by one task in a stage of its own. Rounds
    over them would cost the driver thousands of tasks to keep account of, as each one has
    several shuffles. Of more edges, labels spread along them and jump along themselves
    until none changes; each round is cut, so a lost executor costs one round at most.
    Nothing but counts comes to the driver.
    """
    edges = cut(edges.select("a", "b").filter("a <> b").distinct())
    if edges.count() <= GATHERED:
        return cut(edges.coalesce(1).mapInArrow(_gather, "node long, component long"))
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("low"))
        hop = labels.select(F.col("node").alias("at"), F.col("component").alias("hop"))
        new = labels.join(near, labels.node == near.a).select("node", "component", F.least("component", "low").alias("low"))
        new = cut(new.join(hop, new.low == hop.at).select("node", F.least("low", "hop").alias("component"), (F.least("low", "hop") < F.col("component")).alias("moved")))
        moved = new.filter("moved").limit(1).count()
        labels = new.select("node", "component")
        if not moved:
            return labels


@fresh
def _gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends = _read(batches, ("a", "b"))
    if not ends:
        return
    node, place = np.unique(np.concatenate(ends), return_inverse=True)
    label = _union(np.arange(len(node)), *np.split(place, 2))
    for i in range(0, len(node), 1 << 18):
        yield batch(_LABEL, node[i : i + (1 << 18)], node[label[i : i + (1 << 18)]])


_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, k: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp of every whole text. Null counts as empty, whose fingerprint is 0."""

    @fresh
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column("text"))
            made = np.fromiter((fingerprint(data[x:y].tobytes(), k) for x, y in zip(at, at[1:], strict=False)), dtype=np.uint64, count=len(at) - 1)
            yield batch(_FP, b.column("doc_id"), made.view(np.int64))

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def simhash_classes(docs: DataFrame, *, k: int = 4, t: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of documents whose fingerprints are linked within ``t`` bits.

    Returns doc_id, fp (long) and component_id, the smallest doc_id that links
    reach. Equal texts, repeated rows and all texts without words share their
    class; a text with fewer than ``k`` words is one shingle. Null texts count
    as empty; an empty table gives no rows; extra columns are ignored. Copies
    meet as one fingerprint before anything is compared.
    """
    fps = cut(fingerprints(docs, k, id_col=id_col, text_col=text_col))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = links(distinct.select("fp"), t)
    one = distinct.select(F.col("fp").alias("a"), F.col("first").alias("first_a"))
    two = distinct.select(F.col("fp").alias("b"), F.col("first").alias("first_b"))
    edges = found.join(one, "a").join(two, "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    reached = components(edges)
    classes = distinct.join(reached, distinct["first"] == reached.node, "left").select("fp", F.coalesce("component", "first").alias("component_id"))
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def shingles(text: bytes, k: int) -> set[bytes]:
    words = text.lower().split()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


#: Documents whose shingles are counted to tell the common ones, and how many of these are sent out.
#: They only set the order of shingles, so they decide about cost and never about results.
COUNTED, COMMON = 8_000, 1 << 16
#: Documents that share a shingle and that the chains pair outright; the others of a larger group are compared afterwards.
CHAINED = 3
#: Bytes of the least sketch of a set; one has about a bit for each shingle, and a larger one folds to a smaller.
SKETCH = 64
#: Documents expected at a common shingle before they are dealt to several tasks for the chains,
#: and documents of a large group that one task compares with as many others.
CROWD, BLOCK = 1 << 16, 1 << 12

_SET = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("size", pa.int32())])
_HASH = pa.schema([("h", pa.int64())])
_DEALT = pa.schema([("key", pa.int64()), ("salt", pa.int32()), ("doc_id", pa.int64()), ("size", pa.int32()), ("place", pa.int32())])
_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("size", pa.int32()), ("place", pa.int32())])
_WHOLE = pa.schema([("doc_id", pa.int64()), ("hashes", pa.binary())])
_SKETCH = pa.schema([("doc_id", pa.int64()), ("size", pa.int32()), ("sketch", pa.binary()), ("least", pa.binary())])


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct k-word shingles; fewer words are one shingle."""
    h = word_hashes(text.lower().split())
    return np.unique(seed_hashes(h, "1" * min(k, len(h)))) if len(h) else np.zeros(0, np.uint64)


def _sets(b: pa.RecordBatch, k: int) -> list[np.ndarray]:
    data, at = utf8(b.column("text"))
    return [shingle_hashes(data[x:y].tobytes(), k) for x, y in zip(at, at[1:], strict=False)]


def _sketch(hashes: np.ndarray) -> bytes:
    """Parities of the set's counts by some bits of the hash: two sets differ in at least as many shingles as their sketches in bits."""
    bits = SKETCH * 8
    while bits * 2 <= len(hashes):
        bits *= 2
    return np.packbits(np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits).astype(np.uint8) & 1).tobytes()


def _fold(sketch: np.ndarray, n: int) -> np.ndarray:
    """The sketch that the same set has with ``n`` bytes."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, n), axis=0)


def _needed(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles that sets of these sizes share at least when they are similar."""
    return np.ceil(similarity / (1 + similarity) * (x + y) - 1e-9)


def _could(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of sizes x and y can be similar if the first shingle they share is at places p and q."""
    return (np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-9) & (np.minimum(x - p, y - q) >= _needed(x, y, similarity))


def _read(batches: Iterable[pa.RecordBatch], names: Iterable[str]) -> list[np.ndarray]:
    parts = [[b.column(name).to_numpy(zero_copy_only=False) for name in names] for b in batches]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _units(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], names: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """The columns ``names`` of each run of rows with the same keys, one run in memory at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        at = [b.column(k).to_numpy() for k in keys]
        cuts = [0, *(np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], axis=0)) + 1).tolist(), b.num_rows]
        for x, y in zip(cuts, cuts[1:], strict=False):
            unit = tuple(int(c[x]) for c in at)
            if held and unit != last:
                yield _read(held, names)
                held = []
            held.append(b.slice(x, y - x))
            last = unit
    if held:
        yield _read(held, names)


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])[: len(low)] & (low != high)
    return low[new], high[new]


def _meet(key: np.ndarray, salt: np.ndarray, doc: np.ndarray, size: np.ndarray, place: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs to verify, and a mask of the rows in groups that the chains don't pair outright.

    A row has three pairs at most with later ones, so that pairs grow with the rows, however
    large groups are: the next by size, and the next two in an order of its key's own. A salt
    from 0 tells a part of a group that was dealt out; it is large whatever is here of it.
    """

    def steps(order: np.ndarray, most: int) -> None:
        k, d, x, p = group[order], doc[order], size[order], place[order]
        for step in range(1, min(most, len(k) - 1) + 1):
            i = np.flatnonzero(k[step:] == k[:-step])
            if not len(i):
                break
            i = i[_could(x[i], x[i + step], p[i], p[i + step], similarity)]
            left.append(d[i])
            right.append(d[i + step])

    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    by_key = np.lexsort((salt, key))
    new = np.concatenate([[True], (np.diff(key[by_key]) != 0) | (np.diff(salt[by_key]) != 0)])[: len(key)]
    group = np.empty(len(key), dtype=np.int64)
    group[by_key] = np.cumsum(new) - 1
    large = (np.bincount(group)[group] > CHAINED) | (salt >= 0)
    steps(np.lexsort((doc, size, group)), 1)
    with np.errstate(over="ignore"):
        mixed = (doc ^ key).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    steps(np.lexsort((mixed ^ (mixed >> np.uint64(29)), group)), CHAINED - 1)
    return *_distinct_pairs(np.concatenate(left), np.concatenate(right)), large


def _across(size: np.ndarray, place: np.ndarray, label: np.ndarray, part: np.ndarray, sketch: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs with different labels that can be similar; rows come by size.

    Pairs are across two parts of a group, or all of them if there is one part.
    """
    end = np.searchsorted(size, np.floor(size / similarity + 1e-9), side="right")
    one = not len(part) or (part == part[0]).all()
    for i in range(len(size)):
        j = np.arange(i + 1, end[i])
        j = j[(label[j] != label[i]) & (one | (part[j] != part[i]))]
        j = j[_could(size[i], size[j], place[i], place[j], similarity)]
        apart = np.bitwise_count(sketch[j] ^ sketch[i]).sum(1, dtype=np.int64)
        j = j[apart <= size[i] + size[j] - 2 * _needed(size[i], size[j], similarity)]
        if len(j):
            yield np.full(len(j), i), j


def near_duplicates(docs: DataFrame, *, k: int = 5, similarity: float = 0.8, linked: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents whose k-word shingles are alike: doc_id and component_id of those with a partner.

    Two documents are linked if the Jaccard similarity of their sets of k-word
    shingles (as 64-bit hashes) is at least ``similarity``; the components are
    those of all such links, and of the classes in ``linked`` (doc_id, component_id;
    see ``simhash_classes``) if given, whose members aren't compared again. Texts
    without words are alike. Null texts count as empty; rows with a null id are left out.

    Equal sets meet by digest, and one document stands for them. With all sets in
    one order, similar sets share a shingle among the first n - ceil(similarity n) + 1
    of n (the prefix filter), so documents are dealt out by those, rare ones first.
    Those that share one are linked along chains, which pair up to ``CHAINED``
    documents outright. Of a larger group all pairs that those verified links have
    not joined are then tried unless their sizes, places or sketches rule them out. That
    goes by blocks of about ``BLOCK`` documents: a task compares two of them and
    holds no more, so a group of any size is spread over the cluster.
    """
    crowd, block = CROWD, BLOCK
    texts = id_text(docs, id_col, text_col).filter("doc_id IS NOT NULL")

    @fresh
    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = _sets(b, k)
            yield batch(_SET, b.column("doc_id"), [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], [len(s) for s in sets])

    made = cut(texts.mapInArrow(summarise, "doc_id long, digest binary, size int"))
    stands = cut(made.join(made.groupBy("digest").agg(F.min("doc_id").alias("first")), "digest").select("doc_id", "first"))
    same = stands.filter("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    texts = drop_ids(texts, stands.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("first")).alias("is_first")).filter("NOT is_first"))

    @fresh
    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(_HASH, np.concatenate([*_sets(b, k), np.zeros(0, np.uint64)]).view(np.int64))

    every = max(1, made.count() // COUNTED)
    counted = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).mapInArrow(hashes, "h long").groupBy("h").count().filter("count > 3")
    top = counted.orderBy(F.desc("count"), "h").limit(COMMON).collect()
    common = np.array([r.h for r in top], dtype=np.int64).view(np.uint64)
    often = np.array([r["count"] for r in top], dtype=np.int64)[np.argsort(common)]
    common = np.sort(common)

    @fresh
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefixes, salts, docs, sizes = [], [], b.column("doc_id").to_numpy(), []
            for doc, s in zip(docs.tolist(), _sets(b, k), strict=True):
                n, weight = len(s) - ceil(similarity * len(s) - 1e-9) + 1, np.zeros(len(s), np.int64)
                if len(common) and len(s):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    weight = np.where(common[at] == s, often[at], 0)
                    if weight.any():
                        order = np.lexsort((s, weight))
                        s, weight = s[order], weight[order]
                n = n if n > 1 else 0  # so few shingles are similar only if equal
                shares = weight[:n] * every // crowd + 1
                prefixes.append(s[:n])
                salts.append(np.where(shares > 1, xxhash.xxh32_intdigest(doc.to_bytes(8, "little", signed=True)) % shares, -1))
                sizes.append(len(s))
            n = np.array([len(p) for p in prefixes], dtype=np.int64)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield batch(_DEALT, np.concatenate([*prefixes, np.zeros(0, np.uint64)]).view(np.int64), np.concatenate([*salts, np.zeros(0, np.int64)]).astype(np.int32), np.repeat(docs, n), np.repeat(np.array(sizes, dtype=np.int32), n), place.astype(np.int32))

    @fresh
    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _read(batches, _DEALT.names)
        if not columns:
            return
        key, salt, doc, size, place = columns
        a, b, large = _meet(key, salt, doc, size, place, similarity)
        none = pa.nulls(len(a), pa.int64())
        yield batch(_MET, a, b, none, none.cast(pa.int32()), none.cast(pa.int32()))
        yield batch(_MET, doc[large], pa.nulls(int(large.sum()), pa.int64()), key[large], size[large], place[large])

    n = partitions(docs.sparkSession)
    dealt = texts.mapInArrow(deal, "key long, salt int, doc_id long, size int, place int").repartition(n, "key", "salt")
    met = cut(dealt.mapInArrow(meet, "a long, b long, key long, size int, place int"))
    pairs = met.filter("b IS NOT NULL").select("a", "b").distinct()
    large = met.filter("b IS NULL")

    def either(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).filter("doc_id IS NOT NULL").distinct()

    @fresh
    def outline(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = _sets(b, k)
            whole = [_sketch(s) for s in sets]
            least = [_fold(np.frombuffer(s, dtype=np.uint8), SKETCH).tobytes() for s in whole]
            yield batch(_SKETCH, b.column("doc_id"), [len(s) for s in sets], whole, least)

    sketches = cut(join_few(texts, either(met), "doc_id").select("doc_id", "text").mapInArrow(outline, "doc_id long, size int, sketch binary, least binary"))

    @fresh
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(_WHOLE, b.column("doc_id"), [s.tobytes() for s in _sets(b, k)])

    @fresh
    def sift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (x, xs), (y, ys) = utf8(b.column("sketch_a")), utf8(b.column("sketch_b"))
            m, n = (b.column(c).to_numpy().astype(np.int64) for c in ("size_a", "size_b"))
            apart = np.zeros(b.num_rows, np.int64)
            for i in range(b.num_rows):
                s, u = x[xs[i] : xs[i + 1]], y[ys[i] : ys[i + 1]]
                least = min(len(s), len(u))
                apart[i] = np.bitwise_count(_fold(s, least) ^ _fold(u, least)).sum(dtype=np.int64)
            mask = pa.array(apart <= m + n - 2 * _needed(m, n, similarity))
            yield batch(_LINK, b.column("a").filter(mask), b.column("b").filter(mask))

    @fresh
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (x, xs), (y, ys) = utf8(b.column("hashes_a")), utf8(b.column("hashes_b"))
            good = []
            for i in range(b.num_rows):
                s, u = x[xs[i] : xs[i + 1]].view(np.uint64), y[ys[i] : ys[i + 1]].view(np.uint64)
                both = len(np.intersect1d(s, u, assume_unique=True))
                good.append(both >= similarity * (len(s) + len(u) - both))
            mask = pa.array(good, type=pa.bool_())
            yield batch(_LINK, b.column("a").filter(mask), b.column("b").filter(mask))

    def both_sides(pairs: DataFrame, df: DataFrame) -> DataFrame:
        for name in ("a", "b"):
            pairs = pairs.join(df.select(F.col("doc_id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in df.columns if c != "doc_id")), name)
        return pairs

    def verified(pairs: DataFrame) -> DataFrame:
        likely = cut(both_sides(pairs, sketches.drop("least")).mapInArrow(sift, "a long, b long").distinct())
        sets = cut(join_few(texts, either(likely), "doc_id").select("doc_id", "text").mapInArrow(keep, "doc_id long, hashes binary"))
        return cut(both_sides(likely, sets).mapInArrow(verify, "a long, b long"))

    @fresh
    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _units(batches, ("key", "low", "high"), ("a", "size", "place", "label", "part", "least")):
            order = np.lexsort((columns[0], columns[1]))
            doc, size, place, label, part, least = (c[order] for c in columns)
            sketch = np.stack([np.frombuffer(x, dtype=np.uint64) for x in least])
            for i, j in _across(size.astype(np.int64), place.astype(np.int64), label, part, sketch, similarity):
                yield batch(_LINK, np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j]))

    if linked is not None:
        same = cut(same.unionByName(linked.filter("doc_id <> component_id").select(F.col("component_id").alias("a"), F.col("doc_id").alias("b"))))
    found = verified(pairs)
    if large.limit(1).count():
        labelled = large.join(components(same.unionByName(found)).select(F.col("node").alias("a"), "component"), "a", "left").withColumn("label", F.coalesce("component", "a"))
        labelled = cut(labelled.select("key", "a", "size", "place", "label"))
        apart = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
        split = labelled.join(apart.select("key", F.ceil(F.col("rows") / block).cast("int").alias("parts")), "key")
        split = split.join(sketches.select(F.col("doc_id").alias("a"), "least"), "a").withColumn("part", F.pmod(F.xxhash64("a", "key"), F.col("parts")).cast("int"))
        # Part x meets each other part, and itself in the unit (x, x).
        split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        split = split.select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "a", "size", "place", "label", "part", "least")
        units = split.repartition(n, "key", "low", "high").sortWithinPartitions("key", "low", "high")
        rest = cut(units.mapInArrow(across, "a long, b long").distinct())
        found = found.unionByName(verified(rest))
    return components(same.unionByName(found)).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
