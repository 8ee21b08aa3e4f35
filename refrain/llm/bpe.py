"""Byte-level BPE as a lazily determinised transducer, and its decoder.

Merges are compiled into pair tests: tokens ``a b`` may stand side by side just
if encoding their joined bytes gives ``a b`` again, and a sequence is the BPE
encoding of its bytes just if all its neighbours may. So every prefix of a
piece has one last token, and a nondeterministic transducer can read bytes while
it follows, in a trie of all tokens, each token that may be under way.

Its determinised states are sets of such paths with the output that each still
owes. What all paths owe alike is emitted at once, so that a state's memory is
bounded by the longest token. States and moves are made on first use and kept;
a state table over its bound is dropped and made again as needed.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from refrain.llm.base import batch, id_text, kept, utf8

#: Bounds of one worker's tables; a table that reaches its bound is emptied.
MAX_STATES = 250_000
MAX_PIECES = 320_000
#: Pieces over this length go through the transducer each time.
MAX_CACHED_PIECE = 64
#: Texts whose results are sent back at once; letters, or pieces of a longer text, that are encoded at once.
ROWS, SLAB = 1000, 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Merges:
    """Merge ranks and the pair test, with its results kept.

    While a token is built up by itself, its outermost part at either end grows
    merge by merge. ``_edge`` lists the parts at one end, each with the rank of
    the merge that ends it. Two tokens may stand side by side if no part at the
    end of the first and part at the start of the second, alive at one time,
    merge before one of them is merged away inside its own token.
    """

    def __init__(self, ranks: dict[bytes, int], max_pairs: int = 2 * MAX_STATES):
        self.ranks, self.max_pairs = ranks, max_pairs
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._edges: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self._pairs: dict[tuple[int, int], bool] = {}

    def _halves(self, token: bytes, below: int) -> list[bytes]:
        """The parts of a token after all merges ranked below its own."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, i = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == below:
                raise ValueError(f"token {below} is not made by merges of lower rank")
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _edge(self, token: int, end: int) -> list[tuple[bytes, float]]:
        """Innermost first: the parts at the token's start (end 0) or its end (1)."""
        edge = self._edges[end].get(token)
        if edge is None:
            whole = self.tokens[token]
            if len(whole) == 1:
                edge = [(whole, float("inf"))]
            else:
                inner = self._edge(self.ranks[self._halves(whole, token)[-end]], end)
                edge = [*inner[:-1], (inner[-1][0], token), (whole, float("inf"))]
            self._edges[end][token] = edge
        return edge

    def adjacent(self, a: int, b: int) -> bool:
        key = (a, b)
        ok = self._pairs.get(key)
        if ok is None:
            if len(self._pairs) > self.max_pairs:
                self._pairs.clear()
            ok = self._pairs[key] = self._test(self._edge(a, 1), self._edge(b, 0))
        return ok

    def _test(self, left: list[tuple[bytes, float]], right: list[tuple[bytes, float]]) -> bool:
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            rank = self.ranks.get(x + y)
            # Of equal ranks the leftmost pair merges first.
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1


class Transducer:
    """Reads the bytes of a piece and writes its tokens, each once it is certain.

    A path is (owed tokens, last token before the one under way or -1, trie
    node of the bytes since). States are numbered; ``_moves[state]`` has the
    next state and the tokens written for every byte seen there.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.merges, self.max_states = Merges(ranks, 2 * max_states), max_states
        # The trie: the child of (node, byte), each node's token or -1, and whether it goes on.
        self._child: dict[int, int] = {}
        self._token, self._inner = array("i", [-1]), bytearray(1)
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                nxt = self._child.get(node << 8 | byte)
                if nxt is None:
                    nxt = self._child[node << 8 | byte] = len(self._token)
                    self._inner[node] = 1
                    self._inner.append(0)
                    self._token.append(-1)
                node = nxt
            self._token[node] = rank
        self._reset()

    def _reset(self) -> None:
        start = (((), -1, 0),)
        self._paths: list[tuple] = [start]
        self._number: dict[tuple, int] = {start: 0}
        self._moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        paths = []
        for owed, last, node in self._paths[state]:
            nxt = self._child.get(node << 8 | byte)
            if nxt is None:
                continue
            paths.append((owed, last, nxt))
            token = self._token[nxt]
            if token >= 0 and (last < 0 or self.merges.adjacent(last, token)):
                # A boundary: no other path ends here, as each prefix has one encoding.
                paths.append(((*owed, token), token, 0))
        paths = [p for p in paths if self._inner[p[2]]]
        first, common = min((p[0] for p in paths), key=len), 0
        while common < len(first) and all(p[0][common] == first[common] for p in paths):
            common += 1
        out = first[:common]
        key = tuple((p[0][common:], p[1], p[2]) for p in paths)
        number = self._number.get(key)
        if number is None:
            number = self._number[key] = len(self._paths)
            self._paths.append(key)
            self._moves.append({})
        self._moves[state][byte] = (number, out)
        return number, out

    def encode_piece(self, piece: bytes) -> list[int]:
        if len(self._paths) > self.max_states:
            self._reset()
        state, out, moves = 0, [], self._moves
        for byte in piece:
            move = moves[state].get(byte) or self._move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        for owed, _, node in self._paths[state]:
            if node == 0:
                return out + list(owed)
        raise ValueError("a byte of this piece is no token")


class Encoder:
    """Splits text by a pattern and encodes every piece by the transducer.

    Most pieces of natural text have come before, so results are remembered for
    each piece, as the bytes of its ids; the transducer reads those that are new.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES, max_pieces: int = MAX_PIECES):
        self.transducer, self.pattern, self.max_pieces = Transducer(ranks, max_states), regex.compile(pattern), max_pieces
        # Two generations: a full one becomes the old one, from which pieces still in use come back.
        self._kept: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        made = self._kept.get(piece) or self._old.get(piece)
        if made is None:
            made = array("i", self.transducer.encode_piece(piece.encode())).tobytes()
        if len(piece) <= MAX_CACHED_PIECE:
            if len(self._kept) >= self.max_pieces:
                self._old, self._kept = self._kept, {}
            self._kept[piece] = made
        return made

    def _ids(self, pieces: list[str]) -> np.ndarray:
        made: list[bytes | None] = list(map(self._kept.get, pieces))
        at = -1
        try:
            while True:
                at = made.index(None, at + 1)
                made[at] = self._piece(pieces[at])
        except ValueError:  # no piece left
            pass
        return np.frombuffer(b"".join(made), dtype=np.int32)

    def stream(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, ``SLAB`` letters or pieces at a time."""
        if len(text) <= SLAB:
            yield self._ids(self.pattern.findall(text))
            return
        pieces = (m.group() for m in self.pattern.finditer(text))
        while slab := list(islice(pieces, SLAB)):
            yield self._ids(slab)

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.stream(text) for i in ids.tolist()]


class Utf8Stream:
    """Incremental UTF-8: gives the text of all complete characters fed so far.

    ``state`` is the DFA's: how many continuation bytes the open character still
    lacks, and the range that the next one must lie in.
    """

    def __init__(self) -> None:
        self.tail, self.missing, self.low, self.high = b"", 0, 0x80, 0xBF

    def _step(self, byte: int) -> None:
        if self.missing:
            if not self.low <= byte <= self.high:
                raise ValueError("not UTF-8: bad continuation byte")
            self.missing, self.low, self.high = self.missing - 1, 0x80, 0xBF
        elif byte >= 0x80:
            if not 0xC2 <= byte <= 0xF4:
                raise ValueError("not UTF-8: bad lead byte")
            self.missing = 1 + (byte >= 0xE0) + (byte >= 0xF0)
            self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
            self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)

    def feed(self, data: bytes) -> str:
        data = self.tail + data
        # Only the last three bytes can belong to an open character.
        lead = next((i for i in range(len(data) - 1, max(-1, len(data) - 4), -1) if data[i] & 0xC0 != 0x80), len(data))
        self.missing, self.low, self.high = 0, 0x80, 0xBF
        for byte in data[lead:]:
            self._step(byte)
        end = lead if self.missing else len(data)
        self.tail = data[end:]
        return data[:end].decode("utf-8")

    def close(self) -> None:
        if self.tail:
            raise ValueError("not UTF-8: the last character is cut off")


class Decoder:
    """Token ids to bytes through one table; ``stream`` also validates UTF-8 as it goes."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self._size = np.array([len(t) for t in tokens], dtype=np.int64)
        self._at = np.concatenate([[0], np.cumsum(self._size)])[:-1]

    def to_bytes(self, ids: np.ndarray) -> bytes:
        size = self._size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        index = np.arange(ends[-1]) + np.repeat(self._at[ids] - (ends - size), size)
        return self._blob[index].tobytes()

    def stream(self, slabs: Iterable[np.ndarray]) -> Iterator[str]:
        utf8_stream = Utf8Stream()
        for ids in slabs:
            yield utf8_stream.feed(self.to_bytes(ids))
        utf8_stream.close()


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _codec(path: str, pattern: str, max_states: int, max_pieces: int) -> tuple[Encoder, Decoder, list[str]]:
    ranks = load_ranks(path)
    return Encoder(ranks, pattern, max_states, max_pieces), Decoder(ranks), [str(i) for i in range(max(ranks.values(), default=-1) + 1)]


def _texts(column: pa.Array) -> Iterator[str]:
    data, at = utf8(column)
    for a, b in zip(at, at[1:], strict=False):
        yield data[a:b].tobytes().decode("utf-8", "replace")


class _Digests:
    """Digests of a text's ids and of what they decode to, both fed slab by slab."""

    def __init__(self, encoder: Encoder, decoder: Decoder, decimals: list[str]):
        self.encoder, self.decoder, self.decimals = encoder, decoder, decimals

    def __call__(self, text: str) -> tuple[int, str, str]:
        n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()

        def slabs() -> Iterator[np.ndarray]:
            nonlocal n
            for ids in self.encoder.stream(text):
                if len(ids):
                    ids_sha.update((b" " if n else b"") + " ".join(map(self.decimals.__getitem__, ids.tolist())).encode())
                    n += len(ids)
                    yield ids

        for part in self.decoder.stream(slabs()):
            text_sha.update(part.encode())
        return n, ids_sha.hexdigest(), text_sha.hexdigest()


def encode_decode(docs: DataFrame, path: str, pattern: str, *, digests: bool = False, max_states: int = MAX_STATES, max_pieces: int = MAX_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text by the ranks file at ``path`` and decode it again.

    Returns doc_id, ids array<int>, decoded string; with ``digests`` instead
    doc_id, n_tokens, ids_sha256 (of decimal ids joined by a space) and
    decoded_sha256, so that ids needn't leave the task that made them; then ids
    and decoded bytes of a long text are held a slab at a time. A null or empty
    text has no tokens. Repeated rows and ids each return a row; extra columns
    are ignored. No shuffle: each task reads its texts once, and a lost
    executor's tasks just run again.

    Pieces met before are answered from a table, others by the transducer. A
    worker's tables take about 0.2 kB a piece (of which two bounds' worth are
    kept) and 1 kB a state; smaller bounds trade time for memory, never results.
    """

    key = (path, pattern, max_states, max_pieces)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder, decimals = kept(key, lambda: _codec(*key))
        digest = _Digests(encoder, decoder, decimals)
        gc.disable()  # the tables have no cycles, and going through them takes long
        try:
            for b in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
                texts = _texts(b.column("text"))
                if digests:
                    rows = list(map(digest, texts))
                    yield batch(_DIGESTS, b.column("doc_id"), *([r[i] for r in rows] for i in range(3)))
                    continue
                made = [np.concatenate([*encoder.stream(text), np.zeros(0, np.int32)]) for text in texts]
                ends = np.cumsum([0, *map(len, made)])
                ids = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(np.concatenate([*made, np.zeros(0, np.int32)])))
                yield batch(_IDS, b.column("doc_id"), ids, ["".join(decoder.stream([m])) for m in made])
        finally:
            gc.enable()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>, decoded string"
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)
