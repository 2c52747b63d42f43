"""Byte-level BPE encoding and decoding with a segment tree per piece.

A text is cut into pieces by the tokenizer's pattern, and every piece is merged
by itself. Over a piece's byte positions stands a segment tree; the leaf of a
part's first byte holds the rank of that part joined with the next one, and
every inner node the leftmost smallest rank below it. The root is the next
merge. A merge ends one part and changes the pairs of two live neighbours:
three point updates, each logarithmic in the piece's bytes, so a piece of n
bytes takes n log n steps whatever it holds.

The trees of many short pieces are the rows of a matrix and merge at the same
time. Documents are encoded where they are read, nothing is shuffled. A worker
keeps the ids of a bounded number of short pieces it has seen.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.common import pick


@dataclass(frozen=True)
class ByteBpeParams:
    """``ranks``: path of a rank file (base64 bytes and rank a line), which
    every executor can read; ``pattern``: what a piece is; ``kept_pieces``:
    short pieces whose ids a worker keeps; ``part_chars``: characters worked on
    at a time, of one text or of several."""
    ranks: str
    pattern: str
    kept_pieces: int = 1 << 18
    part_chars: int = 1 << 20


MOST = 64  # bytes of a piece that is encoded along with others and kept


def default_params() -> ByteBpeParams:
    import public_tokenizers
    return ByteBpeParams(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def load_ranks(path: str) -> dict:
    """Rank by token bytes; a token's rank is its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def encode_piece(piece: bytes, ranks: dict) -> list:
    """Ids of one piece: of all neighbouring parts whose joined bytes have a
    rank, the leftmost with the smallest rank is joined, until none is left. A
    piece that is a token itself is that token; a byte without a rank is a KeyError."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << max(0, n - 1).bit_length()
    bits, none = size.bit_length(), 1 << 62  # a node is rank and position in one number, so the smaller of two is the leftmost minimum
    mask = (1 << bits) - 1
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    tree = [none] * (2 * size)
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank << bits | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    while tree[1] < none:
        at = tree[1] & mask
        gone = following[at]
        end = following[at] = following[gone]
        changed = [(gone, None)]
        if end < n:
            before[end] = at
            changed.append((at, get(piece[at:following[end]])))
        else:
            changed.append((at, None))
        if at:
            left = before[at]
            changed.append((left, get(piece[left:end])))
        for start, rank in changed:
            node = size + start
            tree[node] = none if rank is None else rank << bits | start
            while node > 1:  # up to the root, or to a node that stays as it is
                a, b = tree[node], tree[node ^ 1]
                node >>= 1
                if b < a:
                    a = b
                if tree[node] == a:
                    break
                tree[node] = a
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:following[at]]])
        at = following[at]
    return out


class PairTable:
    """Rank of two neighbouring tokens' joined bytes, by their ids: every split
    of a token into two tokens, sorted, so its size is bounded by the
    vocabulary's bytes."""

    def __init__(self, ranks: dict):
        self.width = max(ranks.values(), default=-1) + 1
        found = [(ranks[x[:k]] * self.width + ranks[x[k:]], i) for x, i in ranks.items() for k in range(1, len(x)) if x[:k] in ranks and x[k:] in ranks]
        rows = np.array(sorted(found), np.int64).reshape(-1, 2)
        self.keys, self.values = np.append(rows[:, 0], -1), np.append(rows[:, 1], -1)  # a last entry that no pair equals
        self.bytes = np.full(256, -1, np.int64)
        for x, i in ranks.items():
            if len(x) == 1:
                self.bytes[x[0]] = i

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where there is none; an id of -1 is no token."""
        wanted = np.where((left < 0) | (right < 0), -2, left * self.width + right)
        at = np.searchsorted(self.keys[:-1], wanted)
        return np.where(self.keys[at] == wanted, self.values[at], -1)


def encode_pieces(pieces: list, table: PairTable, size: int) -> list:
    """Ids (little-endian 32-bit, as bytes) of many pieces of at most ``size``
    bytes (a power of two), none a token itself: the trees of ``encode_piece``,
    one a row of a matrix, all merging at the same time."""
    m, bits, none = len(pieces), size.bit_length(), 1 << 62
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    data = np.frombuffer(b"".join(x.ljust(size, b"\0") for x in pieces), np.uint8).reshape(m, size)
    place = np.arange(size)
    live = place < lengths[:, None]
    ids = np.where(live, table.bytes[data], -1)
    if (ids[live] < 0).any():
        raise KeyError("a byte without a rank")
    ids = np.concatenate([ids, np.full((m, 1), -1)], axis=1)  # the place after the last byte holds no token
    following = np.broadcast_to(np.append(np.minimum(place + 1, size), size), (m, size + 1)).copy()
    before = np.broadcast_to(np.append(place - 1, size - 1), (m, size + 1)).copy()

    def keys(left: np.ndarray, right: np.ndarray, start: np.ndarray) -> np.ndarray:
        rank = table.ranks(left, right)
        return np.where(rank < 0, none, rank << bits | start)

    tree = np.full((m, 2 * size), none, np.int64)
    tree[:, size:] = keys(ids[:, :-1], ids[:, 1:], place)
    half = size
    while half > 1:
        tree[:, half // 2:half] = np.minimum(tree[:, half:2 * half:2], tree[:, half + 1:2 * half:2])
        half //= 2

    def update(rows: np.ndarray, start: np.ndarray, value) -> None:
        node = start + size
        tree[rows, node] = value
        for _ in range(bits - 1):
            value = np.minimum(tree[rows, node], tree[rows, node ^ 1])
            node = node >> 1
            tree[rows, node] = value

    rows = np.flatnonzero(tree[:, 1] < none)
    while len(rows):
        root = tree[rows, 1]
        at = root & ((1 << bits) - 1)
        gone = following[rows, at]
        end = following[rows, gone]
        following[rows, at], before[rows, end] = end, at
        ids[rows, at] = root >> bits
        live[rows, gone] = False
        update(rows, gone, none)
        update(rows, at, keys(root >> bits, ids[rows, end], at))
        held = at > 0
        some, left = rows[held], before[rows[held], at[held]]
        update(some, left, keys(ids[some, left], root[held] >> bits, left))
        rows = rows[tree[rows, 1] < none]
    flat, ends = ids[:, :-1][live].astype("<u4").tobytes(), (np.cumsum(live.sum(axis=1)) * 4).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class _Pieces(dict):
    """Ids (little-endian 32-bit, as bytes) by piece. A full table becomes the
    older one, in place of the one before; pieces found there come back, so
    frequent ones stay and about twice ``kept_pieces`` are held at most."""

    def __init__(self, p: ByteBpeParams):
        import regex
        super().__init__()
        self.older: dict = {}
        self.params, self.ranks = p, load_ranks(p.ranks)
        self.pattern, self.gap = regex.compile(p.pattern), regex.compile(r"(?<=\S)(?=\s)")
        self.bytes = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, i in self.ranks.items():
            self.bytes[i] = token

        self.table = PairTable(self.ranks)

    def __missing__(self, piece: str) -> bytes:
        found = encode_piece(piece.encode("utf-8", "replace"), self.ranks)
        return struct.pack(f"<{len(found)}I", *found)

    def learn(self, pieces: set) -> None:
        """Take up the ids of those pieces that are short, new ones many at a time."""
        new: dict = {}
        for piece in pieces.difference(self.keys()):
            if piece in self.older:
                self[piece] = self.older[piece]
            elif len(data := piece.encode("utf-8", "replace")) <= MOST:
                if data in self.ranks:
                    self[piece] = self.ranks[data].to_bytes(4, "little")
                else:
                    new.setdefault(max(2, 1 << (len(data) - 1).bit_length()), []).append((piece, data))
        for size, found in new.items():
            for i in range(0, len(found), 4096):
                part = found[i:i + 4096]
                self.update(zip([x for x, _ in part], encode_pieces([x for _, x in part], self.table, size), strict=True))

    def forget(self) -> None:
        """Called between texts: a full table becomes the older one."""
        if len(self) >= self.params.kept_pieces:
            self.older = dict(self)
            self.clear()

    def parts(self, text: str) -> Iterator[str]:
        """A long text in parts. No piece goes from a character on to white
        space after it, and none looks back, so cuts there change no piece."""
        start = 0
        while len(text) - start > self.params.part_chars:
            cut = self.gap.search(text, start + self.params.part_chars)
            if cut is None:
                break
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, texts: list) -> Iterator[list]:
        """The ids of each text in turn, as bytes, a part of a long text at a
        time; short texts' new pieces are looked at together."""
        held, size = [], 0
        for text in [*texts, None]:
            if held and (text is None or size + len(text) > self.params.part_chars):
                found = [self.pattern.findall(t) for t in held]
                self.learn(set().union(*found))
                yield from ([b"".join(map(self.__getitem__, x))] for x in found)
                self.forget()
                held, size = [], 0
            if text is None:
                return
            if len(text) > self.params.part_chars:
                yield self._long(text)
            else:
                held.append(text)
                size += len(text)

    def _long(self, text: str) -> Iterator[bytes]:
        for part in self.parts(text):
            found = self.pattern.findall(part)
            self.learn(set(found))
            yield b"".join(map(self.__getitem__, found))
            self.forget()

    def decode(self, ids) -> bytes:
        if len(ids) and not 0 <= min(ids) <= max(ids) < len(self.bytes):
            raise ValueError(f"an id outside the {len(self.bytes)} tokens")
        return b"".join(map(self.bytes.__getitem__, ids))


_LOADED: dict = {}


def _pieces(p: ByteBpeParams) -> _Pieces:
    """The table of a Python worker, which outlives a task."""
    if p not in _LOADED:
        _LOADED[p] = _Pieces(p)
    return _LOADED[p]


def _batches(rows: pa.RecordBatch, size: int = 512) -> Iterator[pa.RecordBatch]:
    for i in range(0, rows.num_rows, size):
        yield rows.slice(i, size)


def encode(docs: DataFrame, params: ByteBpeParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) per document: the whole text's ids, where
    special tokens' strings are plain text. A null or empty text has no ids;
    null ids and repeated rows stay rows of their own; other columns are not looked at."""
    p = params or default_params()
    d = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(p)
        for rows in (x for b in batches for x in _batches(b)):
            texts = [t or "" for t in rows.column("text").to_pylist()]
            ids = [np.frombuffer(b"".join(x), "<u4").astype("i4") for x in pieces.encode(texts)]
            yield pa.record_batch([rows.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, params: ByteBpeParams | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, data, text``: the ids' bytes, and these as UTF-8 (bytes that are
    none become U+FFFD). Null or no ids decode to nothing, null entries are left
    out, an id without a token is an error."""
    p = params or default_params()
    d = pick(encoded, doc_id=id_col, ids=ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(p)
        for rows in (x for b in batches for x in _batches(b)):
            data = [pieces.decode([i for i in ids or [] if i is not None]) for ids in rows.column("ids").to_pylist()]
            yield pa.record_batch([rows.column("doc_id"), pa.array(data, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in data], pa.string())],
                                  names=["doc_id", "data", "text"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, data binary, text string")


def digests(docs: DataFrame, params: ByteBpeParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document: the texts
    are encoded, their ids decoded, and neither is kept longer than a part of a
    text. Nulls, empty texts and repeated rows as in ``encode``."""
    p = params or default_params()
    d = pick(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(p)
        for rows in (x for b in batches for x in _batches(b)):
            n, a, b = [], [], []
            for parts in pieces.encode([t or "" for t in rows.column("text").to_pylist()]):
                count, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
                for data in parts:
                    count += len(data) // 4
                    ids.update(data)
                    decoded.update(pieces.decode(np.frombuffer(data, "<u4").tolist()))
                n.append(count)
                a.append(ids.hexdigest())
                b.append(decoded.hexdigest())
            yield pa.record_batch([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
