"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (byte-level BPE) and tokenizer B (sentencepiece) cut the same bytes
into tokens. Where a token of both ends at the same byte, the text can be cut
into groups of A tokens and B tokens that cover the same bytes. The ends are
found by galloping: the shorter list of ends drives an exponential and then a
binary search into the longer one. That gives each end's rank among the longer
list's ends; ends that meet slice the groups, and differences of ranks are the
tokens that a token overlaps.

Tokens that end together are linked, so one's bytes are a suffix of the
other's: the linked id pairs are among the pairs of vocabulary entries of which
one ends with the other. These are numbered from the vocabularies. Their number
is bounded by the vocabularies' total bytes whatever the corpus, so tasks count
them in an array, one sum per pair and task is shuffled, and the table of
counts can be broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.byte_bpe import encode_piece
from larder.llm.common import materialise, pick


@dataclass(frozen=True)
class AlignParams:
    """``a``: path of a tokenizers JSON file: byte-level BPE without a
    normaliser whose pieces ``pattern`` finds; ``b``: path of a sentencepiece
    model. Every executor can read both."""
    a: str
    b: str
    pattern: str


def default_params() -> AlignParams:
    import public_tokenizers as t
    return AlignParams(t.path("byte_bpe_50k.json"), t.path("piece_bpe_32k.model"), t.PATTERN)


def _byte_of_char() -> dict:
    """The character that byte-level BPE writes for each byte, and its byte:
    printable Latin-1 characters stand for themselves, the rest follow from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


STRIDE = 16


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the rising numbers ``short``, how many of the rising numbers
    ``long`` are smaller: from an earlier rank on steps that double, then a
    binary search in the last step. Every 16th number starts from the rank of
    the one 16 before it; the numbers between start from that rank, all at once."""
    n = len(long)
    long_list, rank, starts = long.tolist(), 0, []
    for x in short[::STRIDE].tolist():
        low, step = rank, 1
        while rank < n and long_list[rank] < x:
            low = rank + 1
            rank += step
            step += step
        if rank > low:
            rank = bisect_left(long_list, x, low, min(rank, n))
        starts.append(rank)
    padded = np.append(long, np.iinfo(np.int64).max)
    low = np.repeat(np.array(starts, np.int64), STRIDE)[:len(short)]
    high, step = low.copy(), 1
    todo = np.flatnonzero(padded[low] < short)
    while len(todo):
        at = high[todo]
        low[todo] = at + 1
        high[todo] = at = np.minimum(at + step, n)
        step += step
        todo = todo[padded[at] < short[todo]]
    todo = np.flatnonzero(low < high)
    while len(todo):
        a, b = low[todo], high[todo]
        middle = (a + b) >> 1
        less = padded[middle] < short[todo]
        low[todo] = a = np.where(less, middle + 1, a)
        high[todo] = b = np.where(less, b, middle)
        todo = todo[a < b]
    return low


@dataclass
class Aligned:
    """Tokens of one text: ids and ends of both sides, the last A and B token of
    every group, and for every token of the side with fewer tokens (``driver``,
    "a" or "b") the first and the last token of the other that it overlaps."""
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    driver: str
    first: np.ndarray
    last: np.ndarray


def meet(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple:
    """(last A token of each group, last B token of each group, driving side,
    first and last token of the other side that each driving token overlaps).
    Both lists rise strictly and end alike."""
    swap = len(b_ends) < len(a_ends)
    short, long = (b_ends, a_ends) if swap else (a_ends, b_ends)
    ranks = gallop(short, long)
    both = long[np.minimum(ranks, max(0, len(long) - 1))] == short if len(long) else np.zeros(0, bool)
    first = np.concatenate([[0], ranks[:-1] + both[:-1]]).astype(np.int64)[:len(ranks)]
    at, other = np.flatnonzero(both), ranks[both]
    return (other, at, "b", first, ranks) if swap else (at, other, "a", first, ranks)


class Tokenizers:
    """Both tokenizers and the numbered pairs of ids whose tokens can end together."""

    def __init__(self, p: AlignParams):
        import sentencepiece
        self.b = sentencepiece.SentencePieceProcessor(model_file=p.b)
        self._load_a(p)
        self.b_bytes = [self._b_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.width = len(self.b_bytes)
        self.pairs = self._pairs()
        self.pair_b = self.pairs % self.width
        # A token's text in a list of groups: A tokens, those that end a group, then the same of B.
        a, b = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(self.width)]
        self.shown = [x.encode() for x in [*[i + "," for i in a], *[i + "|" for i in a], *[i + "," for i in b], *[i + ";" for i in b]]]

    def _load_a(self, p: AlignParams) -> None:
        """A's token bytes, and a function from a text to its ids. Where the ids
        follow the merges, as is usual, the vocabulary is a table of ranks and a
        faster library merges by it; else the file's own library does."""
        chars = _byte_of_char()
        with open(p.a, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary = {bytes(chars[c] for c in token): i for token, i in file["model"]["vocab"].items()}
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        merged = [bytes(chars[c] for c in x + y) for x, y in pairs]
        order = [vocabulary[x] for x in merged]
        ranks = {x: vocabulary[x] for x in [*(bytes([k]) for k in range(256)), *merged] if x in vocabulary}
        if file.get("normalizer") is None and order == sorted(set(order)) and len(ranks) == 256 + len(merged):
            import regex
            import tiktoken
            a = tiktoken.Encoding("a", pat_str=p.pattern, mergeable_ranks=ranks, special_tokens={})
            pattern, gap = regex.compile(p.pattern), re.compile(r"\s{1000}")

            def ids(text: str) -> list:
                if not gap.search(text):
                    return a.encode_ordinary(text)
                # The library's own pattern matching fails on very long white space.
                return [i for piece in pattern.findall(text) for i in encode_piece(piece.encode("utf-8", "replace"), ranks)]

            self.a_ids, self.lossless = ids, True  # every byte is a token, and nothing is normalised
        else:
            from tokenizers import Tokenizer
            a = Tokenizer.from_file(p.a)
            a.no_padding()
            a.no_truncation()
            a.encode_special_tokens = True
            self.a_ids, self.lossless = lambda text: a.encode(text, add_special_tokens=False).ids, False

    def _b_bytes(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _pairs(self) -> np.ndarray:
        """Pairs (a * width + b), rising, of entries of which one ends with the
        other; at most as many as the two vocabularies have bytes, times the
        entries of equal bytes."""
        a_of, b_of = {}, {}
        for of, tokens in ((a_of, self.a_bytes), (b_of, self.b_bytes)):
            for i, x in enumerate(tokens):
                if x:
                    of.setdefault(x, []).append(i)
        found = set()
        for x, ids in a_of.items():
            for k in range(len(x)):
                found.update(i * self.width + j for j in b_of.get(x[k:], ()) for i in ids)
        for x, ids in b_of.items():
            for k in range(1, len(x)):
                found.update(i * self.width + j for i in a_of.get(x[k:], ()) for j in ids)
        return np.array(sorted(found), np.int64)

    def align(self, text: str | None) -> Aligned | None:
        """None for a text without tokens: null, empty, or one that a side does
        not give back (a space, then the text) byte by byte."""
        if not text:
            return None
        whole = " " + text
        a, b, data = self.a_ids(whole), self.b.encode(text), whole.encode("utf-8", "replace")
        if b"".join(map(self.b_bytes.__getitem__, b)) != data or not (self.lossless or b"".join(map(self.a_bytes.__getitem__, a)) == data):
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        sizes_a, sizes_b = self.a_sizes[a], self.b_sizes[b]
        if not (sizes_a.all() and sizes_b.all()):
            return None
        return Aligned(a, b, *meet(np.cumsum(sizes_a), np.cumsum(sizes_b)))

    def group_text(self, x: Aligned) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: every token's text with what follows it, in the
        order of the groups, A before B."""
        na, nb = np.diff(x.group_a, prepend=-1), np.diff(x.group_b, prepend=-1)
        out = np.empty(len(x.a) + len(x.b), np.int64)
        ends_a, ends_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
        ends_a[x.group_a] = ends_b[x.group_b] = 1
        out[np.arange(len(x.a)) + np.repeat(np.cumsum(nb) - nb, na)] = x.a + ends_a * len(self.a_bytes)
        out[np.arange(len(x.b)) + np.repeat(np.cumsum(na), nb)] = 2 * len(self.a_bytes) + x.b + ends_b * self.width
        return b"".join(map(self.shown.__getitem__, out.tolist()))[:-1]

    def linked(self, x: Aligned) -> tuple:
        """Numbers of the distinct linked pairs and how often each is linked."""
        pairs, times = np.unique(x.a[x.group_a] * self.width + x.b[x.group_b], return_counts=True)
        return np.searchsorted(self.pairs, pairs).astype("<i4"), times.astype("<i4")


_LOADED: dict = {}


def _tokenizers(p: AlignParams) -> Tokenizers:
    """Those of a Python worker, which outlive a task."""
    if p not in _LOADED:
        _LOADED[p] = Tokenizers(p)
    return _LOADED[p]


def _rows(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, size):
            yield b.slice(i, size)


def align(docs: DataFrame, params: AlignParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself, per document: ``doc_id, a_ids, b_ids, groups``
    (array of last A and last B token of each group, counted from 0),
    ``driver`` ("a" or "b", the side with fewer tokens; A if equal),
    ``overlaps`` (per driving token, the first and last token of the other side
    that shares bytes with it). Texts without tokens have empty arrays and a null driver."""
    p = params or default_params()
    d = pick(docs, doc_id=id_col, text=text_col)
    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    ends = pa.struct([("a", pa.int32()), ("b", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(p)
        for rows in _rows(batches):
            found = [both.align(t) for t in rows.column("text").to_pylist()]
            pair = lambda names, x, y: [dict(zip(names, v, strict=True)) for v in zip(x.tolist(), y.tolist(), strict=True)]
            yield pa.record_batch([
                rows.column("doc_id"), pa.array([x.a.tolist() if x else [] for x in found], pa.list_(pa.int32())),
                pa.array([x.b.tolist() if x else [] for x in found], pa.list_(pa.int32())),
                pa.array([pair("ab", x.group_a, x.group_b) if x else [] for x in found], pa.list_(ends)),
                pa.array([x.driver if x else None for x in found], pa.string()),
                pa.array([pair(("first", "last"), x.first, x.last) if x else [] for x in found], pa.list_(span))],
                names=["doc_id", "a_ids", "b_ids", "groups", "driver", "overlaps"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, groups array<struct<a:int,b:int>>, "
                             "driver string, overlaps array<struct<first:int,last:int>>")


def _aligned(d: DataFrame, p: AlignParams) -> DataFrame:
    """Figures per document, and its linked pairs by number with their times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(p)
        for rows in _rows(batches):
            figures, digest, pairs, times = [], [], [], []
            for text in rows.column("text").to_pylist():
                x = both.align(text)
                if x is None:
                    figures.append((0, 0, 0, 0, 0))
                    digest.append("")
                    pairs.append(b"")
                    times.append(b"")
                    continue
                k, n = both.linked(x)
                figures.append((len(x.a), len(x.b), len(x.group_a), int(n.sum()), int((x.last - x.first + 1).sum())))
                digest.append(hashlib.sha256(both.group_text(x)).hexdigest())
                pairs.append(k.tobytes())
                times.append(n.tobytes())
            numbers = [pa.array(x, pa.int64()) for x in zip(*figures, strict=True)]
            yield pa.record_batch([rows.column("doc_id"), *numbers, pa.array(digest, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                                  names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "pairs", "times"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, "
                             "groups_sha256 string, pairs binary, times binary")


def _counted(found: DataFrame, p: AlignParams) -> DataFrame:
    """``pair, n``: links of each numbered pair in the whole corpus, from
    ``found (pairs, times)``; a task sends at most one row per pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(_tokenizers(p).pairs), np.int64)
        for rows in batches:
            for k, n in zip(rows.column("pairs").to_pylist(), rows.column("times").to_pylist(), strict=True):
                total[np.frombuffer(k, "<i4")] += np.frombuffer(n, "<i4")  # a document names a pair once
        pair = np.flatnonzero(total)
        yield pa.record_batch([pa.array(pair, pa.int32()), pa.array(total[pair], pa.int64())], names=["pair", "n"])

    return found.select("pairs", "times").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, params: AlignParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``a_id, b_id, n_links, best`` per linked id pair: how many links of the
    whole corpus hold it, and whether no pair of its B id has more (ties
    included). At most one row per pair of vocabulary entries of which one ends
    with the other."""
    p = params or default_params()
    both = _tokenizers(p)
    counted = _counted(materialise(_aligned(pick(docs, doc_id=id_col, text=text_col), p), "aligned"), p)
    pairs = both.pairs
    named = docs.sparkSession.createDataFrame(pa.table({"pair": pa.array(range(len(pairs)), pa.int32()),
                                                         "a_id": pa.array(pairs // both.width, pa.int32()), "b_id": pa.array(pairs % both.width, pa.int32())}))
    n = counted.join(named, "pair").select("a_id", "b_id", F.col("n").alias("n_links"))
    top = n.groupBy("b_id").agg(F.max("n_links").alias("top"))
    return n.join(top, "b_id").select("a_id", "b_id", "n_links", (F.col("n_links") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, params: AlignParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256, n_overlaps``.

    ``n_best``: links whose pair's corpus-wide count is the highest of its B
    id, ties included; ``count_sum``: the links' counts added up; ``n_overlaps``:
    pairs of an A and a B token that share bytes. Null, empty and
    not reproducible texts have zeros and an empty digest; null ids, repeated
    rows and extra columns are harmless. The texts are encoded once; what is
    written are the documents' figures and their pairs' numbers."""
    p = params or default_params()
    d = pick(docs, doc_id=id_col, text=text_col)
    found = materialise(_aligned(d, p), "aligned")
    both = _tokenizers(p)
    counted = _counted(found, p).toArrow()  # bounded by the vocabularies, see above
    counts = np.zeros(len(both.pairs), np.int64)
    counts[counted.column("pair").to_numpy()] = counted.column("n").to_numpy()
    top = np.zeros(both.width, np.int64)
    np.maximum.at(top, both.pair_b, counts)
    known = docs.sparkSession.sparkContext.broadcast((counts, counts == top[both.pair_b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = known.value
        for rows in batches:
            linked = [(np.frombuffer(k, "<i4"), np.frombuffer(t, "<i4").astype(np.int64))
                      for k, t in zip(rows.column("pairs").to_pylist(), rows.column("times").to_pylist(), strict=True)]
            sums = [int(t @ n[k]) for k, t in linked]
            bests = [int(t[best[k]].sum()) for k, t in linked]
            yield pa.record_batch([*(rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(bests, pa.int64()),
                                   pa.array(sums, pa.int64()), rows.column("groups_sha256"), rows.column("n_overlaps")],
                                  names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                 "count_sum long, groups_sha256 string, n_overlaps long")
