"""BPE encoding and decoding by a distinct-word table.

A word is a run of characters without ASCII white space; the tokenizer encodes
every such run by itself, so a text's ids are its words' ids in order. Texts
are grouped into blocks of a few MB. Each block sends its distinct words, dealt
out by the word's hash, to the task that owns the word; there every distinct
word of the corpus is encoded once. The ids go back to the blocks, which join
them by position. Decoding looks every id up in the table of pieces.

Shuffled are the distinct words of each block (twice, compressed) and the block
texts (once, compressed), never one row per word of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import pick


@dataclass(frozen=True)
class BpeParams:
    """``tokenizer``: path of a tokenizers JSON file, which every executor can
    read; ``block_bytes``: text per block (one longer text is a block of its
    own); ``buckets``: parts of the word table, by default the session's
    shuffle partitions. A part holds its share of the distinct words in memory."""
    tokenizer: str
    block_bytes: int = 8 << 20
    buckets: int | None = None


def default_params() -> BpeParams:
    import public_tokenizers
    return BpeParams(public_tokenizers.path("word_bpe_49k.json"))


_TOKENIZERS: dict = {}


def _tokenizer(path: str):
    """The tokenizer and the list of its pieces, once per Python worker."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        pieces: list = [""] * (max(t.get_vocab(with_added_tokens=True).values(), default=-1) + 1)
        for piece, i in t.get_vocab(with_added_tokens=True).items():
            pieces[i] = piece
        _TOKENIZERS[path] = (t, pieces)
    return _TOKENIZERS[path]


def encode_words(path: str, words: list, chunk: int = 2000) -> list:
    """Little-endian 32-bit ids of each word, as bytes. Words go to the
    tokenizer many at a time, a line each; offsets tell them apart again."""
    t, _ = _tokenizer(path)
    out = []
    for i in range(0, len(words), chunk):
        part = words[i:i + chunk]
        e = t.encode("\n".join(part), add_special_tokens=False)
        ids = np.asarray(e.ids, "<u4")
        ends = np.cumsum([len(w) + 1 for w in part])
        starts = np.fromiter((x for x, _ in e.offsets), np.int64, len(ids))
        cut = np.searchsorted(np.searchsorted(ends, starts, "right"), np.arange(len(part) + 1))
        out += [ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return out


def _zip(data: bytes) -> bytes:
    import zstandard
    return zstandard.compress(data, 6)


def _unzip(data: bytes) -> bytes:
    import zstandard
    return zstandard.decompress(data)


def _pack_rows(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_batch(rows)
    return _zip(sink.getvalue().to_pybytes())


def _unpack_rows(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(_unzip(data)).read_all().combine_chunks().to_batches()[0]


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers, all first bytes before all second bytes and so on."""
    return values.astype("<u4").view(np.uint8).reshape(len(values), 4).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, len(data) // 4).T).view("<u4").ravel()


def _pack_ids(ids: list) -> bytes:
    """The lists of ids of some words, given as bytes: their lengths, then all ids."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    lengths = np.array([len(x) // 4 for x in ids], "<u4")
    return _zip(len(ids).to_bytes(8, "little") + _planes(lengths) + _planes(flat))


def _unpack_ids(data: bytes) -> list:
    data = _unzip(data)
    n = int.from_bytes(data[:8], "little")
    ends = np.cumsum(_numbers(data[8:8 + 4 * n]), dtype=np.int64) * 4
    flat = _numbers(data[8 + 4 * n:]).tobytes()
    return [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def _texts(column) -> list:
    return [t.encode("utf-8", "replace") if t else b"" for t in column.to_pylist()]


def _blocks(batches, limit: int):
    """(key, record batch) per block of about ``limit`` text bytes. The key is
    a hash of the block's rows: a second reading that cuts the same blocks gets
    the same keys."""
    import xxhash

    def block(parts):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        h = xxhash.xxh3_128()
        for t in _texts(rows.column("text")):
            h.update(t + b"\0")
        return h.digest(), rows

    held, size = [], 0
    for batch in batches:
        lengths = [len(t) if t else 0 for t in batch.column("text").to_pylist()]
        start = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield block(held)
                held, size, start = [], 0, i
            size += n
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield block(held)


def _dealt(rows: pa.RecordBatch, buckets: int) -> dict:
    """The distinct words of a block by bucket, in order."""
    import xxhash
    dealt: dict = {}
    distinct: set = set()
    for t in _texts(rows.column("text")):  # one text's words at a time
        distinct.update(t.split())
    for w in sorted(distinct):
        dealt.setdefault(xxhash.xxh3_64_intdigest(w) % buckets, []).append(w)
    return dealt


def encode_blocks(docs: DataFrame, p: BpeParams, finish, schema: str) -> DataFrame:
    """Blocks of ``docs (doc_id, text)`` with their word tables joined back;
    ``finish(batch, encode)`` turns each block into an output batch, where
    ``encode`` maps a word (bytes) to its ids (bytes)."""
    spark = docs.sparkSession
    buckets = p.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _blocks(batches, p.block_bytes):
            dealt = _dealt(rows, buckets)
            yield pa.record_batch([pa.array(list(dealt), pa.int32()), pa.array([key] * len(dealt), pa.binary()),
                                   pa.array([_zip(b"\n".join(x)) for x in dealt.values()], pa.binary())],
                                  names=["bucket", "block", "words"])

    def encode(table: pa.Table) -> pa.Table:
        lists = [_unzip(x).split(b"\n") for x in table.column("words").to_pylist()]
        distinct = sorted(set().union(*lists))
        ids = dict(zip(distinct, encode_words(p.tokenizer, [w.decode() for w in distinct]), strict=True))
        packed = [_pack_ids([ids[w] for w in x]) for x in lists]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "ids": pa.array(packed, pa.binary())})

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _blocks(batches, p.block_bytes):
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([_pack_rows(rows)], pa.binary())], names=["block", "data"])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = [_unpack_rows(x) for x in left.column("data").to_pylist()]  # several: equal blocks
        words = _dealt(blocks[0], buckets)
        known: dict = {}
        for bucket, x in zip(right.column("bucket").to_pylist(), right.column("ids").to_pylist(), strict=True):
            known.update(zip(words[bucket], _unpack_ids(x), strict=True))

        class Encoded(dict):  # a block that was cut otherwise when it was read again: its words are encoded here
            def __missing__(self, word):
                self[word] = encode_words(p.tokenizer, [word.decode()])[0]
                return self[word]

        ids = Encoded(known)
        return pa.concat_tables(pa.Table.from_batches([finish(x, ids.__getitem__)]) for x in blocks)

    d = docs.select("doc_id", "text")
    dealt = d.mapInArrow(words, "bucket int, block binary, words binary")
    table = dealt.groupBy("bucket").applyInArrow(encode, "block binary, bucket int, ids binary")
    data = d.mapInArrow(texts, "block binary, data binary")
    return data.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(join, schema)


def encode(docs: DataFrame, params: BpeParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) per document: the whole text's ids,
    without special tokens added. A null or empty text has no ids; repeated
    rows and null ids stay rows of their own."""
    p = params or default_params()
    d = pick(docs, doc_id=id_col, text=text_col)

    def finish(rows: pa.RecordBatch, ids) -> pa.RecordBatch:
        flat = [np.frombuffer(b"".join(map(ids, t.split())), "<u4") for t in _texts(rows.column("text"))]
        return pa.record_batch([rows.column("doc_id"), pa.array([x.astype("i4") for x in flat], pa.list_(pa.int32()))],
                               names=["doc_id", "ids"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return encode_blocks(d, p, finish, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, params: BpeParams | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the pieces of the ids joined with spaces, special
    pieces included. Null or no ids decode to the empty text; ids that the
    vocabulary does not have, negative ones too, are left out as the library
    leaves them out. The table of pieces is the tokenizer's vocabulary, whose
    size is fixed."""
    p = params or default_params()
    d = pick(encoded, doc_id=id_col, ids=ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _tokenizer(p.tokenizer)[1]
        for b in batches:
            text = [" ".join([pieces[i] for i in x if i is not None and 0 <= i < len(pieces)]) if x else "" for x in b.column("ids").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, params: BpeParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document, encoded
    and decoded block by block without keeping the ids."""
    p = params or default_params()
    d = pick(docs, doc_id=id_col, text=text_col)

    def finish(rows: pa.RecordBatch, ids) -> pa.RecordBatch:
        pieces = [x.encode() for x in _tokenizer(p.tokenizer)[1]]
        decoded: dict = {}
        n, a, b = [], [], []
        for t in _texts(rows.column("text")):
            words = t.split()
            found = [ids(w) for w in words]
            data = b"".join(found)
            for i in set(found):
                if i not in decoded:  # each distinct word of the block is decoded once
                    decoded[i] = b" ".join([pieces[k] for k in np.frombuffer(i, "<u4")])
            n.append(len(data) // 4)
            a.append(hashlib.sha256(data).hexdigest())
            b.append(hashlib.sha256(b" ".join([decoded[i] for i in found if i])).hexdigest())
        return pa.record_batch([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                               names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return encode_blocks(d, p, finish, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
