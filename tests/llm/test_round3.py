"""Byte-level BPE, alignment of tokenizers and whitening against plain versions."""

import base64
import collections
import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from larder.llm import alignment, byte_bpe, whitening
from tests.llm import helpers as h

SOUP = "aAbé ü ß中文 '\"1299.,;\n\t 　\x0b\x1c\x85  🙂́ſ"


def odd(seed=3):
    rnd = random.Random(seed)
    soup = ["".join(rnd.choice(SOUP) for _ in range(rnd.randrange(80))) for _ in range(150)]
    return [*h.odd_texts(), "a" * 3000, " " * 700 + "x", "ab" * 999 + "1" * 500, "Don't <|endoftext|> <s> now",
            "\x00\x01 \U0010ffff", "Ελληνικά текст 日本語 العربية हिन्दी 한국어", *soup]


def test_segment_tree_equals_the_library():
    p = byte_bpe.default_params()
    ranks = byte_bpe.load_ranks(p.ranks)
    lib = tiktoken.Encoding("lib", pat_str=p.pattern, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    pieces = [bytes(rnd.choice(b"aaabcdet \xc3\xa9") for _ in range(rnd.randrange(1, 40))) for _ in range(3000)]
    pieces += [b"a" * n for n in range(1, 130)] + [bytes([k]) for k in range(256)] + [b"the " * 500]
    for piece in pieces:
        assert byte_bpe.encode_piece(piece, ranks) == lib._encode_single_piece(piece), piece
    table = byte_bpe.PairTable(ranks)
    for size in (2, 4, 8, 64):
        some = [x for x in pieces if len(x) <= size and x not in ranks]
        got = byte_bpe.encode_pieces(some, table, size)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [lib._encode_single_piece(x) for x in some]


def test_byte_bpe_equals_the_library(spark):
    p = byte_bpe.default_params()
    lib = tiktoken.Encoding("lib", pat_str=p.pattern, mergeable_ranks=byte_bpe.load_ranks(p.ranks), special_tokens={})
    texts = odd()
    ids = [None, *range(1, len(texts) - 1), 1]
    docs = h.frame(spark, texts, ids)
    want, plain = collections.Counter(), collections.Counter()
    for i, t in zip(ids, texts, strict=True):
        e = lib.encode_ordinary(t or "")
        want[i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
        plain[i, tuple(e), t or ""] += 1
    small = byte_bpe.ByteBpeParams(p.ranks, p.pattern, kept_pieces=50, part_chars=100)
    for params in (None, small):
        assert collections.Counter(tuple(r) for r in byte_bpe.digests(docs, params).collect()) == want
    encoded = byte_bpe.encode(docs, small)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == collections.Counter({k[:2]: v for k, v in plain.items()})
    assert collections.Counter((r.doc_id, r.text) for r in byte_bpe.decode(encoded).collect()) == collections.Counter(
        (i, t or "") for i, t in zip(ids, texts, strict=True))


def test_decode_of_odd_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, 0])], "doc_id long, ids array<int>")
    assert [len(r.data) for r in byte_bpe.decode(rows).orderBy("doc_id").collect()] == [0, 0, 1]
    with pytest.raises(Exception, match="outside"):
        byte_bpe.decode(spark.createDataFrame([(1, [10 ** 6])], "doc_id long, ids array<int>")).collect()


def _plain_sides(texts):
    p = alignment.default_params()
    a = Tokenizer.from_file(p.a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=p.b)
    pattern = tiktoken.Encoding("x", pat_str=".", mergeable_ranks={bytes([k]): k for k in range(256)}, special_tokens={})
    assert pattern  # ids below come from the tokenizers library and sentencepiece alone
    rank_file = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(rank_file, "rb") as f:
        of = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f)}
    out = []
    for t in texts:
        if not t:
            out.append(None)
            continue
        x = a.encode(" " + t, add_special_tokens=False).ids
        y = b.encode(t)
        xb = [of[i] for i in x]
        yb = [bytes([int(s[3:5], 16)]) if b.is_byte(i) else s.replace("▁", " ").encode() for i, s in ((i, b.id_to_piece(i)) for i in y)]
        data = (" " + t).encode()
        out.append((x, y, xb, yb) if b"".join(xb) == data == b"".join(yb) else None)
    return out


def _brute(texts):
    sides, docs = _plain_sides(texts), []
    count = collections.Counter()
    for side in sides:
        if side is None:
            docs.append(None)
            continue
        x, y, xb, yb = side
        ends = lambda parts: [sum(map(len, parts[:k + 1])) for k in range(len(parts))] if len(parts) < 400 else np.cumsum([len(v) for v in parts]).tolist()
        xe, ye = ends(xb), ends(yb)
        at = {e: j for j, e in enumerate(ye)}
        links = [(i, at[e]) for i, e in enumerate(xe) if e in at]
        count.update((x[i], y[j]) for i, j in links)
        groups, pi, pj = [], 0, 0
        for i, j in links:
            groups.append(",".join(map(str, x[pi:i + 1])) + "|" + ",".join(map(str, y[pj:j + 1])))
            pi, pj = i + 1, j + 1
        docs.append((x, y, links, ";".join(groups), xe, ye))
    top = collections.Counter()
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return docs, count, top


def test_alignment_equals_brute_force(spark):
    texts = [*odd(), "a▁b", "plain words here", "plain words here again"]
    docs, count, top = _brute(texts)
    frame = h.frame(spark, texts)
    got = {r.doc_id: r for r in alignment.alignment(frame).collect()}
    assert sum(d is None for d in docs) >= 4 and sum(d is not None for d in docs) > 100
    for i, d in enumerate(docs):
        r = got[i]
        if d is None:
            assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", 0)
            continue
        x, y, links, groups, xe, ye = d
        counts = [count[x[a], y[b]] for a, b in links]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.count_sum) == (len(x), len(y), len(links), len(links), sum(counts))
        assert r.n_best == sum(count[x[a], y[b]] == top[y[b]] for a, b in links)
        assert r.groups_sha256 == hashlib.sha256(groups.encode()).hexdigest()
        if len(x) < 400:
            starts = lambda e: [0, *e[:-1]]
            assert r.n_overlaps == sum(max(s, u) < min(e, v) for s, e in zip(starts(xe), xe, strict=True) for u, v in zip(starts(ye), ye, strict=True))
    pairs = {(r.a_id, r.b_id): (r.n_links, r.best) for r in alignment.pair_counts(frame).collect()}
    assert pairs == {k: (n, n == top[k[1]]) for k, n in count.items()}


def test_alignment_itself(spark):
    texts = ["plain words, here", None, "x" * 50]
    rows = alignment.align(h.frame(spark, texts)).orderBy("doc_id").collect()
    docs, _, _ = _brute(texts)
    assert rows[1].a_ids == [] and rows[1].driver is None and rows[1].groups == []
    for r, d in ((rows[0], docs[0]), (rows[2], docs[2])):
        x, y, links, _, xe, ye = d
        assert (r.a_ids, r.b_ids, [tuple(g) for g in r.groups]) == (x, y, links)
        mine, other = (ye, xe) if r.driver == "b" else (xe, ye)
        assert (len(ye) < len(xe)) == (r.driver == "b")
        for k, o in enumerate(r.overlaps):
            s, e = (mine[k - 1] if k else 0), mine[k]
            hit = [j for j, v in enumerate(other) if max(s, other[j - 1] if j else 0) < min(e, v)]
            assert [o.first, o.last] == [hit[0], hit[-1]]


def test_alignment_of_other_vocabularies(tmp_path):
    """A vocabulary whose ids don't follow its merges goes to its own library."""
    import json
    p = alignment.default_params()
    with open(p.a, encoding="utf-8") as f:
        file = json.load(f)
    x, y = (k for k, v in file["model"]["vocab"].items() if v in (300, 40000))
    file["model"]["vocab"][x], file["model"]["vocab"][y] = file["model"]["vocab"][y], file["model"]["vocab"][x]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(file), encoding="utf-8")
    other, own = alignment.Tokenizers(alignment.AlignParams(str(path), p.b, p.pattern)), alignment.Tokenizers(p)
    text = "the other side of the river, 1999"
    assert [other.a_bytes[i] for i in other.a_ids(text)] == [own.a_bytes[i] for i in own.a_ids(text)]
    assert (other.align(text).group_a == own.align(text).group_a).all()


@pytest.mark.parametrize("text", [" " * 300_000 + "x", "a b\n\n" + "\t \n" * 100_000, "a" * 200_000, "ab1 " * 50_000])
def test_very_long_runs(text):
    """Runs that a library's pattern fails on; whole texts of one piece."""
    p = alignment.default_params()
    a = Tokenizer.from_file(p.a)
    x = alignment.Tokenizers(p).align(text)
    assert x.a.tolist() == a.encode(" " + text, add_special_tokens=False).ids and x.group_a[-1] == len(x.a) - 1
    pieces = byte_bpe._Pieces(byte_bpe.default_params())
    ids = np.frombuffer(b"".join(next(iter(pieces.encode([text])))), "<u4")
    assert pieces.decode(ids.tolist()) == text.encode()


def test_galloping_ranks():
    rnd = random.Random(2)
    for _ in range(300):
        short = sorted(rnd.sample(range(2000), rnd.randrange(30)))
        long = sorted(rnd.sample(range(2000), rnd.randrange(600)))
        got = alignment.gallop(np.array(short, np.int64), np.array(long, np.int64))
        assert got.tolist() == [sum(v < x for v in long) for x in short]


def _vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, n string, V string")


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_whitening_equals_exact_fractions(spark, scale):
    rnd = np.random.default_rng(4)
    data = (rnd.normal(size=(300, 10)) @ rnd.normal(size=(10, 10)) * scale).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    bad = [(900, None), (901, [None] + [0.0] * 9), (902, [math.nan] + [0.0] * 9), (903, [math.inf] + [0.0] * 9), (904, []), (905, [1.0])]
    got = whitening.whiten(_vectors(spark, rows + bad + [(None, rows[0][1]), rows[1]])).collect()
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows] + [[math.floor(1024 * c) + 100_000 for c in rows[k][1]] for k in (0, 1)], object)
    n, s = len(x), x.sum(axis=0)
    centred = x * n - s
    cov = np.array([[float(Fraction(int((centred[:, i] * centred[:, j]).sum()), n ** 3)) for j in range(10)] for i in range(10)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * 8 and {r.component for r in got} == set(range(1, 9)) and {r.n for r in got} == {n}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    whole = sorted(((r.vec_id if r.vec_id is not None else -1), r.component, int(r.deviation)) for r in got)
    ids = [*range(len(rows)), -1, 1]
    assert whole == sorted((i, k, int((c * c).sum())) for i, c in zip(ids, centred, strict=True) for k in range(1, 9))
    by = {(r.vec_id, r.component): r for r in got}
    for k in range(8):
        want = ((centred / n).astype(float) @ vectors[:, k]) / math.sqrt(values[k])
        sign = np.sign(want[5] * by[5, k + 1].whitened)
        assert np.allclose([by[i, k + 1].whitened for i in range(300)], sign * want[:300], rtol=1e-7, atol=1e-9)
        assert math.isclose(by[0, k + 1].explained, values[k] / values.sum(), rel_tol=1e-9)


def test_whitening_without_variance(spark):
    assert whitening.whiten(_vectors(spark, [])).collect() == [] and whitening.whiten(_vectors(spark, [(1, None)])).collect() == []
    one = whitening.whiten(_vectors(spark, [(1, [0.5, 0.25])], "double")).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    line = whitening.whiten(_vectors(spark, [(i, [float(i), 2.0 * i]) for i in range(5)], "double")).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and line[0].identity_error < 1e-9


def test_polarisation_holds_large_entries(spark):
    got = whitening.whiten(_vectors(spark, [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [5.0, 7.0])], "double")).collect()
    assert {r.n for r in got} == {3} and got[0].identity_error < 1e-6


@pytest.mark.parametrize("run", [byte_bpe.encode, byte_bpe.digests, alignment.alignment, alignment.align, alignment.pair_counts])
def test_empty_tables(spark, run):
    assert run(h.frame(spark, [])).collect() == []
