"""Rules, encoding, personal data and near-duplicates against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

from larder.llm import bpe, minhash, pii, quality
from tests.llm import helpers as h


def test_bands_base_figures_and_verdicts(spark):
    rnd = random.Random(1)
    noise = "".join(chr(rnd.randrange(33, 126)) for _ in range(4000))
    texts = [*h.odd_texts(), "spam egg " * 400, " ".join(noise[i:i + 9] for i in range(0, 4000, 9)),
             "x y z\nx y z\n\nx y z \nq # $", h.words(rnd, 400)]
    got = {r.doc_id: r for r in quality.compression_bands(h.frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = h.WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if h.WORD.search(x)]
        windows = list(zip(w, w[1:], w[2:], strict=False))
        count = collections.Counter(windows)
        covered = {k + j for k, x in enumerate(windows) if count[x] > 1 for j in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert got[len(texts) - 1].kept and got[5].kept and not got[11].kept and not got[0].kept
    assert not got[12].kept and not got[12].base_failed  # incompressible


def test_keep_good_keeps_columns(spark):
    docs = h.frame(spark, h.odd_texts())
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [4, 5, 6, 7, 8]


def test_encoding_equals_the_tokenizer(spark):
    t = Tokenizer.from_file(bpe.default_params().tokenizer)
    texts = [*h.odd_texts(), "Don't stop<|endoftext|>now ①½ É\u0301 \u3000가각 \u1100\u1161x\x0bY", "ΣΑΣ İstanbul\u00a0ǅ"]
    ids = [None, *range(1, len(texts) - 1), 1]
    params = bpe.BpeParams(bpe.default_params().tokenizer, block_bytes=2000, buckets=3)
    docs = h.frame(spark, texts, ids)
    want = collections.Counter()
    for i, x in zip(ids, texts, strict=True):
        e = t.encode(x or "", add_special_tokens=False).ids
        d = t.decode(e, skip_special_tokens=False)
        want[i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(d.encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in bpe.digests(docs, params).collect()) == want
    encoded = bpe.encode(docs.filter("doc_id > 3"), params)
    got = {r.doc_id: r.text for r in bpe.decode(encoded, params).collect() if r.doc_id == 8}
    assert got[8] == t.decode(t.encode(texts[8], add_special_tokens=False).ids, skip_special_tokens=False)


def test_lists_of_ids_survive_packing():
    ids = [np.array(x, "<u4").tobytes() for x in ([], [1], [70000, 2, 3], [], [5])]
    assert bpe._unpack_ids(bpe._pack_ids(ids)) == ids and bpe._unpack_ids(bpe._pack_ids([])) == []


KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _valid(kind, m):
    g = re.sub("[^0-9]", "", m)
    if kind == "card":
        total = sum((2 * int(c) - 9 * (c > "4") if i % 2 else int(c)) for i, c in enumerate(g[::-1]))
        return 13 <= len(g) <= 19 and total % 10 == 0
    return {"ip": lambda: all(int(x) <= 255 for x in m.split(".")), "phone": lambda: 9 <= len(g) <= 15}.get(kind, lambda: True)()


def test_personal_data_base_spans(spark):
    rnd = random.Random(3)
    soup = ["".join(rnd.choice("a1.@-+ ()9_é4") for _ in range(rnd.randrange(60))) for _ in range(300)]
    texts = [*h.odd_texts(), "x" * 50000, "1" * 40000, "a.b@c.d_e@f.g é 4111 1111 1111 1111 10.0.0.256 1.2.3.4.5 +49 (30) 123-4567 ",
             "0000.000.0.255 4111-1111-1111-1112", *soup]
    got = {r.doc_id: r for r in pii.find_pii(h.frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        spans, n = [], []
        for kind, pattern in KINDS:
            own = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, t or "") if _valid(kind, m[0])] if len(t or "") < 40000 else []
            spans, n = spans + own, [*n, len(own)]
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == n
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest() and r.spans.startswith(",".join(spans))


def test_bootstrap_finds_identifiers_in_trusted_contexts(spark):
    seeds = [f"please call us at +49 30 12345{k} any time {k}" for k in range(100, 140)]
    new = ["please call us at 0305-998877 any time", "the year was 20210304 in total"]
    out = {r.doc_id: r for r in pii.find_pii(h.frame(spark, [*seeds, *new])).collect()}
    assert out[40].spans == "id:18:29" and out[41].spans == ""
    docs = h.frame(spark, [*seeds, *new, None, "plain", "mail é a.b@c.de and 1.2.3.4"])
    red = pii.redact(docs)
    got = {r.doc_id: (r.text, r.n_chars) for r in red.collect()}
    assert red.columns == docs.columns and got[42] == (None, 0) and got[43] == ("plain", 5)
    assert got[44] == ("mail é <EMAIL> and <IP>", 23) and got[40][0] == "please call us at <ID> any time"
    assert got[0][0] == "please call us at <PHONE> any time 100" or got[0][0].startswith("please call us at <PHONE>")


def test_every_base_span_is_a_mention(spark):
    texts = ["write mail to (joe@a.org) or call", "é dial us at +1 (017) 555-7713 any time", "x" * 1020 + " my new ip: 10.0.0.7 ok 12345"]
    d = pii.base_spans(h.frame(spark, texts), "text")
    got = {r.doc_id: [tuple(x) for x in r.mentions] for r in pii._mentions(d, "text", pii.BootstrapParams()).collect()}
    assert got[0] == [(15, 24, "joe@a.org", "to", "mail", "or", True, False)]
    assert got[1] == [(13, 30, "+1 (017) 555-7713", "at", "us", "any", True, False)]
    assert got[2] == [(1032, 1040, "10.0.0.7", "ip:", "new", "ok", True, False), (1044, 1049, "12345", "ok", "#.#.#.#", "", False, False)]


def test_bootstrap_trusts_contexts_that_hold_many_unseen(spark):
    known = [f"please send mail to u{chr(97 + k)}@a.org right now" for k in range(20)]
    unseen = [f"please send mail to user-{5000 + k}-x right now" for k in range(20)]
    plain = [f"they met in town on 20{k:02d}-05-17 or so" for k in range(20)]
    mixed = [f"they met in town on {k}{k}{k}.1.2.3 or so" for k in range(1, 3)]
    rare = [f"your order number is {70000 + k} in all" for k in range(60)] + [f"your order number is 10.0.0.{k} in all" for k in range(6)]
    texts = [*known, *unseen, *plain, *mixed, *rare]
    out = [r.spans for r in pii.find_pii(h.frame(spark, texts)).orderBy("doc_id").collect()]
    assert out[20:40] == ["id:20:31"] * 20 and set(out[40:60]) == {""} and set(out[62:122]) == {""}


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(9)
    texts = h.odd_texts()
    for k in range(12):
        base = h.words(rnd, rnd.choice((3, 8, 40, 150)), f"b{k}x").split()
        texts.append(" ".join(base))
        for _ in range(4):
            copy = list(base)
            for _ in range(rnd.randrange(4)):
                copy[rnd.randrange(len(copy))] = f"n{rnd.randrange(10 ** 6)}"
            texts.append(" ".join(copy))
    ids = [*range(100, 100 + len(texts))]
    rnd.shuffle(ids)
    sets = {i: h.shingles(t, 3) for i, t in zip(ids, texts, strict=True)}
    want = h.groups(ids, lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    docs = h.frame(spark, texts, ids)
    rows = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in ids}
    kept = minhash.keep_one(docs, minhash.MinMaxParams(shingle=3, percent=85))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_null_and_repeated_ids(spark):
    docs = h.frame(spark, ["a b c d", "a b c d", "a b c d", None, "e f g"], [None, 7, 7, None, None])
    rows = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in minhash.near_duplicates(docs).collect())
    assert rows == sorted([("None", "7", False), ("7", "7", True), ("7", "7", True), ("None", "None", True), ("None", "None", True)])
    assert minhash.keep_one(docs).count() == 3


@pytest.mark.parametrize("run", [quality.compression_bands, quality.keep_good, bpe.digests, pii.find_pii, pii.redact,
                                 minhash.near_duplicates, minhash.keep_one])
def test_empty_tables(spark, run):
    assert run(h.frame(spark, [])).collect() == []


def test_blocks_link_what_the_stars_leave(spark):
    """Edited copies around the threshold, far more than a block holds."""
    import random
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(60), 1 + i % 3):
            words[at] = f"e{rng.randrange(4)}"
        texts.append(" ".join(words))
    sets = [{tuple(w[k:k + 3]) for k in range(len(w) - 2)} for w in (t.split() for t in texts)]
    comp = list(range(60))
    for a in range(60):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((comp[a], comp[b]))
                comp = [low if c == high else c for c in comp]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = minhash.near_duplicates(docs, minhash.MinMaxParams(block_rows=4, block_shingles=500)).collect()
    assert len(set(comp)) > 3
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(comp))
