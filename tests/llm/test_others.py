"""Archives, mixing, vectors, URLs, toxicity, licences and the pipeline."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from larder.llm import licenses, mixing, toxicity, urls, vectors, warc
from tests.llm import helpers as h

PAGES = "page_id long, url string, html string, sum string, Size string"
LABELS = "doc_id long, quality int, toxic int, extra string"


def _sha(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def test_warc_round_trip(spark):
    html = [None, "", "<p>é</p>", "x" * 300000, "<p>é</p>", "<p>é</p>", "\x1f\u008b\x08 WARC/1.1\r\n", "last"]
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://h/{i} ü\r\nX: y", t, "a", "b") for i, t in enumerate(html)], PAGES)
    got = {r.page_id: r for r in warc.round_trip(pages, warc.WarcParams(split_bytes=500)).collect()}
    first = {t or "": min(i for i, x in enumerate(html) if (x or "") == (t or "")) for t in html}
    for i, t in enumerate(html):
        r, lead = got[i], first[t or ""]
        assert (r.payload_bytes, r.payload_digest) == (len((t or "").encode()), _sha(t))
        assert (r.record_type, r.refers_to) == (("response", None) if lead == i else ("revisit", lead))
    assert len(got) == len(html)
    none = warc.round_trip(pages, warc.WarcParams(min_payload=1 << 20)).collect()
    assert {r.record_type for r in none} == {"response"} and warc.round_trip(pages.filter("false")).count() == 0


def test_byte_ranges_own_each_record_once(tmp_path):
    rnd = random.Random(2)
    p = warc.WarcParams()
    # Magic bytes inside payloads, and a payload that is itself a gzip member of something else.
    payloads = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(900))) + warc.MAGIC * 3 + zlib.compress(b"x" * 50, 0, wbits=31)
                for _ in range(40)]
    data = b"".join(warc._record(i, "http://x", x, None, p) for i, x in enumerate(payloads))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data + b"\x1f\x8b\x08cut off")
    for step in (1, 97, 1000, len(data) + 99):
        got = [warc.parse(r) for s in range(0, len(data) + 20, step) for r in warc.range_records(str(path), s, s + step)] if step > 1 else None
        if got is not None:
            assert [g["payload"] for g in got] == payloads


def _mixed(spark):
    rnd = random.Random(4)
    rows = [(i, h.words(rnd, 20 + i % 60, "ab"[i % 4 == 0]), "ab"[i % 4 == 0]) for i in range(240)]
    rows += [(1000, None, "a"), (1001, "", None), (None, "b1 b2 b3", "b"), (1000, None, "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS rate", "2 AS Copies")


def test_mixing_meets_targets(spark):
    docs, labels = _mixed(spark), spark.range(120).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    p = mixing.MixParams(targets={"a": 0.5, "b": 0.5})
    rows = mixing.mixing_rates(docs, labels, p).collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 and abs(sum(r.posterior.values()) - 1) < 1e-6 for r in rows)
    total = sum(r.n_tokens for r in rows)
    for d in "ab":
        assert sum(r.rate * r.n_tokens * r.posterior[d] for r in rows) == pytest.approx(total / 2, rel=2e-3)
    assert all(abs(r.copies - r.rate) < 1 for r in rows)
    kept = mixing.mix(docs, labels, mixing.MixParams(targets={"a": 0.5, "b": 0.5}, min_rate=1.0))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows}


def test_mixing_equals_plain_projected_gradient(spark):
    rnd = np.random.default_rng(0)
    post, tokens = rnd.dirichlet((0.4, 0.4, 0.4), 80), rnd.integers(0, 90, 80)
    scored = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, post, strict=True)],
                                   "mix_tokens long, mix_posterior array<double>")
    p = mixing.MixParams(targets={"x": 0.7, "y": 0.2, "z": 0.1}, max_rounds=7, tolerance=0.0)
    steps, report = mixing.fit_rates(scored, ["x", "y", "z"], p)
    a = (tokens[:, None] * post).T
    wanted, r = tokens.sum() * np.array([0.7, 0.2, 0.1]), np.ones(80)
    for _ in range(7):
        r = np.maximum(0, r - post @ ((a @ r - wanted) / a.sum(1)))
    assert len(steps) == 7 and np.allclose(report["expected"], a @ r, rtol=1e-6)


def test_mixing_knows_rare_domains(spark):
    rows = [(i, f"a{i % 7} a{i % 5} a1", "a") for i in range(400)] + [(1000 + i, "r1 r2 r3", "rare") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = mixing.MixParams(targets={"a": 0.9, "rare": 0.1}, train_rows=8)
    got = mixing.mixing_rates(docs, docs, p).collect()
    assert all(set(r.posterior) == {"a", "rare"} for r in got)
    assert sum(r.rate * r.n_tokens * r.posterior["rare"] for r in got) == pytest.approx(1209 * 0.1, rel=1e-2)
    with pytest.raises(ValueError, match="none"):
        mixing.mixing_rates(docs, docs, mixing.MixParams(targets={"a": 0.5, "none": 0.5}))
    with pytest.raises(RuntimeError, match="not met"):
        mixing.mixing_rates(docs, docs, mixing.MixParams(targets={"a": 0.1, "rare": 0.9}, total=100.0, min_rate=1.0))
    assert [mixing._quota(c, 10) for c in ([3, 100], [2, 3, 4], [50, 50])] == [7, 4, 5]


def test_mixing_without_labels_or_rows(spark):
    docs, none = _mixed(spark), spark.createDataFrame([], LABELS)
    assert {r.rate for r in mixing.mixing_rates(docs, none).collect()} == {1.0}
    assert mixing.mixing_rates(docs.filter("false"), none).count() == 0


def test_vectors_equal_brute_force(spark):
    rnd = np.random.default_rng(1)
    base = rnd.standard_normal((120, 16))
    dense = base[:1] + 0.02 * rnd.standard_normal((60, 16))
    pairs = base[1:31] + 0.1 * rnd.standard_normal((30, 16))
    rows = [*base.tolist(), *dense.tolist(), *pairs.tolist(), base[5].tolist(), (2 * base[5]).tolist(), (-base[5]).tolist()]
    ok = np.array(rows)
    unit = ok / np.linalg.norm(ok, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.9
    np.fill_diagonal(hit, False)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0]]
    n = len(rows)
    df = spark.createDataFrame([(i, v, "k") for i, v in enumerate([*rows, *odd])], "vec_id long, embedding array<double>, key string")
    p = vectors.DescentParams(block=32)
    got = {r.vec_id: r for r in vectors.similar_vectors(df, p).collect()}
    want = h.groups(list(range(n)), lambda a, b: hit[a, b])
    assert len(got) == n + len(odd)
    assert [got[i].n_links for i in range(n)] == hit.sum(1).tolist()
    assert [got[i].component_id for i in range(n)] == [want[i] for i in range(n)]
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert all(got[n + k].n_links == 0 and got[n + k].component_id == n + k for k in range(len(odd)))
    assert vectors.similar_vectors(df.filter("false")).count() == 0


def test_vectors_of_dense_groups_link_across(spark):
    rnd = np.random.default_rng(3)
    axes = np.linalg.qr(rnd.standard_normal((16, 16)))[0]
    at = lambda cos: cos * axes[0] + np.sqrt(1 - cos * cos) * axes[1]
    centres = [axes[0], at(0.92), -axes[0], axes[2]]
    ok = np.concatenate([c + 0.001 * rnd.standard_normal((80, 16)) for c in centres])
    unit = ok / np.linalg.norm(ok, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.9
    np.fill_diagonal(hit, False)
    df = spark.createDataFrame(list(enumerate(ok.tolist())), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vectors.similar_vectors(df, vectors.DescentParams(block=32)).collect()}
    assert hit.sum() == 160 * 159 + 2 * 80 * 79 and [got[i].n_links for i in range(320)] == hit.sum(1).tolist()
    assert [got[i].component_id for i in range(320)] == [0] * 160 + [160] * 80 + [240] * 80


def test_vectors_raise_when_the_last_pass_is_short(spark, monkeypatch):
    monkeypatch.setattr(vectors, "_audit", lambda *_: 0.5)
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(20)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall"):
        vectors.similar_vectors(df, vectors.DescentParams(attempts=1))


def test_urls(spark):
    listed = ["http://a.net/x", "HTTP://WWW.Example.NET/en/1?q", "https://example.net", "ftp://é.Example.com/de/", "x://org/fr/#z",
              "no scheme", None, "", "http://", "http://a.com:80/p?x://y", "a://b://c/d"]
    spam = [f"http://win.spam{k}.com/casino/{k}.html?bonus=1" for k in range(40)]
    good = [f"http://site{k}.com/news/{k}.html?id=1" for k in range(60)]
    rows = [*listed, *spam, *good, "http://win.other.com/casino/9.html?bonus=1", None]
    ids = [*range(len(rows) - 1), None]
    pages = spark.createDataFrame([(i, u, "r", "t") for i, u in zip(ids, rows, strict=True)], "page_id long, url string, rule string, tokens string")
    labels = spark.createDataFrame([(11 + k, int(k >= 40), 0, "x") for k in range(100)] + [(None, 0, 1, "x")], LABELS)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, labels).collect()}
    assert got[0] == ("a.net", "/x", "net/", "block") and got[1] == ("www.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("example.net", "", None, "allow") and got[3] == ("é.example.com", "/de/", "example.com/de/", "block")
    assert got[4] == ("org", "/fr/", "org/fr/", "allow") and got[5] == got[6] == got[7] == got[8] == ("", "", None, "allow")
    assert got[9][:2] == ("a.com:80", "/p") and got[10][:2] == ("b:", "//c/d") and got[None][3] == "allow"
    assert all(got[11 + k][3] == "block" for k in range(40)) and all(got[51 + k][3] == "allow" for k in range(60))
    assert got[111] == ("win.other.com", "/casino/9.html", None, "block")
    none = urls.judge_urls(pages.filter("page_id = 111"), labels.filter("false")).collect()
    assert [r.verdict for r in none] == ["allow"] and urls.judge_urls(pages.filter("false"), labels).count() == 0


def test_urls_block_by_any_part(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(8))
    deep = "/".join(f"part{chr(97 + k)}" for k in range(24))
    bad = [f"http://{word()}.org/en/casino/{k}?a=1&b=2&c=3" for k in range(30)]
    bad += [f"http://{word()}.org/en/{k}?a=1&b=2&spam=3" for k in range(30)] + [f"http://bad.a.b.c.{word()}.org/en/{k}" for k in range(30)]
    bad += [f"http://{word()}.org/en/{k}?a=buy" for k in range(30)] + [f"http://{word()}.org/{deep}/{k}?z=1" for k in range(30)]
    good = [f"http://{word()}.org/en/{k}?a=1&b=2&c=3" for k in range(80)] + [f"http://{word()}.org/{deep}/{k}" for k in range(20)]
    new = ["http://new.org/x/casino/", "http://new.org/en/1?x=1&y=2&spam=9", "http://bad.a.b.c.new.org/", "http://new.org/en/2?a=buy",
           f"http://new.org/{deep}/7?z=2", "http://new.org/en/7?a=1&b=2&c=3", f"http://new.org/{deep}/7"]
    pages = spark.createDataFrame(list(enumerate([*bad, *good, *new])), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 150), 0, "x") for i in range(250)], LABELS)
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages, labels, urls.UrlParams(rules=())).collect()}
    assert [got[250 + i] for i in range(7)] == ["block"] * 5 + ["allow"] * 2


def test_toxicity_on_held_out_documents(spark):
    rnd = random.Random(6)
    bad = ["grobian", "schuft", "unhold", "flegel"]
    texts = [h.words(rnd, 60) + (f" {rnd.choice(bad)}, {rnd.choice(bad)}." if i % 3 == 0 else "") for i in range(300)]
    rows = [*texts, None, "", texts[0]]
    docs = h.frame(spark, rows, [*range(300), None, 301, 0])
    labels = spark.createDataFrame([(i, int(i % 7 > 0), int(i % 3 == 0), "x") for i in range(200)], LABELS)
    got = toxicity.toxicity(docs, labels, toxicity.ChainParams(iterations=10)).collect()
    assert len(got) == 303 and all(0 <= r.prob_junk <= 1 and 0 <= r.prob_toxic <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and 200 <= r.doc_id < 300]
    assert sum(r.is_toxic == (r.doc_id % 3 == 0) for r in held) >= 97
    assert not next(r for r in got if r.doc_id == 301).is_toxic
    kept = toxicity.drop_toxic(docs, labels, toxicity.ChainParams(iterations=10))
    assert kept.columns == docs.columns and 180 < kept.count() < 215


def test_toxicity_probabilities_do_not_depend_on_the_bound(spark):
    rnd = random.Random(9)
    texts = [h.words(rnd, 5) + (" hint" if i % 10 == 0 or i % 4 == 1 else "") for i in range(1000)]
    docs = h.frame(spark, [*texts, "hint"])
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 0), "x") for i in range(1000)], LABELS)
    full, cut = ({r.doc_id: r.prob_toxic for r in toxicity.toxicity(docs, labels, toxicity.ChainParams(train_rows=n)).collect()}
                 for n in (1000, 100))
    for got in (full, cut):  # 100 of 350 documents with the word are toxic
        assert got[1000] == pytest.approx(100 / 350, abs=0.1)
        assert sum(got[i] for i in range(1000)) == pytest.approx(100, abs=25)


def test_toxicity_without_labels_or_rows(spark):
    docs, none = h.frame(spark, ["a b", None]), spark.createDataFrame([], LABELS)
    assert [(r.prob_toxic, r.is_toxic) for r in toxicity.toxicity(docs, none).collect()] == [(0.0, False)] * 2
    assert toxicity.toxicity(docs.filter("false"), none).count() == 0


def test_licences(spark):
    rnd = random.Random(8)
    plain = [h.words(rnd, 80) + "\n" + h.words(rnd, 40) for _ in range(60)]
    texts = [*plain, "text\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.\nSome code is provided under the GNU GPL v3.",
             "Distributed under the terms of the Apache License, Version 2.0.", "Her driver's license expired in 2004.", None, "", "\n \n",
             plain[0]]
    out = licenses.scan_licenses(h.frame(spark, texts, [*range(len(texts) - 1), None])).collect()
    got = {r.doc_id: r for r in out}
    assert got[60].families == "MIT" and got[60].spans == "MIT:5:36" and got[60].n_paragraphs == 2
    assert got[61].families == "CC-BY-NC,GPL-3.0" and got[62].license == "Apache-2.0"
    assert all(got[i].n_licenses == 0 and got[i].license is None for i in [*range(60), 63, 64, 65, 66, None])
    assert (got[64].n_paragraphs, got[66].n_paragraphs) == (0, 0)
    assert licenses.scan_licenses(h.frame(spark, [])).count() == 0


def test_licence_sentence_in_a_long_line(spark):
    rnd = random.Random(12)
    plain = [f"{h.words(rnd, 60)}. Then {h.words(rnd, 60)}." for _ in range(60)]
    text = f"{plain[0]} Released under the MIT License. And {h.words(rnd, 200)}."
    got = {r.doc_id: r for r in licenses.scan_licenses(h.frame(spark, [*plain, text])).collect()}
    assert got[60].families == "MIT" and got[60].spans == f"MIT:0:{len(text)}" and all(got[i].n_licenses == 0 for i in range(60))


def test_pipeline_runs_its_stages(spark):
    from tests.conftest import SF_SMOKE
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "personal data", "source mixing", "BPE encoding"]
    out = corpus_pipeline.run(spark, SF_SMOKE)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 50
