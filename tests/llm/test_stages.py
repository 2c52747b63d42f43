"""The pipeline stage by stage against plain versions, its odd inputs, and plans
that hold an expensive step once."""

import collections
import hashlib
import random
import re
import warnings

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from larder.llm import bpe, mixing, pii, quality
from larder.llm.common import materialise
from tests.llm import helpers as h
from tests.llm.test_texts import KINDS, _valid

LABELS = "doc_id long, quality int, toxic int, extra string"


def _corpus():
    """(texts, languages): clean prose in two invented languages, copies, junk, personal data, nulls."""
    rnd = random.Random(8)
    texts, langs = [], []

    def add(text, lang):
        texts.append(text)
        langs.append(lang)

    for k in range(40):
        stem = "ab"[k % 3 == 0]
        base = h.words(rnd, 90 + 7 * (k % 5), stem)
        add(base, stem)
        if k % 4 == 0:  # a copy, and a near copy
            add(base, stem)
            add(base.replace(" ", " new ", 1), stem)
        if k % 5 == 0:
            add(f"{h.words(rnd, 60, stem)} mail joe{k}@a.org or +49 30 12345{k:02d} from 10.0.{k}.1 {h.words(rnd, 60, stem)}", stem)
    for odd in (None, "", " \n", "too short", "spam egg ham " * 300):
        add(odd, "a")
    return texts, langs


def _docs(spark):
    texts, langs = _corpus()
    rows = [(i if i else None, t, lang, "s", len(t or ""), "x", "y") for i, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rate string, Copies string")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    _docs(spark).write.parquet(f"{path}/documents.parquet")
    spark.range(200).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic", "'z' AS extra").write.parquet(f"{path}/labels.parquet")
    return str(path)


def _redacted(text):
    """Spans cut as the stage does: leftmost first, of equal starts the longest."""
    spans = sorted((m.start(), -m.end(), kind) for kind, pattern in KINDS for m in re.finditer(pattern, text) if _valid(kind, m[0]))
    out, at = [], 0
    for s, e, kind in spans:
        if s < at:
            at = max(at, -e)
            continue
        out += [text[at:s], f"<{kind.upper()}>"]
        at = -e
    return "".join(out) + text[at:]


def test_pipeline_equals_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = {n: f for n, f in corpus_pipeline.STAGES}
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")

    compress = zstandard.ZstdCompressor(level=3).compress
    start = docs.collect()
    kept = [r for r in start if quality.text_stats(r.text, compress, quality.BandParams())[-1]]
    assert 0 < len(kept) < len(start) and all(r in kept for r in start if r.text and r.text[0] in "ab")
    got = materialise(stages["quality rules"](spark, docs, sf_dir), "test")
    assert got.columns == docs.columns and sorted(got.collect(), key=key) == sorted(kept, key=key)

    sets = {r.doc_id: h.shingles(r.text, 5) for r in kept if r.doc_id is not None}
    comp = h.groups(list(sets), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    alone = [r for r in kept if r.doc_id is None]
    linked = {i for r in alone for i, s in sets.items() if 100 * len(h.shingles(r.text, 5) & s) >= 80 * len(h.shingles(r.text, 5) | s)}
    want = {c for c in comp.values()} | (set() if linked else {None})
    got = materialise(stages["near-duplicates"](spark, got, sf_dir), "test")
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == want and got.count() == len(want) < len(kept)

    texts = {r.doc_id: r.text for r in got.collect()}
    got = materialise(stages["personal data"](spark, got, sf_dir), "test")
    red = {r.doc_id: r for r in got.collect()}
    assert got.columns == docs.columns and {i: r.text for i, r in red.items()} == {i: _redacted(t) for i, t in texts.items()}
    assert all(r.n_chars == len(r.text) for r in red.values()) and sum("<EMAIL>" in r.text for r in red.values()) == 8

    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)  # targets not met
        got = materialise(stages["source mixing"](spark, got, sf_dir), "test")
    times = collections.Counter(r.doc_id for r in got.collect())
    assert got.columns == docs.columns and set(times) == set(red) and {r.doc_id: r for r in got.collect()} == red
    tokens = {lang: sum(len(h.WORD.findall(r.text)) for r in red.values() if r.lang == lang) for lang in "ab"}
    mixed = {lang: sum(times[r.doc_id] * len(h.WORD.findall(r.text)) for r in red.values() if r.lang == lang) for lang in "ab"}
    share = {lang: tokens[lang] ** 0.7 / sum(v ** 0.7 for v in tokens.values()) for lang in "ab"}
    assert all(abs(mixed[lang] / sum(mixed.values()) - share[lang]) < 0.08 for lang in "ab")  # copies are whole documents

    t = Tokenizer.from_file(bpe.default_params().tokenizer)
    want = collections.Counter()
    for r in got.collect():
        ids = t.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in stages["BPE encoding"](spark, got, sf_dir).collect()) == want


def test_pipeline_over_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_mixing_runs_its_classifier_once(spark, sf_dir):
    """The rate is read off a written table: no classifier in the last plan."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) > 50")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plan = mixing.mix(docs, labels, mixing.MixParams(min_rate=1.0))._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan and "mix_features" not in plan and "split(" not in plan


def test_rounds_start_from_written_rates(spark):
    """Writing the rates every few rounds changes nothing but the work of a round."""
    rnd = np.random.default_rng(3)
    rows = [(int(t), [float(x) for x in q]) for t, q in zip(rnd.integers(1, 90, 60), rnd.dirichlet((0.3, 0.3), 60), strict=True)]
    scored = spark.createDataFrame(rows, "mix_tokens long, mix_posterior array<double>")
    p = {"targets": {"x": 0.8, "y": 0.2}, "max_rounds": 7, "tolerance": 0.0}
    one, many = (mixing.fit_rates(scored, ["x", "y"], mixing.MixParams(**p, write_every=k)) for k in (100, 2))
    assert len(one[0]) == len(many[0]) == 7 and np.allclose(one[0], many[0]) and np.allclose(one[1]["expected"], many[1]["expected"])


def test_mix_of_empty_and_odd_tables(spark):
    docs = _docs(spark)
    none = spark.createDataFrame([], LABELS)
    assert mixing.mix(docs.limit(0), none).count() == 0
    kept = mixing.mix(docs, none)  # no labels: every rate is 1
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_redaction_runs_its_detectors_once(spark):
    plan = pii.redact(_docs(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "regexp_replace" not in plan


def test_decode_leaves_unknown_ids_out(spark):
    t = Tokenizer.from_file(bpe.default_params().tokenizer)
    ids = [[320, -1, 10 ** 6, 530], [None, 320], [], None]
    rows = bpe.decode(spark.createDataFrame(list(enumerate(ids)), "doc_id int, ids array<int>")).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [t.decode([320, 10 ** 6, 530], skip_special_tokens=False), t.decode([320], skip_special_tokens=False), "", ""]


def test_archives_of_ids_that_say_null(spark):
    from larder.llm import warc
    pages = spark.createDataFrame([("null", "http://a", "x"), (None, "http://b", "y"), ("", "http://c", "z"), ("a b/ü", None, "x")],
                                  "page_id string, url string, html string")
    got = {r.payload_digest + r.record_type: (r.page_id, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert sorted(got.values(), key=str) == sorted([("a b/ü", None), ("null", "a b/ü"), (None, None), ("", None)], key=str)


def _all_rules(baskets, least, confidence, most):
    """Sets of tokens, at most ``most``, frequent with bad rows and mostly bad."""
    import itertools
    tokens = sorted(set().union(*[b for b, _ in baskets]))
    out = []
    for n in range(1, most + 1):
        for x in itertools.combinations(tokens, n):
            held = [bad for b, bad in baskets if b.issuperset(x)]
            if held and sum(held) >= least and sum(held) > 0 and sum(held) >= confidence * len(held):
                out.append(frozenset(x))
    return out


def test_mined_rules_equal_all_combinations(spark):
    from larder.llm import urls
    for seed in range(4):
        rnd = random.Random(seed)
        baskets = []
        for _ in range(150):
            b = {f"t{k}" for k in range(9) if rnd.random() < 0.4}
            b |= {"t0x"} if "t0" in b else set()  # stands where t0 stands
            baskets.append((b, ("t1" in b and "t2" in b) or {"t3", "t4", "t5"} <= b or rnd.random() < 0.15))
        p = urls.UrlParams(support=0.03, confidence=0.8)
        df = spark.createDataFrame([(sorted(b), bad) for b, bad in baskets], "tokens array<string>, bad boolean")
        rules = collections.defaultdict(lambda: collections.defaultdict(set))
        for r in urls.mine_rules(df, p).collect():
            rules[r.rule_id][r.slot].add(r.token)
            assert r.needs == len(r.rule_id.split(" "))
        want = _all_rules(baskets, p.support * 150, p.confidence, 3)
        held = [b for b in map(frozenset, (set(x) for x in ({f"t{k}" for k in range(9) if rnd.random() < 0.5} for _ in range(300)))) ]
        held += [b | {"t0x"} for b in held if "t0" in b]
        for b in held:
            got = any(len(slots) == len(rule.split(" ")) and all(b & slots[x] for x in slots) for rule, slots in rules.items())
            assert got == any(b >= x or (b | {"t0x", "t0"}) >= x and ("t0" in b or "t0x" in b) for x in want), (seed, sorted(b))


def test_near_equal_segments_are_mined_in_time(spark):
    """24 tokens that mostly stand together: combinations of three, not 2^24."""
    import time
    from larder.llm import urls
    rows = [([f"p:seg{j:02d}" for j in range(24) if j != i % 24] + ["x"] * (i % 2), i % 5 > 0) for i in range(600)]
    start = time.time()
    rules = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), urls.UrlParams())
    assert rules.count() == 0 or rules.agg({"needs": "max"}).first()[0] <= 3
    assert time.time() - start < 120
