"""Texts and plain versions that the tests compare with."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, Kept string, Text_2 string, rid string"


def words(rnd: random.Random, n: int, stem: str = "w") -> str:
    return " ".join(f"{stem}{rnd.randrange(5000)}" for _ in range(n))


def odd_texts() -> list:
    """Null, empty, spaces, one word, a very long text, a text twice and a near copy."""
    rnd = random.Random(5)
    text = words(rnd, 120)
    return [None, "", " \t\n", "one", words(rnd, 30000), text, text, text.replace(" ", "  ", 1), text + " more", "A B", "a b"]


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in zip(ids, texts, strict=True)], DOCS)


def shingles(text, size: int) -> frozenset:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*[w[i:] for i in range(size)], strict=False)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def groups(ids, linked) -> dict:
    """Smallest reachable id per id, by trying every pair."""
    comp = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = sorted((comp[a], comp[b]))
                comp = {k: x if v == y else v for k, v in comp.items()}
    return comp
