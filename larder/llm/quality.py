"""Quality rules by compression bands.

Every whole text is compressed with zstandard, once as a whole and once in
fixed chunks. Repetitive text compresses too well and random text too badly;
how well clean text compresses depends on its length, so each length class has
its own band of allowed ratios (raw bytes / compressed bytes).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import pick, positional


@dataclass(frozen=True)
class BandParams:
    """``bands``: (least bytes, lowest ratio, highest ratio) by text length;
    ``chunk_bytes``: chunk length; ``chunk_band``: allowed ratio of a chunk;
    ``max_bad_chunks``: largest share of chunks outside the band;
    ``level``: zstandard level; ``min_words`` and ``max_repeat_percent``: base rules."""
    bands: tuple = ((0, 0.0, 4.0), (256, 1.05, 3.5), (1024, 1.3, 4.0), (8192, 1.4, 5.0), (65536, 1.4, 6.0))
    chunk_bytes: int = 4096
    chunk_band: tuple = (1.2, 4.5)
    max_bad_chunks: float = 0.25
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, " \
        "bad_chunks double, base_failed boolean, kept boolean"


def _repeated(words: list) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    index: dict = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) == len(words):
        return 0
    pair = ids[:-1] * len(index) + ids[1:]
    pair = np.unique(pair, return_inverse=True)[1]
    _, window, count = np.unique(pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + n] |= twice
    return int(covered.sum())


def _band(bands, size: int):
    low, high = 0.0, float("inf")
    for least, lo, hi in bands:
        if size >= least:
            low, high = lo, hi
    return low, high


def text_stats(text, compress, p: BandParams) -> tuple:
    """All figures of one text; ``compress`` is a zstandard compressor's method."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # splits at the same six ASCII characters
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeat = _repeated(words)
    base_failed = len(words) < p.min_words or 100 * repeat > p.max_repeat_percent * len(words)
    ratio = len(raw) / len(compress(raw)) if raw else 0.0
    low, high = _band(p.bands, len(raw))
    bad = 0.0
    if len(raw) > p.chunk_bytes:
        chunks = [raw[i:i + p.chunk_bytes] for i in range(0, len(raw), p.chunk_bytes)]
        if len(chunks[-1]) < p.chunk_bytes // 2:  # a short rest would have a ratio of its own kind
            chunks[-2:] = [chunks[-2] + chunks[-1]]
        bad = float(np.mean([not p.chunk_band[0] <= len(c) / len(compress(c)) <= p.chunk_band[1] for c in chunks]))
    kept = not base_failed and low <= ratio <= high and bad <= p.max_bad_chunks
    return (len(words), chars, symbols, len(lines) - len(set(lines)), repeat, ratio, bad, base_failed, kept)


def stats_column(text, params: BandParams = BandParams()):
    """A struct column of all figures and the verdict for a text column."""
    names = [x.split()[0] for x in STATS.split(", ")]

    @F.pandas_udf(STATS)
    def stats(s: pd.Series) -> pd.DataFrame:
        import zstandard
        compress = zstandard.ZstdCompressor(level=params.level).compress
        return pd.DataFrame([text_stats(t if isinstance(t, str) else None, compress, params) for t in s], columns=names)

    return stats(text)


def compression_bands(docs: DataFrame, params: BandParams = BandParams(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the base figures, ``ratio``,
    ``bad_chunks``, ``base_failed`` and ``kept``.

    A null or empty text has no words, so it fails the base rules. Repeated
    rows and null ids are judged row by row. No shuffle: one pass over the
    texts, each task holding one Arrow batch."""
    d = pick(docs, doc_id=id_col, text=text_col)
    return d.select("doc_id", stats_column(F.col("text"), params).alias("s")).select("doc_id", "s.*")


def keep_good(docs: DataFrame, params: BandParams = BandParams(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    flat, at, restore = positional(docs)
    return restore(flat.withColumn("stats", stats_column(F.col(at(text_col)), params)).filter("stats.kept"))
