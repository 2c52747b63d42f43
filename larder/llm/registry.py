"""All registered queries of the package and their SQL."""

from __future__ import annotations

from larder.llm import (queries_alignment, queries_bpe, queries_byte_bpe, queries_licenses, queries_minhash,
                        queries_mixing, queries_pii, queries_quality, queries_toxicity, queries_urls, queries_vectors,
                        queries_warc, queries_whitening)

_MODULES = (queries_quality, queries_warc, queries_mixing, queries_pii, queries_bpe, queries_vectors, queries_urls,
            queries_toxicity, queries_licenses, queries_minhash, queries_byte_bpe, queries_alignment, queries_whitening)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
