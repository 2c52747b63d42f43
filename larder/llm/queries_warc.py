"""Registered query of the WARC writer and reader, and its SQL."""

from __future__ import annotations

from larder.llm.warc import round_trip
from larder.sources.tables import read_table


def op2_warc(spark, sf_dir):
    return round_trip(read_table(spark, sf_dir, "pages"))


QUERIES = {"op2_warc": op2_warc}

# Base32 of the 160-bit SHA-1: five hexadecimal digits are four base32 digits.
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v // {d}) % 32) + 1, 1)"
_B32 = " || ".join(_DIGIT.format(d=32 ** k) for k in (3, 2, 1, 0))
_HEX = " + ".join(f"(strpos('0123456789abcdef', substr(h, 5 * k + {i + 1}, 1)) - 1) * {16 ** (4 - i)}" for i in range(5))

ORACLES = {"op2_warc": f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT r, page_id, strlen(t) AS n, sha1(t) AS h FROM p),
k AS (SELECT r, k, {_HEX} AS v FROM h, range(8) AS g(k)),
b AS (SELECT r, string_agg({_B32}, '' ORDER BY k) AS d FROM k GROUP BY r),
f AS (SELECT h, min(page_id) AS first FROM h GROUP BY h)
SELECT h.page_id, CAST(h.n AS BIGINT) AS payload_bytes, b.d AS payload_digest,
       CASE WHEN h.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN h.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM h JOIN b USING (r) JOIN f ON f.h = h.h
"""}
