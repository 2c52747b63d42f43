"""Training-data operators: quality rules, WARC archives, source mixing, PII,
BPE encoding, near-duplicates, URL rules, toxicity and licence scans.

Nothing outside this package imports it.
"""
