"""Registered query of the URL filter."""

from __future__ import annotations

from larder.llm.urls import judge_urls
from larder.sources.tables import read_table


def op7_url_rules(spark, sf_dir):
    return judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


QUERIES = {"op7_url_rules": op7_url_rules}
ORACLES: dict = {}
