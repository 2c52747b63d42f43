"""Summarise the executed plan of every registered query (after running it
into the noop sink, so AQE decisions are final): shuffles, sorts, windows,
broadcasts, Python nodes. Writes a Markdown table to stdout."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from larder.catalog.queries import QUERIES
    from larder.plans.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in QUERIES if not n.startswith("gbt_")]
    spark = build_session("local[8]", 16)
    print("| query | shuffles | reused | broadcasts | sorts | window nodes | python nodes | checkpoint reads | file scans |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        count = lambda pat: len(re.findall(pat, final))
        print(f"| {name} | {count(r'[+-] Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)')} "
              f"| {count(r'Reused')} | {count(r'[+-] BroadcastExchange')} | {count(r'[+-] Sort [[]')} "
              f"| {count(r'[+-] Window [[]')} | {count(r'FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython')} "
              f"| {count(r'Scan ExistingRDD')} | {count(r'FileScan parquet')} |", flush=True)


if __name__ == "__main__":
    main()
