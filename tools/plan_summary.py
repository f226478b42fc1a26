"""Summarise the physical plan of every registered query (for scale review).

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)



def main(sf_dir: str) -> None:
    from tripflow.registry import QUERIES, WRITERS
    from tripflow.session import build_session

    spark = build_session(shuffle_partitions=16)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}` (AQE initial plans).\n")
    print("| query | scans | exchanges | joins | aggregates | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, q in sorted(QUERIES.items()):
        if name in WRITERS:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q(spark, sf_dir).explain(mode="formatted")
        text = buf.getvalue().split("\n\n")[0]
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct) (\w+)", text)
        jc: dict[str, int] = {}
        for kind, jt in joins:
            jc[f"{kind} {jt}"] = jc.get(f"{kind} {jt}", 0) + 1
        full = buf.getvalue()
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", full)))
        print(
            f"| `{name}` | {text.count('Scan parquet')} | {len(re.findall(r'Exchange \(', text)) - len(re.findall(r'BroadcastExchange \(', text))} "
            f"| {', '.join(f'{k} x{v}' for k, v in sorted(jc.items())) or '-'} | {len(re.findall(r'HashAggregate|ObjectHashAggregate|SortAggregate', text))} "
            f"| {'; '.join(p[:60] for p in pushed[:2]) or '-'} |"
        )


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
