"""Print the executed (final, adaptive) physical plans of selected queries,
trimmed to operators and scan details, as Markdown.

usage: python tools/plans.py [sf_dir] [name ...] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harborline.plans.catalog import QUERIES  # noqa: E402
from harborline.session import local_session  # noqa: E402

DEFAULT = ["upsert_ports", "upsert_duplicates", "backfill_ports", "stats_read", "sql_latest", "stat_scan", "zone_filter",
           "zone_filter_grid",
           "ais_summary", "page_slice"]


def trim(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r"\[plan_id=\d+\]", "", line)
    return line if len(line) <= 190 else line[:187] + "..."


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or DEFAULT
    spark = local_session(8, 16)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    print(f"# Executed plans at {os.path.basename(sf)} (local[8], AQE on)\n")
    print("Generated by `python tools/plans.py`; expression lists are cut at 190 characters.")
    print("What to look for: one exchange per join side; PushedFilters / PartitionFilters on")
    print("every scan; narrow ReadSchema; BroadcastHashJoin / BroadcastNestedLoopJoin only")
    print("against inputs AQE measured small (zones, duplicate keys, page stops, day bounds).\n")
    for name in names:
        df = QUERIES[name](spark, sf)
        df.collect()  # runs this frame's own execution, so the adaptive plan is final (dev tool)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        for line in plan.splitlines():
            if "FileScan" in line:
                head, _, rest = line.partition(" Batched:")
                print(trim(head))
                pad = " " * (len(head) - len(head.lstrip()) + 6)
                for key in ("PartitionFilters", "PushedFilters", "ReadSchema"):
                    m = re.search(key + r": (\[[^\]]*\]|struct<[^>]*>)", rest)
                    if m:
                        print(trim(f"{pad}{key}: {m.group(1)}"))
            else:
                print(trim(line))
        print("```\n")


if __name__ == "__main__":
    main()
