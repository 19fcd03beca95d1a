"""Summarise the physical plan of every registered batch job: operator tree,
exchanges, join strategies, pushed filters and read schemas.

usage: python tools/plan_report.py [--no-broadcast] [sf_dir] [name ...] > PLANS.md

--no-broadcast shows the plans as they are at 100 TB, where Spark's own
broadcast choice never applies to the big sides (size-checked hints on small
lookups still do).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowforge.functions.text import JAVA_BLANKS  # noqa: E402


def summary(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString().replace(JAVA_BLANKS, "0x00-0x20")
    out = []
    for line in text.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if "FileScan" in line:
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            parts = re.search(r"^(.*FileScan \w+)", line)
            tbl = re.search(r"\[file:[^\]]*/([^/\]]+\.parquet)\]", line)
            extra = [parts.group(1) if parts else line[:60]]
            if tbl:
                extra.append(tbl.group(1))
            if schema:
                extra.append(f"ReadSchema={schema.group(1)}")
            if pushed and pushed.group(1):
                extra.append(f"PushedFilters=[{pushed.group(1)[:160]}]")
            out.append(" ".join(extra))
        else:
            out.append(line[:200])
    return out


def main() -> None:
    args = sys.argv[1:]
    no_bc = "--no-broadcast" in args
    args = [a for a in args if a != "--no-broadcast"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    from rowforge.session import build_session
    from rowforge.plans.queries import QUERIES
    spark = build_session("local[8]", shuffle_partitions=16)
    if no_bc:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        print("# Plans at scale: Spark's broadcast choice off\n")
        print("Only the size-checked lookups (nation, states, stop words) are broadcast; every big")
        print("side takes the shuffle path, as it would at 100 TB.\n")
    else:
        print("# Physical plans of the registered batch jobs\n")
        print(f"Generated by `tools/plan_report.py` on `{sf}` (local[8], AQE on; the initial")
        print("plan is shown, AQE may re-plan joins and coalesce partitions at run time).\n")
    for name in args[1:] or sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        print(f"## {name}\n\n```")
        print("\n".join(summary(df)))
        print("```\n")

if __name__ == "__main__":
    main()
