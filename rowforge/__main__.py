"""Command line: ``python -m rowforge <job> ...`` (see ``--help``)."""

from __future__ import annotations

import argparse
import json

from rowforge.plans import jobs
from rowforge.session import build_session


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="rowforge")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("cleanse", help="two plan files -> kept/rejected/merged/deduplicated")
    c.add_argument("--file1", required=True, help="plan lines, header first, dates yyyy-MM-dd")
    c.add_argument("--file2", required=True, help="plan lines, dates dd-MM-yyyy, fields may be padded")
    c.add_argument("--out", required=True, help="output folder")
    e = sub.add_parser("enrich", help="plan CSV + customers/states -> enriched + ranking")
    e.add_argument("--plans", required=True, help="plan CSV with header (10 columns)")
    e.add_argument("--custs-states", required=True,
                   help="mixed file: customers (5 fields) and states (2 fields)")
    e.add_argument("--out", required=True, help="output folder")
    e.add_argument("--jdbc-url")
    e.add_argument("--jdbc-table")
    e.add_argument("--jdbc-user")
    e.add_argument("--jdbc-password")
    t = sub.add_parser("chat", help="chat files -> words + keyword counts")
    t.add_argument("--chat-dir", required=True, help="folder receiving id~text~type files")
    t.add_argument("--stopwords", required=True, help="one stop word per line")
    t.add_argument("--out", required=True, help="output folder")
    t.add_argument("--checkpoint", help="stream checkpoint folder (default: <out>/_checkpoints)")
    a = p.parse_args(argv)

    spark = build_session(a.master, app=f"rowforge-{a.job}")
    if a.job == "cleanse":
        print(json.dumps(jobs.cleansing_job(spark, a.file1, a.file2, a.out), default=str))
    elif a.job == "enrich":
        jdbc = None
        if a.jdbc_url:
            jdbc = {"url": a.jdbc_url, "table": a.jdbc_table, "user": a.jdbc_user,
                    "password": a.jdbc_password}
        jobs.enrichment_job(spark, a.plans, a.custs_states, a.out, jdbc)
    else:
        jobs.chat_job(spark, a.chat_dir, a.stopwords, a.out, a.checkpoint)


if __name__ == "__main__":
    main()
