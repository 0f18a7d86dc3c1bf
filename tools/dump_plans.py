"""Write the physical plans of the main queries to docs/PLANS.md.

Run after a change to see that the plans are still the ones we want:
``python tools/dump_plans.py [--sf-dir DIR]``.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from evstar.plans.queries import QUERIES  # noqa: E402
from evstar.session import get_session  # noqa: E402

MAIN = [
    "stg_orders",
    "fact_orders",
    "revenue_by_date_nation",
    "dq_relationships_customer",
    "dq_unique_lineitem",
    "profile_lake",
    "topic_key_affinity",
    "latest_snapshot",
]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    # long literal expressions (the stand-in message text) are elided
    return re.sub(r"\[[^\]\n]{160,}\]", "[...]", text)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"))
    args = ap.parse_args()
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "16"})
    parts = [
        "# Physical plans of the main queries\n",
        f"Generated by `tools/dump_plans.py` on `{args.sf_dir}` (initial adaptive plans; AQE may still turn a "
        "sort-merge join into a broadcast join, or split a skewed partition, once shuffle sizes are known).\n",
    ]
    for name in MAIN:
        df = QUERIES[name](spark, args.sf_dir)
        text = "\n".join(line[:220] for line in plan_text(df).splitlines())
        parts.append(f"\n## {name}\n\n```\n{text}\n```\n")
    with open(args.out, "w") as f:
        f.write("".join(parts))
    print(f"wrote {args.out}")


if __name__ == "__main__":
    main()
