"""Print the physical plan tree (formatted explain, node list only) of registered queries.

    python scripts/show_plans.py [--sf-dir DIR] [--no-broadcast] name ...
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.operators.layout import plan_text  # noqa: E402
from ledgerloom.plans.registry import QUERIES  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

KEEP = ("PushedFilters", "ReadSchema", "PartitionFilters", "Bucketed", "Keys", "Functions",
        "Join type", "Arguments: hashpartitioning", "Arguments: rangepartitioning")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--no-broadcast", action="store_true",
                    help="switch off AQE's runtime broadcast too, to show the large-data plan")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    spark = build_session("local[8]", shuffle_partitions=8)
    if args.no_broadcast:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for name in args.names:
        text = plan_text(QUERIES[name](spark, args.sf_dir), "formatted")
        tree, _, details = text.partition("\n\n\n")
        print(f"### {name}\n```")
        print(tree.strip())
        for line in details.splitlines():
            if line.startswith(KEEP) or line.startswith("("):
                print(line)
        print("```\n")


if __name__ == "__main__":
    main()
