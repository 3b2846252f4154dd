"""Print the formatted physical plan and a shuffle / broadcast summary of registered queries.

usage: python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")


def main() -> None:
    from lakekpi.registry import QUERIES
    from lakekpi.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    for name in args:
        df = QUERIES[name](spark, sf_dir)
        print(f"===== {name}")
        df.explain("formatted")
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(
            f"-- shuffles={plan.count('Exchange hashpartitioning') + plan.count('Exchange rangepartitioning')}"
            f" broadcasts={plan.count('BroadcastExchange')} single-partition={plan.count('SinglePartition')}"
            f" nested-loop={plan.count('NestedLoop')} window-group-limit={plan.count('WindowGroupLimit')}"
        )
    spark.stop()


if __name__ == "__main__":
    main()
