"""Write PLANS.md: the formatted physical plan summary of the headline queries.

    python tools/explain_plans.py [--sf /root/testdata/sf0.01]

For each query: number of shuffles (Exchange), broadcasts, scans with their
pushed filters / read schema, window and Python nodes — what to look at when
asking "would this plan survive 1000x the data?".
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    nodes = [l for l in lines if re.match(r"^\(\d+\) ", l)]
    names = [re.sub(r"^\(\d+\) ", "", l).split(" ")[0] for l in nodes]
    scans = []
    for i, l in enumerate(lines):
        if l.startswith("(") and "Scan parquet" in l:
            block = []
            for m in lines[i + 1:i + 12]:
                if m.startswith("("):
                    break
                if m.startswith(("PushedFilters", "ReadSchema", "PartitionFilters", "Location")):
                    block.append(m.strip())
            scans.append(block)
    return {
        "exchanges": sum(n in ("Exchange", "ShuffleExchange") for n in names),
        "broadcasts": sum(n == "BroadcastExchange" for n in names),
        "windows": sum(n == "Window" for n in names),
        "python": sum("Python" in n or "ArrowEval" in n or "FlatMapGroupsInPandas" in n for n in names),
        "smj": sum(n == "SortMergeJoin" for n in names),
        "bhj": sum(n == "BroadcastHashJoin" for n in names),
        "scans": scans,
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "PLANS.md"))
    args = ap.parse_args()
    from bench import HEADLINE
    from fareweave.plans.registry import QUERIES, load_all
    from fareweave.session import local_session
    load_all()
    spark = local_session()
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(args.sf)}` (AQE on; the initial plan "
           "is shown — at run time AQE may turn a sort-merge join into a broadcast join when a side is "
           "measured under the threshold, coalesce partitions, or split skewed ones).", "",
           "| query | exchanges | broadcast | SMJ | BHJ | windows | python |", "|---|---|---|---|---|---|---|"]
    details = []
    for k in HEADLINE:
        df = QUERIES[k](spark, args.sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s = summarize(plan)
        out.append(f"| `{k}` | {s['exchanges']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
                   f"{s['windows']} | {s['python']} |")
        details.append(f"### `{k}`\n")
        for sc in s["scans"]:
            details.append("- " + "; ".join(x for x in sc if not x.startswith("Location")))
        details.append("")
    out += ["", "## Scans (pushed filters and pruned read schema)", ""] + details
    with open(args.out, "w") as f:
        f.write("\n".join(out) + "\n")
    print("wrote", args.out)


if __name__ == "__main__":
    main()
