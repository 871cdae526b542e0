"""Write docs/PLANS.md: the physical plan shape of the main queries.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from titleflow.plans.queries import QUERIES  # noqa: E402
from titleflow.session import local_session  # noqa: E402

KEYS = ["assemble_gold", "stratified_sample", "upsert", "person_stats", "role_scores", "tfidf", "topk_per_request", "latest_partition", "clean_sentinel_int"]
OPS = re.compile(r"(Exchange \w+|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|HashAggregate|ObjectHashAggregate|WindowGroupLimit|Window|Generate|FileScan \w+|PartitionFilters: \[[^\]]*\]|ReadSchema: \S+)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan; AQE re-plans at run time
    out = ["# Physical plans (static, before AQE)\n", f"Generated by `tools/plans.py` on `{sf_dir}`.\n"]
    for k in KEYS:
        plan = QUERIES[k](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts: dict[str, int] = {}
        for m in OPS.finditer(plan):
            name = m.group(1).split(":")[0].split(" [")[0]
            if name.startswith("FileScan") or name.startswith("ReadSchema") or name.startswith("PartitionFilters"):
                continue
            counts[name] = counts.get(name, 0) + 1
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        pfs = sorted(set(re.findall(r"PartitionFilters: (\[[^\]]*\])", plan)))
        out.append(f"## {k}\n")
        out.append("| operator | count |\n|---|---|")
        out += [f"| {n} | {c} |" for n, c in sorted(counts.items())]
        out.append("\nScans read only: " + "; ".join(f"`{s}`" for s in schemas))
        if any(p != "[]" for p in pfs):
            out.append("\nPartition filters: " + "; ".join(f"`{p}`" for p in pfs if p != "[]"))
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
