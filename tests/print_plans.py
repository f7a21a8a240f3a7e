"""Write PLANS.md: physical plan trees of selected queries (explain formatted,
tree part only) after one execution, so the adaptive plan is final."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "tagged_range_sorted": "array predicate after the scan; range on the (nested) level column; range-partitioned sort",
    "dedup_keep_first": "keep-first as min_by with a partial (map-side) aggregate before the shuffle",
    "first_match_else_first": "first-match-else-first as one partial + final aggregate per user",
    "fan_in_list": "lines meet parts (broadcast chosen by AQE from measured size), partial collect per order, then orders",
    "map_from_lists": "last cell per (order, flag) reduced map-side; per-order lists hold at most one entry per flag",
    "link_follow_join": "links counted per host (partial) before meeting the pages",
    "chain_pairs": "W1 as an equi-join on (chain, pos + 1); no window over the chain",
    "chain_successors": "W2 as a per-chain partial aggregate joined back; no window over the chain",
    "upsert_secondary_key": "fold (partial max_by), phase-1 full outer join on the key, targets per name, left join on (name, key)",
    "multi_valued_count": "partial collect_set per customer (bounded by distinct statuses), global count from partials",
    "page_items": "trace A: parsed pages read back from the written table; listing rows meet detail pages, "
                  "abilities fan out to their pages and fan back in",
    "etl_documents": "whole flow: documents read back from the table written before the merge's branches",
}


def tree(plan: str) -> str:
    """The final plan tree plus the pushdown/read-schema lines of each scan."""
    lines = plan.splitlines()
    out, i = [], 0
    while i < len(lines) and not lines[i].strip().startswith("("):
        if "Initial Plan" in lines[i]:
            break
        out.append(lines[i].rstrip())
        i += 1
    scans = []
    for j, ln in enumerate(lines):
        if ln.startswith("(") and "Scan" in ln:
            for x in lines[j + 1:j + 9]:
                if x.startswith(("PushedFilters", "ReadSchema")):
                    scans.append(f"{ln.strip()}  {x.strip()[:200]}")
    return "\n".join([x for x in out if x.strip()] + ([""] + scans if scans else []))


def main():
    from __spark_entry__ import queries
    from tessera.session import build_session
    sf = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("local[8]", 8)
    parts = ["# Physical plans of selected queries", "",
             f"Generated by `tests/print_plans.py` on `{sf}` (local[8], AQE on) after one execution of each "
             "query, so adaptive decisions (broadcast conversions, coalescing) are final.", ""]
    for name, note in NOTES.items():
        df = queries()[name](spark, sf)
        df._jdf.queryExecution().toRdd().count()     # run this plan so AQE finalizes it
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        parts += [f"## {name}", "", note, "", "```", tree(plan), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main()
