"""Write PLANS.md: physical plan trees of the key queries with a note on each.

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NOTES = {
    "page_link_fact": "Pages keyed by URL hash; the link list is extracted in the scan stage, so the dedupe "
                      "shuffle (with a map-side `WindowGroupLimit`) moves link lists, not whole pages. Ids come "
                      "from the distinct keys numbered through a table under the checkpoint folder and are "
                      "attached by a join whose strategy Spark picks from the dimension's size.",
    "latest_per_key": "`WindowGroupLimit Partial` runs before the exchange: a key holding a third of the rows "
                      "ships one row per map task. `Final` after the exchange, then the window.",
    "first_non_null": "Partial aggregation before the exchange (`min_by` with a null-skipping ordering), final "
                      "after: hot keys are combined map-side.",
    "attach_ids": "Two left lookups. No hints: the dimensions are broadcast where their estimated size "
                  "is under `autoBroadcastJoinThreshold`; a large dimension becomes a sort-merge join, with AQE "
                  "skew splitting for hot keys on the fact side.",
    "nested_fact": "Duplicates per (order, line) are cut map-side before the first exchange, so each collected "
                   "map is bounded by its distinct line numbers; explode happens after the id joins.",
    "dim_upsert_changed": "One full outer join splits untouched / matched / new rows; new rows are numbered "
                          "through the range-partitioned table, never a single-task window.",
    "label_value_pivot": "The pivot is array expressions inside each row: no exchange at all.",
    "ordered_union_limit": "Filters pushed into the Parquet scan; the ordered limit is `TakeOrderedAndProject` "
                           "(per-task top-n, then a merge of n rows per task).",
    "page_table_extract": "Page rules are column expressions: a scan, one generate and projections, no exchange and no Python.",
}


def tree(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head = text.split("\n\n")[0]
    return head.strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from strata.plans.catalog import QUERIES
    from strata.session import get_session
    spark = get_session("local[8]", 16)
    out = ["# Physical plans of the key queries", "",
           f"Generated by `tools/dump_plans.py` at `{sf}` (`explain(\"formatted\")`, initial adaptive plan).", ""]
    for name, note in NOTES.items():
        out += [f"## `{name}`", "", note, "", "```", tree(QUERIES[name](spark, sf)), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
