"""Regenerate PLANS.md: the final (post-AQE) physical plans of the headline
queries at sf0.1 with a note on what each means at 100 TB.

    python tools/write_plans.py [/root/testdata/sf0.1]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import QUERIES  # noqa: E402
from tessera.session import local_session  # noqa: E402

NOTES = {
    "conditional_counts": "One scan reading 3 of 6 columns; partial aggregate per task, so the shuffle carries at most (tasks x priorities) rows. At 100 TB the shuffle stays tiny; the work is the column-pruned scan.",
    "dedup_keep_last": "`max_by(struct(row), struct(order))` is a partial + final aggregate. The struct buffer is not fixed-width, so Spark picks SortAggregate: each task sorts its rows by key (spillable) and emits one partial per key; the shuffle moves at most one row per key per task. A key holding a third of all rows costs a third of the scan, spread over all tasks; it never lands whole in one task, as it would with a `row_number()` window.",
    "upsert_by_key": "Both loads are de-duplicated by the aggregate above, so the anti join sees unique keys on both sides and cannot skew. Catalyst broadcast the incoming key set because its estimated size is under `autoBroadcastJoinThreshold` (a statistics-checked bound); a larger one stays a sort-merge join on the key. The date filter is pushed into the Parquet scan (`PushedFilters`), so row groups outside a load are skipped. The third branch carries rows whose key has a NULL: its `isnull` filter reaches the scan (row groups without NULLs are skipped by their statistics). It meets the incoming NULL keys through a size-checked broadcast; with none, Spark drops that join. Against a table stored with `keyed.write_bucketed`, the complete-key anti join reads the stored side bucket by bucket, with no exchange (see `tests/test_plans.py`).",
    "group_mean_rows": "Per-group means come from a partial + final aggregate, read once as a local table (at most 100,000 rows, checked) and broadcast. The rows are never shuffled by the group key, so two groups do not mean two tasks. The final `ORDER BY` is the report's own order (range partitioning with sampled bounds).",
    "stratified_split": "One aggregate counts rows per (class, 2-hex-digit hash bucket). That small table gives the class sizes, the quotas and each bucket's offset. Rows in buckets wholly inside or outside the quota are labelled by a broadcast join (map-only). Only each class's single boundary bucket goes through a window partitioned by (class, bucket). Classes large enough that a bucket would exceed 1M rows get more digits, so a class holding a third of all rows is cut into up to 16^6 pieces.",
    "roc_points": "One row per distinct score (map-side-combined aggregate). At this size the score table fits under 100,000 rows and is summed as a local one-partition table. Larger score tables take the two-level path: range buckets from `percentile_approx` bounds (Bucketizer), bucket totals turned into offsets, and a window partitioned by bucket (plan-checked in `tests/test_plans.py` with a forced small bucket size).",
    "histogram_by_group": "Pass 1: per-group min and max (partial + final aggregate), read once as a checked local table that serves both the broadcast and the dense frame. Pass 2: bin index by arithmetic, count per (group, bin) with a partial aggregate. The dense frame is `explode(sequence(0, bins-1))` over the group table, not a cross join; output size is groups x bins, independent of rows.",
    "orphan_rows": "Keys first: the child's distinct keys (map-side combined, so a hot key costs one row per task) are anti-joined with the parent's distinct keys, key-only. The orphan-key set is checkpointed, checked against the 100,000-row bound and broadcast into a semi join with the child rows, so those rows, text included, are never shuffled. Past the bound the semi join shuffles, and AQE splits a skewed key (left semi is a supported skew-join type).",
    "impute_all": "The fill values were fitted first, in one pass: a single long-format value-count aggregate gives the exact median of `value` and the most frequent `category` (and the row count). The transform is a projection with literals (`coalesce(value, 29.0)`, `coalesce(category, R)`), with no join. The aggregate underneath is the binding (`sparse_lines`), not the imputer.",
    "classification_report": "The rows are aggregated once into (y, yhat) cells. That classes^2 table is read once as a local table, and precision, recall, F1 and the averages are derived from it, never from the rows again.",
}


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    return "\n".join(line[:170] for line in text.rstrip().splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = ["# Physical plans of the headline queries (sf0.1, local[8], AQE on)", "",
           "Generated by `python tools/write_plans.py` after executing each query, so these are",
           "AQE's final plans (expression and plan ids stripped, long lines trimmed). Each plan",
           "is preceded by what it means at 100 TB.", ""]
    for key, note in NOTES.items():
        out += [f"## {key}", "", note, "", "```", final_plan(QUERIES[key](spark, sf_dir)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
