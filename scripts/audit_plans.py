"""Physical-plan audit of every registered query (writes a Markdown table to stdout).

Counts exchanges, broadcasts, join kinds, windows (with their partition
keys), generators and any Python evaluation in the executed plan at the
given scale factor.  Eager model-fitting queries are skipped.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from songemo.plans.catalog import queries  # noqa: E402
from songemo.session import build_session  # noqa: E402

SKIP = {"ridge_fit", "elasticnet_fit", "cv_scores", "tree_cv_scores", "rf_fit", "gbt_fit", "model_comparison", "ml_predict",
        "kmeans", "median_impute"}
KEYS = [("Exchange hashpartitioning", "hash"), ("Exchange rangepartitioning", "range"),
        ("Exchange SinglePartition", "single"), ("BroadcastExchange", "bcast"), ("SortMergeJoin", "SMJ"),
        ("BroadcastHashJoin", "BHJ"), ("BroadcastNestedLoopJoin", "BNLJ"), ("CartesianProduct", "cartesian"),
        ("WindowGroupLimit", "wgl"), ("Generate", "generate"), ("BatchEvalPython", "py-udf"),
        ("ArrowEvalPython", "pandas-udf")]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    print(f"| query | plan operators ({sf}) | window partition keys |\n|---|---|---|")
    for name, fn in sorted(queries().items()):
        if name in SKIP:
            continue
        p = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = ", ".join(f"{short} {p.count(k)}" for k, short in KEYS if p.count(k))
        wins = sorted({w.strip() for w in re.findall(r"Window \[.*?\], \[(.*?)\], \[", p)})
        wins = [re.sub(r"#\d+L?", "", w) or "(none: <= k rows)" for w in wins]
        print(f"| {name} | {counts or 'narrow only'} | {'; '.join(wins)} |")
    spark.stop()


if __name__ == "__main__":
    main()
