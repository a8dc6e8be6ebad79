"""Print the physical plans of the headline operators (explain "formatted") and a one-line summary.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from handoff.functions.columns import is_missing, nan_to_null  # noqa: E402
from handoff.operators import clean as C  # noqa: E402
from handoff.operators import profile as B  # noqa: E402
from handoff.plans import views  # noqa: E402
from handoff.session import local_session  # noqa: E402


def summary(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("Scan parquet")
    shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan))
    bcast = plan.count("BroadcastExchange")
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^ \]]*)", plan)))
    print(f"{name}: scans={scans} shuffles={shuffles} broadcasts={bcast} read={schemas}")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    lines = views.line_table(spark, sf)
    # the validator's single aggregate (null counts + ranges of every column)
    aggs = [F.count(F.lit(1))]
    for f in lines.schema.fields:
        aggs.append(F.count_if(is_missing(F.col(f.name), f.dataType)))
        if f.dataType.typeName() in ("double", "long", "integer"):
            v = nan_to_null(F.col(f.name).cast("double"))
            aggs += [F.min(v), F.max(v)]
    one_scan = lines.agg(*aggs)
    summary("validator aggregate", one_scan)
    summary("keep_first (lineitem key)", C.keep_first(views.table(spark, sf, "lineitem"),
                                                     ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    summary("value_counts (all columns)", B.value_counts(lines))
    summary("customer_snapshot", views.customer_snapshot(spark, sf))
    one_scan.explain("formatted")


if __name__ == "__main__":
    main()
