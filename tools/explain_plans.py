"""Print the physical plans of the key operators (explain "formatted"),
trimmed to the lines that show exchanges, scans, pushdown and bucketing.

usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

import re
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators.averaging import param_average  # noqa: E402
from tessera.operators.sampling import sample_cap, split_exact, split_side  # noqa: E402
from tessera.plans import queries as Q  # noqa: E402
from tessera.plans import training as T  # noqa: E402
from tessera.session import build_session  # noqa: E402

KEEP = re.compile(r"^(\+-|:|\s+[:+]|(\* )?[A-Z]\w+[^()]* \(\d+\)$|PushedFilters|PartitionFilters|ReadSchema|"
                  r"Bucketed|SelectedBucketsCount|Arguments: (range|hash|Single))")
TREE_END = re.compile(r"^\(\d+\) ")


def show(title, df):
    print(f"## {title}\n\n```")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    in_tree = True
    for line in plan.splitlines():
        if TREE_END.search(line):
            in_tree = False  # node details follow the tree: keep only the notable lines
        if in_tree and line.strip() and not line.startswith("=="):
            print(line.rstrip()[:150])
        elif not in_tree and KEEP.search(line) and not TREE_END.search(line):
            print(line.rstrip()[:150])
    print("```\n")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    print("# Physical plans of the key operators\n\nGenerated by `tools/explain_plans.py` "
          f"on `{sf}` (AQE off to show the static plan).\n")
    e = Q._emb(spark, sf)
    show("split_exact: one data exchange, bounded offsets broadcast", split_exact(e.select("id", "label"), "id"))
    show("sample_cap: buckets past the cap dropped before the exchange", sample_cap(e.select("id", "label"), "id", 300))
    show("split_side train (as the job runs it): test buckets pruned by the broadcast join, one data exchange",
         split_side(e, "id", "train", 0.8))
    show("split_side test: narrow for whole buckets, exchange only for the boundary bucket",
         split_side(e, "id", "test", 0.8, positions=False))
    show("score_batch: narrow scan -> MapInPandas, pruned columns", Q.score_batch(spark, sf))
    show("confusion + class metrics: one scoring pass, partial/final aggregates", Q.class_metrics_q(spark, sf))
    emb = Q.table(spark, sf, "embeddings")
    show("param_average (ARRAY<DOUBLE>): partial + final ObjectHashAggregate",
         param_average(emb.select(F.lit("w").alias("param"), F.col("label").alias("chunk"),
                                  F.col("embedding").cast("array<double>").alias("values"))))
    train = split_side(e, "id", "train", 0.8)
    rows = T.prepare_training_rows(train, 30, 4, 5)
    g = rows.agg(F.max("rounds_per_group")).first()[0]
    show("one training round's input: bucketed scan, partition + row-group pruning, no exchange before the fit",
         T.rows_of_round(rows, 1, g).groupBy("wkey").count())
    spark.stop()


if __name__ == "__main__":
    main()
