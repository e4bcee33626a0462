"""``spark-submit -m seasonflow <raw csv> <work folder> [--publish <folder>]``.

``--cv`` and ``--tune N`` use the featured table that an earlier run left in the work folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from seasonflow.plans import flow
from seasonflow.plans.forecasters import LIGHTGBM, LIGHTGBM_SPACE, SearchSpace
from seasonflow.spec import TRANSIT


def main() -> None:
    options = argparse.ArgumentParser(prog="seasonflow")
    options.add_argument("raw", help="raw wide CSV, on any store Spark can read")
    options.add_argument("root", help="folder for the stored tables and models")
    options.add_argument("--publish", help="folder that receives the published tables")
    options.add_argument("--dates", choices=["by_rule", "two_pass"], default="by_rule")
    options.add_argument("--cv", action="store_true", help="walk-forward validation only")
    options.add_argument("--tune", type=int, metavar="N", help="search with N trials only")
    options.add_argument("--learner", choices=["xgboost", "lightgbm"], default="xgboost", help="whose ranges --tune searches")
    chosen = options.parse_args()
    spark = SparkSession.builder.appName("seasonflow").getOrCreate()
    if chosen.cv:
        flow.walk_forward_step(spark, chosen.root, TRANSIT, LIGHTGBM).show(50, False)
        return
    if chosen.tune:
        space = LIGHTGBM_SPACE if chosen.learner == "lightgbm" else SearchSpace()
        for table in flow.tuning_step(spark, chosen.root, TRANSIT, space, trials=chosen.tune):
            table.show(500, False)
        return
    flow.run(spark, chosen.raw, chosen.root, TRANSIT, policy=chosen.dates, target=chosen.publish).show(50, False)


if __name__ == "__main__":
    main()
