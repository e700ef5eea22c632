"""``spark-submit`` entry of the batch plan: raw folders in, gold tables and forecast out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from skyledger.operators.forecast import TREES
from skyledger.plans.lakehouse import build


def main() -> None:
    parser = argparse.ArgumentParser(prog="skyledger")
    parser.add_argument("--calendar", required=True)
    parser.add_argument("--archive", required=True)
    for optional in ("monthly", "normals", "revisions", "place"):
        parser.add_argument(f"--{optional}")
    parser.add_argument("--out", required=True)
    parser.add_argument("--trees", type=int, default=TREES)
    parser.add_argument("--source-order", nargs="+", help="sources, the one that wins a day first")
    parser.add_argument("--alias", nargs="+", default=[], metavar="NAME=PLACE", help="other spellings of places")
    parser.add_argument("--by-place-month", action="store_true", help="impute the forecast by means of place and month")
    args = vars(parser.parse_args())
    folders = ("calendar", "archive", "monthly", "normals", "revisions")
    raw = {name: args[name] for name in folders if args[name]}
    spark = SparkSession.builder.appName("skyledger").getOrCreate()
    build(spark, raw, args["out"].rstrip("/"), args["trees"], args["place"], args["source_order"],
          dict(a.split("=", 1) for a in args["alias"]), args["by_place_month"])
    spark.stop()


if __name__ == "__main__":
    main()
