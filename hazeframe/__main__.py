"""Command line: spark-submit -m hazeframe <job> ... or python -m hazeframe <job> ..."""

from __future__ import annotations

import argparse

from hazeframe.plans import jobs
from hazeframe.session import get_spark
from hazeframe.sources.tables import table_path


def main() -> None:
    parser = argparse.ArgumentParser(prog="hazeframe")
    parser.add_argument("--root", required=True, help="folder of the tables")
    commands = parser.add_subparsers(dest="job", required=True)
    load = commands.add_parser("load", help="CSV folders -> measurements")
    load.add_argument("folders", nargs="+", metavar="LABEL=FOLDER")
    locate = commands.add_parser("locate", help="nearest settlement of each sensor -> sensors")
    locate.add_argument("gazetteer", help="Parquet table place_id, name, admin1, cc, latitude, longitude")
    locate.add_argument("--keep-moves", action="store_true")
    commands.add_parser("aggregate", help="-> daily_city_avg, monthly_city_avg")
    commands.add_parser("describe", help="-> CSV reports")
    commands.add_parser("index", help="-> aqi, daily_city_aqi")
    commands.add_parser("train", help="-> ml_metrics, ml_predictions, models")
    commands.add_parser("anomalies", help="-> anomalies")
    commands.add_parser("drop-old", help="remove older versions of all tables")
    args = parser.parse_args()

    spark = get_spark()
    if args.job == "load":
        jobs.load(spark, dict(item.split("=", 1) for item in args.folders), args.root).show()
    elif args.job == "locate":
        jobs.locate(spark, spark.read.parquet(args.gazetteer), args.root, args.keep_moves)
    elif args.job == "aggregate":
        jobs.aggregate(spark, args.root)
    elif args.job == "describe":
        jobs.describe(spark, args.root, table_path(args.root, "reports"))
    elif args.job == "index":
        jobs.index(spark, args.root).show(truncate=False)
    elif args.job == "train":
        for run in jobs.train(spark, args.root, table_path(args.root, "models")):
            run.metrics.show(truncate=False)
    elif args.job == "drop-old":
        print(jobs.drop_old(spark, args.root))
    else:
        jobs.find_anomalies(spark, args.root)


if __name__ == "__main__":
    main()
