"""``spark-submit``-able job: raw delimited files in, tables, report and figure tables out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from flowmetrics import fixed
from flowmetrics.plans.report import run_report
from flowmetrics.sources.readings import read_delimited, read_parquet


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="flowmetrics")
    p.add_argument("input", nargs="+", help="paths or globs of the raw readings")
    p.add_argument("--output", required=True, help="folder all executors can reach")
    p.add_argument("--input-format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--output-format", choices=["csv", "parquet"], default="parquet")
    p.add_argument("--sep", default=fixed.RAW_SEPARATOR)
    p.add_argument("--infer", action="store_true", help="infer types instead of declaring them")
    p.add_argument("--first-year", type=int, default=fixed.FIRST_YEAR)
    p.add_argument("--last-year", type=int, default=fixed.LAST_YEAR)
    p.add_argument("--median", choices=["approx", "exact"], default="exact")
    p.add_argument("--top", type=int, default=fixed.TOP_N)
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName("flowmetrics").getOrCreate()
    if args.input_format == "csv":
        raw = read_delimited(spark, args.input, sep=args.sep, infer=args.infer)
    else:
        raw = read_parquet(spark, args.input)
    written = run_report(
        raw,
        args.output,
        years=(args.first_year, args.last_year),
        median=args.median,
        n=args.top,
        fmt=args.output_format,
        stage=args.input_format == "csv",
    )
    for group, paths in written.items():
        for name, path in paths.items():
            print(f"{group}\t{name}\t{path}")


if __name__ == "__main__":
    main()
