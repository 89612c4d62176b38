"""Run the whole load: spark-submit with this module, or `python -m arrivals`."""

from __future__ import annotations

import argparse
from dataclasses import MISSING, fields

from pyspark.sql import SparkSession

from arrivals.plans import StarInputs, load_star
from arrivals.plans.airports import FILES


def main() -> None:
    parser = argparse.ArgumentParser(prog="arrivals", description="Store the arrivals star schema as Parquet.")
    for field in fields(StarInputs):
        required = field.default is MISSING
        parser.add_argument(
            "--" + field.name.replace("_", "-"), required=required, default=None if required else field.default
        )
    parser.add_argument("--output", required=True)
    parser.add_argument("--replace-arrivals", choices=["all", "months"], default="all")
    parser.add_argument("--airport-files", type=int, default=FILES)
    parser.add_argument("--preview-rows", type=int, default=0)
    parser.add_argument("--turn-bytes", type=int)
    options = vars(parser.parse_args())
    output, replace, files, rows, turn = (options.pop(name) for name in ("output", "replace_arrivals", "airport_files", "preview_rows", "turn_bytes"))
    spark = SparkSession.builder.appName("arrivals").getOrCreate()
    load_star(spark, StarInputs(**options), output, replace, files, rows, turn).show(truncate=False)


if __name__ == "__main__":
    main()
