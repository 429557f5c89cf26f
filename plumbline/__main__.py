"""python -m plumbline config.json output-folder"""

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from plumbline.plans.export import export
from plumbline.plans.quality import run_quality
from plumbline.plans.results import severity_counts
from plumbline.sources.catalog import load_tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="plumbline")
    parser.add_argument("config", help="JSON file with sources and business rules")
    parser.add_argument("output", help="folder for the results")
    parser.add_argument("--as-of", help="moment after which dates are future; default: now")
    arguments = parser.parse_args()
    config = json.loads(Path(arguments.config).read_text(encoding="utf-8"))
    spark = SparkSession.builder.appName("plumbline").getOrCreate()
    run = run_quality(load_tables(spark, config), config, arguments.as_of)
    paths, _ = export(run, config, arguments.output)
    severity_counts(run.findings, run.drift).show()
    print("\n".join(paths))


if __name__ == "__main__":
    main()
