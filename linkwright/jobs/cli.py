"""The command: ``python -m linkwright.jobs.cli``. It ends with 0 (done), 2 (failed), 3 (data missing), 4 (headers wrong);
with --check-data: 0 (ready), 1 (data missing), 2 (headers wrong)."""

from __future__ import annotations

import argparse
import json
import logging
import os

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from . import config, dataset, keyed_run
from .run import STAGES, run

DONE, FAILED, NO_DATA, NO_SCHEMA = 0, 2, 3, 4


def arguments() -> argparse.ArgumentParser:
    # Fixed names: the options of the command.
    p = argparse.ArgumentParser(prog="linkwright", description="Link the records of one source to those of two others.")
    p.add_argument("--config", help="JSON file with settings")
    p.add_argument("--stage", choices=STAGES, default="all", help="how far to run")
    p.add_argument("--data-root", help="folder with train/ and test/")
    p.add_argument("--output-dir", help="folder for results")
    p.add_argument("--no-cache", action="store_true", help="neither read nor keep tables")
    p.add_argument("--clear-cache", action="store_true", help="remove kept tables first")
    p.add_argument("--verbose", action="store_true")
    p.add_argument("--make-demo", action="store_true", help="make small demo data first")
    p.add_argument("--check-data", action="store_true", help="only tell whether the data can be used")
    p.add_argument("--max-train-records", type=int, help="source-1 records to learn from, at most")
    p.add_argument("--keyed", choices=("simple", "strict"), help="match the test data by exact keys, without a model")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    try:
        settings = config.load(args.config, data_root=args.data_root, output_dir=args.output_dir, max_train_records=args.max_train_records).within(os.getcwd())
    except (OSError, ValueError, TypeError) as error:
        logging.error("%s", error)
        return FAILED
    spark = spark or SparkSession.builder.appName("linkwright").getOrCreate()
    try:
        if args.make_demo:
            dataset.make_demo(spark, settings.data_root)
        if args.check_data:
            code, said = dataset.readiness(spark, settings.data_root)
            print(said)
            return code
        if not dataset.discover(spark, settings.data_root)["complete"]:
            print(dataset.readiness(spark, settings.data_root)[1])
            return NO_DATA
        if errors := dataset.schema_errors(spark, settings.data_root):
            print("\n".join(errors))
            return NO_SCHEMA
        if args.keyed:
            report = keyed_run.match_files(spark, f"{settings.data_root}/test", settings.output_dir, args.keyed)
        else:
            report = run(spark, settings, args.stage, not args.no_cache, args.clear_cache)
    except (OSError, ValueError, RuntimeError, PySparkException) as error:
        logging.error("%s", error)
        return FAILED
    print(json.dumps(report, indent=2, sort_keys=True, default=str, ensure_ascii=False))
    return DONE


if __name__ == "__main__":
    raise SystemExit(main())
