"""Command line: python -m lipiflow --mode single|continuous|scheduled|status|reprocess|file|report."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from lipiflow.config import get_config, setup_logging
from lipiflow.plans.pipeline import Pipeline


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lipiflow")
    parser.add_argument("--mode", default="single", choices=("single", "continuous", "scheduled", "status", "reprocess", "file", "report"))
    parser.add_argument("--config", help="file of KEY=value lines")
    parser.add_argument("--file-id")
    parser.add_argument("--output", default="report")
    parser.add_argument("--verbose", action="store_true")
    args = parser.parse_args(argv)
    config = get_config(args.config)
    log = setup_logging(config.update(log_level="DEBUG") if args.verbose else config)
    spark = SparkSession.builder.appName("lipiflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    pipeline = Pipeline(spark, config)
    show = lambda x: log.info(json.dumps(x, default=str, ensure_ascii=False))
    if args.mode == "single":
        show(pipeline.run_cycle())
    elif args.mode == "continuous":
        pipeline.run_continuous()
    elif args.mode == "scheduled":
        while pipeline.running:
            show(pipeline.run_cycle())
            time.sleep(3600)
    elif args.mode == "status":
        show(pipeline.status())
        for error in pipeline.recent_errors(3):
            show(error)
    elif args.mode == "reprocess":
        show(pipeline.reprocess_failed())
    elif args.mode == "file":
        show(pipeline.process_file(args.file_id))
    else:
        pipeline.report(args.output)


if __name__ == "__main__":
    main()
