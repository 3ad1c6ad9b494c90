"""Command line for spark-submit.

    spark-submit --py-files arrivals_mart.zip arrivals_mart/__main__.py run \
        --staging s3a://bucket/staging --production s3a://bucket/production
    python -m arrivals_mart lookups --labels <label file> --staging <dir>
    python -m arrivals_mart check --tables <production folder or catalog database>
    python -m arrivals_mart incremental --arrivals <dir> --ports <csv dir> --target <dir> --checkpoint <dir>

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
memory, checkpoint folder and AQE settings come from spark-submit / the
cluster's defaults.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from arrivals_mart.operators.quality import assert_checks, run_checks
from arrivals_mart.plans.pipeline import StagingLayout, layout_from_config, run_pipeline
from arrivals_mart.schemas import PORT_LOOKUP, TABLE_KEYS
from arrivals_mart.session import apply_scale_defaults, clear_scratch, ensure_checkpoint_dir
from arrivals_mart.sources.files import read_csv
from arrivals_mart.sources.labels import write_lookups
from arrivals_mart.streaming.incremental import incremental_fact_load


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="arrivals_mart")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="build, write, (load) and check the four tables")
    run.add_argument("--config", default=None, help="INI file with [S3] roots and [DATA] input paths")
    run.add_argument("--staging", default=None)
    run.add_argument("--production", default=None)
    run.add_argument("--warehouse", default=None, help="folder or catalog database for truncate-and-load")
    run.add_argument("--buckets", type=int, default=None, help="bucket the record-keyed warehouse tables")
    run.add_argument("--no-unique", action="store_true", help="check row counts and null keys, not uniqueness")
    for field in StagingLayout.__dataclass_fields__:
        run.add_argument(f"--{field}", default=None, help=f"relative path of the {field} input")
    lk = sub.add_parser("lookups", help="extract port and country lookups from a label dictionary")
    lk.add_argument("--labels", required=True)
    lk.add_argument("--staging", required=True)
    lk.add_argument("--valid-only", action="store_true", help="leave out labels that mark a code as not usable")
    chk = sub.add_parser("check", help="row-count, null-key and duplicate-key checks on loaded tables")
    chk.add_argument("--tables", required=True, help="folder holding one parquet folder per table, or a catalog database")
    chk.add_argument("--no-unique", action="store_true", help="check row counts and null keys, not uniqueness")
    inc = sub.add_parser("incremental", help="load the fact rows of new arrival files")
    inc.add_argument("--arrivals", required=True)
    inc.add_argument("--ports", required=True)
    inc.add_argument("--target", required=True)
    inc.add_argument("--checkpoint", required=True)
    inc.add_argument("--max-files-per-batch", type=int, default=None)
    return p


def _load_table(spark: SparkSession, where: str, table: str):
    if "/" in where:
        return spark.read.parquet(f"{where.rstrip('/')}/{table}")
    return spark.table(f"{where}.{table}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"arrivals_mart {args.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    apply_scale_defaults(spark)
    if args.command == "run":
        staging, production, layout = (
            layout_from_config(args.config) if args.config else (args.staging, args.production, StagingLayout())
        )
        staging, production = args.staging or staging, args.production or production
        if not staging or not production:
            raise SystemExit("run needs --staging and --production (or --config)")
        overrides = {f: getattr(args, f) for f in StagingLayout.__dataclass_fields__ if getattr(args, f)}
        layout = StagingLayout(**{**layout.__dict__, **overrides})
        report = run_pipeline(spark, staging, production, layout, args.warehouse, check=False, buckets=args.buckets,
                              unique=not args.no_unique)
        rows = assert_checks(report)
        for r in rows:
            print(f"{r['table_name']}: {r['row_count']} rows, key {r['key_column']} checked")
    elif args.command == "check":
        tables = {t: (_load_table(spark, args.tables, t), k) for t, k in TABLE_KEYS.items()}
        rows = assert_checks(run_checks(tables, unique=not args.no_unique))
        for r in rows:
            print(f"{r['table_name']}: {r['row_count']} rows, key {r['key_column']} checked")
    elif args.command == "lookups":
        write_lookups(spark, args.labels, args.staging, valid_only=args.valid_only)
    elif args.command == "incremental":
        ports = read_csv(spark, args.ports, PORT_LOOKUP)
        report = []
        n = incremental_fact_load(spark, args.arrivals, ports, args.target, args.checkpoint, args.max_files_per_batch, report)
        print(f"{n} micro-batches loaded")
        nulls = sum(r["null_keys"] for r in report)
        if nulls:
            raise ValueError(f"fact_immigration.immigration_id is null in {nulls} loaded rows")
    clear_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
