"""Command line: ``validate`` and ``build-features``, each one published run and a summary."""

from __future__ import annotations

import argparse
import posixpath
import sys
from typing import TextIO

from pyspark.sql import SparkSession

from tallyline.plans import runs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyline", description="Validates wagering records and builds customer features")
    commands = top.add_subparsers(dest="command", required=True)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--output", required=True, help="folder of runs; a last part named as the command's own table folder is dropped")
    shared.add_argument("--run-id", help="name of the run; its UTC start by default")
    shared.add_argument("--batch-size", type=int, default=runs.BATCH_ROWS, help="rows of a reported batch")
    shared.add_argument("--validation-workers", type=int, default=1, help="reported only: Spark schedules the work")
    shared.add_argument("--target-feature-partition-rows", type=int, default=runs.BATCH_ROWS, help="about how many source rows a partition has")
    shared.add_argument("--feature-partition-count", type=int, help="number of customer partitions, instead of the target")
    one = commands.add_parser("validate", parents=[shared])
    one.add_argument("--input", required=True, help="CSV input")
    two = commands.add_parser("build-features", parents=[shared])
    two.add_argument("--input", help="CSV input, unless a published run is reused")
    two.add_argument("--from-validation-run", help="folder of the published run to reuse")
    two.add_argument("--first-n-bets", type=int, default=runs.FIRST_N, help="largest bet number of a feature row")
    two.add_argument("--feature-workers", type=int, default=1, help="reported only: Spark schedules the work")
    return top


def output_root(command: str, output: str) -> str:
    """The folder of runs, where the command's own table folder was given."""
    parent, name = posixpath.split(output.rstrip("/"))
    return (parent or ".") if name == {"validate": "validation", "build-features": "features"}[command] else output


def summary(found: dict, with_features: bool) -> str:
    """What an operator of a run wants to see of its manifest."""
    get = lambda part, key: found.get(part, {}).get(key, "unknown")
    whole = lambda x: x if isinstance(x, int) else 0
    total, valid, invalid = (whole(get("validation", k)) for k in ("total_rows", "valid_rows", "invalid_rows"))
    share = 100 * invalid / total if total else 0
    lines = ["Batch run completed", *(f"  {label}: {found.get(key, 'unknown')}" for label, key in (("run_id", "run_id"), ("status", "status"), ("input", "input_path")))]
    if found.get("reused_validation_checkpoint"):
        lines.append(f"  source_validation_run_id: {found.get('source_validation_run_id', 'unknown')}")
    lines += [f"  {key}: {found.get(key, 'unknown')}" for key in ("started_at", "finished_at")]
    lines += ["Validation", f"  rows: {total} total, {valid} valid, {invalid} invalid ({share:.2f}% invalid)", f"  row_batches: {get('validation', 'batches_processed')}, batch_size: {get('validation', 'batch_size')}", f"  customer_partitions: {get('validation', 'feature_partition_count')}"]
    failures = found.get("validation", {}).get("failure_counts_by_rule") or {}
    lines += ["  validation_failures:" + ("" if failures else " none")]
    lines += [f"    {rule}: {n}" for rule, n in sorted(failures.items(), key=lambda x: (-whole(x[1]), x[0]))]
    if with_features:
        lines += ["Features", *(f"  {label}: {get('features', key)}" for label, key in (("customers", "customers"), ("first_n_bets", "first_n_bets"), ("customers_with_incomplete_first_n", "customers_with_incomplete_first_n"), ("feature_partitions", "feature_partition_count"), ("feature_workers", "feature_worker_count")))]
    lines += ["Outputs", f"  run_dir: {get('outputs', 'run_dir')}", *(f"  {t}: {get('outputs', f'{t}_dir')}" for t in ("raw_bets", "valid_bets", "invalid_bets"))]
    if with_features:
        lines.append(f"  customer_features: {get('features', 'feature_dir')}")
    return "\n".join([*lines, f"  manifest: {get('outputs', 'manifest')}", f"  success_marker: {get('outputs', 'success_marker')}"]) + "\n"


def main(argv: list[str] | None = None, spark: SparkSession | None = None, out: TextIO | None = None) -> int:
    known = parser()
    args = known.parse_args(argv)
    with_features = args.command == "build-features"
    if with_features and (args.input is None) == (args.from_validation_run is None):
        known.error("build-features takes either --input or --from-validation-run")
    config = runs.RunConfig(args.batch_size, args.validation_workers, args.feature_workers if with_features else 1, args.target_feature_partition_rows, args.feature_partition_count, args.first_n_bets if with_features else runs.FIRST_N)
    spark = spark or SparkSession.builder.appName("tallyline").getOrCreate()
    root = output_root(args.command, args.output)
    if not with_features:
        found = runs.validate(spark, args.input, root, args.run_id, config)
    elif args.input is not None:
        found = runs.build_features(spark, args.input, root, args.run_id, config)
    else:
        found = runs.build_features_from(spark, args.from_validation_run, root, args.run_id, config)
    (out or sys.stdout).write(summary(found, with_features))
    return 0
