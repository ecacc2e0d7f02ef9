"""A batch run: raw, validated and feature tables staged, reported, checked and published at once."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import features, partition, rules
from tallyline.sources.csv import read_csv
from tallyline.sources.store import Store, part_name

# Versions, defaults and the texts of reports.
SCHEMA_VERSION = "bets-v1"
FEATURE_SET_VERSION = "customer-first-n-v1"
BATCH_ROWS = 1000
FIRST_N = 20
FIRST_N_POLICY = "Rows are validated first. Feature generation uses only valid rows within the configured first-N bet window; later valid bets are not pulled forward to replace invalid rows inside that window."
LAYOUT = "partitioned_by_customer_hash"


def now() -> datetime:
    return datetime.now(timezone.utc)


def at_least_one(value: int, name: str) -> None:
    if value < 1:
        raise ValueError(f"{name} must be greater than 0")


@dataclass(frozen=True)
class RunConfig:
    """What a run may set. Batch size and workers are checked and reported; Spark does the scheduling."""

    batch_size: int = BATCH_ROWS
    validation_workers: int = 1
    feature_workers: int = 1
    target_partition_rows: int = BATCH_ROWS
    partition_count: int | None = None
    first_n: int = FIRST_N
    rules: rules.RuleConfig = field(default_factory=rules.RuleConfig)
    #: Columns of the feature table, all by default, and the version that its report names.
    feature_columns: tuple[str, ...] | None = None
    feature_set_version: str = FEATURE_SET_VERSION

    @property
    def features(self) -> list[str]:
        return list(self.feature_columns or feature_columns(self.first_n))

    def check(self) -> None:
        for name in ("batch_size", "validation_workers", "feature_workers", "first_n"):
            at_least_one(getattr(self, name), name)
        partition.partition_count(self.partition_count, self.target_partition_rows, 0)


@dataclass(frozen=True)
class Validated:
    """A validated data set: its report, and the run it comes from where it is reused."""

    folder: str
    report: dict
    source_run_id: str | None = None
    source_run_dir: str | None = None

    @property
    def count(self) -> int:
        return self.report["feature_partition_count"]


@dataclass(frozen=True)
class FeatureCounts:
    customers: int
    customers_with_incomplete_first_n: int


class Run:
    """Folders of one run; nothing shows under ``runs`` until ``commit``."""

    def __init__(self, store: Store, output: str, run_id: str | None = None) -> None:
        self.store, self.started_at = store, now()
        self.run_id = run_id if run_id is not None else self.started_at.strftime("run-%Y-%m-%dT%H-%M-%SZ")
        if not self.run_id or self.run_id in (".", "..") or "/" in self.run_id or "\\" in self.run_id:
            raise ValueError(f"not a run id: {self.run_id!r}")
        self.staging, self.committed = f"{output}/_staging/{self.run_id}", f"{output}/runs/{self.run_id}"
        for path in (self.staging, self.committed):
            if store.exists(path):
                raise FileExistsError(f"run already exists: {path}")
        self._runs = f"{output}/runs"

    def missing(self, validated: Validated) -> list[str]:
        """Paths that have to be there before the run is published."""
        s, n = self.staging, validated.count
        wanted, own = [f"{s}/run_manifest.json"], validated.source_run_dir is None
        if own:
            wanted.append(f"{s}/validation/validation_report.json")
        else:
            wanted += [f"{validated.source_run_dir}/_SUCCESS", f"{validated.folder}/validation_report.json"]
        tables = [f"{validated.folder}/valid_bets", f"{validated.folder}/invalid_bets"] + [f"{s}/raw/raw_bets"] * own
        if self.store.exists(f"{s}/features"):
            wanted.append(f"{s}/features/feature_report.json")
            tables.append(f"{s}/features/customer_features")
        out = [path for path in wanted if not self.store.exists(path)]
        for table in tables:
            there = set(self.store.names(table))
            out += [f"{table}/{part_name(k)}" for k in range(n) if part_name(k) not in there]
        return out

    def commit(self, validated: Validated) -> None:
        missing = self.missing(validated)
        if missing:
            raise FileNotFoundError(f"run is not whole, these paths are lacking: {', '.join(missing)}")
        self.store.write_json(f"{self.staging}/_SUCCESS", {"run_id": self.run_id, "committed_at": now().isoformat(timespec="seconds")})
        self.store.make_folder(self._runs)
        self.store.rename(self.staging, self.committed)

    def abort(self) -> None:
        self.store.delete(self.staging)


def validate_input(spark: SparkSession, store: Store, path: str, run: Run, config: RunConfig) -> Validated:
    """The raw and validated tables of a CSV input, each in customer-complete parts, and their report."""
    at = now()
    fingerprint = store.fingerprint(path)
    raw_input = read_csv(spark, path)
    total = raw_input.rows.count()
    count = partition.partition_count(config.partition_count, config.target_partition_rows, total)
    raw_dir, folder = f"{run.staging}/raw/raw_bets", f"{run.staging}/validation"
    store.write_parts(partition.customer_complete(rules.project(raw_input.rows), count, "source_row_number"), raw_dir, count)
    stored = spark.read.schema(rules.RAW_SCHEMA).parquet(raw_dir)
    present = [c for c in config.rules.columns if c in raw_input.fieldnames]
    annotated = partition.customer_complete(rules.annotate(stored, config.rules, columns=present), count, "source_row_number")
    annotated = annotated.persist(StorageLevel.DISK_ONLY)
    try:
        store.write_parts(rules.valid(annotated), f"{folder}/valid_bets", count)
        store.write_parts(rules.invalid(annotated, config.rules.columns).withColumn("validated_at", F.lit(at)), f"{folder}/invalid_bets", count)
    finally:
        annotated.unpersist()
    invalid = spark.read.parquet(f"{folder}/invalid_bets")
    failures = invalid.select(F.explode(F.split("validation_errors", r"\|")).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("failures")).orderBy("rule").collect()  # a row for each rule
    report = {
        "run_id": run.run_id,
        "generated_at": at.isoformat(timespec="seconds"),
        "schema_version": SCHEMA_VERSION,
        "total_rows": total,
        "valid_rows": spark.read.parquet(f"{folder}/valid_bets").count(),
        "invalid_rows": invalid.count(),
        "batch_size": config.batch_size,
        "batches_processed": math.ceil(total / config.batch_size),
        "feature_partition_count": count,
        "missing_columns": [c for c in config.rules.columns if c not in raw_input.fieldnames],
        "extra_columns": [c for c in raw_input.fieldnames if c not in config.rules.columns],
        "failure_counts_by_rule": {r["rule"]: r["failures"] for r in failures},
        "input_path": path,
        "input_fingerprint": fingerprint,
    }
    store.write_json(f"{folder}/validation_report.json", report)
    return Validated(folder, report)


def load_validated(spark: SparkSession, store: Store, run_dir: str) -> Validated:
    """The validated tables of a published run, after checks that it is whole and of this schema."""
    run_dir = run_dir.rstrip("/")
    folder = f"{run_dir}/validation"
    if not store.is_file(f"{run_dir}/_SUCCESS"):
        raise FileNotFoundError(f"no published run, not committed: {run_dir}/_SUCCESS is lacking")
    missing = [p for p in (f"{folder}/validation_report.json", f"{folder}/valid_bets", f"{folder}/invalid_bets") if not store.exists(p)]
    if missing:
        raise FileNotFoundError(f"the reused run lacks {', '.join(missing)}")
    report = store.read_json(f"{folder}/validation_report.json")
    if report.get("schema_version") != SCHEMA_VERSION:
        raise ValueError(f"the reused run has schema version {report.get('schema_version')!r}, not {SCHEMA_VERSION!r}")
    for name in ("feature_partition_count", "total_rows", "batches_processed", "valid_rows", "invalid_rows", "batch_size"):
        if type(report.get(name)) is not int:
            raise ValueError(f"{name!r} in the report of the reused run is no whole number")
    if not isinstance(report.get("failure_counts_by_rule"), dict):
        report["failure_counts_by_rule"] = {}
    if not isinstance(report.get("input_fingerprint"), dict):
        report["input_fingerprint"] = {}
    absent = [f"{t}/{part_name(k)}" for t in (f"{folder}/valid_bets", f"{folder}/invalid_bets") for there in [set(store.names(t))] for k in range(report["feature_partition_count"]) if part_name(k) not in there]
    if absent:
        raise FileNotFoundError(f"the reused run lacks the parts {', '.join(absent)}")
    found = dict(spark.read.parquet(f"{folder}/valid_bets").dtypes)
    if found != rules.VALID_TYPES:
        raise ValueError(f"the reused run has the columns {found}, not {rules.VALID_TYPES}")
    return Validated(folder, report, run_dir.rsplit("/", 1)[-1], run_dir)


def feature_columns(n: int) -> list[str]:
    """Columns of the feature table, in order."""
    at_least_one(n, "first_n_bets")
    return ["customer_id", "first_bet_datetime", f"bet_{n}_datetime", *features.MEASURES, "feature_generated_at"]


def write_features(spark: SparkSession, store: Store, validated: Validated, run: Run, config: RunConfig) -> FeatureCounts:
    at, folder, n = now(), f"{run.staging}/features", config.first_n
    parts = [f"{validated.folder}/valid_bets/{part_name(k)}" for k in range(validated.count)]
    built = features.build_features(spark.read.parquet(*parts), n).withColumn("feature_generated_at", F.lit(at)).select(*config.features)
    store.write_parts(partition.customer_complete(built, validated.count, "customer_id"), f"{folder}/customer_features", validated.count)
    counts = FeatureCounts(*features.completeness(spark.read.parquet(f"{folder}/customer_features"), n).first())
    store.write_json(f"{folder}/feature_report.json", {
        "input_path": validated.report.get("input_path", ""),
        "input_fingerprint": validated.report.get("input_fingerprint", {}),
        "validated_before_feature_generation": True,
        "reused_validation_checkpoint": validated.source_run_id is not None,
        "source_validation_run_id": validated.source_run_id,
        "source_validation_run_dir": validated.source_run_dir,
        "invalid_rows_excluded": validated.report["invalid_rows"],
        "run_id": run.run_id,
        "generated_at": at.isoformat(timespec="seconds"),
        "feature_set_version": config.feature_set_version,
        "feature_columns": config.features,
        "window_datetime_column": f"bet_{n}_datetime",
        **asdict(counts),
        "first_n_bets": n,
        "feature_worker_count": config.feature_workers,
        "batch_size": validated.report["batch_size"],
        "feature_partition_count": validated.count,
        "output_format": "parquet",
        "output_layout": LAYOUT,
        "first_n_policy": FIRST_N_POLICY,
    })
    return counts


def manifest(run: Run, validated: Validated, config: RunConfig, counts: FeatureCounts | None) -> dict:
    root, n = run.committed, config.first_n
    source = validated.source_run_dir or root
    built = counts is not None
    return {
        "run_id": run.run_id,
        "started_at": run.started_at.isoformat(timespec="seconds"),
        "finished_at": now().isoformat(timespec="seconds"),
        "status": "success",
        "input_path": validated.report.get("input_path", ""),
        "reused_validation_checkpoint": validated.source_run_id is not None,
        "source_validation_run_id": validated.source_run_id,
        "outputs": {
            "run_dir": root,
            "raw_bets_dir": f"{source}/raw/raw_bets",
            "validation_dir": f"{source}/validation",
            "valid_bets_dir": f"{source}/validation/valid_bets",
            "invalid_bets_dir": f"{source}/validation/invalid_bets",
            "features_dir": f"{root}/features",
            "manifest": f"{root}/run_manifest.json",
            "success_marker": f"{root}/_SUCCESS",
        },
        "validation": validated.report,
        "features": {
            "customers": counts.customers if built else 0,
            "customers_with_incomplete_first_n": counts.customers_with_incomplete_first_n if built else 0,
            "first_n_bets": n if built else None,
            "feature_columns": config.features if built else [],
            "window_datetime_column": f"bet_{n}_datetime" if built else None,
            "feature_worker_count": config.feature_workers if built else None,
            "batch_size": validated.report["batch_size"],
            "feature_partition_count": validated.count,
            "feature_dir": f"{root}/features/customer_features",
            "feature_report": f"{root}/features/feature_report.json",
        },
    }


def _publish(spark: SparkSession, output: str, run_id: str | None, config: RunConfig, source: Callable[[Store, Run], Validated], with_features: bool) -> dict:
    store = Store(spark)
    run = Run(store, output.rstrip("/") or "/", run_id)
    try:
        config.check()
        validated = source(store, run)
        counts = write_features(spark, store, validated, run, config) if with_features else None
        found = manifest(run, validated, config, counts)
        store.write_json(f"{run.staging}/run_manifest.json", found)
        run.commit(validated)
    except BaseException:
        run.abort()
        raise
    return found


def validate(spark: SparkSession, path: str, output: str, run_id: str | None = None, config: RunConfig = RunConfig()) -> dict:
    """A published run of validated tables; returns its manifest."""
    return _publish(spark, output, run_id, config, lambda store, run: validate_input(spark, store, path, run, config), False)


def build_features(spark: SparkSession, path: str, output: str, run_id: str | None = None, config: RunConfig = RunConfig()) -> dict:
    """As ``validate``, with the feature table."""
    return _publish(spark, output, run_id, config, lambda store, run: validate_input(spark, store, path, run, config), True)


def build_features_from(spark: SparkSession, run_dir: str, output: str, run_id: str | None = None, config: RunConfig = RunConfig()) -> dict:
    """The feature table from the validated tables of a published run, which stays as it is."""
    return _publish(spark, output, run_id, config, lambda store, run: load_validated(spark, store, run_dir), True)


def library_report(raw: DataFrame, config: rules.RuleConfig = rules.RuleConfig(), run_id: str | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """Valid rows, invalid rows and report of a frame, by the rules of library mode."""
    at = now().isoformat(timespec="seconds")
    annotated = rules.annotate(raw, config, mode="library")
    counts = {r["rule"]: r["failures"] for r in rules.failure_counts(annotated).orderBy("rule").collect()}
    report = {
        "run_id": run_id or at.replace(":", "").replace("+", "Z"),
        "generated_at": at,
        "schema_version": SCHEMA_VERSION,
        **rules.totals(annotated).first().asDict(),
        "missing_columns": [c for c in config.columns if c not in raw.columns],
        "extra_columns": [c for c in raw.columns if c not in config.columns and c != "source_row_number"],
        "failure_counts_by_rule": counts,
    }
    return rules.valid(annotated), rules.invalid(annotated, config.columns), report
