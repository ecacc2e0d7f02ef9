"""CSV source, partitions, runs and the command line."""

import csv
import hashlib
import io
import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyline import cli
from tallyline.operators import partition, rules
from tallyline.plans import runs
from tallyline.sources.csv import fieldnames, read_csv

IDS = [f"00000000-0000-4000-8000-{i:012d}" for i in range(1, 8)]


def bet(i, customer, num, **change):
    return {"bet_id": str(i), "customer_id": customer, "bet_datetime": f"2024-08-01 00:00:{num:02d}.500", "bet_num": str(num), "betting_amount": "10", "price": "3", "category": "racing", "stake_type": "cash", "bet_result": "return", "payout": "30", "return_for_entain": "-20"} | change


def write(path, rows, names=tuple(rules.COLUMNS)):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, names, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


BETS = [bet(k * 10 + n, c, n) for k, c in enumerate(IDS) for n in (1, 2, 3)] + [bet(900, IDS[0], 4, betting_amount="-1"), bet(901, "x", 1), bet(0 * 10 + 1, IDS[1], 4)]


@pytest.fixture
def bets(tmp_path):
    return write(tmp_path / "bets.csv", BETS)


def parts(folder):
    return sorted(p.name for p in Path(folder).iterdir() if not p.name.startswith("."))


def test_csv_records_and_numbers(spark, tmp_path):
    at = tmp_path / "odd.csv"
    at.write_text('﻿bet_id,price,bet_id,Bet_Num,note\n1,2,3,4,"two\nlines"\n\n5\n   \n"6 ""q""",7,,9,10,11,12\n', encoding="utf-8")
    assert fieldnames(spark, str(at)) == ["bet_id", "price", "bet_id", "Bet_Num", "note"]
    found = read_csv(spark, str(at))
    rows = rules.project(found.rows).orderBy("source_row_number").select("bet_id", "price", "bet_num", "source_row_number").collect()
    assert [tuple(r) for r in rows] == [("3", "2", "", 2), ("", "", "", 3), ("", "", "", 4), ("", "7", "", 5)]


def test_csv_without_rows_or_known_columns(spark, tmp_path):
    for name, text, n in (("empty", "", 0), ("header", "bet_id,price\n", 0), ("other", "a,b\n1,2\n3,4\n", 2)):
        (tmp_path / name).write_text(text)
        rows = rules.project(read_csv(spark, str(tmp_path / name)).rows)
        assert [r["source_row_number"] for r in rows.orderBy("source_row_number").collect()] == list(range(2, 2 + n))


@pytest.mark.parametrize("quoted", [True, False])
def test_csv_folder_is_numbered_by_file_name(spark, tmp_path, quoted):
    for k, n in enumerate((3, 50, 1)):
        write(tmp_path / f"f{k}.csv", [bet(f"{k}-{i}", IDS[0], 1) for i in range(n)])
    rows = read_csv(spark, str(tmp_path), quoted).rows.orderBy("source_row_number").select("bet_id", "source_row_number").collect()
    assert [tuple(r) for r in rows] == [(f"{k}-{i}", at) for at, (k, i) in enumerate(((k, i) for k, n in enumerate((3, 50, 1)) for i in range(n)), 2)]


def test_buckets_are_the_digest_modulo_the_count(spark):
    names = ["", "x", *IDS]
    for n in (1, 7, 1000, 2**31 - 1):
        got = spark.createDataFrame([(c,) for c in names], "c string").select(partition.bucket(F.col("c"), n)).collect()
        assert [r[0] for r in got] == [int(hashlib.sha256(c.encode()).hexdigest(), 16) % n for c in names]


def test_partition_counts():
    assert [partition.partition_count(None, 10, n) for n in (0, 10, 11)] == [1, 1, 2]
    assert partition.partition_count(3, 10, 999) == 3
    for fixed, target in ((0, 10), (None, 0)):
        with pytest.raises(ValueError):
            partition.partition_count(fixed, target, 1)


def test_a_run_and_its_reuse(spark, tmp_path, bets):
    out = tmp_path / "out"
    text = io.StringIO()
    assert cli.main(["validate", "--input", bets, "--output", f"{out}/validation", "--run-id", "one", "--feature-partition-count", "20", "--batch-size", "5"], spark, text) == 0
    root = out / "runs" / "one"
    report = json.loads((root / "validation/validation_report.json").read_text())
    assert (report["total_rows"], report["valid_rows"], report["invalid_rows"], report["batches_processed"]) == (24, 21, 3, 5)
    assert report["failure_counts_by_rule"] == dict.fromkeys(["bet_id_unique", "betting_amount_gt_0", "customer_id_uuid", "payout_formula", "return_for_entain_formula"], 1)
    assert "rows: 24 total, 21 valid, 3 invalid (12.50% invalid)" in text.getvalue()
    for table in ("raw/raw_bets", "validation/valid_bets", "validation/invalid_bets"):
        assert parts(root / table) == [f"part-{k:05d}.parquet" for k in range(20)]
    valid = pq.ParquetFile(root / "validation/valid_bets/part-00000.parquet").schema_arrow
    assert (str(valid.field("bet_datetime").type), str(valid.field("bet_id").type)) == ("timestamp[us]", "int64")
    invalid = pq.ParquetFile(root / "validation/invalid_bets/part-00000.parquet").schema_arrow
    assert str(invalid.field("validated_at").type) == "timestamp[us, tz=UTC]"
    where = {}
    for k in range(20):
        rows = pq.ParquetFile(root / f"raw/raw_bets/part-{k:05d}.parquet").read().to_pylist()
        assert [r["source_row_number"] for r in rows] == sorted(r["source_row_number"] for r in rows)
        for r in rows:
            assert where.setdefault(r["customer_id"], k) == k == int(hashlib.sha256(r["customer_id"].encode()).hexdigest(), 16) % 20
    assert not list((out / "_staging").iterdir())

    text = io.StringIO()
    assert cli.main(["build-features", "--from-validation-run", str(root), "--output", f"{out}/features", "--run-id", "two", "--first-n-bets", "3"], spark, text) == 0
    found = json.loads((out / "runs/two/run_manifest.json").read_text())
    assert (found["source_validation_run_id"], found["features"]["customers"], found["features"]["customers_with_incomplete_first_n"]) == ("one", 7, 0)
    assert found["outputs"]["valid_bets_dir"] == f"{root}/validation/valid_bets"
    table = pq.ParquetFile(out / "runs/two/features/customer_features/part-00000.parquet").schema_arrow
    assert table.names == runs.feature_columns(3) == ["customer_id", "first_bet_datetime", "bet_3_datetime", "bets_used", "total_betting_amount", "mean_betting_amount", "mean_price", "pct_racing", "pct_cash", "pct_return", "total_payout", "total_return_for_entain", "feature_generated_at"]
    assert not (out / "runs/two/raw").exists() and "source_validation_run_id: one" in text.getvalue()

    (root / "validation/valid_bets/part-00003.parquet").unlink()
    with pytest.raises(FileNotFoundError, match="part-00003"):
        runs.build_features_from(spark, str(root), str(out), "three")
    (root / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError, match="not committed"):
        runs.build_features_from(spark, str(root), str(out), "three")
    assert parts(out / "runs") == ["one", "two"]


def test_a_run_with_features_and_a_lacking_column(spark, tmp_path, bets):
    found = runs.build_features(spark, bets, str(tmp_path / "out"), "r", runs.RunConfig(first_n=2))
    assert (found["features"]["customers"], found["validation"]["feature_partition_count"]) == (7, 1)
    names = [c for c in rules.COLUMNS if c != "price"] + ["extra"]
    report = runs.validate(spark, write(tmp_path / "less.csv", BETS, names), str(tmp_path / "out"), "s")["validation"]
    assert (report["missing_columns"], report["extra_columns"], report["valid_rows"]) == (["price"], ["extra"], 0)
    assert report["failure_counts_by_rule"]["missing_column:price"] == report["failure_counts_by_rule"]["missing_value:price"] == 24


def test_failures_leave_nothing(spark, tmp_path, bets):
    out = tmp_path / "out"
    with pytest.raises(Exception):
        runs.validate(spark, str(tmp_path / "none.csv"), str(out), "a")
    for config in (runs.RunConfig(batch_size=0), runs.RunConfig(partition_count=0), runs.RunConfig(first_n=0), runs.RunConfig(feature_workers=0)):
        with pytest.raises(ValueError):
            runs.build_features(spark, bets, str(out), "a", config)
    with pytest.raises(ValueError):
        runs.validate(spark, bets, str(out), "../a")
    assert not (out / "_staging/a").exists() and not (out / "runs").exists()
    (out / "_staging/a").mkdir(parents=True)
    with pytest.raises(FileExistsError):
        runs.validate(spark, bets, str(out), "a")
    assert (out / "_staging/a").exists()


@pytest.mark.parametrize("argv", [["build-features", "--output", "o"], ["build-features", "--output", "o", "--input", "a", "--from-validation-run", "b"], ["validate", "--output", "o"], []])
def test_arguments(argv):
    with pytest.raises(SystemExit) as end:
        cli.main(argv)
    assert end.value.code == 2


def test_output_roots():
    assert [cli.output_root("validate", p) for p in ("o/validation", "o/validation/", "o/features", "validation")] == ["o", "o", "o/features", "."]
    assert cli.output_root("build-features", "o/features") == "o"
    assert "validation_failures: none" in cli.summary({}, True) and "(0.00% invalid)" in cli.summary({}, False)


def test_library_report(spark):
    raw = spark.createDataFrame([tuple(bet(1, IDS[0], n)[c] for c in rules.COLUMNS) + (n, "z") for n in (1, 2)], ", ".join(f"{c} string" for c in rules.COLUMNS) + ", source_row_number long, more string")
    valid, invalid, report = runs.library_report(raw)
    assert (valid.count(), invalid.count(), report["extra_columns"], report["failure_counts_by_rule"]) == (0, 2, ["more"], {"bet_id_unique": 2})
