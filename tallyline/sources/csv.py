"""Raw records from CSV: text columns by exact header name, and row numbers in file order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyline.operators.rules import COLUMNS

#: Number of the first record; the header is row 1.
FIRST_ROW = 2


@dataclass(frozen=True)
class RawInput:
    """Header names as they stand, and the expected columns with ``source_row_number``."""

    fieldnames: list[str]
    rows: DataFrame


def _reader(spark: SparkSession, quoted_newlines: bool):
    return spark.read.option("multiLine", quoted_newlines).option("escape", '"').option("encoding", "UTF-8")


def fieldnames(spark: SparkSession, path: str, quoted_newlines: bool = True) -> list[str]:
    """Names in the header, repeats included; none for an empty file."""
    first = _reader(spark, quoted_newlines).csv(path).head(1)
    return [name or "" for name in first[0]] if first else []


def read_csv(spark: SparkSession, path: str, quoted_newlines: bool = True) -> RawInput:
    """Records of a file, or of a folder of files with one header, numbered by file name and place.

    Blank lines are no records; short records end in nulls, and surplus fields are dropped. Of columns
    of the same name the last one counts. A file is one task, as a record may span lines; without
    ``quoted_newlines`` files are split, and lines of blanks alone are no records.
    """
    names = fieldnames(spark, path, quoted_newlines)
    wanted = [c for c in COLUMNS if c in names]
    if not wanted:  # rows still count
        found = _reader(spark, quoted_newlines).option("header", True).schema("c0 string").csv(path) if names else None
    else:
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        found = _reader(spark, quoted_newlines).option("header", True).schema(schema).csv(path)
    if found is None:
        return RawInput(names, spark.createDataFrame([], StructType([StructField("source_row_number", LongType(), False)])))
    last = {name: f"c{i}" for i, name in enumerate(names)}
    columns = [F.col(last[c]).alias(c) for c in wanted]
    placed = found.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    if quoted_newlines and len(found.inputFiles()) == 1:
        return RawInput(names, placed.select(*wanted, (F.col("at") + FIRST_ROW).alias("source_row_number")))
    # a row for each file or split of a file, which the input's listing bounds
    splits = placed.groupBy("file", "block").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = splits.select("file", "block", (before - F.col("begin")).alias("shift"))
    numbered = placed.join(offsets, ["file", "block"])
    return RawInput(names, numbered.select(*wanted, (F.col("at") + F.col("shift") + FIRST_ROW).alias("source_row_number")))
