"""Files and folders of any store that Spark reaches, through its file system interface."""

from __future__ import annotations

import json
import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession


class Store:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def is_file(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at) and fs.getFileStatus(at).isFile()

    def names(self, path: str) -> list[str]:
        fs, at = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def make_folder(self, path: str) -> None:
        fs, at = self._at(path)
        fs.mkdirs(at)

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def rename(self, source: str, target: str) -> None:
        """A target that is there already is an error: a folder would be moved into it."""
        (fs, at), to = self._at(source), self._at(target)[1]
        if fs.exists(to):
            raise FileExistsError(f"already exists: {target}")
        if not fs.rename(at, to):
            raise OSError(f"cannot rename {source} to {target}")

    def copy(self, source: str, target: str) -> None:
        (a, source_at), (b, target_at) = self._at(source), self._at(target)
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(a, source_at, b, target_at, False, True, self._conf)

    def read_text(self, path: str) -> str:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Written beside its place first, so that no half file is ever seen there."""
        fs, at = self._at(path)
        fs.mkdirs(at.getParent())
        beside = self._at(f"{path}.tmp")[1]
        stream = fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if fs.exists(at):
            fs.delete(at, False)
        if not fs.rename(beside, at):
            raise OSError(f"cannot write {path}")

    def read_json(self, path: str) -> dict[str, Any]:
        found = json.loads(self.read_text(path))
        if not isinstance(found, dict):
            raise ValueError(f"not a JSON object: {path}")
        return found

    def write_json(self, path: str, payload: dict[str, Any]) -> None:
        self.write_text(path, json.dumps(payload, indent=2, sort_keys=True) + "\n")

    def fingerprint(self, path: str) -> dict[str, object]:
        """Path, size and time of the last change; a local file's time is exact."""
        if os.path.isfile(path):
            found = os.stat(path)
            return {"path": path, "size_bytes": found.st_size, "mtime_ns": found.st_mtime_ns}
        fs, at = self._at(path)
        status = fs.getFileStatus(at)  # raises where there is nothing
        return {"path": path, "size_bytes": fs.getContentSummary(at).getLength(), "mtime_ns": status.getModificationTime() * 1_000_000}

    def write_csv(self, rows: DataFrame, folder: str, columns: list[str]) -> None:
        """``columns`` of ``rows`` as a folder of CSV files with headers, in row order; seen when whole.

        Other columns are left out, nulls become empty fields, and a quote in a field is doubled.
        """
        beside = f"{folder}.tmp"
        rows.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(beside)
        if self.exists(folder):
            self.delete(folder)
        self.rename(beside, folder)

    def write_parts(self, rows: DataFrame, folder: str, count: int) -> None:
        """``rows``, already in ``count`` partitions, as ``part-00000.parquet`` and so on, one for each.

        Partitions without rows get a file without rows.
        """
        key = "spark.sql.parquet.outputTimestampType"
        was = self.spark.conf.get(key)
        self.spark.conf.set(key, "TIMESTAMP_MICROS")
        try:
            rows.write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(folder)
            written = {int(name.split("-")[1]): name for name in self.names(folder) if name.startswith("part-")}
            absent = [k for k in range(count) if k not in written]
            for k, name in written.items():
                self.rename(f"{folder}/{name}", f"{folder}/{part_name(k)}")
            if absent:
                empty = f"{folder}/_empty"
                self.spark.createDataFrame([], rows.schema).coalesce(1).write.option("compression", "zstd").parquet(empty)
                source = next(f"{empty}/{name}" for name in self.names(empty) if name.startswith("part-"))
                for k in absent:
                    self.copy(source, f"{folder}/{part_name(k)}")
                self.delete(empty)
            self.delete(f"{folder}/_SUCCESS")
        finally:
            self.spark.conf.set(key, was)


def part_name(index: int) -> str:
    return f"part-{index:05d}.parquet"
