"""Append-only stores whose runs become visible as a whole.

A run writes its files into a folder of its own and publishes them by one small numbered file, renamed into place last. A run
that breaks before that leaves a folder nobody reads; of two runs at once, one finds its number taken and fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Store:
    """Folders published under `path`; entries are what the runs recorded, oldest first."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def _numbers(self) -> list[int]:
        folder = self._path("_runs")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def entries(self) -> list[dict]:
        found = []
        for number in self._numbers():
            stream = self._files.open(self._path(f"_runs/{number:08d}.json"))
            try:
                found.append(json.loads(bytes(stream.readAllBytes()).decode()))
            finally:
                stream.close()
        return found

    def write(self, df: DataFrame) -> str:
        """Files of this run, not visible yet; returns the folder's name."""
        name = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def publish(self, entry: dict) -> int:
        number = max(self._numbers(), default=0) + 1
        draft, final = self._path(f"_runs/.{uuid.uuid4().hex}"), self._path(f"_runs/{number:08d}.json")
        stream = self._files.create(draft)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            self._files.delete(draft, False)
            raise RuntimeError(f"run {number} was published by another build")
        return number

    def read(self, schema: str, part: str = "data") -> DataFrame:
        """All published rows of a part."""
        folders = [f"{self.path}/{entry[part]}" for entry in self.entries() if entry.get(part)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)
