"""A versioned table store on any Hadoop file system: immutable versions and a manifest that names the current one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class TableStore:
    """Data and watermark change together: both are in one manifest, which is written last and never changed (SNK-1 to
    SNK-15). Manifests are numbered; creating a number that exists fails, so of two writers one has to start again. That
    holds where the file system creates a file only if it is not there, as HDFS and local ones do; object stores without
    such a conditional write need one writer a table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _manifests(self, table: str) -> list[int]:
        at = self._path(f"{self.root}/{table}/_manifests")
        if not self._fs.exists(at):
            return []
        return sorted(int(s.getPath().getName().split(".")[0]) for s in self._fs.listStatus(at) if s.getPath().getName().endswith(".json"))

    def manifest(self, table: str) -> dict | None:
        numbers = self._manifests(table)
        if not numbers:
            return None
        stream = self._fs.open(self._path(f"{self.root}/{table}/_manifests/{numbers[-1]:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, table: str) -> DataFrame | None:
        m = self.manifest(table)
        return self.spark.read.parquet(*[f"{self.root}/{table}/{p}" for p in m["parts"]]) if m else None

    def watermark(self, table: str) -> str | None:
        m = self.manifest(table)
        return m["watermark"] if m else None

    def commit(self, table: str, df: DataFrame, *, watermark: str | None = None, append: bool = False, partition_by: list[str] = (), sort_by: list[str] = ()) -> int:
        """Writes a version (or, to append, one more part of it), then the manifest. Returns its number."""
        before, numbers = self.manifest(table), self._manifests(table)
        part = f"v-{uuid.uuid4().hex}"
        out = (df.sortWithinPartitions(*sort_by) if sort_by else df).write
        (out.partitionBy(*partition_by) if partition_by else out).parquet(f"{self.root}/{table}/{part}")
        number = (numbers[-1] if numbers else 0) + 1
        body = {"parts": [*(before["parts"] if before and append else []), part], "watermark": watermark if watermark is not None else before and before["watermark"]}
        stream = self._fs.create(self._path(f"{self.root}/{table}/_manifests/{number:012d}.json"), False)
        stream.write(bytearray(json.dumps(body).encode()))
        stream.close()
        return number

    def staged(self, table: str, df: DataFrame) -> DataFrame:
        """df as written once to the table's staging folder, which replaces what an ended run left there."""
        at = f"{self.root}/{table}/_staging"
        df.write.mode("overwrite").parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def unstage(self, table: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{table}/_staging"), True)

    def vacuum(self, table: str, keep: int = 2) -> int:
        """Deletes the versions that none of the last `keep` manifests names, and older manifests; readers of those must
        have ended. Returns how many versions went."""
        numbers = self._manifests(table)
        names = {}
        for n in numbers[-max(keep, 1) :]:
            stream = self._fs.open(self._path(f"{self.root}/{table}/_manifests/{n:012d}.json"))
            try:
                names |= dict.fromkeys(json.loads(bytes(stream.readAllBytes()).decode())["parts"])
            finally:
                stream.close()
        for n in numbers[: -max(keep, 1)]:
            self._fs.delete(self._path(f"{self.root}/{table}/_manifests/{n:012d}.json"), False)
        gone = [s.getPath() for s in self._fs.listStatus(self._path(f"{self.root}/{table}")) if s.getPath().getName().startswith("v-") and s.getPath().getName() not in names] if numbers else []
        for at in gone:
            self._fs.delete(at, True)
        return len(gone)

    def truncate(self, table: str) -> None:
        """SNK-10."""
        if (df := self.read(table)) is not None:
            self.commit(table, df.limit(0))
