"""The Parquet lake: zones under one base path, readers and writers."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: The values of a partition's columns, as its folder is named.
Partition = dict[str, str]
#: Where a partitioned table without rows keeps its columns; readers skip the name.
SCHEMA = "_esquema"


@dataclass(frozen=True)
class Lake:
    """Zones landing, raw, refined and exports_dashboard under a base path."""

    spark: SparkSession
    base: str

    def path(self, zone: str, table: str = "") -> str:
        return f"{self.base}/{zone}/{table}".rstrip("/")

    def read(self, zone: str, table: str) -> DataFrame:
        path = self.path(zone, table)
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
        return self.spark.read.schema(self.spark.read.parquet(f"{path}/{SCHEMA}").schema).parquet(path)

    def replace(self, zone: str, table: str, rows: DataFrame) -> DataFrame:
        """Write the table once and hand back the stored rows, so that later steps and
        counts read the files and nothing is computed twice."""
        rows.write.mode("overwrite").parquet(self.path(zone, table))
        return self.read(zone, table)

    def replace_partitions(
        self,
        zone: str,
        table: str,
        rows: DataFrame,
        columns: tuple[str, ...],
        order: tuple[str, ...] = (),
        only_present: bool = False,
        within: Callable[[Partition], bool] | None = None,
    ) -> DataFrame:
        """Write partitioned by columns, each file ordered so that its row groups cover
        narrow ranges. Rebalancing gathers a partition's rows into few files and splits a
        partition larger than the advisory size, so neither tiny files nor one huge task
        appear. With only_present, partitions without new rows are left as they are. `within`
        names the partitions that the rows stand for completely: of those, the ones without new
        rows are removed, all others are left. A write that is repeated ends in the same state."""
        partial = only_present or within is not None
        before = self.partitions(zone, table, columns) if within else {}
        (
            rows.hint("rebalance", *columns)
            .sortWithinPartitions(*columns, *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if partial else "static")
            .partitionBy(*columns)
            .parquet(self.path(zone, table))
        )
        if within:
            after = self.partitions(zone, table, columns)
            for values, files in before.items():  # a partition that was written has files of new names only
                if within(dict(zip(columns, values))) and after.get(values) == files:
                    self._remove(zone, table, "/".join(f"{c}={v}" for c, v in zip(columns, values)))
        if not self._files(zone, table).globStatus(self._folder(zone, table, f"{columns[0]}=*")):
            # a table without any partition has no file that tells its columns
            self.spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{self.path(zone, table)}/{SCHEMA}")
        return self.spark.read.schema(rows.schema).parquet(self.path(zone, table))

    def partitions(self, zone: str, table: str, columns: tuple[str, ...]) -> dict[tuple[str, ...], set[str]]:
        """The files of each partition, from a listing; none for a table that is not there."""
        try:
            files = self.read(zone, table).inputFiles()
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return {}
        folder = re.compile("/" + "/".join(f"{re.escape(c)}=([^/]*)" for c in columns) + "/([^/]*)$")
        found: dict[tuple[str, ...], set[str]] = {}
        for file in files:
            if named := folder.search(unquote(file)):
                *values, name = named.groups()
                found.setdefault(tuple(values), set()).add(name)
        return found

    def _folder(self, zone: str, table: str, partition: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(zone, table)}/{partition}")

    def _files(self, zone: str, table: str):
        return self._folder(zone, table, "").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _remove(self, zone: str, table: str, partition: str) -> None:
        self._files(zone, table).delete(self._folder(zone, table, partition), True)
