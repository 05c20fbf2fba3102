"""Tables that change together: each commit writes new folders and swaps one pointer to all of them.

A folder holds ``CURRENT``, a list of tables and where their rows are. What fails before the swap leaves every table
as it was; a reader sees the tables of one commit, never of two.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """The tables of ``folder``, in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        path = self._path("CURRENT")
        return self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())

    def places(self) -> dict[str, str]:
        """Folder of each table, by name; none before the first commit."""
        if not self._files().util().exists(self._path("CURRENT")):
            return {}
        return json.loads("\n".join(r["value"] for r in self.spark.read.text(f"{self.folder}/CURRENT").collect()))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.spark.read.parquet(f"{self.folder}/{place}") for name, place in self.places().items()}

    def commit(self, changed: Mapping[str, DataFrame]) -> None:
        """Write ``changed`` and swap them in together; other tables stay. Old folders stay for readers that still use them."""
        before = self.places()
        version = uuid.uuid4().hex
        for name, rows in changed.items():
            rows.write.parquet(f"{self.folder}/{version}/{name}")
        places = before | {name: f"{version}/{name}" for name in changed}
        fs = self._path("CURRENT").getFileSystem(self.spark._jsc.hadoopConfiguration())
        fresh = self._path(f"{version}/CURRENT")
        out = fs.create(fresh, True)
        try:
            out.write(bytearray(json.dumps(places).encode()))
        finally:
            out.close()
        if self.places() != before:
            raise RuntimeError("the tables were changed by another commit")
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self._files().rename(fresh, self._path("CURRENT"), how)
