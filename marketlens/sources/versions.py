"""Tables that are replaced whole: each change writes a new version beside the old one, which readers keep until it is complete."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..schemas import SCHEMAS


class Tables:
    """The declared tables under a folder that driver and executors share. A version is complete with Spark's _SUCCESS file, so a
    writer that fails leaves the table as it was; the version before the newest is kept for readers under way. One writer at a
    time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.system, self.top = fs.FileSystem.from_uri(self.root if ":" in self.root else "file://" + self.root)

    def versions(self, name: str) -> list[int]:
        found = self.system.get_file_info(fs.FileSelector(f"{self.top}/{name}", allow_not_found=True))
        numbers = [int(f.base_name[1:]) for f in found if f.base_name.startswith("v")]
        return sorted(n for n in numbers if self.system.get_file_info(f"{self.top}/{name}/v{n}/_SUCCESS").type != fs.FileType.NotFound)

    def read(self, name: str) -> DataFrame:
        """The newest version; a table that was never written is empty."""
        have = self.versions(name)
        if not have:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}/v{have[-1]}")

    def replace(self, name: str, rows: DataFrame) -> None:
        """Writes the next version. rows may read the table itself."""
        have = self.versions(name)
        columns = [f.name for f in self.spark.createDataFrame([], SCHEMAS[name]).schema]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.root}/{name}/v{have[-1] + 1 if have else 1}")
        for n in have[:-1]:
            self.system.delete_dir(f"{self.top}/{name}/v{n}")
