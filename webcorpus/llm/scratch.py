"""Written tables that cut an operator's lineage, in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webcorpus.session import remove_scratch, scratch_path


class Scratch:
    """Keeps count of an operator's written tables, so that those its result does not read can go."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.prefix, self.paths = spark, prefix, []

    def save(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        """``df`` written and read back; ``keep``: the result reads it."""
        path = scratch_path(self.spark, f"{self.prefix}-{name}")
        df.write.parquet(path)
        if not keep:
            self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            remove_scratch(self.spark, path)
        self.paths.clear()
